"""Compare two snapshots of a contract registry.

Re-aimed from comparing two versions of one file to comparing two snapshots of
``contract_fields(contract, field, position, logical_type, physical_type, required,
key_position)`` for any number of contracts: the snapshots are tagged and grouped once per
field, then once per contract; column rules do the rest.

Severity per change:
  contract removed → breaking; contract added → information;
  field removed, type changed, required field added, required tightened → breaking;
  optional field added, required relaxed → compatible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.types import spark_type_name

CHANGE_COLUMNS = ["contract", "field", "change", "severity", "old_value", "new_value"]


def _fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per field of either snapshot: ``(contract, field, o_type, o_req, o_here, n_…)``."""
    def tagged(df: DataFrame, side: str) -> DataFrame:
        own, other = ("o", "n") if side == "old" else ("n", "o")
        return df.select(
            "contract", "field",
            spark_type_name(F.col("physical_type")).alias(f"{own}_type"),
            F.col("required").alias(f"{own}_req"), F.lit(True).alias(f"{own}_here"),
            F.lit(None).cast("string").alias(f"{other}_type"),
            F.lit(None).cast("boolean").alias(f"{other}_req"), F.lit(False).alias(f"{other}_here"),
        )

    return tagged(old, "old").unionByName(tagged(new, "new")).groupBy("contract", "field").agg(
        F.max("o_type").alias("o_type"), F.bool_or("o_req").alias("o_req"), F.bool_or("o_here").alias("o_here"),
        F.max("n_type").alias("n_type"), F.bool_or("n_req").alias("n_req"), F.bool_or("n_here").alias("n_here"),
    )


def contract_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """D1 + D2 (+ D3 when ordered by contract, field): one row per difference.

    A contract on one side only is one change (D1), told by its first field's row; fields are
    compared (D2) in the contracts of both snapshots."""
    fields = _fields(old, new)
    contracts = fields.groupBy("contract").agg(
        F.bool_or("o_here").alias("was"), F.bool_or("n_here").alias("stays"), F.min("field").alias("first"))
    j = fields.join(contracts, "contract")

    def change(cond, name, severity, old_v, new_v, of_field=True):
        return F.when(cond, F.struct(
            (F.col("field") if of_field else F.lit(None).cast("string")).alias("field"),
            F.lit(name).alias("change"), F.lit(severity).alias("severity"),
            old_v.cast("string").alias("old_value"), new_v.cast("string").alias("new_value")))

    none = F.lit(None)
    told = F.col("field").eqNullSafe(F.col("first"))
    both = F.col("was") & F.col("stays")
    kept = F.col("o_here") & F.col("n_here")
    o_req, n_req = (F.coalesce(F.col(c), F.lit(False)) for c in ("o_req", "n_req"))
    changes = F.array(
        change(told & ~F.col("stays"), "contract_removed", "breaking", none, none, of_field=False),
        change(told & ~F.col("was"), "contract_added", "information", none, none, of_field=False),
        change(both & ~F.col("n_here"), "field_removed", "breaking", F.col("o_type"), none),
        change(both & ~F.col("o_here") & n_req, "required_field_added", "breaking", none, F.col("n_type")),
        change(both & ~F.col("o_here") & ~n_req, "optional_field_added", "compatible", none, F.col("n_type")),
        change(kept & (F.col("o_type") != F.col("n_type")), "type_changed", "breaking", F.col("o_type"), F.col("n_type")),
        change(kept & ~o_req & n_req, "required_tightened", "breaking", F.col("o_req"), F.col("n_req")),
        change(kept & o_req & ~n_req, "required_relaxed", "compatible", F.col("o_req"), F.col("n_req")),
    )
    return j.select("contract", F.inline(F.filter(changes, lambda c: c.isNotNull()))).select(*CHANGE_COLUMNS)


def changelog(diff: DataFrame) -> DataFrame:
    """D3: the differences per contract in a stable order, numbered within their contract
    (``position``, from 1). A contract's changes are bounded by its fields."""
    order = [F.col("field").asc_nulls_first(), F.col("change")]
    numbered = diff.withColumn("position", F.row_number().over(Window.partitionBy("contract").orderBy(*order)).cast("bigint"))
    return numbered.orderBy("contract", "position")


def diff_verdict(diff: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """D4 per contract: breaking if any change is; every contract of either snapshot is
    reported, unchanged ones as not breaking."""
    every = old.select("contract").union(new.select("contract")).distinct()
    per = diff.groupBy("contract").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if(F.col("severity") == "breaking").alias("breaking_changes"),
    )
    return every.join(per, "contract", "left").select(
        "contract",
        F.coalesce(F.col("changes"), F.lit(0)).alias("changes"),
        F.coalesce(F.col("breaking_changes"), F.lit(0)).alias("breaking_changes"),
        (F.coalesce(F.col("breaking_changes"), F.lit(0)) > 0).alias("breaking"),
    )


def overall_verdict(verdict: DataFrame) -> DataFrame:
    """D4 overall: fail when any contract is breaking."""
    return verdict.agg(
        F.count(F.lit(1)).alias("contracts"),
        F.count_if("breaking").alias("breaking_contracts"),
        (~F.coalesce(F.bool_or("breaking"), F.lit(False))).alias("passed"),
    )


def snapshot_digests(stored: DataFrame, regenerated: DataFrame, by: str = "contract") -> DataFrame:
    """Per contract of either snapshot: ``rows`` (stored less regenerated) and ``same``, whether both hold the
    same multiset of rows by an order-free digest. A side's digest is its row count and the sums of two
    64-bit hashes over whole rows; both sides are added up in one grouping, the regenerated one with a minus."""
    cols = stored.columns

    def signed(df: DataFrame, sign: int) -> DataFrame:
        # The hash passes over NULL cells, so where they stand is hashed too.
        row = [*cols, *[F.isnull(c) for c in cols]]
        a, b = (F.xxhash64(F.lit(salt), *row).cast("decimal(20,0)") * sign for salt in (1, 2))
        return df.select(F.col(by), F.lit(sign).alias("n"), a.alias("a"), b.alias("b"))

    sums = signed(stored, 1).unionByName(signed(regenerated.select(*cols), -1)).groupBy(by).agg(
        F.sum("n").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select(by, "rows", ((F.col("rows") == 0) & (F.col("a") == 0) & (F.col("b") == 0)).alias("same"))


def in_sync(stored: DataFrame, regenerated: DataFrame, by: str = "contract") -> DataFrame:
    """Rows present on one side only (multiset difference both ways); empty = in sync.

    Digests are compared first; only the rows of contracts whose digests differ are compared one by one."""
    cols = stored.columns
    unequal = snapshot_digests(stored, regenerated, by).where(~F.col("same")).select(F.col(by).alias("__by"))

    def differing(df: DataFrame) -> DataFrame:
        return df.select(*cols).join(unequal, F.col(by).eqNullSafe(F.col("__by")), "left_semi")

    stored, regenerated = differing(stored), differing(regenerated)
    return stored.exceptAll(regenerated).withColumn("side", F.lit("only_stored")).unionByName(
        regenerated.exceptAll(stored).withColumn("side", F.lit("only_regenerated"))
    )
