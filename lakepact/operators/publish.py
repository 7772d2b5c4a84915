"""S5 publish, S7 ensure_table: tables whose content is replaced by switching versions.

A plain overwrite of a file table is not atomic: an error in one task leaves the table
empty. Here every load writes a *new version folder* next to the current one (shared
storage, through Spark's commit protocol, so lost executors only retry tasks) and the
table is switched to it with one catalog call (``ALTER TABLE … SET LOCATION``). Until the
switch the table keeps serving its old files; a failed write or a failed gate leaves it
untouched.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..contract import Contract
from ..session import lake_root
from ..sources.catalog import ensure_namespace, table_exists, table_location
from .checks import sql_str
from .evolution import add_optional_columns
from .shape import align_by_name

# Folder names that this module gives to versions: the first one, and stamped ones.
_VERSION_SUFFIX = re.compile(r"_v(?:0|[0-9]{20}_[0-9a-f]{6})$")
# Table property: the folders published for the table, oldest first. Retention deletes no other.
VERSIONS = "lakepact.versions"


def create_table_ddl(contract: Contract, name: str, location: str) -> str:
    """DDL of a contract's table: columns in contract order, NOT NULL for required fields
    (informational on file tables; the `required` check is the guard), one comment each."""
    cols = ",\n  ".join(
        f"`{f.name}` {f.data_type.simpleString().upper()}"
        f"{' NOT NULL' if f.required else ''} COMMENT {sql_str(f.description or '')}"
        for f in contract.fields
    )
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet\n"
        f"LOCATION {sql_str(location)}\nCOMMENT {sql_str(contract.description or '')}"
    )


def ensure_table(spark: SparkSession, contract: Contract, name: str, namespace: str,
                 table: str | None = None) -> list[str]:
    """S6 + S7 + E7: create the table when absent (never replace it); otherwise apply only
    additive changes, refusing everything else before touching anything."""
    ns_dir = namespace.replace("`", "").replace(".", "/")
    three_part = namespace.count("`.`") > 0  # a configured catalog places its own schemas
    ensure_namespace(spark, namespace, None if three_part else f"{lake_root(spark)}/{ns_dir}")
    table = table or contract.physical_name
    if not table_exists(spark, name):
        location = f"{lake_root(spark)}/{ns_dir}/{table}/{table}_v0"
        spark.sql(create_table_ddl(contract, name, location))
        return [f"table created: {name}"]
    return add_optional_columns(spark, name, contract)


def next_version_path(spark: SparkSession, name: str) -> str:
    """A new sibling folder of the table's current location."""
    loc = table_location(spark, name)
    parent, base = loc.rstrip("/").rsplit("/", 1)
    stem = _VERSION_SUFFIX.sub("", base)
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    return f"{parent}/{stem}_v{stamp}_{uuid.uuid4().hex[:6]}"


def published_versions(spark: SparkSession, name: str) -> list[str]:
    """Folders recorded as published for the table, oldest first."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()  # a few properties of one table
    return next((r["value"].split("\n") for r in rows if r["key"] == VERSIONS and r["value"]), [])


def _record(spark: SparkSession, name: str, versions: list[str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({sql_str(VERSIONS)} = {sql_str(chr(10).join(versions))})")


def _same(path: str) -> str:
    """A folder, however a local one is written."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def switch_version(spark: SparkSession, name: str, path: str) -> None:
    """Point the table at a fully written version folder (one catalog operation) and record it."""
    previous = table_location(spark, name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_str(path)}")
    spark.catalog.refreshTable(name.replace("`", ""))
    # A recovered switch is made twice: by its owner, and by the load that found its claim.
    own = [v for v in published_versions(spark, name) if _same(v) != _same(path)]
    if previous and _same(previous) not in map(_same, [*own, path]) and _VERSION_SUFFIX.search(previous.rstrip("/")):
        own.append(previous)
    _record(spark, name, [*own, path])


class ClaimTaken(Exception):
    """Another load owns the switch away from a version."""


def _claim_path(version: str) -> str:
    # Inside the version's folder (readers skip names with a leading _), so it goes with the version.
    return f"{version.rstrip('/')}/_next_version"


def claim_switch(spark: SparkSession, name: str, current: str, path: str) -> None:
    """Compare-and-swap for the switch from ``current`` to ``path``: the commit file
    ``_next_version`` in the current version's folder, which names the next one, is created only if
    absent. Whoever creates it switches; all others are refused (``ClaimTaken``), however close
    they come. A version has one successor, so a load that began on another version than the
    table's is refused as well.

    Recovery: a load that dies between its claim and its switch leaves a claim on the table's
    current version. The next one to come finds it, finishes that switch if the claimed version is
    complete (its rows had passed their gate), or else removes the claim, and is refused once.
    """
    now = table_location(spark, name)
    if now != current:
        raise ClaimTaken(f"{name} is at {now}, not at {current}")
    claim = _claim_path(current)
    if _create_once(spark, claim, path):
        # Claimed after another load's whole switch and release: the table has moved on.
        if table_location(spark, name) == current:
            return
        release_claim(spark, current)
        raise ClaimTaken(f"{name} was switched meanwhile")
    claimed = _read_text(spark, claim)
    if claimed and table_location(spark, name) == current:
        if path_exists(spark, f"{claimed}/_SUCCESS"):
            switch_version(spark, name, claimed)  # the same switch its owner makes, if alive
        elif not path_exists(spark, claimed):
            release_claim(spark, current)
    raise ClaimTaken(f"{name}: {claimed} follows {current}")


def release_claim(spark: SparkSession, version: str) -> None:
    """Forget the successor of a version, so that another may follow it (after a rollback)."""
    delete_path(spark, _claim_path(version))


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears with its content, only if it is absent; whether it was."""
    fs, temporary = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    final = _fs(spark, path)[1]
    try:
        if fs.getScheme() == "file":  # a local rename would replace; a hard link does not
            try:
                os.link(temporary.toUri().getPath(), final.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return bool(fs.rename(temporary, final))  # refused where the target exists
    finally:
        fs.delete(temporary, False)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):  # released meanwhile
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass
class Published:
    rows: int
    location: str | None
    previous: str | None


def publish(spark: SparkSession, df: DataFrame, name: str, mode: str = "swap") -> Published:
    """Replace the table's rows with ``df``; columns bind by name.

    ``mode='swap'`` writes a new version and switches to it (the default);
    ``mode='overwrite'`` is a plain ``INSERT OVERWRITE`` (not atomic on file tables).
    Returns the row count of the table afterwards (A1).
    """
    aligned = align_by_name(df, spark.table(name).columns)
    previous = table_location(spark, name)
    rows = Observation(f"publish_{uuid.uuid4().hex[:8]}")  # counted by the write itself
    written = aligned.observe(rows, F.count(F.lit(1)).alias("n"))
    if mode == "overwrite":
        written.write.insertInto(name.replace("`", ""), overwrite=True)
        location = previous
    else:
        location = next_version_path(spark, name)
        written.write.mode("errorifexists").parquet(location)
        try:
            claim_switch(spark, name, previous, location)
        except ClaimTaken:
            delete_path(spark, location)
            raise
        switch_version(spark, name, location)
    return Published(int(rows.get["n"]), location, previous)


# --------------------------------------------------------------------------------------
# Storage housekeeping through the Hadoop file system of the session (any shared store)
# --------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a staged version that will never be published."""
    try:
        fs, p = _fs(spark, path)
        return bool(fs.delete(p, True))
    except Exception:  # storage cleanup must never hide the real outcome
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename_only_file(spark: SparkSession, folder: str, to: str) -> None:
    """Move the single part file that Spark wrote under ``folder`` to the path ``to``."""
    fs, p = _fs(spark, folder)
    part = next(st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))
    fs.rename(part, _fs(spark, to)[1])


def prune_versions(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Retention: of the versions recorded for this table, keep the newest ``keep`` (the current one
    always among them) and delete the others. Folders that were never published for this table -
    other tables', or stages of a load still in flight - are not looked at. Returns the folders
    removed."""
    current = table_location(spark, name)
    older = [v for v in published_versions(spark, name) if _same(v) != _same(current)]
    stay = max(keep - 1, 0)
    drop, kept = older[: len(older) - stay], older[len(older) - stay:]
    removed = [v for v in drop if delete_path(spark, v)]
    if drop:
        left = [v for v in drop if v not in removed and path_exists(spark, v)]
        _record(spark, name, [*left, *kept, current])
    return removed
