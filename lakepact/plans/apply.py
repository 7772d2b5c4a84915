"""W1 apply a contract to a delivery; W2 apply many.

One load = resolve target → structure → read + type → stage (one pass: typing, the
staged write and every single-pass check together) → key/grouped checks on the staged
copy → gate → switch the table to the staged version → post-load check.

Passes over the data: the delivery is read once; the staged Parquet copy is read again
only for the key/grouped checks (key columns only) and the post-load check.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from ..contract import Contract, ContractError, Target, resolve_target
from ..operators.checks import (
    MALFORMED, cast_loss_specs, check_report, compile_checks, fused_metrics, malformed_spec, stops, surplus_specs,
    usable_fused,
)
from ..operators.gate import GateFailed, Outcome, TableCheckFailed, run_checks
from ..operators.publish import (
    ClaimTaken, claim_switch, delete_path, ensure_table, next_version_path, prune_versions, release_claim, switch_version,
)
from ..sources.catalog import table_location
from ..operators.shape import align_by_name, surplus_columns, type_columns, typed_columns
from ..sources.text import read_landing_text


# The observed number of rows that a staging write wrote.
ROWS = "__rows"


@dataclass
class LoadResult:
    contract: str
    table: str
    actions: list[str]
    rows_read: int
    rows_loaded: int | None
    gate: list[Row]
    post: list[Row] | None
    surplus_columns: list[str] = field(default_factory=list)
    location: str | None = None

    @property
    def passed(self) -> bool:
        """No check failed; a rule that did not run (see ``not_run``) is no failure."""
        return not any(stops(r["result"]) for r in [*self.gate, *(self.post or [])])

    @property
    def not_run(self) -> list[str]:
        return [r["check"] for r in self.gate if r["result"] == "not_run"]


def apply_contract(
    spark: SparkSession,
    contract: Contract,
    environment: str,
    source: str | list[str] | DataFrame,
    *,
    delimiter: str | None = None,
    post_check: bool | str = True,
    mode: str = "FAILFAST",
    cast_loss: bool = False,
    raw_schema_checks: bool = False,
    multi_line: bool = True,
    split_quoted: bool = False,
    publish_mode: str = "swap",
    encoding: str = "UTF-8",
    malformed_rows: bool = False,
    rollback: bool = False,
    keep_versions: int | None = None,
    not_run_blocks: bool = False,
) -> LoadResult:
    """W1. ``source`` is a delivery path or list of paths (header CSV) or a frame of text
    columns.

    ``post_check``: True (every check again on the table, as the reference does), "schema"
    (presence, types and row count only: the table's files are the staged files the gate
    already checked, so at 100 TB this saves a full pass), or False.
    ``publish_mode``: "swap" switches the table to the staged version (file tables: the
    only atomic way); "overwrite" inserts the staged rows by name (for transactional table
    formats, whose overwrite is atomic and which do not move locations).
    ``cast_loss`` adds informational rows counting text that could not be typed;
    ``raw_schema_checks`` makes the presence checks look at the delivery's own headings.
    A row whose number of cells differs from the heading refuses the delivery (``mode``).
    ``malformed_rows`` reads on and counts such rows in a check of the gate instead.
    ``rollback`` points the table back at its previous version when the post-load check fails.
    ``keep_versions`` deletes older published versions of this table after a good load.
    ``not_run_blocks`` refuses a delivery whose contract holds a rule that only another engine runs.

    Raises ``GateFailed`` (nothing published, table untouched), ``EvolutionRefused``
    (structure cannot follow the contract), ``TableCheckFailed`` (post-load), ``ContractError``
    when another load published the table since this one began.
    """
    target: Target = resolve_target(contract, environment)
    name = target.spark_name(spark)
    actions = ensure_table(spark, contract, name, target.namespace(spark), target.table)

    if isinstance(source, (str, list, tuple)):
        local = next((s for s in contract.servers if s.delimiter), None)
        delim = delimiter or (local.delimiter if local else ",")
        paths = source if isinstance(source, str) else list(source)
        text = read_landing_text(spark, paths, delim, mode=mode, multi_line=multi_line, encoding=encoding,
                                 split_quoted=split_quoted,
                                 malformed_column=MALFORMED if malformed_rows else None)
    else:
        text = source
    flagged = MALFORMED in text.columns
    surplus = [c for c in surplus_columns(text, contract) if c != MALFORMED]
    table_cols = spark.table(name).columns
    previous = table_location(spark, name)
    specs = compile_checks(contract)
    if surplus:
        specs = specs + surplus_specs(surplus, len(specs))  # information rows, never failing
    extra = [text[MALFORMED]] if flagged else []
    if flagged:
        specs = specs + [malformed_spec(len(specs))]
    if cast_loss:
        present = [f.name for f in contract.fields if f.name in text.columns]
        extra += [text[text.columns.index(c)].alias(f"__raw__{c}") for c in present]
        specs = specs + cast_loss_specs(contract, present, len(specs))
    wide = text.select(*typed_columns(text, contract), *extra)
    typed_schema = type_columns(text, contract).schema
    specs = usable_fused(wide, specs)  # a rule that is no row predicate runs as SQL instead

    # Stage: one pass types the rows, writes the new version and gathers the fused checks.
    staged_path = next_version_path(spark, name)
    obs = Observation(f"gate_{contract.physical_name}_{uuid.uuid4().hex[:8]}")  # unique per load
    # A1: the rows are counted by the write itself, whether or not a check asks for it.
    observed_frame = wide.observe(obs, F.count(F.lit(1)).alias(ROWS), *fused_metrics(wide, specs))
    to_write = align_by_name(observed_frame, table_cols)
    try:
        to_write.write.mode("errorifexists").parquet(staged_path)
    except Exception as e:
        delete_path(spark, staged_path)  # a failed stage is debris: retention never sees it
        if "MALFORMED" in str(e):
            raise ContractError(f"{contract.id}: the delivery holds rows that do not fit its heading") from e
        raise
    observed = dict(obs.get)
    rows_read = int(observed.pop(ROWS))
    staged = spark.read.schema(to_write.schema).parquet(staged_path)  # known schema: no footer scan

    try:
        report = check_report(staged, contract, specs=specs, observed=observed, schema=typed_schema,
                              presence=text.schema if raw_schema_checks else None).collect()
    except Exception:
        delete_path(spark, staged_path)  # e.g. a SQL rule that does not analyse
        raise
    if any(stops(r["result"], not_run_blocks) for r in report):
        current = spark.table(name).count()
        delete_path(spark, staged_path)
        raise GateFailed(contract, report, current, name, not_run_blocks)

    if publish_mode == "overwrite":
        staged.select(*table_cols).write.insertInto(name.replace("`", ""), overwrite=True)
        delete_path(spark, staged_path)
        staged_path = None
    else:
        try:  # loads of one table go one after another
            claim_switch(spark, name, previous, staged_path)
        except ClaimTaken as e:
            delete_path(spark, staged_path)
            raise ContractError(f"{name}: another load published while this one ran; load again") from e
        switch_version(spark, name, staged_path)
    rows_loaded = rows_read  # the staged rows are the table's

    post = None
    if post_check:
        post_specs = None
        if post_check == "schema":
            post_specs = [s for s in compile_checks(contract) if s.plan == "schema" or s.kind == "row_count"]
        out: Outcome = run_checks(spark.table(name), contract, not_run_blocks, specs=post_specs)
        post = out.report
        if not out.passed:
            if rollback and staged_path:
                try:
                    claim_switch(spark, name, staged_path, previous)
                except ClaimTaken:
                    pass  # another load has replaced the rows since
                else:
                    release_claim(spark, previous)
                    switch_version(spark, name, previous)
            raise TableCheckFailed(contract, name, post)
    if keep_versions and staged_path:
        prune_versions(spark, name, keep_versions)
    return LoadResult(contract.id, name, actions, rows_read, rows_loaded, report, post,
                      surplus, staged_path)


def check_declared_source(spark: SparkSession, contract: Contract, server: str = "local") -> Outcome:
    """Run every check of a contract against the file source it declares for ``server``
    (format, delimiter, path), typed as a load would type it; nothing is written."""
    from ..sources.text import read_contract_source

    text = read_contract_source(spark, contract, server)
    return run_checks(type_columns(text, contract), contract)


@dataclass
class JobOutcome:
    contract: str
    status: str  # loaded | gate_failed | refused | error
    checks: int
    failed: int
    rows_loaded: int | None
    message: str


def apply_all(
    spark: SparkSession,
    jobs: Sequence[tuple[Contract, str, str | DataFrame]],
    max_parallel: int = 4,
) -> list[JobOutcome]:
    """One independent load per contract in one environment.

    Loads run concurrently on the shared SparkContext (each in its own session, so model
    views never collide); one failing load does not stop the others.
    """
    from ..operators.evolution import EvolutionRefused

    inherited = {k: v for k, v in spark.conf.getAll.items()
                 if k.startswith("lakepact.") or k == "spark.sql.session.timeZone"}

    def session_for(source):
        if not isinstance(source, (str, list, tuple)):
            return source.sparkSession
        s = spark.newSession()  # own temp views; runtime settings copied over
        for k, v in inherited.items():
            s.conf.set(k, v)
        return s

    def one(job) -> JobOutcome:
        contract, env, source = job
        s = session_for(source)
        try:
            res = apply_contract(s, contract, env, source)
            return JobOutcome(contract.id, "loaded", len(res.gate), 0, res.rows_loaded, "ok")
        except GateFailed as e:
            bad = sum(1 for r in e.report if r["result"] == "failed")
            return JobOutcome(contract.id, "gate_failed", len(e.report), bad, None, str(e))
        except TableCheckFailed as e:
            bad = sum(1 for r in e.report if r["result"] == "failed")
            return JobOutcome(contract.id, "post_check_failed", len(e.report), bad, None, str(e))
        except EvolutionRefused as e:
            return JobOutcome(contract.id, "refused", 0, len(e.problems), None, str(e))
        except Exception as e:  # noqa: BLE001 - whatever stops one load is that load's outcome
            return JobOutcome(contract.id, "error", 0, 0, None, f"{type(e).__name__}: {e}"[:500])

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return list(pool.map(one, jobs))
