"""G1 gate and G2 table validation: run the checks, decide on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from ..contract import Contract, ContractError
from .checks import check_report, failing_rows, stops


class GateFailed(ContractError):
    """The delivery breaks its contract; nothing was published."""

    def __init__(self, contract: Contract, report: list[Row], current_rows: int | None, table: str | None,
                 not_run_blocks: bool = False):
        self.report, self.current_rows, self.table = report, current_rows, table
        bad = [r for r in report if stops(r["result"], not_run_blocks)]
        keeps = (
            f" {table} keeps its {current_rows} current rows." if table is not None else ""
        )
        super().__init__(
            f"delivery breaks contract {contract.id}: {len(bad)} of {len(report)} checks failed "
            f"({', '.join(r['check'] for r in bad)}). Nothing published.{keeps}"
        )


class TableCheckFailed(ContractError):
    """The physical table breaks its contract after loading."""

    def __init__(self, contract: Contract, table: str, report: list[Row]):
        self.report, self.table = report, table
        bad = [r["check"] for r in report if stops(r["result"])]
        super().__init__(f"table {table} breaks contract {contract.id}: failed {', '.join(bad)}")


@dataclass
class Outcome:
    passed: bool
    report: list[Row]

    @property
    def failed(self) -> list[Row]:
        return [r for r in self.report if r["result"] == "failed"]

    @property
    def not_run(self) -> list[Row]:
        """Declared rules that nobody looked at: no failure, and no pass."""
        return [r for r in self.report if r["result"] == "not_run"]

    @property
    def shown(self) -> list[Row]:
        """the failing checks, or all of them when none fails."""
        return failing_rows(self.report)


def run_checks(df: DataFrame, contract: Contract, not_run_blocks: bool = False, **kw) -> Outcome:
    """R1 + R2 in one action: the report is one row per check, collected once."""
    rows = check_report(df, contract, **kw).collect()
    return Outcome(not any(stops(r["result"], not_run_blocks) for r in rows), rows)


def gate(df: DataFrame, contract: Contract, *, table: str | None = None, materialize: bool = False,
         not_run_blocks: bool = False, **kw) -> Outcome:
    """G1: check a frame before it is written; raise if any check fails, naming how many
    rows the current table keeps.

    The checks read ``df`` once for the fused aggregate and once per key/SQL check; for a
    frame parsed from text pass ``materialize=True`` to write it once to the shared folder
    first (a load does this anyway: it checks its staged copy). A rule of another engine is not run; it
    stops the frame only with ``not_run_blocks``."""
    if materialize:
        from ..session import materialize as _m

        df = _m(df, "gate")
    out = run_checks(df, contract, not_run_blocks, **kw)
    if not out.passed:
        current = None
        if table is not None:
            current = df.sparkSession.table(table).count()
        raise GateFailed(contract, out.report, current, table, not_run_blocks)
    return out


def validate_table(spark: SparkSession, contract: Contract, table: str) -> Outcome:
    """The same checks on the physical table; failure raises."""
    out = run_checks(spark.table(table), contract)
    if not out.passed:
        raise TableCheckFailed(contract, table, out.report)
    return out
