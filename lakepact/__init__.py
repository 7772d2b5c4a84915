"""lakepact: contract-driven table loading on Spark.

Read a text delivery, type it by its contract, run every declared check in as few
passes as possible, publish only if all pass (switching the table to a new version),
evolve tables only additively, and lint/diff whole catalogues of contracts as Spark jobs.
"""

from .contract import Contract, ContractError, Field, Rule, Target, parse_type, resolve_target
from .operators.checks import check_report, compile_checks, failing, verdict
from .operators.evolution import EvolutionRefused, schema_drift
from .operators.gate import GateFailed, TableCheckFailed, gate, run_checks, validate_table
from .operators.publish import ensure_table, publish
from .operators.shape import align_by_name, type_columns
from .operators.diff import changelog, contract_diff, diff_verdict, in_sync
from .plans.apply import apply_all, apply_contract, check_declared_source
from .sources.registry import read_contract_registry
from .sources.text import read_landing_text

__all__ = [
    "Contract", "ContractError", "Field", "Rule", "Target", "parse_type", "resolve_target",
    "check_report", "compile_checks", "failing", "verdict", "EvolutionRefused", "schema_drift",
    "GateFailed", "TableCheckFailed", "gate", "run_checks", "validate_table", "ensure_table",
    "publish", "align_by_name", "type_columns", "apply_all", "apply_contract", "read_landing_text",
    "changelog", "contract_diff", "diff_verdict", "in_sync", "check_declared_source",
    "read_contract_registry",
]
