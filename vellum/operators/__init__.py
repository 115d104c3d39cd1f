"""DataFrame operators: contracts, months, joins, distinct, checks, run log."""

from vellum.operators.checks import all_passed, pre_checks
from vellum.operators.contracts import (
    ContractError,
    cast_to_contract,
    contract_gaps,
    contract_report,
    domain_violations,
    enforce,
    require_contract,
    split_by_domain,
)
from vellum.operators.distinct import normalise_columns, normalise_distinct
from vellum.operators.joins import flat_fact, left_chain
from vellum.operators.months import (
    kept_months,
    load_contiguous_months,
    month_counts,
    month_prefix_by_key,
    month_prefix_summary,
    month_slice,
)
from vellum.operators.runs import latest_runs, lifecycle_audit, lifecycle_status, may_run, run_duration

__all__ = [
    "ContractError",
    "all_passed",
    "cast_to_contract",
    "contract_gaps",
    "contract_report",
    "domain_violations",
    "enforce",
    "flat_fact",
    "kept_months",
    "latest_runs",
    "left_chain",
    "lifecycle_audit",
    "lifecycle_status",
    "load_contiguous_months",
    "may_run",
    "month_counts",
    "month_prefix_by_key",
    "month_prefix_summary",
    "month_slice",
    "normalise_columns",
    "normalise_distinct",
    "pre_checks",
    "require_contract",
    "run_duration",
    "split_by_domain",
]
