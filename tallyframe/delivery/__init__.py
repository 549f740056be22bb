from .contracts import Col, Contract, apply_contract, check_contract, contract_problems, display_contract
from .ledger import deliver, undelivered
from .outbox import outbox, upsert_actions
from .routing import act_digest, digest, fill_rows, outcome, route, satisfied, split_outcome
from .runlog import freshness, log_row, log_run, log_view, run_status

__all__ = [
    "Col", "Contract", "act_digest", "apply_contract", "check_contract", "contract_problems", "deliver",
    "digest", "display_contract", "fill_rows", "freshness", "log_row", "log_run", "log_view", "outbox",
    "outcome", "route", "run_status", "satisfied", "split_outcome", "undelivered", "upsert_actions",
]
