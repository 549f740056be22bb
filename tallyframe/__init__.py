"""DataFrame operators for financial reconciliation and report delivery on Spark."""

from .params import RunParams
from .session import build_session, work_dir

__all__ = ["RunParams", "build_session", "work_dir"]
