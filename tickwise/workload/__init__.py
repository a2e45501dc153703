"""Every operator as a query over the sample tables, with the SQL that checks it."""

from tickwise.workload import fault_model, runs, scoring, sources, time_axis  # noqa: F401
from tickwise.workload.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
