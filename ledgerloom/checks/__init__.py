"""Every query on the shared test tables, each next to the SQL it must agree with."""

from ledgerloom.checks.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
