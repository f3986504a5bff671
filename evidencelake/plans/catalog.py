"""All registered queries of the session-evidence operators."""

from evidencelake.plans import answer_queries, chain_queries, decide_queries, fact_queries, intervals_queries, join_queries, report_queries, risk_queries, scalar_queries  # noqa: F401  registers its queries
from evidencelake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
