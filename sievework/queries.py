"""All queries over the driver's tables but those of the training data operators, and their SQL."""

from sievework.plans import backlog, claims, evaluation, exports, feed, gold, incremental, intake, labels, laid, pools, reconciliation, sampling, scoring, sets, states  # noqa: F401
from sievework.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
