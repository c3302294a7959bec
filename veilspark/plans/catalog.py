"""All registered queries and oracles (importing the modules registers them)."""

from __future__ import annotations

from veilspark.plans import checks_queries, data_queries, queries, stream_queries  # noqa: F401
from veilspark.plans.oracles import ORACLES
from veilspark.plans.queries import QUERIES

__all__ = ["QUERIES", "ORACLES"]
