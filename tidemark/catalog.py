"""All registered queries: importing the modules below registers theirs."""

from tidemark import queries_jobs, queries_models, queries_series  # noqa: F401
from tidemark.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
