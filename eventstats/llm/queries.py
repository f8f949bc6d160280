"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from eventstats.llm import (  # noqa: F401
    queries_chat_search,
    queries_data,
    queries_models,
    queries_near,
    queries_repair,
    queries_repeats,
    queries_tokens,
)
from eventstats.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
