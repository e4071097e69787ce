"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from tidemark.llm import curation, marking, shaping, substrings  # noqa: F401
from tidemark.llm.registry import QUERIES, SQL  # noqa: F401
