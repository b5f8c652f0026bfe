"""Imports every operator, so that its query is registered."""

from __future__ import annotations

from shelfrank.llm import alignment, bpe, centroids, exact_dedup, licenses, mixture, near_dedup, nearest, pages, passages, spots, token_files, toxicity  # noqa: F401
from shelfrank.llm.registry import ORACLES, QUERIES  # noqa: F401
