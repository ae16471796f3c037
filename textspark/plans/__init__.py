"""Registered queries (one per inventory item) and their oracle SQL."""

from . import pretok_queries, dialogue_queries, token_queries, dataset_queries, lm_queries, misc_queries  # noqa: F401  (registration side effects)
from .registry import ORACLE, QUERIES, register  # noqa: F401
