"""Registered queries with their oracle SQL."""
from catalog.registry import ORACLES, QUERIES  # noqa: F401
from catalog import models, texts  # noqa: F401  (named sub-queries first; modules register on import)
from catalog import contracts, flows, operators, quality, retrieval  # noqa: F401
