"""Registry of driver queries and their oracle SQL."""

from __future__ import annotations

from lodestar.plans import oracles, queries

QUERIES = dict(queries.QUERIES)
ORACLES = {k: v for k, v in oracles.finalize(oracles.SQL).items() if k in QUERIES}
