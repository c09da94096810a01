"""All queries of the catalogue."""

from __future__ import annotations

from roompulse.plans import batch, logs, model, stream  # noqa: F401  (each registers its queries)
from roompulse.plans.catalog import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
