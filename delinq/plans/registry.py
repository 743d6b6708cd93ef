"""All registered queries; importing the topic modules registers them in this order."""

from __future__ import annotations

from delinq.plans.base import CHECKS, QUERIES
from delinq.plans.queries import catalog, columns, joins, aggregates, ranking, models, quality, streams  # noqa: F401, I001

__all__ = ["CHECKS", "QUERIES"]
