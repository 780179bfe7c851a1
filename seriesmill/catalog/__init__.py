"""All registered queries."""

from seriesmill.catalog import (  # noqa: F401
    context, dataset, evaluation, features, flagship, labels, modelling, sources, streaming, trading,
)
from seriesmill.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
