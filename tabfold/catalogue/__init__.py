"""Registered queries over the driver's tables, with their SQL oracles."""

from tabfold.catalogue import (  # noqa: F401
    classification,
    clustering,
    features,
    joins,
    ordered,
    regression,
    relational,
    sources,
    splits,
    streams,
    summaries,
    text,
)
from tabfold.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
