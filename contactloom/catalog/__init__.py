"""All registered queries; importing the modules registers them."""

from contactloom.catalog import (  # noqa: F401
    columns,
    extraction,
    ordering,
    resolution,
    streams,
    tables,
)
from contactloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
