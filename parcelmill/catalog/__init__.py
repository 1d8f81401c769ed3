"""All named queries."""

from parcelmill.catalog import io, nested, relational, reports, scalars, takeoff  # noqa: F401
from parcelmill.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
