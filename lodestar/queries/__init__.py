"""Registered queries over the driver tables, each with a DuckDB oracle."""

from lodestar.queries.common import ORACLES, QUERIES  # noqa: F401
from lodestar.queries import classify, extra, flows, io, linkage, records, resolution, scalars, sources  # noqa: F401
