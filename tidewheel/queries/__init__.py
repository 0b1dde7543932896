"""The registered queries: each applies one operator to whole tables, with the same result in DuckDB's SQL."""

from tidewheel.queries import business, measures, names, shaping
from tidewheel.queries.base import Registry

REGISTRY = Registry()
for _module in (shaping, measures, business, names):
    _module.register(REGISTRY)
