"""Calculation groups: items that are applied to whatever measure a report shows, as rows of an axis."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.plans.context import Context
from tidewheel.plans.measure import Measure, query
from tidewheel.plans.model import Model


@dataclass(frozen=True)
class CalculationGroup:
    """An axis of items. Each item is a function of the selected measure, in order of display; formats are display formats
    of the items that have one of their own. Of several groups, the one of higher precedence is applied to what the
    others have made of the measure."""

    name: str
    items: dict[str, Callable[[Measure], Measure]]
    formats: dict[str, str] = field(default_factory=dict)
    precedence: int = 0


def by_items(model: Model, axes: list[str], measures: dict[str, Measure], groups: list[CalculationGroup], ctx: Context = Context(), only: dict[str, list[str]] | None = None) -> DataFrame:
    """query() with the groups as further axes: a row for each combination of axis values and items for which a measure
    isn't blank. Adds, for each group, its item, <name>_ordinal and <name>_format (null: the measure's own).

    only: the items of a group that the report selects. All items are evaluated in one query, so those that need the
    same fact and axes share its scan, and are then stacked.
    """
    shown = [[i for i in g.items if i in (only or {}).get(g.name, g.items)] for g in groups]
    order = sorted(range(len(groups)), key=lambda k: groups[k].precedence)
    picks = list(product(*shown))
    applied = {(p, name): reduce(lambda m, k: groups[k].items[picks[p][k]](m), order, m) for p in range(len(picks)) for name, m in measures.items()}
    wide = query(model, axes, {f"_i{p}_{name}": m for (p, name), m in applied.items()}, ctx)
    kinds = {name: reduce(_wider, (wide.schema[f"_i{p}_{name}"].dataType for p in range(len(picks)))) for name in measures}
    rows = []
    for p, pick in enumerate(picks):
        labels = [c for g, i in zip(groups, pick) for c in (F.lit(i).alias(g.name), F.lit(list(g.items).index(i)).alias(f"{g.name}_ordinal"), F.lit(g.formats.get(i)).cast("string").alias(f"{g.name}_format"))]
        rows.append(F.struct(*labels, *(F.col(f"_i{p}_{name}").cast(kinds[name]).alias(name) for name in measures)))
    return wide.select(*axes, F.inline(F.array(*rows))).dropna("all", subset=list(measures))


def _wider(a, b):
    """The type that one column of all items' values has: theirs if all agree, else double precision."""
    return a if a == b else "double"
