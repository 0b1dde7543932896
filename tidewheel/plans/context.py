"""The filter context: which rows a measure sees. Immutable; every change gives a new one."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

_NAME = re.compile(r"[A-Za-z_]\w*")
_LITERAL = r"(?:'(?:[^']|'')*'|[+-]?\w[\w.]*)"


@dataclass(frozen=True, eq=False)
class Filter:
    """A predicate (SQL over columns of one table), or membership of column in the first column of rows.

    outer: set by the report around the query, not by a measure in it. cells: the axes that rows have
    besides keys, if every cell of these has keys of its own; column is the first of the keys.
    """

    column: str
    sql: str = ""
    rows: DataFrame | None = None
    outer: bool = False
    cells: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()

    def columns(self, known: dict[str, str]) -> set[str]:
        return {self.column} | {n for n in _NAME.findall(re.sub(r"'[^']*'", "", self.sql)) if n in known}

    @property
    def key(self) -> tuple[str, str, int]:
        return self.column, self.sql, id(self.rows) if self.rows is not None else 0


@dataclass(frozen=True, eq=False)
class Context:
    filters: tuple[Filter, ...] = ()

    @classmethod
    def slicers(cls, **predicates: str) -> "Context":
        """The report's own filters, by column."""
        return cls(tuple(Filter(c, s, outer=True) for c, s in predicates.items()))

    def set(self, column: str, sql: str) -> "Context":
        """Overwrites all filters on the column."""
        return replace(self.remove(column), filters=(*self.remove(column).filters, Filter(column, sql)))

    def keep(self, column: str, sql: str) -> "Context":
        """Adds to the filters on the column."""
        return replace(self, filters=(*self.filters, Filter(column, sql)))

    def among(self, column: str, rows: DataFrame, overwrite: bool = True) -> "Context":
        """Only values of column that are in the first column of rows, whatever that one's table: a virtual relationship."""
        base = self.remove(column) if overwrite else self
        return replace(base, filters=(*base.filters, Filter(column, rows=rows)))

    def within(self, keys: tuple[str, ...], cells: tuple[str, ...], rows: DataFrame) -> "Context":
        """Only combinations of the cells' axes and the keys that rows have."""
        return replace(self, filters=(*self.filters, Filter(keys[0], rows=rows, cells=cells, keys=keys)))

    @property
    def key(self) -> tuple:
        return tuple((f.key, f.outer) for f in self.filters)

    def remove(self, *columns: str) -> "Context":
        return replace(self, filters=tuple(f for f in self.filters if f.column not in columns))

    def clear(self) -> "Context":
        return Context()

    def outer(self, *columns: str) -> "Context":
        """Drops what measures have set (on the columns, or all), but not the report's own filters."""
        return replace(self, filters=tuple(f for f in self.filters if f.outer or columns and f.column not in columns))

    # Introspection, for measures that branch on the context.
    def is_filtered(self, *columns: str) -> bool:
        return any(f.column in columns for f in self.filters)

    def selected(self, column: str, alternate: str | None = None) -> str | None:
        """The one value that the column's filters leave (equality, or IN with literals; several filters meet), else
        alternate. Other predicates only narrow down, so with them a value that is left counts too."""
        left: set[str] | None = None
        for f in self.filters:
            m = re.fullmatch(rf"\s*{column}\s*(?:=\s*({_LITERAL})|IN\s*\(\s*({_LITERAL}(?:\s*,\s*{_LITERAL})*)\s*\))\s*", f.sql, re.I) if f.column == column else None
            if m:
                found = {x[1:-1].replace("''", "'") if x[0] == "'" else x for x in re.findall(_LITERAL, m[1] or m[2])}
                left = found if left is None else left & found
        return left.pop() if left is not None and len(left) == 1 else alternate

    def has_one_value(self, column: str) -> bool:
        return self.selected(column) is not None
