"""The semantic model: tables, relationships and the joins that a set of columns needs."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """Many-to-one edge: filters flow from the one side to the many side, with both also back.

    An inactive edge is used only where a measure names its many-side column. date_part compares
    the day of a timestamp. total says that the one side has every key of the many side (a generated
    calendar does): where only that key is asked for, it is taken from the fact and nothing is joined.
    """

    many: str
    many_column: str
    one: str
    one_column: str
    active: bool = True
    both: bool = False
    date_part: bool = False
    total: bool = False


class Model:
    """Tables by name (column names unique over the model, but for key columns that only join), their
    relationships, and what each column is shown and sorted by."""

    def __init__(self, tables: dict[str, DataFrame], relationships: list[Relationship], calendar: str | None = None, sort_by: dict[str, str] | None = None):
        self.tables, self.relationships, self.calendar, self.sort_by = tables, relationships, calendar, sort_by or {}
        self.home: dict[str, str] = {}
        for name, df in tables.items():
            for c in df.columns:
                if c in self.home:
                    raise ValueError(f"column {c} is in {self.home[c]} and in {name}")
                self.home[c] = name

    def path(self, fact: str, table: str, use: frozenset[str] = frozenset()) -> list[Relationship] | None:
        """Edges from fact to table, many side first; None if no filter flows that way. A used inactive edge
        takes the place of the active ones to the same table."""
        replaced = {r.one for r in self.relationships if r.many_column in use}
        queue, came = deque([fact]), {fact: []}
        while queue:
            at = queue.popleft()
            if at == table:
                return came[at]
            for r in self.relationships:
                open_ = r.many_column in use if r.one in replaced else r.active
                if r.many == at and open_ and r.one not in came:
                    came[r.one] = [*came[at], r]
                    queue.append(r.one)
        return None

    def reaches(self, fact: str, column: str, use: frozenset[str] = frozenset()) -> bool:
        return column in self.home and self.path(fact, self.home[column], use) is not None

    def star(self, fact: str, columns: set[str], use: frozenset[str] = frozenset(), shift: int = 0) -> DataFrame:
        """The fact with the columns of other tables joined to it, each dimension once, none but the columns asked for.

        Keys without a dimension row keep their fact rows (their dimension columns are null, the blank
        member). shift moves the fact's dates by months before they meet the calendar.
        """
        edges: dict[Relationship, None] = {}
        for c in sorted(columns):
            for r in self.path(fact, self.home[c], use) or []:
                edges.setdefault(r)
        ends = {r.one_column for r in edges} | {r.many_column for r in edges}
        keep = lambda t: [c for c in self.tables[t].columns if c in columns or c in ends]
        out = self.tables[fact].select(*keep(fact))
        leads = {r.many for r in edges}
        for r in sorted(edges, key=lambda r: len(self.path(fact, r.one, use) or [])):
            key = F.col(r.many_column)
            if r.date_part:
                key = F.to_date(key)
            if shift and r.one == self.calendar:
                key = F.add_months(key, shift)
            if r.total and r.one not in leads and not columns & set(self.tables[r.one].columns) - {r.one_column}:
                out = out.withColumn(r.one_column, key)
                continue
            dim = self.tables[r.one].select(*keep(r.one))
            out = out.join(dim, key == dim[r.one_column], "left")
        return out

    def route(self, fact: str, table: str, use: frozenset[str] = frozenset()) -> list[tuple[Relationship, bool]] | None:
        """How a filter on a table that the fact doesn't reach comes to it over both-ways edges: the edges from that table
        up to one that the fact reaches, or is, each with whether it is crossed from its many side. None if there is no way;
        two ways are an error, as a filter would depend on which is taken."""
        found, ways = [], deque([(table, ())])
        while ways:
            at, came = ways.popleft()
            if came and self.path(fact, at, use) is not None:
                found.append(list(came))
                continue
            been = {table, *(r.one if up else r.many for r, up in came)}
            for r in self.relationships:
                if not (r.active or r.many_column in use):
                    continue
                if r.many == at and r.both and r.one not in been:
                    ways.append((r.one, (*came, (r, True))))
                if r.one == at and r.many not in been:
                    ways.append((r.many, (*came, (r, False))))
        if len(found) > 1:
            names = " or ".join("-".join(r.one if up else r.many for r, up in w) for w in found)
            raise ValueError(f"a filter on {table} comes to {fact} by {names}")
        return found[0] if found else None

    def carried(self, way: list[tuple[Relationship, bool]], rows: DataFrame, keep: tuple[str, ...] = ()) -> tuple[str, DataFrame]:
        """Rows of the way's first table as a set of keys at its end: the column that they restrict there, and a frame of it and
        of the columns kept. Every table on the way is reduced to what the one before leaves."""
        for k, (r, up) in enumerate(way):
            here, there = (r.many_column, r.one_column) if up else (r.one_column, r.many_column)
            keys = rows.select(*(c for c in keep if c != "_key"), F.col(here).alias("_key")).distinct()
            if k == len(way) - 1:
                return there, keys
            table = self.tables[r.one if up else r.many]
            on = table[there] == keys["_key"]
            rows = table.join(keys, on).drop("_key") if keep else table.join(keys, on, "left_semi")
        raise ValueError("no way")
