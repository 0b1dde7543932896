"""Measures, and the compiler from axes and measures to one DataFrame plan.

A measure is evaluated in a context, per combination of axis values. Leaves that need the same fact,
axes and joins become conditional aggregates of one scan; what all of them filter is applied
before it. Only measures that iterate over keys, or that look at other axes, need a further
aggregation, and those results are joined by axis values.

A fact that doesn't reach an axis gives one value for all of the axis's values, as nothing filters it. The
rows of a result that has such a measure are the combinations that exist: those of the smallest table
that reaches the axes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.plans.context import _NAME, Context, Filter
from tidewheel.plans.model import Model
from tidewheel.plans.ranking import placed, ranked

__all__ = ["Cumulative", "Derived", "Having", "InScope", "Iterate", "Leaf", "Measure", "Rank", "Selected", "With", "calculated", "ordered", "query", "ranked", "share"]


class Measure:
    """Base of all measures; `+ - * /` combine them with blank semantics."""

    def __add__(self, other: "Measure") -> "Measure":
        from tidewheel.functions import plus

        return Derived({"a": self, "b": other}, lambda a, b: plus(a, b))

    def __sub__(self, other: "Measure") -> "Measure":
        from tidewheel.functions import minus

        return Derived({"a": self, "b": other}, lambda a, b: minus(a, b))

    def __truediv__(self, other: "Measure") -> "Measure":
        from tidewheel.functions import divide

        return Derived({"a": self, "b": other}, lambda a, b: divide(a, b))

    def __mul__(self, other: "Measure") -> "Measure":
        return Derived({"a": self, "b": other}, lambda a, b: a * b)


@dataclass(frozen=True, eq=False)
class Leaf(Measure):
    """An aggregate (sum, count, countd, min, max, avg, texts) of an SQL expression over a fact's star. count and
    countd of nothing are blank; countd counts a blank value as one; texts are the distinct values in order, with commas
    between them, for attributes of few values."""

    fact: str
    agg: str
    expr: str = "1"


@dataclass(frozen=True, eq=False)
class Derived(Measure):
    """A function of other measures' columns."""

    parts: dict[str, Measure]
    of: Callable[..., Column]


@dataclass(frozen=True, eq=False)
class With(Measure):
    """A measure in a changed context: set overwrites a column's filters (and its axis), keep adds to them, remove
    and clear lift them (and the axes), outer keeps the report's alone; among restricts a column to rows;
    use names many-side columns of inactive relationships; shift moves dates by months."""

    measure: Measure
    set: dict[str, str] = field(default_factory=dict)
    keep: dict[str, str] = field(default_factory=dict)
    remove: tuple[str, ...] = ()
    clear: bool = False
    outer: tuple[str, ...] | bool = False
    among: dict[str, DataFrame] = field(default_factory=dict)
    use: tuple[str, ...] = ()
    shift: int = 0


@dataclass(frozen=True, eq=False)
class Iterate(Measure):
    """Evaluates parts for every combination of keys (rows: computed columns, where: a filter over them), then
    aggregates with an SQL expression. A part sees the key as its filter."""

    keys: tuple[str, ...]
    parts: dict[str, Measure]
    agg: str
    rows: dict[str, str] = field(default_factory=dict)
    where: str | None = None


@dataclass(frozen=True, eq=False)
class Having(Measure):
    """The measure over those values of keys for which a predicate holds: parts are evaluated for every combination of the
    axes and keys in the current context, where is SQL over keys and parts. Every cell of the axes has values of its own;
    those for which all parts are blank are none of them. The measure may not lift an axis."""

    measure: Measure
    keys: tuple[str, ...]
    parts: dict[str, Measure]
    where: str


@dataclass(frozen=True, eq=False)
class Rank(Measure):
    """The dense rank, 1 for the largest, of the measure's value among its values for the members of column over.

    The members are those that the report leaves (selected), or all there are, each evaluated with the filters that
    measures have set on over and on lift's columns lifted, and the axes of lift as well; where is SQL over over that a
    member must fulfil. Other axes stay, so each of their cells is ranked on its own. Members without a value don't
    count; a cell's own value needn't be a member's."""

    measure: Measure
    over: str
    lift: tuple[str, ...] = ()
    selected: bool = True
    where: str | None = None


@dataclass(frozen=True, eq=False)
class Cumulative(Measure):
    """The measure over all days up to the last of each cell, whatever filters the calendar otherwise has. The axes of the
    calendar say which cells there are (without one: all days that the context leaves). Leaves in it are sums, counts,
    extremes, means and distinct counts; a part that differs by the axes must stand outside."""

    measure: Measure


@dataclass(frozen=True, eq=False)
class InScope(Measure):
    """The measure of the first of these axes that the result has in its rows' own axes, else otherwise."""

    by_axis: dict[str, Measure]
    otherwise: Measure


@dataclass(frozen=True, eq=False)
class Selected(Measure):
    """The measure of the one value that the context filters column to, else otherwise."""

    column: str
    by_value: dict[str, Measure]
    otherwise: Measure


@dataclass(frozen=True)
class _Scan:
    fact: str
    axes: tuple[str, ...]
    use: frozenset[str]
    shift: int
    members: tuple[tuple[str, str, int], ...]
    links: tuple[tuple[str, tuple[str, ...]], ...] = ()


#: Values of axes that may meet all values of axes of another fact.
CROSSED = 10_000
#: Aggregates that are those of their parts' aggregates.
_ADDS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


class _Compiler:
    """finer: the compiler of more axes, whose scans may be added up instead of scanning anew."""

    def __init__(self, model: Model, finer: "_Compiler | None" = None):
        self.model, self.finer = model, finer
        self.scans: dict[_Scan, dict[tuple, str]] = {}
        self.frames: list[tuple[tuple[str, ...], DataFrame]] = []
        self.rows: dict[tuple[str, str, int], Filter] = {}
        self.cells: dict[tuple, tuple[DataFrame, object]] = {}
        self.running: dict[tuple, dict[tuple[str, str, str], str]] = {}
        self.contexts: dict[tuple, Context] = {}
        self.spread = False
        self.n = 0

    def _name(self) -> str:
        self.n += 1
        return f"_m{self.n}"

    def column(self, m: Measure, ctx: Context, axes: tuple[str, ...], use: frozenset[str], shift: int) -> Column:
        if isinstance(m, Derived):
            return m.of(**{k: self.column(p, ctx, axes, use, shift) for k, p in m.parts.items()})
        if isinstance(m, With):
            if m.clear:
                ctx, axes = ctx.clear(), ()
            if m.outer:
                cols = () if m.outer is True else m.outer
                ctx, axes = ctx.outer(*cols), tuple(a for a in axes if cols and a not in cols)
            ctx = ctx.remove(*m.remove)
            axes = tuple(a for a in axes if a not in m.remove and a not in m.set and a not in m.among)
            for c, sql in m.set.items():
                ctx = ctx.set(c, sql)
            for c, sql in m.keep.items():
                ctx = ctx.keep(c, sql)
            for c, rows in m.among.items():
                ctx = ctx.among(c, rows)
            return self.column(m.measure, ctx, axes, use | frozenset(m.use), shift + m.shift)
        if isinstance(m, Having):
            return self.column(m.measure, self._having(m, ctx, axes, use, shift), axes, use, shift)
        if isinstance(m, Rank):
            return self._rank(m, ctx, axes, use, shift)
        if isinstance(m, Cumulative):
            return self._cumulative(m.measure, ctx, axes, use, shift)
        if isinstance(m, Iterate):
            axes = self._reached(m.parts.values(), axes, use)
            keys = (*axes, *(k for k in m.keys if k not in axes))
            inner = _evaluate(self.model, keys, m.parts, ctx, use, shift)
            for name, sql in m.rows.items():
                inner = inner.withColumn(name, F.expr(sql))
            if m.where:
                inner = inner.filter(m.where)
            name = self._name()
            self.frames.append((axes, inner.groupBy(*axes).agg(F.expr(m.agg).alias(name))))
            return F.col(name)
        if isinstance(m, InScope):
            part = next((p for a, p in m.by_axis.items() if a in axes), m.otherwise)
            return self.column(part, ctx, axes, use, shift)
        if isinstance(m, Selected):
            return self.column(m.by_value.get(ctx.selected(m.column), m.otherwise), ctx, axes, use, shift)
        if isinstance(m, Leaf):
            return self._leaf(m, ctx, axes, use, shift)
        raise TypeError(f"{m!r} is no measure")

    def _reached(self, measures: Iterable[Measure], axes: tuple[str, ...], use: frozenset[str]) -> tuple[str, ...]:
        """The axes that a fact of the measures reaches; the others don't filter them."""
        facts = {f for m in measures for f in _facts(m)}
        use = use | frozenset(c for m in measures for c in _uses(m))
        there = tuple(a for a in axes if any(self.model.reaches(f, a, use) or self.model.home.get(a) and self.model.route(f, self.model.home[a], use) for f in facts))
        self.spread |= there != axes
        return there

    def _having(self, m: Having, ctx: Context, axes: tuple[str, ...], use: frozenset[str], shift: int) -> Context:
        own = self._reached(m.parts.values(), axes, use)
        cells = (*own, *(k for k in m.keys if k not in own))
        key = (cells, m.where, tuple((n, id(p)) for n, p in m.parts.items()), ctx.key, use, shift)
        if key not in self.cells:  # measures over the same members share a scan
            self.cells[key] = _evaluate(self.model, cells, m.parts, ctx, use, shift).filter(m.where).select(*cells), m
        return ctx.within(m.keys, own, self.cells[key][0])

    def _rank(self, m: Rank, ctx: Context, axes: tuple[str, ...], use: frozenset[str], shift: int) -> Column:
        axes = self._reached([m.measure], axes, use)
        lifted = (m.over, *m.lift)
        among = ctx.outer(*lifted) if m.selected else ctx.remove(*lifted)
        within = tuple(a for a in axes if a not in lifted)
        member = F.expr(m.where) if m.where else F.lit(True)
        members = _evaluate(self.model, (*within, m.over), {"_v": m.measure}, among, use, shift)
        if m.over in axes and not set(m.lift) & set(axes) and among.key == ctx.key:
            rows, counted = members, member
        else:
            own = _evaluate(self.model, axes, {"_v": m.measure}, ctx, use, shift).withColumn("_member", F.lit(False))
            blank = {a: F.lit(None).cast(own.schema[a].dataType) for a in axes if a not in within}
            members = members.filter(member).withColumn("_member", F.lit(True)).withColumns(blank)
            rows, counted = members.select(*axes, "_v", "_member").unionByName(own), F.col("_member")
        name = self._name()
        out = placed(rows, "_v", within, None if rows is members and m.where is None else counted, name)
        if "_member" in out.columns:
            out = out.filter(~F.col("_member"))
        self.frames.append((axes, out.select(*axes, name)))
        return F.col(name)

    def _cumulative(self, m: Measure, ctx: Context, axes: tuple[str, ...], use: frozenset[str], shift: int) -> Column:
        if isinstance(m, Derived):
            return m.of(**{k: self._cumulative(p, ctx, axes, use, shift) for k, p in m.parts.items()})
        if isinstance(m, Leaf):
            axes = self._reached([m], axes, use)
            if m.agg == "avg":
                total, n = (self._cumulative(Leaf(m.fact, a, m.expr), ctx, axes, use, shift) for a in ("sum", "count"))
                return total / n
            key = (axes, ctx.key, use, shift)
            self.contexts[key] = ctx
            slots = self.running.setdefault(key, {})
            return F.col(slots.setdefault((m.fact, m.agg, m.expr), self._name()))
        raise TypeError("a cumulative measure is made of leaves and their combinations; change the context outside of it")

    def _leaf(self, m: Leaf, ctx: Context, axes: tuple[str, ...], use: frozenset[str], shift: int) -> Column:
        model = self.model
        reach = lambda c: model.reaches(m.fact, c, use)
        axes = self._reached([m], axes, use)
        plain, members, links = set(), [], {model.home[a]: [] for a in axes if not reach(a)}
        for f in ctx.filters:
            if not reach(f.column):
                if f.rows is None and model.home.get(f.column) in links:
                    links[model.home[f.column]].append(f.sql)
                way = model.route(m.fact, model.home[f.column], use) if f.column in model.home else None
                if way is None or f.keys:
                    continue
                home = model.tables[model.home[f.column]]
                start = home.filter(f.sql) if f.rows is None else home.join(f.rows.select(F.col(f.rows.columns[0]).alias("_member")).distinct(), F.col(f.column) == F.col("_member"), "left_semi")
                there, keys = model.carried(way, start)
                f = self.rows.setdefault((there, f.sql, hash(keys.semanticHash())), Filter(there, f.sql, keys))
                key = (there, f.sql, hash(keys.semanticHash()))
            elif f.rows is None:
                plain.add(f.sql)
                continue
            else:
                if lost := [c for c in f.cells if c not in axes]:
                    raise ValueError(f"a measure over selected keys lifts the axis {lost[0]}")
                key = f.key
                self.rows[key] = f
            members.append(key)
        scan = _Scan(m.fact, axes, use, shift, tuple(members), tuple((t, tuple(sqls)) for t, sqls in links.items()))
        slot = (m.agg, m.expr, frozenset(plain))
        slots = self.scans.setdefault(scan, {})
        if slot not in slots:
            slots[slot] = self._name()
        return F.col(slots[slot])

    def _scan(self, scan: _Scan, slots: dict[tuple, str], totals: bool = False) -> DataFrame:
        model = self.model
        preds = {p for _, _, plain in slots for p in plain}
        wanted = {n for text in [*preds, *(e for _, e, _ in slots)] for n in _NAME.findall(text) if n in model.home}
        wanted |= {*scan.axes, *(k[0] for k in scan.members), *(c for k in scan.members for c in (*self.rows[k].cells, *self.rows[k].keys))}
        linked = []
        for table, sqls in scan.links:  # axes that only a both-ways edge leads to: their values' keys
            rows = reduce(DataFrame.filter, sqls, model.tables[table])
            linked.append(model.carried(model.route(scan.fact, table, scan.use), rows, tuple(a for a in scan.axes if model.home[a] == table)))
            wanted.add(linked[-1][0])
        reach = lambda c: model.reaches(scan.fact, c, scan.use)
        base = model.star(scan.fact, {c for c in wanted if reach(c)}, scan.use, scan.shift)
        for k in scan.members:
            f = self.rows[k]
            if f.keys:
                names = {c: f"_member{i}" for i, c in enumerate(c for c in dict.fromkeys((*f.cells, *f.keys)) if reach(c))}
                on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
                base = base.join(f.rows.select(*(F.col(c).alias(n) for c, n in names.items())), on, "left_semi")
                continue
            rows = f.rows.select(F.col(f.rows.columns[0]).alias("_member"))
            base = base.join(rows, F.col(f.column) == F.col("_member"), "left_semi")
        for there, keys in linked:
            base = base.join(keys, F.col(there) == F.col("_key")).drop("_key")
        common = frozenset.intersection(*(plain for _, _, plain in slots))
        for p in sorted(common):
            base = base.filter(p)
        own = {plain - common for _, _, plain in slots}
        if all(own):  # rows that no aggregate sees, as those outside of all windows, needn't come this far
            both = lambda ps: reduce(lambda a, b: a & b, map(F.expr, sorted(ps)))
            base = base.filter(reduce(lambda a, b: a | b, map(both, own)))
        aggs = [_aggregate(agg, expr, plain - common, name) for (agg, expr, plain), name in slots.items()]
        if not totals:
            return base.groupBy(*scan.axes).agg(*aggs)
        level = F.lit(len(scan.axes)) - F.bit_count(F.grouping_id()).cast("int")  # of a rollup, the axes that a row has
        return base.rollup(*scan.axes).agg(*aggs, level.alias("level"))

    def _frame(self, scan: _Scan, slots: dict[tuple, str]) -> DataFrame:
        """The scan's aggregates: from those of a scan of more axes, where all of them add up."""
        for c in (self, self.finer) if self.finer else (self,):
            for s, theirs in c.scans.items():
                if s != scan and replace(s, axes=()) == replace(scan, axes=()) and set(scan.axes) <= set(s.axes) and all(k in theirs and k[0] in _ADDS for k in slots):
                    parts = c._frame(s, theirs)
                    return parts.groupBy(*scan.axes).agg(*(_ADDS[k[0]](theirs[k]).alias(name) for k, name in slots.items()))
        return self._scan(scan, slots)

    def _upto(self, key: tuple, slots: dict[tuple[str, str, str], str]) -> DataFrame:
        """Cumulative leaves per axes. Days get the number of the first cell that doesn't end before them, facts are
        aggregated by that number and the other axes, and each cell then holds what came up to it: a running aggregate of
        as many rows as there are cells at most; a distinct count counts each value where it first appears."""
        axes, _, use, shift = key
        model, ctx = self.model, self.contexts[key]
        calendar = model.tables[model.calendar]
        (day,) = {r.one_column for r in model.relationships if r.one == model.calendar}
        mine = tuple(a for a in axes if model.home[a] == model.calendar)
        others = tuple(a for a in axes if a not in mine)
        visible = calendar
        for f in ctx.filters:
            if model.home.get(f.column) == model.calendar:
                visible = visible.filter(f.sql) if f.rows is None else visible.join(f.rows.select(F.col(f.rows.columns[0]).alias("_member")), F.col(f.column) == F.col("_member"), "left_semi")
        # all of this is as small as the calendar
        cells = visible.groupBy(*mine).agg(F.max(day).alias("_end"))
        ends = cells.select("_end").distinct().withColumn("_upto", F.row_number().over(Window.orderBy("_end")))
        dated = calendar.join(ends, F.col(day) == F.col("_end"), "left")
        dated = dated.withColumn("_upto", F.min("_upto").over(Window.orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_end")
        inner = Model({**model.tables, model.calendar: dated}, [replace(r, total=False) if r.one == model.calendar else r for r in model.relationships], model.calendar)
        free = ctx.remove(*calendar.columns)
        added = {name: Leaf(*slot) for slot, name in slots.items() if slot[1] != "countd"}
        parts = []
        if added:
            parts.append(_evaluate(inner, (*others, "_upto"), added, free, use, shift))
        for (fact, _, expr), name in ((s, n) for s, n in slots.items() if s[1] == "countd"):
            of, value = inner, expr
            if expr not in model.home:  # an expression over the fact's own columns becomes one of them
                value = "_value"
                of = Model({**inner.tables, fact: inner.tables[fact].withColumn(value, F.expr(expr))}, inner.relationships, model.calendar)
            seen = _evaluate(of, (*others, value), {"_upto": Leaf(fact, "min", "_upto")}, free, use, shift)
            parts.append(seen.groupBy(*others, "_upto").agg(F.count("*").alias(name)))
        rows = parts[0]
        for p in parts[1:]:
            rows = _join(rows, p, (*others, "_upto"), "full")
        rows = rows.filter(F.col("_upto").isNotNull())  # days after the last cell
        w = Window.partitionBy(*others).orderBy("_upto")
        sofar = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = {name: {"min": F.min, "max": F.max}.get(slot[1], F.sum)(name).over(sofar) for slot, name in slots.items()}
        rows = rows.select(*others, "_upto", (F.lead("_upto").over(w) - 1).alias("_until"), *(v.alias(n) for n, v in running.items()))
        every = cells.join(ends, "_end").select(*mine, F.col("_upto").alias("_cell"))
        out = rows.join(F.broadcast(every), (F.col("_cell") >= F.col("_upto")) & F.coalesce(F.col("_cell") <= F.col("_until"), F.lit(True)))
        return out.select(*axes, *running)

    def joined(self, axes: tuple[str, ...], ctx: Context, use: frozenset[str], shift: int) -> DataFrame:
        frames = [(k[0], self._upto(k, slots)) for k, slots in self.running.items()] + self.frames
        there = {s.axes for s in self.scans} | {a for a, _ in frames}
        if axes and (self.spread or axes not in there):
            frames += self._existing(axes, ctx, use, shift, there)
        frames = [(s.axes, self._frame(s, slots)) for s, slots in self.scans.items()] + frames
        whole = [f for a, f in frames if a == axes]
        out = whole[0]
        for f in whole[1:]:
            out = _join(out, f, axes, "full")
        for a, f in frames:
            if a != axes:
                out = _join(out, f, a, "left")
        return out

    def _existing(self, axes: tuple[str, ...], ctx: Context, use: frozenset[str], shift: int, there: set[tuple[str, ...]]) -> list[tuple[tuple[str, ...], DataFrame]]:
        """The combinations of the axes' values that exist in the context: those of the table that reaches all of them by the
        fewest edges. Axes that no one table reaches meet in all combinations; all but one such part must be small."""
        model, left, parts = self.model, list(axes), []
        edges = lambda t, a: model.path(t, model.home[a], use)
        while left:
            reached = {t: [a for a in left if edges(t, a) is not None] for t in model.tables}
            t = min(model.tables, key=lambda t: (-len(reached[t]), sum(len(edges(t, a)) for a in reached[t])))
            if not reached[t]:
                raise ValueError(f"no table has the axis {left[0]}")
            parts.append((t, tuple(reached[t])))
            left = [a for a in left if a not in reached[t]]
        if len(parts) == 1:
            self._leaf(Leaf(parts[0][0], "count"), ctx, axes, use, shift)  # its rows are the combinations
            return []
        found = [_evaluate(model, mine, {"_n": Leaf(t, "count")}, ctx, use, shift).select(*mine) for t, mine in parts]
        sizes = [f.limit(CROSSED + 1).count() for f in found]
        large = max(range(len(found)), key=sizes.__getitem__)
        if any(n > CROSSED for k, n in enumerate(sizes) if k != large):
            raise ValueError(f"no table reaches all of {axes}, and more than one part of them has over {CROSSED} values")
        out = found[large]
        for k, f in enumerate(found):
            if k != large:
                out = out.crossJoin(F.broadcast(f))  # at most CROSSED rows
        return [(axes, out.select(*axes))]


def _parts(m: Measure) -> list[Measure]:
    """The measures that a measure is made of."""
    own = [*getattr(m, "parts", {}).values(), *getattr(m, "by_axis", {}).values(), *getattr(m, "by_value", {}).values()]
    return own + [x for x in (getattr(m, "measure", None), getattr(m, "otherwise", None)) if x is not None]


def _tree(m: Measure) -> Iterator[Measure]:
    yield m
    for p in _parts(m):
        yield from _tree(p)


def _facts(m: Measure) -> set[str]:
    return {x.fact for x in _tree(m) if isinstance(x, Leaf)}


def _uses(m: Measure) -> set[str]:
    return {c for x in _tree(m) if isinstance(x, With) for c in x.use}


def _aggregate(agg: str, expr: str, where: frozenset[str], name: str) -> Column:
    on = reduce(lambda a, b: a & b, map(F.expr, sorted(where))) if where else None
    value = F.expr(expr) if on is None else F.when(on, F.expr(expr))
    if agg == "countd":
        blank = F.expr(expr).isNull() if on is None else on & F.expr(expr).isNull()
        n = F.count_distinct(value) + F.coalesce(F.max(F.when(blank, 1)), F.lit(0))
        return F.when(n > 0, n).alias(name)
    if agg == "count":
        n = F.count(value)
        return F.when(n > 0, n).alias(name)
    if agg == "texts":
        found = F.array_sort(F.collect_set(value))
        return F.when(F.size(found) > 0, F.array_join(found.cast("array<string>"), ", ")).alias(name)
    return getattr(F, agg)(value).alias(name)


def _join(left: DataFrame, right: DataFrame, axes: tuple[str, ...], how: str) -> DataFrame:
    """By axis values, where null equals null."""
    if not axes:
        return left.crossJoin(right)  # one row on the right side, from a total aggregate
    names = {a: f"_r_{a}" for a in axes}
    right = right.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(n)) for a, n in names.items()))
    if how == "full":
        left, right = left.withColumn("_l", F.lit(True)), right
        out = left.join(right, on, "full")
        return out.withColumns({a: F.when(F.col("_l"), F.col(a)).otherwise(F.col(n)) for a, n in names.items()}).drop("_l", *names.values())
    return left.join(right, on, "left").drop(*names.values())


def _evaluate(model: Model, axes: tuple[str, ...], measures: dict[str, Measure], ctx: Context, use: frozenset[str] = frozenset(), shift: int = 0, compiler: _Compiler | None = None) -> DataFrame:
    c = compiler or _Compiler(model)
    columns = {name: c.column(m, ctx, axes, use, shift) for name, m in measures.items()}
    rows = c.joined(axes, ctx, use, shift)
    return rows.select(*axes, *(col.alias(name) for name, col in columns.items())).dropna("all", subset=list(measures))


def query(model: Model, axes: list[str], measures: dict[str, Measure], ctx: Context = Context(), totals: bool = False) -> DataFrame:
    """One row per combination of axis values for which a measure isn't blank: axes, then measures.

    totals: adds subtotals of every leading part of the axes and the grand total, each evaluated at its
    own level, and a column level, the number of axes that a row has. The aggregates within measures that
    add up (sums, counts, extremes) are taken from those of the level below, so they share one scan of the
    fact. Where others (distinct counts, averages) stand on the report's own axes, all levels are one
    rollup of one scan; iterations, and what looks at other axes, are evaluated anew at each level.
    """
    if not totals:
        return _evaluate(model, tuple(axes), measures, ctx)
    if (whole := _rolled_up(model, tuple(axes), measures, ctx)) is not None:
        return whole
    out = compiler = None
    for k in range(len(axes), -1, -1):
        compiler = _Compiler(model, compiler)
        part = _evaluate(model, tuple(axes[:k]), measures, ctx, compiler=compiler)
        missing = {a: F.lit(None).cast(model.tables[model.home[a]].schema[a].dataType) for a in axes[k:]}
        part = part.withColumns(missing).select(*axes, *measures, F.lit(k).alias("level"))
        out = part if out is None else out.unionByName(part)
    return out


def _rolled_up(model: Model, axes: tuple[str, ...], measures: dict[str, Measure], ctx: Context) -> DataFrame | None:
    """All levels of query()'s totals from one rollup of each fact's scan; None if aggregates that add up do without, or if
    a measure looks at other axes than its rows'."""
    if not axes or any(isinstance(x, (Having, InScope, Iterate, Rank, Cumulative)) for m in measures.values() for x in _tree(m)):
        return None
    c = _Compiler(model)
    columns = {name: c.column(m, ctx, axes, frozenset(), 0) for name, m in measures.items()}
    if c.spread or any(s.axes != axes for s in c.scans) or all(k[0] in _ADDS for slots in c.scans.values() for k in slots):
        return None
    out = None
    for scan, slots in c.scans.items():
        frame = c._scan(scan, slots, totals=True)
        out = frame if out is None else _join(out, frame, (*axes, "level"), "full")
    return out.select(*axes, *(v.alias(k) for k, v in columns.items()), "level").dropna("all", subset=list(measures))


def ordered(model: Model, rows: DataFrame, *axes: str) -> DataFrame:
    """rows in the order of these axes, each by the column that the model sorts it by (the value itself where it names
    none; an axis value's smallest, if it has several)."""
    keys = []
    for a in axes:
        by = model.sort_by.get(a)
        if by is None:
            keys.append(F.col(a))
            continue
        places = model.tables[model.home[a]].groupBy(a).agg(F.min(by).alias(f"_by_{a}"))
        rows = _join(rows, places, (a,), "left")
        keys.append(F.col(f"_by_{a}"))
    return rows.orderBy(*keys).drop(*(f"_by_{a}" for a in axes))


def calculated(model: Model, table: str, columns: dict[str, Measure], keys: list[str] | None = None, ctx: Context = Context()) -> DataFrame:
    """The table with columns that are measures, each evaluated with its row as filter.

    keys: the columns of the table that filter (default: all of them). A measure is evaluated once for each distinct
    combination of these that the table has and joined back, null to null, so rows that agree in them get equal
    values, and rows for which nothing is found a blank. A fact that a key doesn't reach isn't filtered by it.
    """
    rows, by = model.tables[table], keys or model.tables[table].columns
    if clash := set(columns) & set(rows.columns):
        raise ValueError(f"the table has a column {min(clash)}")
    found = _evaluate(model, tuple(by), columns, ctx)
    return _join(rows, found, tuple(by), "left").select(*rows.columns, *columns)


def share(measure: Measure, *axes: str) -> Measure:
    """The measure over its value with the axes' filters lifted."""
    return measure / With(measure, remove=axes)
