"""Secret scans: all rules as one deterministic automaton over bytes.

Each rule's regular expression becomes a set of positions (one for each byte class of the pattern);
subset construction over the positions gives an automaton that searches: a state is the threads of
all starts that are alive, the leftmost first, and a match ends all later starts. The rules' automata
run side by side as one automaton, which is minimised and laid out as a transition array over classes
of bytes. One pass over the bytes finds, for every rule, where its matches are accepted; where such a
match starts is then read backwards from its first accepting byte, over that match alone.

The pass takes many lanes of a text at a time, each from the root state, and then corrects the first
bytes of each lane by the state that the lane before it really ended in (up to where both agree), so
the result is that of one walk. Texts stay where they are: no shuffle, and memory beyond the batch is
bounded by SLICE, whatever a text's length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast

#: Bytes of a pass that are looked at together, lanes of it, and the least width of a lane.
SLICE, LANES, WIDTH = 4 << 20, 4096, 256
#: States that an automaton may have.
STATES = 20_000
#: Stands between texts; no UTF-8 text holds it.
SEPARATOR = 0xFF


@dataclass(frozen=True)
class Rule:
    """Matches of an ASCII regular expression (literals, classes, groups, alternatives, repeats), leftmost and without
    overlap; those of fewer than least bytes are dropped. tail: only the bytes from the first that completes a match
    count, that is, those of the pattern's last repeat."""

    kind: str
    pattern: str
    least: int = 1
    tail: bool = False
    ignore_case: bool = False


#: Fixed values of the contract, and the order of kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, tail=True, ignore_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]+", 24),
)
#: Publicly documented forms of keys, besides.
RULES = (
    *BASE,
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
)

_CLASSES = {sre.CATEGORY_DIGIT: b"0123456789", sre.CATEGORY_SPACE: b" \t\n\r\f\v", sre.CATEGORY_WORD: b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"}


class _Positions:
    """A pattern's positions: the bytes of each, which may come first, last, and after which."""

    def __init__(self, rule: Rule):
        self.rule, self.bytes, self.follow = rule, [], []
        nullable, self.first, self.last = self._sequence(sre_parser.parse(rule.pattern.encode()))
        if nullable:
            raise ValueError(f"rule {rule.kind} matches nothing at all")
        self.before: list[set[int]] = [set() for _ in self.bytes]
        for p, after in enumerate(self.follow):
            for q in after:
                self.before[q].add(p)
        self.lead = self._lead()
        self._back: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def _sequence(self, nodes: Iterable) -> tuple[bool, set[int], set[int]]:
        out = (True, set(), set())
        for op, arg in nodes:
            out = self._after(out, self._node(op, arg))
        return out

    def _after(self, a: tuple, b: tuple) -> tuple[bool, set[int], set[int]]:
        for p in a[2]:
            self.follow[p] |= b[1]
        return a[0] and b[0], a[1] | b[1] if a[0] else a[1], a[2] | b[2] if b[0] else b[2]

    def _node(self, op: object, arg: object) -> tuple[bool, set[int], set[int]]:
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY):
            return self._place(op, arg)
        if op is sre.SUBPATTERN:
            return self._sequence(arg[3])
        if op is sre.BRANCH:
            parts = [self._sequence(p) for p in arg[1]]
            return any(n for n, _, _ in parts), set().union(*(f for _, f, _ in parts)), set().union(*(x for _, _, x in parts))
        if op is sre.MAX_REPEAT:
            low, high, body = arg
            out = (True, set(), set())
            for k in range(max(low, 1) if high is sre.MAXREPEAT else high):
                n, first, last = self._sequence(body)
                if high is sre.MAXREPEAT and k + 1 == max(low, 1):
                    for p in last:
                        self.follow[p] |= first
                out = self._after(out, (n or k >= low, first, last))
            return out
        raise ValueError(f"rule {self.rule.kind}: {op} can't be compiled")

    def _place(self, op: object, arg: object) -> tuple[bool, set[int], set[int]]:
        found: set[int] = set()
        negate = op in (sre.NOT_LITERAL, sre.ANY)
        for what, x in arg if op is sre.IN else [(sre.LITERAL, arg if arg is not None else 10)]:
            if what is sre.NEGATE:
                negate = True
            elif what is sre.LITERAL:
                found.add(x)
            elif what is sre.RANGE:
                found.update(range(x[0], x[1] + 1))
            elif what is sre.CATEGORY and x in _CLASSES:
                found.update(_CLASSES[x])
            else:
                raise ValueError(f"rule {self.rule.kind}: {what} can't be compiled")
        if self.rule.ignore_case:
            letters = {b for b in found if chr(b).isalpha() and b < 128}
            found |= {b ^ 32 for b in letters}
        if negate:
            found = set(range(256)) - found
        self.bytes.append(frozenset(found - {SEPARATOR}))
        self.follow.append(set())
        p = {len(self.bytes) - 1}
        return False, p, p

    def _lead(self) -> int | None:
        """The most bytes up to a match's first accepting one, this included; None if there is no bound."""
        here, n = set(self.first), 1
        while here - self.last:
            if n > len(self.bytes):
                return None
            here, n = {q for p in here - self.last for q in self.follow[p]}, n + 1
        return n

    def step(self, threads: tuple[frozenset[int], ...], b: int) -> tuple[frozenset[int], ...]:
        """The next state of the search: threads by start, the leftmost first."""
        over = bool(threads) and bool(threads[0] & self.last)
        seen: set[int] = set()
        out = []
        for t in threads:
            if new := {q for p in t for q in self.follow[p] if b in self.bytes[q]} - seen:
                seen |= new
                out.append(frozenset(new))
        going_on = over and bool(out)
        if not going_on and (new := {q for q in self.first if b in self.bytes[q]} - seen):
            out.append(frozenset(new))
        accepts = [bool(t & self.last) for t in out]
        if any(accepts[1:]) and not accepts[0] or going_on and not accepts[0] or over and not going_on and any(accepts):
            raise ValueError(f"rule {self.rule.kind}: where its matches end depends on more than the bytes so far")
        return tuple(out[:1] if accepts and accepts[0] else out)

    def start(self, text: bytes, at: int, floor: int) -> int:
        """Where the match starts that text[at] completes: the leftmost place from floor on."""
        here = frozenset(p for p in self.last if text[at] in self.bytes[p])
        best = at
        while True:
            if here & self.first:
                best = at
            at -= 1
            if at < floor:
                return best
            key = here, text[at]
            if (new := self._back.get(key)) is None:
                new = self._back[key] = frozenset(q for p in here for q in self.before[p] if text[at] in self.bytes[q])
            if not new:
                return best
            here = new


class Automaton:
    """All rules in one transition array. States are numbered by their row's first entry; the root is 0."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        if len({r.kind for r in rules}) < len(rules) or len(rules) > 32:
            raise ValueError("up to 32 rules, each of its own kind")
        self.rules = rules
        self.parts = [_Positions(r) for r in rules]
        kinds: dict[tuple, int] = {}
        self.classes = np.array([kinds.setdefault((b == SEPARATOR, *(b in s for p in self.parts for s in p.bytes)), len(kinds)) for b in range(256)], np.uint8)
        samples = [int(np.flatnonzero(self.classes == k)[0]) for k in range(len(kinds))]
        root = tuple(() for _ in rules)
        number, queue, rows = {root: 0}, [root], []
        for state in queue:  # grows
            row = []
            for b in samples:
                new = root if b == SEPARATOR else tuple(p.step(t, b) for p, t in zip(self.parts, state))
                if new not in number:
                    number[new] = len(queue)
                    queue.append(new)
                row.append(number[new])
            rows.append(row)
            if len(queue) > STATES:
                raise ValueError(f"the rules need more than {STATES} states")
        table = np.array(rows)
        accepts = np.array([sum(1 << k for k, (p, t) in enumerate(zip(self.parts, s)) if t and t[0] & p.last) for s in queue], np.uint32)
        label, groups = np.unique(accepts, return_inverse=True)[1].ravel(), 0
        while groups < (groups := int(label.max()) + 1):  # until no group is parted any more
            label = np.unique(np.column_stack((label, label[table])), axis=0, return_inverse=True)[1].ravel()
        firsts = np.unique(label, return_index=True)[1]
        order = np.concatenate(([label[0]], np.delete(np.arange(groups), label[0])))  # the root first
        place = np.empty(groups, np.int64)
        place[order] = np.arange(groups)
        self.width = len(kinds)
        self.table = (place[label[table[firsts[order]]]] * self.width).ravel()
        self.accepts = np.repeat(accepts[firsts[order]], self.width)
        self.kind = np.uint16 if len(self.table) <= 1 << 16 else np.uint32

    @property
    def states(self) -> int:
        return len(self.table) // self.width

    def walk(self, data: np.ndarray, state: int = 0) -> np.ndarray:
        """The state after each byte, from a state on."""
        n = len(data)
        lanes = max(1, min(LANES, n // WIDTH))
        width = -(-n // lanes)
        classes = self.classes[data]
        padded = np.full(lanes * width, self.classes[SEPARATOR], np.uint8)
        padded[:n] = classes
        columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
        out = np.empty((width, lanes), self.kind)
        now = np.zeros(lanes, np.int64)
        for k in range(width):
            now = self.table.take(now + columns[k])
            out[k] = now
        out = np.ascontiguousarray(out.T).reshape(-1)[:n]
        table, read = self.table.tolist(), classes.tobytes()
        for at in range(0, n, width):
            was = int(out[at - 1]) if at else state
            if was:  # this lane has begun in the root state, which wasn't right
                for p in range(at, n):
                    was = table[was + read[p]]
                    if out[p] == was:
                        break
                    out[p] = was
        return out

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, of texts with separators between them; ordered."""
        whole = np.frombuffer(text, np.uint8)
        out: list[tuple[int, int, int]] = []
        last = [0] * len(self.rules)  # where each rule's last match has ended, kept or not
        waiting: list[tuple[int, int, int] | None] = [None] * len(self.rules)  # first, end, floor of one that may go on
        state = 0
        for at in range(0, len(whole), SLICE):
            walked = self.walk(whole[at : at + SLICE], state)
            state, stop = int(walked[-1]), at + len(walked)
            said = self.accepts.take(walked)
            places = np.flatnonzero(said)
            said = said[places]
            for k, rule in enumerate(self.rules):
                p = places[(said >> np.uint32(k) & np.uint32(1)).astype(bool)] + at
                cut = np.flatnonzero(np.diff(p) > 1)  # accepting bytes in a row are of one match
                firsts, ends = (p[np.concatenate(([0], cut + 1))], p[np.concatenate((cut, [len(p) - 1]))] + 1) if len(p) else (p, p)
                floors = np.concatenate(([last[k]], ends))[: len(ends)]
                if waiting[k]:
                    if len(p) and firsts[0] == at:
                        firsts[0], _, floors[0] = waiting[k]
                    else:
                        out += self._kept(text, k, *([x] for x in waiting[k]))
                    waiting[k] = None
                if len(p):
                    last[k] = int(ends[-1])
                    if last[k] == stop:
                        waiting[k] = int(firsts[-1]), stop, int(floors[-1])
                        firsts, ends, floors = firsts[:-1], ends[:-1], floors[:-1]
                    if rule.tail or self.parts[k].lead is not None:
                        long = ends - firsts >= rule.least - (0 if rule.tail else self.parts[k].lead - 1)
                        firsts, ends, floors = firsts[long], ends[long], floors[long]
                    out += self._kept(text, k, firsts.tolist(), ends.tolist(), floors.tolist())
        for k, w in enumerate(waiting):
            if w:
                out += self._kept(text, k, *([x] for x in w))
        return sorted(out, key=lambda m: (m[0], m[2]))

    def _kept(self, text: bytes, k: int, firsts: list[int], ends: list[int], floors: list[int]) -> Iterator[tuple[int, int, int]]:
        """Matches of rule k that are long enough, by their first accepting bytes, ends, and the ends of those before."""
        rule = self.rules[k]
        for first, end, floor in zip(firsts, ends, floors):
            if not rule.tail or end - first >= rule.least:
                start = self.parts[k].start(text, first, floor)
                if rule.tail or end - start >= rule.least:
                    yield start, end, k


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def found(automaton: Automaton, texts: list[bytes]) -> list[list[dict]]:
    """The spans of each text, in code points."""
    data = bytes([SEPARATOR]).join(texts)
    starts = (np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]).tolist()
    out: list[list[dict]] = [[] for _ in texts]
    hits = automaton.matches(data)
    if not hits:
        return out
    owner = [bisect_right(starts, a) - 1 for a, _, _ in hits]
    points = np.unique(np.array([0, *(x for a, b, _ in hits for x in (a, b)), *(starts[k] for k in owner)]))
    points = points[points < len(data)]
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    upto = np.concatenate(([0], np.cumsum(np.add.reduceat(begins, points, dtype=np.int64)))).tolist()
    place = dict(zip(points.tolist(), upto)) | {len(data): upto[-1]}  # code points before each
    for (a, b, k), t in zip(hits, owner):
        zero = place[starts[t]]
        out[t].append({"kind": automaton.rules[k].kind, "start": place[a] - zero, "end": place[b] - zero})
    return out


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds spans to every row of docs: kind, start and end (code points, end exclusive) of all matches of all rules, by
    start and then in the order of rules.

    Null and empty texts have none. Rows stand alone, repeated ones give equal results. A column named spans is
    replaced (the text is read before), all others pass.
    """
    shared = broadcast(docs.sparkSession, Automaton(rules))

    @F.arrow_udf(_SPANS)
    def spans_of(texts: pa.Array) -> pa.Array:
        return pa.array(found(shared.value, [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]), _TYPE)

    return docs.withColumn("spans", spans_of(F.col(text).cast("string")))


def redacted(text: Column, spans: Column, mask: str = "*") -> Column:
    """The text with every code point of a span replaced by the mask's one character; no SQL null but for a null text."""
    inside = lambda s, sofar: F.struct(
        F.concat(sofar["done"], F.substring(text, (sofar["at"] + 1).cast("int"), F.greatest(s["start"] - sofar["at"], F.lit(0)).cast("int")), F.repeat(F.lit(mask), F.greatest(s["end"] - F.greatest(s["start"], sofar["at"]), F.lit(0)).cast("int"))).alias("done"),
        F.greatest(s["end"], sofar["at"]).alias("at"),
    )
    rest = lambda x: F.concat(x["done"], F.substring(text, (x["at"] + 1).cast("int"), F.char_length(text)))
    return F.aggregate(spans, F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at")), lambda sofar, s: inside(s, sofar), rest)


def digests(rows: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (text) of scan()'s rows."""
    named: Callable[[Column], Column] = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    own = of([r.kind for r in base])
    counts = [F.size(of([r.kind])).cast("bigint").alias(f"n_{r.kind}") for r in base]
    return rows.select("doc_id", *counts, F.sha2(named(own).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def _oracle(rules: tuple[Rule, ...]) -> str:
    """The same rows in DuckDB's SQL: each rule's matches and what stands between them, whose lengths add up to places."""
    either = lambda r: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in r.pattern.split("[", 1)[0]) + "[" + r.pattern.split("[", 1)[1] if r.ignore_case else r.pattern
    one = """
  SELECT k, {n} AS place, '{kind}' AS kind, {least} AS least, {length} AS size, length(m) AS chars,
    sum(length(s) + length(m)) OVER (PARTITION BY k ORDER BY i) - length(m) AS a
  FROM (SELECT k, m, s, i, t FROM (SELECT k, t, unnest(string_split_regex(t, '{p}')[:len(ms)]) AS s, unnest(ms) AS m, unnest(range(len(ms))) AS i FROM (SELECT k, t, regexp_extract_all(t, '{p}') AS ms FROM d)))"""
    parts = []
    for n, r in enumerate(rules):
        p = either(r).replace("'", "''")
        parts.append(one.format(n=n, kind=r.kind, least=r.least, p=p, length=f"length(regexp_extract(m, '{p}', 2))" if r.tail else "length(m)"))
    named = "coalesce(string_agg(kind || ':' || a || ':' || (a + chars), ',' ORDER BY a, place){}, '')"
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
x AS ({" UNION ALL ".join(parts)}),
g AS (
  SELECT k, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)}, {named.format(f" FILTER (WHERE kind IN ({base}))")} AS base, {named.format("")} AS spans
  FROM x WHERE size >= least GROUP BY k)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.k = g.k
"""


ORACLE = _oracle(RULES)
