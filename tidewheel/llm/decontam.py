"""Benchmark decontamination with a generalised suffix automaton over the test items' words.

A window is `window` consecutive words of an item, or a whole item of fewer words. Training texts
are streamed word by word through the automaton, which tracks the longest suffix that occurs in
some item. Where that match is as long as a window, the window's words are hit, and the state
tells which items hold it. A document whose hit words reach the coverage limit is contaminated,
and the operator cuts the hit spans out of its text.

The documents never move: one pass, no shuffle. The benchmark is read in blocks of about
BLOCK_CHARS characters, each with an automaton of its own; beyond one block there is a pass for each,
one after the other (so one automaton is held and broadcast at a time), whose hits are written, and
the hits of a text are united by the text's digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast, delete, looked_up, shared_dir, written

#: Characters of item texts in one automaton; bounds what the driver holds and broadcasts at a time.
BLOCK_CHARS = 4_000_000

#: A-Z becomes a-z, other ASCII but digits and a-z becomes a space; bytes over 127 stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """The words of a text: lower-cased runs of a-z, 0-9 and non-ASCII characters, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton of items (id, words), and which windows each state stands for."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.word_ids: dict[bytes, int] = {}
        number = self.word_ids.setdefault
        coded = [(key, [number(w, len(self.word_ids)) for w in ws]) for key, ws in items if ws]
        self.shortest = min([window, *(len(ws) for _, ws in coded)])
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        states = range(len(self.next))
        by_length = sorted(states, key=self.length.__getitem__)
        #: Of a state of at least a window's length: the state that holds its suffix of that length.
        self.window_state = [-1] * len(self.next)
        for v in by_length:
            if self.length[v] >= window:
                up = self.link[v]
                self.window_state[v] = v if self.length[up] < window else self.window_state[up]
        self.items: dict[int, list[int]] = {}
        #: Of a state: items shorter than a window that it holds, by their length.
        self.short: dict[int, dict[int, list[int]]] = {}
        for key, ws in coded:
            v = 0
            for i, w in enumerate(ws):
                v = self.next[v][w]
                if i + 1 >= window and ((found := self.items.setdefault(self.window_state[v], [])) == [] or found[-1] != key):
                    found.append(key)  # in the order of items, an item may be there again
            if len(ws) < window:
                self.short.setdefault(v, {}).setdefault(len(ws), []).append(key)
        #: The nearest state on the way of suffix links, itself included, with such items.
        self.short_state = [-1] * len(self.next)
        for v in by_length:
            self.short_state[v] = v if v in self.short else self.short_state[self.link[v]] if v else -1

    def _extend(self, last: int, w: int) -> int:
        """Appends a word to the item that ends in state last. States grow by at most two a word."""
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(w)) is not None:
            if length[q] == length[last] + 1:
                return q
            return self._split(last, w, q)
        new = self._state({}, -1, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q for the strings that end here but are shorter than q's longest."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _state(self, nxt: dict[int, int], link: int, length: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def match(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of hit words (start, end; disjoint, in order) and the ids of the items that hit them."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        if len(ws) < self.shortest:
            return spans, found
        windows: set[tuple[int, int]] = set()  # states and lengths, so that a window's items are taken once however often it occurs
        known = self.word_ids.get
        ids = np.fromiter((known(w, -1) for w in ws), np.int64, len(ws))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= self.shortest:
                self._stream(ids[start:stop].tolist(), start, spans, windows)
        for v, n in windows:
            found.update(self.items.get(v, ()) if n == self.window else self.short[v][n])
        return merged(spans), found

    def _stream(self, run: list[int], at: int, spans: list[tuple[int, int]], windows: set[tuple[int, int]]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = matched = 0
        for i, w in enumerate(run, at):
            while (t := nxt[v].get(w)) is None and v:
                v = link[v]
                matched = length[v]
            if t is None:
                matched = 0
                continue
            v = t
            matched += 1
            longest = 0
            if matched >= window:
                longest = window
                windows.add((self.window_state[v], window))
            u = self.short_state[v]
            while u > 0:
                for n in self.short[u]:
                    if n <= matched:
                        longest = max(longest, n)
                        windows.add((u, n))
                u = self.short_state[link[u]]
            if longest:
                spans.append((i + 1 - longest, i + 1))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of spans and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode()


_FOUND = "struct<n_words:bigint,starts:array<int>,ends:array<int>,item_ids:array<bigint>>"
_TYPE = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("item_ids", pa.list_(pa.int64()))])


def _blocks(items: DataFrame, window: int, block_chars: int) -> Iterator[ItemAutomaton]:
    """Automata over the items, one block after the other: the driver holds the words of one at a time."""
    items = items.select("item_id", "text").filter("item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // block_chars) or 1
    if n == 1:
        yield _automaton(items, window)
        return
    path = shared_dir(items.sparkSession)
    items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")).write.partitionBy("block").parquet(path)
    placed = items.sparkSession.read.schema(f"{items.schema.simpleString()[7:-1].replace(':', ' ')}, block int").parquet(path)
    for k in range(n):
        yield _automaton(placed.filter(F.col("block") == k), window)
    delete(items.sparkSession, path)


def _automaton(items: DataFrame, window: int) -> ItemAutomaton:
    return ItemAutomaton([(r.item_id, words(r.text)) for r in items.sort("item_id", "text").collect()], window)


def _matches(shared: Broadcast) -> Column:
    """What the broadcast automaton finds in column text."""

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for x in texts:
            ws = words(x.as_py())
            spans, keys = shared.value.match(ws)
            rows.append({"n_words": len(ws), "starts": [a for a, _ in spans], "ends": [b for _, b in spans], "item_ids": sorted(keys)})
        return pa.array(rows, _TYPE)

    return found(F.col("text"))


def _united(n_words: pa.Array, starts: pa.Array, ends: pa.Array, item_ids: pa.Array) -> pa.Array:
    rows = []
    for n, a, b, keys in zip(n_words.to_pylist(), starts.to_pylist(), ends.to_pylist(), item_ids.to_pylist()):
        spans = merged([(x, y) for s, e in zip(a, b) for x, y in zip(s, e)])
        rows.append({"n_words": n, "starts": [x for x, _ in spans], "ends": [y for _, y in spans], "item_ids": sorted({k for ks in keys for k in ks})})
    return pa.array(rows, _TYPE)


def _cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    return pa.array([None if t is None else cut(t, list(zip(a, b))) for t, a, b in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist())], pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, coverage: tuple[int, int] = (1, 20), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Adds to every row of docs: n_words, n_hit, spans (word positions, end exclusive), item_ids
    (sorted), contaminated and clean_text.

    docs needs text; items needs item_id and text. contaminated: n_hit > 0 and
    n_hit / n_words >= coverage. clean_text is the text, without the hit spans if it is contaminated.
    A null or empty text has no words; an item without an id, a text or words takes no part; items
    with one id count once; repeated rows of docs are judged each on its own. Columns of docs with
    one of the added names are replaced, all others pass.
    """
    added = ["n_words", "n_hit", "spans", "item_ids", "contaminated", "clean_text"]
    docs = docs.drop(*(c for c in added if c != "text"))
    automata = _blocks(items, window, block_chars)
    first, second = next(automata), next(automata, None)
    if second is None:
        out = docs.withColumn("_found", _matches(broadcast(docs.sparkSession, first)))
    else:
        spark, key = docs.sparkSession, F.sha2("text", 256)
        texts = docs.select("text").filter("text <> ''")
        none = _matches(broadcast(spark, ItemAutomaton([], window)))
        parts = []
        for automaton in chain([first, second], automata):
            first = second = None
            shared = broadcast(spark, automaton)
            # by block, what it hits of any text, once for each text
            hits = texts.select(key.alias("_key"), _matches(shared).alias("_found")).filter("size(_found.item_ids) > 0")
            parts.append(written(hits.groupBy("_key").agg(F.first("_found").alias("_found"))))
            shared.destroy()
        every = reduce(DataFrame.unionByName, parts).groupBy("_key").agg(*(f("_found." + c).alias(c) for f, c in ((F.max, "n_words"), (F.collect_list, "starts"), (F.collect_list, "ends"), (F.collect_list, "item_ids"))))
        every = every.select("_key", F.arrow_udf(_united, _FOUND)("n_words", "starts", "ends", "item_ids").alias("_hits"))
        out = looked_up(docs.withColumn("_key", key), written(every), ["_key"]).withColumn("_found", F.coalesce("_hits", none)).drop("_key", "_hits")
    f = F.col("_found")
    hit = F.aggregate(F.zip_with(f.ends, f.starts, lambda b, a: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    out = out.withColumns({"n_words": f.n_words, "n_hit": hit, "spans": F.arrays_zip(f.starts.alias("start"), f.ends.alias("end")), "item_ids": f.item_ids})
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (coverage[1] * F.col("n_hit") >= coverage[0] * F.col("n_words")))
    return out.withColumn("clean_text", F.when(F.col("contaminated"), F.arrow_udf(_cut, "string")("text", f.starts, f.ends)).otherwise(F.col("text"))).drop("_found")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (ids sorted as strings, comma-joined), contaminated."""
    ids = F.sort_array(F.col("item_ids").cast("array<string>"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), "contaminated")


#: The same result in DuckDB's SQL, by joining all windows.
ORACLE = r"""
WITH it AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM it WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
wins AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hits AS (SELECT wins.doc_id, wins.i, wins.n, iw.item_id FROM wins JOIN iw ON wins.win = iw.win AND wins.n = iw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
"""
