"""N-gram Jaccard join: documents whose sets of five-word shingles are 80 % alike, and their groups.

The join is a blocked sparse product of the document by shingle incidence matrix. Three things keep
it from becoming quadratic.

Equal sets are one row of the matrix (a class, represented by its smallest id), so exact copies
cost nothing. The first product uses only each row's prefix: in one global order of shingles, rows
of n shingles that are 80 % alike share one among the first n - ceil(0.8 n) + 1, and at the first that they
share the smaller row has passed n / 9 at most. The order puts the frequent shingles last; as any common order is
valid, it is enough to count what prefixes by hash hold. Overlaps accumulated over prefixes discard pairs that cannot
reach the size-derived bound. Of a shingle with more than SPARSE rows a spanning forest passes of the pairs that their whole
sets' parities don't rule out: else shingles that unrelated rows share by chance, whose number grows faster than the
input, would tie most rows into one component. One with more than DENSE rows gives a star of candidate edges, and a
frequent one that no row may begin a match with gives none.

The candidate edges' components are the blocks of the second product, over whole sets, which passes
on a spanning forest of the links. A component of more than BLOCK shingles or ROWS rows is cut into
bands of sizes, of which only neighbours meet, and these into parts, so a task compares at most ROWS
with ROWS rows. Within a task pairs come from prefixes again, those of rows already united are
skipped, and the overlaps of the others are counted exactly. A long text of few shingles goes there as
its set, so a task's bytes are bounded by its rows and shingles whatever the texts repeat.

Shingles are 64-bit hashes. Links are transitive in the result: every linked document is in its
group, though copies and pairs within a group are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.llm.shared import broadcast, forget, held, looked_up, ship, sieve_places, written

WORDS = 5
#: Rows that a shingle may have for its pairs to be listed one by one.
SPARSE = 16
#: Rows that a shingle may have for their parities to be compared, and about how many bytes of parities a task takes.
DENSE, PARITIES = 1 << 12, 1 << 23
#: Frequent shingles that are put last, at most; the broadcast list has 8 bytes for each.
FREQUENT = 1 << 19
#: Shingles, and rows, in a block of the second product.
BLOCK, ROWS = 1_000_000, 1 << 14
#: Bytes of a text that goes to the second product as it is, whatever its set is; a longer one must be this many times its
#: set's number of shingles at most, else the set goes.
LONG, PER_SHINGLE = 1 << 14, 16
#: Sizes in a band differ by this factor: more than 1.25, so that alike rows are in one band or in neighbours.
BAND = 1.26
#: Parts that a frequent shingle's rows are dealt out to.
SALT = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that words are hashed of at a time.
SLICE = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random number for each byte at each place of a word; a word's hash is their sum.
_RANDOM = np.random.default_rng(20_240_601).integers(0, 1 << 64, (64, 256), np.uint64)


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space) of raw, and where they start."""
    b = np.frombuffer(raw, np.uint8)
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    at = np.flatnonzero(inside)
    place = at - np.repeat(starts, lengths)
    value = _RANDOM[place & 63, b[at]]
    if lengths.max() > 64:
        value = value * (2 * (place >> 6) + 1).astype(np.uint64)
    h = np.add.reduceat(value, np.cumsum(lengths) - lengths)
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29)), starts


def _slices(raw: bytes) -> Iterator[bytes]:
    """raw in pieces of about SLICE bytes, cut at spaces or line breaks."""
    at = 0
    while len(raw) - at > 2 * SLICE:
        cut = max(raw.find(b" ", at + SLICE), raw.find(b"\n", at + SLICE, at + 2 * SLICE))
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each whole text its set of five-word shingles, as sorted 64-bit hashes. Words are runs without ASCII
    white space, A-Z lower-cased; fewer than five words are one shingle; no word, none."""
    raws = ((t or "").encode().lower() for t in texts)
    following = next(raws, None)
    while following is not None:
        part, size = [following], len(following)
        while (following := next(raws, None)) is not None and size + len(following) <= SLICE:
            part.append(following)
            size += len(following)
        if size <= 2 * SLICE:
            h, at = _word_hashes(b"\n".join(part))
            ends = np.searchsorted(at, np.cumsum([len(p) + 1 for p in part])).tolist()
        else:  # one long text: a part of several has SLICE bytes at most
            found = [_word_hashes(x)[0] for x in _slices(part[0])]
            h, ends = np.concatenate(found), [sum(map(len, found))]
        n = max(len(h) - WORDS + 1, 0)
        x = np.full(n, WORDS, np.uint64)
        for k in range(WORDS):
            x = (x ^ h[k : k + n]) * _MIX
            x ^= x >> np.uint64(29)
        a = 0
        for b in ends:
            if b - a >= WORDS:
                s = np.sort(x[a : b - WORDS + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                few = np.array([b - a], np.uint64)
                for k in range(a, b):
                    few = (few ^ h[k]) * _MIX
                    few ^= few >> np.uint64(29)
                yield few
            else:
                yield np.empty(0, np.uint64)
            a = b


def prefix_length(n: int) -> int:
    """How many first shingles of n must hold one that is shared with any 80 % alike set."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def parity(s: np.ndarray) -> bytes:
    """For each of 64 * 2**k places, whether an odd number of the set's hashes fall on it; 0.7 places for each hash at least.

    Two sets differ in no fewer shingles than their parities do in places, and a parity's halves give, one xor the other,
    that of half the places.
    """
    places = 64
    while 10 * places < 7 * len(s):
        places *= 2
    return np.packbits(np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1).tobytes()


def near(ids: np.ndarray, n: np.ndarray, parities: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that may be 80 % alike by their sizes n and parities."""
    order = np.lexsort((ids, n))
    ids, n, parities = ids[order], n[order], [parities[i] for i in order.tolist()]
    width = np.fromiter(map(len, parities), np.int64, len(ids))  # grows with n
    fitting = np.searchsorted(4 * n, 5 * n, side="right")  # behind the last row that isn't too large for each
    united, out = _Union(len(ids)), []
    for w in np.unique(width).tolist():
        lo, mid, top = np.searchsorted(width, w), np.searchsorted(width, w, "right"), np.searchsorted(width, 2 * w, "right")
        own = np.frombuffer(b"".join(parities[lo:mid]), np.uint64).reshape(mid - lo, w // 8)
        wider = np.frombuffer(b"".join(parities[mid:top]), np.uint64).reshape(top - mid, 2, w // 8)
        table = np.concatenate((own, wider[:, 0] ^ wider[:, 1]))
        for a in range(lo, mid):
            b = a + 1 + np.flatnonzero(united.group[a + 1 : fitting[a]] != united.group[a])
            differing = np.bitwise_count(table[b - lo] ^ table[a - lo]).sum(1, dtype=np.int64)
            for c in b[9 * differing <= n[a] + n[b]].tolist():
                if united.join(a, c):
                    out.append((int(ids[a]), int(ids[c])))
    return out


def _frequent(docs: DataFrame, least: int) -> np.ndarray:
    """Shingles that more than `least` documents have in the prefix they would have by hashes alone, sorted.

    Counted over all documents: by each task for what it reads, then over tasks. If they are more
    than FREQUENT, those from that eighth of a power of two on which leaves FREQUENT at most.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def counts() -> pa.RecordBatch:
            u, c = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c.astype(np.int32))], ["shingle", "n"])

        for b in batches:
            for at in range(0, len(b), 256):
                for s in shingle_sets(b.column(0)[at : at + 256].to_pylist()):
                    waiting.append(s[: prefix_length(len(s))].copy())
                    size += len(waiting[-1])
                if size > 500_000:
                    yield counts()
                    waiting, size = [], 0
        if waiting:
            yield counts()
        pa.default_memory_pool().release_unused()

    ship(docs.sparkSession)
    found = written(docs.select("text").mapInArrow(counted, "shingle bigint, n int").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") > least))
    step = F.floor(8 * F.log2("n")).cast("int")
    histogram = sorted(((r.step, r["count"]) for r in found.groupBy(step.alias("step")).count().collect()), reverse=True)  # 8 * 63 rows at most
    kept, total = None, 0
    for at, n in histogram:
        total += n
        if total > FREQUENT:
            break
        kept = at
    out = np.empty(0, np.uint64)
    if kept is not None:
        out = np.sort(found.filter(step >= kept).select("shingle").toArrow().column(0).to_numpy().view(np.uint64))
    forget(found)
    return out


def _sketches(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, n, set_hash and parity (of the whole set), prefix (shingles) and n_late, how many of these are frequent."""
    shared = broadcast(docs.sparkSession, frequent)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                sizes, keys, parities, prefixes, lates = [], [], [], [], []
                for s in shingle_sets(part.column(1).to_pylist()):
                    sizes.append(len(s))
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    parities.append(parity(s) if len(s) else None)
                    p = prefix_length(len(s))
                    if len(late):
                        where = np.searchsorted(late, s)
                        where[where == len(late)] = 0
                        last = late[where] == s
                        first = s[~last][:p]
                        s = np.concatenate((first, s[last][: p - len(first)]))
                        lates.append(len(s) - len(first))
                    else:
                        s = s[:p]
                        lates.append(0)
                    prefixes.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()), pa.array(parities, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(lates, pa.int32())], ["doc_id", "n", "set_hash", "parity", "prefix", "n_late"])
            pa.default_memory_pool().release_unused()

    return written(docs.select("doc_id", "text").mapInArrow(sketched, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n int, set_hash binary, parity binary, prefix array<bigint>, n_late int"))


def _candidates(prefixed: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) such that rows 80 % alike are in one component, and the written table that they are made of, besides
    rows; prefixed: rep, n, prefix, n_late, a class each, rows: rep, parity."""
    at = F.posexplode("prefix").alias("pos", "shingle")
    dealt = prefixed.select("rep", "n", "n_late", (F.size("prefix") - F.col("n_late")).alias("early"), at)
    late, begins = F.col("pos") >= F.col("early"), 9 * F.col("pos") <= F.col("n")
    # one number holds n, n_late and whether a match with a row of this size or more may begin here
    packed = F.col("n") + F.shiftleft(F.col("n_late").cast("long"), 31) + F.shiftleft(begins.cast("long"), 62)
    dealt = dealt.select("shingle", F.when(late, F.pmod(F.xxhash64("rep"), F.lit(SALT)) + 1).otherwise(0).cast("int").alias("salt"), "rep", packed.alias("packed"))
    # one shuffle by shingle serves the counts, the join with them and the pairs
    dealt = dealt.repartition("shingle", "salt")
    counts = dealt.groupBy("shingle", "salt").agg(F.count("*").alias("m"), F.min("rep").alias("first"), F.max("packed").alias("most"))
    begun = counts.filter((F.col("salt") > 0) & (F.col("most") >= 1 << 62)).select("shingle").distinct()  # FREQUENT rows at most
    several = counts.filter("m > 1 and salt = 0").drop("most").unionByName(counts.filter("salt > 0").drop("most").join(F.broadcast(begun), "shingle", "left_semi"))
    shared = written(dealt.join(several, ["shingle", "salt"]))
    n = lambda c: F.col(c).bitwiseAND((1 << 31) - 1)
    n_late = lambda c: F.shiftright(c, 31).bitwiseAND((1 << 31) - 1)
    sizes = [n("packed").alias("n"), n_late("packed").alias("late")]
    sparse = shared.filter(f"salt = 0 and m <= {SPARSE}").select("shingle", "rep", *sizes)
    other = sparse.select("shingle", F.col("rep").alias("other"), F.col("n").alias("n2"), F.col("late").alias("late2"))
    alike = (F.col("rep") < F.col("other")) & (5 * F.least("n", "n2") >= 4 * F.greatest("n", "n2"))
    pairs = sparse.join(other, "shingle").filter(alike).groupBy("rep", "n", "late", "other", "n2", "late2").agg(F.count("*").alias("overlap"))
    # what is shared but not in both prefixes lies behind the prefix of one of the two; frequent ones may be shared too
    behind = lambda n: F.floor((4 * F.col(n) + 4) / 5) - 1
    pairs = pairs.filter(9 * (F.col("overlap") + F.least("late", "late2") + F.greatest(behind("n"), behind("n2"))) >= 4 * (F.col("n") + F.col("n2")))
    middle = shared.filter(f"salt = 0 and m > {SPARSE} and m <= {DENSE}").select("shingle", "rep", n("packed").alias("n"))
    size = middle.agg(F.coalesce(F.sum(F.col("n").cast("long") + 256), F.lit(0))).first()[0] // 4  # a parity has n / 4 bytes at most, or 8

    def nears(t: pa.Table) -> pa.Table:
        t = t.sort_by("shingle")
        ids, sizes, parities = t.column("rep").to_numpy(), t.column("n").to_numpy(), t.column("parity").to_pylist()
        cuts = np.flatnonzero(np.diff(t.column("shingle").to_numpy())) + 1
        found = [e for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]) for e in near(ids[i:j], sizes[i:j], parities[i:j])]
        return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    task = F.pmod(F.xxhash64("shingle"), F.lit(1 + size // PARITIES)).alias("task")
    forests = middle.join(rows.select("rep", "parity"), "rep").select(task, "shingle", "rep", F.col("n").cast("long").alias("n"), "parity").groupBy("task").applyInArrow(nears, "a bigint, b bigint").distinct()
    dense = shared.filter(f"salt > 0 or m > {DENSE}")
    stars = dense.groupBy(F.col("first").alias("a"), F.col("rep").alias("b")).agg(F.lit(1)).select("a", "b")
    firsts = dense.filter("salt > 0").groupBy("shingle", "first").agg(F.lit(1)).groupBy("shingle").agg(F.min("first").alias("least"))
    joined = dense.filter("salt > 0").groupBy("shingle", F.col("first").alias("b")).agg(F.lit(1)).join(firsts, "shingle").select(F.col("least").alias("a"), "b")
    edges = pairs.select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(forests).unionByName(stars).unionByName(joined.distinct())
    return edges.filter("a <> b"), shared


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, text, set of the documents whose id is a rep of wanted, and of a few others: a bitmap of hashes picks them, so
    that not all texts are shuffled. Either text or set is null. The join with wanted is up to the caller."""

    place, shared = sieve_places(wanted, "rep")

    @F.arrow_udf("struct<wanted:boolean,set:array<bigint>>")
    def looked_at(places: pa.Array, texts: pa.Array) -> pa.Array:
        there = held(shared.value, places)
        sets: list[np.ndarray | None] = []
        for x, ok in zip(texts, there.tolist()):
            (s,) = shingle_sets([x.as_py()]) if ok and x.is_valid else (None,)
            sets.append(None if s is None or len(x.as_buffer()) <= PER_SHINGLE * len(s) else s.view(np.int64))
        return pa.StructArray.from_arrays([pa.array(there), pa.array(sets, pa.list_(pa.int64()))], ["wanted", "set"])

    looked_at = looked_at.asNondeterministic()  # else it is evaluated for the filter and once more for its set
    own, long = F.col("doc_id").cast("bigint"), F.when(F.octet_length("text") > LONG, F.col("text"))  # no other text goes to Python
    found = docs.filter("doc_id is not null").select(own.alias("rep"), "text", looked_at(place(own), long).alias("_at")).filter("_at.wanted")
    return found.select("rep", F.when(F.col("_at.set").isNull(), F.col("text")).alias("text"), F.col("_at.set").alias("set"))


class _Union:
    """Disjoint groups of 0..k-1; group[i] is i's group, kept up to date (the smaller one is renamed)."""

    def __init__(self, k: int):
        self.group = np.arange(k)
        self.members = [[i] for i in range(k)]

    def join(self, i: int, j: int) -> bool:
        a, b = int(self.group[i]), int(self.group[j])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.group[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []
        return True


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of each."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def overlaps(ids: np.ndarray, sides: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """The block's product: a spanning forest of the pairs (of different sides, unless all are 0) that are 80 % alike.

    Rows, by size, look for smaller ones in the postings of prefixes, in the order of the block's own frequencies.
    """
    k = len(ids)
    by_size = np.argsort(sizes, kind="stable")
    ids, sides, n = ids[by_size], sides[by_size], sizes[by_size]
    flat = flat[_ranges((np.cumsum(sizes) - sizes)[by_size], n)]
    owner, offsets = np.repeat(np.arange(k), n), np.cumsum(n) - n
    _, column, width = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((column, width[column], owner))
    column, place = column[order], np.arange(len(flat)) - np.repeat(offsets, n)
    shared = width[column] > 1
    entry = np.flatnonzero(shared & (9 * place <= n[owner]))  # where a match with a row of this size or more may begin
    key = column[entry] * k + owner[entry]
    sort = np.argsort(key, kind="stable")
    key, row_of, place_of = key[sort], owner[entry[sort]], place[entry[sort]]
    probe = np.flatnonzero(shared & (place <= n[owner] - (4 * n[owner] + 4) // 5))
    least = np.searchsorted(5 * n, 4 * n)  # the first row that isn't too small for each
    start = np.searchsorted(key, column[probe] * k + least[owner[probe]])
    length = np.searchsorted(key, column[probe] * k + owner[probe]) - start
    probe, start, length = probe[length > 0], start[length > 0], length[length > 0]
    bounds = np.searchsorted(owner[probe], np.arange(k + 1))
    united, out = _Union(k), []
    here, seen = np.zeros(len(width), bool), np.full(k, -1)
    both = bool(sides.any())
    for a in np.flatnonzero(np.diff(bounds)).tolist():
        lo, hi = bounds[a], bounds[a + 1]
        at = _ranges(start[lo:hi], length[lo:hi])
        passed = np.repeat(place[probe[lo:hi]], length[lo:hi])
        own = column[offsets[a] : offsets[a] + n[a]]
        here[own] = True
        some = 64
        while len(at):
            part, passed_a, at, passed = at[:some], passed[:some], at[some:], passed[some:]
            b = row_of[part]
            fits = (united.group[b] != united.group[a]) & (seen[b] != a) & (9 * np.minimum(n[a] - passed_a, n[b] - place_of[part]) >= 4 * (n[a] + n[b]))
            if both:
                fits &= sides[b] != sides[a]
            b = np.unique(b[fits])
            linked = b[:0]
            if len(b):
                seen[b] = a
                m = n[b]
                overlap = np.add.reduceat(here[column[_ranges(offsets[b], m)]].astype(np.int64), np.cumsum(m) - m)
                linked = b[9 * overlap >= 4 * (n[a] + m)]
            for c in linked.tolist():
                if united.join(a, c):
                    out.append((int(ids[a]), int(ids[c])))
            if len(linked) and len(at):
                open_ = united.group[row_of[at]] != united.group[a]
                at, passed = at[open_], passed[open_]
            some = min(2 * some, 4096)
        here[own] = False
    return out


def _placed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rep, block, band, next, i, j, side: the tasks of the second product that each row takes part in."""
    members = groups.join(rows.select(F.col("rep").alias("node"), "n"), "node").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / np.log(BAND)).cast("int"))
    bands = written(members.groupBy("root", "band").agg(F.sum("n").alias("total"), F.count("*").alias("rows")))
    whole, count = bands.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    small = F.pmod(F.xxhash64("root"), F.lit(max(1, 2 * whole // BLOCK, 2 * count // ROWS)))
    parts = F.ceil(F.greatest(F.col("total") / BLOCK, F.col("rows") / ROWS)).cast("int")
    large = bands.groupBy("root").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"), F.map_from_entries(F.collect_list(F.struct("band", parts))).alias("parts"))
    large = large.filter((F.col("total") > BLOCK) | (F.col("rows") > ROWS)).select("root", "parts")  # some 60 bands at most each
    out = members.join(large, "root", "left")
    of = lambda step: F.coalesce(F.try_element_at("parts", F.col("band") + step), F.lit(0))
    own = F.pmod(F.xxhash64("node"), F.greatest(of(0), F.lit(1))).cast("int")
    out = out.withColumns({"own": own, "parts_0": of(0), "parts_1": of(1), "parts_2": of(-1)})
    me, band = F.col("own"), F.col("band")

    def tasks(count: str, task) -> F.Column:
        numbers = F.filter(F.sequence(F.lit(0), F.col(count)), lambda o: o < F.col(count))
        return F.transform(numbers, lambda o: F.struct(*(c.cast("int").alias(name) for c, name in zip(task(o), ("band", "next", "i", "j", "side")))))

    same = tasks("parts_0", lambda o: (band, band, F.least(me, o), F.greatest(me, o), (me > o)))
    up = tasks("parts_1", lambda o: (band, band + 1, me, o, F.lit(0)))
    down = tasks("parts_2", lambda o: (band - 1, band, o, me, F.lit(1)))
    alone = F.array(F.struct(*(F.lit(0).alias(name) for name in ("band", "next", "i", "j", "side"))))
    is_large = F.col("parts").isNotNull()
    out = out.select(F.col("node").alias("rep"), F.when(is_large, F.col("root")).otherwise(small).alias("block"), is_large.alias("large"), F.explode(F.when(is_large, F.concat(same, up, down)).otherwise(alone)).alias("task"))
    return out.select("rep", "block", "large", "task.*")


def _links(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges (a, b) of a spanning forest of all links, as a written table; groups: node, root of the candidate components."""
    placed = written(_placed(rows, groups))

    def product(t: pa.Table) -> pa.Table:
        texts, sets = t.column("text").to_pylist(), [None if x is None else np.array(x, np.int64).view(np.uint64) for x in t.column("set").to_pylist()]
        hashed = shingle_sets([x for x, s in zip(texts, sets) if s is None])
        sets = [next(hashed) if s is None else s for s in sets]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))  # none is empty
        found = overlaps(t.column("rep").to_numpy(), t.column("side").to_numpy(), np.concatenate(sets), sizes)
        return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    texts = _texts(docs, placed.select("rep").distinct())
    out = written(placed.join(texts, "rep").groupBy("block", "large", "band", "next", "i", "j").applyInArrow(product, "a bigint, b bigint"))
    forget(placed)
    return out


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id: integer; text).

    component_id is the smallest doc_id that the row reaches by links, itself included. Null and
    empty texts have no shingles and no link; a row without a doc_id takes its class's group if
    another row has that text, else null. Repeated ids are taken as rows of one document: their
    texts' groups are joined. Other columns of docs are left out.
    """
    docs = docs.select("doc_id", "text")
    sketches = _sketches(docs, _frequent(docs, SPARSE))
    filled = sketches.filter("n > 0")
    classes = filled.groupBy("set_hash").agg(F.min("doc_id").cast("bigint").alias("rep"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("prefix").alias("prefix"), F.first("n_late").alias("n_late"), F.count("*").alias("copies"))
    prefixed = written(classes.filter("rep is not null"))
    # the prefixes, most of what is written here, go as soon as they have been used
    kept = written(sketches.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "set_hash"))
    forget(sketches)
    rows = written(prefixed.select("set_hash", "rep", "n", "copies", "parity"))
    edges, shared = _candidates(prefixed, rows)
    forget(prefixed)
    candidates = components(edges)
    forget(shared)
    links = _links(docs, rows, candidates)
    roots = components(links)
    forget(links)
    named = written(rows.select("set_hash", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("set_hash", F.coalesce("root", "rep").alias("component_id")))
    own = F.col("doc_id").cast("bigint")
    # a text with very many copies meets its group by a broadcast
    grouped = looked_up(kept.filter("n_shingles > 0"), named, ["set_hash"], rows.select("set_hash", F.col("copies").alias("n")))
    out = grouped.select("doc_id", "n_shingles", F.coalesce("component_id", own).alias("component_id"))
    return out.unionByName(kept.filter("n_shingles = 0").select("doc_id", "n_shingles", own.alias("component_id")))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that represent their group: those whose doc_id is its smallest, and rows without a doc_id.
    All columns pass."""
    kept = groups(docs).filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))


#: The same result in DuckDB's SQL, by counting all shared shingles.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT o.a, o.b FROM o JOIN n x ON o.a = x.doc_id JOIN n y ON o.b = y.doc_id WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id, doc_id AS node FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.node = e.a),
c AS (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""
