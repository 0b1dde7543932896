"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix and written in another order.

Cuts stand between units (characters, words or lines). A unit begins where a predicate of two
adjacent bytes holds, so a text's bytes are taken in chunks that overlap by one byte, each chunk's
unit starts are counted on their own, and the running sums of these counts tell which chunk owns
the cut of a given rank: only the two owning chunks are scanned again for the cuts' bytes.

One pass, no shuffle: Python gets the texts and gives back five numbers; texts are cut, joined and
digested by SQL functions. Where cuts fall depends on the id alone, so a repeated run gives the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import ship

#: Bytes of a chunk.
CHUNK = 4096
#: Bytes of texts that are looked at together; a longer text is looked at on its own.
SLICE = 4 << 20
#: Marks of the parts; a text that contains one isn't transformed.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, those that are transformed, and of 100 transformed ones, those written suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Whether a unit begins at a byte, by it and the byte before (a text's first unit begins with the text).
STARTS: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "char": lambda before, at: (at & 0xC0) != 0x80,
    "word": lambda before, at: _SPACE[before] & ~_SPACE[at],
    "line": lambda before, at: before == 10,
}


def _flags(data: np.ndarray, start: int, end: int, firsts: np.ndarray, unit: str) -> np.ndarray:
    """Unit starts of data[start:end], of which firsts are the first bytes of texts."""
    before = np.empty(end - start, np.uint8)
    before[1:] = data[start : end - 1]
    before[0] = data[start - 1] if start else 10
    out = STARTS[unit](before, data[start:end])
    out[firsts[(firsts >= start) & (firsts < end)] - start] = True
    return out


def cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, draws: np.ndarray, unit: str = "char", chunk: int = CHUNK) -> np.ndarray:
    """For the texts data[starts[k]:ends[k]] (one after the other, none empty) and two draws for each: how many units a
    text has, the ranks draw % (n + 1) of its cuts (the smaller first), and the bytes before each cut."""
    parts = -(-(ends - starts) // chunk)
    text_of = np.repeat(np.arange(len(starts)), parts)
    first_chunk = np.cumsum(parts) - parts
    at = starts[text_of] + (np.arange(len(text_of)) - first_chunk[text_of]) * chunk
    counted = np.add.reduceat(_flags(data, int(starts[0]), int(ends[-1]), starts, unit), at - starts[0], dtype=np.int64)
    upto = np.concatenate(([0], np.cumsum(counted)))
    before = upto[first_chunk]  # units of the texts before
    n = upto[first_chunk + parts] - before
    ranks = np.sort(draws % (n + 1)[:, None], axis=1)
    out = np.empty((len(starts), 5), np.int64)
    out[:, 0], out[:, 1:3] = n, ranks
    for side in (0, 1):
        wanted = before + ranks[:, side]
        owner = np.searchsorted(upto, wanted, "right") - 1  # the chunk in which the unit after the cut begins
        for k in range(len(starts)):
            if ranks[k, side] == n[k]:
                out[k, 3 + side] = ends[k] - starts[k]
                continue
            lo = int(at[owner[k]])
            hi = min(lo + chunk, int(ends[k]))
            found = np.flatnonzero(_flags(data, lo, hi, starts[k : k + 1], unit))
            out[k, 3 + side] = lo + found[wanted[k] - upto[owner[k]]] - starts[k]
    return out


_FOUND = "struct<n:bigint,low:bigint,high:bigint,low_byte:bigint,high_byte:bigint>"
_FIELDS = ["n", "low", "high", "low_byte", "high_byte"]


def _cuts_of(unit: str) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    def found(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        draws = np.stack([h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)], axis=1).astype(np.int64)
        out = np.zeros((len(texts), 5), np.int64)
        filled = np.flatnonzero(np.diff(bounds) > 0)
        at = 0
        while at < len(filled):
            stop = max(at + 1, int(np.searchsorted(bounds[filled + 1], bounds[filled[at]] + SLICE, "right")))
            rows = filled[at:stop]
            first = int(bounds[rows[0]])
            out[rows] = cuts(raw[first : int(bounds[rows[-1] + 1])], bounds[rows] - first, bounds[rows + 1] - first, draws[rows], unit)
            at = stop
        return pa.StructArray.from_arrays([pa.array(out[:, k]) for k in range(5)], _FIELDS)

    return found


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Adds to every row of docs: n (units of the text), form (plain, psm or spm), prefix_units and middle_units (null if
    plain) and output.

    h1 to h4 are the first four groups of eight hex digits of the sha256 of `1:` and the key (a null key counts as an
    empty text): the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger.
    A text is plain if it is empty, contains a mark or h3 % 100 >= transformed, else spm if h4 % 100 < suffix_first,
    else psm. Null texts count as empty. Words begin after white space (space, tab to carriage return), lines after
    \\n; what stands before the first word belongs to it. Rows stand alone: repeated rows give equal results. Columns
    with one of the added names are replaced (the key and the text are read before), all others pass.
    """
    ship(docs.sparkSession)
    added = ["n", "form", "prefix_units", "middle_units", "output"]
    mine = docs.withColumns({"_text": F.coalesce(F.col(text).cast("string"), F.lit("")), "_hash": F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)})
    h = lambda k: F.conv(F.substring("_hash", 8 * k - 7, 8), 16, 10).cast("bigint")
    mine = mine.withColumns({"_cut": F.arrow_udf(_cuts_of(unit), _FOUND)("_text", h(1), h(2))})
    marked = reduce(lambda a, b: a | b, (F.contains("_text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)))
    plain = (F.col("_text") == "") | marked | (h(3) % 100 >= transformed)
    form = F.when(plain, "plain").when(h(4) % 100 < suffix_first, "spm").otherwise("psm")
    mine = mine.withColumn("_form", form)
    c, raw = F.col("_cut"), F.col("_text").cast("binary")
    bit = lambda start, size: F.substring(raw, start.cast("int"), size.cast("int")).cast("string")
    prefix, middle, suffix = bit(F.lit(1), c.low_byte), bit(c.low_byte + 1, c.high_byte - c.low_byte), bit(c.high_byte + 1, F.octet_length("_text") - c.high_byte)
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    output = F.when(F.col("_form") == "plain", F.col("_text")).when(F.col("_form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    cut = F.col("_form") != "plain"
    new = {"n": c.n, "form": F.col("_form"), "prefix_units": F.when(cut, c.low), "middle_units": F.when(cut, c.high - c.low), "output": output}
    return mine.select(*(F.col(x) for x in docs.columns if x not in added), *(v.alias(k) for k, v in new.items()))


def restored(output: Column, form: Column) -> Column:
    """The text that transform() has made an output of: the marks stand in the output only where it has put them."""
    parts = F.split(output, "<[PSM]>", -1)
    prefix, suffix = F.when(form == "spm", parts[2]).otherwise(parts[1]), F.when(form == "spm", parts[1]).otherwise(parts[2])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of transform()'s rows by characters."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


#: The same result in DuckDB's SQL. The restored text is the input, as the transformation loses nothing.
ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
f AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM r),
c AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""
