"""Chat formatting of reply trees, with DataFrame operations only.

A reply tree is a table of nodes with parents. Self-joins that double their reach each time (parent,
grandparent, 4th, 8th ancestor ...) find each node's way to its root and add up the scores on it, in
about log2(depth) rounds of at most a row per node. The leaves are ranked within their conversation
by that sum, the nodes of the chosen paths are enumerated by the same tables, and each chosen path
becomes one formatted conversation. Each round's table is written to the shared folder.

The template marks a turn as START role newline text END. In roles and texts `\\`, `<` and `[` are
escaped, so neither a mark nor a control string of the <...> and [...] kinds can stand in them, and
unescaping gives the text back exactly. The loss mask has one entry for each turn's segment: the span
(start, length) in it that counts, or null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.shared import forget, written

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
_ESCAPES = [("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("\n", "\\3")]


def escape(c: Column, line: bool = False) -> Column:
    """No `<`, no `[`, and every backslash followed by a digit; with line, no line break either."""
    for plain, code in _ESCAPES if line else _ESCAPES[:3]:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, line: bool = False) -> Column:
    for plain, code in reversed(_ESCAPES if line else _ESCAPES[:3]):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def ways_up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(jumps, rooted). rooted: tree, node, score for the nodes that have a way to a root, score being the sum on it,
    both ends included. jumps[k]: tree, node, above for nodes with a 2**k-th ancestor.

    nodes has tree, node (unique in its tree), parent and score. A parent that is null, the node itself
    or not in the tree makes a root. Nodes that lead into a cycle have no way to a root.
    """
    own = nodes.select("tree", "node", "score", F.when(~F.col("parent").eqNullSafe(F.col("node")), F.col("parent")).alias("parent"))
    there = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    first = written(own.join(there, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("above"), "score"))
    done, open_ = first.filter("above is null"), first.filter("above is not null")
    jumps = []
    while True:
        ends = done.select("tree", F.col("node").alias("above"), F.lit(None).cast(open_.schema["above"].dataType).alias("top"), F.col("score").alias("more"))
        on = open_.select("tree", F.col("node").alias("above"), F.col("above").alias("top"), F.col("score").alias("more"))
        new = written(open_.join(on.unionByName(ends), ["tree", "above"]).select("tree", "node", F.col("top").alias("above"), (F.col("score") + F.col("more")).alias("score")))
        left, arrived = new.agg(F.count("above"), F.count_if(F.col("above").isNull())).first()
        if arrived:
            jumps.append(open_.drop("score"))
        # a node twice as far from its root as one that arrived now arrives next: if none did, the others lead into cycles
        if not arrived:
            forget(new)
            return jumps, done
        done, open_ = done.unionByName(new.filter("above is null")), new.filter("above is not null")
        if not left:
            return jumps, done


def path_nodes(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """tree, leaf, node, up for all nodes from each leaf (tree, leaf) to its root; up: steps from the leaf."""
    every = [leaves.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up"))]
    for k, jump in enumerate(jumps):
        so_far = reduce(DataFrame.unionByName, every)
        every.append(written(so_far.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))))
    return reduce(DataFrame.unionByName, every)


def format_trees(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The `branches` best root-to-leaf paths of every tree, each formatted as one conversation.

    nodes: tree, node, parent, role, text, score. A path's score is the sum of its nodes' (null: 0);
    ties go to the smaller leaf. Null roles and texts are empty. Of rows with one tree and node the
    smallest (by parent, role, text, score) counts; rows without a tree or a node are left out, and
    so are nodes that lead into a cycle. Returns tree, leaf, rank, score, segments (one per turn, root
    first), loss_spans (for each segment the start and length of an assistant's text, else null) and
    formatted, the segments joined. Other columns of nodes are left out.
    """
    rest = F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = written(nodes.filter("tree is not null and node is not null").groupBy("tree", "node").agg(F.min(rest).alias("_rest")).select("tree", "node", "_rest.*"))
    jumps, rooted = ways_up(nodes)
    leaves = rooted.withColumnRenamed("node", "leaf")
    if jumps:
        leaves = leaves.join(jumps[0].select("tree", F.col("above").alias("leaf")), ["tree", "leaf"], "left_anti")
    best = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    chosen = written(leaves.withColumn("rank", best).filter(F.col("rank") <= branches))
    on_path = path_nodes(chosen, jumps)
    segment = F.concat(F.lit(START), escape(F.col("role"), line=True), F.lit("\n"), escape(F.col("text")), F.lit(END))
    body = F.when(F.col("role") == LEARNED, F.char_length(escape(F.col("text"))))
    turns = nodes.select("tree", "node", segment.alias("segment"), body.alias("learned"), (F.char_length(escape(F.col("role"), line=True)) + len(START) + 2).alias("start"))
    rows = on_path.join(chosen, ["tree", "leaf"]).join(turns, ["tree", "node"])
    turn = F.struct((-F.col("up")).alias("at"), "segment", "learned", "start")
    out = rows.groupBy("tree", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform("turns", lambda t: F.when(t["learned"].isNotNull(), F.struct(t["start"].alias("start"), t["learned"].alias("length"))))
    out = out.select("tree", "leaf", "rank", "score", F.col("turns.segment").alias("segments"), spans.alias("loss_spans"))
    return out.withColumn("formatted", F.array_join("segments", ""))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.char_length(role) + 2, F.char_length(part) - F.char_length(role) - 1 - len(END))
        return F.struct(unescape(role, line=True).alias("role"), unescape(text).alias("text"))

    return F.transform(_parts(formatted), turn)


def _parts(formatted: Column) -> Column:
    """What follows each START."""
    parts = F.split(formatted, r"<\|im_start\|>")
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def learned(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = lambda part, s: F.when(s.isNotNull(), unescape(F.substr(part, s["start"] - len(START), s["length"])))
    return F.array_join(F.zip_with(_parts(formatted), spans, under), "")


def chained(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as trees without branches: each turn replies to the one before.

    Turns of one number are ordered by role and text, a null number comes first. A null conv_id is a
    conversation of its own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted output."""
    rows = rows.select("tree", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"))
    rows = rows.withColumn("loss", learned(F.col("formatted"), F.col("loss_spans")))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        F.expr("try_cast(tree AS bigint)").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: The same result in DuckDB's SQL.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(24 + length(role) + 2 * length(text) - length(translate(text, '\<[', ''))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
