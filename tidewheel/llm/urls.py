"""URL filters: host and path rules, and a path-template tree where no rule fits. DataFrame operations only.

Segments that look variable (digits, great length) become wildcards by themselves, which leaves few
templates per host. Level by level, down to the deepest, a branch of the host's tree stays a branch of
its own only if its labels differ from its siblings' (two-proportion z test with continuity correction,
so that few labels need no other bound); all other branches merge into the parent's wildcard. A merged template is rejected if its labelled
purity, smoothed towards the same template over all hosts and that towards the overall rate, reaches
the limit. Pages that a rule decides are the labels.

Pages are counted per (host, template) with partial aggregation before anything else is shuffled, and
the tree is built on those counts. Joins go by looked_up(): a template, host or branch that very many
rows share meets its row by a broadcast of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import ascii_lower, forget, looked_up, written

#: (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with its path.
Rules = list[tuple[str, str, str]]
#: The host that stands for all hosts together; no host holds a slash.
ALL_HOSTS = "/"
#: Characters of a segment beyond which it looks variable.
LONG = 24


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: then up to `?`, `#`
    or the end. A null url and one without `://` have neither."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: Rules) -> Column:
    """The longest fitting rule as struct(rule, verdict), of equally long ones the first; else null."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    if not ordered:
        return F.lit(None).cast("struct<rule:string,verdict:string,host:string,path:string>")
    table = F.array(*(F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in ordered))
    fits = lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"])
    return F.get(F.filter(table, fits), F.lit(0))


def template(path: Column) -> Column:
    """The path's segments with variable ones as `*`."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(r"\d") | (F.length(s) > LONG), "*").otherwise(s))


def _branching(rows: DataFrame, level: int) -> tuple[int | None, int | None]:
    """Of open rows from a level on: how many levels follow in which no parent has two children (None: there are none that have), and
    the last level's distance (None: no row goes as far). A row for each parent and level is all that is shuffled."""
    deep = rows.filter(F.col("open") & (F.size("template") >= level))
    parts = deep.select("host", F.slice("template", 1, level - 1).alias("prefix"), F.posexplode(F.slice("template", level, F.size("template"))).alias("at", "own"))
    ends = parts.groupBy("host", "prefix", "at").agg(F.min("own").alias("a"), F.max("own").alias("b"))
    return tuple(ends.agg(F.min(F.when(F.col("a") != F.col("b"), F.col("at"))), F.max("at")).first())


def tree(counts: DataFrame, z: float = 2.0) -> DataFrame:
    """host, first (the template as given), template (generalised) with its pages n and labels blocked, labelled.

    counts: host, first (array), n, blocked, labelled; one row per host and first.
    The levels end where no branch of any parent can pass the test. Levels in which every open parent has one child only,
    as in the depths of a crawler's trap, are passed at once: an only child becomes the wildcard, and what lets its
    parent go on or not does so below as well.
    """
    rows = written(counts.withColumn("template", F.col("first")).withColumn("open", F.lit(True)))
    level = 0
    while True:
        level += 1
        first, last = _branching(rows, level)
        if last is None:
            break
        passed = last + 1 if first is None else first
        if passed:
            stars = F.array_repeat(F.lit("*"), F.least(F.lit(passed), F.size("template") - (level - 1)))
            rest = F.slice("template", level + passed, F.greatest(F.size("template") - (level + passed - 1), F.lit(0)))
            only = F.concat(F.slice("template", 1, level - 1), stars, rest)
            before = rows
            rows = rows.withColumn("template", F.when(F.col("open") & (F.size("template") >= level), only).otherwise(F.col("template")))
            rows._tidewheel_path = before._tidewheel_path
            level += passed
            if first is None:
                break
        deep = F.col("open") & (F.size("template") >= level)
        prefix = F.slice("template", 1, level - 1)
        at = rows.filter(deep).withColumn("prefix", prefix).withColumn("own", F.element_at("template", level))
        sums = [F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
        child = written(at.groupBy("host", "prefix", "own").agg(*sums, F.count("*").alias("rows")))
        parent = child.groupBy("host", "prefix").agg(*(F.sum(c).alias(f"all_{c}") for c in ("blocked", "labelled", "rows")))
        rest = F.col("all_labelled") - F.col("labelled")
        pooled = F.try_divide("all_blocked", "all_labelled")
        apart = F.abs(F.try_divide("blocked", "labelled") - F.try_divide(F.col("all_blocked") - F.col("blocked"), rest))
        inverse = F.try_divide(F.lit(1.0), "labelled") + F.try_divide(F.lit(1.0), rest)
        stays = F.coalesce(apart - inverse / 2 > z * F.sqrt(pooled * (1 - pooled) * inverse), F.lit(False))
        # a parent of one row, of labels all alike or of z * z labels at most has no branch, nor has what is below it
        goes_on = (F.col("all_rows") > 1) & (F.col("all_blocked") > 0) & (F.col("all_blocked") < F.col("all_labelled")) & (F.col("all_labelled") > z * z)
        tested = written(looked_up(child, parent, ["host", "prefix"]).select("host", "prefix", "own", F.col("rows").alias("n"), (stays & goes_on).alias("stays"), goes_on.alias("goes_on")))
        merged = looked_up(at, tested.drop("n"), ["host", "prefix", "own"], tested.select("host", "prefix", "own", "n"))
        below = F.size("template") - level
        new = F.when(F.col("stays"), F.col("template")).when(F.col("goes_on"), F.concat("prefix", F.array(F.lit("*")), F.slice("template", level + 1, below))).otherwise(F.concat("prefix", F.array_repeat(F.lit("*"), below + 1)))
        out = merged.select("host", "first", "n", "blocked", "labelled", new.alias("template"), F.col("goes_on").alias("open"))
        before, rows = rows, written(out.unionByName(rows.filter(~deep).select(*out.columns)))
        forget(before)
        forget(tested)
        forget(child)
    whole = rows.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "blocked", "labelled")))
    out = written(looked_up(rows.select("host", "first", "template"), whole, ["host", "template"]))
    forget(rows)
    return out


def judge(pages: DataFrame, rules: Rules, key: str = "page_id", url: str = "url", limit: float = 0.5, weight: float = 4.0) -> DataFrame:
    """key, host, path, rule, verdict (allow or block), template, purity for every row of pages.

    purity is the smoothed share of blocked labels of the page's template; it decides where no rule
    fits, and is computed for all. Without any label it is 0. Repeated rows are judged alike; other
    columns of pages are left out.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_hit", matched(F.col("host"), F.col("path"), rules)).withColumn("first", template(F.col("path")))
    blocked, labelled = F.sum((F.col("_hit.verdict") == "block").cast("long")), F.count("_hit.verdict")
    counts = written(rows.groupBy("host", "first").agg(F.count("*").alias("n"), F.coalesce(blocked, F.lit(0)).alias("blocked"), labelled.alias("labelled")))
    pooled = counts.groupBy("first").agg(*(F.sum(c).alias(c) for c in ("n", "blocked", "labelled"))).select(F.lit(ALL_HOSTS).alias("host"), "first", "n", "blocked", "labelled")
    found = tree(counts.unionByName(pooled))
    total = counts.agg(F.sum("blocked"), F.sum("labelled")).first()
    rate = (total[0] or 0) / (total[1] or 1)
    smooth = lambda towards: (F.col("blocked") + weight * towards) / (F.col("labelled") + weight)
    anywhere = found.filter(F.col("host") == ALL_HOSTS).select("first", smooth(F.lit(float(rate))).alias("anywhere"))
    here = looked_up(found.filter(F.col("host") != ALL_HOSTS), anywhere, ["first"]).select("host", "first", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), smooth(F.col("anywhere")).alias("purity"))
    rows = looked_up(rows, here, ["host", "first"], counts.select("host", "first", "n"))
    own = F.when(F.col("purity") >= limit, "block").otherwise("allow")
    return rows.select(key, "host", "path", F.col("_hit.rule").alias("rule"), F.coalesce("_hit.verdict", own).alias("verdict"), "template", "purity")
