"""Customer names: cleaning, segments, chains and the merge of near-equal names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import entity as E
from tidewheel.queries.base import Registry, table

#: Endings that make company-like names of parts' and customers' names.
ENDINGS = [" Inc", " LLC", " & Sons Co.", " c/o Bank", " Hospital", " Academy", " Plant, Ltd", " Hotel"]
NAME = "CASE WHEN p_partkey % 5 = 0 THEN 'The ' ELSE '' END || p_name || ' ' || p_type || " + " ".join(["CASE CAST(p_size AS INTEGER) % 8", *(f"WHEN {k} THEN '{e}'" for k, e in enumerate(ENDINGS)), "END"])


def names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.expr(NAME).alias("name"))


def _sql() -> str:
    b = lambda p: f"'(?i)\\b({p})\\b'"
    normal = f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(upper(stripped), '&', ' AND '), '+', ' AND '), '^THE ', ''), '\\b({E.COMPANY_WORDS})\\b', '', 'g'), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g'))"
    rules = [(p, s) for s, p in E.SEGMENTS]
    cases = [f"WHEN regexp_matches(lower(normal), '\\b({p})\\b') THEN '{s}'" for p, s in rules]
    cases.insert(1, f"WHEN regexp_matches(lower(normal), '\\b({E.SCHOOL})\\b') AND regexp_matches(lower(normal), '\\b({E.RELIGIOUS})\\b') THEN 'Private Schools'")
    return f"WITH n AS (SELECT p_partkey, {NAME} AS name FROM part), a AS (SELECT *, CASE WHEN regexp_matches(name, '(?i)\\s+(c/o|co)\\s+') THEN trim(regexp_extract(name, '(?i)^(.*?)\\s+(?:c/o|co)\\s+', 1)) ELSE name END AS stripped FROM n), c AS (SELECT *, {normal} AS normal FROM a) SELECT p_partkey, name, stripped, normal, CASE {' '.join(cases)} ELSE 'Other' END AS segment FROM c"


def register(reg: Registry) -> None:
    @reg.add(_sql())
    def names_cleaned(spark: SparkSession, d: str) -> DataFrame:
        """Cleaning steps and the segment of every name."""
        out = E.cleaned(names(spark, d), "name")
        return out.select("p_partkey", "name", "stripped", "normal", E.segment("normal").alias("segment"))

    @reg.add()
    def names_resolved(spark: SparkSession, d: str) -> DataFrame:
        """All steps, with the greedy merge; its matching-block ratio has no SQL form (tested against brute force)."""
        return E.resolved(names(spark, d), "p_partkey", "name")
