"""Customer names: cleaning, chains, segments and a greedy merge of near-equal names.

Cleaning and segments are column expressions. The merge never compares all names: two names that are
alike enough differ in few characters, so one of a few pieces of the longer one stands unchanged in
the other at nearly the same place (an exact filter). Names are then decided in rounds: a name is kept
once all earlier names like it have been merged away, and merged into the first kept one like it.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.sources.shared import shared_folder
from tidewheel.functions.semantics import ColumnLike, col
from tidewheel.operators.reshape import classified

# The words and patterns that names are cleaned and segmented by, in the order that they apply.
COMPANY_WORDS = r"LLC|INC|CO|CORP|L\.L\.C\.|INC\.|COMPANY|LIMITED|LTD|INCORPORATED|CORPORATION"
NOISE_WORDS = r"INC|LLC|COMPANY|CORP|LTD|LIMITED|INCORPORATED|THE"
CHAINS = {
    "ORANGETHEORY": "ORANGETHEORY FITNESS", "ORANGE THEORY": "ORANGETHEORY FITNESS", "FLAGSHIP": "FLAGSHIP HEALTHCARE PROPERTIES", "PERFECTION SERVICE": "PERFECTION SERVICES",
    "PROVIDENCE COMMERCIAL": "PROVIDENCE COMMERCIAL REAL ESTATE", "WALMART": "WALMART", "CINTAS": "CINTAS", "STARBUCKS": "STARBUCKS", "AMAZON": "AMAZON", "CVS": "CVS",
    "WALGREENS": "WALGREENS", "DOLLAR GENERAL": "DOLLAR GENERAL", "TARGET": "TARGET", "KROGER": "KROGER", "LOWES": "LOWES", "HOME DEPOT": "HOME DEPOT", "MCDONALDS": "MCDONALDS",
    "BURGER KING": "BURGER KING", "WENDYS": "WENDYS", "TACO BELL": "TACO BELL", "SUBWAY": "SUBWAY", "DOMINOS": "DOMINOS", "PIZZA HUT": "PIZZA HUT", "CHICK-FIL-A": "CHICK-FIL-A",
    "CHIPOTLE": "CHIPOTLE", "PANERA": "PANERA BREAD", "FEDEX": "FEDEX", "UPS": "UPS", "USPS": "US POSTAL SERVICE", "FIFTH THIRD": "FIFTH THIRD BANK", "PNC": "PNC BANK",
    "CHASE": "CHASE BANK", "HUNTINGTON": "HUNTINGTON BANK", "WELLTOWER": "WELLTOWER", "CUSHMAN": "CUSHMAN AND WAKEFIELD", "CBRE": "CBRE", "COLLIERS": "COLLIERS", "JLL": "JLL",
}
RELIGIOUS = r"church|temple|mosque|synagogue|ministry|baptist|catholic|methodist|lutheran|presbyterian|episcopal|god|saint|st\.|bible|christian|bishop|our lady|notre dame|sacred heart|holy|jesuit|bethlehem|trinity|immaculate|zion|covenant|grace|faith|christ|nazarene|apostolic|assembly of god|archdiocese"
SCHOOL = r"school|academy|prep|institute|university|college|seminary|education|learning|primary|elementary|middle school|high school|k-12|collegiate"
SEGMENTS = [
    ("Private Schools", r"academy|prep|university|college|seminary|collegiate"),
    ("Public Schools", r"isd|sch dist|public school|elementary|high school|middle school|school district|schools|city school|county school"),
    ("Religious", RELIGIOUS),
    ("Medical", r"hospital|clinic|health|medical|physician|doctor|dr\.|dental|dentist|surgery|veterinary|vet|healthcare|urgent care|care|dentures?|pharmacy|rehab|recovery|senior living|nursing|rehabilitation|amerimed|pathology|lab|laboratory"),
    ("Hospitality", r"hotel|inn|suites|resort|motel|lodge|aloft|marriott|hilton|holiday inn|staybridge|hampton|courtyard|residence inn|fairfield"),
    ("Municipal", r"city|county|dept|department|state of|fiscal court|jail|police|fire|library|municipal|govt|authority|township"),
    ("Data Center", r"data center|compute|hosting|server|cloud|colocation"),
    ("Industrial", r"mfg|manufacturing|industrial|plant|factory|works|production|packaging|steel|chemical|distributing|logistics|warehouse|engineering|tools|systems|construction|contractor|builders|auto|automotive|parts|metal|plastic|energy|machining|tool|trucking|cargo|freight|transport|shipping|supply chain|distribution"),
    ("Office", r"inc|llc|corp|co|company|group|associates|partners|bank|financial|insurance|realty|properties|law|firm|holding|services|management|solutions|partnership|llp"),
    ("Office", r"cbre|jll|colliers|cushman|wakefield|nai|avison young|foundry commercial|equity|prologis|duke realty"),
]
ALIKE = 0.95


def _word(pattern: str) -> str:
    return rf"(?U)\b({pattern})\b"


def without_care_of(name: ColumnLike) -> Column:
    """The name up to `C/O` or `CO` between spaces."""
    mark = r"(?isU)^(.*?)\s+(?:C/O|CO)\s+"
    return _once(col(name), lambda c: F.when(c.rlike(mark), F.trim(F.regexp_extract(c, mark, 1))).otherwise(c))


def normalised(name: ColumnLike) -> Column:
    """Upper case, & and + as AND, without a leading THE, company words and punctuation, single spaces."""
    c = F.replace(F.replace(F.upper(col(name)), F.lit("&"), F.lit(" AND ")), F.lit("+"), F.lit(" AND "))
    c = F.regexp_replace(c, "^THE ", "")
    c = F.regexp_replace(F.regexp_replace(c, _word(COMPANY_WORDS), ""), r"(?U)[^\w\s]", "")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _once(c: Column, of: Callable[[Column], Column]) -> Column:
    """of(c), with c evaluated once however often of uses it."""
    return F.get(F.transform(F.array(c), of), F.lit(0))


def chained(name: ColumnLike, chains: dict[str, str] = CHAINS) -> Column:
    """The chain's name if the name starts with one of the prefixes (the first that fits)."""
    if not chains:
        return col(name)
    rules = lambda c: classified(c, [(F.startswith(F.upper(c), F.lit(p)), m) for p, m in chains.items()])
    return _once(col(name), lambda c: F.coalesce(rules(c), c))


def segment(name: ColumnLike) -> Column:
    """The first segment whose words stand in the name; Other if none does."""

    def rules(c: Column) -> Column:
        has = lambda p: c.rlike(_word(p))
        bands = [(has(p), s) for s, p in SEGMENTS]
        bands.insert(1, (has(SCHOOL) & has(RELIGIOUS), "Private Schools"))
        return classified(c, bands, "Other")

    return _once(F.lower(col(name)), rules)


def comparison_key(name: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(col(name), _word(NOISE_WORDS), ""))


def cleaned(rows: DataFrame, name: str) -> DataFrame:
    """Adds stripped, normal (normalised) and master (after the chain rule)."""
    return rows.withColumn("stripped", without_care_of(name)).withColumn("normal", normalised("stripped")).withColumn("master", chained("normal"))


def alike_pairs(names: DataFrame) -> DataFrame:
    """(a, b) of distinct names, a before b by length and text, whose comparison keys are equal or more than ALIKE
    by matching blocks. names: column name, distinct."""
    keyed = names.filter("name <> ''").select("name", comparison_key("name").alias("key"))
    equal = keyed.select(F.col("name").alias("a"), "key").join(keyed.select(F.col("name").alias("b"), "key"), "key").select("a", "b")
    k = F.length("key")
    # more than 0.95 alike: fewer than 0.05 (m + n) characters unmatched, and m, n differ by fewer than that
    edits = F.floor(F.lit(0.0501) * 2 * k * F.lit(1.06)).cast("int") + 1
    pieces = edits + 1
    size = F.floor(k / pieces).cast("int")
    piece = F.posexplode(F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0)))).alias("i", "_i")
    cut = lambda i, n, s: F.substr(F.col("key"), i * s + 1, s)
    whole = keyed.filter(size > 0).withColumns({"n": k, "edits": edits, "pieces": pieces, "size": size})
    held = whole.select("name", "key", "n", "edits", "pieces", "size", piece).select("name", "key", "n", "edits", "size", (F.col("i") * F.col("size")).alias("at"), cut(F.col("i"), F.col("pieces"), F.col("size")).alias("part"))
    sizes = held.groupBy("size").agg(F.max("edits").alias("reach"))
    # pieces meet within bands of places, so that a piece which stands in many names at other places is no common key
    band = lambda place: F.floor(place / (2 * F.col("reach") + 1))
    held = held.join(F.broadcast(sizes), "size").withColumn("band", band(F.col("at"))).drop("reach")
    windows = keyed.withColumn("m", k).crossJoin(F.broadcast(sizes)).filter(F.col("m") >= F.col("size"))  # a row per piece size: a few
    starts = F.explode(F.sequence(F.lit(0), F.col("m") - F.col("size"))).alias("start")
    windows = windows.select(F.col("name").alias("other"), F.col("key").alias("other_key"), "m", "size", "reach", starts)
    bands = F.array_distinct(F.array(band(F.col("start") - F.col("reach")), band(F.col("start") + F.col("reach"))))
    windows = windows.select("other", "other_key", "m", "size", "start", F.explode(bands).alias("band"), F.substr(F.col("other_key"), F.col("start") + 1, F.col("size")).alias("part"))
    near = held.join(windows, ["size", "part", "band"]).filter((F.abs(F.col("start") - F.col("at")) <= F.col("edits")) & (F.abs(F.col("n") - F.col("m")) <= F.col("edits")) & (F.col("name") != F.col("other")))
    near = near.select(F.col("other").alias("a"), F.col("name").alias("b"), F.col("other_key").alias("ka"), F.col("key").alias("kb")).distinct()
    before = lambda x, y: (F.length(x) < F.length(y)) | ((F.length(x) == F.length(y)) & (F.col(x) < F.col(y)))
    near = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("kb").alias("ka"), F.col("ka").alias("kb"))).filter(before("a", "b")).distinct()

    @F.arrow_udf("boolean")
    def alike(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([difflib.SequenceMatcher(None, p, q).ratio() > ALIKE for p, q in zip(x.to_pylist(), y.to_pylist())])

    return near.filter(alike("ka", "kb")).select("a", "b").unionByName(equal.filter(before("a", "b"))).distinct()


def merged(names: DataFrame) -> DataFrame:
    """name, canonical for distinct names: in order of length and text each name that isn't merged yet is kept, and
    all later ones alike it are merged into it. Rounds of joins; each cuts its lineage by a checkpoint."""
    spark = names.sparkSession
    if not spark._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    pairs = alike_pairs(names).checkpoint()
    kept, gone = None, None
    left = pairs
    while True:
        # kept now: names with no earlier undecided name alike them, of those that still are in a pair
        first = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti").checkpoint()
        if first.isEmpty():
            break
        order = F.struct(F.length("a").alias("n"), F.col("a"))
        taken = left.join(first, "a").groupBy("b").agg(F.min(order).alias("_first")).select(F.col("b").alias("name"), F.col("_first.a").alias("canonical")).checkpoint()
        kept = first if kept is None else kept.unionByName(first)
        gone = taken if gone is None else gone.unionByName(taken)
        decided = taken.select("name").unionByName(first.select(F.col("a").alias("name")))
        left = left.join(decided.select(F.col("name").alias("a")), "a", "left_anti").join(decided.select(F.col("name").alias("b")), "b", "left_anti").select("a", "b").checkpoint()
    if gone is None:
        return names.select("name", F.col("name").alias("canonical"))
    return names.join(gone, "name", "left").select("name", F.coalesce("canonical", "name").alias("canonical"))


def resolved(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key, original, master (after all steps), segment and changes (what was applied), for every row."""
    clean = cleaned(rows.select(key, F.col(name).alias("original")), "original")
    canonical = merged(clean.select(F.col("master").alias("name")).filter("name is not null and name <> ''").distinct())
    out = clean.join(canonical, F.col("master") == F.col("name"), "left").withColumn("final", F.coalesce("canonical", "master"))
    upper = F.upper("original")
    stripped = (F.upper("stripped") != F.trim(upper)) & (F.contains(upper, F.lit("C/O")) | F.contains(upper, F.lit("CO ")))
    changes = F.concat_ws(", ", F.when(stripped, "C/O Strip"), F.when(F.col("master") != F.col("normal"), "Chain Rule"), F.when(F.col("final") != F.col("master"), "Fuzzy Merge"))
    return out.select(key, "original", F.col("final").alias("master"), segment("final").alias("segment"), changes.alias("changes"))
