"""Text expressions: proper case, trimming, a closed set of display formats, lenient conversion."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.semantics import ColumnLike, col

#: All characters that count as white space when a text is trimmed.
BLANKS = " \t\r\n   "


def trim_all(c: ColumnLike) -> Column:
    """Trims every kind of white space."""
    return F.btrim(col(c), F.lit(BLANKS))


def proper(c: ColumnLike) -> Column:
    """Proper case: a letter is upper case after anything that is no letter."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return F.array_join(F.transform(parts, F.initcap), "")


def proper_names(names: list[str]) -> list[str]:
    """Column names UPPER_SNAKE or camelCase as separate words in proper case."""
    out = []
    for n in names:
        spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", n.replace("_", " "))
        out.append(" ".join(w[:1].upper() + w[1:].lower() for w in spaced.split()))
    return out


def strip_prefix_word(c: ColumnLike, word: str) -> Column:
    """The text without a leading word, in any case."""
    return F.regexp_replace(col(c), rf"(?i)^\s*{re.escape(word)}\s+", "")


def first_filled(*cs: ColumnLike) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in cs))


def try_value(c: ColumnLike, kind: str) -> Column:
    """Conversion in which errors become null."""
    return F.col(c).try_cast(kind) if isinstance(c, str) else c.try_cast(kind)


#: The display formats that are supported, by pattern.
FORMATS = ("0", "0.0", "0.00", "#,0", "#,0.00", "$#,0", "$#,0.00", "0%", "0.0%", "0.00%", "MMM yyyy", "dd-MMM-yyyy", "MMM d, yyyy", "yyyy-MM-dd")


def fmt(c: ColumnLike, pattern: str, sign: ColumnLike | None = None) -> Column:
    """A number or date as display text, by one of FORMATS; a blank stays blank. sign: the value whose sign a $ format
    shows, in front of $0 too; without it the shown number's own, and zero has none."""
    if pattern not in FORMATS:
        raise ValueError(f"format {pattern!r} is none of {FORMATS}")
    x = col(c)
    if "y" in pattern:
        return F.date_format(x, pattern)
    places = len(pattern.partition(".")[2].rstrip("%"))
    value = F.round((x.cast("decimal(28,8)") * 100) if pattern.endswith("%") else x.cast("decimal(28,8)"), places)
    grouped = F.format_number(value, places) if "," in pattern else value.cast(f"decimal(28,{places})").cast("string")
    if pattern.startswith("$"):
        size = F.format_number(F.abs(value), places)
        grouped = F.concat(F.when((value if sign is None else col(sign)) < 0, "-").otherwise(""), F.lit("$"), size)
    return F.concat(grouped, F.lit("%")) if pattern.endswith("%") else grouped


def fmt_by_sign(c: ColumnLike, sections: str) -> Column:
    """A number as display text by up to three of FORMATS, for positive, negative and zero values, as in
    "$#,0;($#,0);0". A section may stand in parentheses; the negative one shows the size alone. Values without a section
    of their own use the first."""
    x, texts = col(c), []
    for k, section in enumerate(sections.split(";")):
        plain = section[1:-1] if section[:1] + section[-1:] == "()" else section
        shown = fmt(F.abs(x) if k == 1 else x, plain)
        texts.append(F.concat(F.lit("("), shown, F.lit(")")) if plain != section else shown)
    if len(texts) > 3:
        raise ValueError(f"{sections!r} has more than three sections")
    out = F.when(x < 0, texts[1] if len(texts) > 1 else texts[0])
    return out.when(x == 0, texts[2] if len(texts) > 2 else texts[0]).otherwise(texts[0])


def described(rows: DataFrame, formats: dict[str, str]) -> DataFrame:
    """rows whose columns carry their display format as metadata, under the name format; values stay as they are."""
    for name, sections in formats.items():
        rows = rows.withMetadata(name, {**rows.schema[name].metadata, "format": sections})
    return rows


def trend(change: ColumnLike, rising: str = "▲", falling: str = "▼", level: str = "▬") -> Column:
    """A glyph for the sign of a change, a figure space and its percentage; blank if it is blank."""
    x = col(change)
    return F.concat(F.when(x > 0, rising).when(x < 0, falling).otherwise(level), F.lit(" "), fmt(F.abs(x), "0.0%"))


def percent_encoded(c: ColumnLike) -> Column:
    """A text for use in a data URI: %, #, <, > and double quotes encoded."""
    x = col(c)
    for plain, code in (("%", "%25"), ("#", "%23"), ("<", "%3C"), (">", "%3E"), ('"', "%22")):
        x = F.replace(x, F.lit(plain), F.lit(code))
    return x
