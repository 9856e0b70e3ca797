"""Text operators: tokens, spans with offsets, segments, gates, splices, keys. All but spans stay on the JVM side."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.arrow import flat_map


def tokens(text: Column) -> Column:
    """Words and runs of whitespace, in order; joined they give the text."""
    return F.regexp_extract_all(text, F.lit(r"(\s+|\S+)"), 1)


def title_body(text: Column) -> tuple[Column, Column]:
    """Split at the first newline, which stays with the body; without one the body is empty."""
    at = F.locate("\n", text)
    return F.substring_index(text, "\n", 1), F.when(at > 0, text.substr(at, F.length(text))).otherwise("")


def line_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Every line of the text with its place and offsets (code points): line_no (from 0), line, start, end (exclusive);
    the other columns stay. One pass over each text."""

    def lines(t):
        at = 0
        for i, line in enumerate((t or "").split("\n")):
            yield i, line, at, at + len(line)
            at += len(line) + 1

    return flat_map(df, [c for c in df.columns if c != text], [text], lines, "line_no int, line string, start int, end int")


def all_spans(df: DataFrame, text: str, pattern: str, group: int = 0, name: str = "found") -> DataFrame:
    """Every match of a pattern with the offsets of the whole match (code points): match_no (from 0), the group's text,
    start, end; the other columns stay. Spark's own functions give matches without places, and adding up the lengths
    before each match is quadratic in a text's matches; this is one pass over each text, in Arrow batches."""

    def matches(t, find=re.compile(pattern)):
        yield from ((i, m[group], m.start(), m.end()) for i, m in enumerate(find.finditer(t or "")))

    return flat_map(df, [c for c in df.columns if c != text], [text], matches, f"match_no int, {name} string, start int, end int")


def segments(lines: DataFrame, keys: list[str], is_start: Column, order: str = "line_no") -> DataFrame:
    """Numbers the segments that lines marked as starts begin; lines before the first are segment 0."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn("segment", F.sum(F.when(is_start, 1).otherwise(0)).over(w).cast("long"))


def is_title_case(line: Column) -> Column:
    """Short words aside, every word begins with a capital or a digit."""
    words = F.filter(F.split(line, " "), lambda w: F.length(w) > 3)
    return F.forall(words, lambda w: w.rlike("^[A-Z0-9]"))


# -- gates over ordered rows ------------------------------------------------------------------------------------


def gate(rows: DataFrame, keys: list[str], order: str, start: Column, stop: Column | None = None) -> DataFrame:
    """Rows from the first that starts the gate, up to (without) the first later one that stops it."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    out = rows.withColumn("_open", F.max(F.when(start, 1).otherwise(0)).over(w))
    if stop is None:
        return out.where("_open = 1").drop("_open")
    out = out.withColumn("_stop", F.max(F.when((F.col("_open") == 1) & stop & ~start, 1).otherwise(0)).over(w))
    return out.where("_open = 1 and _stop = 0").drop("_open", "_stop")


def next_but(rows: DataFrame, keys: list[str], order: str, skip: Column, value: str, name: str) -> DataFrame:
    """The value of the next row that is not skipped (the next marker, with stars and page breaks left out).

    Rows are gone through backwards, where a frame that only grows is kept as it is; forwards, every row's would be read anew."""
    w = W.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(F.when(~skip, F.col(value)), ignorenulls=True).over(w))


def missing_numbers(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Numbers between a row's and the one before it (from 0) that no row has."""
    before = F.coalesce(F.lag(number).over(W.partitionBy(*keys).orderBy(number)), F.lit(-1))
    gaps = rows.withColumn("_before", before).where(F.col(number) - F.col("_before") > 1)
    return gaps.select(*keys, F.explode(F.sequence(F.col("_before") + 1, F.col(number) - 1)).alias(f"missing_{number}"))


# -- splices and keys -------------------------------------------------------------------------------------------


def splice(text: Column, spans: Column) -> Column:
    """Replaces spans (array of struct(start, end, value), sorted, apart) in a text."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda a, s: F.struct(F.concat(a["out"], text.substr(a["at"] + 1, s["start"] - a["at"]), s["value"]).alias("out"), s["end"].cast("int").alias("at"))
    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], text.substr(a["at"] + 1, F.length(text))))


def splice_matches(df: DataFrame, text: str, pattern: str, value: str) -> DataFrame:
    """df's texts with every match of a pattern (Java's syntax) replaced by a value, taken as it is. A null text is an empty one."""
    as_is = value.replace("\\", "\\\\").replace("$", "\\$")
    return df.withColumn(text, F.regexp_replace(F.coalesce(text, F.lit("")), pattern, as_is))


def overlay(left: Column, right: Column) -> Column:
    """Array overlay: the right one's items where not null, else the left's; an empty right one gives the left."""
    return F.when(F.size(right) == 0, left).otherwise(F.transform(right, lambda x, i: F.coalesce(x, F.get(left, i))))


def between(low: Column, high: Column) -> Column:
    """Numbers strictly between two (a range that `through` names, without its ends)."""
    return F.when(high - low > 1, F.sequence(low + 1, high - 1)).otherwise(F.array().cast("array<bigint>"))


def replace_first(text: Column, sentence: Column) -> Column:
    """The first sentence replaced: up to the first period; a text without one is replaced whole. Periods of the new sentence go."""
    at = F.locate(".", text)
    new = F.replace(sentence, F.lit("."), F.lit(""))
    return F.when(at > 0, F.concat(new, text.substr(at, F.length(text)))).otherwise(new)


def classify_date(sentence: Column) -> Column:
    """comments, effective or other, in this order."""
    low = F.lower(sentence)
    return F.when(low.contains("comment"), "comments").when(low.contains("effective"), "effective").otherwise("other")


def trailing_date(sentence: Column) -> Column:
    """The last 'Month d, yyyy' at the end of a sentence."""
    found = F.regexp_extract(sentence, r"([A-Z][a-z]+ \d{1,2}, \d{4})[^\d]*$", 1)
    return F.when(found != "", F.to_date(found, "MMMM d, yyyy"))


def annual_edition(date: Column, title: Column) -> Column:
    """Year of the first annual edition that can hold a change of this date: titles up to 16 are issued on 1 January, up
    to 27 on 1 April, up to 41 on 1 July, others on 1 October."""
    month = F.when(title <= 16, 1).when(title <= 27, 4).when(title <= 41, 7).otherwise(10)
    issued = F.make_date(F.year(date), month, F.lit(1))
    return F.when(date > issued, F.year(date) + 1).otherwise(F.year(date))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
