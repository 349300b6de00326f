"""Spans of regular-expression matches as DataFrame expressions.

Offsets are in code points, end exclusive. Matches are the leftmost, non-overlapping
ones; patterns must not match the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name

#: Prefix sums are made in blocks of so many numbers, so that their cost stays near linear.
BLOCK = 512

#: How much of the text before and after a span is kept with it.
CONTEXT = 40


def _prefix(xs: Column) -> Column:
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out"))
    return F.aggregate(xs, start, step, lambda a: a["out"])


def before(xs: Column) -> Column:
    """For each number of an integer array, the sum of those before it."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / BLOCK).cast("int") - 1, F.lit(0))), lambda b: F.slice(xs, b * BLOCK + 1, BLOCK)
    )
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    shifted = F.zip_with(blocks, _prefix(sums), lambda b, s: F.transform(_prefix(b), lambda x: x + s))
    return F.flatten(shifted)


def with_matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``df`` with an array column of spans for each named pattern: start, end, value, ahead, after, behind. The text must not be null.

    A text's parts between matches and the matches themselves give all lengths, and
    their running sums the offsets. ``ahead`` is what stands before the span, CONTEXT
    characters at most and no further than the match before; ``after`` is the same behind the
    span, and ``behind`` its first character, empty at the end or where the next match begins.
    """
    gap = lambda g: F.struct(
        F.char_length(g).alias("n"), F.substring(g, -CONTEXT, CONTEXT).alias("ahead"), F.substring(g, 1, CONTEXT).alias("after")
    )
    for name, pattern in patterns.items():
        matches, gaps, starts = (free_name(df, f"{name}_{x}") for x in ("matches", "gaps", "starts"))
        df = df.withColumn(matches, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        parts = F.when(F.size(matches) > 0, F.split(text, pattern, -1)).otherwise(F.array(F.lit("")))
        df = df.withColumn(gaps, F.transform(parts, gap))
        both = F.zip_with(F.slice(gaps, 1, F.size(matches)), F.col(matches), lambda g, m: g["n"] + F.char_length(m))
        df = df.withColumn(starts, before(both))

        df = df.withColumn(name, _spans(gaps, matches, starts)).drop(matches, gaps, starts)
    return df


def _spans(gaps: str, matches: str, starts: str) -> Column:
    def span(at: Column, i: Column) -> Column:
        gap, match = F.get(gaps, i), F.get(matches, i)
        start = at + gap["n"]
        end = start + F.char_length(match)
        after = F.get(gaps, i + 1)["after"]
        behind = F.substring(after, 1, 1)
        return F.struct(start.alias("start"), end.alias("end"), match.alias("value"), gap["ahead"].alias("ahead"), after.alias("after"), behind.alias("behind"))

    return F.transform(starts, span)


def listed(kinds: dict[str, Column]) -> Column:
    """Spans of all kinds in one array by start, then by kind as listed: struct<start, rank, end, kind>."""

    def tagged(spans: Column, rank: int, kind: str) -> Column:
        own = [F.lit(rank).alias("rank"), F.lit(kind).alias("kind")]
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), own[0], s["end"].alias("end"), own[1]))

    return F.array_sort(F.concat(*[tagged(c, i, k) for i, (k, c) in enumerate(kinds.items())]))


def joined(spans: Column) -> Column:
    """kind:start:end of listed spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark) -> Column:
    """The text with listed spans replaced by ``mark(span)``; of overlapping spans the first counts, and the others' rest goes too."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        parts = F.when(fresh, F.concat(a["parts"], F.array(gap, mark(s)))).otherwise(a["parts"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), parts.alias("parts"))

    return F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.char_length(text))))
