"""Text expressions that the planner compiles: edges of words, matches with their offsets, running sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.arabic import SPACES

#: A character of a word: marks aren't one. White space in every sense.
WORD = r"[\p{L}\p{N}_]"
LEFT, RIGHT = f"(?<!{WORD})", f"(?!{WORD})"
SPACE = SPACES[:-1]

_CHUNK = 256


def bound(value: Column, use) -> Column:
    """use(value), with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(*terms: str) -> str:
    """A pattern for any of the terms as a whole word."""
    return f"{LEFT}(?:{'|'.join(terms)}){RIGHT}"


def has(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?s){pattern}")


def until(text: Column, pattern: str) -> Column:
    """The text before the first match, all of it if there is none."""
    return F.regexp_extract(text, rf"(?s)\A(.*?)(?:{pattern}|\z)", 1)


def strip(text: Column, chars: str = SPACE) -> Column:
    """Without characters of the class at both ends."""
    return F.regexp_replace(text, rf"\A{chars}+|{chars}+\z", "")


def slice_of(text: Column, start: Column, end: Column) -> Column:
    """Characters from start to end, counted from 0, the end exclusive."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def running(numbers: Column) -> Column:
    """Sums of an array's beginnings, each with its last number: in chunks, so that a long array costs little more than its length."""

    def sums(xs: Column, start: Column) -> Column:
        zero = F.array(start)
        return F.slice(F.aggregate(xs, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))), 2, F.size(xs))

    def chunked(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
        before = F.concat(F.array(F.lit(0).cast("long")), sums(totals, F.lit(0).cast("long")))
        return F.flatten(F.zip_with(chunks, F.slice(before, 1, F.size(chunks)), sums))

    def long_(xs: Column) -> Column:
        return bound(F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _CHUNK).cast("int")), lambda i: F.slice(xs, i * _CHUNK + 1, _CHUNK)), chunked)

    return bound(numbers, lambda xs: F.when(F.size(xs) <= _CHUNK, sums(xs, F.lit(0).cast("long"))).otherwise(long_(xs)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start,end,quote>> of a pattern's matches. Offsets are code points: sums of what stands before and of matches."""
    gaps = F.regexp_extract_all(text, F.lit(rf"(?s)\G(.*?)(?:{pattern})"), F.lit(1))  # \G: after the last match nothing is tried again

    def placed(hits: Column) -> Column:
        ends = running(F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("long")))
        return F.zip_with(ends, hits, lambda e, h: F.struct((e - F.length(h)).cast("int").alias("start"), e.cast("int").alias("end"), h.alias("quote")))

    return bound(F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(0)), placed)


def inside(spans: Column, at: Column) -> Column:
    """Whether a place lies in one of array<struct<start,end>>."""
    return F.exists(spans, lambda s: (s["start"] <= at) & (at < s["end"]))
