"""Excerpts, re-anchored quotes, highlight intervals and other small text functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.arabic import normalize
from quillspark.functions.lists import CHAIN_MARKS, DECOMPOSED_FROM, DECOMPOSED_TO
from quillspark.functions.native import bound, matches, running, slice_of

BEFORE, WIDTH, CONTEXT = 65, 340, 24
# Starts of headings that are a book's metadata, and of those on the first level.
META_HEADINGS = ("المؤلف", "الكتاب", "الناشر", "الطبعة", "القسم", "عدد الأجزاء")
FIRST_LEVEL = ("كتاب", "الكتاب")


def excerpt(text: Column, wanted: list[str], before: int = BEFORE, width: int = WIDTH) -> Column:
    """struct<text,start,end> of what is shown for a query's tokens: round the first word of the source that holds one of
    them, else the opening (F10). It looks at every word: apply it to a page of results."""
    tokens = F.array(*map(F.lit, wanted))
    hit = F.get(F.filter(matches(text, r"[^\s\p{Z}]+"), lambda m: F.arrays_overlap(F.regexp_extract_all(normalize(m["quote"]), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), tokens)), F.lit(0))
    start = F.greatest(F.lit(0), F.coalesce(hit["start"], F.lit(0)) - before)
    end = F.least(F.length(text), start + width)
    return F.struct(slice_of(text, start, end).alias("text"), start.alias("start"), end.alias("end"))


def places(text: Column, quote: Column) -> Column:
    """array<int>: where a quote stands, also where it overlaps itself."""
    # What stands before each occurrence, and its first character: the next one may begin inside it.
    escaped = F.concat(F.lit(r"(?s)\G(.*?)(?=\Q"), F.replace(quote, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)."))
    gaps = F.regexp_extract_all(text, escaped, F.lit(1))
    found = F.transform(running(F.transform(gaps, lambda g: (F.length(g) + 1).cast("long"))), lambda e: (e - 1).cast("int"))
    return F.when(F.length(quote) > 0, found).otherwise(F.array().cast("array<int>"))


def reanchor(text: Column, quote: Column, start: Column, before: Column, after: Column, context: int = CONTEXT) -> Column:
    """Where a stored quote begins now: at its offset, else at the one place with the same neighbourhood, else null."""
    n = F.length(quote)

    def alike(i: Column) -> Column:
        return (slice_of(text, F.greatest(i - context, F.lit(0)), i) == before) & (slice_of(text, i + n, i + n + context) == after)

    only = bound(F.filter(places(text, quote), alike), lambda same: F.when(F.size(same) == 1, F.get(same, F.lit(0))))
    return F.when(slice_of(text, start, start + n) == quote, start).otherwise(only)


def elementary_intervals(length: Column, ranges: Column) -> Column:
    """The pieces that overlapping highlights cut a text into: start, end and the numbers of the ranges over each.

    ranges: array of struct(start, end).
    """
    edges = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), length.cast("int")), F.transform(ranges, lambda r: r["start"].cast("int")), F.transform(ranges, lambda r: r["end"].cast("int")))))
    pieces = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    numbered = F.transform(ranges, lambda r, i: F.struct(i.alias("i"), r["start"].cast("int").alias("s"), r["end"].cast("int").alias("e")))
    return F.transform(pieces, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.transform(F.filter(numbered, lambda r: (r["s"] <= p["start"]) & (r["e"] >= p["end"])), lambda r: r["i"]).alias("over")))


def page_locator(text: Column) -> Column:
    """32-bit FNV-1a over UTF-16 units in base 36: the reader's page locator (F16)."""
    units = F.hex(F.encode(text, "UTF-16LE"))
    order = F.sequence(F.lit(0), F.greatest(F.floor(F.length(units) / 4).cast("int") - 1, F.lit(0)))
    value = lambda i: F.conv(F.concat(F.substring(units, i * 4 + 3, F.lit(2)), F.substring(units, i * 4 + 1, F.lit(2))), 16, 10).cast("long")
    mixed = F.aggregate(order, F.lit(2166136261).cast("long"), lambda h, i: (h.bitwiseXOR(value(i)) * 16777619).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(text.isNotNull(), F.lower(F.conv(F.when(F.length(text) > 0, mixed).otherwise(2166136261).cast("string"), 10, 36)))


def reader_fold(text: Column) -> Column:
    """The folding of searches inside a book: no marks, plain alef, yeh and heh, lower case."""
    plain = F.regexp_replace(F.translate(text, DECOMPOSED_FROM, DECOMPOSED_TO), CHAIN_MARKS, "")
    return F.lower(F.translate(plain, "ىة", "يه"))


def toc_level(title: Column) -> Column:
    """1 or 2 for a heading of a table of contents, null for one that isn't shown."""
    n, starts = F.length(title), lambda words: reduce(lambda a, b: a | b, (title.startswith(w) for w in words))
    return F.when((n > 4) & (n < 250) & ~starts(META_HEADINGS), F.when(starts(FIRST_LEVEL), 1).otherwise(2))


def clean_markup(text: Column) -> Column:
    """Common character entities decoded and white space collapsed."""
    t = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
