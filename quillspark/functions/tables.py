"""Text functions that need offsets of several patterns at once, as UDFs over a page, and as table functions for SQL.

One call reads one page with all of its regions or entries, in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import statements, years
from quillspark.sources import html_pages

SPANS = "array<struct<start:int,end:int>>"


def _pairs(x) -> list[tuple[int, int]]:
    return [(int(n["start"]), int(n["end"])) for n in (x if x is not None else [])]


class _Function:
    """A Python function as an Arrow UDF, made when it is first used: workers import this module without a session."""

    def __init__(self, f, returns: str):
        self.f, self.returns = f, returns

    def __call__(self, *columns):
        return F.udf(self.f, self.returns, useArrow=True)(*columns)


def _detect(text, regions, notes):
    return [] if text is None else statements.detect(text, _pairs(regions), _pairs(notes))


def _evidence(text, entries, notes):
    return [] if text is None else years.evidence(text, [(int(e["start"]), int(e["head"]), int(e["end"])) for e in entries], _pairs(notes))


def _parse_year(text):
    return None if text is None else tuple(years.parse_year(text))


def _page(html):
    if html is None:
        return None
    got = html_pages.parse(html.encode())
    return got["pages"][0]["text"], got["metadata"]["_html_title"], got["fallback"], len(got["pages"]), got["source_title"]


#: text, array<struct<start,end>> of regions, footnotes
detect = _Function(_detect, f"array<{statements.STATEMENT}>")
#: text, array<struct<start,head,end>> of entries, footnotes
evidence = _Function(_evidence, f"array<{years.ITEM}>")
parse_year = _Function(_parse_year, years.YEAR)
page = _Function(_page, "struct<text:string,title:string,fallback:boolean,pages:int,source_title:string>")


class _Statements:
    def eval(self, text: str):
        for s in _detect(text, [{"start": 0, "end": len(text or "")}], None):
            yield s[1:10]


class _Years:
    def eval(self, text: str):
        for _, year, status, kind, a, b in _evidence(text, [{"start": 0, "head": 0, "end": len(text or "")}], None):
            yield year, status, kind, a, b, text[a:b]


class _Pages:
    def eval(self, html: str):
        if html is not None:
            for p in html_pages.parse(html.encode())["pages"]:
                yield p["ordinal"], p["text"], p["part"], p["label"], p["raw_start"], p["raw_end"]


def register(spark: SparkSession) -> None:
    """SQL table functions, for LATERAL joins: quill_statements(text), quill_death_years(text), quill_pages(html); and the
    scalar quill_parse_year(fragment)."""
    said = "start int, end int, quote string, origin string, subject_status string, quote_scope string, attribution_text string, attribution_start int, attribution_end int"
    for name, made, schema in (
        ("quill_statements", _Statements, said),
        ("quill_death_years", _Years, "year int, status string, kind string, start int, end int, quote string"),
        ("quill_pages", _Pages, "ordinal int, text string, part string, label string, raw_start long, raw_end long"),
    ):
        spark.udtf.register(name, F.udtf(made, returnType=schema))
    spark.udf.register("quill_parse_year", F.udf(_parse_year, years.YEAR, useArrow=True))


def statements_of(pages: DataFrame, regions: str, notes: str, text: str = "text") -> DataFrame:
    """One row for each statement of a page's regions (T5): the page's other columns, the region's, and the statement's.

    regions: array<struct<start,end,...>>; their further fields come out as columns.
    """
    rest = [c for c in pages.columns if c not in (text, regions, notes)]
    more = [f.name for f in pages.schema[regions].dataType.elementType.fields if f.name not in ("start", "end")]
    spans = F.transform(regions, lambda r: F.struct(r["start"].cast("int").alias("start"), r["end"].cast("int").alias("end")))
    found = pages.select(*rest, regions, F.explode(detect(text, spans, notes)).alias("__s"))
    own = F.get(F.col(regions), F.col("__s.region"))
    return found.select(*rest, *[own[c].alias(c) for c in more], "__s.*").drop("region")
