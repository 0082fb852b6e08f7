"""Chronology of a corpus: records, groups and bands from entries and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import tables, years
from quillspark.functions.arabic import normalize
from quillspark.operators import audit, chronology
from quillspark.operators.corpus import content_id


def note_arrays(footnotes: DataFrame, name: str = "footnotes") -> DataFrame:
    """page_id and its footnotes as array<struct<start,end>>."""
    span = F.struct(F.col("start_offset").cast("int").alias("start"), F.col("end_offset").cast("int").alias("end"))
    return footnotes.groupBy("page_id").agg(F.sort_array(F.collect_list(span)).alias(name))


def with_notes(pages: DataFrame, footnotes: DataFrame) -> DataFrame:
    return pages.join(note_arrays(footnotes), "page_id", "left").withColumn("footnotes", F.coalesce("footnotes", F.array().cast(tables.SPANS)))


def records(pages: DataFrame, entries: DataFrame, footnotes: DataFrame) -> DataFrame:
    """One row for each entry whose heading holds a name; names with two years or more lose theirs.

    An entry's text ends with the next heading on its page (W1). A page's entries are one array: its text moves once, to meet
    them, and is read once, and only pages that have a named entry are read.
    """
    head = F.struct(F.col("start_offset").cast("int").alias("start"), F.col("end_offset").cast("int").alias("head"), "entry_id", years.name_label(F.col("title")).alias("label"))
    own = entries.select("page_id", head.alias("e")).groupBy("page_id").agg(F.array_sort(F.collect_list("e")).alias("es"))
    own = own.where(F.exists("es", lambda e: e["label"].isNotNull()))
    rows = with_notes(pages.select("page_id", "text").join(own, "page_id"), footnotes)
    ended = F.transform("es", lambda e, i: e.withField("end", F.coalesce(F.get(F.col("es"), i + 1)["start"], F.length("text"))))
    rows = rows.withColumn("es", F.filter(ended, lambda e: e["label"].isNotNull()))
    spans = F.transform("es", lambda e: F.struct(e["start"].alias("start"), e["head"].alias("head"), e["end"].alias("end")))
    rows = rows.withColumn("items", tables.evidence("text", spans, "footnotes"))
    judged = F.transform("es", lambda e, i: e.withField("d", years.decide(F.filter("items", lambda x: x["entry"] == i))))
    told = F.transform(judged, lambda e: e.withField("quote", years.quoted(F.col("text"), e["d"])))
    got = rows.select("page_id", F.explode(told).alias("e"))
    got = got.select("e.entry_id", "page_id", F.col("e.label").alias("name_label"), F.col("e.d.year").alias("death_year"), F.col("e.d.status").alias("date_status"), F.col("e.d.start").alias("evidence_start"), F.col("e.d.end").alias("evidence_end"), F.col("e.quote").alias("evidence_quote"), F.col("e.d.kind").alias("evidence_kind"))
    return chronology.null_conflicts(got.withColumn("name_key", normalize(F.col("name_label"))), "name_key", "death_year", "date_status")


def groups(rows: DataFrame) -> DataFrame:
    """Provisional groups of one name and one year."""
    g = chronology.year_groups(rows, "name_key", "death_year", "name_label")
    return g.select(content_id(F.col("name_key"), F.col("death_year").cast("string")).alias("group_id"), "name_key", "death_year", F.col("label").alias("name_label"), "source_entries")


def years_table(found: DataFrame) -> DataFrame:
    """year, groups, source_entries: what the bands are made of."""
    return found.groupBy(F.col("death_year").alias("year")).agg(F.count(F.lit(1)).alias("groups"), F.sum("source_entries").alias("source_entries"))


def checks(rows: DataFrame, found: DataFrame, pages: DataFrame) -> DataFrame:
    """check, violations: bands and groups add up, quotes stand at their offsets."""
    dated = rows.where("death_year IS NOT NULL")
    years_ = years_table(found)
    totals = dated.agg(F.count(F.lit(1)).alias("n")).join(found.agg(F.coalesce(F.sum("source_entries"), F.lit(0)).alias("g"))).join(chronology.bins(years_, 30).agg(F.coalesce(F.sum("source_entries"), F.lit(0)).alias("b")))
    quotes = rows.where("evidence_quote IS NOT NULL").join(pages.select("page_id", "text"), "page_id")
    return audit.required(totals.where("n <> g OR n <> b"), "totals").unionAll(audit.required(audit.quote_mismatches(quotes, "text", "evidence_start", "evidence_end", "evidence_quote"), "evidence_quotes"))
