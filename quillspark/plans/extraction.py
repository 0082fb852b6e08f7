"""Biography regions across pages, statements with their owners, roll-ups and audits.

Inputs are tables in the shape of the corpus: pages (page_id, source_id, book_id, ordinal, text), entries (entry_id,
page_id, start_offset, end_offset, name_label or null), footnotes (page_id, start_offset, end_offset). Every recorded
heading closes the region before it; only one with a name label opens a new owner; owners never cross a source file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions import tables
from quillspark.functions.arabic import normalize
from quillspark.functions.statements import classify, clean_label
from quillspark.operators import audit
from quillspark.plans.chronicle import with_notes


def regions(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, source_id, start_offset, end_offset, biography_id, role of all non-empty regions.

    Pages carry the last heading before them by one window over page rows; texts aren't part of it.
    """
    sized = pages.select("page_id", "source_id", "ordinal", F.length("text").alias("__n"))
    on_page = entries.groupBy("page_id").agg(F.min("start_offset").alias("__first"), F.max_by(F.struct(F.when(F.col("name_label").isNotNull(), F.col("entry_id")).alias("o")), "start_offset").alias("__last"))
    before = W.partitionBy("source_id").orderBy("ordinal").rowsBetween(W.unboundedPreceding, -1)
    joined = sized.join(on_page, "page_id", "left").withColumn("__owner", F.last("__last", ignorenulls=True).over(before)["o"])
    head = joined.select("page_id", "source_id", F.lit(0).alias("start_offset"), F.coalesce("__first", "__n").alias("end_offset"), F.col("__owner").alias("biography_id"), F.when(F.col("__owner").isNotNull(), "continuation").otherwise("unassigned").alias("role"))
    following = F.lead("start_offset").over(W.partitionBy("page_id").orderBy("start_offset"))
    own = entries.withColumn("__next", following).join(sized, "page_id")
    named = F.col("name_label").isNotNull()
    opened = own.select("page_id", "source_id", F.col("start_offset").cast("int").alias("start_offset"), F.coalesce("__next", "__n").cast("int").alias("end_offset"), F.when(named, F.col("entry_id")).alias("biography_id"), F.when(named, "opening").otherwise("unassigned").alias("role"))
    return head.unionByName(opened).where("end_offset > start_offset")


def segments(found: DataFrame) -> DataFrame:
    """Regions that belong to a biography."""
    return found.where(F.col("biography_id").isNotNull()).select("biography_id", "page_id", "source_id", "start_offset", "end_offset", "role")


def openings(pages: DataFrame, entries: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each labelled entry, with boundary status and class."""
    order = W.partitionBy("source_id").orderBy("ordinal", "start_offset")
    placed = entries.join(pages.select("page_id", "source_id", "book_id", "ordinal"), "page_id")
    placed = placed.withColumn("boundary_status", F.when(F.lead("entry_id").over(order).isNotNull(), "next_recorded_heading").otherwise("source_file_end_unresolved"))
    bios = placed.where(F.col("name_label").isNotNull()).withColumnRenamed("entry_id", "biography_id").drop("end_offset").withColumnRenamed("start_offset", "heading_start")
    ends = entries.select(F.col("entry_id").alias("biography_id"), F.col("end_offset").alias("heading_end"))
    opening = found.where("role = 'opening'").select("biography_id", F.col("end_offset").alias("__b"))
    bios = bios.join(ends, "biography_id").join(opening, "biography_id").join(pages.select("page_id", "text"), "page_id")
    kind = classify(F.col("text"), F.col("heading_start"), F.col("__b"), F.col("heading_end"))
    label = clean_label(F.col("name_label"))
    return bios.select("biography_id", label.alias("name_label"), normalize(label).alias("name_key"), F.col("page_id").alias("opening_page_id"), "source_id", "book_id", "heading_start", "heading_end", kind.alias("classification"), "boundary_status")


def biographies(pages: DataFrame, entries: DataFrame, found: DataFrame, statements: DataFrame) -> DataFrame:
    """The openings with roll-ups of their segments and statements."""
    bios = openings(pages, entries, found)
    sizes = segments(found).groupBy("biography_id").agg(F.count(F.lit(1)).alias("segment_count"), F.sum(F.col("end_offset") - F.col("start_offset")).cast("long").alias("char_count"))
    said = statements.where(F.col("biography_id").isNotNull()).groupBy("biography_id").agg(F.count(F.lit(1)).alias("statement_count"))
    return bios.join(sizes, "biography_id", "left").join(said, "biography_id", "left").na.fill(0, ["segment_count", "char_count", "statement_count"])


def statements(pages: DataFrame, found: DataFrame, footnotes: DataFrame) -> DataFrame:
    """Statements of all regions; statement_id is content-addressed, text_sha256 shares equal quotes.

    A page's regions are one array: its text moves once, and is read once.
    """
    own = found.groupBy("page_id", "source_id").agg(F.sort_array(F.collect_list(F.struct(F.col("start_offset").alias("start"), F.col("end_offset").alias("end"), "biography_id"))).alias("regions"))
    rows = with_notes(own.join(pages.select("page_id", "book_id", "text"), "page_id"), footnotes)
    got = tables.statements_of(rows, "regions", "footnotes")
    status = F.when(F.col("biography_id").isNotNull(), F.col("subject_status")).when(F.col("origin") == "footnote", "editorial_context_unresolved").otherwise("unassigned_source_context")
    key = F.sha2(F.concat_ws(":", "page_id", F.col("start").cast("string"), F.col("end").cast("string"), "origin"), 256)
    return got.withColumn("subject_status", status).withColumn("statement_id", key).withColumn("text_sha256", F.sha2("quote", 256))


def triggers(said: DataFrame) -> DataFrame:
    """statement_id, kind, start, end, quote of every trigger."""
    return said.select("statement_id", F.explode("triggers").alias("t")).select("statement_id", "t.*").distinct()


def trigger_counts(said: DataFrame) -> DataFrame:
    """Statements with a trigger of each kind."""
    return triggers(said).groupBy("kind").agg(F.countDistinct("statement_id").alias("statements"))


def checks(pages: DataFrame, entries: DataFrame, footnotes: DataFrame, found: DataFrame, said: DataFrame, bios: DataFrame | None = None) -> DataFrame:
    """check, violations: all must be zero (E28). With biographies, their boundaries and their number are checked, too."""
    text = pages.select("page_id", "text")
    seg = segments(found)
    spans = said.select("page_id", "biography_id", "origin", F.col("start").alias("start_offset"), F.col("end").alias("end_offset"))
    owned = spans.where(F.col("biography_id").isNotNull()).withColumn("k", F.concat_ws("|", "page_id", "biography_id"))
    heads = entries.select("page_id", F.col("start_offset").alias("at"))
    t = triggers(said).alias("t").join(said.select("statement_id", "page_id", F.col("start").alias("s"), F.col("end").alias("e")), "statement_id").join(text, "page_id")
    bad = {
        "quote_mismatches": audit.quote_mismatches(said.join(text, "page_id"), "text", "start", "end", "quote"),
        "trigger_mismatches": audit.quote_mismatches(t, "text", "start", "end", "quote").unionByName(t.where("start < s OR end > e")),
        "attribution_mismatches": audit.quote_mismatches(said.where(F.col("attribution_text").isNotNull()).join(text, "page_id"), "text", "attribution_start", "attribution_end", "attribution_text"),
        "bad_segments": seg.join(text, "page_id").where("start_offset < 0 OR end_offset > length(text)"),
        "wrong_biography_owner": audit.uncontained(owned, seg.withColumn("k", F.concat_ws("|", "page_id", "biography_id")), "k"),
        "headings_crossed": audit.crossed(seg, heads, "page_id"),
        "footnote_layer_errors": audit.uncontained(spans.where("origin = 'footnote'"), footnotes, "page_id").select("page_id").unionByName(audit.overlapping(spans.where("origin = 'main_text'"), footnotes, "page_id").select("page_id")),
    }
    if bios is not None:
        bad["pending_boundaries"] = bios.where("boundary_status IS NULL OR boundary_status NOT IN ('next_recorded_heading', 'source_file_end_unresolved')")
        bad["missing_candidates"] = audit.difference(entries.where("name_label IS NOT NULL").select("entry_id"), bios.select(F.col("biography_id").alias("entry_id")))
    out = None
    for name, rows in bad.items():
        one = audit.required(rows, name)
        out = one if out is None else out.unionAll(one)
    return out
