"""From files to the corpus tables: texts, spans, entries, mentions, passages, citations.

Every id is made of content: a page of its file and place, an entry of its page and start. A text is stored once, however
many pages hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import headings
from quillspark.functions.arabic import normalize
from quillspark.operators import corpus
from quillspark.operators.corpus import content_id
from quillspark.sources import archives


def _notes() -> F.Column:
    own = F.filter("spans", lambda s: s["kind"] == "footnote")
    return F.transform(own, lambda s: F.struct(s["start_offset"].alias("start"), s["end_offset"].alias("end")))


def texts(pages: DataFrame) -> DataFrame:
    """text_sha256, text, char_count: each distinct text once."""
    return pages.select("text_sha256", "text").dropDuplicates(["text_sha256"]).withColumn("char_count", F.length("text"))


def spans(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.explode("spans").alias("s")).select("page_id", "s.*")


def footnotes(pages: DataFrame) -> DataFrame:
    return spans(pages).where("kind = 'footnote'").select("page_id", "start_offset", "end_offset")


def entries(pages: DataFrame) -> DataFrame:
    """entry_id, page_id, start_offset, end_offset, title, search_title, kind: what may head an entry (T1). Title pages have none."""
    body = pages.where(~F.col("is_metadata"))
    found = body.select("page_id", F.explode(headings.candidates(F.col("text"), F.col("titles"), F.col("number_starts"), _notes())).alias("c"))
    key = content_id(F.col("page_id"), F.col("c.start").cast("string"))
    return found.select(key.alias("entry_id"), "page_id", F.col("c.start").alias("start_offset"), F.col("c.end").alias("end_offset"), "c.title", normalize(F.col("c.title")).alias("search_title"), "c.kind")


def mentions(pages: DataFrame, heads: DataFrame) -> DataFrame:
    """page_id, entry_id, kind, trigger, start_offset, end_offset, in_footnote, evidence, status: relationship words.

    Each belongs to the latest entry at or before it on its page, one in a footnote to none (J12): entries of a page meet
    its mentions as one sorted array.
    """
    own = heads.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("start_offset", "entry_id"))).alias("heads"))
    evidence = F.transform(headings.mentions(F.col("text"), _notes()), lambda m: m.withField("evidence", F.substring(F.col("text"), m["start"] + 1, m["end"] - m["start"])))
    found = pages.select("page_id", F.explode(evidence).alias("m")).join(own, "page_id", "left")
    last = F.element_at(F.filter("heads", lambda h: h["start_offset"] <= F.col("m.start")), -1)
    owner = F.when(~F.col("m.in_footnote") & (F.size(F.filter("heads", lambda h: h["start_offset"] <= F.col("m.start"))) > 0), last["entry_id"])
    return found.select("page_id", owner.alias("entry_id"), "m.kind", "m.trigger", F.col("m.start").alias("start_offset"), F.col("m.end").alias("end_offset"), "m.in_footnote", "m.evidence", F.lit("unresolved_mention").alias("status"))


def passages(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Locations of passages in stored texts, and each distinct passage with its first location."""
    where = corpus.passages(stored, "text_sha256", "text")
    first = F.min(F.struct("text_sha256", "start_offset", "end_offset", "passage")).alias("f")
    once = where.groupBy(F.col("sha256").alias("passage_id")).agg(first)
    return where.select(F.col("sha256").alias("passage_id"), "text_sha256", "start_offset", "end_offset"), once.select("passage_id", F.sha2(normalize(F.col("f.passage")), 256).alias("normalized_sha256"), "f.text_sha256", "f.start_offset", "f.end_offset")


def citations(pages: DataFrame, files: DataFrame, books: DataFrame) -> DataFrame:
    """What a page is cited by: book, edition, volume, printed number, file (J1). Files and books are few beside pages."""
    f = files.select(F.col("id").alias("source_id"), "archive_id", "archive_name", "zip_path", "raw_sha256")
    own = pages.select("page_id", "text_sha256", "source_id", "book_id", "zip_index", "ordinal", F.col("label").alias("printed_label"), "part", "raw_start", "raw_end")
    return own.join(f, "source_id").join(books.select("book_id", "title", "author", "edition", "publisher", "category", "source_group"), "book_id")


def build(files: DataFrame) -> dict[str, DataFrame]:
    """All corpus tables of parsed files (archives.read_files)."""
    pages, books = archives.pages(files), archives.books(files)
    stored = texts(pages)
    heads = entries(pages)
    where, once = passages(stored)
    return {
        "archives": archives.archive_table(files),
        "files": files.drop("pages"),
        "books": books,
        "pages": pages,
        "texts": stored,
        "spans": spans(pages),
        "footnotes": footnotes(pages),
        "entries": heads,
        "mentions": mentions(pages, heads),
        "passage_locations": where,
        "passages": once,
        "citations": citations(pages, files, books),
    }
