"""Read-only queries of the served API, as functions that return DataFrames (2.13).

The corpus is a dict of tables: those of corpus.build(), and biographies, segments, statements, records (chronology),
identities, entry_identity, claims, date_summary, neighbors, observations. Arguments are validated and clamped here; unknown
ids give empty results. Searches read a stored index of the table where one is given (search.store of its normalized text),
else they scan. Results come by BM25, which a scan computes as the index does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.arabic import fold, normalize
from quillspark.functions.native import slice_of
from quillspark.functions.passages import excerpt
from quillspark.operators import chronology as years
from quillspark.operators import search as fts
from quillspark.operators.corpus import page
from quillspark.operators.sequence import neighbours

ORIGINS = ("main_text", "footnote")
KINDS = ("birth", "death", "teachers", "students", "assessment", "alias", "family", "cross_reference")
RELATIONS = ("teacher", "student")
#: Digits and marks that may stand before a name in a title.
LEADING = "0123456789٠١٢٣٤٥٦٧٨٩-– .()\"«»"


def _choice(value: str | None, allowed: tuple[str, ...], what: str) -> str | None:
    if value is not None and value not in allowed:
        raise ValueError(f"{what} must be one of {allowed}")
    return value


def _where(rows: DataFrame, *conditions: Column | None) -> DataFrame:
    for c in conditions:
        if c is not None:
            rows = rows.where(c)
    return rows


def stats(tables: dict[str, DataFrame]) -> DataFrame:
    """One row a table, with its count."""
    out = None
    for name in sorted(tables):
        one = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionAll(one)
    return out


def books(tables: dict[str, DataFrame], q: str | None = None) -> DataFrame:
    """Books whose folded title and group contain the folded query, with their numbers of files."""
    b = tables["books"]
    text = normalize(F.concat_ws(" ", "title", "source_group"))
    return _where(b, text.contains(fold(q)) if q else None).orderBy("title", "book_id")


def _ranked(rows: DataFrame, key: str, text: str, q: str, mode: str, index: fts.Index | None) -> DataFrame:
    """Rows that match, with their BM25 score: larger is better."""
    words = fts.parse(q, mode, fold)
    if index is None:
        found = fts.search(rows, key, text, q, mode, normalize, fold)
        score = fts.bm25(rows, key, normalize(F.col(text)), words)
    else:
        found = rows.join(index.find(q, mode, fold), key, "left_semi")
        if mode == "exact":
            found = found.where(F.contains(F.col(text), F.lit(q)))
        score = index.ranked(q, fold)
    return found.join(score, key, "left").na.fill(0.0, ["score"])


def search_pages(tables: dict[str, DataFrame], q: str, mode: str = "words", book: str | None = None, limit: int = 20, offset: int = 0, index: fts.Index | None = None) -> DataFrame:
    """Distinct texts by BM25, each with its first page, the number of its pages, and an excerpt round the hit."""
    pages = _where(tables["pages"], F.col("book_id") == book if book else None)
    cited = pages.groupBy("text_sha256").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("source_count"))
    got = _ranked(tables["texts"], "text_sha256", "text", q, mode, index).join(cited, "text_sha256")
    few = page(got.select("text_sha256", "page_id", "source_count", "score", "text"), [F.desc("score"), F.col("text_sha256")], limit, offset)
    return few.withColumn("excerpt", excerpt(F.col("text"), fts.parse(q, mode, fold))).drop("text")


def search_entries(tables: dict[str, DataFrame], q: str, mode: str = "words", book: str | None = None, limit: int = 20, offset: int = 0, index: fts.Index | None = None) -> DataFrame:
    """Entries by title: those whose name begins with the query first, then by BM25 (L2)."""
    rows = tables["entries"]
    if book:
        rows = rows.join(tables["pages"].where(F.col("book_id") == book).select("page_id"), "page_id", "left_semi")
    got = _ranked(rows, "entry_id", "title", q, mode, index)
    first = F.when(F.ltrim(normalize(F.col("title")), F.lit(LEADING)).startswith(fold(q)), 0).otherwise(1)
    return page(got.withColumn("place", first), [F.col("place"), F.desc("score"), F.col("entry_id")], limit, offset)


def biographies(tables: dict[str, DataFrame], q: str | None = None, limit: int = 20, offset: int = 0, index: fts.Index | None = None) -> DataFrame:
    """Biographies by name in BM25's order, or all in the order of their ids."""
    rows = tables["biographies"]
    if not q:
        return page(rows, [F.col("biography_id")], limit, offset)
    return page(_ranked(rows, "biography_id", "name_label", q, "words", index), [F.desc("score"), F.col("biography_id")], limit, offset)


def biography(tables: dict[str, DataFrame], biography_id: str, limit: int = 12, offset: int = 0) -> DataFrame:
    """A biography's segments in the order of its source, with their texts and citations."""
    own = tables["segments"].where(F.col("biography_id") == biography_id).join(tables["pages"].select("page_id", "text", "ordinal"), "page_id")
    text = slice_of(F.col("text"), F.col("start_offset"), F.col("end_offset"))
    rows = own.select("biography_id", "page_id", "ordinal", "start_offset", "end_offset", "role", text.alias("text"))
    few = page(rows, [F.col("ordinal"), F.col("start_offset")], limit, offset, 50)
    return few.join(tables["biographies"].select("biography_id", "name_label", "classification", "boundary_status"), "biography_id").join(tables["citations"].select("page_id", "title", "printed_label", "part"), "page_id", "left")


def statements(tables: dict[str, DataFrame], q: str | None = None, kind: str | None = None, origin: str | None = None, biography: str | None = None, limit: int = 20, offset: int = 0, index: fts.Index | None = None) -> DataFrame:
    """Statements by any of the filters, with their biography's name (Q9, P2, J4, J6). Searches come by BM25, others in order."""
    _choice(kind, KINDS, "kind")
    _choice(origin, ORIGINS, "origin")
    s = _ranked(tables["statements"], "statement_id", "quote", q, "words", index) if q else tables["statements"].withColumn("score", F.lit(0.0))
    s = _where(s, F.exists("triggers", lambda t: t["kind"] == kind) if kind else None, F.col("origin") == origin if origin else None, F.col("biography_id") == biography if biography else None)
    s = s.join(tables["biographies"].select("biography_id", "name_label"), "biography_id", "left")
    return page(s, [F.desc("score"), F.col("page_id"), F.col("start"), F.col("statement_id")], limit, offset)


def sources(tables: dict[str, DataFrame], text_sha256: str, limit: int = 100, offset: int = 0) -> DataFrame:
    """All occurrences of a text, with their citations."""
    got = tables["citations"].where(F.col("text_sha256") == text_sha256)
    return page(got, [F.col("title"), F.col("zip_path"), F.col("ordinal")], limit, offset, 500)


def duplicates(tables: dict[str, DataFrame], text_sha256: str) -> DataFrame:
    """Passages of a text that stand on more than one page, with their places in it and how many pages hold them."""
    own = tables["passage_locations"].where(F.col("text_sha256") == text_sha256)
    held = tables["passage_locations"].join(own.select("passage_id").distinct(), "passage_id", "left_semi")
    n = held.select("passage_id", "text_sha256").join(tables["pages"].select("text_sha256"), "text_sha256").groupBy("passage_id").agg(F.count(F.lit(1)).alias("source_occurrences"))
    return own.join(n.where("source_occurrences > 1"), "passage_id").orderBy("start_offset")


def passage_sources(tables: dict[str, DataFrame], passage_id: str, limit: int = 100, offset: int = 0) -> DataFrame:
    """Every page that a passage stands on, with its place and citation."""
    got = tables["passage_locations"].where(F.col("passage_id") == passage_id).join(tables["citations"], "text_sha256")
    return page(got, [F.col("title"), F.col("page_id"), F.col("start_offset")], limit, offset, 500)


def page_record(tables: dict[str, DataFrame], page_id: str) -> DataFrame:
    """A page with its citation, spans, entries, mentions, the pages before and after it in its book, over file boundaries
    (J14), and the number of pages of its text."""
    mine = F.col("page_id") == page_id
    own = tables["pages"].where(mine).select("book_id").distinct()
    around = neighbours(tables["pages"].select("page_id", "book_id", "zip_index", "ordinal").join(own, "book_id", "left_semi"), "book_id", ["zip_index", "ordinal"], "page_id").where(mine).select("page_id", "previous_id", "next_id")
    rec = tables["pages"].where(mine).select("page_id", "source_id", "book_id", "ordinal", "label", "part", "header", "text", "text_sha256").join(around, "page_id")
    for name, fields in (("spans", ["start_offset", "end_offset", "kind", "anchor"]), ("entries", ["start_offset", "end_offset", "entry_id", "title", "kind"]), ("mentions", ["start_offset", "end_offset", "kind", "trigger", "in_footnote", "entry_id", "evidence"])):
        rows = tables[name].where(mine).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        rec = rec.join(rows, "page_id", "left")
    count = tables["pages"].join(rec.select("text_sha256"), "text_sha256", "left_semi").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("source_count"))
    cite = tables["citations"].where(mine).select("page_id", F.struct("title", "author", "edition", "zip_path", citation_label(F.col("part"), F.col("printed_label"), F.col("ordinal")).alias("label")).alias("citation"))
    return rec.join(count, "text_sha256").join(cite, "page_id", "left")


def entry(tables: dict[str, DataFrame], entry_id: str) -> DataFrame:
    """An entry with its text on its own page, which ends with the next heading, and the page after it."""
    e = tables["entries"].where(F.col("entry_id") == entry_id)
    later = tables["entries"].select("page_id", F.col("start_offset").alias("__s")).join(e.select("page_id", "start_offset"), "page_id").where("__s > start_offset").groupBy("page_id").agg(F.min("__s").alias("__next"))
    rows = e.join(tables["pages"].select("page_id", "text"), "page_id").join(later, "page_id", "left")
    end = F.coalesce("__next", F.length("text"))
    return rows.select("entry_id", "page_id", "title", "kind", "start_offset", end.alias("end_offset"), slice_of(F.col("text"), F.col("start_offset"), end).alias("text"), F.lit("current_page_only").alias("scope"), F.lit("automatic_candidate").alias("status"))


def chronology(tables: dict[str, DataFrame], width: int = 30) -> DataFrame:
    """Bands of years with their groups and entries, as the report has them."""
    if width not in (30, 100):
        raise ValueError("bands are of 30 or 100 years")
    dated = tables["records"].where("death_year IS NOT NULL")
    found = years.year_groups(dated, "name_key", "death_year", "name_label")
    per = found.groupBy(F.col("death_year").alias("year")).agg(F.count(F.lit(1)).alias("groups"), F.sum("source_entries").alias("source_entries"))
    return years.bins(per, width).orderBy("start")


def citation_label(part: Column, label: Column, ordinal: Column) -> Column:
    """Part and printed number; a missing number is replaced by the page's place, marked."""
    number = F.when(label.isNull() | (F.trim(label) == ""), F.concat(F.lit("#"), (ordinal + 1).cast("string"))).otherwise(label)
    return F.concat_ws("/", part, number)


def identities(view: DataFrame) -> DataFrame:
    """identity_id, kind, display_name (the label of the smallest entry) and entry_count of a unified view."""
    return view.groupBy("identity_id").agg(F.min("identity_kind").alias("kind"), F.min_by("name_label", "entry_id").alias("display_name"), F.count(F.lit(1)).alias("entry_count"))


def identity_entry(tables: dict[str, DataFrame], entry_id: str) -> DataFrame:
    """An entry's identity, its name and the number of its entries."""
    return tables["entry_identity"].where(F.col("entry_id") == entry_id).join(tables["identities"], "identity_id")


def _by_entry(table: str) -> Callable[[dict[str, DataFrame], str], DataFrame]:
    return lambda tables, entry_id: tables[table].join(tables["entry_identity"].where(F.col("entry_id") == entry_id).select("identity_id"), "identity_id", "left_semi")


def identity_members(tables: dict[str, DataFrame], identity_id: str, limit: int = 30, offset: int = 0) -> DataFrame:
    return page(tables["entry_identity"].where(F.col("identity_id") == identity_id), [F.col("entry_id")], limit, offset)


def identity_dates(tables: dict[str, DataFrame], entry_id: str) -> DataFrame:
    """All year claims of an entry's identity, with the identity's summary beside each."""
    claims = _by_entry("claims")(tables, entry_id)
    summary = tables["date_summary"].select("identity_id", "years", "bucket_size", "bucket_start", "bucket_end")
    return claims.join(summary, "identity_id", "left").orderBy("year", "entry_id", "evidence_type", "quote")


def identity_graph(tables: dict[str, DataFrame], entry_id: str, relation: str | None = None, limit: int = 30, offset: int = 0) -> DataFrame:
    """Names that an entry's identity is linked to, most supported first. A name isn't a person."""
    _choice(relation, RELATIONS, "relation")
    got = _where(_by_entry("neighbors")(tables, entry_id), F.col("relation") == relation if relation else None)
    return page(got, [F.desc("entries"), F.desc("observations"), F.col("relation"), F.col("mention_id")], limit, offset)


def graph_evidence(tables: dict[str, DataFrame], entry_id: str, relation: str, mention_id: str, limit: int = 30, offset: int = 0) -> DataFrame:
    """The observations behind one neighbour of an entry's identity."""
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")
    got = _by_entry("observations")(tables, entry_id).where((F.col("relation") == relation) & (F.col("mention_id") == mention_id))
    return page(got, [F.col("entry_id"), F.col("other_id")], limit, offset)


def graph_mention(tables: dict[str, DataFrame], mention_id: str, relation: str | None = None, limit: int = 30, offset: int = 0) -> DataFrame:
    """Identities that a name is linked to; their labels are looked up for the page that is shown only."""
    _choice(relation, RELATIONS, "relation")
    got = _where(tables["neighbors"].where(F.col("mention_id") == mention_id), F.col("relation") == relation if relation else None)
    few = page(got, [F.desc("entries"), F.desc("observations"), F.col("identity_id"), F.col("relation")], limit, offset)
    return F.broadcast(few).join(tables["identities"].select("identity_id", F.col("kind").alias("identity_kind"), "display_name"), "identity_id", "left")


def chain_edges(chain: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbouring names of a chain against known teacher edges: found, missing or unknown.

    chain: id, i, name, next_name. edges: student, teacher. Names meet if equal, or if one of two words or more is the
    other's beginning, up to a space. unknown: the student has no edges at all. Names meet by an equi-join on beginnings of
    whole words, so that no name is compared with all others.
    """
    c, e = chain.where(F.col("next_name").isNotNull()), edges.select("student", "teacher").distinct()
    spoken = F.split("student", " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(spoken)), lambda i: F.struct(F.array_join(F.slice(spoken, 1, i), " ").alias("k"), i.alias("n")))
    keyed = e.select("student", "teacher", F.explode(heads).alias("h")).where((F.col("h.k") == F.col("student")) | (F.col("h.n") >= 2)).select("teacher", F.col("h.k").alias("name"))
    got = c.join(keyed, "name", "left")
    fits = (F.col("teacher") == F.col("next_name")) | ((F.size(F.split("next_name", " ")) >= 2) & F.col("teacher").startswith(F.concat("next_name", F.lit(" "))))
    flags = got.groupBy("id", "i", "name", "next_name").agg(F.bool_or(F.col("teacher").isNotNull()).alias("known"), F.coalesce(F.bool_or(fits), F.lit(False)).alias("hit"))
    return flags.select("id", "i", "name", "next_name", F.when(F.col("hit"), "found").when(F.col("known"), "missing").otherwise("unknown").alias("state"))
