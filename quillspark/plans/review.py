"""What reviewers see: the queue, contexts, packets, comparisons, and the corpus audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import audit, chronology
from quillspark.operators.sequence import top_per_group

CONTEXT, STATEMENTS, EXAMPLES = 400, 12, 8


def queue(records: DataFrame, groups: DataFrame, cite: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of more than one entry, and their members with evidence and citation.

    records: entry_id, group_id, name_label, death_year, evidence_page_id, evidence_quote, page_id. cite: page_id and
    citation fields. Fails at run time on a member without evidence.
    """
    wanted = groups.where("source_entries > 1")
    members = records.join(wanted.select("group_id"), "group_id", "left_semi").join(cite, "page_id", "left")
    return wanted, audit.refuse(members, F.coalesce(F.col("evidence_quote"), F.lit("")) == "", "a proposed member has no evidence quote")


def queue_mismatches(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Groups whose count isn't that of their members."""
    return audit.count_mismatches(groups, members, "group_id", "source_entries")


def contexts(members: DataFrame, entries: DataFrame, pages: DataFrame, statements: DataFrame, chars: int = CONTEXT, most: int = STATEMENTS) -> DataFrame:
    """Each member with its opening's surroundings and its first statements (E2). A heading that isn't at its offsets fails."""
    e = entries.select("entry_id", F.col("page_id").alias("__p"), "start_offset", "end_offset", "title").join(pages.select(F.col("page_id").alias("__p"), "text"), "__p")
    e = audit.refuse(e, F.expr("substring(text, start_offset + 1, end_offset - start_offset) <> title"), "a heading isn't at its offsets")
    first = F.greatest(F.col("start_offset") - chars, F.lit(0))
    opening = F.substring("text", first + 1, F.col("end_offset") + chars - first)
    few = top_per_group(statements.where(F.col("biography_id").isNotNull()), "biography_id", [F.col("page_id"), F.col("start"), F.col("end"), F.col("origin")], most)
    told = few.groupBy(F.col("biography_id").alias("entry_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "page_id", "start", "end", "origin", "subject_status", "quote"))).alias("statements"))
    return members.join(e.select("entry_id", F.col("title").alias("heading"), opening.alias("opening_context")), "entry_id").join(told, "entry_id", "left")


def packet(members: DataFrame, statements: DataFrame, pages: DataFrame) -> DataFrame:
    """All evidence of each member, every quote checked against its page (E25). An entry's statements are one row's array."""
    text = statements.join(pages.select("page_id", "text"), "page_id")
    ok = audit.refuse(text, F.expr("NOT (quote <=> substring(text, start + 1, end - start))"), "a quote isn't at its offsets")
    told = ok.groupBy(F.col("biography_id").alias("entry_id")).agg(F.array_sort(F.collect_list(F.struct("page_id", "start", "end", "origin", "quote"))).alias("evidence"), F.count(F.lit(1)).alias("n_statements"))
    return members.join(told, "entry_id", "left").na.fill(0, ["n_statements"])


def compare(statements: DataFrame, years: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """Quotes that two entries share, every occurrence with every other, and how their years relate."""
    if left == right:
        raise ValueError("two different entries are needed")
    a = statements.where(F.col("biography_id") == left).select("quote", F.col("page_id").alias("left_page"), F.col("start").alias("left_start"))
    b = statements.where(F.col("biography_id") == right).select("quote", F.col("page_id").alias("right_page"), F.col("start").alias("right_start"))
    pair = years.where(F.col("entry_id").isin(left, right)).agg(F.max(F.when(F.col("entry_id") == left, F.col("year"))).alias("left_year"), F.max(F.when(F.col("entry_id") == right, F.col("year"))).alias("right_year"))
    both = F.col("left_year").isNotNull() & F.col("right_year").isNotNull()
    low, high = F.least("left_year", "right_year"), F.greatest("left_year", "right_year")
    relation = F.when(~both, "unavailable").when(F.col("left_year") == F.col("right_year"), "same_extracted_year").otherwise("different_extracted_years")
    return a.join(b, "quote"), pair.select("left_year", "right_year", relation.alias("date_relation"), F.when(both, chronology.common_unit(low, high)).alias("unit"))


def endpoint_examples(groups: DataFrame, records: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """The first groups of the earliest and the latest year, each with its first entry's evidence."""
    ends = groups.agg(F.min("death_year").alias("a"), F.max("death_year").alias("b")).select(F.explode(F.array_distinct(F.array("a", "b"))).alias("death_year"))
    chosen = top_per_group(groups.join(ends, "death_year", "left_semi"), "death_year", [F.col("name_label"), F.col("group_id")], most)
    evidence = records.groupBy("group_id").agg(F.min_by(F.struct("entry_id", "evidence_page_id", "evidence_quote"), "entry_id").alias("e"))
    return chosen.join(evidence, "group_id", "left").select("group_id", "name_label", "death_year", "rank", "e.*")


def corpus_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """check, violations of offsets and counts over the corpus tables; all must be zero.

    tables: files (id, status, pages, markers), pages (page_id, source_id, text), entries, mentions, spans (page_id and
    offsets).
    """
    text = tables["pages"].select("page_id", "text")
    n = tables["pages"].groupBy(F.col("source_id").alias("id")).agg(F.count(F.lit(1)).alias("__n"))
    files = tables["files"].join(n, "id", "left")
    outside = "start_offset < 0 OR end_offset > length(text) OR end_offset < start_offset"
    bad = {
        "source_page_counts": files.where("status = 'ok' AND page_count <> coalesce(__n, 0)"),
        "page_marker_counts": files.where("marker_count > 0 AND marker_count <> page_count"),
        "failed_files": files.where("status <> 'ok'"),
        "entry_offsets": tables["entries"].join(text, "page_id").where(f"{outside} OR NOT (title <=> substring(text, start_offset + 1, end_offset - start_offset))"),
        "mention_offsets": tables["mentions"].join(text, "page_id").where(outside),
        "span_offsets": tables["spans"].join(text, "page_id").where(outside),
    }
    out = None
    for name, rows in bad.items():
        one = audit.required(rows, name)
        out = one if out is None else out.unionAll(one)
    return out
