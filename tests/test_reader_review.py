"""Reader, review, chronology and sinks on small tables."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import passages
from quillspark.plans import chronicle, reader, review
from quillspark.sources import sinks


def test_small_functions(spark):
    def one(make, *values):
        df = spark.createDataFrame([values], ", ".join(f"v{i} {'int' if isinstance(v, int) else 'string'}" for i, v in enumerate(values)))
        return df.select(make(*[F.col(f"v{i}") for i in range(len(values))]).alias("x")).first().x

    text = "كلام كثير قبل " * 20 + "أُسامة بن عمير ثم كلام"
    got = one(lambda t: passages.excerpt(t, ["اسامة"]), text)
    assert "أُسامة" in got.text and text[got.start : got.end] == got.text and got.end - got.start <= 340
    assert one(lambda t: passages.excerpt(t, ["zzz"]), "abc")[1:] == (0, 3)
    assert one(passages.reanchor, "xx abc yy", "abc", 3, "", "") == 3
    assert one(passages.reanchor, "zz xx abc yy", "abc", 3, "zz xx ", " yy") == 6
    assert one(passages.reanchor, "abc abc", "abc", 1, "q", "q") is None
    assert one(passages.page_locator, "") == "ztntfp" and one(passages.page_locator, "a") != one(passages.page_locator, "b")
    assert one(passages.reader_fold, "أُسَامَة") == "اسامه"
    assert one(reader.heading_match, "12 - أُسامة ابن عمير، والد", "أسامة بن عمير") and not one(reader.heading_match, "باب أسامة", "أسامة")
    assert one(reader.assessment, "3 - فلان صدوق يخطئ من السابعة", "تقريب التهذيب") == "صدوق يخطئ" and one(reader.assessment, "صدوق", "غيره") is None
    titles = ["تقريب التهذيب", "الإصابة في تمييز الصحابة", "تهذيب التهذيب", "تهذيب الكمال", "إكمال تهذيب الكمال", "كتاب"]
    for companion, want in ((False, [0, 4, 1, 2, 5, 5]), (True, [0, 1, 2, 3, 5, 5])):
        assert [one(lambda t: reader.priority(t, F.lit(companion)), t) for t in titles] == want  # noqa: B023
    r = spark.createDataFrame([(10, [(2, 6), (4, 8)])], "n int, r array<struct<start:int,end:int>>")
    got = r.select(passages.elementary_intervals(F.col("n"), F.col("r")).alias("x")).first().x
    assert [(p.start, p.end, p.over) for p in got] == [(0, 2, []), (2, 4, [0]), (4, 6, [0, 1]), (6, 8, [1]), (8, 10, [])]
    t = spark.createDataFrame([("كتاب الصلاة",), ("باب الوضوء",), ("المؤلف فلان",), ("قصر",)], "title string")
    assert [x.level for x in reader.contents(t).collect()] == [1, 2]
    assert spark.createDataFrame([("a &lt;b&gt;  &amp;amp; c",)], "s string").select(passages.clean_markup(F.col("s"))).first()[0] == "a <b> &amp; c"


def test_reader_books(spark):
    p = spark.createDataFrame([("b", 0, 0, "1"), ("b", 0, 1, "1"), ("b", 1, 0, "2"), ("b", 1, 1, None), ("b", 1, 2, "2")], "book string, file int, ordinal int, part string")
    p = reader.page_index(p, "book", ["file", "ordinal"])
    v = reader.volumes(p, "book", "part")
    assert [(r.page, r.title) for r in v.orderBy("page").collect()] == [(0, "1"), (2, "2"), (3, None), (4, "2")]
    assert [r.volume for r in reader.volume_of(p, v, "book").orderBy("page").collect()] == ["1", "1", "2", None, "2"]
    g = spark.createDataFrame([("b", 0, ["weak", "hasan"]), ("b", 1, ["sahih", "hasan"]), ("b", 2, ["weak"]), ("b", 3, ["hasan"]), ("b", 4, [])], "book string, page int, s array<string>").withColumn("status", reader.grade_status(F.col("s")))
    assert [r.status for r in g.orderBy("page").collect()] == ["review", "sahih", "weak", "hasan", None]
    assert reader.grade_counts(g, "book").first().asDict() == {"book": "b", "weak": 1, "sahih": 1, "hasan": 1, "review": 1}
    assert [r.next_page for r in reader.next_graded(g, "book", "status").orderBy("page").collect()] == [1, None, None, None, None]
    rows = spark.createDataFrame([("1", "x", 5), ("2", "name y", 2), ("3", "name z", 0), ("2", "name y", 2)], "id string, title string, p int")
    assert [r.id for r in reader.ranked(rows, "id", F.col("title").startswith("name"), F.lit(False), F.col("p")).collect()] == ["3", "2", "1"]
    typed, ink = spark.createDataFrame([("p1", "n"), ("p2", " ")], "page_id string, text string"), spark.createDataFrame([("p3", 2), ("p9", 1)], "page_id string, strokes int")
    pages = spark.createDataFrame([("p1", 1, 1), ("p2", 0, 0), ("p3", 0, 5)], "page_id string, book int, page int")
    assert [r.page_id for r in reader.note_index(typed, ink, pages).collect()] == ["p3", "p1", "p9"]


@pytest.fixture(scope="module")
def dated(spark):
    texts = {"p1": "محمد بن علي بن زيد (ت 230 هـ)\nنص.\nأحمد بن عمر بن سعد\nتوفي سنة 240 هـ.\n", "p2": "محمد بن علي بن زيد\nمات سنة 250 هـ.\nباب آخر\nعلي بن سعيد بن خالد\nنص بلا تاريخ.\n"}
    heads = [("e1", "p1", "محمد بن علي بن زيد (ت 230 هـ)"), ("e2", "p1", "أحمد بن عمر بن سعد"), ("e3", "p2", "محمد بن علي بن زيد"), ("e4", "p2", "باب آخر"), ("e5", "p2", "علي بن سعيد بن خالد")]
    pages = spark.createDataFrame(list(texts.items()), "page_id string, text string")
    entries = spark.createDataFrame([(e, p, texts[p].index(t), texts[p].index(t) + len(t), t) for e, p, t in heads], "entry_id string, page_id string, start_offset int, end_offset int, title string")
    none = spark.createDataFrame([], "page_id string, start_offset int, end_offset int")
    return pages, entries, chronicle.records(pages, entries, none).cache()


def test_chronology_of_entries(spark, dated):
    pages, entries, rows = dated
    got = {r.entry_id: (r.death_year, r.date_status) for r in rows.collect()}
    assert got == {"e1": (None, "ambiguous_name_or_conflicting_year"), "e3": (None, "ambiguous_name_or_conflicting_year"), "e2": (240, "explicit_hijri"), "e5": (None, "no_usable_death_date")}
    g = chronicle.groups(rows)
    assert [(r.death_year, r.source_entries) for r in g.collect()] == [(240, 1)]
    assert {r.violations for r in chronicle.checks(rows, g, pages).collect()} == {0}


def test_review_views(spark, dated):
    pages, entries, rows = dated
    rec = spark.createDataFrame([("e1", "G", "n", 230, "p1", "q", "p1"), ("e3", "G", "n", 230, "p2", "q", "p2"), ("e2", "H", "m", 240, "p1", "q", "p1")], "entry_id string, group_id string, name_label string, death_year int, evidence_page_id string, evidence_quote string, page_id string")
    groups = spark.createDataFrame([("G", "n", 230, 2), ("H", "m", 240, 1)], "group_id string, name_label string, death_year int, source_entries long")
    cite = spark.createDataFrame([("p1", "b"), ("p2", "b")], "page_id string, book string")
    wanted, members = review.queue(rec, groups, cite)
    assert wanted.count() == 1 and sorted(r.entry_id for r in members.collect()) == ["e1", "e3"] and review.queue_mismatches(wanted, members).count() == 0
    with pytest.raises(Exception, match="no evidence"):
        review.queue(rec.withColumn("evidence_quote", F.lit("")), groups, cite)[1].collect()
    text = pages.where("page_id = 'p1'").first().text
    said = spark.createDataFrame([("e1", "p1", 0, 4, "main_text", "s", text[0:4]), ("e3", "p1", 0, 4, "main_text", "s", text[0:4]), ("e3", "p1", 5, 7, "main_text", "s", text[5:7])], "biography_id string, page_id string, start int, end int, origin string, subject_status string, quote string")
    ctx = {r.entry_id: r for r in review.contexts(members, entries, pages, said, chars=3).collect()}
    assert ctx["e1"].opening_context.startswith("محمد") and len(ctx["e3"].statements) == 2
    assert {r.entry_id: r.n_statements for r in review.packet(members, said, pages).collect()} == {"e1": 1, "e3": 2}
    with pytest.raises(Exception, match="isn't at its offsets"):
        review.packet(members, said.withColumn("quote", F.lit("zz")), pages).collect()
    shared, years = review.compare(said, rec.select("entry_id", F.col("death_year").alias("year")), "e1", "e3")
    assert shared.count() == 1 and years.first().date_relation == "same_extracted_year" and years.first().unit == 1
    with pytest.raises(ValueError):
        review.compare(said, rec, "e1", "e1")
    assert sorted((r.group_id, r.entry_id) for r in review.endpoint_examples(groups, rec).collect()) == [("G", "e1"), ("H", "e2")]
    files = spark.createDataFrame([("s1", "ok", 2, 2), ("s2", "failed", 0, 0)], "id string, status string, page_count int, marker_count int")
    tables = {"files": files, "pages": pages.withColumn("source_id", F.lit("s1")), "entries": entries, "mentions": entries.withColumn("end_offset", F.lit(9999)), "spans": entries}
    assert {r.check: r.violations for r in review.corpus_audit(tables).collect()} == {"source_page_counts": 0, "page_marker_counts": 0, "failed_files": 1, "entry_offsets": 0, "mention_offsets": 5, "span_offsets": 0}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    path = str(tmp_path / "t")
    sinks.write_once(df, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_once(df, path)
    sinks.add_missing(spark, spark.createDataFrame([(1, "z"), (3, "c")], "id int, v string"), path, ["id"])
    sinks.merge(spark, spark.createDataFrame([(2, "b")], "id int, v string"), path, ["id"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sinks.csv_report(df, ["id"]).decode("utf-8").startswith("﻿id,v\r\n1,a\r\n2,")
    assert '"v": "a"' in sinks.json_report(df, ["id"]) and "<td>1</td>" in sinks.html_report("<t>", df, ["id"])
    with pytest.raises(ValueError):
        sinks.csv_report(df, ["id"], most=1)
