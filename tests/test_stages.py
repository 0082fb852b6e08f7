"""Extraction over pages, identity stages, archives, streams and the API on small tables."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillspark.functions.arabic import normalize
from quillspark.operators import search
from quillspark.operators.components import components
from quillspark.plans import api, chronicle, corpus, extraction, identity
from quillspark.sources import archives
from quillspark.storage import materialize
from quillspark.streaming import ingest

TEXTS = {
    "p1": ("f1", 0, "أحمد بن محمد بن زيد\nقال أبو زرعة: ثِقَةٌ.\nروى عن أبيه.\nقال المحقق: إسناده ضعيف.\n"),
    "p2": ("f1", 1, "تُوُفِّيَ سنة ثلاثمائة.\n"),
    "p3": ("f1", 2, "تتمة النص.\nباب آخر\nقال أحمد: ضعيف.\nمحمد بن عبد الله\nقال أحمد: ليس به بأس.\n"),
    "p4": ("f2", 0, "روى عنه ابنه.\n"),
    "p5": ("f2", 1, "إبراهيم بن محمد\nقال أبو زرعة: ثِقَةٌ.\n"),
}
ENTRIES = [("a", "p1", "أحمد بن محمد بن زيد", True), ("chapter", "p3", "باب آخر", False), ("b", "p3", "محمد بن عبد الله", True), ("c", "p5", "إبراهيم بن محمد", True)]


@pytest.fixture(scope="module")
def small(spark):
    pages = spark.createDataFrame([(p, s, "book", o, t) for p, (s, o, t) in TEXTS.items()], "page_id string, source_id string, book_id string, ordinal int, text string")
    rows = [(e, p, TEXTS[p][2].index(t), TEXTS[p][2].index(t) + len(t), t if bio else None) for e, p, t, bio in ENTRIES]
    entries = spark.createDataFrame(rows, "entry_id string, page_id string, start_offset int, end_offset int, name_label string")
    a = TEXTS["p1"][2].index("قال المحقق")
    notes = spark.createDataFrame([("p1", a, len(TEXTS["p1"][2]))], "page_id string, start_offset int, end_offset int")
    found = extraction.regions(pages, entries)
    return pages, entries, notes, found, extraction.statements(pages, found, notes).cache()


def test_segments_and_owners(small):
    pages, entries, notes, found, said = small
    seg = {(r.biography_id, r.page_id, r.role) for r in extraction.segments(found).collect()}
    assert {x[1:] for x in seg if x[0] == "a"} == {("p1", "opening"), ("p2", "continuation"), ("p3", "continuation")}
    rows = said.collect()
    assert {r.biography_id for r in rows if r.page_id == "p4"} == {None}
    assert {r.subject_status for r in rows if r.biography_id is None and r.page_id == "p3"} == {"unassigned_source_context"}
    twice = [r for r in rows if r.attribution_text == "أبو زرعة"]
    assert len(twice) == 2 and len({r.text_sha256 for r in twice}) == 1


def test_biographies_and_checks(small):
    pages, entries, notes, found, said = small
    bios = {r.biography_id: r for r in extraction.biographies(pages, entries, found, said).collect()}
    assert set(bios) == {"a", "b", "c"}
    assert bios["b"].boundary_status == "source_file_end_unresolved" and bios["a"].boundary_status == "next_recorded_heading"
    assert bios["a"].segment_count == 3 and bios["c"].statement_count == 1
    assert {r.check: r.violations for r in extraction.checks(pages, entries, notes, found, said).collect()} == dict.fromkeys(["quote_mismatches", "trigger_mismatches", "attribution_mismatches", "bad_segments", "wrong_biography_owner", "headings_crossed", "footnote_layer_errors"], 0)
    assert {r.kind: r.statements for r in extraction.trigger_counts(said).collect()}["assessment"] == 5


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _entries(spark):
    rows = [(e, "اسم", f"{e} label", "biography_candidate", f"book{i % 2}", "page") for i, e in enumerate("abcdef")]
    return spark.createDataFrame(rows, "entry_id string, name_key string, name_label string, classification string, book_id string, opening_page_id string")


DECISIONS = "left_id string, right_id string, decision string"


def test_unified_view_keeps_reviews(spark):
    links = spark.createDataFrame([("a", "b", "x"), ("b", "c", "x"), ("c", "d", "x"), ("e", "f", "x"), ("d", "e", "x")], "left_id string, right_id string, kind string")
    reviewed = spark.createDataFrame([("a", "P", "reviewed"), ("b", "P", "reviewed")], "entry_id string, person_id string, person_status string")
    decided = spark.createDataFrame([("a", "b", "same"), ("d", "e", "uncertain")], DECISIONS)
    view, judged = identity.unified_view(_entries(spark), links, decided, reviewed)
    what = {(r.left_id, r.right_id): r.disposition for r in judged.collect()}
    assert what == {("a", "b"): "already_reviewed", ("b", "c"): "review_bridge", ("c", "d"): "provisional_link", ("e", "f"): "provisional_link", ("d", "e"): "review_veto"}
    ids = {r.entry_id: (r.identity_id, r.identity_kind) for r in view.collect()}
    assert len(ids) == 6 and ids["a"] == ids["b"] == ("P", "reviewed_person")
    assert ids["c"] == ids["d"] != ids["e"] == ids["f"]
    assert {r.identity_id: r.n for r in view.groupBy("identity_id").agg(F.count("*").alias("n")).collect()}[ids["c"][0]] == 2


def test_transitive_veto_is_refused(spark):
    pairs = spark.createDataFrame([("a", "b", 2, "n"), ("b", "c", 3, "n"), ("d", "e", 1, "n")], "left_id string, right_id string, shared long, name_key string")
    assert identity.provisional_links(pairs, spark.createDataFrame([("a", "b", "different")], DECISIONS)).count() == 1
    with pytest.raises(ValueError):
        identity.provisional_links(pairs, spark.createDataFrame([("a", "c", "different")], DECISIONS))


def test_candidates_links_and_graph(spark):
    e = _entries(spark)
    said = spark.createDataFrame([("a", "t1", 70), ("b", "t1", 70), ("b", "t2", 80), ("a", "t2", 80), ("c", "t2", 80), ("c", "t9", 10), ("d", "t9", 10)], "entry_id string, text_sha256 string, chars int")
    got = {(r.left_id, r.right_id): (r.shared, r.priority) for r in identity.literal_candidates(e, said).collect()}
    assert got == {("a", "b"): (2, "strong_short_name_review"), ("a", "c"): (1, "one_literal_review"), ("b", "c"): (1, "one_literal_review")}
    assert identity.literal_candidates(e, said, cap=2).count() == 1
    feats = [(x, k, n, "اسم") for x in "ab" for k, ns in (("teachers", "pqr"), ("students", "uvw")) for n in ns] + [("c", "teachers", "p", "اسم")]
    feats_df = spark.createDataFrame(feats, "entry_id string, kind string, name string, name_key string")
    rel = identity.relationship_candidates(spark.createDataFrame(feats, "entry_id string, kind string, name string, name_key string"))
    assert {(r.left_id, r.right_id): r.priority for r in rel.collect()} == {("a", "b"): "both_lists_3plus", ("a", "c"): "weak_overlap", ("b", "c"): "weak_overlap"}
    view = e.withColumn("identity_id", F.concat(F.lit("single-"), "entry_id")).withColumn("identity_kind", F.lit("unlinked_entry"))
    none = spark.createDataFrame([], DECISIONS)
    assert [(r.left_id, r.right_id) for r in identity.relationship_links(rel, view, none).collect()] == [("a", "b")]
    assert {(r.left_id, r.right_id, r.left_identity, r.right_book) for r in identity.relationship_gaps(feats_df, view).collect()} == {("a", "b", "single-a", "book1"), ("a", "c", "single-a", "book0"), ("b", "c", "single-b", "book0")}
    assert identity.relationship_gaps(feats_df, view.withColumn("identity_id", F.lit("one"))).count() == 0 and identity.relationship_gaps(feats_df, view, most_group=2).count() == 0
    obs, near = identity.relationship_graph(rel.where("priority = 'both_lists_3plus'"), view)
    assert obs.count() == 12 and near.count() == 12
    gaps = identity.gap_queue(identity.name_groups(e), view)
    assert [(r.name_key, r.identities, r.priority) for r in gaps.collect()] == [("اسم", 6, "cross_book_short_name")]


def test_identity_dates(spark):
    view = _entries(spark).withColumn("identity_id", F.lit("I"))
    auto = spark.createDataFrame([("a", 186, "q", "p"), ("b", 187, "q", "p"), ("c", None, "q", "p")], "entry_id string, year int, quote string, page_id string")
    seen = spark.createDataFrame([("a", 189, "r", "p")], "entry_id string, year int, quote string, page_id string")
    claims, summary = identity.identity_dates(view, auto, seen)
    r = summary.first()
    assert claims.count() == 3 and (r.years, r.bucket_size, r.bucket_start, r.bucket_end) == ("186,187,189", 10, 180, 189)
    with pytest.raises(Exception, match="missing from the identity view"):
        identity.identity_dates(view.where("entry_id = 'a'"), auto, seen)[0].collect()


def test_decisions_are_checked_and_latest_wins(spark):
    schema = "left_id string, right_id string, decision string, reviewer string, reason string, recorded_at int"
    members = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "h")], "entry_id string, group_id string")
    new = spark.createDataFrame([("b", "a", "same", "r", "w", 1), ("a", "b", "different", "r", "w", 2)], schema)
    history, now = identity.record_decisions(spark.createDataFrame([], schema), new, members)
    assert history.count() == 2 and [(r.left_id, r.right_id, r.decision) for r in now.collect()] == [("a", "b", "different")]
    for bad in (("a", "c", "same", "r", "w", 1), ("a", "b", "same", "r", " ", 1), ("a", "b", "maybe", "r", "w", 1), ("a", "a", "same", "r", "w", 1)):
        with pytest.raises(Exception, match="a decision needs"):
            identity.record_decisions(history, spark.createDataFrame([bad], schema), members)[0].collect()


def test_persons_need_all_pairs(spark):
    people = spark.createDataFrame([(x, "P") for x in "abc"] + [("d", "Q"), ("e", "Q")], "entry_id string, person_id string")
    same = spark.createDataFrame([("a", "b", "same"), ("a", "c", "same"), ("b", "c", "different"), ("d", "e", "same")], DECISIONS)
    assert [(r.person_id, r.missing) for r in identity.incomplete_persons(people, same).collect()] == [("P", 1)]


def test_date_claims_must_be_unique(spark, small):
    pages, entries, _, found, _ = small
    seg = extraction.segments(found)
    claim = lambda q: spark.createDataFrame([("b", "p3", q, 206)], "entry_id string, page_id string, quote string, year int")
    r = identity.date_claims(claim("ليس به بأس"), seg, pages).first()
    assert TEXTS["p3"][2][r.start_offset : r.end_offset] == "ليس به بأس"
    for q in ("غير موجود", "د"):
        with pytest.raises(Exception, match="exactly once"):
            identity.date_claims(claim(q), seg, pages).collect()


def test_archive_to_tables_and_search(spark, tmp_path):
    body = lambda x: f'<html><title>t</title><div class="PageText"><p>الكتاب: كتاب {x}</p></div><div class="PageText"><span class="title">1 - أسامة بن عمير بن عامر</span><p>روى عنه ابنه {x}</p><p>توفي سنة 230 هـ.</p></div></html>'
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("exports/one.htm", body("أول"))
        z.writestr("exports/two.htm", body("ثان"))
        z.writestr("exports/bad.htm", b"\xff\x81<div class='PageText'><!-- <div class='PageText'> --></div>")
        z.writestr("exports/readme.txt", "no")
    files = archives.read_files(spark, str(tmp_path / "a.zip")).cache()
    assert {r.source_group: r.status for r in files.collect()} == {"one": "ok", "two": "ok", "bad": "failed"}
    assert archives.read_files(spark, str(tmp_path / "a.zip"), known=files).count() == 1
    assert archives.read_files(spark, str(tmp_path / "a.zip"), groups=["two"]).count() == 1
    assert archives.read_files(spark, str(tmp_path / "a.zip"), limit=2).count() == 2
    t = {k: materialize(v) for k, v in corpus.build(files).items()}
    assert [(r.files, r.status) for r in t["archives"].collect()] == [(3, "partial")]
    assert {r.title for r in t["books"].collect()} == {"كتاب أول", "كتاب ثان"}
    pages = t["pages"]
    assert pages.count() == 4 and pages.where("is_metadata").count() == 2
    file = files.where("source_group = 'one'").first().asDict()
    p = pages.where((F.col("source_id") == file["id"]) & (F.col("ordinal") == 1)).first()
    assert archives.raw_bytes(spark, str(tmp_path / "a.zip"), file, p.raw_start, p.raw_end).startswith(b'<div class="PageText"><span')
    # From entries to a chronology, statements and served records.
    heads = t["entries"].collect()
    assert len(heads) == 2 and all(p.text[e.start_offset : e.end_offset] == e.title for e in heads if e.page_id == p.page_id)
    told = t["mentions"].collect()
    assert {(m.kind, m.trigger) for m in told} == {("student_mention", "روى عنه"), ("family_mention", "ابنه")} and {m.entry_id for m in told} == {e.entry_id for e in heads}
    t["records"] = materialize(chronicle.records(t["pages"], t["entries"], t["footnotes"]))
    assert {(r.name_label, r.death_year) for r in t["records"].collect()} == {("أسامة بن عمير بن عامر", 230)}
    named = t["entries"].join(t["records"].select("entry_id", "name_label"), "entry_id")
    found = materialize(extraction.regions(pages, named))
    said = materialize(extraction.statements(pages, found, t["footnotes"]))
    assert {x["kind"] for r in said.collect() for x in r.triggers} == {"students", "family", "death"}
    bios = t["biographies"] = materialize(extraction.biographies(pages, named, found, said))
    assert all(r.violations == 0 for r in extraction.checks(pages, named, t["footnotes"], found, said, bios).collect())
    t["segments"], t["statements"] = extraction.segments(found), said
    rec = api.page_record(t, p.page_id).first()
    assert rec.previous_id is not None and len(rec.entries) == 1 and len(rec.mentions) == 2 and rec.citation.title == "كتاب أول" and rec.source_count == 1
    e = api.entry(t, rec.entries[0].entry_id).first()
    assert e.text.startswith("1 - أسامة") and "روى عنه" in e.text
    assert api.biography(t, rec.entries[0].entry_id).first().title == "كتاب أول"
    assert api.biographies(t, "عمير").count() == 2 and api.biographies(t).count() == 2
    assert api.statements(t, "ابنه", kind="family").count() == 2 and api.statements(t, origin="footnote").count() == 0
    assert [r.source_entries for r in api.chronology(t).collect()] == [2]
    assert api.search_entries(t, "أسامة").first().place == 0 and api.sources(t, p.text_sha256).count() == 1
    assert api.search_pages(t, "أُسامة ابن عمير").count() == 2
    hit = api.search_pages(t, "اسامة بن", "phrase", limit=1).first()
    assert hit.has_more and "أسامة" in hit.excerpt.text
    assert api.search_pages(t, "أسامة بن", "exact").count() == 2 and api.search_pages(t, "اسامة بن", "exact").count() == 0
    # A stored index gives what the scan gives.
    search.store(t["texts"], "text_sha256", normalize(F.col("text")), str(tmp_path / "i"), buckets=4)
    index = search.Index(spark, str(tmp_path / "i"), "text_sha256", buckets=4)
    for q, mode in (("أُسامة ابن عمير", "words"), ("اسامة بن", "phrase"), ("أسامة بن", "exact"), ("اسا", "prefix")):
        a, b = ([(r.text_sha256, round(r.score, 9), r.excerpt.start) for r in api.search_pages(t, q, mode, index=i).collect()] for i in (None, index))
        assert a == b and len(a) == 2
    assert api.books(t, "ثان").count() == 1 and api.stats({"pages": pages}).first().rows == 4
    for q in ("", "?" * 3, "x" * 201):
        with pytest.raises(ValueError):
            api.search_pages(t, q)
    with pytest.raises(ValueError):
        api.search_pages(t, "x", "regex")


def test_releases(spark, tmp_path):
    import hashlib

    (tmp_path / "m.json").write_text('{"database_sha256": "abc", "parts": [{"name": "a.bin"}]}')
    assert archives.manifest(spark, str(tmp_path / "m.json"))["database_sha256"] == "abc"
    parts = tmp_path / "parts"
    parts.mkdir()
    (parts / "a.bin").write_bytes(b"one")
    (parts / "b.bin").write_bytes(b"two")
    sha = {n: hashlib.sha256(c).hexdigest() for n, c in (("a.bin", b"one"), ("b.bin", b"two"))}
    memo = archives.verified(spark, str(parts), sha)
    assert archives.verified(spark, str(parts), sha, memo).count() == 2
    with pytest.raises(ValueError, match="b.bin"):
        archives.verified(spark, str(parts), sha | {"b.bin": "0"})
    assert archives.located(["/x/a.zip", "/y/b.zip"], "b.zip") == "/y/b.zip" and archives.located(["/x/a.zip"], "c.zip") == "/x/a.zip"
    with pytest.raises(KeyError):
        archives.located(["/x/a.zip", "/y/b.zip"], "c.zip")
    t = spark.createDataFrame([("abc",)], "release_sha256 string")
    assert identity.same_release(t, t) == "abc"
    with pytest.raises(ValueError):
        identity.same_release(t, spark.createDataFrame([("abd",)], "release_sha256 string"))


def test_person_registry(spark):
    same = spark.createDataFrame([("a", "b", "same"), ("c", "a", "same"), ("b", "c", "same"), ("a", "d", "same")], DECISIONS)
    known = spark.createDataFrame([(x, f"name {x}", 200) for x in "abcd"], "entry_id string, name string, year int")
    empty = identity.empty_registry(spark)
    person, reg = identity.create_person(empty, same, known, "a", "b", "اسم", "r", "why")
    first = identity.show_person(reg, person).first()
    assert (first.status, first.entries, [e.action for e in first.events]) == ("reviewed", ["a", "b"], ["create"])
    more = identity.add_to_person(reg, same, known, person, "c", "r", "why")
    row = identity.show_person(more, person).first()
    assert row.entries == ["a", "b", "c"] and len(row.events) == 2 and row.evidence_sha256 != first.evidence_sha256
    for bad in (lambda: identity.add_to_person(reg, same, known, person, "d", "r", "why"), lambda: identity.add_to_person(reg, same, known, "x", "c", "r", "why"), lambda: identity.create_person(reg, same, known, "a", "c", "n", "r", "why"), lambda: identity.create_person(empty, same, known, "a", "b", " ", "r", "why")):
        with pytest.raises(ValueError):
            bad()
    assert [r.status for r in identity.audit_persons(more, same).collect()] == ["reviewed"]
    assert [r.status for r in identity.audit_persons(more, same.where("left_id <> 'b'")).collect()] == ["needs_review"]


def test_late_corrections_group_their_names_anew(spark, tmp_path):
    src, out = str(tmp_path / "s"), str(tmp_path / "o")
    schema = "name string, year int"
    for rows in ([("x", 201), ("y", 305)], [("x", 209)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        ingest.regroup_dates(spark.readStream.schema(schema).parquet(src), str(tmp_path / "c"), out, "name", "year", str(tmp_path / "ck")).awaitTermination(60)
    got = {r.name: (r.years, r.bucket_size) for r in ingest.current_groups(spark, out, "name").collect()}
    assert got == {"x": ("201,209", 10), "y": ("305", 1)}


def test_chain_states(spark):
    chain = spark.createDataFrame([(1, 0, "مالك بن انس", "نافع"), (1, 1, "نافع", "سالم"), (1, 2, "سالم", "عمر"), (1, 3, "عمر", None)], "id int, i int, name string, next_name string")
    edges = spark.createDataFrame([("مالك بن انس الاصبحي", "نافع"), ("نافع", "عمر")], "student string, teacher string")
    assert [r.state for r in api.chain_edges(chain, edges).orderBy("i").collect()] == ["found", "missing", "unknown"]


def test_streams_are_idempotent(spark, tmp_path):
    src, out, bad = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "bad")
    schema = "id string, error string"
    for rows in ([("a", None), ("b", "broken")], [("a", None), ("b", None), ("c", None)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        ingest.ingest_new(spark.readStream.schema(schema).parquet(src), "id", out, bad, str(tmp_path / "ck")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    assert [r.id for r in spark.read.parquet(bad).collect()] == ["b"]
    dsrc, hist = str(tmp_path / "d"), str(tmp_path / "h")
    spark.createDataFrame([("x", "same", 1), ("x", "different", 2)], "k string, d string, at int").write.parquet(dsrc)
    ingest.latest_state(spark.readStream.schema("k string, d string, at int").parquet(dsrc), ["k"], "at", hist, str(tmp_path / "ck2")).awaitTermination(60)
    assert [r.d for r in ingest.current_state(spark, hist, ["k"], "at").collect()] == ["different"]


def test_stored_index_finds_what_a_scan_finds(spark, tmp_path):
    from quillspark.operators import search

    rows = [(1, "the red fox"), (2, "fox the red, red fox!"), (3, "foxes of the red"), (4, ""), (5, None), (6, "The  RED-fox the"), (7, "redfox")]
    docs = spark.createDataFrame(rows, "id long, text string")
    search.store(docs, "id", F.lower("text"), str(tmp_path / "i"), buckets=4)
    index = search.Index(spark, str(tmp_path / "i"), "id", buckets=4)
    for q, mode in (("the red", "words"), ("red fox", "phrase"), ("the fox", "prefix"), ("red", "words"), ("fo", "prefix"), ("red red fox", "phrase"), ("red red", "words"), ("nothing", "words")):
        scan = sorted(r.id for r in search.search(docs, "id", "text", q, mode).collect())
        assert sorted(r.id for r in index.find(q, mode).collect()) == scan, (q, mode)
    assert sorted(r.id for r in search.search(docs, "id", "text", "RED-fox", "exact").collect()) == [6]
    a = {r.id: round(r.score, 9) for r in index.ranked("red fox").collect()}
    assert a == {r.id: round(r.score, 9) for r in search.bm25(docs, "id", F.lower("text"), ["red", "fox"]).collect()} and set(a) == {1, 2, 3, 6}
