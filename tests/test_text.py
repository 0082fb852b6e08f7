"""Golden cases of the text functions."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import headings, lists, native, passages, statements, tables, years
from quillspark.sources import html_pages


@pytest.mark.parametrize(("text", "year"), [("249 هـ", 249), ("١٣ هـ", 13), ("تسع وعشرين ومائتين", 229), ("ثلاث مائة وخمس عشرة", 315), ("تسعمائة وخمس", 905), ("الف واربع مائة وخمس", 1405)])
def test_stated_years(text, year):
    assert years.parse_year(text).year == year


@pytest.mark.parametrize("text", ["نحو مائتين", "بعد سنة مائتين", "سبعين", "سنة مائتين", "200 م", "2000 م", "230 أو 231", "مائتين ونيف", "", "1451 هـ", "99"])
def test_no_year(text):
    assert years.parse_year(text).year is None


def one(spark, text, make, **more):
    """make(text column) of one text."""
    df = spark.createDataFrame([(text,)], "t string").withColumns({k: F.lit(v) if not isinstance(v, tuple) else F.from_json(F.lit(v[0]), v[1]) for k, v in more.items()})
    return df.select(make(F.col("t")).alias("x")).first().x


def spans(*pairs):
    import json

    return json.dumps([{"start": a, "end": b} for a, b in pairs]), tables.SPANS


def test_name_labels(spark):
    assert one(spark, "123 - أسامة بن عمير، والد أبي المليح", years.name_label) == "أسامة بن عمير"
    assert one(spark, "1 - قال ابن حجر في مقدمته", years.name_label) is None
    assert one(spark, "", years.name_label) is None and one(spark, None, years.name_label) is None


def test_death_evidence_prefers_the_heading_and_skips_notes(spark):
    text = "محمد بن علي (ت 230 هـ)\nروى عن فلان. توفي سنة 240 هـ."
    got = years.evidence(text, [(0, text.index("\n"), len(text))], [])
    assert [x[1] for x in got] == [230] and text[got[0][4] : got[0][5]] == "(ت 230 هـ"
    text = "محمد بن علي\nنص الترجمة.\nتوفي سنة 230 هـ."
    assert years.evidence(text, [(0, 11, len(text))], [(text.index("توفي"), len(text))]) == []
    got = years.evidence(text, [(0, 11, len(text))], [])
    rows = spark.createDataFrame([(got,), ([],)], f"items array<{years.ITEM}>").select(years.decide(F.col("items")).alias("d")).collect()
    assert rows[0].d.year == 230 and (rows[1].d.year, rows[1].d.status) == (None, "no_usable_death_date")


def test_entries_of_a_page_are_told_apart():
    text = "أحمد\nتوفي سنة 230 هـ.\nعلي\nمات سنة مائتين وعشرين.\n"
    second = text.index("علي")
    got = years.evidence(text, [(0, 4, second), (second, second + 3, len(text))], [])
    assert [(x[0], x[1]) for x in got] == [(0, 230), (1, 220)]


def said(text, notes=()):
    names = [x.split(":")[0] for x in statements.STATEMENT[7:].split(",")[:10]] + ["triggers"]
    return [dict(zip(names, s, strict=True)) for s in statements.detect(text, [(0, len(text))], list(notes))]


def _kinds(rows):
    return [t[0] for r in rows for t in r["triggers"]]


def test_statements_direction_and_offsets():
    t = "رَوَى عَنْ زيد. رَوَى عَنْهُ ابنه. قال أحمد: ثِقَةٌ."
    got = said(t)
    assert _kinds(got).count("teachers") == 1 and _kinds(got).count("students") == 1
    for r in got:
        assert r["quote"] == t[r["start"] : r["end"]]
        assert all(quote == t[a:b] for _, a, b, quote in r["triggers"])


def test_statement_layers_are_apart():
    t = "قال أحمد: ثقة. قال المحقق: ضعيف."
    got = said(t, [(t.index("قال المحقق"), len(t))])
    assert [(r["origin"], r["attribution_text"]) for r in got] == [("main_text", "أحمد"), ("footnote", "المحقق")]


def test_a_line_of_its_own_says_who_speaks():
    t = "كلام.\nقال أبو حاتم:\nصدوق في نفسه."
    (got,) = said(t)
    assert got["attribution_text"] == "أبو حاتم" and got["quote"].startswith("قال أبو حاتم")


def test_report_assessment_has_no_speaker():
    got = said("قال أحمد: إسناده ضعيف.")[0]
    assert got["subject_status"] == "possible_report_or_chain_assessment" and got["attribution_text"] is None


def test_statements_share_a_quote_and_keep_whole_triggers():
    got = said("ولد سنة مائتين وتوفي سنة ثلاثمائة.")
    assert len(got) == 1 and set(_kinds(got)) == {"birth", "death"}
    t = "روى\nعن زيد " + "لفظ محفوظ " * 200 + " ثقة."
    got = said(t)
    assert {r["quote_scope"] for r in got} == {"clause", "context_window"} or {r["quote_scope"] for r in got} == {"context_window"}
    for r in got:
        assert r["quote"] == t[r["start"] : r["end"]] and all(b <= r["end"] for _, _, b, _ in r["triggers"])
    assert _kinds(said("\u200cوَتُوُفِّيَ سنة ثلاثمائة.")) == ["death"]


def test_regions_of_a_page_are_read_together():
    t = "ثقة.\nضعيف.\n"
    got = statements.detect(t, [(0, 5), (5, len(t))], [])
    assert [(s[0], s[3]) for s in got] == [(0, "ثقة."), (1, "ضعيف.")]


def test_relationship_lists(spark):
    got = one(spark, "روى عن: إبراهيم التيمي، وخيثمة بن عبد الرحمن. روى عنه: عبد الأعلى بن حماد، وأبو داود الطيالسي.", lists.relationships)
    assert (set(got.teachers), set(got.students)) == ({"ابراهيم التيمي", "خيثمة بن عبد الرحمن"}, {"عبد الاعلي بن حماد", "ابو داود الطيالسي"})
    got = one(spark, "روى عنه ابن الغسيل. وله أخبار أخرى.", lists.relationships)
    assert (got.teachers, got.students) == ([], ["ابن الغسيل"])
    assert one(spark, None, lists.relationships).teachers == []


def test_chain_order_and_end(spark):
    assert one(spark, "قال: حدثنا عبد الله بن يوسف، قال: أخبرنا مالك عن نافع عن ابن عمر أن رسول الله قال", lists.chain) == ["عبد الله بن يوسف", "مالك", "نافع", "ابن عمر"]
    assert one(spark, "", lists.chain) == [] and one(spark, "كلام بلا سند", lists.chain) == []


def test_grades(spark):
    got = one(spark, "12 - حديث متن إِسْنَادُهُ  ضعيف", lambda t: lists.claims(t, F.col("n")), n=spans())
    assert [(c.status, c.origin, c.scope, c.quote) for c in got] == [("weak", "text", "chain", "إِسْنَادُهُ  ضعيف")]
    text = "13 - هذا حديث حسن\nوقال: إسناده ضعيف"
    got = one(spark, text, lambda t: lists.claims(t, F.col("n")), n=spans((18, len(text))))
    assert {(c.status, c.origin) for c in got} == {("hasan", "text"), ("weak", "note")}
    far = text[:18] + "كلام " * 40 + text[18:]
    assert {c.status for c in one(spark, far, lambda t: lists.claims(t, F.col("n")), n=spans((18, len(far))))} == {"hasan"}
    assert one(spark, text, lambda t: lists.report_numbers(t, F.array(F.lit(0), F.lit(3)))) == ["13"]


def test_matches_and_running_sums(spark):
    text = "x🙂ab" * 700 + "ab"
    got = one(spark, text, lambda t: native.matches(t, "ab|b"))
    import re

    assert [(m.start, m.end, m.quote) for m in got] == [(m.start(), m.end(), m[0]) for m in re.finditer("ab|b", text)]
    n = list(range(1000))
    assert spark.createDataFrame([(n,)], "n array<long>").select(native.running(F.col("n")).alias("x")).first().x == [sum(n[: i + 1]) for i in n]
    assert spark.createDataFrame([([],)], "n array<long>").select(native.running(F.col("n")).alias("x")).first().x == []


def test_small_passage_functions(spark):
    assert one(spark, "aXbX", lambda t: passages.places(t, F.lit("X"))) == [1, 3] and one(spark, "aaa", lambda t: passages.places(t, F.lit("aa"))) == [0, 1]
    assert one(spark, "a\\Eb\\E", lambda t: passages.places(t, F.lit("\\E"))) == [1, 4]

    def fnv(text):
        h, units = 2166136261, text.encode("utf-16-le")
        for i in range(0, len(units), 2):
            h = (h ^ int.from_bytes(units[i : i + 2], "little")) * 16777619 & 0xFFFFFFFF
        out = ""
        while h:
            out, h = "0123456789abcdefghijklmnopqrstuvwxyz"[h % 36] + out, h // 36
        return out

    for text in ("", "abc", "أسامة 🙂", "x" * 500):
        assert one(spark, text, passages.page_locator) == fnv(text)
    assert one(spark, "أُسَامَةُ إلى ABC", passages.reader_fold) == "اسامه الي abc"
    got = one(spark, "كلام " * 30 + "قال أُسَامَة بن زيد " + "كلام " * 90, lambda t: passages.excerpt(t, ["اسامة"]))
    assert got.start == 150 + 4 - 65 and "أُسَامَة" in got.text and got.end - got.start == 340
    assert one(spark, "نص قصير", lambda t: passages.excerpt(t, ["غيره"])).text == "نص قصير"


BOOK = """<html><head><title>كتاب</title></head><body><div class="PageText"><p>الكتاب: سنن</p><p>المؤلف: فلان</p></div>
<div class="PageText" id="p2"><div class="PageHead"><span class="PartName">1</span><span class="PageNumber">7</span>رأس</div><span class="title" id="t">1 - أحمد بن محمد بن زيد</span>روى عن أبيه. كلام</p>بقية<div class="footnote">توفي سنة 9</div></div></body></html>"""


def test_pages_of_a_book(spark):
    from quillspark.plans import corpus
    from quillspark.sources import archives

    got = html_pages.parse(BOOK.encode())
    assert not got["fallback"] and got["markers"] == 2 and got["metadata"]["الكتاب"] == "سنن"
    page = got["pages"][1]
    assert (page["label"], page["part"], page["anchor"]) == ("7", "1", "p2")
    assert "رأس" not in page["text"] and "كلام\nبقية" in page["text"]
    assert [s[0] for s in page["spans"]] == ["heading", "footnote", "anchor"]
    assert BOOK.encode()[page["raw_start"] :].startswith(b'<div class="PageText" id="p2">') and page["raw_end"] == len(BOOK.encode())
    rows = spark.createDataFrame([("p", False, page["text"], [{"start": a, "end": b} for a, b in page["titles"]], page["number_starts"], archives._page_rows([page])[0]["spans"])], f"page_id string, is_metadata boolean, text string, titles {tables.SPANS}, number_starts array<int>, spans array<{archives.SPAN}>")
    heads = corpus.entries(rows)
    (e,) = heads.collect()
    assert e.kind == "biography_heading_candidate" and page["text"][e.start_offset : e.end_offset] == e.title
    assert [(m.kind, m.entry_id, m.evidence) for m in corpus.mentions(rows, heads).where("NOT in_footnote").collect()] == [("teacher_mention", e.entry_id, "روى عن أبيه")]
    assert corpus.entries(rows.withColumn("is_metadata", F.lit(True))).count() == 0


def test_numbered_lines_and_chapters(spark):
    text = "12 -\nمحمد بن عبد الله بن زيد\nباب بن زيد في الطهارة\n13 - نص بلا اسم معروف\n"
    found = one(spark, text, lambda t: headings.candidates(t, F.col("titles"), F.col("numbers"), F.col("notes")), titles=spans((29, 51)), numbers=("[0, 52]", "array<int>"), notes=spans())
    assert [(c.start, c.kind) for c in found] == [(0, "numbered_entry_candidate")] and found[0].title.endswith("زيد")


def test_fallback_encoding_and_mismatch():
    got = html_pages.parse("<body>نص</body>".encode("cp1256"))
    assert got["fallback"] and got["encoding"] == "cp1256" and got["pages"][0]["text"].strip() == "نص"
    with pytest.raises(ValueError):
        html_pages.parse(b"<div class='PageText'>a</div><!-- <div class='PageText'> -->")
