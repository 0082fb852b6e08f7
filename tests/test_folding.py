"""Native search keys equal their Python twins on random strings."""

import random

from pyspark.sql import functions as F

from quillspark.functions import arabic

PIECES = [*"ابنأإآٱىيةؤئهو ", "ابن", " ابن ", "أبو ", "عبد الله", "عبد  الرحمن", "ً", "ّ", "ٰ", "ـ", "​", "‏", "﻿", "ۖ", "٣", "٩", "\t", "\n", "\x1c", "\x1f", "\x85", " ", " ", "　", "A", "É", "_", "1", "-", "،", "🙂"]


def _strings(n=4000, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_normalize_and_name_key(spark):
    rows = list(enumerate(_strings()))
    df = spark.createDataFrame(rows, "i int, s string")
    got = df.select("i", arabic.normalize(F.col("s")).alias("n"), arabic.name_key(F.col("s")).alias("k")).collect()
    text = dict(rows)
    assert [r for r in got if r.n != arabic.fold(text[r.i])] == []
    assert [(text[r.i], r.k) for r in got if r.k != arabic.fold_name(text[r.i])] == []


def test_fold_is_stable_and_tolerant_patterns_find_marked_terms(spark):
    for s in _strings(1500, 2):
        assert arabic.fold(arabic.fold(s)) == arabic.fold(s)
    rows = [("اسناده صحيح", "قال: إِسْنَادُهُ \u064b صَحِيح."), ("اسناده صحيح", "إسناد صحيح"), ("اسناد", "أسنـاد"), ("حديث حسن", "حديث\n\u200cحسن")]
    for term, text in rows:
        got = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract("t", f"({arabic.tolerant(term)})", 1)).first()[0]
        assert bool(got) == (term in ("اسناده صحيح", "حديث حسن") and text != "إسناد صحيح")


def test_signatures_of_spellings(spark):
    pairs = [("أبو عبد الله بن رفاعة", "أبي عبدالله بن رفاعه"), ("الرؤاسي", "الرواسي")]
    apart = [("محمد بن أحمد بن علي", "محمد بن أحمد بن عمر")]
    df = spark.createDataFrame([(a, b, same) for same, ps in ((True, pairs), (False, apart)) for a, b in ps], "a string, b string, same boolean")
    assert all(r.x == r.same for r in df.select((arabic.signature(F.col("a")) == arabic.signature(F.col("b"))).alias("x"), "same").collect())
