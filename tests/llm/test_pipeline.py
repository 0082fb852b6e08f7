"""The pipeline's stages and run() against plain Python written apart from them, and the registered queries."""

import base64
import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark import storage
from quillspark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPOKEN = {"en": "the and that with over under light water house river stone", "fr": "le les une dans avec pour être été maison forêt", "de": "der die und nicht auch über schön wasser haus straße"}
INSULTS = ["vilefool", "vilefolk", "nastygit", "rotbrain"]
STAGE = dict(corpus_pipeline.STAGES)


def corpus(rnd):
    """Rows of documents, which of them are toxic, and which have no language."""
    rows, toxic, strange = [], set(), set()
    for i in range(360):
        lang = rnd.choice(sorted(SPOKEN))
        words = [rnd.choice(SPOKEN[lang].split()) + rnd.choice(["", "", "s", "en"]) for _ in range(rnd.randint(12, 90))]
        if i % 5 == 0:
            toxic.add(i)
            for _ in range(rnd.randint(4, 9)):
                words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        rows.append([i, " ".join(words), lang, rnd.choice(["a", "b", "c", "d", None, "a", "a"]), 1])
    for i in range(360, 380):  # exact copies, and copies with another case
        rows.append([i, rows[i - 300][1].upper() if i % 2 else rows[i - 300][1], rows[i - 300][2], "b", 1])
        if i - 300 in toxic:
            toxic.add(i)
    for i, t in enumerate([None, "", "12 34 !!", "слово дело " * 20]):
        rows.append([380 + i, t, None, "a", 0])
        strange.add(380 + i)
    return [tuple(r) for r in rows], toxic, strange


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("made"))
    rows, toxic, strange = corpus(random.Random(31))
    spark.createDataFrame(rows, DOC).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, *_ in rows if i % 4], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where, rows, toxic, strange


def plain_fingerprint(text):
    import xxhash

    w = [x for x in regex.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_single(rows):
    """The first id of each group of rows that links of 3 bits connect."""
    fps = [plain_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    return [r for i, r in enumerate(rows) if group[i] == i]


def plain_mix(rows):
    """How often each id is taken: whole documents in the order of their keys, and one that fits what is missing."""
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {r[0]: len([x for x in regex.split(r"[\x20\x09-\x0D]+", r[1] or "") if x]) for r in rows}
    total = {n: sum(size[r[0]] for r in rows if r[3] == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, budget = {}, 1.5 * sum(total.values())
    while len(target) < len(names):
        free = [n for n in names if n not in target]
        rest = budget - sum(target.values())
        over = [n for n in free if rest * weight[n] / sum(weight[m] for m in free) > 2 * total[n]]
        target |= {n: 2 * total[n] for n in over} if over else {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}

    def key(r):
        u = (int(hashlib.md5(f"{r[0]}\x01{r[1] or ''}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        quality = 0.5 + len(regex.sub(r"[^\p{L} ]|  +", "", r[1])) / max(1, len(r[1])) if r[1] is not None else 0.5
        return -math.log(u) / quality

    out = Counter()
    for n in names:
        mine = sorted((r for r in rows if r[3] == n), key=lambda r: (key(r), r[0]))
        epochs = int(target[n] // total[n]) if total[n] else 0
        left = target[n] - epochs * total[n]
        out.update({r[0]: epochs for r in mine})
        after, upto = [], 0
        for r in mine:
            upto += size[r[0]]
            if size[r[0]] and upto <= left:
                out[r[0]] += 1
                fitted = upto
            elif size[r[0]]:
                after.append(r)
        missing = left - (fitted if any(out[r[0]] > epochs for r in mine) else 0)
        after = [r for r in after if abs(size[r[0]] - missing) < missing]
        if after:
            out[min(after, key=lambda r: (abs(size[r[0]] - missing), key(r), r[0]))[0]] += 1
    return {i: n for i, n in out.items() if n}


def ids_of(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_equals_plain_python(spark, made):
    where, rows, toxic, strange = made
    docs = storage.table(spark, where, "documents")
    spoken = STAGE["language_id"](spark, docs, where)
    rows = [r for r in rows if r[0] not in strange]
    assert ids_of(spoken) == [r[0] for r in rows]
    clean = STAGE["toxicity"](spark, spark.createDataFrame(rows, DOC), where)
    rows = [r for r in rows if r[0] not in toxic]
    assert ids_of(clean) == [r[0] for r in rows]
    single = STAGE["simhash_dedup"](spark, spark.createDataFrame(rows, DOC), where)
    rows = plain_single(rows)
    assert ids_of(single) == [r[0] for r in rows]
    mixed = STAGE["mixing"](spark, spark.createDataFrame(rows, DOC), where)
    want = plain_mix(rows)
    assert Counter(ids_of(mixed)) == want
    assert all(df.columns == docs.columns for df in (spoken, clean, single, mixed))


def test_run_equals_plain_python_and_leaves_one_table(spark, made, monkeypatch):
    import public_tokenizers
    import tiktoken

    where, rows, toxic, strange = made
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    got = corpus_pipeline.run(spark, where)
    assert len(set(os.listdir(shared)) - before) == 1  # the last stage's rows
    want = plain_mix(plain_single([r for r in rows if r[0] not in toxic | strange]))
    text = {r[0]: r[1] for r in rows}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == want and got.columns == [*DOC.replace(",", "").split()[::2], "ids", "n_tokens", "round_trip"]
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids) // 4 and r.round_trip


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and further columns with names used elsewhere."""
    long_ = "the water and the light " * 20_000
    rows = [(0, None, None, None, None), (None, "", "en", "a", 0), (2, long_, "en", "a", 1), (None, "der die und", "de", "b", 3), (4, "le les une dans avec", "fr", None, 5), (4, "le les une dans avec", "fr", None, 5), (5, "over under light", None, "b", None)]
    more = {c: F.lit("mine") for c in ("severity", "grade", "toxic", "fp", "row", "at", "key", "size", "score", "lang_pred", "l", "t", "k", "fingerprint", "copies", "ids", "n_tokens")}
    return spark.createDataFrame(rows, DOC).withColumns(more)


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_take_odd_rows_and_empty_tables(spark, made, odd, name):
    where = made[0]
    got = STAGE[name](spark, odd, where)
    rows = got.collect()
    if name == "bpe":
        assert len(rows) == 7 and all(r.round_trip and r.size == "mine" for r in rows) and {r.n_tokens for r in rows if r.text in (None, "")} == {0}
        assert sorted(got.columns) == sorted([*odd.columns, "round_trip"])
    else:
        assert got.columns == odd.columns and all(r.severity == r.key == "mine" for r in rows)
    kept = Counter(r.text[:20] if r.text else r.text for r in rows)
    if name == "language_id":
        assert kept[None] == kept[""] == 0 and kept["le les une dans avec"] == 2
    if name == "toxicity":
        assert len(rows) == 7
    if name == "simhash_dedup":
        assert kept["le les une dans avec"] == 1 and kept[None] + kept[""] == 1 and len(rows) == 5
    empty = STAGE[name](spark, odd.limit(0), where)
    assert empty.count() == 0 and empty.columns == got.columns


def test_labels_may_be_empty(spark, made, tmp_path):
    where = made[0]
    storage.table(spark, where, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = storage.table(spark, where, "documents")
    assert STAGE["toxicity"](spark, docs, str(tmp_path)).count() == docs.count()


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_dedup", "mixing", "bpe"]


@here
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for n in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    got, want = queries()[name](spark, SF).toPandas(), con.execute(oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 11)) and "pipeline" in queries()
