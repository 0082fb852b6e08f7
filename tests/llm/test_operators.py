"""The ten operators against brute force, and on nulls, empty tables, ties, repeated rows and clashing columns."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import bpe, chat, langid, license_scan, mixing, simhash, toxicity, url_filter

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs(spark, texts, sources=None, langs=None):
    rows = [(i, t, langs[i] if langs else "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, "word " * 30000, "en", "a", 1), (3, "???", None, "b", 3), (4, "one two three four five", "en", None, 5), (4, "one two three four five", "en", None, 5), (None, "lost", "fr", "b", 4)]
    return spark.createDataFrame(rows, DOC).withColumn("ids", F.lit("mine")).withColumn("fp", F.lit(1)).withColumn("score", F.lit("x"))


def plain_tokenizer(name):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# 7 byte-level BPE


def test_tree_encoding_equals_the_whole(spark):
    enc, rnd = plain_tokenizer(bpe.VOCABULARY), random.Random(3)
    parts = ["a", "b", "'re", "'", "'s", " ", "  ", "\n", "\t", "\r\n", "9", "12", "!", "?!", "é", "ü", "漢字", "🙂", "\u00a0", "\x1c", "\u3000", "the ", " and", "İ", "ǆ", "٣", "\u0301", "_"]
    for _ in range(1500):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))
        for leaf in (1, 2, 5, 17):
            assert bpe.encode_tree(enc, s, leaf) == enc.encode_ordinary(s), (s, leaf)


def test_tree_encoding_of_runs_without_a_boundary():
    enc = plain_tokenizer(bpe.VOCABULARY)
    for s in ("a" * 9000, "漢字" * 3000, " " * 6000, "\n" * 5000 + "x", "!" * 5000 + "a"):
        assert bpe.encode_tree(enc, s, 512) == enc.encode_ordinary(s)


@pytest.mark.parametrize("letters", ["ab", "the", "abcdefghijklmnop", "漢字日本語文章", "ñéüßaei", "0123456789", "-=", "!?.,;", "aA", "a'st", "ابن محمد"])
def test_tree_encoding_inside_long_runs(letters, monkeypatch):
    """Windows inside one match, small ones so that they often have to grow: tokens outside are those of the whole."""
    used = []
    plain = bpe._inside
    monkeypatch.setattr(bpe, "RUNS", (6, 24, 96))
    monkeypatch.setattr(bpe, "NEAR", 4)
    monkeypatch.setattr(bpe, "_inside", lambda *a: used.append(plain(*a)) or used[-1])
    rnd = random.Random(len(letters))
    for name in (bpe.VOCABULARY, chat.VOCABULARY):
        enc = plain_tokenizer(name)
        for _ in range(60):
            s = rnd.choice(["", " ", "x'", "'", "\n"]) + "".join(rnd.choice(letters) for _ in range(rnd.randint(200, 1500))) + rnd.choice(["", " end", "\n\n", "'s"])
            for leaf in (37, 128):
                assert bpe.encode_tree(enc, s, leaf) == enc.encode_ordinary(s), s
    assert any(x is not None for x in used) or letters in ("a'st", "ابن محمد", "-=")


def test_seams_of_long_runs_take_small_windows(monkeypatch):
    """In a long text without a boundary the work at a seam doesn't grow with the sides."""
    enc, seen = plain_tokenizer(bpe.VOCABULARY), []
    rnd = random.Random(24)
    s = "".join(rnd.choice("漢字日本語文章一二三大小中国人") for _ in range(60_000))

    class Watched:
        def __getattr__(self, name):
            return getattr(enc, name)

        def encode_ordinary(self, text):
            seen.append(len(text))
            return enc.encode_ordinary(text)

    assert bpe.encode_tree(Watched(), s, 2048) == enc.encode_ordinary(s) and max(seen) <= 2048


def test_round_trip_and_digests(spark, odd):
    enc = plain_tokenizer(bpe.VOCABULARY)
    got = bpe.digests(odd).collect()
    assert len(got) == 7
    want = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in got:
        ids = enc.encode_ordinary(want[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
    assert bpe.digests(odd.limit(0)).count() == 0
    assert {"lang", "fp", "score", "ids"} <= set(bpe.encode(odd).columns)


# 3 chat formatting


CONV = "conv_id long, turn long, role string, text string"
SAID = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST] ␛. ␛␛ <|turn|><|end_reply|>"), (1, 2, "assistant", None), (2, 1, None, ""), (2, None, "us\ner", "<<s>s> <|reply|>"), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (3, 0, "system", "a" * 50000)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(SAID, CONV).withColumn("ids", F.lit(0))
    turns = chat.format_turns(df)
    table = bpe.token_bytes(bpe.named(chat.VOCABULARY)[0])
    for r in turns.collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert chat.read_turn(table, ids) == (r.role, r.text)
        text = chat.render(table, ids)
        assert text.count("<|turn|>") == 1 and text.count("<|end|>") + text.count("<|end_reply|>") == 1 and "[INST]" not in text and "</s>" not in text
    got = {r.conv_id: r for r in chat.conversations(turns).collect()}
    for conv in {x[0] for x in SAID}:
        rows = sorted([x for x in SAID if x[0] == conv], key=lambda x: (x[1] is not None, x[1] or 0))
        whole = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in rows)
        loss = "".join(x[3] or "" for x in rows if x[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.conversations(chat.format_turns(df.limit(0))).count() == 0


def test_escaping_is_reversible_and_leaves_no_control_string():
    rnd, parts = random.Random(5), [*chat.CONTROL, *chat.FOREIGN, chat.ESC, ".", "<", ">", "|", "s", "/", "[", "]", "INST", " "]
    for _ in range(3000):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        e = chat.escape(s)
        assert chat.unescape(e) == s and not any(x in e for x in (*chat.CONTROL, *chat.FOREIGN))


def test_loss_mask_by_prefix_sums():
    turn, body, reply, end, end_reply = range(100, 105)
    ids = np.array([turn, 5, body, 6, end, turn, 5, reply, 7, 8, end_reply, turn, 5, reply, end_reply])
    assert ids[chat.loss_mask(ids, 100)].tolist() == [7, 8]


def test_reserved_ids_come_after_any_vocabulary(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi " * 40_000), (1, 1, "assistant", "ok")], CONV)
    for name in (chat.VOCABULARY, bpe.VOCABULARY):
        path, pattern = bpe.named(name)
        assert chat.first_id(path) == len(bpe.token_bytes(path)) > max(bpe.ranks(path).values())
        turns = chat.format_turns(df, path=path, pattern=pattern)
        assert all(np.frombuffer(r.ids, "<u4").max() < chat.first_id(path) + len(chat.CONTROL) for r in turns.collect())
        (r,) = chat.conversations(turns, path=path).collect()
        assert r.turns_sha256 == hashlib.sha256(("user\n" + "hi " * 40_000 + "\nassistant\nok\n").encode()).hexdigest() and r.loss_chars == 2


# 4 SimHash


def plain_fingerprint(text):
    import xxhash

    w = WORD.findall((text or "").encode().lower())
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(keys, fps):
    least = dict(enumerate(keys))
    while True:
        new = {i: min((least[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3), key=lambda x: (x is None, x or 0)) for i in least}
        if new == least:
            return least
        least = new


def test_near_duplicates_equal_brute_force(spark, odd):
    rnd = random.Random(1)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(n)) for n in (3, 8, 40, 200, 300, 5)]
    texts = []
    for b in base:
        for _ in range(12):
            w = b.split()
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = rnd.choice(["X", "y", "Zz"])
            texts.append(" ".join(w))
    texts += [None, "", "  ", "one", "One", base[3].upper(), "é É"]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    want = plain_components(list(range(len(texts))), fps)
    assert len(got) == len(texts)
    for i, fp in enumerate(fps):
        assert (got[i].fingerprint, got[i].component_id) == (f"{fp:016x}", want[i])
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 7 and {r.component_id for r in rows if r.doc_id in (0, 1)} == {0} and len({(r.doc_id, r.fingerprint, r.component_id) for r in rows if r.doc_id == 4}) == 1
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.keep_one(odd)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 2, 3, 4] and kept.columns == odd.columns


def test_keep_one_tells_unlike_texts_of_equal_or_no_key_apart(spark, monkeypatch):
    rnd = random.Random(12)
    a, b, c, d = (" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(60)) for _ in range(4))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (2, a), (2, d), (2, d)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOC)
    want = [(1, a), (2, d), (None, b), (None, c)]
    for most in (simhash.BROADCAST_BLOCKS, 0):  # what goes is sent as a filter, or all rows are looked up
        monkeypatch.setattr(simhash, "BROADCAST_BLOCKS", most)
        assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str) == sorted(want, key=str)
    for given in (df, df.repartition(3, "text")):
        got = [(r.doc_id, r.text) for r in simhash.keep_one(given).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_links_connect_what_all_pairs_connect(spark):
    rnd = random.Random(7)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(400):
        x = rnd.choice(fps)
        for _ in range(rnd.randint(1, 3)):
            x ^= 1 << rnd.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()]
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in found)
    up = {x: x for x in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    ours, want = [root(x) for x in fps], plain_components(fps, fps)
    assert ours == [want[i] for i in range(len(fps))]


def test_hot_keys_are_split(spark, monkeypatch):
    """Fingerprints that all share a key, split twice: what is connected stays so, and nothing else."""
    monkeypatch.setattr(simhash, "HOT", 20)
    rnd = random.Random(23)
    base = rnd.getrandbits(64)
    fps = {base}
    while len(fps) < 300:
        x = rnd.choice(sorted(fps)) if rnd.random() < 0.6 else base
        for _ in range(rnd.choice([1, 2, 3, 3, 4, 9])):
            x ^= 1 << rnd.randrange(20, 64)
        fps.add(x)
    fps = sorted(fps)
    got = simhash.links(spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")).collect()
    up = {x: x for x in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in got:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert 0 < (a ^ b).bit_count() <= 3
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    want = plain_components(fps, fps)
    assert [root(x) for x in fps] == [want[i] for i in range(len(fps))]


def test_dense_runs_give_a_forest():
    fps = np.array(sorted({0xFFFF0000 ^ (1 << i) ^ (1 << j) for i in range(40, 60) for j in range(40, 60)}), np.uint64)
    got = simhash._run_links(fps, 0)
    assert len(got) == len(fps) - 1


# 9 mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, stopped, total = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}, {}, 1.5 * sum(sizes.values())
    while True:
        free = [n for n in names if n not in stopped]
        rest = total - sum(stopped.values())
        t = {n: rest * w[n] / sum(w[m] for m in free) for n in free}
        over = [n for n in free if t[n] > 2 * sizes[n]]
        if not over:
            return {**t, **stopped}
        stopped |= {n: 2 * sizes[n] for n in over}


def test_mixing_meets_targets(spark, odd):
    rnd = random.Random(2)
    sources = [rnd.choice(["a", "b", "B", "é", None]) for _ in range(600)] + ["hot"] * 400
    texts = ["w " * rnd.randint(0, 30) for _ in sources]
    df = docs(spark, texts, sources)
    rows = mixing.plan(df, bucket=50).collect()
    size = {}
    for r in rows:
        assert r.size == len(texts[r.doc_id].split()) and r.taken in (0, r.size, 2 * r.size)
        size[r.source] = size.get(r.source, 0) + r.size
    want = plain_targets(size)
    for s in size:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {size[s]} and all(abs(r.target - want[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 16
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in mixing.plan(df.repartition(7), bucket=50).collect())
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in mixing.plan(df).collect())
    odd_rows = mixing.plan(odd).collect()
    assert len(odd_rows) == 7 and {r.size for r in odd_rows if r.doc_id in (0, 1)} == {0}
    assert mixing.mix(odd).columns == odd.columns and mixing.plan(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0
    none = mixing.plan(docs(spark, [None, ""])).collect()
    assert [(r.target, r.taken) for r in none] == [(0.0, 0)] * 2


def test_mixing_copies_of_one_row(spark):
    df = docs(spark, ["a b c"] * 6 + ["d e f g"] * 3, ["x"] * 6 + ["y"] * 3)
    df = df.withColumn("doc_id", F.lit(1).cast("long"))
    assert mixing.mix(df).count() == sum(r.copies for r in mixing.plan(df).collect())


# 1 language ID

LANGS = {"en": "the and that with over under light water", "fr": "le les une dans avec pour être été", "de": "der die und nicht auch über schön"}


def spoken(rnd, lang, n=30):
    return " ".join(rnd.choice(LANGS[lang].split()) for _ in range(n))


def test_language_id(spark, odd):
    rnd = random.Random(9)
    langs = [rnd.choice(list(LANGS)) for _ in range(300)]
    texts = [spoken(rnd, x) for x in langs]
    df = docs(spark, texts + [None, "", "123 !!"], langs=langs + ["en", None, "fr"])
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 for k, r in got.items())
    held = [k for k in range(300) if got[k].held_out]
    assert np.mean([got[k].lang_pred == langs[k] for k in held]) > 0.97
    assert {got[k].lang_pred for k in (300, 301, 302)} == {"und"} and {got[k].score for k in (300, 301, 302)} == {0.0}
    assert sorted(r.doc_id for r in langid.keep(df).collect()) == list(range(300))
    assert langid.keep(odd).columns == odd.columns and {r.score for r in langid.keep(odd).collect()} == {"x"} and langid.identify(odd).count() == 7 and langid.identify(odd.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.learn(df.limit(0))).collect()} == {"und"}


def test_learning_reads_whole_texts(spark):
    tail = spoken(random.Random(13), "fr", 400)
    f = langid.learn(docs(spark, [spoken(random.Random(14), "en", 400), "1 " * (1 << 19) + tail], langs=["en", "fr"]))
    assert f.languages == ["en", "fr"] and f.predict([tail])[0] == ["fr"]


def test_pieces_give_the_grams_of_the_whole():
    text = "\n" + spoken(random.Random(15), "de", 500) + " \u0130x\n"
    for size in langid.SIZES:
        h, ok = langid.gram_hashes(langid.letters(text), size)
        got = [langid.gram_hashes(langid.letters(text[at : at + 100 + max(langid.SIZES) - 1])[: 100 + size - 1], size) for at in range(0, len(text), 100)]
        assert np.array_equal(np.concatenate([x[y] for x, y in got]), h[ok])


def test_lang_id_never_uses_ids_or_labels(spark):
    rnd = random.Random(10)
    df = docs(spark, [spoken(rnd, x) for x in ["en", "fr", "de"] * 40], langs=["en", "fr", "de"] * 40)
    f = langid.learn(df)
    a = langid.predict(df, f).select("text", "lang_pred", "score").orderBy("text").collect()
    b = langid.predict(df.withColumn("doc_id", F.lit(5)).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None)), f).select("text", "lang_pred", "score").orderBy("text").collect()
    assert a == b


def plain_grams(text):
    """n-grams as strings, by definition: letters inside; all else is a blank."""
    low = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    return [low[i : i + n] for n in langid.SIZES for i in range(len(low) - n + 1) if " " not in low[i + 1 : i + n - 1]]


def test_popcounts_equal_sets_of_strings(spark):
    """The filter, built on executors, gives the languages that plain sets give, and counts that differ by false positives only."""
    rnd = random.Random(16)
    langs = [rnd.choice(list(LANGS)) for _ in range(90)]
    texts = [spoken(rnd, x, 40) + rnd.choice(["", " the die les", " 42 x\u00df"]) for x in langs]
    f = langid.learn(docs(spark, texts, langs=langs))
    own = {x: [g for t, y in zip(texts, langs) if y == x for g in plain_grams(t)] for x in LANGS}
    sets = {x: set(g) for x, g in own.items()}
    rate = {x: {g: own[x].count(g) / len(own[x]) for g in sets[x]} for x in LANGS}
    assert f.languages == sorted(LANGS)
    probes = [spoken(rnd, x, 25) + " zzzq wxyz" for x in LANGS] + ["\u00e9t\u00e9 die", "q"]
    n, counts = f.counts(probes)
    for i, t in enumerate(probes):
        grams = plain_grams(t)
        assert n[i] == len(grams)
        for j, x in enumerate(f.languages):
            first = sum(g in sets[x] for g in grams)
            second = sum(g in sets[x] and rate[x][g] >= langid.SHARE * max(r.get(g, 0) for r in rate.values()) for g in grams)
            for want, got, wrong in zip((first, second), counts[i, j], f.wrong[2 * j : 2 * j + 2]):
                assert abs(got - want) <= 1 + 5 * math.sqrt(n[i] * wrong)


def test_false_positives_are_taken_off():
    rng = np.random.default_rng(0)
    table = np.zeros((1 << 13, 1), np.uint8)
    own = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for i in range(langid.K):
        table[langid.slots(own, i, 1 << 13), 0] |= 1
    f = langid.filled(["a"], table)
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    hit = np.ones(20000, bool)
    for i in range(langid.K):
        hit &= table[langid.slots(other, i, 1 << 13), 0] & 1 == 1
    assert 0.2 < f.wrong[0] and abs(hit.mean() - f.wrong[0]) < 0.02 and f.wrong[1] == 0


def test_many_languages_use_wide_masks(spark):
    rnd = random.Random(17)
    words = {f"l{i:02d}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)] for i in range(70)}
    texts, langs = zip(*[(" ".join(rnd.choice(w) for _ in range(20)), x) for x, w in words.items() for _ in range(3)])
    f = langid.learn(docs(spark, list(texts), langs=list(langs)))
    assert f.table.dtype == np.uint64 and f.table.shape[1] == 3
    assert f.predict([" ".join(w) for w in words.values()])[0] == list(words)


def test_keep_rejects_unknown_writing(spark):
    rnd = random.Random(18)
    langs = [rnd.choice(list(LANGS)) for _ in range(200)]
    strange = ["".join(rnd.choice("qxzjvwkygb") for _ in range(300)), "слово дело " * 30, "12 34", None]
    df = docs(spark, [spoken(rnd, x) for x in langs] + strange, langs=langs + [None] * 4)
    assert sorted(r.doc_id for r in langid.keep(df).collect()) == list(range(200))


# 2 URL filters


def plain_verdict(url, listed, rules=url_filter.RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    p = re.sub(r"/+$", "", re.sub(r"(/index)?\.html?$", "", path))
    return host, path, None, "block" if host and re.sub(r"^(www|m)\.", "", host) + p in listed else "allow"


def test_url_filter_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    hosts = ["example.com", "WWW.Example.com", "a.net", "net", "notnet", "example.net", "m.example.org", "x.de", "É.com", "user@h.com:80"]
    urls = [rnd.choice(["http", "https"]) + "://" + rnd.choice(hosts) + rnd.choice(["", "/", "/en/", "/en/7", "/en/77.html", "/de/8", "/de/9/index.html", "/es/", "/EN/7"]) + rnd.choice(["", "?q=/en/", "#top", "/", "?"]) for _ in range(500)]
    urls += [None, "", "no scheme/en/", "http://", "://", "a://b://c/en/x", "http://example.com\nx/en/7", "http:///en/7"] + urls[:20]
    listed = {"x.de", "x.de/de/9", "example.org/de/9", "user@h.com:80/EN/7"}
    urls += ["https://example.com/en/7" + "y" * 200_000, "http://" + "x" * 100_000 + ".org/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("block", F.lit(1)).withColumn("mask", F.lit("m")).withColumn("listed", F.lit("l"))
    names = spark.createDataFrame([(x,) for x in sorted(listed)] + [(None,), ("x.de",)], "canonical string")
    for most in (url_filter.BROADCAST_BYTES, -1):  # the list is broadcast, or joined with the possible hits
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", most)
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, names).collect()}
        assert got == {i: plain_verdict(u, listed) for i, u in enumerate(urls)}
        plan = url_filter.judge(pages, names)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
        assert url_filter.judge(pages.limit(0), names).count() == 0
        assert {r.listed for r in url_filter.judge(pages, names.limit(0)).collect()} == {False}
        mine = pages.select("page_id", "block", "mask", "listed", F.lit("x.de").alias("bits"), F.lit("k").alias("__u"))
        assert url_filter.listed_urls(mine.drop("__u"), names, "bits").where("listed AND block = 1 AND mask = 'm'").count() == len(urls)


def test_list_files_and_the_generated_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# a comment\n\nhttps://www.A.com/b/index.html?x=1\nc.org/d/\n")
    assert sorted(r.canonical for r in url_filter.read_list(spark, str(tmp_path / "list.txt")).collect()) == ["a.com/b", "c.org/d"]
    got = {r.canonical for r in url_filter.generated_list(spark).collect()}
    assert got == {f"{h}/{x}/{n}" for i, h in enumerate(url_filter.list_hosts()) for x in url_filter.LIST_LANGUAGES for n in range(1000) if (n * 7 + i) % 4}


def test_bloom_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("c"))
    blocks = 3000 * url_filter.BITS_PER_URL // 64
    masks = url_filter.bloom(listed, "c", blocks)
    probe = spark.range(6000).select("id", F.concat(F.lit("u"), "id").alias("c")).withColumn("b", url_filter.block_of(F.col("c"), blocks)).withColumn("m", url_filter.bits_of(F.col("c")))
    hit = probe.join(masks, F.col("b") == F.col("block")).where(F.col("mask").bitwiseAND(F.col("m")) == F.col("m"))
    assert hit.where("id < 3000").count() == 3000 and hit.where("id >= 3000").count() < 120


# 10 license scans


def plain_licenses(text, templates=license_scan.TEMPLATES):
    def grams(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[^\W_]+|(.)", low) if x is None] and re.findall(r"[^\W_]+", low)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    g = grams(text)
    return {n: len(g & grams(t)) / len(grams(t)) for n, t in templates.items() if len(g & grams(t)) / len(grams(t)) >= license_scan.LEAST}


def license_texts(rnd, n):
    fill, texts = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split(), []
    for _ in range(n):
        t = rnd.choice(list(license_scan.TEMPLATES.values())).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            t[rnd.randrange(len(t))] = "changed"
        cut = rnd.choice([0, 0, 2])
        around = [rnd.choice(fill) for _ in range(rnd.randint(0, 40))]
        at = rnd.randint(0, len(around))
        texts.append(rnd.choice([" ", "\n", " -- "]).join(around[:at] + t[cut:] + around[at:]).swapcase())
    return texts


def test_license_scan_equals_brute_force(spark, odd, monkeypatch):
    texts = license_texts(random.Random(6), 200)
    df = docs(spark, texts)
    want = {i: plain_licenses(t) for i, t in enumerate(texts)}
    assert len({n for x in want.values() for n in x}) == len(license_scan.TEMPLATES)
    for most in (license_scan.MOST_VALUES, 10):  # in place, and joined with a stored band table
        monkeypatch.setattr(license_scan, "MOST_VALUES", most)
        rows = license_scan.scan(df).collect()
        assert {r.doc_id: {c.name: c.containment for c in r.licenses} for r in rows} == want
        assert all({c.name for c in r.licenses} <= set(r.retrieved) for r in rows)
        assert {r.n_licenses for r in license_scan.report(odd).collect()} == {0} and license_scan.report(odd).count() == 7
        assert license_scan.report(odd.limit(0)).count() == 0
        plan = license_scan.report(df)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and (most == 10 or "Exchange" not in plan)
    with pytest.raises(ValueError):
        license_scan.scan(df, {"short": "only four words here"})


def test_bands_alone_bring_up_every_template(spark):
    """Every template, short ones too, is retrieved through band values of its own windows."""
    found = license_scan.index(spark, license_scan.TEMPLATES)
    assert {t["width"] for t in found.values()} == set(license_scan.WIDTHS)
    for t in found.values():
        assert len(t["bands"]) == license_scan.bands_of(t["width"]) and all(t["bands"])
    got = license_scan.scan(docs(spark, list(license_scan.TEMPLATES.values()) + ["the " * 50, "released under the mit"])).collect()
    for name, r in zip(license_scan.TEMPLATES, got):
        assert name in r.retrieved and (name, 1.0) in {(c.name, c.containment) for c in r.licenses}
    assert got[-1].retrieved == [] and got[-2].retrieved == []


def test_copies_with_enough_containment_are_retrieved(spark):
    """Copies of the long templates with words changed, added and removed, of which four fifths of the shingles are left."""
    rnd, texts = random.Random(22), []
    for name, t in license_scan.TEMPLATES.items():
        for _ in range(12):
            words = t.split()
            while True:
                more = list(words)
                at = rnd.randrange(len(more))
                more[at : at + rnd.randint(0, 2)] = rnd.choice([[], ["other"], ["quite", "other"]])
                if plain_licenses(" ".join(more)).get(name, 0) < license_scan.LEAST:
                    break
                words = more
            texts.append((name, " ".join(words)))
    got = license_scan.scan(docs(spark, [t for _, t in texts])).collect()
    assert all(name in r.retrieved for (name, _), r in zip(texts, got))


# 6 toxicity


def test_toxicity_finds_marked_texts(spark, odd):
    rnd = random.Random(8)
    plain = ["".join(rnd.choice("cdfghklmrt") + rnd.choice("aeiou") for _ in range(3)) for _ in range(2000)]
    texts, toxic = [], []
    for _ in range(600):
        w = [rnd.choice(plain) for _ in range(rnd.randint(5, 200))]
        t = rnd.random() < 0.3
        for _ in range(rnd.randint(2, 8) if t else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["awful", "nasty", "badword", "badsome", "badness"]))
        texts.append(" ".join(w))
        toxic.append(int(t))
    df = docs(spark, texts + [None, ""])
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if i % 2] + [(9999, 1, 1), (None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.grade(df, labels).collect()}
    assert np.mean([got[i].toxic == bool(toxic[i]) for i in range(0, 600, 2)]) > 0.97
    assert not got[600].toxic and not got[601].toxic and all(0 <= r.severity <= 2 for r in got.values())
    kept = {r.doc_id for r in toxicity.keep(df, labels).collect()}
    assert kept == {k for k, r in got.items() if not r.toxic}
    assert {r.severity < 1e-9 for r in toxicity.grade(odd, labels.limit(0)).collect()} == {True}
    named = odd.withColumn("toxic", F.lit("mine")).withColumn("grade", F.lit("mine"))
    assert {(r.toxic, r.grade) for r in toxicity.keep(named, labels.limit(0)).collect()} == {("mine", "mine")}
    assert toxicity.keep(odd, labels.limit(0)).columns == odd.columns and toxicity.grade(odd.limit(0), labels).count() == 0


def test_thresholds_are_ordered_and_severity_rises():
    slots = [np.array([1, 2]), np.array([3]), np.array([3, 4])] * 40
    grades = np.array([0, 1, 2] * 40)
    m = toxicity.fit(slots, grades)
    assert (np.diff(m.thresholds) > 0).all()
    raw = np.array([m.weights[s].sum() for s in slots[:3]])
    assert (np.diff(m.severity(raw)) >= 0).all()


def test_fit_equals_a_dense_reference():
    """The same likelihood written over a dense matrix, minimised by numeric gradients with a line search."""
    rng = np.random.default_rng(19)
    x = (rng.random((240, 5)) < 0.4).astype(float)
    grades = np.digitize(x @ np.array([2.0, 1.0, 0.5, -1.0, 0.0]) + rng.logistic(size=240), [1.0, 2.5])
    weight = np.where(grades > 0, 120 / (grades > 0).sum(), 120 / (grades == 0).sum())
    l2 = 0.01

    def loss(u):
        t = np.array([u[5], u[5] + np.exp(u[6])])
        above = np.column_stack([np.ones(240), 1 / (1 + np.exp(-(x @ u[:5])[:, None] + t)), np.zeros(240)])
        mass = above[np.arange(240), grades] - above[np.arange(240), grades + 1]
        return -(weight * np.log(mass)).mean() + l2 / 2 * (u[:5] ** 2).sum()

    u, step = np.zeros(7), 1.0
    for _ in range(3000):
        g = np.array([(loss(u + d) - loss(u - d)) / 2e-5 for d in np.eye(7) * 1e-5])
        while loss(u - step * g) > loss(u) - 0.25 * step * (g @ g) and step > 1e-9:
            step /= 2
        u, step = u - step * g, min(1.0, step * 2)
    slots = [np.flatnonzero(r).astype(np.int32) + 7 for r in x]
    m = toxicity.fit(slots, grades, l2=l2, steps=3000, rate=0.02)
    assert np.allclose(m.weights[7:12], u[:5], atol=0.01) and np.allclose(m.thresholds, [u[5], u[5] + np.exp(u[6])], atol=0.01)


def test_cut_of_ties():
    """Rows of one severity are accepted or rejected together."""
    s, t = np.array([0.5] * 6 + [1.0] * 4), np.array([0, 0, 0, 0, 0, 1, 1, 1, 1, 1])
    assert 0.5 < toxicity.best_cut(s, t) < 1.0
    assert toxicity.best_cut(np.array([0.5] * 4), np.array([0, 0, 0, 1])) >= 0.5


def test_a_row_weighs_what_its_features_weigh():
    rng = np.random.default_rng(21)
    m = toxicity.Model(rng.standard_normal(toxicity.DIM), np.array([0.0, 1.0]), 1.0)
    for text in ("", "abcde abcdf abcdg abcd abc", "Eins eins zwei zweites zweiter dreizehn"):
        words = toxicity.tokens(text)
        assert abs(m.raw(words) - m.weights[toxicity.features(words)].sum()) < 1e-9 and abs(m.raw(words) - m.raw(words)) < 1e-12


def test_near_copies_count_once():
    rng = np.random.default_rng(20)
    rows = [np.sort(rng.choice(5000, 60, replace=False)).astype(np.int32) for _ in range(20)]
    copies = [np.append(r[:-2], [6000 + i, 6100 + i]).astype(np.int32) for i, r in enumerate(rows)]
    none = np.zeros(toxicity.DIM, bool)
    kept = toxicity.unlike([toxicity.sketch(s, none) for s in rows + copies])
    assert set(range(20)) <= set(kept.tolist()) and len(kept) <= 22
