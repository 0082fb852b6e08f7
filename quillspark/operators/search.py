"""Full-text search: words, phrase, prefix, exact, BM25, by a scan or a stored index (Q1 to Q8)."""

from __future__ import annotations

import math
import re
import zlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.storage import materialize

EDGE = r"[\p{L}\p{N}\p{Co}]"
TOKEN = EDGE + "+"
#: Standard BM25 parameters; a query has at most so many tokens and characters.
K1, B, MOST_TOKENS, MOST_CHARS, BUCKETS = 1.2, 0.75, 20, 200, 64
MODES = ("words", "phrase", "prefix", "exact")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))


def parse(query: str, mode: str, normalize=str.lower) -> list[str]:
    """The tokens of a query, which is data and never operators; raises for empty or oversized ones."""
    import regex

    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not query or len(query) > MOST_CHARS:
        raise ValueError(f"a query has 1 to {MOST_CHARS} characters")
    found = regex.findall(TOKEN, normalize(query))
    if not 1 <= len(found) <= MOST_TOKENS:
        raise ValueError(f"a query has 1 to {MOST_TOKENS} words")
    return found


def matches(text: Column, words: list[str], mode: str) -> Column:
    """Whether a normalized text matches: a predicate of a scan, without tokens, join or shuffle.

    Every word costs a plain substring test first, and a pattern with token edges only where that holds.
    """
    left, right, gap = f"(?<!{EDGE})", f"(?!{EDGE})", f"[^{EDGE[1:-1]}]+"
    if mode == "phrase":
        first = F.lit(True)
        for w in words:
            first = first & F.contains(text, F.lit(w))
        return first & text.rlike(left + gap.join(map(re.escape, words)) + right)
    out = F.lit(True)
    for i, w in enumerate(words):
        open_ = mode == "prefix" and i == len(words) - 1
        out = out & F.contains(text, F.lit(w)) & text.rlike(left + re.escape(w) + ("" if open_ else right))
    return out


def search(docs: DataFrame, key: str, text: str, query: str, mode: str = "words", normalize=F.lower, fold=str.lower, only: DataFrame | None = None) -> DataFrame:
    """Rows of docs that match in one of the modes; only: keys of the books asked for (Q7)."""
    got = docs.where(matches(normalize(F.col(text)), parse(query, mode, fold), mode))
    if mode == "exact":
        got = got.where(F.contains(F.col(text), F.lit(query)))
    return got if only is None else got.join(only, key, "left_semi")


def bm25(docs: DataFrame, key: str, text: Column, words: list[str]) -> DataFrame:
    """key, score of documents with any of the words; larger is better (Q6). text is normalized.

    Lengths and term counts come from each row by itself. One aggregate row, with n, the mean length and a count for each
    of the query's words, is all that the driver sees.
    """
    counted = docs.select(key, F.regexp_count(text, F.lit(TOKEN)).alias("dl"), *[F.when(F.contains(text, F.lit(w)), F.regexp_count(text, F.lit(f"(?<!{EDGE}){re.escape(w)}(?!{EDGE})"))).otherwise(0).alias(f"tf{i}") for i, w in enumerate(words)])
    counted = materialize(counted)  # a few numbers a row, so that texts are read once
    stats = counted.where("dl > 0").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(words))]).first()
    score, any_ = F.lit(0.0), F.lit(False)
    for i in range(len(words)):
        df, tf = stats[f"df{i}"], F.col(f"tf{i}")
        any_ = any_ | (tf > 0)
        score = score + math.log((stats["n"] - df + 0.5) / (df + 0.5) + 1) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / (stats["mean"] or 1.0)))
    return counted.where(any_).select(key, score.alias("score"))


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """token, key, positions of normalized texts (Q1): a text's positions are put together where it lies, without a shuffle."""
    schema = T.StructType([T.StructField("token", T.StringType()), docs.schema[key], T.StructField("positions", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                words, keys, places = [], [], []
                for k, found in zip(b.column(0).slice(at, 256).to_pylist(), b.column(1).slice(at, 256).to_pylist(), strict=True):
                    own: dict[str, list[int]] = {}
                    for i, w in enumerate(found or ()):
                        own.setdefault(w, []).append(i)
                    words += own
                    keys += [k] * len(own)
                    places += own.values()
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(keys, b.schema.field(0).type), pa.array(places, pa.list_(pa.int32()))], ["token", key, "positions"])

    return docs.select(key, tokens(text).alias("w")).mapInArrow(run, schema)


def _part(token: Column, buckets: int) -> Column:
    return (F.crc32(token.cast("binary")) % buckets).cast("int")


def store(docs: DataFrame, key: str, text: Column, path: str, buckets: int = BUCKETS, salts: int = 4) -> None:
    """An inverted index: postings partitioned by token hash and sorted by token, and each document's length.

    One shuffle, by token hash and one of `salts` parts of the keys: a word that every text has is dealt to several tasks.
    """
    post = postings(docs, key, text).withColumn("part", _part(F.col("token"), buckets))
    salt = F.pmod(F.xxhash64(key), F.lit(salts))
    post.repartition(buckets * salts, "part", salt).sortWithinPartitions("part", "token").write.partitionBy("part").parquet(f"{path}/postings")
    docs.select(key, F.regexp_count(text, F.lit(TOKEN)).alias("dl")).write.parquet(f"{path}/lengths")


def _moved(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


class Index:
    """A stored index. A query reads the partitions of its tokens only; a prefix reads all, pruned by token statistics."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.post, self.lengths = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/lengths")
        self.n, self.mean = self.lengths.where("dl > 0").agg(F.count(F.lit(1)), F.avg("dl")).first()

    def _of(self, words: list[str]) -> DataFrame:
        return self.post.where(F.col("part").isin(sorted({zlib.crc32(w.encode()) % self.buckets for w in words})) & F.col("token").isin(sorted(set(words))))

    def find(self, query: str, mode: str = "words", fold=str.lower) -> DataFrame:
        """Keys that match; of `exact`, the candidates that the source text is then asked for."""
        words = parse(query, mode, fold)
        whole = words[:-1] if mode == "prefix" else words
        if mode == "prefix":
            tail = self.post.where(F.col("token").startswith(words[-1])).select(self.key).distinct()
            return tail.join(self._all(whole).select(self.key), self.key, "left_semi") if whole else tail
        rows = self._all(words)
        if mode == "phrase" and len(words) > 1:
            starts = [_moved(F.element_at("places", w), i) for i, w in enumerate(words)]
            rows = rows.where(F.size(reduce(F.array_intersect, starts)) > 0)
        return rows.select(self.key)

    def _all(self, words: list[str]) -> DataFrame:
        """Keys that hold all of the words, with their places by word. A word has one posting for a key."""
        few = sorted(set(words))
        if len(few) == 1:
            return self._of(few).select(self.key, F.create_map("token", "positions").alias("places"))
        got = self._of(few).groupBy(self.key).agg(F.collect_list(F.struct("token", "positions")).alias("p"))
        return got.where(F.size("p") == len(few)).select(self.key, F.map_from_entries("p").alias("places"))

    def ranked(self, query: str, fold=str.lower) -> DataFrame:
        """key, score of documents with any of the words."""
        words = parse(query, "words", fold)
        rows = self._of(words)
        df = {r["token"]: r["df"] for r in rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).collect()}  # the query's words
        idf = F.lit(0.0)
        for w in dict.fromkeys(words):
            idf = F.when(F.col("token") == w, math.log((self.n - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5) + 1) * words.count(w)).otherwise(idf)
        tf = F.size("positions")
        part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / self.mean))
        return rows.join(self.lengths, self.key).groupBy(self.key).agg(F.sum(part).alias("score"))
