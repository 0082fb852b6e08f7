"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is -ln(u) / w, with u a uniform number from its doc_id and text and w its quality weight; sorting a source by
key samples it without replacement in proportion to w. A source whose target is e whole epochs and a fraction takes
every document e times, and then the first documents by key whose prefix sum stays within the remaining budget. What is
still missing then, less than the next document by key has, is made up for by one of the others: the one whose size is
nearest to it, if that brings the source nearer to its target.

Only numbers are dealt out, never texts: prefix sums don't put a source into one task, as keys are cut into buckets of about
BUCKET rows, buckets are summed, and a running sum over the few bucket totals is added to those inside the buckets. Sources
are ranked and their level is found in the same way, by sums of the parts that a sort deals them into. What the mix takes
then comes down to a few numbers a source (epochs, the last row by key that fits, the filler), which are sent to the
documents where they lie: up to BROADCAST sources to every task, more by a join.

Null text has size 0, a null source is a source of its own and comes last. Rows of size 0 are taken as part of complete
epochs only. Repeated rows have equal keys: which of them is taken first doesn't show. Without documents, or without a
word in them, nothing is taken. plan() returns its own columns, mix() those of docs, whatever their names but for those
that begin with two underscores, which are used inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, materialize
from quillspark.storage import scope

WEIGHTS, SHARE, MOST, BUCKET, BROADCAST = (5, 2, 1), 1.5, 2, 2000, 100_000


def n_words(text: Column) -> Column:
    """Number of words: a word starts where a non-space follows the beginning or a space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.5 to 1.5: half, and the share of letters and single spaces among the characters."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L} ]|  +", ""))
    return F.coalesce(F.lit(0.5) + plain / F.greatest(F.length(text), F.lit(1)), F.lit(0.5))


def unit(*columns: str) -> Column:
    """A uniform double in (0, 1) from 52 bits of the columns' md5: the same on every run and in every engine."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def ranked(rows: DataFrame, order: list[Column], sums: tuple[str, ...] = ()) -> DataFrame:
    """rows as a table with `__rank`, their place in the order from 0, and `__before_x` for x in sums: the sum of x before them.

    A sort deals the rows into parts; each part is numbered and summed by itself, and then moved by what comes before it.
    The driver gets a row for each part.
    """
    dealt = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("__part", F.shiftright("__at", 33).cast("int"))
    parts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(x).alias(f"__s_{x}") for x in sums]).orderBy("__part").collect()
    moves, n, before = [], 0, {x: 0 for x in sums}
    for r in parts:
        moves.append((r["__part"], n, *[float(before[x]) for x in sums]))
        n += r["__n"]
        before = {x: before[x] + (r[f"__s_{x}"] or 0) for x in sums}
    move = dealt.sparkSession.createDataFrame(moves, "__p int, __n long" + "".join(f", __s_{x} double" for x in sums))
    own = W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(move), F.col("__part") == F.col("__p"))
    out = out.withColumn("__rank", F.col("__n") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    for x in sums:
        out = out.withColumn(f"__before_{x}", F.col(f"__s_{x}") + F.coalesce(F.sum(x).over(own), F.lit(0)))
    return out.drop("__at", "__part", "__p", "__n", *[f"__s_{x}" for x in sums])


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from source, source_size: one row a source.

    Sources in code point order, null last, weigh `weights`, repeating, and share `share` times all sizes. A target stops
    at `most` times its source's size; the excess goes to the others by weight. In the order of size over weight the
    stopped sources are a prefix. The level is what is left over the weight that is left; it rises along the prefix, which
    ends where it is below the next source's stop, and falls after it.
    """
    s = ranked(sources, [F.col("source").asc_nulls_last()]).withColumnRenamed("__rank", "__i")
    s = s.withColumn("__w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__i") % len(weights) + 1).cast("int")))
    s = s.withColumn("__cap", F.col("source_size") * float(most)).withColumn("__r", F.col("__cap") / F.col("__w"))
    s = ranked(s, [F.col("__r"), F.col("__i")], ("__cap", "__w"))
    size, weight = s.agg(F.sum("source_size"), F.sum("__w")).first()
    own = (F.lit(float(size or 0) * float(share)) - F.col("__before___cap")) / (F.lit(float(weight or 0)) - F.col("__before___w"))
    level = s.select(own.alias("own"), "__r").agg(F.max(F.when(F.col("own") <= F.col("__r"), F.col("own")))).first()[0]
    return s.select("source", "source_size", F.coalesce(F.least("__cap", F.col("__w") * F.lit(level).cast("double")), F.col("__cap")).alias("target"))


def _numbers(docs: DataFrame) -> list[Column]:
    """What the mix decides on: `__row`, a hash of the whole row, size and key."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    return [whole.alias("__row"), n_words(F.col("text")).alias("__size"), (-F.log(unit("doc_id", "text")) / quality_weight(F.col("text"))).alias("__key")]


def _place(key, doc_id, size, row) -> Column:
    """The order in a source: by key, then doc_id (null last), size and hash."""
    return F.struct(F.col(key).alias("key"), F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(size).alias("size"), F.col(row).alias("row"))


def _sent(sources: DataFrame, n: int) -> DataFrame:
    return F.broadcast(sources) if n <= BROADCAST else sources


def _decided(docs: DataFrame, weights, share: float, most: float, bucket: int) -> tuple[DataFrame, DataFrame, int]:
    """From a table with _numbers(): rows with their prefix sums, one row a source with what the mix takes of it, and the number of sources.

    rows: source, doc_id, row, size, key, at (place), end (prefix sum). sources: source, source_size, target, epochs, rest,
    cut (the place of the last row that fits), missing, filler (end and place of the row that makes up for what is missing).
    """
    rows = docs.select("source", "doc_id", F.col("__row").alias("row"), F.col("__size").alias("size"), F.col("__key").alias("key"), _place("__key", "doc_id", "__size", "__row").alias("at"))
    per = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    n = per.count()
    sources = targets(per.select("source", "source_size"), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    sources = materialize(sources.join(per.select(F.col("source").alias("__s"), F.greatest(F.lit(1), F.ceil(F.col("n") / bucket)).cast("long").alias("buckets")), F.col("source").eqNullSafe(F.col("__s"))).drop("__s"))
    own = _sent(sources.select(F.col("source").alias("__s"), "buckets", "rest"), n)
    rows = rows.join(own, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    # exp(-key) is between 0 and 1 and falls with the key: cut evenly.
    rows = rows.withColumn("b", F.least(F.col("buckets") - 1, F.floor((1 - F.exp(-F.col("key"))) * F.col("buckets"))))
    sums = rows.groupBy("source", "b").agg(F.sum("size").alias("in"))
    sums = sums.withColumn("before", F.sum("in").over(W.partitionBy("source").orderBy("b")) - F.col("in")).select(F.col("source").alias("__s"), F.col("b").alias("__b"), "before")
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("__s")) & (F.col("b") == F.col("__b"))).drop("__s", "__b")
    inside = W.partitionBy("source", "b").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    rows = materialize(rows.withColumn("end", F.col("before") + F.sum("size").over(inside)).select("source", "doc_id", "row", "size", "key", "at", "end", "rest"))
    fits = (F.col("end") <= F.col("rest")) & (F.col("size") > 0)
    cut = rows.groupBy("source").agg(F.max(F.when(fits, F.struct("end", "at"))).alias("cut"))
    left = sources.join(cut.select(F.col("source").alias("__s"), "cut"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    left = materialize(left.select("source", "source_size", "target", "epochs", "rest", F.col("cut.end").alias("upto"), F.col("cut.at").alias("cut"), (F.col("rest") - F.coalesce("cut.end", F.lit(0))).alias("missing")))
    off = F.abs(F.col("size") - F.col("missing"))
    after = rows.join(_sent(left.select(F.col("source").alias("__s"), "missing"), n), F.col("source").eqNullSafe(F.col("__s")))
    better = after.where(~fits & (F.col("size") > 0) & (off < F.col("missing")))
    one = better.groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("at.key").alias("key"), F.col("at.none").alias("none"), F.col("at.id").alias("id"), "end", "at")).alias("m"))
    one = one.select(F.col("source").alias("__s"), F.struct("m.end", "m.at").alias("filler"))
    return rows, left.join(one, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s"), n


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, bucket: int = BUCKET) -> DataFrame:
    """Each row's doc_id, source, size, source_size, target, copies and taken."""
    rows, sources, n = _decided(materialize(docs.select("doc_id", "source", *_numbers(docs))), weights, share, most, bucket)
    own = _sent(sources.select(F.col("source").alias("__s"), "source_size", "target", "epochs", "filler"), n)
    rows = rows.join(own, F.col("source").eqNullSafe(F.col("__s")))
    once_more = ((F.col("end") <= F.col("rest")) & (F.col("size") > 0)) | F.coalesce(F.col("filler") == F.struct("end", "at"), F.lit(False))
    rows = rows.withColumn("copies", (F.col("epochs") + F.when(once_more, 1).otherwise(0)).cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, bucket: int = BUCKET) -> DataFrame:
    """The mix: each row of docs as many times as it is taken, in whole copies.

    A row is taken once more than its source's epochs if its place isn't after the cut, or is the filler's. Where only some
    of several equal rows are (they share the place of the cut or of the filler), one of them stands for all.
    """
    with scope() as keep:
        numbered = keep(materialize(docs.select("*", *_numbers(docs))))  # texts are looked at once; what is decided on is read by column
        rows, sources, n = _decided(numbered, weights, share, most, bucket)
        # Equal rows at the two places: how many there are, and how many fit.
        ends = sources.select(F.col("source").alias("__s"), "epochs", F.explode(F.array_distinct(F.array(F.col("cut"), F.col("filler.at")))).alias("p"), F.col("filler.at").alias("f")).where("p IS NOT NULL")
        fits = (F.col("end") <= F.col("rest")) & (F.col("size") > 0)
        equal = rows.join(_sent(ends, n), F.col("source").eqNullSafe(F.col("__s")) & F.col("at").eqNullSafe(F.col("p")))
        equal = equal.groupBy("source", "p").agg(F.count(F.lit(1)).alias("n"), F.count_if(fits).alias("fit"), F.max(F.col("p").eqNullSafe(F.col("f")).cast("long")).alias("one"), F.max("epochs").alias("epochs"))
        equal = keep(materialize(equal.withColumn("fit", F.col("fit") + F.col("one")).where("fit BETWEEN 1 AND n - 1").select("source", "p", (F.col("epochs") * F.col("n") + F.col("fit")).alias("all"))))
        few = keep(materialize(sources.select("source", "epochs", "cut", F.col("filler.at").alias("filler"))))
    parted = equal.limit(1).count() > 0
    some = equal.groupBy("source").agg(F.collect_list(F.struct("p", "all")).alias("__parted"))  # two a source at most
    own = few.join(some.select(F.col("source").alias("__s"), "__parted"), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s") if parted else few.withColumn("__parted", F.lit(None).cast(some.schema["__parted"].dataType))
    own = _sent(own.select(F.col("source").alias("__s"), F.col("epochs").alias("__e"), F.col("cut").alias("__cut"), F.col("filler").alias("__filler"), "__parted"), n)
    found = numbered.join(own, F.col("source").eqNullSafe(F.col("__s"))).withColumn("__at", _place("__key", "doc_id", "__size", "__row"))
    more = (F.col("__size") > 0) & (F.coalesce(F.col("__at") <= F.col("__cut"), F.lit(False)) | F.coalesce(F.col("__at") == F.col("__filler"), F.lit(False)))
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def copied(taken: DataFrame) -> DataFrame:
        return taken.where("__c > 0").withColumn("__c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c")))).select(*columns)

    whole = found.withColumn("__c", (F.col("__e") + F.when(more, 1).otherwise(0)).cast("long"))
    if not parted:
        return copied(whole)
    group = F.filter("__parted", lambda x: x["p"].eqNullSafe(F.col("__at")))
    mine = whole.withColumn("__group", F.coalesce(F.size(group), F.lit(0)))
    first = mine.where("__group > 0").withColumn("__c", group[0]["all"]).dropDuplicates(["source", "doc_id", "__row"])
    return copied(mine.where("__group <= 0")).unionByName(copied(first))
