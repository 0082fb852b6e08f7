"""Candidate pairs: shared texts, overlapping name lists, vetoes, dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.storage import materialize

#: Rows of one key that are dealt to a block, and pairs that a task makes, about.
_BLOCK, _TASK = 1000, 2_000_000
#: Members of a pack, about: a pair of packs, which a task holds, gives the square of it.
_PACK = 128


def shared_text_pairs(rows: DataFrame, member: str, text: str, cap: int | None = None, within: str | None = None, differ: str | None = None) -> DataFrame:
    """left_id, right_id, shared: pairs of members with the same text, and how many distinct texts.

    cap: texts that more members of a group hold are skipped. within: pairs must agree in this column. differ: and not
    agree in that one. Texts are counted first, so that those of a single member, which are most, don't reach the join.
    """
    keys = [text] + ([within] if within else [])
    kept = list(dict.fromkeys([member, *keys, *([differ] if differ else [])]))
    rows = rows.select(*kept).where(F.col(text).isNotNull()).distinct()
    sizes = rows.groupBy(*keys).agg(F.countDistinct(member).alias("__n")).where(F.col("__n") >= 2 if cap is None else F.col("__n").between(2, cap))
    rows = rows.join(sizes.drop("__n"), keys, "left_semi")
    left, right = rows.alias("l"), rows.alias("r")
    on = F.col(f"l.{member}") < F.col(f"r.{member}")
    for k in keys:
        on = on & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    if differ:
        on = on & (F.col(f"l.{differ}") != F.col(f"r.{differ}"))
    found = left.join(right, on).select(F.col(f"l.{member}").alias("left_id"), F.col(f"r.{member}").alias("right_id"), F.col(f"l.{text}").alias("__t"))
    # (member, text) is distinct, unless a member comes with two values of `differ`.
    return found.groupBy("left_id", "right_id").agg((F.countDistinct("__t") if differ else F.count(F.lit(1))).alias("shared"))


def packs(rows: DataFrame, member: str, alike: list[str]) -> DataFrame:
    """pack, weight, the columns of `alike`, and own: members that agree in these, with their other columns, _PACK or so to a
    pack. rows: one or more of each member, all of which are in one pack."""
    rows = materialize(rows)
    sizes = rows.groupBy(*alike).agg(F.ceil(F.count(F.lit(1)) / _PACK).cast("int").alias("__packs"))
    dealt = rows.join(sizes, alike).withColumn("__p", F.pmod(F.xxhash64(member), F.col("__packs")))
    got = dealt.groupBy(*alike, "__p").agg(F.count(F.lit(1)).alias("weight"), F.collect_list(F.struct(member, *[c for c in rows.columns if c not in (member, *alike)])).alias("own"))
    return materialize(got.select(F.monotonically_increasing_id().alias("pack"), "weight", *alike, "own"))


def unpacked(met: DataFrame, member: str, before: tuple[str, ...], after: tuple[str, ...], ordered: bool = True) -> DataFrame:
    """Pairs of members, of pairs of packs: left_own, right_own, and same where these are one pack. The ends come out as left_id
    and right_id, the lesser first if they are to be ordered, what is known of them as left_... and right_..., between columns
    of the packs' pair."""
    fields = met.schema["left_own"].dataType.elementType.names
    kept = [*before, *after, "same"]
    # The left end's columns are taken before the right ends meet it: once, not for each of them.
    left = met.select(*kept, "right_own", F.explode("left_own").alias("__l")).select(*kept, "right_own", *[F.col(f"__l.{c}").alias(f"__l_{c}") for c in fields])
    got = left.select(*kept, *[f"__l_{c}" for c in fields], F.explode("right_own").alias("__r"))
    first = F.col(f"__l_{member}") < F.col(f"__r.{member}")

    def ends(c: str) -> list[Column]:
        l, r, name = F.col(f"__l_{c}"), F.col(f"__r.{c}"), "id" if c == member else c
        both = (F.when(first, l).otherwise(r), F.when(first, r).otherwise(l)) if ordered else (l, r)
        return [x.alias(f"{end}_{name}") for end, x in zip(("left", "right"), both, strict=True)]

    return got.where(~F.col("same") | first).select(*before, *[x for c in fields for x in ends(c)], *after)


def meetings(rows: DataFrame, member: str, keys: list[str], within: str | None = None, of: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """left_id, right_id, shared, and `within`: pairs of members with keys in common, each once, and how many keys they share.

    of: what is known of members, by member and `within`; its columns come out as left_... and right_..., and members that
    it lacks are left out. Each row knows its member's other keys, so that a pair is made at its least key only and counted
    there: rows travel, pairs never do. Rows of a key that many hold are dealt to blocks, which meet two by two. weight: how
    many a member stands for, if it is a pack; then a block has fewer of them.
    """
    who, keys = [member, *([within] if within else [])], list(dict.fromkeys([*keys, *([within] if within else [])]))
    rows = rows.select(*dict.fromkeys([member, *keys, *([weight] if weight else [])])).dropna().distinct()
    block, task = (_BLOCK, _TASK) if weight is None else (4 * _BLOCK, 4 * _TASK)
    count = F.count(F.lit(1))
    held = materialize(rows.groupBy(*keys).agg((F.sum(weight) if weight else count).alias("__n"), count.alias("__rows")).where("__rows > 1").drop("__rows").withColumn("__k", F.monotonically_increasing_id()))
    rows = materialize(rows.join(held, keys).select(*who, "__k", "__n"))
    parts = (held.agg(F.sum(F.col("__n") * F.col("__n") / 2)).first()[0] or 0) // task
    known = rows.groupBy(*who).agg(F.sort_array(F.collect_list("__k")).alias("__ks"))
    more = [c for c in of.columns if c not in who] if of is not None else []
    rows = rows.join(known if of is None else known.join(of, who), who)
    blocks = F.ceil(F.col("__n") / block).cast("int")
    rows = rows.withColumn("__blocks", blocks).withColumn("__b", F.pmod(F.xxhash64(member), F.col("__blocks")).cast("int"))
    others = [F.filter("__ks", lambda x: x < F.col("__k")), F.filter("__ks", lambda x: x > F.col("__k"))]

    def side(s: str, i: Column, j: Column) -> DataFrame:
        own = [F.col(c).alias(f"{s}{c}") for c in (member, *more)] + [o.alias(f"{s}{n}") for o, n in zip(others, ("__before", "__after"), strict=True)]
        got = rows.select("__k", *([within] if within and s == "l" else []), i.alias("__i"), j.alias("__j"), *own)
        return got.repartition(int(parts), "__k", "__i", "__j") if parts > 1 else got

    b = F.col("__b")
    left, right = side("l", b, F.explode(F.sequence(b, F.col("__blocks") - 1))), side("r", F.explode(F.sequence(F.lit(0), b)), b)
    l, r = F.col(f"l{member}"), F.col(f"r{member}")
    got = left.join(right, ["__k", "__i", "__j"]).where(((F.col("__i") < F.col("__j")) | (l < r)) & ~F.arrays_overlap("l__before", "r__before"))
    common = F.when((F.size("l__after") > 0) & (F.size("r__after") > 0), F.size(F.array_intersect("l__after", "r__after"))).otherwise(0)
    ends = [F.when((l < r) == first, F.col(f"l{c}")).otherwise(F.col(f"r{c}")).alias(f"{end}_{'id' if c == member else c}") for c in (member, *more) for end, first in (("left", True), ("right", False))]
    return got.select(*([within] if within else []), *ends, (common + 1).cast("long").alias("shared"))


def representative_edges(rows: DataFrame, member: str, text: str, within: str | None = None) -> DataFrame:
    """left_id, right_id: each member of a text with the least one (A26). They connect what all of the text's pairs connect:
    a text of n members gives n - 1 edges, and one that everybody holds isn't a square of them."""
    keys = [text] + ([within] if within else [])
    rows = rows.select(member, *keys).where(F.col(text).isNotNull()).distinct()
    least = rows.groupBy(*keys).agg(F.min(member).alias("left_id"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return rows.join(least, keys).where(F.col("left_id") != F.col(member)).select("left_id", F.col(member).alias("right_id")).distinct()


def members_of(pairs: DataFrame) -> DataFrame:
    """Each entry that is in a pair, once."""
    return pairs.select(F.explode(F.array("left_id", "right_id")).alias("entry_id")).distinct()


def overlap_pairs(rows: DataFrame, group: str, member: str, item: str, least: int = 1, most_group: int | None = None) -> DataFrame:
    """group, left_id, right_id, common (sorted), n_common: pairs of a group with items in common.

    most_group: larger groups are left out, as a documented limit of the operator. Items meet by an equi-join: pairs
    without a common item never exist.
    """
    rows = rows.select(group, member, item).distinct()
    if most_group is not None:
        small = rows.groupBy(group).agg(F.countDistinct(member).alias("__n")).where(F.col("__n").between(2, most_group)).select(group)
        rows = rows.join(small, group, "left_semi")
    left, right = rows.alias("l"), rows.alias("r")
    on = (F.col(f"l.{group}") == F.col(f"r.{group}")) & (F.col(f"l.{item}") == F.col(f"r.{item}")) & (F.col(f"l.{member}") < F.col(f"r.{member}"))
    got = left.join(right, on).groupBy(F.col(f"l.{group}").alias(group), F.col(f"l.{member}").alias("left_id"), F.col(f"r.{member}").alias("right_id"))
    return got.agg(F.array_sort(F.collect_list(F.col(f"l.{item}"))).alias("common")).withColumn("n_common", F.size("common").cast("long")).where(F.col("n_common") >= least)


def literal_priority(shared: Column) -> Column:
    """strong_literal from two shared texts on."""
    return F.when(shared >= 2, "strong_literal").otherwise("one_literal")


def long_name_priority(shared: Column, name_words: Column) -> Column:
    """strong_long_name, strong_short_name_review or one_literal_review."""
    return F.when(shared < 2, "one_literal_review").when(name_words >= 5, "strong_long_name").otherwise("strong_short_name_review")


def overlap_priority(teachers: Column, students: Column) -> Column:
    """both_lists_3plus (one or more in each, three in all), one_list_3plus, weak_overlap."""
    return F.when((teachers > 0) & (students > 0) & (teachers + students >= 3), "both_lists_3plus").when((teachers >= 3) | (students >= 3), "one_list_3plus").otherwise("weak_overlap")


def ordered(a: str, b: str) -> list[Column]:
    """A pair's ends in order, so that either spelling of it meets the other."""
    return [F.least(a, b).alias("left_id"), F.greatest(a, b).alias("right_id")]


def without_vetoed(pairs: DataFrame, vetoes: DataFrame) -> DataFrame:
    """Pairs that no reviewer has decided against."""
    return pairs.join(vetoes.select("left_id", "right_id").distinct(), ["left_id", "right_id"], "left_anti")


def transitive_conflicts(vetoes: DataFrame, roots: DataFrame) -> DataFrame:
    """Vetoed pairs whose ends are connected all the same (E18): must be none before a merge view is used."""
    l, r = roots.select(F.col("node").alias("left_id"), F.col("root").alias("lr")), roots.select(F.col("node").alias("right_id"), F.col("root").alias("rr"))
    return vetoes.join(l, "left_id").join(r, "right_id").where("lr = rr").select("left_id", "right_id", F.col("lr").alias("root"))


def observations(pairs: DataFrame) -> DataFrame:
    """Each pair as two directed observations."""
    both = F.array(F.struct(F.col("left_id").alias("entry_id"), F.col("right_id").alias("other_id")), F.struct(F.col("right_id").alias("entry_id"), F.col("left_id").alias("other_id")))
    rest = [c for c in pairs.columns if c not in ("left_id", "right_id")]
    return pairs.select(*rest, F.explode(both).alias("__o")).select("__o.entry_id", "__o.other_id", *rest)


def dispositions(links: DataFrame, decided: DataFrame, reviewed: DataFrame) -> DataFrame:
    """What becomes of each evidence link in the unified view.

    decided: left_id, right_id, decision of reviewers. reviewed: entry_id, person_id of entries that reviewers have
    joined to persons. A link is a review_veto where they were told apart or left uncertain, already_reviewed inside one
    person, a review_bridge where an end belongs to a person, and else a provisional_link.
    """
    d = decided.where(F.col("decision").isin("different", "uncertain")).select("left_id", "right_id", F.lit(True).alias("__veto")).distinct()
    l = reviewed.select(F.col("entry_id").alias("left_id"), F.col("person_id").alias("__lp"))
    r = reviewed.select(F.col("entry_id").alias("right_id"), F.col("person_id").alias("__rp"))
    got = links.join(d, ["left_id", "right_id"], "left").join(l, "left_id", "left").join(r, "right_id", "left")
    what = F.when(F.col("__veto"), "review_veto").when(F.col("__lp") == F.col("__rp"), "already_reviewed").when(F.col("__lp").isNotNull() | F.col("__rp").isNotNull(), "review_bridge").otherwise("provisional_link")
    return got.withColumn("disposition", what).drop("__veto", "__lp", "__rp")
