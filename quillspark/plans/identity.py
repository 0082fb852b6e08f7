"""Entity resolution in reversible stages: nothing is merged, reviewers' decisions override every link.

Each stage is a function of tables. Entries are (entry_id, name_key, name_label, classification, book_id,
opening_page_id); decisions are (left_id, right_id, decision) with left_id < right_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.arabic import signature
from quillspark.functions.lists import relationships
from quillspark.functions.passages import places
from quillspark.operators import audit, chronology, pairs
from quillspark.operators.components import components
from quillspark.operators.corpus import page
from quillspark.operators.sequence import upsert

# Openers of names that are chapter titles or chain words, not persons.
CHAPTERS = r"^(?:سيرة|كتاب|باب) "
CHAIN_WORDS = r"^(?:اخبرنا|حدثنا|قال|سمعت|عن) "
#: Characters of a biography's opening that lists are looked for in.
SLICE = 5000


def hashed_id(prefix: str, value: Column) -> Column:
    """A bucket id: prefix and the first 32 hex digits of the value's sha-256."""
    return F.concat(F.lit(prefix), F.left(F.sha2(value, 256), F.lit(32)))


def name_groups(entries: DataFrame, short: int = 5) -> DataFrame:
    """Buckets of equal name keys, which aren't people, with a status (E8, A13, A15). Names of fewer words than `short` are short."""
    g = entries.groupBy("name_key").agg(F.count(F.lit(1)).alias("entry_count"), F.count_if(F.col("classification") == "biography_candidate").alias("biography_count"), F.countDistinct("book_id").alias("distinct_books"))
    words = F.size(F.split("name_key", " "))
    status = F.when(F.col("biography_count") == 0, "index_only").when(F.col("entry_count") == 1, "single_entry").when(words < short, "short_name_review").otherwise("multiple_entries")
    return g.select(hashed_id("name-", F.col("name_key")).alias("name_group_id"), "*", status.alias("status"))


def inventory(entries: DataFrame, least: int = 25, words: int = 5, low: int = 2, high: int = 8) -> DataFrame:
    """Members of long names with `low` to `high` entries in two books or more."""
    kept = entries.where((F.length("name_key") >= least) & (F.size(F.split("name_key", " ")) >= words) & (F.col("classification") == "biography_candidate"))
    g = kept.groupBy("name_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("book_id").alias("b")).where(F.col("n").between(low, high) & (F.col("b") >= 2))
    return kept.join(g.select("name_key"), "name_key", "left_semi")


def bulk_candidates(members: DataFrame, statements: DataFrame, decisions: DataFrame | Callable[[Column, Column], Column], least: int = 60) -> DataFrame:
    """Pairs of one inventory name that share long quotes, however many entries hold a quote, with how their years relate
    and what reviewers have said (E9, A22 to A24, J26). members: entry_id, name_key, year. statements: entry_id, text_sha256,
    chars, and name_key where it is known. decisions may be a rule of a pair's ends: then no pair travels."""
    long_ = statements.where(F.col("chars") >= least)
    if "name_key" not in long_.columns:
        long_ = long_.join(members.select("entry_id", "name_key").distinct(), "entry_id")
    got = pairs.meetings(long_, "entry_id", ["text_sha256"], within="name_key", of=members.select("entry_id", "name_key", "year"))
    if isinstance(decisions, DataFrame):
        got = got.join(decisions.select(*pairs.ordered("left_id", "right_id"), "decision"), ["left_id", "right_id"], "left")
    else:
        got = got.withColumn("decision", decisions(F.col("left_id"), F.col("right_id")))
    return got.select("left_id", "right_id", "name_key", "shared", pairs.literal_priority(F.col("shared")).alias("priority"), chronology.date_relation(F.col("left_year"), F.col("right_year")).alias("date_relation"), "decision")


def literal_candidates(members: DataFrame, statements: DataFrame, cap: int | None = 20, least: int = 60) -> DataFrame:
    """Pairs of one name that share long quotes, of which up to `cap` entries of the name hold each (E10). statements: entry_id,
    text_sha256, chars."""
    long_ = statements.where(F.col("chars") >= least).join(members.select("entry_id", "name_key"), "entry_id")
    got = pairs.shared_text_pairs(long_, "entry_id", "text_sha256", cap=cap, within="name_key")
    names = members.select(F.col("entry_id").alias("left_id"), "name_key")
    got = got.join(names, "left_id")
    return got.withColumn("priority", pairs.long_name_priority(F.col("shared"), F.size(F.split("name_key", " "))))


def features(segments: DataFrame, pages: DataFrame, most: int = SLICE) -> DataFrame:
    """entry_id, kind, name: teachers and students that the beginning of each biography's opening lists, of which `most`
    characters are looked at (J24, T10)."""
    opening = segments.where("role = 'opening'").select(F.col("biography_id").alias("entry_id"), "page_id", "start_offset", "end_offset")
    text = opening.join(pages.select("page_id", "text"), "page_id").select("entry_id", relationships(F.expr(f"substring(text, start_offset + 1, least(end_offset - start_offset, {most}))")).alias("r"))
    both = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("r")[k].alias("names")) for k in ("teachers", "students")])
    return text.select("entry_id", F.explode(both).alias("k")).select("entry_id", "k.kind", F.explode("k.names").alias("name"))


def relationship_candidates(features: DataFrame, group: str = "name_key", most_group: int | None = None, of: DataFrame | None = None, brief: bool = False) -> DataFrame:
    """Pairs of a group with common teachers or students (E11). features: entry_id, kind, name and the group. of: columns by
    entry_id, which come out for both ends. Entries of equal lists meet as one: what two lists have in common is found once
    for all pairs of their entries. brief: the sizes of the common lists instead of these, and a pair's ends in any order, for
    results that put them in one of their own."""
    rows = features.select(group, "entry_id", "kind", "name").where(F.col("kind").isin("teachers", "students")).dropna().distinct()
    if most_group is not None:
        small = rows.groupBy(group, "kind").agg(F.countDistinct("entry_id").alias("__n")).where(F.col("__n") <= most_group)
        rows = rows.join(small.drop("__n"), [group, "kind"], "left_semi")
    lists = rows.groupBy("entry_id", group).agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("name")))).alias(k) for k in ("teachers", "students")])
    packs = pairs.packs(lists if of is None else lists.join(of, "entry_id"), "entry_id", [group, "teachers", "students"])
    items = packs.select("pack", "weight", group, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("names")) for k in ("teachers", "students")])).alias("k")).select("pack", "weight", group, "k.kind", F.explode("k.names").alias("name"))
    met = pairs.meetings(items, "pack", ["kind", "name"], within=group, of=packs.drop("weight"), weight="weight")
    met = met.select(group, *[F.array_intersect(f"left_{k}", f"right_{k}").alias(k) for k in ("teachers", "students")], "left_own", "right_own", F.lit(False).alias("same"))
    own = packs.where(F.col("weight") > 1).select(group, "teachers", "students", F.col("own").alias("left_own"), F.col("own").alias("right_own"), F.lit(True).alias("same"))
    met = met.unionByName(own).withColumn("priority", pairs.overlap_priority(F.size("teachers"), F.size("students")))
    if brief:
        met = met.withColumns({k: F.size(k) for k in ("teachers", "students")})
    return pairs.unpacked(met, "entry_id", (group,), ("teachers", "students", "priority"), ordered=not brief)


def relationship_gaps(features: DataFrame, view: DataFrame, group: str = "name_key", most_group: int | None = 20, more: tuple[str, ...] = (), brief: bool = False) -> DataFrame:
    """Pairs of a name's entries that have common teachers or students and two identities, with these and their books.

    features: entry_id, kind, name and the group. Names of more than `most_group` entries are left out, as in the queue that
    reviewers get; None: no name is. more: columns of the view that come out as well, for both ends. brief: as for
    relationship_candidates.
    """
    if most_group is not None:
        small = view.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") <= most_group).select(group)
        features = features.join(small, group, "left_semi")
    ids = view.select("entry_id", F.col("identity_id").alias("identity"), F.col("book_id").alias("book"), *more)
    return relationship_candidates(features, group, of=ids, brief=brief).where("left_identity <> right_identity")


def variant_candidates(features: DataFrame, family: str = "bucket_id") -> DataFrame:
    """Pairs of a spelling family with unlike names and common teachers or students (E12): both_lists_3plus or review_overlap.

    features: entry_id, name_key, kind, name and the family.
    """
    names = features.select("entry_id", "name_key").distinct()
    got = relationship_candidates(features, family).join(names.select(F.col("entry_id").alias("left_id"), F.col("name_key").alias("__l")), "left_id").join(names.select(F.col("entry_id").alias("right_id"), F.col("name_key").alias("__r")), "right_id")
    return got.where("__l <> __r").withColumn("priority", F.when(F.col("priority") == "both_lists_3plus", F.col("priority")).otherwise("review_overlap")).drop("__l", "__r")


def variant_entries(entries: DataFrame) -> DataFrame:
    """entry_id, name_key, bucket_id of spelling families with two name keys or more."""
    sig = entries.withColumn("signature", signature(F.col("name_key")))
    families = sig.groupBy("signature").agg(F.countDistinct("name_key").alias("n")).where("n > 1")
    return sig.join(families.select("signature"), "signature", "left_semi").select("entry_id", "name_key", hashed_id("variant-", F.col("signature")).alias("bucket_id"))


def _vetoed(links: DataFrame, decisions: DataFrame, kinds: tuple[str, ...] = ("different", "uncertain")) -> DataFrame:
    return pairs.without_vetoed(links, decisions.where(F.col("decision").isin(*kinds)))


def check_vetoes(links: DataFrame, decisions: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """links, failing if a reviewed pair of these kinds is connected through others."""
    bad = pairs.transitive_conflicts(decisions.where(F.col("decision").isin(*kinds)), components(links, "left_id", "right_id"))
    if bad.limit(1).count():
        raise ValueError("a provisional component crosses a reviewed pair")
    return links


def provisional_links(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Links of two shared quotes or more that no reviewer has vetoed."""
    got = _vetoed(candidates.where("shared >= 2"), decisions)
    return check_vetoes(got, decisions, ("different",))


def combined_links(literal: DataFrame, relationships: DataFrame, decisions: DataFrame) -> DataFrame:
    """Two shared quotes, or one and both relationship lists (E13). literal, relationships: pairs with name_key."""
    strong = literal.where("shared >= 2").select("left_id", "right_id", "name_key", "shared", F.lit("two_long_statements").alias("evidence_kind"))
    lists = relationships.where((F.col("priority") == "both_lists_3plus") & ~F.col("name_key").rlike(CHAPTERS)).select("left_id", "right_id", "name_key")
    more = lists.join(literal.where("shared = 1").select("left_id", "right_id", "shared"), ["left_id", "right_id"]).withColumn("evidence_kind", F.lit("literal_and_both_relationships"))
    return check_vetoes(_vetoed(strong.unionByName(more), decisions), decisions, ("different",))


def variant_links(literal: DataFrame, relationships: DataFrame, entries: DataFrame) -> DataFrame:
    """Links across spellings, quotes before lists (E15). Both ends must be biographies."""
    bio = entries.where("classification = 'biography_candidate'").select("entry_id")
    a = literal.where("shared >= 2").select("left_id", "right_id", F.lit(1).alias("o"), F.lit("two_long_statements").alias("evidence_kind"))
    b = relationships.where("priority = 'both_lists_3plus'").select("left_id", "right_id", F.lit(2).alias("o"), F.lit("both_relationship_lists").alias("evidence_kind"))
    best = a.unionByName(b).groupBy("left_id", "right_id").agg(F.min_by("evidence_kind", "o").alias("evidence_kind"))
    return best.join(bio.withColumnRenamed("entry_id", "left_id"), "left_id", "left_semi").join(bio.withColumnRenamed("entry_id", "right_id"), "right_id", "left_semi").select("left_id", "right_id", "evidence_kind")


def relationship_links(gaps: DataFrame, identities: DataFrame, decisions: DataFrame) -> DataFrame:
    """Three teachers and three students in common, different books, both ends unlinked, not vetoed."""
    ids = identities.select("entry_id", "identity_id", "book_id")
    got = gaps.where((F.col("priority") == "both_lists_3plus") & (F.size("teachers") >= 3) & (F.size("students") >= 3))
    got = got.join(ids.select(F.col("entry_id").alias("left_id"), F.col("identity_id").alias("li"), F.col("book_id").alias("lb")), "left_id").join(ids.select(F.col("entry_id").alias("right_id"), F.col("identity_id").alias("ri"), F.col("book_id").alias("rb")), "right_id")
    got = got.where(F.col("li").startswith("single-") & F.col("ri").startswith("single-") & (F.col("lb") != F.col("rb")))
    return _vetoed(got, decisions).select("left_id", "right_id", F.lit("teachers_3plus_students_3plus").alias("evidence_kind"), "teachers", "students")


def clusters(links: DataFrame, prefix: str = "prov-") -> DataFrame:
    """entry_id, root, identity_id, members: the id is made of all members."""
    c = components(links, "left_id", "right_id").withColumnRenamed("node", "entry_id")
    named = c.groupBy("root").agg(hashed_id(prefix, F.array_join(F.sort_array(F.collect_list("entry_id")), "\u0000")).alias("identity_id"), F.count(F.lit(1)).alias("members"))
    return c.join(named, "root")


def evidence_links(**stages: DataFrame) -> DataFrame:
    """All links (left_id, right_id) of the stages, each tagged with its stage's name (X2): literal=..., variant=..., relationship=..."""
    tagged = [df.select("left_id", "right_id", F.lit(kind).alias("kind")) for kind, df in stages.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def link_kinds(links: DataFrame) -> DataFrame:
    """One row a pair, with the kinds of its evidence."""
    return links.groupBy("left_id", "right_id").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kind"))


def unified_view(entries: DataFrame, links: DataFrame, decisions: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entry_id, identity_id, identity_kind, ...) of every entry, and what became of each link.

    links: left_id, right_id, kind of all evidence. reviewed: entry_id, person_id, person_status.
    """
    judged = pairs.dispositions(links, decisions, reviewed)
    used = judged.where("disposition = 'provisional_link'").select("left_id", "right_id")
    check_vetoes(used, decisions, ("different", "uncertain"))
    prov = clusters(used).select("entry_id", F.col("identity_id").alias("__p"))
    got = entries.join(reviewed, "entry_id", "left").join(prov, "entry_id", "left")
    person = F.col("person_id").isNotNull()
    kind = F.when(person & (F.col("person_status") == "reviewed"), "reviewed_person").when(person, "needs_review").when(F.col("__p").isNotNull(), "provisional_cluster").otherwise("unlinked_entry")
    identity = F.coalesce("person_id", "__p", F.concat(F.lit("single-"), F.col("entry_id")))
    return got.select(*entries.columns, identity.alias("identity_id"), kind.alias("identity_kind")), judged


def gap_queue(groups: DataFrame, view: DataFrame, least_spaces: int = 4) -> DataFrame:
    """Names whose biographies stay under two identities or more, by priority."""
    kinds = view.groupBy("name_key").agg(
        F.countDistinct("identity_id").alias("identities"),
        F.count_if(F.col("identity_kind").isin("reviewed_person", "needs_review")).alias("reviewed_entries"),
        F.count_if(F.col("identity_kind") == "provisional_cluster").alias("provisional_entries"),
        F.count_if(F.col("identity_kind") == "unlinked_entry").alias("unlinked_entries"),
    )
    got = groups.where("entry_count >= 2 AND biography_count >= 2").join(kinds.where("identities >= 2"), "name_key")
    cross = (F.col("distinct_books") >= 2) & (F.col("biography_count") >= 2)
    spaces = F.length("name_key") - F.length(F.replace("name_key", F.lit(" "), F.lit("")))
    return got.withColumn("priority", F.when(F.col("name_key").rlike(CHAIN_WORDS), "suspected_heading_noise").when(cross & (spaces >= least_spaces), "cross_book_long_name").when(cross, "cross_book_short_name").otherwise("same_book_or_index"))


def identity_dates(view: DataFrame, automatic: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All year claims with their identity, and a summary for each identity.

    automatic, reviewed: entry_id, year, quote, page_id. A claim whose entry isn't in the view is an error.
    """
    claims = automatic.where(F.col("year").isNotNull()).select("entry_id", "year", "quote", "page_id", F.lit("automatic").alias("evidence_type"))
    claims = claims.unionByName(reviewed.select("entry_id", "year", "quote", "page_id", F.lit("reviewed_claim").alias("evidence_type")))
    claims = claims.join(view.select("entry_id", "identity_id"), "entry_id", "left")
    claims = audit.refuse(claims, F.col("identity_id").isNull(), "a dated entry is missing from the identity view")
    counts = claims.groupBy("identity_id").agg(F.count(F.lit(1)).alias("claims"), F.countDistinct("entry_id").alias("entries"))
    return claims, counts.join(chronology.decimal_bucket(claims, "identity_id", "year"), "identity_id")


def relationship_graph(found: DataFrame, view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Directed observations of name mentions, and each identity's neighbours."""
    names = [found.select("left_id", "right_id", "priority", F.lit(kind[:-1]).alias("relation"), F.explode(kind).alias("name")) for kind in ("teachers", "students")]
    both = pairs.observations(names[0].unionByName(names[1])).withColumn("mention_id", hashed_id("mention-", F.col("name")))
    obs = both.join(view.select("entry_id", "identity_id", "opening_page_id"), "entry_id").distinct()
    return obs, obs.groupBy("identity_id", "relation", "mention_id").agg(F.countDistinct("entry_id").alias("entries"), F.count(F.lit(1)).alias("observations"))


def incomplete_persons(person_entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs of a person's entries without an explicit `same` (E23): the person needs review while there is any.

    Counts decide: a person of n entries has n (n - 1) / 2 decided pairs. No pair is made that isn't decided.
    """
    p = person_entries.select("entry_id", "person_id")
    same = decisions.where("decision = 'same'").select("left_id", "right_id").distinct()
    inside = same.join(p.select(F.col("entry_id").alias("left_id"), F.col("person_id").alias("a")), "left_id").join(p.select(F.col("entry_id").alias("right_id"), F.col("person_id").alias("b")), "right_id").where("a = b")
    have = inside.groupBy(F.col("a").alias("person_id")).agg(F.count(F.lit(1)).alias("decided"))
    size = p.groupBy("person_id").agg(F.countDistinct("entry_id").alias("n"))
    got = size.join(have, "person_id", "left").withColumn("missing", (F.col("n") * (F.col("n") - 1) / 2).cast("long") - F.coalesce("decided", F.lit(0)))
    return got.where("missing > 0 OR n < 2").select("person_id", "n", "missing")


def date_grouping(members: DataFrame, evidence: DataFrame, claims: DataFrame) -> DataFrame:
    """name_key, its distinct years from evidence and reviewers' claims, and their bucket; names without a year have none.

    members: name_key. evidence, claims: name_key, year.
    """
    years = evidence.select("name_key", "year").union(claims.select("name_key", "year")).where("year IS NOT NULL").distinct()
    return members.select("name_key").distinct().join(chronology.decimal_bucket(years, "name_key", "year"), "name_key", "left").withColumn("years", F.coalesce("years", F.lit("")))


def refresh_dates(grouping: DataFrame, evidence: DataFrame, claims: DataFrame, keys: list[str]) -> DataFrame:
    """grouping with the names `keys` grouped anew; all others stay as they are and nothing of them is read (E5, K3)."""
    own = grouping.sparkSession.createDataFrame([(k,) for k in keys], "name_key string")
    fresh = date_grouping(own, evidence.where(F.col("name_key").isin(keys)), claims.where(F.col("name_key").isin(keys)))
    return upsert(grouping, fresh.select(*grouping.columns), ["name_key"])


#: Names in the order in which reviewers look at them.
TRIAGE = ("conflicting_dates", "matching_dates", "one_dated")


def triage_list(groups: DataFrame, limit: int = 100) -> DataFrame:
    """The first names to review: by triage status, then those of most entries. groups: name_key, entries, triage_status."""
    rank = F.coalesce(*[F.when(F.col("triage_status") == s, i) for i, s in enumerate(TRIAGE)], F.lit(len(TRIAGE)))
    return page(groups, [rank, F.desc("entries"), F.col("name_key")], limit)


def _person_pairs(decisions: DataFrame, ids: list[str]) -> None:
    """Raises unless every pair of the entries is decided as the same. ids: a person's entries."""
    ids = sorted(ids)
    if len(set(ids)) != len(ids) or len(ids) < 2:
        raise ValueError("a person needs two different entries or more")
    own = decisions.where(F.col("left_id").isin(ids) & F.col("right_id").isin(ids) & (F.col("decision") == "same"))
    have = {(r[0], r[1]) for r in own.select(*pairs.ordered("left_id", "right_id")).distinct().collect()}
    lacking = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (a, b) not in have]
    if lacking:
        raise ValueError(f"every pair needs an explicit decision that it is the same: {' / '.join(lacking[0])}")


REGISTRY = {
    "persons": "person_id string, display_name string, status string, evidence_sha256 string, created_at timestamp, updated_at timestamp",
    "person_entries": "entry_id string, person_id string",
    "events": "person_id string, action string, entry_id string, reviewer string, reason string, recorded_at timestamp",
}


def empty_registry(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in REGISTRY.items()}


def _registered(registry: dict[str, DataFrame], decisions: DataFrame, evidence: DataFrame, person_id: str, name: str | None, old: list[str], new: list[str], action: str, reviewer: str, reason: str) -> dict[str, DataFrame]:
    if not reviewer.strip() or not reason.strip() or (name is not None and not name.strip()):
        raise ValueError("a name, a reviewer and a reason are required")
    _person_pairs(decisions, old + new)
    spark = evidence.sparkSession
    taken = registry["person_entries"].where(F.col("entry_id").isin(new)).limit(1).count()
    if taken:
        raise ValueError("an entry belongs to a person already")
    rows = evidence.where(F.col("entry_id").isin(old + new)).withColumn("person_id", F.lit(person_id))
    print_ = evidence_fingerprint(rows, "person_id", *evidence.columns).first()
    if rows.select("entry_id").distinct().count() != len(old) + len(new):
        raise ValueError("an entry has no evidence")
    now = F.current_timestamp()
    entries = spark.createDataFrame([(e, person_id) for e in new], REGISTRY["person_entries"])
    event = spark.createDataFrame([(person_id, action, new[0] if action == "add" else None, reviewer, reason)], "person_id string, action string, entry_id string, reviewer string, reason string").withColumn("recorded_at", now)
    if action == "create":
        own = spark.createDataFrame([(person_id, name, "reviewed", print_["evidence_sha256"])], "person_id string, display_name string, status string, evidence_sha256 string").withColumn("created_at", now).withColumn("updated_at", now)
        persons = registry["persons"].unionByName(own)
    else:
        mine = F.col("person_id") == person_id
        persons = registry["persons"].withColumn("evidence_sha256", F.when(mine, F.lit(print_["evidence_sha256"])).otherwise(F.col("evidence_sha256"))).withColumn("updated_at", F.when(mine, now).otherwise(F.col("updated_at")))
    return {"persons": persons, "person_entries": registry["person_entries"].unionByName(entries), "events": registry["events"].unionByName(event)}


def create_person(registry: dict[str, DataFrame], decisions: DataFrame, evidence: DataFrame, a: str, b: str, name: str, reviewer: str, reason: str) -> tuple[str, dict[str, DataFrame]]:
    """A person of two entries that reviewers have decided to be the same, and the registry with it.

    evidence: entry_id and what is known of it; its fingerprint is kept with the person. The id is made of the entries.
    """
    person = "person-" + hashlib.sha256("\u0000".join(sorted((a, b))).encode()).hexdigest()[:32]
    return person, _registered(registry, decisions, evidence, person, name, [], [a, b], "create", reviewer, reason)


def add_to_person(registry: dict[str, DataFrame], decisions: DataFrame, evidence: DataFrame, person_id: str, entry_id: str, reviewer: str, reason: str) -> dict[str, DataFrame]:
    """The registry with one more entry of a person: it must be the same as every one of them."""
    old = [r["entry_id"] for r in registry["person_entries"].where(F.col("person_id") == person_id).select("entry_id").collect()]
    if not old:
        raise ValueError("unknown person")
    return _registered(registry, decisions, evidence, person_id, None, old, [entry_id], "add", reviewer, reason)


def audit_persons(registry: dict[str, DataFrame], decisions: DataFrame) -> DataFrame:
    """persons, with those that lack a decision marked needs_review."""
    lacking = incomplete_persons(registry["person_entries"], decisions).select("person_id", F.lit(True).alias("__l"))
    return registry["persons"].join(lacking, "person_id", "left").withColumn("status", F.when(F.col("__l"), "needs_review").otherwise(F.col("status"))).drop("__l")


def show_person(registry: dict[str, DataFrame], person_id: str) -> DataFrame:
    """One row: the person, its entries, and its events in their order."""
    own = lambda t: registry[t].where(F.col("person_id") == person_id)
    e = own("person_entries").groupBy("person_id").agg(F.array_sort(F.collect_list("entry_id")).alias("entries"))
    v = own("events").groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("recorded_at", "action", "entry_id", "reviewer", "reason"))).alias("events"))
    return own("persons").join(e, "person_id", "left").join(v, "person_id", "left")


def evidence_fingerprint(rows: DataFrame, person: str, *fields: str) -> DataFrame:
    """A person's evidence in one canonical order, hashed (A29): a changed decision or source shows."""
    items = F.sort_array(F.collect_set(F.to_json(F.struct(*fields))))
    return rows.groupBy(person).agg(F.sha2(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")), 256).alias("evidence_sha256"))


def record_decisions(history: DataFrame, new: DataFrame, members: DataFrame, group: str = "group_id") -> tuple[DataFrame, DataFrame]:
    """History with the new decisions appended, and the latest decision of each pair.

    new: left_id, right_id, decision, reviewer, reason, recorded_at. Refused at run time: unknown decisions, blank
    reviewers or reasons, a pair with itself, pairs that aren't of one group.
    """
    from quillspark.operators.sequence import latest

    left = members.select(F.col("entry_id").alias("left_id"), F.col(group).alias("__l"))
    right = members.select(F.col("entry_id").alias("right_id"), F.col(group).alias("__r"))
    cols = [c for c in new.columns if c not in ("left_id", "right_id")]
    placed = new.select(*pairs.ordered("left_id", "right_id"), *cols).join(left, "left_id", "left").join(right, "right_id", "left")
    bad = ~F.col("decision").isin("same", "different", "uncertain") | (F.trim("reviewer") == "") | (F.trim("reason") == "") | (F.col("left_id") == F.col("right_id")) | ~F.coalesce(F.col("__l") == F.col("__r"), F.lit(False))
    ok = audit.refuse(placed, F.coalesce(bad, F.lit(True)), "a decision needs a known verdict, a reviewer, a reason and two entries of one group").select(*new.columns)
    all_ = history.unionByName(ok)
    return all_, latest(all_, ["left_id", "right_id"], [F.desc("recorded_at"), F.desc("decision")])


def date_claims(claims: DataFrame, segments: DataFrame, pages: DataFrame) -> DataFrame:
    """Offsets of quotes that stand exactly once inside their biography's spans on their page; others are refused.

    claims: entry_id, page_id, quote, year. Occurrences may overlap each other.
    """
    rows = claims.join(segments.select(F.col("biography_id").alias("entry_id"), "page_id", "start_offset", "end_offset"), ["entry_id", "page_id"]).join(pages.select("page_id", "text"), "page_id")
    at = places(F.expr("substring(text, start_offset + 1, end_offset - start_offset)"), F.col("quote"))
    found = rows.select("entry_id", "page_id", "quote", "year", F.explode(F.transform(at, lambda i: i + F.col("start_offset"))).alias("start_offset"))
    one = found.groupBy("entry_id", "page_id", "quote", "year").agg(F.count(F.lit(1)).alias("n"), F.min("start_offset").alias("start_offset"))
    got = claims.join(one, ["entry_id", "page_id", "quote", "year"], "left")
    got = audit.refuse(got, F.coalesce(F.col("n") != 1, F.lit(True)), "a quote must stand exactly once in its biography")
    return got.select("entry_id", "page_id", "quote", "year", "start_offset", (F.col("start_offset") + F.length("quote")).alias("end_offset"))


def same_release(*tables: DataFrame) -> str:
    """The one release checksum that one-row metadata tables agree on; raises otherwise."""
    found = {r[0] for t in tables for r in t.select("release_sha256").limit(2).collect()}
    if len(found) != 1:
        raise ValueError("the inputs come from different releases")
    return found.pop()
