"""An Arabic corpus made of the driver's tables by rules that SQL can follow, and the stages over it, end to end.

Each part is an entry of a biographical dictionary: its key gives a name, a death in one of six forms, lists of teachers and
students, and a judgement. Three entries make a page, some pages begin with the end of the last entry or have a footnote,
twenty pages a file. The SQL knows the answers from the rules: it counts lengths and never parses a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import headings, lists, native, passages, statements, tables, years
from quillspark.functions.arabic import name_key, normalize, signature
from quillspark.operators.corpus import content_id
from quillspark.plans import api, chronicle, corpus, extraction, identity, review
from quillspark.plans.base import Registry, Tables
from quillspark.storage import materialize

query = Registry()

NAMES = ("محمد", "أحمد", "علي", "صالح", "يوسف", "خالد", "جابر", "حسين")
HUNDRED, TENS = ("مائة", "مائتين", "ثلاثمائة"), ("عشرين", "ثلاثين", "أربعين", "خمسين", "ستين", "سبعين", "ثمانين", "تسعين")
JUDGED = ("ثقة", "ضعيف", "صدوق")
REST, NOTE = "تتمة الكلام.\n", "قال المحقق: ضعيف.\n"
A_PAGE, A_FILE, PERSONS = 3, 20, 53


def _list(values) -> Column:
    return F.array(*map(F.lit, values))


def _pick(values, i: Column) -> Column:
    return F.get(_list(values), i.cast("int"))


def _name(k: Column) -> Column:
    return F.concat(_pick(NAMES, k % 8), F.lit(" بن "), _pick(NAMES, F.floor(k / 8) % 8))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


def _sql_name(k: str, names=NAMES) -> str:
    return f"({_sql_list(names)}[({k}) % 8 + 1] || ' بن ' || {_sql_list(names)}[(({k}) // 8) % 8 + 1])"


PLAIN = tuple(n.replace("أ", "ا") for n in NAMES)


def entries_by_rule(t: Tables) -> DataFrame:
    """k, page, heading, body (lines) of each entry."""
    k = F.col("p_partkey")
    person = k % PERSONS
    form, year = F.when((k % 6 == 2) & (person % 4 != 0), 1).otherwise(k % 6), 100 + person * 7 % 300
    label = F.concat(_name(person), F.lit(" بن "), _pick(NAMES, F.floor(person / 7) % 8))
    head = F.concat(k.cast("string"), F.lit(" - "), label, F.when(form == 0, F.concat(F.lit(" (ت "), year.cast("string"), F.lit(" هـ)"))).otherwise(""))
    died = F.when(form == 1, F.concat(F.lit("توفي سنة "), year.cast("string"), F.lit(" هـ."))).when(form == 2, F.concat(F.lit("مات سنة "), _pick(HUNDRED, k % 3), F.lit(" و"), _pick(TENS, k % 8), F.lit("."))).when(form == 3, F.lit("توفي سنة نحو مائتين.")).when(form == 5, F.lit("توفي سنة 230 أو 231."))
    lines = F.concat(
        F.lit("روى عن: "), _name(person + 1), F.lit("، "), _name(k % 5 + 20), F.lit(".\n"),
        F.lit("روى عنه: "), _name(person + 9), F.lit("، "), _name(k % 7 + 40), F.lit(".\n"),
        F.lit("قال "), _pick(NAMES, k % 8), F.lit(": "), _pick(JUDGED, k % 3), F.lit(".\n"),
        F.coalesce(F.concat(died, F.lit("\n")), F.lit("")),
    )
    return t.part.select(k.alias("k"), F.floor(k / A_PAGE).cast("long").alias("page"), label.alias("label"), head.alias("heading"), lines.alias("body"))


def pages(t: Tables) -> DataFrame:
    """The pages, in the shape of archives.pages()."""
    one = entries_by_rule(t).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("k", "heading", "body"))).alias("es"))
    before = F.when(F.col("page") % 5 == 2, F.lit(REST)).otherwise("")
    after = F.when(F.col("page") % 4 == 1, F.lit(NOTE)).otherwise("")
    one = one.withColumn("before", before).withColumn("after", after)
    one = one.withColumn("main", F.concat("before", F.array_join(F.transform("es", lambda e: F.concat(e["heading"], F.lit("\n"), e["body"])), "")))
    ends = native.running(F.transform("es", lambda e: (F.length(e["heading"]) + 1 + F.length(e["body"])).cast("long")))
    start = lambda e, end: (F.length("before") + end - F.length(e["heading"]) - 1 - F.length(e["body"])).cast("int")
    titles = F.zip_with("es", ends, lambda e, end: F.struct(start(e, end).alias("start"), (start(e, end) + F.length(e["heading"])).alias("end")))
    note = F.struct(F.lit("footnote").alias("kind"), F.length("main").alias("start_offset"), (F.length("main") + F.length("after")).alias("end_offset"), F.lit(None).cast("string").alias("anchor"))
    text = F.concat("main", "after")
    file = F.floor(F.col("page") / A_FILE)
    return one.select(
        F.concat(F.lit("p"), F.col("page").cast("string")).alias("page_id"), F.concat(F.lit("f"), file.cast("string")).alias("source_id"), F.concat(F.lit("b"), (file % 5).cast("string")).alias("book_id"),
        file.cast("int").alias("zip_index"), F.lit(False).alias("is_metadata"), (F.col("page") % A_FILE).cast("int").alias("ordinal"), text.alias("text"), F.when(F.col("after") != "", F.array(note)).otherwise(F.array().cast("array<struct<kind:string,start_offset:int,end_offset:int,anchor:string>>")).alias("spans"),
        titles.alias("titles"), F.array().cast("array<int>").alias("number_starts"), F.lit("").alias("header"), F.lit("1").alias("part"), F.col("page").cast("string").alias("label"), F.sha2(text, 256).alias("text_sha256"),
    )


_RULES = f"""
r AS (SELECT p_partkey AS k, p_partkey // {A_PAGE} AS page, p_partkey % {PERSONS} AS person, CASE WHEN p_partkey % 6 = 2 AND p_partkey % {PERSONS} % 4 <> 0 THEN 1 ELSE p_partkey % 6 END AS form, 100 + p_partkey % {PERSONS} * 7 % 300 AS y FROM part),
e AS (SELECT *, {_sql_name('person')} || ' بن ' || {_sql_list(NAMES)}[(person // 7) % 8 + 1] AS label, {_sql_name('person', PLAIN)} || ' بن ' || {_sql_list(PLAIN)}[(person // 7) % 8 + 1] AS key,
  CASE form WHEN 1 THEN 'توفي سنة ' || y || ' هـ.' WHEN 2 THEN 'مات سنة ' || {_sql_list(HUNDRED)}[k % 3 + 1] || ' و' || {_sql_list(TENS)}[k % 8 + 1] || '.' WHEN 3 THEN 'توفي سنة نحو مائتين.' WHEN 5 THEN 'توفي سنة 230 أو 231.' ELSE '' END AS died,
  'روى عن: ' || {_sql_name('person + 1')} || '، ' || {_sql_name('k % 5 + 20')} || '.' AS l1, 'روى عنه: ' || {_sql_name('person + 9')} || '، ' || {_sql_name('k % 7 + 40')} || '.' AS l2,
  {_sql_list(NAMES)}[k % 8 + 1] AS critic, 'قال ' || {_sql_list(NAMES)}[k % 8 + 1] || ': ' || {_sql_list(JUDGED)}[k % 3 + 1] || '.' AS l3 FROM r),
h AS (SELECT *, k || ' - ' || label || CASE WHEN form = 0 THEN ' (ت ' || y || ' هـ)' ELSE '' END AS heading FROM e),
n AS (SELECT *, length(heading) + length(l1) + length(l2) + length(l3) + 4 + CASE WHEN died <> '' THEN length(died) + 1 ELSE 0 END AS len FROM h),
o AS (SELECT *, (CASE WHEN page % 5 = 2 THEN {len(REST)} ELSE 0 END + coalesce(sum(len) OVER (PARTITION BY page ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS pos, row_number() OVER (PARTITION BY page ORDER BY k DESC) = 1 AS last FROM n),
x AS (SELECT *, 'p' || page AS page_id, pos + length(heading) + 1 AS a1, pos + length(heading) + length(l1) + 2 AS a2, pos + length(heading) + length(l1) + length(l2) + 3 AS a3, pos + length(heading) + length(l1) + length(l2) + length(l3) + 4 AS a4 FROM o)"""


class _Corpus:
    """The stages' tables, each made when it is first asked for."""

    def __init__(self, t: Tables):
        self.t, self.made = t, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = getattr(self, f"_{name}")()
        return self.made[name]

    def _pages(self):
        return materialize(pages(self.t))

    def _entries(self):
        return materialize(corpus.entries(self.pages))

    def _mentions(self):
        return corpus.mentions(self.pages, self.entries)

    def _footnotes(self):
        return corpus.footnotes(self.pages)

    def _records(self):
        return materialize(chronicle.records(self.pages, self.entries, self.footnotes))

    def _named(self):
        """Entries with the label that their record has: it is a function of the title."""
        return self.entries.withColumn("name_label", years.name_label(F.col("title")))

    def _regions(self):
        return materialize(extraction.regions(self.pages, self.named))

    def _segments(self):
        return extraction.segments(self.regions)

    def _statements(self):
        return materialize(extraction.statements(self.pages, self.regions, self.footnotes))

    def _biographies(self):
        return materialize(extraction.biographies(self.pages, self.named, self.regions, self.statements))

    def _members(self):
        b = self.biographies
        return b.select(F.col("biography_id").alias("entry_id"), "name_key", "name_label", "classification", "book_id", "source_id", "opening_page_id")

    def _openings(self):
        """What pairs of entries need of the biographies; classes and roll-ups aren't made."""
        found = extraction.openings(self.pages, self.named, self.regions)
        return materialize(found.select(F.col("biography_id").alias("entry_id"), "name_key", "book_id", "source_id"))

    def _features(self):
        return materialize(identity.features(self.segments, self.pages).join(self.openings.select("entry_id", "name_key"), "entry_id"))

    def _view(self):
        return self.identified(self.members)

    @staticmethod
    def identified(members: DataFrame) -> DataFrame:
        """Entries of one name and file are one identity."""
        return members.withColumn("identity_id", F.concat_ws("/", "name_key", "source_id")).withColumn("identity_kind", F.lit("provisional_cluster"))

    def _gaps(self):
        return materialize(identity.relationship_gaps(self.features, self.view, most_group=None))

    def _graph(self):
        return identity.relationship_graph(self.gaps, self.view)

    def _citations(self):
        p = self.pages
        return p.select("page_id", "text_sha256", "source_id", "book_id", "zip_index", "ordinal", F.col("label").alias("printed_label"), "part", F.col("source_id").alias("zip_path"), F.col("book_id").alias("title"), F.lit("author").alias("author"), F.lit("1").alias("edition"))

    def _texts(self):
        return corpus.texts(self.pages)

    def _spans(self):
        return corpus.spans(self.pages)

    def _passage_locations(self):
        return corpus.passages(self.texts)[0]

    def _entry_identity(self):
        return self.view

    def _identities(self):
        return api.identities(self.view)

    def _neighbors(self):
        return self.graph[1]

    def _observations(self):
        return self.graph[0]

    def _dates(self):
        auto = self.records.select("entry_id", F.col("death_year").alias("year"), F.col("evidence_quote").alias("quote"), "page_id")
        return identity.identity_dates(self.view, auto, auto.limit(0))

    def _claims(self):
        return self.dates[0]

    def _date_summary(self):
        return self.dates[1]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def _id(k: int, at: int = 0) -> str:
    """The id of the entry k, if it begins its page at a place."""
    import hashlib

    return hashlib.sha256(f"p{k // A_PAGE}\0{at}".encode()).hexdigest()


def _placed(c: _Corpus, rows: DataFrame, key: str = "entry_id") -> DataFrame:
    """rows with their entry's page and place instead of its id, which SQL doesn't make."""
    e = c.entries.select(F.col("entry_id").alias("__e"), F.col("page_id").alias("entry_page"), F.col("start_offset").alias("entry_start"))
    return rows.join(e, F.col(key) == F.col("__e"), "left").drop("__e", key)


@query(f"WITH {_RULES} SELECT page_id, pos::INT AS start_offset, (pos + length(heading))::INT AS end_offset, heading AS title, k || ' - ' || key || CASE WHEN form = 0 THEN ' (ت ' || y || ' ه)' ELSE '' END AS search_title, 'biography_heading_candidate' AS kind FROM x")
def entry_candidates(t: Tables) -> DataFrame:
    return _Corpus(t).entries.drop("entry_id")


@query(f"""WITH {_RULES} SELECT page_id, pos::INT AS entry_start, page_id AS entry_page, 'teacher_mention' AS kind, 'روى عن' AS trigger, a1::INT AS start_offset, (a1 + length(l1) - 1)::INT AS end_offset, false AS in_footnote, left(l1, length(l1) - 1) AS evidence FROM x
UNION ALL SELECT page_id, pos::INT, page_id, 'student_mention', 'روى عنه', a2::INT, (a2 + length(l2) - 1)::INT, false, left(l2, length(l2) - 1) FROM x""")
def relationship_mentions(t: Tables) -> DataFrame:
    c = _Corpus(t)
    return _placed(c, c.mentions.drop("status"))


_DATED = f"""{_RULES},
d AS (SELECT *, CASE form WHEN 0 THEN y WHEN 1 THEN y WHEN 2 THEN 100 * (k % 3 + 1) + 10 * (k % 8 + 2) END AS year,
  CASE form WHEN 0 THEN 'explicit_hijri' WHEN 1 THEN 'explicit_hijri' WHEN 2 THEN 'hijri_assumed_from_death_context' WHEN 3 THEN 'approximate_or_range' WHEN 5 THEN 'conflicting_or_range' ELSE 'no_usable_death_date' END AS status FROM x),
bad AS (SELECT key FROM d GROUP BY 1 HAVING count(DISTINCT year) > 1),
rec AS (SELECT d.*, bad.key IS NOT NULL AS unsure FROM d LEFT JOIN bad USING (key))"""


@query(f"""WITH {_DATED} SELECT page_id, label AS name_label, key AS name_key, CASE WHEN NOT unsure THEN year END::INT AS death_year, CASE WHEN unsure THEN 'ambiguous_name_or_conflicting_year' ELSE status END AS date_status,
  CASE WHEN form = 0 THEN pos + length(heading) - length(' هـ)') - length(y::VARCHAR) - 3 WHEN died <> '' THEN a4 END::INT AS evidence_start, CASE WHEN form = 0 THEN pos + length(heading) - 1 WHEN died <> '' THEN a4 + length(died) END::INT AS evidence_end,
  CASE WHEN form = 0 THEN '(ت ' || y || ' هـ' WHEN died <> '' THEN died END AS evidence_quote, CASE WHEN form = 0 THEN 'heading_death_date' WHEN died <> '' THEN 'same_entry_death_context' END AS evidence_kind FROM rec""")
def chronology_records(t: Tables) -> DataFrame:
    """Names, years and their evidence from pages."""
    return _Corpus(t).records.drop("entry_id")


@query(f"""WITH {_DATED}, g AS (SELECT key, year, count(*) AS n FROM rec WHERE NOT unsure AND year IS NOT NULL GROUP BY 1, 2), b AS (SELECT (year - 1) // 30 * 30 + 1 AS s, count(*) AS groups, sum(n) AS n FROM g GROUP BY 1)
SELECT s AS start, s + 29 AS "end", coalesce(groups, 0)::BIGINT AS groups, coalesce(n, 0)::BIGINT AS source_entries FROM (SELECT unnest(generate_series((SELECT min(s) FROM b), (SELECT max(s) FROM b), 30)) AS s) LEFT JOIN b USING (s)""")
def chronology_bands(t: Tables) -> DataFrame:
    """The endpoint's bands over the corpus (API:chronology)."""
    return api.chronology(_Corpus(t))


@query()
def chronology_checks(t: Tables) -> DataFrame:
    """Bands, groups and quotes of all records: each count must be zero."""
    c = _Corpus(t)
    return chronicle.checks(c.records, chronicle.groups(c.records), c.pages)


_SAID = f"""{_RULES}, s AS (
  SELECT page_id, pos AS owner, a1 AS a, l1 AS quote, 'main_text' AS origin, 'unresolved_in_biography_context' AS status, NULL AS who, 'teachers' AS kind, last FROM x
  UNION ALL SELECT page_id, pos, a2, l2, 'main_text', 'unresolved_in_biography_context', NULL, 'students', last FROM x
  UNION ALL SELECT page_id, pos, a3, l3, 'main_text', 'unresolved_in_biography_context', critic, 'assessment', last FROM x
  UNION ALL SELECT page_id, pos, a4, died, 'main_text', 'unresolved_in_biography_context', NULL, 'death', last FROM x WHERE died <> ''
  UNION ALL SELECT page_id, pos, pos + len, rtrim('{NOTE.strip()}'), 'footnote', 'editorial_context_unresolved', 'المحقق', 'assessment', last FROM x WHERE last AND page % 4 = 1)"""


@query(f"WITH {_SAID} SELECT page_id, owner::INT AS entry_start, page_id AS entry_page, a::INT AS start, (a + length(quote))::INT AS \"end\", quote, origin, status AS subject_status, who AS attribution_text, kind AS kinds FROM s")
def extracted_statements(t: Tables) -> DataFrame:
    """Statements of every page, with owners, layers and speakers."""
    c = _Corpus(t)
    kinds = F.array_join(F.transform("triggers", lambda x: x["kind"]), ",")
    return _placed(c, c.statements.select("page_id", "biography_id", "start", "end", "quote", "origin", "subject_status", "attribution_text", kinds.alias("kinds")), "biography_id")


@query(f"WITH {_SAID} SELECT kind, count(*) AS statements FROM s GROUP BY 1")
def trigger_counts(t: Tables) -> DataFrame:
    return extraction.trigger_counts(_Corpus(t).statements)


@query(f"""WITH {_RULES}, w AS (SELECT *, page // {A_FILE} AS file, lead(page) OVER (PARTITION BY page // {A_FILE} ORDER BY k) AS following FROM x),
s AS (SELECT *, last AND following % 5 = 2 AS more FROM w)
SELECT label AS name_label, key AS name_key, page_id AS opening_page_id, pos::INT AS heading_start, CASE WHEN following IS NULL THEN 'source_file_end_unresolved' ELSE 'next_recorded_heading' END AS boundary_status, 'biography_candidate' AS classification,
  (1 + CASE WHEN more THEN 1 ELSE 0 END)::BIGINT AS segment_count, (len + CASE WHEN last AND page % 4 = 1 THEN {len(NOTE)} ELSE 0 END + CASE WHEN more THEN {len(REST)} ELSE 0 END)::BIGINT AS char_count, (3 + CASE WHEN died <> '' THEN 1 ELSE 0 END + CASE WHEN last AND page % 4 = 1 THEN 1 ELSE 0 END)::BIGINT AS statement_count FROM s""")
def extracted_biographies(t: Tables) -> DataFrame:
    """Biographies with their continuations on the next page, classes and roll-ups."""
    return _Corpus(t).biographies.select("name_label", "name_key", "opening_page_id", "heading_start", "boundary_status", "classification", "segment_count", "char_count", "statement_count")


@query()
def extraction_checks(t: Tables) -> DataFrame:
    """All audits over the statements of every page, which are thousands here: each count must be zero."""
    c = _Corpus(t)
    return extraction.checks(c.pages, c.named, c.footnotes, c.regions, c.statements, c.biographies)


_FEATURES = f"""{_RULES}, f AS (
  SELECT k, page_id, pos, key, 'teachers' AS kind, unnest(list_distinct([{_sql_name('person + 1', PLAIN)}, {_sql_name('k % 5 + 20', PLAIN)}])) AS name FROM x
  UNION ALL SELECT k, page_id, pos, key, 'students', unnest(list_distinct([{_sql_name('person + 9', PLAIN)}, {_sql_name('k % 7 + 40', PLAIN)}])) FROM x)"""


@query(f"WITH {_FEATURES} SELECT page_id AS entry_page, pos::INT AS entry_start, key AS name_key, kind, name FROM f")
def relationship_features(t: Tables) -> DataFrame:
    """Teachers and students that openings list."""
    c = _Corpus(t)
    return _placed(c, c.features)


_GAPS = f"""{_FEATURES}, file AS (SELECT k, key || '/f' || (page // {A_FILE}) AS identity, 'b' || (page // {A_FILE} % 5) AS book FROM x),
pr AS (SELECT a.key, least(a.page_id || '/' || a.pos, b.page_id || '/' || b.pos) AS l, greatest(a.page_id || '/' || a.pos, b.page_id || '/' || b.pos) AS r, a.k AS ak, b.k AS bk, count(*) FILTER (a.kind = 'teachers') AS teachers, count(*) FILTER (a.kind = 'students') AS students
  FROM f a JOIN f b ON a.key = b.key AND a.kind = b.kind AND a.name = b.name AND a.k < b.k GROUP BY 1, 2, 3, 4, 5),
gap AS (SELECT pr.*, CASE WHEN teachers > 0 AND students > 0 AND teachers + students >= 3 THEN 'both_lists_3plus' WHEN teachers >= 3 OR students >= 3 THEN 'one_list_3plus' ELSE 'weak_overlap' END AS priority, x.identity AS ai, y.identity AS bi, x.book AS ab, y.book AS bb
  FROM pr JOIN file x ON x.k = ak JOIN file y ON y.k = bk WHERE x.identity <> y.identity)"""


@query(f"WITH {_GAPS} SELECT l, r, key AS name_key, teachers::INT AS teachers, students::INT AS students, priority, least(ai, bi) AS one_identity, greatest(ai, bi) AS other_identity, least(ab, bb) AS one_book, greatest(ab, bb) AS other_book FROM gap")
def relationship_gaps(t: Tables) -> DataFrame:
    """Pairs of a name with common names and two identities."""
    c = _Corpus(t)
    places = c.entries.select("entry_id", F.concat_ws("/", "page_id", F.col("start_offset").cast("string")).alias("place"))
    view = c.identified(c.openings).join(places, "entry_id")
    got = identity.relationship_gaps(c.features, view, most_group=None, more=("place",), brief=True)
    pair = lambda c, one, other: [F.least(f"left_{c}", f"right_{c}").alias(one), F.greatest(f"left_{c}", f"right_{c}").alias(other)]
    return got.select(*pair("place", "l", "r"), "name_key", "teachers", "students", "priority", *pair("identity", "one_identity", "other_identity"), *pair("book", "one_book", "other_book"))


_GRAPH = f"""{_GAPS}, obs AS (
  SELECT DISTINCT side.identity, side.own, side.other, CASE fa.kind WHEN 'teachers' THEN 'teacher' ELSE 'student' END AS relation, fa.name FROM gap
  JOIN f fa ON fa.k = gap.ak JOIN f fb ON fb.k = gap.bk AND fa.kind = fb.kind AND fa.name = fb.name
  CROSS JOIN LATERAL (VALUES (ai, ak, bk), (bi, bk, ak)) AS side(identity, own, other))"""


@query(f"WITH {_GRAPH} SELECT identity AS identity_id, relation, 'mention-' || left(sha256(name), 32) AS mention_id, count(DISTINCT own) AS entries, count(*) AS observations FROM obs GROUP BY 1, 2, name")
def relationship_graph(t: Tables) -> DataFrame:
    """Names that identities are linked to."""
    return _Corpus(t).neighbors


_M = f"'mention-' || left(sha256({_sql_name('20', PLAIN)}), 32)"


@query(f"""WITH {_GRAPH}, nb AS (SELECT identity, relation, count(DISTINCT own) AS entries, count(*) AS observations FROM obs WHERE 'mention-' || left(sha256(name), 32) = {_M} GROUP BY 1, 2),
who AS (SELECT key || '/f' || (page // {A_FILE}) AS identity, any_value(label) AS display_name FROM x GROUP BY 1)
SELECT identity AS identity_id, relation, entries, observations, 'provisional_cluster' AS identity_kind, display_name FROM nb JOIN who USING (identity) ORDER BY entries DESC, observations DESC, identity, relation LIMIT 30""")
def api_graph_mention(t: Tables) -> DataFrame:
    """The endpoint's first page, with labels looked up for it only (API:graph/mention, J28)."""
    import hashlib

    mention = "mention-" + hashlib.sha256(f"{PLAIN[20 % 8]} بن {PLAIN[20 // 8 % 8]}".encode()).hexdigest()[:32]
    return api.graph_mention(_Corpus(t), mention).select("identity_id", "relation", "entries", "observations", "identity_kind", "display_name")


@query(f"WITH {_GRAPH}, own AS (SELECT key || '/f' || (page // {A_FILE}) AS identity FROM x WHERE k = 0) SELECT relation, 'mention-' || left(sha256(name), 32) AS mention_id, count(DISTINCT own.own) AS entries, count(*) AS observations FROM obs AS own JOIN own AS me USING (identity) GROUP BY relation, name ORDER BY entries DESC, observations DESC, relation, mention_id LIMIT 30")
def api_identity_graph(t: Tables) -> DataFrame:
    return api.identity_graph(_Corpus(t), _id(0)).select("relation", "mention_id", "entries", "observations")


@query(f"WITH {_RULES}, who AS (SELECT key || '/f' || (page // {A_FILE}) AS identity, count(*) AS n FROM x GROUP BY 1) SELECT identity AS identity_id, 'provisional_cluster' AS identity_kind, label AS display_name, n AS entry_count FROM x JOIN who ON identity = key || '/f' || (page // {A_FILE}) WHERE k = 0")
def api_identity_entry(t: Tables) -> DataFrame:
    return api.identity_entry(_Corpus(t), _id(0)).select("identity_id", "identity_kind", "display_name", "entry_count")


@query(f"""WITH {_DATED}, c AS (SELECT page_id, key || '/f' || (page // {A_FILE}) AS identity, year, CASE WHEN form = 0 THEN '(ت ' || y || ' هـ' ELSE died END AS quote FROM rec WHERE NOT unsure AND year IS NOT NULL),
pick AS (SELECT min(identity) AS identity FROM c), ys AS (SELECT identity, min(year) AS lo, array_to_string(list_sort(list(DISTINCT year)), ',') AS years FROM c GROUP BY 1)
SELECT identity AS identity_id, year::INT AS year, quote, page_id, years, 1::INT AS bucket_size, lo::INT AS bucket_start, lo::INT AS bucket_end FROM c JOIN pick USING (identity) JOIN ys USING (identity)""")
def api_identity_dates(t: Tables) -> DataFrame:
    """The dates of the first dated identity (API:identity/dates, E21). A name with two years has none, so that a bucket is one year."""
    c = _Corpus(t)
    first = c.claims.agg(F.min(F.struct("identity_id", "entry_id")).alias("f")).select("f.entry_id").first()
    return api.identity_dates(c, first[0] if first[0] else "").select("identity_id", "year", "quote", "page_id", "years", "bucket_size", "bucket_start", "bucket_end")


@query(f"WITH {_RULES} SELECT page_id, heading AS title, pos::INT AS start_offset, (pos + len)::INT AS end_offset, heading || chr(10) || l1 || chr(10) || l2 || chr(10) || l3 || chr(10) || CASE WHEN died <> '' THEN died || chr(10) ELSE '' END AS text FROM x WHERE k = 0")
def api_entry(t: Tables) -> DataFrame:
    return api.entry(_Corpus(t), _id(0)).select("page_id", "title", "start_offset", "end_offset", "text")


@query(f"WITH {_RULES} SELECT 'p6' AS page_id, 'p5' AS previous_id, 'p7' AS next_id, count(*)::INT AS entries, 2 * count(*)::INT AS mentions, 1::BIGINT AS source_count, '1/6' AS label, 0 AS spans FROM x WHERE page = 6")
def api_page_record(t: Tables) -> DataFrame:
    got = api.page_record(_Corpus(t), "p6")
    return got.select("page_id", "previous_id", "next_id", F.size("entries").alias("entries"), F.size("mentions").alias("mentions"), "source_count", "citation.label", F.coalesce(F.size("spans"), F.lit(0)).alias("spans"))


@query(f"WITH {_RULES}, s AS (SELECT page_id, page, pos::INT AS start_offset, (pos + len + CASE WHEN last AND page % 4 = 1 THEN {len(NOTE)} ELSE 0 END)::INT AS end_offset, label FROM x WHERE k = 5) SELECT page_id, start_offset, end_offset, 'opening' AS role, label AS name_label FROM s UNION ALL SELECT 'p' || (page + 1), 0, {len(REST)}, 'continuation', label FROM s WHERE (page + 1) % 5 = 2")
def api_biography(t: Tables) -> DataFrame:
    """A biography that goes on overleaf (API:biography)."""
    c = _Corpus(t)
    five = c.entries.where(F.col("title").startswith("5 - ")).select("entry_id").first()[0]
    return api.biography(c, five).select("page_id", "start_offset", "end_offset", "role", "name_label")


@query("WITH d AS (SELECT doc_id, sha256(text) AS sha, text FROM documents), l AS (SELECT doc_id, sha, unnest(string_split(text, chr(10))) AS line FROM d), p AS (SELECT DISTINCT sha256(line) AS passage, doc_id, sha FROM l WHERE length(trim(line, ' ' || chr(9) || chr(13))) >= 80), c AS (SELECT passage, count(*) AS n FROM p GROUP BY 1), own AS (SELECT sha FROM p JOIN c USING (passage) WHERE n > 1 ORDER BY doc_id LIMIT 1) SELECT DISTINCT passage AS passage_id, n AS source_occurrences FROM p JOIN own USING (sha) JOIN c USING (passage) WHERE n > 1")
def api_duplicates(t: Tables) -> DataFrame:
    """Passages of a document that other documents hold, too (API:duplicates): the first that has any."""
    pages_ = t.documents.select(F.col("doc_id").alias("page_id"), F.sha2("text", 256).alias("text_sha256"), "text")
    where = materialize(corpus.passages(corpus.texts(pages_))[0].dropDuplicates(["passage_id", "text_sha256"]))
    on = where.join(pages_.select("page_id", "text_sha256"), "text_sha256")
    shared = on.groupBy("passage_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = on.join(shared, "passage_id", "left_semi").orderBy("page_id").select("text_sha256").first()
    return api.duplicates({"pages": pages_, "passage_locations": where}, own[0] if own else "").select("passage_id", "source_occurrences")


@query("WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents), p AS (SELECT sha256(line) AS passage, doc_id, source FROM l WHERE length(trim(line, ' ' || chr(9) || chr(13))) >= 80), m AS (SELECT passage FROM p GROUP BY 1 ORDER BY count(*) DESC, passage LIMIT 1) SELECT doc_id::VARCHAR AS page_id, source AS title FROM p JOIN m USING (passage) ORDER BY title, page_id LIMIT 100")
def api_passage_sources(t: Tables) -> DataFrame:
    """Where the most frequent passage stands (API:passage-sources)."""
    pages_ = t.documents.select(F.col("doc_id").cast("string").alias("page_id"), F.sha2("text", 256).alias("text_sha256"), "text", F.col("source").alias("title"))
    where = corpus.passages(corpus.texts(pages_))[0]
    held = where.join(pages_.select("text_sha256"), "text_sha256").groupBy("passage_id").count().orderBy(F.desc("count"), "passage_id").first()
    return api.passage_sources({"passage_locations": where, "citations": pages_.drop("text")}, held[0] if held else "").select("page_id", "title")


@query(f"WITH {_RULES}, a AS (SELECT l1 AS q, a1 AS pos, page_id FROM x WHERE k = 0 UNION ALL SELECT l2, a2, page_id FROM x WHERE k = 0 UNION ALL SELECT l3, a3, page_id FROM x WHERE k = 0 UNION ALL SELECT died, a4, page_id FROM x WHERE k = 0 AND died <> ''), b AS (SELECT l1 AS q, a1 AS pos, page_id FROM x WHERE k = 24 UNION ALL SELECT l2, a2, page_id FROM x WHERE k = 24 UNION ALL SELECT l3, a3, page_id FROM x WHERE k = 24) SELECT q AS quote, a.pos::INT AS left_start, b.pos::INT AS right_start FROM a JOIN b USING (q)")
def compared_entries(t: Tables) -> DataFrame:
    """Every quote that two entries share, with every other (E26, J20): the first with itself under another id, and the second."""
    c = _Corpus(t)
    second = c.entries.where(F.col("title").startswith("24 - ")).select("entry_id").first()[0]
    said = c.statements.select("quote", "biography_id", "page_id", "start")
    return review.compare(said, c.records.select("entry_id", F.col("death_year").alias("year")), _id(0), second)[0].select("quote", "left_start", "right_start")


@query(f"WITH {_RULES}, s AS (SELECT k, l1 || ' ' || l3 AS q FROM x) SELECT k, (length(q) - length(replace(q, 'روى عن', '')) ) // 6 AS teachers, 1::BIGINT AS assessments FROM s")
def sql_table_functions(t: Tables) -> DataFrame:
    """Statements by a table function in SQL (2.15): LATERAL joins of registered functions."""
    spark = t._spark
    tables.register(spark)
    e = entries_by_rule(t).select("k", F.split("body", "\n").alias("l"))
    e.select("k", F.concat(F.get("l", F.lit(0)), F.lit(" "), F.get("l", F.lit(2))).alias("q")).createOrReplaceTempView("quill_lines")
    return spark.sql("SELECT k, count_if(s.quote LIKE '%روى عن%') AS teachers, count_if(s.attribution_text IS NOT NULL) AS assessments FROM quill_lines, LATERAL quill_statements(q) AS s GROUP BY k")


# Single functions, over whole tables


@query(f"""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 9 AS form, 1 + o_orderkey * 13 % 1600 AS n, o_orderkey % 3 AS h, o_orderkey % 8 AS t FROM orders),
w AS (SELECT *, CASE form WHEN 0 THEN n || ' هـ' WHEN 1 THEN n::VARCHAR WHEN 2 THEN 'نحو ' || n WHEN 3 THEN n || ' م' WHEN 4 THEN n || ' أو ' || (n + 1) WHEN 5 THEN {_sql_list(HUNDRED)}[h + 1] || ' و' || {_sql_list(TENS)}[t + 1] WHEN 6 THEN {_sql_list(TENS)}[t + 1] WHEN 7 THEN 'خمس و' || {_sql_list(TENS)}[t + 1] || ' و' || {_sql_list(HUNDRED)}[h + 1] ELSE 'كلام' END AS fragment FROM o)
SELECT k, CASE WHEN form = 0 AND n <= 1450 THEN n WHEN form = 1 AND n BETWEEN 100 AND 1450 THEN n WHEN form = 5 THEN 100 * (h + 1) + 10 * (t + 2) WHEN form = 7 THEN 100 * (h + 1) + 10 * (t + 2) + 5 END::INT AS year,
  CASE WHEN form = 2 THEN 'approximate_or_range' WHEN form = 3 THEN 'gregorian_only' WHEN form = 4 THEN 'conflicting_or_range' WHEN form IN (0, 1) AND n > 1450 THEN 'out_of_supported_hijri_range' WHEN form = 0 THEN 'explicit_hijri' WHEN form = 1 AND n < 100 THEN 'short_year_needs_century'
  WHEN form = 1 THEN 'hijri_assumed_from_death_context' WHEN form = 6 THEN 'short_year_needs_century' WHEN form = 8 THEN 'unparsed_date' ELSE 'hijri_assumed_from_death_context' END AS status FROM w""")
def death_year_parse(t: Tables) -> DataFrame:
    """Years in numerals and words, vague, doubtful, of another calendar, or none (F8)."""
    k, n, h, ten = F.col("o_orderkey"), 1 + F.col("o_orderkey") * 13 % 1600, _pick(HUNDRED, F.col("o_orderkey") % 3), _pick(TENS, F.col("o_orderkey") % 8)
    s = n.cast("string")
    forms = [F.concat(s, F.lit(" هـ")), s, F.concat(F.lit("نحو "), s), F.concat(s, F.lit(" م")), F.concat(s, F.lit(" أو "), (n + 1).cast("string")), F.concat(h, F.lit(" و"), ten), ten, F.concat(F.lit("خمس و"), ten, F.lit(" و"), h)]
    fragment = F.lit("كلام")
    for i in reversed(range(8)):
        fragment = F.when(k % 9 == i, forms[i]).otherwise(fragment)
    y = tables.parse_year(fragment)
    return t.orders.select(k.alias("k"), y.alias("y")).select("k", "y.year", "y.status")


MARKED = ("مُحَمَّد", "أَحْمَد", "عَلِيّ", "صَالِح", "يُوسُف", "خَالِد", "جَابِر", "حُسَيْن")


@query(f"SELECT c_custkey AS k, {_sql_list(PLAIN)}[c_custkey % 8 + 1] || ' بن ' || {_sql_list(PLAIN)}[c_custkey // 8 % 8 + 1] AS normalized, {_sql_list(PLAIN)}[c_custkey % 8 + 1] || ' ' || {_sql_list(PLAIN)}[c_custkey // 8 % 8 + 1] AS name_key FROM customer")
def name_normalize(t: Tables) -> DataFrame:
    """Keys of marked names (F1, F3): marks, alefs, `son` at its edges, white space and digits."""
    k = F.col("c_custkey")
    a, b = _pick(MARKED, k % 8), _pick(MARKED, F.floor(k / 8) % 8)
    written = F.concat(F.lit("  "), a, F.when(k % 2 == 0, F.lit("\tابن  ")).otherwise(F.lit(" بن ")), b, F.lit("ـ "))
    listed = F.concat(F.lit("("), a, F.lit("، "), b, F.lit(" ١٢)"))
    return t.customer.select(k.alias("k"), normalize(written).alias("normalized"), name_key(listed).alias("name_key"))


_KUNYA = ("أبو", "أبي", "أبا")


@query(f"WITH s AS (SELECT s_suppkey, 'ابو عبدالله بن ' || {_sql_list(PLAIN)}[s_suppkey // 6 % 8 + 1] || ' رفاعه' AS signature, (s_suppkey % 3)::VARCHAR || (s_suppkey % 2)::VARCHAR AS spelling FROM supplier) SELECT 'variant-' || left(sha256(signature), 32) AS bucket_id, count(*) AS entries, count(DISTINCT spelling) AS names FROM s GROUP BY signature HAVING count(DISTINCT spelling) > 1")
def variant_families(t: Tables) -> DataFrame:
    """Names whose spellings share a signature."""
    k = F.col("s_suppkey")
    name = F.concat(_pick(_KUNYA, k % 3), F.when(k % 2 == 0, F.lit(" عبد الله بن ")).otherwise(F.lit(" عبدالله بن ")), _pick(NAMES, F.floor(k / 6) % 8), F.lit(" رفاعة"))
    got = identity.variant_entries(t.supplier.select(k.alias("entry_id"), name.alias("name_key")))
    return got.groupBy("bucket_id").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("name_key").alias("names"))


@query(f"""WITH l AS (SELECT p_partkey AS k, p_partkey % 64 AS a, (p_partkey + 5) % 64 AS b, (p_partkey + 11) % 64 AS c, (p_partkey + 23) % 64 AS d FROM part),
n AS (SELECT k, [{_sql_name('a', PLAIN)}, {_sql_name('b', PLAIN)}, {_sql_name('c', PLAIN)}, {_sql_name('d', PLAIN)}] AS names FROM l)
SELECT k AS id, i - 1 AS i, names[i] AS name, names[i + 1] AS next_name FROM n, (SELECT unnest(range(1, 5)) AS i)""")
def chain_parse(t: Tables) -> DataFrame:
    """Names of chains of transmission, each with the next."""
    got = _chains(t)
    return got.select("id", "i", "name", "next_name")


def _chains(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    n = [_name((k + x) % 64) for x in (0, 5, 11, 23)]
    text = F.concat(F.lit("كلام قبله. قال: حَدَّثَنا "), n[0], F.lit(" عن "), n[1], F.lit("، قال: أخبرنا "), n[2], F.lit(" عن "), n[3], F.lit(" أن رسول الله قال عن "), n[0])
    got = t.part.select(k.alias("id"), lists.chain(text).alias("c"))
    return got.select("id", F.posexplode("c").alias("i", "name"), "c").select("id", "i", "name", F.get("c", F.col("i") + 1).alias("next_name"))


@query(f"""WITH l AS (SELECT p_partkey AS k, [p_partkey % 64, (p_partkey + 5) % 64, (p_partkey + 11) % 64, (p_partkey + 23) % 64] AS j FROM part), q AS (SELECT k, i, j[i] AS a, j[i + 1] AS b FROM l, (SELECT unnest(range(1, 4)) AS i))
SELECT CASE WHEN a % 2 = 1 THEN 'unknown' WHEN b = (a + 5) % 64 THEN 'found' ELSE 'missing' END AS state, count(*) AS n FROM q GROUP BY 1""")
def chain_states(t: Tables) -> DataFrame:
    """Links of chains that recorded teachers hold, don't hold, or say nothing of (J30, J31): names of an even number have one teacher."""
    edges = t._spark.range(0, 64, 2).select(F.translate(_name(F.col("id")), "أ", "ا").alias("student"), F.concat(F.translate(_name((F.col("id") + 5) % 64), "أ", "ا"), F.when(F.col("id") % 4 == 0, F.lit(" الكوفي")).otherwise("")).alias("teacher"))
    return api.chain_edges(_chains(t), edges).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_PHRASE = ("إسناده ضعيف", "إِسْنَادُهُ  صحيح", "هذا حديث حسن", "بلا حكم")
_GRADE = ("weak", "sahih", "hasan")


@query(f"""WITH g AS (SELECT p_partkey AS k, p_partkey % 4 AS a, p_partkey // 4 % 4 AS b, p_partkey % 5 = 0 AS two, p_partkey % 7 = 0 AS far FROM part),
s AS (SELECT *, [x for x in [{_sql_list(_GRADE)}[a + 1], CASE WHEN NOT far THEN {_sql_list(_GRADE)}[b + 1] END] if x IS NOT NULL] AS own FROM g)
SELECT k, k::VARCHAR AS number, len(own)::INT AS claims, CASE WHEN list_contains(own, 'weak') AND len(list_distinct(own)) > 1 THEN 'review' WHEN list_contains(own, 'weak') THEN 'weak' WHEN list_contains(own, 'sahih') THEN 'sahih' ELSE 'hasan' END AS status FROM s WHERE NOT two AND len(own) > 0""")
def grade_claims(t: Tables) -> DataFrame:
    """Grades that a page with one numbered report states, in its text and near the beginning of its note."""
    from quillspark.plans.reader import grade_status

    k = F.col("p_partkey")
    head = F.concat(k.cast("string"), F.lit(" - متن "), _pick(_PHRASE, k % 4), F.lit(".\n"), F.when(k % 5 == 0, F.lit("9 - آخر.\n")).otherwise(""))
    far = F.when(k % 7 == 0, F.lit("كلام " * 40)).otherwise("")
    rows = t.part.select(k.alias("k"), head.alias("h"), F.concat(head, far, _pick(_PHRASE, F.floor(k / 4) % 4)).alias("text"))
    second = F.length("h") - F.length(F.lit("9 - آخر.\n"))
    starts = F.when(F.col("k") % 5 == 0, F.array(F.lit(0), second)).otherwise(F.array(F.lit(0)))
    notes = F.array(F.struct(F.length("h").alias("start"), F.length("text").alias("end")))
    got = rows.select("k", lists.report_numbers(F.col("text"), starts).alias("n"), lists.claims(F.col("text"), notes).alias("c")).where("size(n) = 1 AND size(c) > 0")
    return got.select("k", F.get("n", F.lit(0)).alias("number"), F.size("c").alias("claims"), grade_status(F.transform("c", lambda x: x["status"])).alias("status"))


@query(f"""WITH r AS (SELECT p_partkey AS k, p_partkey % 6 AS form, {_sql_name('p_partkey')} || ' بن ' || {_sql_list(NAMES)}[p_partkey % 8 + 1] AS n FROM part)
SELECT k, CASE form WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n WHEN 3 THEN n ELSE NULL END AS label FROM r""")
def name_labels(t: Tables) -> DataFrame:
    """Names in headings: numbered, cut at punctuation, verbs, judgements; titles of chapters and single names have none."""
    k = F.col("p_partkey")
    n = F.concat(_name(k), F.lit(" بن "), _pick(NAMES, k % 8))
    heading = F.when(k % 6 == 0, F.concat(k.cast("string"), F.lit(" - "), n, F.lit("، والد فلان"))).when(k % 6 == 1, F.concat(n, F.lit(" [خ م] ثقة"))).when(k % 6 == 2, F.concat(F.lit("‏٣٤ - "), n, F.lit(" توفي سنة 200"))).when(k % 6 == 3, F.concat(n, F.lit(" (ت 230)"))).when(k % 6 == 4, F.concat(F.lit("باب "), n)).otherwise(_pick(NAMES, k % 8))
    return t.part.select(k.alias("k"), years.name_label(heading).alias("label"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'catalogue_or_index_candidate' WHEN 1 THEN 'cross_reference_candidate' WHEN 2 THEN 'short_index_candidate' ELSE 'biography_candidate' END AS kind FROM part""")
def entry_classes(t: Tables) -> DataFrame:
    """Kinds of entries by what their openings say."""
    k = F.col("p_partkey")
    name = F.concat(_name(k), F.lit("\n"))
    text = F.when(k % 5 == 0, F.concat(F.lit("فهرس الأسماء\n"), name)).when(k % 5 == 1, F.concat(name, F.lit("تقدم ذكره."))).when(k % 5 == 2, F.concat(name, F.lit("(٣/ "), k.cast("string"), F.lit(")"))).when(k % 5 == 3, F.concat(name, F.lit("تقدم ذكره. "), F.lit("كلام طويل " * 40))).otherwise(F.concat(name, F.lit("ثقة.")))
    rows = t.part.select(k.alias("k"), text.alias("text"), F.length(name).alias("head"))
    head = F.when(F.col("k") % 5 == 0, F.col("head") + 13).otherwise(F.col("head"))
    return rows.select("k", statements.classify(F.col("text"), F.lit(0), F.length("text"), head.cast("int")).alias("kind"))


@query("""WITH d AS (SELECT doc_id, text, length(text) // 2 AS m FROM documents WHERE length(text) >= 120),
s AS (SELECT *, substr(text, m + 1, 30) AS q, substr(text, m - 23, 78) AS around FROM d)
SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR substr(text, m - 4, 30) = q THEN m WHEN len(list_filter(range(0, length(text) - 77), lambda i: substr(text, i + 1, 78) = around)) = 1 THEN m + 5 END::INT AS now FROM s""")
def reanchored_quotes(t: Tables) -> DataFrame:
    """Quotes that are found again after five characters were put before them (T13): at their offset, else by their
    neighbourhood; where a repeated text holds it more than once, the place isn't told."""
    n = F.length("text")
    d = t.documents.where(n >= 120).select("doc_id", "text", F.floor(n / 2).cast("int").alias("m"))
    part = lambda a, b: native.slice_of(F.col("text"), F.col("m") + a, F.col("m") + b)
    moved = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("#" * 5), F.col("text")))
    rows = d.select("doc_id", "m", moved.alias("moved"), part(0, 30).alias("q"), part(-24, 0).alias("b"), part(30, 54).alias("a"))
    return rows.select("doc_id", passages.reanchor(F.col("moved"), F.col("q"), F.col("m"), F.col("b"), F.col("a")).cast("int").alias("now"))


@query(f"WITH {_RULES} SELECT k, CASE WHEN form = 0 THEN 1 ELSE 0 END::INT AS in_note, (length(heading) + 1)::INT AS start FROM x")
def mention_offsets(t: Tables) -> DataFrame:
    """The first relationship word of each entry's own text, by place."""
    e = entries_by_rule(t).select("k", F.concat("heading", F.lit("\n"), "body").alias("text"), F.when(F.col("heading").contains("(ت "), F.array(F.struct(F.lit(0).alias("start"), (F.length("heading") + 2).alias("end")))).otherwise(F.array().cast(tables.SPANS)).alias("notes"))
    m = F.get(headings.mentions(F.col("text"), F.col("notes")), F.lit(0))
    return e.select("k", m["in_footnote"].cast("int").alias("in_note"), m["start"].alias("start"))


@query(f"WITH {_RULES} SELECT count(*) AS entries, count(DISTINCT page_id || '/' || pos) AS ids FROM x")
def entry_ids(t: Tables) -> DataFrame:
    """Ids of entries are made of page and place: as many as there are entries, and the same on every run."""
    c = _Corpus(t)
    again = c.entries.where(F.col("entry_id") == content_id(F.col("page_id"), F.col("start_offset").cast("string")))
    return again.agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("entry_id").alias("ids"))
