"""Books for the reader: page index, volumes, contents, grades, notes, ranked search (W8, W12, A31, J29, L7, L8, 2.16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.lists import DECOMPOSED_FROM, DECOMPOSED_TO
from quillspark.functions.native import SPACE, strip
from quillspark.functions.passages import toc_level


def page_index(pages: DataFrame, book: str, order: list[str]) -> DataFrame:
    """page: the place of each page in its book, over all of its files, from 0."""
    return pages.withColumn("page", (F.row_number().over(W.partitionBy(book).orderBy(*order)) - 1).cast("long"))


def volumes(pages: DataFrame, book: str, part: str, page: str = "page") -> DataFrame:
    """Pages where the part label changes: a volume begins."""
    before = F.lag(part).over(W.partitionBy(book).orderBy(page))
    first = F.row_number().over(W.partitionBy(book).orderBy(page)) == 1
    return pages.withColumn("__new", first | ~before.eqNullSafe(F.col(part))).where("__new").select(book, F.col(part).alias("title"), page)


def volume_of(pages: DataFrame, vols: DataFrame, book: str, page: str = "page") -> DataFrame:
    """Each page with the title of the last volume that starts at or before it: an as-of join by one window."""
    both = pages.select(book, F.col(page).alias("page"), F.lit(None).cast("string").alias("title"), F.lit(1).alias("o")).unionByName(vols.select(book, F.col(page).alias("page"), "title", F.lit(0).alias("o")))
    upto = W.partitionBy(book).orderBy("page", "o").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("volume", F.last(F.when(F.col("o") == 0, F.struct("title")), ignorenulls=True).over(upto)["title"]).where("o = 1").select(book, "page", "volume")


def contents(headings: DataFrame, title: str = "title") -> DataFrame:
    """Headings that are shown, with their level."""
    return headings.withColumn("level", toc_level(F.col(title))).where("level IS NOT NULL")


def grade_status(statuses: Column) -> Column:
    """A page's grade from the grades it states: weak beside another needs review, else weak, sahih, hasan."""
    weak = F.array_contains(statuses, "weak")
    return F.when(weak & (F.size(F.array_distinct(statuses)) > 1), "review").when(weak, "weak").when(F.array_contains(statuses, "sahih"), "sahih").when(F.array_contains(statuses, "hasan"), "hasan")


def grade_counts(pages: DataFrame, book: str, status: str = "status") -> DataFrame:
    """Pages of each grade, by book."""
    return pages.groupBy(book).pivot(status, ["weak", "sahih", "hasan", "review"]).agg(F.count(F.lit(1))).na.fill(0)


def next_graded(pages: DataFrame, book: str, status: str, wanted: str = "sahih", page: str = "page") -> DataFrame:
    """next_page: the nearest later page of a book with the grade."""
    later = W.partitionBy(book).orderBy(page).rowsBetween(1, W.unboundedFollowing)
    return pages.withColumn("next_page", F.min(F.when(F.col(status) == wanted, F.col(page))).over(later))


def ranked(rows: DataFrame, key: str, heading: Column, graded: Column, priority: Column, limit: int = 20) -> DataFrame:
    """Results of several searches, each row once: headings that match first, then graded ones, then by book."""
    once = rows.withColumn("__h", heading).withColumn("__g", graded).withColumn("__p", priority).dropDuplicates([key])
    return once.orderBy(F.desc("__h"), F.desc("__g"), "__p", key).limit(limit).drop("__h", "__g", "__p")


# Judgements that a heading may state; books by their rank, with one that companions come first in.
ASSESSMENT = (
    "جبل الحفظ وإمام الدنيا في فقه الحديث|ليس بثقة|ليس بالقوي|متهم بالكذب|كذاب|ضعيف(?: جدا)?|متروك|مجهول|لين الحديث|سيئ الحفظ|"
    "ثقة(?: ثبت| حافظ| مأمون)?|صدوق(?: له أوهام| يخطئ| سيئ الحفظ)?|مقبول|لا بأس به|صحابي(?:ة)?"
)
COMPANIONS = ("سلم الوصول إلى طبقات الفحول", "الإصابة في تمييز الصحابة", "الاستيعاب في معرفة الأصحاب", "أسد الغابة في معرفة الصحابة", "معرفة الصحابة")
SUMMARY, REVISION, COMPLETION, NOT_COMPLETION = "تقريب التهذيب", "تهذيب التهذيب", "تهذيب الكمال", ("إكمال", "تذهيب")


def person_fold(name: Column) -> Column:
    """A name as the reader compares headings (F17): no marks, plain alef and yeh, `son of` in one form, single spaces."""
    t = F.regexp_replace(F.translate(name, DECOMPOSED_FROM, DECOMPOSED_TO), "[\u064b-\u065f\u0670]", "")
    t = F.regexp_replace(F.translate(t, "ٱى", "اي"), rf"(\A|{SPACE})ابن(?={SPACE}|\z)", "$1بن")
    return strip(F.regexp_replace(F.regexp_replace(t, "[\u200b-\u200f\u0640]", ""), f"{SPACE}+", " "))


def heading_match(title: Column, name: Column) -> Column:
    """Whether a heading, without its numbering, begins with the name."""
    head = F.regexp_replace(person_fold(title), rf"\A(?:{SPACE}|[\p{{Nd}}.()\-–«»\"“”])+", "")
    return head.startswith(person_fold(name))


def priority(title: Column, companion: Column) -> Column:
    """A book's rank among a person's sources; books on companions come second if the person is one."""
    of = lambda *names: reduce(lambda a, b: a | b, (F.contains(title, F.lit(n)) for n in names))
    one = companion.cast("int")
    return F.when(of(SUMMARY), 0).when(companion & of(*COMPANIONS), 1).when(of(REVISION), 1 + one).when(of(COMPLETION) & ~of(*NOT_COMPLETION), 2 + one).when(of(*COMPANIONS), 4).otherwise(5)


def assessment(heading: Column, title: Column) -> Column:
    """The judgement that a heading of the summary states, null elsewhere."""
    found = F.regexp_extract(heading, f"({ASSESSMENT})", 1)
    return F.when(F.contains(title, F.lit(SUMMARY)) & (found != ""), found)


def contents_between(headings: DataFrame, first: int, last: int, page: str = "page") -> DataFrame:
    """Headings of a volume: those on its pages, from first to last."""
    return headings.where(F.col(page).between(first, last))


def note_index(typed: DataFrame, ink: DataFrame, pages: DataFrame) -> DataFrame:
    """All notes, typed or drawn, in page order; those whose page is unknown come last.

    typed: page_id, text. ink: page_id, strokes. pages: page_id, book, page.
    """
    both = typed.join(ink, "page_id", "full_outer").where((F.trim("text") != "") | (F.col("strokes") > 0))
    return both.join(pages.select("page_id", "book", "page"), "page_id", "left").orderBy(F.asc_nulls_last("book"), F.asc_nulls_last("page"), "page_id")
