"""Names in lists of teachers and students, name chains, graded reports, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.arabic import NAME_FROM, NAME_MARKS, NAME_TO, name_key, tolerant
from quillspark.functions.native import SPACE, bound, has, matches, strip, until

# List markers (of students with the last word), what ends a list, what separates names, what isn't in one.
MARKER = rf"(?:روى|روي){SPACE}+عنه{SPACE}*[:：]?|وعنه{SPACE}*[:：]?|(?:روى|روي){SPACE}+عن(?!ه){SPACE}*[:：]?"
OF_STUDENTS = "عنه"
LIST_END = rf"[.؛\n]|{SPACE}+قال{SPACE}|{SPACE}+حدثنا{SPACE}"
LIST_SPLIT = rf"،|,|{SPACE}+و(?=[ا-ي]{{3}})"
NOT_IN_NAMES = ("غيره", "جماعة", "اخرون", "عدة", "قال", "حديث", "كتاب", "توفي", "مات", "ثقة", "يعني", "نسخة", "بلغني", "باس", "روى", "روي", "سمع", "حدث", "يروي", "ليس", "عندهم", "ضعيف")
LIST_REACH, SHORTEST_NAME, FEWEST_WORDS, MOST_WORDS = 360, 8, 2, 6
# Transmission words of a chain, `from` being the weak one, what ends a chain or a name, what isn't one.
STRONG = ("حدثنا", "حدثني", "اخبرنا", "اخبرني", "انبانا", "سمعت", "ثنا")
WEAK = "عن"
CHAIN_END = ("ان رسول الله", "ان النبي", "قال رسول الله", "قال النبي", "ذكر النبي", "صلى الله عليه وسلم")
NAME_END = rf"{SPACE}+قال(?:{SPACE}|[:،.]|\z)|[:،.؛\n]|{SPACE}+ان{SPACE}+"
NOT_A_LINK = ("رسول", "النبي", "الله")
CHAIN_REACH, CHAIN_NAMES = 6000, 12
#: Canonical decomposition of the Arabic letters that have one, without the marks, which are dropped with all others.
DECOMPOSED_FROM, DECOMPOSED_TO, CHAIN_MARKS = "أإآؤئۀۂۓ", "اااويەہے", "[ً-ٰٟ​‌]"
# Grade phrases, by grade; a chain's word; a report's number.
GRADES = {
    "weak": ("اسناده ضعيف", "ضعيف الاسناد", "هذا حديث ضعيف"),
    "sahih": ("اسناده صحيح", "صحيح الاسناد", "هذا حديث صحيح", "صحيح لغيره"),
    "hasan": ("هذا حديث حسن", "اسناده حسن", "حديث حسن"),
}
CHAIN_WORD, REPORT_NUMBER, NUMBER_REACH, NOTE_REACH = "اسناد", rf"\A(?:[​‌]|{SPACE})*(\p{{Nd}}+){SPACE}*[-–]", 25, 160


def _listed(tail: Column) -> Column:
    """Names in the stretch after a marker."""
    own = until(until(tail, LIST_END), MARKER)
    names = F.transform(F.split(own, LIST_SPLIT, -1), lambda x: F.regexp_replace(name_key(x), r"\Aو", ""))

    def fits(n: Column) -> Column:
        count = F.size(F.split(F.trim(n), " +"))
        clean = ~F.exists(F.array(*map(F.lit, NOT_IN_NAMES)), lambda bad: F.contains(n, bad))
        return (F.length(n) >= SHORTEST_NAME) & count.between(FEWEST_WORDS, MOST_WORDS) & clean

    return F.filter(names, fits)


def relationships(text: Column) -> Column:
    """struct<teachers,students>: the names that an entry's text lists, each once, sorted."""
    plain = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), NAME_MARKS, ""), NAME_FROM, NAME_TO)
    marked = rf"({MARKER})(?=((?s:.){{0,{LIST_REACH}}}))"

    def found(own: Column) -> Column:
        return F.zip_with(F.regexp_extract_all(own, F.lit(marked), F.lit(1)), F.regexp_extract_all(own, F.lit(marked), F.lit(2)), lambda m, tail: F.struct(F.contains(m, F.lit(OF_STUDENTS)).alias("s"), _listed(tail).alias("names")))

    def both(rows: Column) -> Column:
        of = lambda students: F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(rows, lambda r: r["s"] == students), lambda r: r["names"]))))
        return F.struct(of(False).alias("teachers"), of(True).alias("students"))

    return bound(bound(plain, found), both)


def chain(text: Column, most: int = CHAIN_NAMES) -> Column:
    """array<string>: the names of a chain of transmission, in order. It begins at the first strong word, if there is one.

    Arabic letters are decomposed and lose their marks; other letters stay as they are.
    """
    begin = r"(?:\A|[^\p{L}\p{M}])"
    link = rf"{begin}(?:{'|'.join((*STRONG, WEAK))}){SPACE}+"
    plain = F.regexp_replace(F.translate(F.substring(F.coalesce(text, F.lit("")), 1, CHAIN_REACH), DECOMPOSED_FROM, DECOMPOSED_TO), CHAIN_MARKS, "")
    strong = bound(plain, lambda p: bound(F.regexp_extract(p, rf"(?s)({begin}(?:{'|'.join(STRONG)}){SPACE}+.*)", 1), lambda s: F.when(s != "", s).otherwise(p)))
    own = until(F.regexp_extract(strong, rf"(?s)({link}.*)", 1), "|".join(CHAIN_END))
    parts = F.regexp_extract_all(own, F.lit(rf"(?s){link}(?=(.*?)(?:{link}|\z))"), F.lit(1))
    names = F.transform(parts, lambda x: strip(until(F.regexp_replace(x, rf"\A{SPACE}+", ""), NAME_END)))
    return F.slice(F.filter(names, lambda n: F.length(n).between(3, 139) & ~has(n, rf"\A(?:{'|'.join(NOT_A_LINK)})")), 1, most)


def report_numbers(text: Column, starts: Column) -> Column:
    """The numbers that numbered lines begin with."""
    found = F.transform(starts, lambda a: F.regexp_extract(F.substring(text, a + 1, NUMBER_REACH), REPORT_NUMBER, 1))
    return F.filter(found, lambda n: n != "")


def claims(text: Column, notes: Column) -> Column:
    """array<struct<status,origin,scope,start,end,quote>>: the first statement of each grade in the text and in notes.

    Phrases are looked for in the source itself, whatever marks it has (F5). Far into a note another report is meant.
    """

    def of_status(status: str) -> Column:
        hits = matches(text, "|".join(map(tolerant, GRADES[status])))
        placed = F.transform(hits, lambda h: h.withField("note", F.get(F.filter(notes, lambda n: (n["start"] <= h["start"]) & (h["start"] < n["end"])), F.lit(0))["start"]))

        def told(origin: str, first: Column) -> Column:
            scope = F.when(has(first["quote"], tolerant(CHAIN_WORD)), "chain").otherwise("report")
            return F.when(first.isNotNull(), F.struct(F.lit(status).alias("status"), F.lit(origin).alias("origin"), scope.alias("scope"), first["start"].alias("start"), first["end"].alias("end"), strip(first["quote"]).alias("quote")))

        def firsts(hits: Column) -> Column:
            near = lambda h: h["note"].isNotNull() & (h["start"] - h["note"] <= NOTE_REACH)
            in_text, in_note = F.get(F.filter(hits, lambda h: h["note"].isNull()), F.lit(0)), F.get(F.filter(hits, near), F.lit(0))
            return F.array(bound(in_text, lambda f: told("text", f)), bound(in_note, lambda f: told("note", f)))

        return bound(placed, firsts)

    return F.filter(F.concat(*map(of_status, GRADES)), lambda c: c.isNotNull())
