"""Search keys of Arabic text. Source text is never changed; keys serve search and grouping only.

Three foldings are kept apart, as they are not interchangeable: normalize (search), name_key (names in lists) and
signature (spelling families). Each has a native expression for tables and, where offsets are needed, a Python twin.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks that are dropped, letters and digits that are folded, spaces.
MARKS = "[\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06edـ\u200b-\u200f\ufeff]"
FOLD_FROM, FOLD_TO = "أإآٱى٠١٢٣٤٥٦٧٨٩", "ااااي0123456789"
NAME_MARKS = "[\u064b-\u065f\u0670ـ]"
NAME_FROM, NAME_TO = "أإآى", "اااي"
SIGN_FROM, SIGN_TO = "أإآؤئة", "اااويه"
SPACES = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
KUNYA = ("ابي", "ابا", "ابو")
SERVANT = ("الله", "الرحمن", "العزيز", "الملك", "الوهاب", "الكريم")

_EDGE_L, _EDGE_R = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def normalize(text: Column) -> Column:
    """The search key: no marks, one form of each folded letter, ASCII digits, single spaces, lower case (F1)."""
    t = F.translate(F.regexp_replace(text, MARKS, ""), FOLD_FROM, FOLD_TO)
    t = F.when(F.contains(t, F.lit("ابن")), F.regexp_replace(t, f"{_EDGE_L}ابن{_EDGE_R}", "بن")).otherwise(t)
    return F.lower(F.trim(F.regexp_replace(t, SPACES, " ")))


def name_key(text: Column) -> Column:
    """Letters and single spaces of a name in a list."""
    t = F.translate(F.regexp_replace(text, NAME_MARKS, ""), NAME_FROM, NAME_TO)
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^ء-ي ]", " "), " +", " "))


def signature(text: Column) -> Column:
    """What spelling variants of a name share."""
    t = F.translate(text, SIGN_FROM, SIGN_TO)
    t = F.regexp_replace(t, f"{_EDGE_L}(?:{'|'.join(KUNYA)}){_EDGE_R}", "ابو")
    t = F.regexp_replace(t, f"{_EDGE_L}ابن{_EDGE_R}", "بن")
    t = F.regexp_replace(t, rf"عبد{SPACES}({'|'.join(SERVANT)})", "عبد$1")
    return F.trim(F.regexp_replace(t, SPACES, " "))


def tolerant(term: str) -> str:
    """A pattern for a term in source text: any marks between its letters, any form of alef, any white space."""
    marks = r"[\p{Mn}\u200b\u200c]*"
    out = [rf"{SPACES[:-1]}(?:{SPACES[:-1]}|[\p{{Mn}}\u200b\u200c])*" if c == " " else ("[اأإآٱ]" if c == "ا" else re.escape(c)) for c in term]
    return "".join(x if i + 1 == len(out) or term[i] == " " else x + marks for i, x in enumerate(out))


_MARKS, _FOLD = re.compile(MARKS), str.maketrans(FOLD_FROM, FOLD_TO)
_SON = re.compile(r"(?<!\w)ابن(?!\w)")
_NAME_MARKS, _NAME_FOLD, _NOT_NAME = re.compile(NAME_MARKS), str.maketrans(NAME_FROM, NAME_TO), re.compile("[^ء-ي ]")


def fold(text: str) -> str:
    """normalize() of one string."""
    return " ".join(_SON.sub("بن", _MARKS.sub("", text).translate(_FOLD)).split()).lower()


def plain_letters(text: str) -> str:
    """Name marks dropped and letters folded, all else kept."""
    return _NAME_MARKS.sub("", text).translate(_NAME_FOLD)


def fold_name(text: str) -> str:
    """name_key() of one string."""
    return " ".join(_NOT_NAME.sub(" ", plain_letters(text)).split())
