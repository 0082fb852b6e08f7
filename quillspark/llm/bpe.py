"""Byte-level BPE encoding and decoding as a monoid over text.

An element is (text, ids). Leaves are encoded by the tokenizer; two neighbours are joined by encoding a window round
their seam again, which grows until the tokens outside it are proved to be those of the whole text. There are two proofs:

- The window ends on either side at a position at which the splitting pattern ends a match whatever the text around it is.
  Matches are encoded separately, and matching has no memory.
- The window lies inside a long run of letters, digits or marks, which is one match as a whole. A sequence of tokens is
  the encoding of a match if each two neighbours are the encoding of their own bytes; so it is enough that the window's
  first and last token each are such neighbours with the token outside.

Near a seam the first is tried, then the second with windows of RUNS characters, and else the first over the whole side.
Decoding concatenates the tokens' bytes up the same tree.

Null text counts as empty; an empty text has no ids. Other columns pass through; `ids` (little-endian unsigned 32-bit
integers, one binary value a row) replaces a column of that name. Repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import bounded, pieces

LEAF = 2048
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    out = [b""] * (max(ranks(path).values()) + 1)
    for k, v in ranks(path).items():
        out[v] = k
    return out


def named(name: str) -> tuple[str, str]:
    """Path and splitting pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _kind(c: str) -> int:
    return 0 if c.isalpha() else 1 if c.isdigit() else 2


def certain(a: str, b: str) -> bool:
    """Whether every match of the pattern ends between a and b, whatever stands before and after.

    Only cases that don't hang on a Unicode version: white space after something else, something else after a line break
    or tab, and two ASCII characters of different kinds (an apostrophe may begin a contraction).
    """
    if b in " \n\t\r":
        return not a.isspace()
    if b.isspace() or a.isspace():
        return a in "\n\t\r" and not b.isspace()
    return a.isascii() and b.isascii() and _kind(a) != _kind(b) and not (a == "'" and b.isalpha())


#: Characters that are of one class in every version of Unicode, for certain: letters, digits, ASCII marks.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0391-\u03a1\u03b1-\u03c9\u0410-\u044f\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_CLASSES = [re.compile(f"[{x}]*") for x in (_LETTERS, "0-9", r"!-/:-@\[-`{-~")]
#: Characters of a side that are looked at for a certain end of a match, and sizes of windows inside a run.
NEAR, RUNS = 64, (64, 512, 4096)


def _inside(enc, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> list[int] | None:
    """The ids of both, by a window inside a run that goes on on both sides; None where there is no proof."""
    (lt, li), (rt, ri) = left, right
    for size in RUNS:
        if len(lt) < size + 4 or len(rt) < size + 4:
            return None
        # Three characters more on the left: a run's first letters may belong to a contraction before it.
        own = next((c for c in _CLASSES if c.fullmatch(lt[-size - 4 :]) and c.fullmatch(rt[: size + 4])), None)
        if own is None:
            return None
        ends = []
        for ids, room, step in ((li, len(lt[-size:].encode()), -1), (ri, len(rt[:size].encode()), 1)):
            n, used = 0, 0
            while n < len(ids) and used + len(t := enc.decode_single_token_bytes(ids[-1 - n if step < 0 else n])) <= room:
                n, used = n + 1, used + len(t)
            ends.append(n - 1)  # the last one that is sure to lie in the run is the neighbour outside
        i, j = ends
        if i < 1 or j < 1:
            continue
        middle = enc._encode_single_piece(enc.decode_bytes(li[-i:] + ri[:j]))
        outside = ((li[-i - 1], middle[0]), (middle[-1], ri[j]))
        if all(enc._encode_single_piece(enc.decode_bytes(list(x))) == list(x) for x in outside):
            return li[:-i] + middle + ri[j:]
    return None


def _ends(text: str, step: int, most: int) -> int | None:
    """Characters from a side's seam to the nearest certain end of a match, at most `most`; None if there is none."""
    for n in range(1, min(most, len(text) - 1) + 1):
        at = len(text) - n if step < 0 else n
        if certain(text[at - 1], text[at]):
            return n
    return None


def join(enc, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
    (lt, li), (rt, ri) = left, right
    if not lt or not rt:
        return (lt, li) if not rt else (rt, ri)
    if certain(lt[-1], rt[0]):
        return lt + rt, li + ri
    p, q = _ends(lt, -1, NEAR), _ends(rt, 1, NEAR)
    if p is None and q is None and (ids := _inside(enc, left, right)) is not None:
        return lt + rt, ids
    p = p or _ends(lt, -1, len(lt)) or len(lt)
    q = q or _ends(rt, 1, len(rt)) or len(rt)
    encode, tail, head = enc.encode_ordinary, lt[len(lt) - p :], rt[:q]
    return lt + rt, li[: len(li) - len(encode(tail))] + encode(tail + head) + ri[len(encode(head)) :]


def encode_tree(enc, text: str, leaf: int = LEAF) -> list[int]:
    """Halves, recursively, down to leaves; depth is the logarithm of the length. enc: a tokenizer()."""

    def node(a: int, b: int) -> tuple[str, list[int]]:
        if b - a <= leaf:
            return text[a:b], enc.encode_ordinary(text[a:b])
        m = (a + b) // 2
        return join(enc, node(a, m), node(m, b))

    return node(0, len(text))[1] if text else []


def decode_tree(table: list[bytes], ids: np.ndarray, leaf: int = LEAF) -> bytes:
    if len(ids) <= leaf:
        return b"".join([table[i] for i in ids.tolist()])
    m = len(ids) // 2
    return decode_tree(table, ids[:m], leaf) + decode_tree(table, ids[m:], leaf)


def _mapped(df: DataFrame, source: str, target: str, make) -> DataFrame:
    """df with a binary column `target` made from `source`, batch by batch."""
    bounded(df.sparkSession)
    rest = [c for c in df.columns if c != target]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(target, T.BinaryType())])

    def run(batches):
        one = make()
        for b in pieces(batches):
            got = pa.array([one(x) for x in b.column(b.schema.get_field_index(source)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in rest] + [got], [*rest, target])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, pattern: str | None = None, leaf: int = LEAF) -> DataFrame:
    """df with the ids of each whole text."""
    own = named(VOCABULARY)
    path, pattern = path or own[0], pattern or own[1]

    def make():
        enc = tokenizer(path, pattern)
        return lambda x: np.asarray(encode_tree(enc, x or "", leaf), dtype="<u4").tobytes()

    return _mapped(df, text, ids, make)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """df with the bytes that the ids stand for."""
    path = path or named(VOCABULARY)[0]

    def make():
        t = token_bytes(path)
        return lambda x: decode_tree(t, np.frombuffer(x or b"", dtype="<u4"), leaf)

    return _mapped(df, ids, decoded, make)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 by an encoding and a decoding of every whole text."""
    both = decode(encode(docs.select("doc_id", "text")).drop("text"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
