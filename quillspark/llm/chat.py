"""Chat formatting by token-level assembly.

Every role and text is encoded separately and reserved ids, which no text can produce as they come after the vocabulary's
largest rank, are spliced between them:

    TURN role BODY text END         for a turn that isn't learned
    TURN role REPLY text END_REPLY  for a turn under the loss mask

Masks are differences of prefix sums over the ids: REPLY and END_REPLY open and close. In the rendered text the ids
stand as control strings; control strings that occur in roles or texts are escaped there, reversibly: ESC within one
(`<ESC.s>`), ESC itself doubled.

Rows are ordered by turn (null first); of one turn, by their ids. Null roles and texts count as empty, rows whose conv_id is
null form one conversation. Repeated rows are turns of their own. Extra columns aren't read. Rows of a conversation are
encoded where they lie; then a worker reads them in order as a stream, with memory for a batch and two digests.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import bpe
from quillspark.llm.common import bounded, pieces

VOCABULARY = "byte_bpe_50k.tiktoken"
LEARNED = ("assistant",)
#: The template's own control strings, in the order of their ids from first_id() on.
CONTROL = ("<|turn|>", "<|body|>", "<|reply|>", "<|end|>", "<|end_reply|>")
TURN, BODY, REPLY, END, END_REPLY = range(len(CONTROL))
#: Control strings of well-known templates, escaped in roles and texts as well.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
ESC = "␛"
_TO = re.compile(f"{ESC}|(?=(?:{'|'.join(re.escape(x) for x in (*CONTROL, *FOREIGN))}))(.)", re.DOTALL)
_FROM = re.compile(f"{ESC}(.)", re.DOTALL)


def escape(s: str) -> str:
    return _TO.sub(lambda m: ESC + ESC if m[1] is None else f"{m[1]}{ESC}.", s)


def unescape(s: str) -> str:
    return _FROM.sub(lambda m: ESC if m[1] == ESC else "", s)


def first_id(path: str) -> int:
    """The first reserved id of a vocabulary: after all of its ranks, however many there are."""
    return max(bpe.ranks(path).values()) + 1


def loss_mask(ids: np.ndarray, first: int) -> np.ndarray:
    """True for the tokens between REPLY and END_REPLY: a difference of prefix sums."""
    opened, closed = np.cumsum(ids == first + REPLY), np.cumsum(ids == first + END_REPLY)
    return (opened - closed > 0) & (ids != first + REPLY)


def format_turns(rows: DataFrame, learned: tuple[str, ...] = LEARNED, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, ids: each row's segment of the conversation as little-endian unsigned 32-bit ids."""
    bounded(rows.sparkSession)
    own = bpe.named(VOCABULARY)
    path, pattern = path or own[0], pattern or own[1]
    src = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema)

    def run(batches):
        enc, first = bpe.tokenizer(path, pattern), first_id(path)

        def one(role: str, text: str) -> bytes:
            loss = role in learned
            ids = [first + TURN, *bpe.encode_tree(enc, escape(role)), first + (REPLY if loss else BODY), *bpe.encode_tree(enc, escape(text)), first + (END_REPLY if loss else END)]
            return np.asarray(ids, dtype="<u4").tobytes()

        for b in pieces(batches):
            got = pa.array(list(map(one, b.column(2).to_pylist(), b.column(3).to_pylist())), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, got], [*b.schema.names, "ids"])

    return src.mapInArrow(run, f"{kinds}, ids binary")


def render(table: list[bytes], ids: np.ndarray) -> str:
    """The text that a run of ids stands for. table: the vocabulary's tokens, which the reserved ids come after."""
    out, at = [], 0
    for i in np.flatnonzero(ids >= len(table)).tolist():
        out += [bpe.decode_tree(table, ids[at:i]), CONTROL[ids[i] - len(table)].encode()]
        at = i + 1
    return b"".join([*out, bpe.decode_tree(table, ids[at:])]).decode()


def read_turn(table: list[bytes], ids: np.ndarray) -> tuple[str, str]:
    """Role and text of a segment, read back from its ids."""
    body = int(np.flatnonzero((ids == len(table) + BODY) | (ids == len(table) + REPLY))[0])
    return tuple(unescape(bpe.decode_tree(table, x).decode()) for x in (ids[1:body], ids[body + 1 : -1]))


def conversations(turns: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, n_tokens, loss_tokens and the digests, from format_turns()'s segments put in order."""
    path = path or bpe.named(VOCABULARY)[0]
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", "ids").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids").select("conv_id", "ids")
    names = ["conv_id", "n_turns", "n_tokens", "loss_tokens", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {kind}, n_turns long, n_tokens long, loss_tokens long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    class Open:
        def __init__(self, conv):
            self.conv, self.n = conv, np.zeros(5, np.int64)
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def add(self, table, ids: np.ndarray):
            mask = loss_mask(ids, len(table))
            role, text = read_turn(table, ids)
            self.turns.update(f"{role}\n{text}\n".encode())
            learned = unescape(bpe.decode_tree(table, ids[mask]).decode())
            self.loss.update(learned.encode())
            self.n += (1, len(ids), int(mask.sum()), len(learned), len(render(table, ids)))

        def row(self):
            return [self.conv, *self.n[:3].tolist(), self.turns.hexdigest(), int(self.n[3]), self.loss.hexdigest(), int(self.n[4])]

    def run(batches):
        table, now = bpe.token_bytes(path), None
        for b in pieces(batches):
            done = []
            for conv, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Open(conv)
                now.add(table, np.frombuffer(ids, dtype="<u4"))
            if done:
                yield out(done)
        if now is not None:
            yield out([now.row()])

    def out(done):
        kinds = [b_type, *[pa.int64()] * 3, pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    b_type = to_arrow_type(turns.schema["conv_id"].dataType)
    return rows.mapInArrow(run, schema)
