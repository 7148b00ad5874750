"""Chat formatting by token-level assembly.

The tokenizer has byte-level BPE ranks; reserved ids above them mark turns and can't come out of any text. Role and text of
a turn are encoded separately and spliced between reserved ids, so a control string inside a text never becomes a mark. It
is escaped besides, reversibly, so the decoded text can be read back by its marks: in a text, `\\` becomes `\\\\`, and the
`<|` of a control string becomes `<\\|`. The loss mask is derived by prefix sums over the pieces: +1 where a stretch that
bears loss begins, -1 where it ends, summed up over the tokens.

A conversation is never collected: turns are rows, ordered within partitions, and reading back streams over them with one
hash state a conversation.

Defined results: null text and null role are empty; turns stand by turn (null first), ties by role, then by
the text's SHA-256; repeated rows
are turns of their own; a null conversation is one of its own; extra columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: The control strings and where the public vocabulary stands.
START, END = "<|im_start|>", "<|im_end|>"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        out += [text[at:found], text[found + 1 : found + 2]]
        at = found + 2
    return "".join([*out, text[at:]])


class Codec:
    """Text to ids and back, with two reserved ids above the vocabulary's."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        top = max(ranks.values())
        self.start, self.end = top + 1, top + 2

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        """Reserved ids come back as their strings; stretches between them are decoded each for itself."""
        out, run = [], []
        for i in ids:
            if i in (self.start, self.end):
                out += [self.encoding.decode_bytes(run).decode(), START if i == self.start else END]
                run = []
            else:
                run.append(i)
        return "".join([*out, self.encoding.decode_bytes(run).decode()])

    def turn(self, role: str, text: str) -> tuple[list[int], list[bool]]:
        """Ids and loss mask of <|im_start|>role, newline, text, <|im_end|>, newline; an assistant's text bears loss."""
        head, body = self.encode(escape(role) + "\n"), self.encode(escape(text))
        ids = [self.start, *head, *body, self.end, *self.encode("\n")]
        steps = np.zeros(len(ids) + 1, np.int8)
        if role == "assistant":
            steps[1 + len(head)] += 1
            steps[1 + len(head) + len(body)] -= 1
        return ids, np.cumsum(steps[:-1]).astype(bool).tolist()


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    """One for each worker."""
    return Codec(path)


def format_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, place, ids array<int>, loss array<boolean>) of each turn (conv_id, turn, role, text); place orders ties.

    vocabulary is a path that every executor can open; the file is read once a worker.
    """
    small_batches(turns.sparkSession)
    kind = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            made = [tool.turn(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            place = pa.array([f"{r}\0{hashlib.sha256(t.encode()).hexdigest()}" for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), place, pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.bool_()))], names=["conv_id", "turn", "place", "ids", "loss"])

    return rows.mapInArrow(run, f"conv_id {kind['conv_id']}, turn {kind['turn']}, place string, ids array<int>, loss array<boolean>")


def read_turn(tool: Codec, ids: list[int], loss: list[bool]) -> tuple[str, str, str, int]:
    """(role, text, text under the loss mask, code points as formatted) of one turn's tokens."""
    shown = tool.decode(ids)
    if not (shown.startswith(START) and shown.endswith(END + "\n")):
        raise ValueError("not a turn")
    role, text = shown[len(START) : -len(END) - 1].split("\n", 1)
    masked = unescape(tool.decode([i for i, on in zip(ids, loss, strict=True) if on]))
    return unescape(role), unescape(text), masked, len(shown)


def digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each conversation, read back from its tokens, in a stream over rows ordered within partitions."""
    small_batches(formatted.sparkSession)
    id_type = formatted.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, now, state, arrow = codec(vocabulary), None, None, None
        done: list[tuple] = []

        def close() -> None:
            n, all_, loss_chars, loss, chars = state
            done.append((now[0], n, all_.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def batch_of() -> pa.RecordBatch:
            kinds = (arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            done.clear()
            return made

        for batch in batches:
            arrow = batch.column(0).type
            for conv, ids, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, masked, size = read_turn(tool, ids, loss)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += size
            if done:
                yield batch_of()
        if now is not None:
            close()
        if done:
            yield batch_of()

    ordered = formatted.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "place")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(run, f"conv_id {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
