"""Conversations as marked-up text with a loss mask, assembled by columns (operator 6).

A turn is written ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a
backslash is doubled and every control string gets a backslash after its first
character, so no control string is left there; dropping each backslash but the
character after it gives the text back. The loss mask covers the escaped texts
of the trained roles, as byte ranges.

Turns of one conversation are dealt into blocks of ``BLOCK_TURNS`` turn numbers,
so that a long conversation is spread over tasks. Within a task sorted rows are
assembled batch by batch: segment lengths, their running sum and scatter indices
come from numpy, and the bytes of all turns are copied into one buffer, which
becomes the Arrow column. A row of the result is one block; the blocks of a
conversation in order are its text.

Cases: null roles and texts are empty. A null conversation id is a conversation,
a null turn comes first in a block of its own. Turns with equal numbers are
ordered by role and text, repeated rows are repeated turns. An empty table gives
no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import chunks, ragged, utf8

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Marks of this template and of widespread ones: none of them is left inside a text.
CONTROL = (TURN, TEXT, END, "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = ("assistant",)
BLOCK_TURNS = 64
BATCH_BYTES = 4 << 20

FORMATTED = (
    "conv_id long, block long, n_turns long, formatted string,"
    " loss_start array<long>, loss_end array<long>"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def escaped(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    for mark in CONTROL:
        texts = pc.replace_substring(texts, mark, f"{mark[0]}\\{mark[1:]}")
    return texts


def unescaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"(?s)\\(.)", r"\1")


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy row ``k`` of a ragged column to ``out[at[k]:]``."""
    sizes = np.diff(offsets)
    for a, b in chunks(sizes, BATCH_BYTES):
        if b == a + 1:
            out[at[a] : at[a] + sizes[a]] = data[offsets[a] : offsets[b]]
        else:
            out[ragged(at[a:b], sizes[a:b])] = data[offsets[a] : offsets[b]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, the offsets of the turns, and where each text starts and ends."""
    (role, role_at), (text, text_at) = utf8(escaped(roles)), utf8(escaped(texts))
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (TURN, TEXT, END)]
    sizes = np.empty((len(roles), 5), np.int64)
    sizes[:, 0::2] = [len(m) for m in marks]
    sizes[:, 1], sizes[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(sizes.reshape(-1)).reshape(-1, 5)
    starts = ends - sizes
    out = np.empty(int(ends[-1, -1]), np.uint8)
    for column, mark in zip((0, 2, 4), marks):
        out[starts[:, column, None] + np.arange(len(mark))] = mark
    _scatter(out, starts[:, 1], role, role_at)
    _scatter(out, starts[:, 3], text, text_at)
    return out, np.concatenate([[0], ends[:, 4]]), starts[:, 3], ends[:, 3]


def _blocks(rows: pa.Table) -> pa.RecordBatch:
    """One row per run of equal conversation and block."""
    conv, block = rows["conv_id"].to_pylist(), rows["block"].to_pylist()
    keys = list(zip(conv, block))
    first = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
    bounds = np.array([*first, len(keys)])
    roles, texts = rows["role"].combine_chunks(), rows["text"].combine_chunks()
    out, offsets, start, end = assemble(roles, texts)
    trained = pc.fill_null(pc.is_in(roles, pa.array(TRAINED)), False).to_numpy(zero_copy_only=False)
    base = np.repeat(offsets[bounds[:-1]], np.diff(bounds))
    lists = np.concatenate([[0], np.cumsum(trained)])[bounds]
    group_offsets = pa.py_buffer(offsets[bounds].astype(np.int64))
    formatted = pa.LargeStringArray.from_buffers(len(first), group_offsets, pa.py_buffer(out))

    def spans(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array((values - base)[trained]))

    return pa.RecordBatch.from_arrays(
        [
            pa.array([conv[k] for k in first], pa.int64()),
            pa.array([block[k] for k in first], pa.int64()),
            pa.array(np.diff(bounds)),
            formatted.cast(pa.string()),
            spans(start),
            spans(end),
        ],
        ["conv_id", "block", "n_turns", "formatted", "loss_start", "loss_end"],
    )


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Blocks of formatted turns with the byte ranges under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            # The last block of a batch may go on in the next one.
            conv, block = rows["conv_id"].to_pylist(), rows["block"].to_pylist()
            last = len(conv) - 1
            while last and (conv[last - 1], block[last - 1]) == (conv[-1], block[-1]):
                last -= 1
            held = rows.slice(last)
            if last:
                yield _blocks(rows.slice(0, last))
        if held is not None:
            yield _blocks(held)

    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.floor(F.col(turn_col) / BLOCK_TURNS).cast("long").alias("block"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    ordered = rows.repartition("conv_id", "block").sortWithinPartitions(
        "conv_id", "block", "turn", "role", "text"
    )
    return ordered.mapInArrow(run, FORMATTED)


def _turns(formatted: str) -> list[str]:
    """Roles and texts in turn, still escaped."""
    found = []
    for turn in formatted.split(TURN)[1:]:
        role, text = turn.removesuffix(END).split(TEXT)
        found += [role, text]
    return found


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its blocks in order.

    SHA-256 needs the bytes of a conversation one after another: the blocks of a
    conversation pass through one task as a stream and are not kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, state, done = None, None, []

        def close():
            n, turns, chars, loss, size = state
            done.append((now[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def taken():
            columns = [pa.array(c) for c in zip(*done)]
            columns[0] = columns[0].cast(pa.int64())
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            columns = batch.to_pydict()
            for conv, text, starts, ends in zip(
                *(columns[c] for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            ):
                if now != (conv,):
                    if state:
                        close()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                plain = unescaped(pa.array(_turns(text), pa.string())).to_pylist()
                raw = text.encode()
                under = [raw[a:b].decode() for a, b in zip(starts, ends)]
                loss = unescaped(pa.array(under, pa.string())).to_pylist()
                state[0] += len(plain) // 2
                state[1].update("".join(f"{p}\n" for p in plain).encode())
                state[2] += sum(map(len, loss))
                state[3].update("".join(loss).encode())
                state[4] += len(text)
            if len(done) > 5000:
                yield taken()
        if state:
            close()
            yield taken()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(run, DIGESTS)
