"""Sequences of bounded length from whole documents (operator 10).

Every text is tokenised once, ends in an end id and is cut into pieces of
``capacity`` ids and one shorter rest. Whole pieces are sequences of their own.
Rests are dealt into groups by the hash of a number that is written with them, so a
group is a random part of the corpus of bounded size, equal rows or not, and each group is packed by first-fit decreasing: a tournament
tree over the free room of its bins finds the first bin that takes a rest in
logarithmic time. Groups know nothing of each other, so they scale out, and the
few bins left open in each are small beside its ``group_rests`` rests.

Cases: a null text counts as empty and gives the end id alone. Null and repeated
document ids are packed as documents of their own. An empty table gives no piece.
Columns beside the id and the text are not read. A very long text gives many whole
pieces, which pass through no group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import binary, chunks, released, staged, trim
from tellurion.llm.tokens import encoder

CAPACITY = 1024
GROUP_RESTS = 4096
#: Bytes of text that a task encodes at a time.
BATCH_BYTES = 1 << 20
#: The same where memory is short, and documents that a task is handed at a time.
LEAN_BYTES, LEAN_ROWS = 1 << 19, 1024
#: Sequence ids of whole pieces start here; those of bins are below.
WHOLE = 1 << 62

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
PACKED = PIECES + ", sequence_id long, offset long"


def cut_batch(
    batch: pa.RecordBatch, tokenizer: str, end_id: int, capacity: int, lean: bool = False
) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of ids and texts, a bounded size of text at a time.

    Lean, what encoding frees is given back after the batch; it adds up within a task otherwise.
    """
    texts = batch.column(1)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    for a, b in chunks(sizes, LEAN_BYTES if lean else BATCH_BYTES):
        flat, counts = encoder(tokenizer, lean).encode(texts.slice(a, b - a))
        ids = np.insert(flat, np.cumsum(counts), np.uint32(end_id))
        counts = counts + 1
        pieces = -(-counts // capacity)
        doc = np.repeat(np.arange(len(counts)), pieces)
        ends = np.cumsum(pieces)
        start = (np.arange(ends[-1]) - (ends - pieces)[doc]) * capacity
        length = np.minimum(capacity, counts[doc] - start)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(a + doc)),
                pa.array(start),
                pa.array(length),
                pa.array(counts[doc]),
                binary(
                    ids.astype("<u4").view(np.uint8),
                    np.concatenate([[0], 4 * np.cumsum(length)]),
                ),
            ],
            ["doc_id", "start", "length", "doc_tokens", "ids"],
        )
    if lean:
        trim()


def cut(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    lean: bool = False,
) -> DataFrame:
    """Pieces of every document's ids (``<u4`` bytes), ``capacity`` ids long but for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from cut_batch(batch, tokenizer, end_id, capacity, lean)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(released(run, keep="tokens"), PIECES)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, taken in the given order, in the first bin with room.

    ``tree[1]`` is the largest free room of all bins; the children of node ``i``
    are ``2 * i`` and ``2 * i + 1``, the leaves are the bins.
    """
    size = 1
    while size < max(1, len(lengths)):
        size *= 2
    tree = [capacity] * (2 * size)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < size:
            node *= 2
            if tree[node] < length:
                node += 1
        bins.append(node - size)
        offsets.append(capacity - tree[node])
        tree[node] -= length
        while node > 1:
            node //= 2
            room = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == room:
                break
            tree[node] = room
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    group_rests: int = GROUP_RESTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lean: bool = False,
) -> DataFrame:
    """Pieces of all documents with the sequence and offset each lies at.

    ``lean`` spares the memory of executors that earlier steps have filled, for more CPU time.
    """
    made = cut(docs, tokenizer, end_id, capacity, id_col, text_col, lean)
    # Written with the pieces, so it stays what it is; equal pieces differ in it.
    pieces = staged(made.withColumn("salt", F.monotonically_increasing_id()), "pieces", LEAN_ROWS if lean else None)
    rests = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_rests))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        order = np.lexsort(
            (
                group["start"].to_numpy(),
                group["doc_id"].fill_null(-1).to_numpy(),
                -group["length"].to_numpy(),
            )
        )
        group = group.take(pa.array(order))
        bins, offsets = first_fit(group["length"].to_pylist(), capacity)
        ids = (key[0].as_py() << 32) + np.array(bins, np.int64)
        return (
            group.drop_columns(["part", "salt"])
            .append_column("sequence_id", pa.array(ids))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    part = F.pmod(F.xxhash64("salt"), F.lit(groups))
    packed = rests.withColumn("part", part).groupBy("part").applyInArrow(run, PACKED)
    whole = (
        pieces.where(F.col("length") == capacity)
        .withColumn("sequence_id", F.col("salt") + F.lit(WHOLE))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("salt")
    )
    return whole.unionByName(packed)
