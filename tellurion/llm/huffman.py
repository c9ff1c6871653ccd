"""Token ids in canonical length-limited Huffman code (operator 1).

Texts are dealt into shards by ascending document id and tokenised once. Counts
of all ids give one code for the whole output: package-merge bounds the length
of a code word, and canonical code words follow from the lengths alone, so the
code book is one row per id. A shard is a run of blocks. A block holds whole
documents, is decoded without any other block, and keeps the bit offset of every
``CHECKPOINT``-th id; decoding walks all its checkpoints side by side through a
table of ``2 ** max_bits`` entries.

The format is two Parquet tables in one folder, written and committed by Spark:
``blocks`` and ``codes``. Spark retries lost tasks; a block depends on its rows
alone.

Cases: a null text counts as empty and gives the end id alone. A null document
id comes first. Rows with equal ids are kept and ordered by text. An empty table
gives empty ``blocks`` and ``codes``. Columns beside the id and the text are not
read. A document longer than a block has a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.llm.common import binary, chunks, staged
from tellurion.llm.tokens import encoder

MAX_BITS = 16
BLOCK_IDS = 1 << 18
CHECKPOINT = 256

TOKENISED = "shard int, start long, doc_ids array<long>, n_tokens array<long>, ids binary"
BLOCKS = (
    "shard int, start long, doc_ids array<long>, n_tokens array<long>, bits long,"
    " checkpoints binary, payload binary"
)
DECODED = "doc_id long, start long, n_tokens long, ids binary"


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Length of each symbol's code word, at most ``max_bits``, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    max_bits = max(max_bits, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, need = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:need].sum())
        lengths[order[:leaves]] += 1
        need = 2 * (need - leaves)
    return lengths


class Code:
    """Canonical code words and the decoding table of one code book."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        rank = np.lexsort((symbols, lengths))
        symbols, lengths = symbols[rank], lengths[rank]
        self.bits = int(lengths.max()) if len(lengths) else 1
        # Words in order of length: each starts where the one before it ends.
        spans = np.int64(1) << (self.bits - lengths)
        firsts = np.cumsum(spans) - spans
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.words = np.zeros(size, np.uint64)
        self.lengths = np.zeros(size, np.int64)
        self.words[symbols] = (firsts >> (self.bits - lengths)).astype(np.uint64)
        self.lengths[symbols] = lengths
        self.symbol_at = np.zeros(1 << self.bits, np.uint32)
        self.length_at = np.ones(1 << self.bits, np.uint8)
        used = int(spans.sum())
        self.symbol_at[:used] = np.repeat(symbols, spans)
        self.length_at[:used] = np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, int, np.ndarray]:
        """Bits of the ids in bytes, their number, and the bit offsets of the checkpoints."""
        if not len(ids):
            return b"", 0, np.zeros(0, np.uint64)
        lengths, words = self.lengths[ids], self.words[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        word, room = starts >> 6, 64 - (starts & 63) - lengths
        out = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
        over = room < 0
        placed = words << np.maximum(room, 0).astype(np.uint64)
        placed[over] = words[over] >> (-room[over]).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(placed, first)
        out[word[over] + 1] |= words[over] << (64 + room[over]).astype(np.uint64)
        total = int(ends[-1])
        data = out.astype(">u8").tobytes()[: (total + 7) // 8]
        return data, total, starts[::CHECKPOINT].astype(np.uint64)

    def decode(self, payload: bytes, n: int, checkpoints: np.ndarray) -> np.ndarray:
        """The ``n`` ids of a block; every checkpoint is a lane of its own."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(payload + bytes(8 + self.bits * CHECKPOINT // 8), np.uint8)
        raw = raw.astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = checkpoints.astype(np.int64)
        out = np.empty((CHECKPOINT, len(at)), np.uint32)
        mask = np.uint32((1 << self.bits) - 1)
        for step in range(min(CHECKPOINT, n)):
            shift = (32 - self.bits - (at & 7)).astype(np.uint32)
            entry = (window[at >> 3] >> shift) & mask
            out[step] = self.symbol_at[entry]
            at += self.length_at[entry]
        return out.T.reshape(-1)[:n]


def tokenised(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Blocks of token ids in ascending document order; ``start`` counts within the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
            for a, b in chunks(sizes, 3 * BLOCK_IDS):
                flat, counts = encoder(tokenizer).encode(texts.slice(a, b - a))
                ids = np.insert(flat, np.cumsum(counts), np.uint32(end_id))
                counts = counts + 1
                for c, d in chunks(counts, BLOCK_IDS):
                    before, own = int(counts[:c].sum()), int(counts[c:d].sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard], pa.int32()),
                            pa.array([start], pa.int64()),
                            pa.array([batch.column(0).slice(a + c, d - c).to_pylist()], pa.list_(pa.int64())),
                            pa.array([counts[c:d]], pa.list_(pa.int64())),
                            pa.array([ids[before : before + own].astype("<u4").tobytes()], pa.binary()),
                        ],
                        ["shard", "start", "doc_ids", "n_tokens", "ids"],
                    )
                    start += own

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, TOKENISED)


def id_counts(blocks: DataFrame) -> DataFrame:
    """How often each id occurs: one row per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found = np.bincount(np.frombuffer(ids.as_py(), "<u4"))
                wide = np.zeros(max(len(found), len(total)), np.int64)
                wide[: len(total)] = total
                wide[: len(found)] += found
                total = wide
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = blocks.select("ids").mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
) -> None:
    """Write the ids of every text to ``folder``.

    The driver holds the code book (one entry per id of the vocabulary) and one
    number per shard.
    """
    spark = docs.sparkSession
    blocks = staged(tokenised(docs, tokenizer, end_id, id_col, text_col), "token-ids")
    counts = sorted((r["id"], r["n"]) for r in id_counts(blocks).collect())
    symbols = np.array([i for i, _ in counts], np.int64)
    lengths = code_lengths(np.array([n for _, n in counts], np.int64), max_bits)
    sizes = blocks.groupBy("shard").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    bases, total = {}, 0
    for row in sorted(sizes.collect()):
        bases[row["shard"]], total = total, total + row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(symbols, lengths)
        for batch in batches:
            made = [code.encode(np.frombuffer(i.as_py(), "<u4")) for i in batch.column("ids")]
            starts = [bases[s.as_py()] + a.as_py() for s, a in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    pa.array(starts, pa.int64()),
                    batch.column("doc_ids"),
                    batch.column("n_tokens"),
                    pa.array([m[1] for m in made], pa.int64()),
                    pa.array([m[2].astype("<u8").tobytes() for m in made], pa.binary()),
                    pa.array([m[0] for m in made], pa.binary()),
                ],
                ["shard", "start", "doc_ids", "n_tokens", "bits", "checkpoints", "payload"],
            )

    # A folder for each shard, named in their order: read by name, the files ascend.
    named = blocks.mapInArrow(run, BLOCKS).withColumn("shard", F.format_string("s%09d", "shard"))
    named.sortWithinPartitions("shard", "start").write.option("compression", "uncompressed").partitionBy(
        "shard"
    ).parquet(f"{folder}/blocks")
    codes = [(int(i), int(n)) for i, n in zip(symbols, lengths)]
    spark.createDataFrame(codes, "id long, length int").coalesce(1).write.parquet(f"{folder}/codes")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder: id, place of the first id, number of ids, ids as ``<u4`` bytes."""
    codes = spark.read.parquet(f"{folder}/codes").collect()
    symbols = np.array([r["id"] for r in codes], np.int64)
    lengths = np.array([r["length"] for r in codes], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(symbols, lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                counts = np.array(batch.column("n_tokens")[k].as_py(), np.int64)
                points = np.frombuffer(batch.column("checkpoints")[k].as_py(), "<u8")
                ids = code.decode(batch.column("payload")[k].as_py(), int(counts.sum()), points)
                ends = np.cumsum(counts)
                first = batch.column("start")[k].as_py() + ends - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("doc_ids")[k].as_py(), pa.int64()),
                        pa.array(first),
                        pa.array(counts),
                        binary(ids.astype("<u4").view(np.uint8), np.concatenate([[0], 4 * ends])),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS.replace("shard int", "shard string")).parquet(f"{folder}/blocks")
    return blocks.mapInArrow(run, DECODED)


