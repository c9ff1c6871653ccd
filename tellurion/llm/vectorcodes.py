"""Product codes of vectors, nearest entries by equal-average search (operator 13).

Components become integers ``floor(scale * x)``; a vector is cut into equal parts, each
with a codebook of its own. Entries start as the parts of the first vectors by id; a round
assigns every part to its nearest entry and moves each entry to the floored mean of its
parts; unused entries stay. Codes are the nearest entries after the last round.

The search for a nearest entry sorts a codebook by component sum. From a part's own sum it
goes outward on both sides. A vector at sum gap g lies at a squared distance of g*g/d at
least, so a side ends when g*g exceeds d times the best distance; at equality it goes on,
since an equally near entry of a lower index wins.

Parts are compared within tasks. A task returns sums and counts for each entry, added up by
Spark; the driver holds the codebooks (at most 256 entries of one vector's length) and
never a vector beyond the first ones. Arithmetic is in whole numbers, so results do not
depend on how rows are dealt.

Cases: vectors that are null or hold null or non-finite components are dropped. All vectors
should have the length of the first one by id whose length the parts divide; vectors of
another length take no part in learning and get null code and errors. Rows that repeat an id
are rows of their own; vectors without an id come last by id. Integers beyond 2**22 count as
2**22. An empty table, or one without a fitting vector, has empty codebooks. A sum of label
errors beyond 64 bits is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 22
#: Vectors whose parts are compared at a time.
BATCH = 4096
#: Labels whose errors are broadcast to the rows; beyond it they are joined by a shuffle.
MOST_BROADCAST = 100_000
SALTS = 16

CODED = "vec_id long, label {}, code string, error long"


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)


class Codebook:
    """Entries of one part, in the order of their component sums."""

    def __init__(self, entries: np.ndarray):
        order = np.argsort(entries.sum(1), kind="stable")
        self.index, self.entries = order, entries[order]
        self.sums = self.entries.sum(1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry, the lower index at ties."""
        sums, width = parts.sum(1), parts.shape[1]
        right = np.searchsorted(self.sums, sums)
        first = np.minimum(right, len(self.sums) - 1)
        best = ((parts - self.entries[first]) ** 2).sum(1)
        which = self.index[first]
        for at, step in ((right, 1), (right - 1, -1)):
            rows = np.arange(len(parts))
            at = at.copy()
            while True:
                inside = (at[rows] >= 0) & (at[rows] < len(self.sums))
                rows = rows[inside]
                gap = self.sums[at[rows]] - sums[rows]
                rows = rows[gap * gap <= width * best[rows]]
                if not len(rows):
                    break
                entry = at[rows]
                distance = ((parts[rows] - self.entries[entry]) ** 2).sum(1)
                index = self.index[entry]
                closer = (distance < best[rows]) | (distance == best[rows]) & (index < which[rows])
                best[rows[closer]] = distance[closer]
                which[rows[closer]] = index[closer]
                at[rows] += step
        return which, best


@dataclass(frozen=True)
class Model:
    """Entries by part, entry and place in the part."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Vectors without null, infinite or undefined components."""
    x = F.col(vector_col)
    infinite = F.lit(float("inf"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == infinite))
    return vectors.where(x.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), x.alias("vector"), F.col(label_col).alias("label")
    )


def _matrices(batch: pa.RecordBatch, length: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole numbers of the vectors of the right length."""
    column = batch.column(batch.schema.get_field_index("vector"))
    sizes = np.diff(column.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    fitting = np.flatnonzero(sizes == length)
    for at in range(0, len(fitting), BATCH):
        rows = fitting[at : at + BATCH]
        yield rows, whole_numbers(flat[starts[rows][:, None] + np.arange(length)], scale)


def start(vectors: DataFrame, parts: int, entries: int, scale: int) -> Model:
    """Codebooks of the first vectors by id; the driver sees at most ``entries`` vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of two digits has 1 to 256 entries")
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    fitting = vectors.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    one = fitting.orderBy(*order).select(F.size("vector").alias("length")).head(1)
    if not one:
        return Model(np.zeros((parts, 0, 1), np.int64), scale)
    length = one[0]["length"]
    first = vectors.where(F.size("vector") == length).orderBy(*order).limit(entries).select("vector").collect()
    rows = whole_numbers(np.array([r["vector"] for r in first]), scale)
    return Model(rows.reshape(len(rows), parts, length // parts).transpose(1, 0, 2).copy(), scale)


def improved(vectors: DataFrame, model: Model) -> Model:
    """The codebooks after one round over all vectors."""
    parts, count, width = model.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in model.entries]
        totals = np.zeros((parts, count, width + 1), np.int64)
        for batch in batches:
            for _, numbers in _matrices(batch, model.length, model.scale):
                for p, book in enumerate(books):
                    own = numbers[:, p * width : (p + 1) * width]
                    which, _ = book.nearest(own)
                    np.add.at(totals[p], which, np.concatenate([own, np.ones((len(own), 1), np.int64)], 1))
        place = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(totals.ravel()[place])], ["place", "total"])

    found = vectors.select("vector").mapInArrow(run, "place long, total long")
    found = found.groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros(parts * count * (width + 1), np.int64)
    totals[found["place"].to_numpy()] = found["total"].to_numpy()
    totals = totals.reshape(parts, count, width + 1)
    used = totals[:, :, -1:]
    return Model(np.where(used > 0, totals[:, :, :-1] // np.maximum(used, 1), model.entries), model.scale)


def coded(vectors: DataFrame, model: Model) -> DataFrame:
    """Code and squared error of every vector."""
    parts, count, width = model.entries.shape
    kind = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in model.entries] if count else []
        for batch in batches:
            codes: list[str | None] = [None] * batch.num_rows
            errors, known = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            for rows, numbers in _matrices(batch, model.length, model.scale) if count else ():
                which = np.zeros((len(rows), parts), np.uint8)
                for p, book in enumerate(books):
                    found, distance = book.nearest(numbers[:, p * width : (p + 1) * width])
                    which[:, p] = found
                    errors[rows] += distance
                known[rows] = True
                for row, code in zip(rows.tolist(), which):
                    codes[row] = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(codes, pa.string()),
                    pa.array(errors, pa.int64(), mask=~known),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return vectors.select("vec_id", "vector", "label").mapInArrow(run, CODED.format(kind))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Model]:
    """Codes and errors of all vectors, and the codebooks that decode them."""
    rows = usable(vectors, id_col, vector_col, label_col)
    model = start(rows, parts, entries, scale)
    for _ in range(rounds if model.entries.shape[1] else 0):
        model = improved(rows, model)
    return coded(rows, model), model


def label_errors(codes: DataFrame) -> DataFrame:
    """Each row with the error summed over the rows of its label, null labels together."""
    codes = staged(codes, "vector-codes")
    sums = codes.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    sums = staged(sums, "label-errors")
    if sums.count() <= MOST_BROADCAST:
        return codes.join(F.broadcast(sums), codes["label"].eqNullSafe(sums["label"])).drop(sums["label"])
    # A label may hold a third of all rows: its rows are dealt by a salt as well.
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    sums = sums.select(F.col("label").alias("of"), "label_error", copies.alias("part"))
    same = salted["label"].eqNullSafe(sums["of"]) & (salted["salt"] == sums["part"])
    return salted.join(sums, same).drop("of", "part", "salt")


def decoded(code: str, model: Model) -> np.ndarray:
    """The vector that a code stands for, in the scale of the input."""
    which = np.frombuffer(bytes.fromhex(code), np.uint8)
    return model.entries[np.arange(len(which)), which].ravel() / model.scale
