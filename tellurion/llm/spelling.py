"""Spelling variants of words by reduced-alphabet generation (operator 12).

Words are runs of Latin letters, A-Z in lower case, counted over the whole corpus. Two
words are near if one inserted, deleted or replaced letter turns one into the other.

1. Letters are hashed to a few symbols, the fewer the longer the word: enough that the
   reduced words of a length are told apart by about ``CELL_BITS`` bits.
2. For each word the full one-edit neighbourhood of its reduced form is generated: a
   shorter, an equally long and a longer reduced word, each in the alphabet of its own
   length. Neighbours are 64-bit hashes, taken from prefix and suffix sums in linear time.
3. They are joined with the reduced vocabulary. A filter of fixed size (``FILTER_BITS``
   bits) of the reduced vocabulary drops most neighbours that no word has before they are
   shuffled; when the vocabulary outgrows it, it drops fewer and loses nothing.
4. Pairs whose letters differ in more than two parities are no one-edit pairs. The rest is
   verified on the original words.
5. A word's form is its most frequent near word if that is ``ratio`` times as frequent. Roots
   follow forms by pointer doubling; forms grow in frequency, so chains are short.

Every join is one by shuffle and sort: what the planner guesses of the size of small-looking
inputs (neighbourhoods, columns of the vocabulary) would bring them whole to the driver.

Both directions of a pair come from their own neighbourhoods, so a pair is found once each way.
Rare noise can be planted (``noise``): an occurrence whose hash with the document id is
divisible by it loses one letter.

Cases: null and empty texts have no word. A null id counts as an empty one. Repeated rows
count again. Ties of frequency go to the word that comes first in code-point order. A word
of any length costs memory in proportion to its length. An empty table gives no row. Columns
beside id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import staged
from tellurion.llm.textops import code_points, mix, powers

LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LENGTH, LEAST_COUNT, RATIO, NOISE = 6, 5, 5, 199
CELL_BITS = 24
#: Bits of the filter of the reduced vocabulary: 16 MB whatever the vocabulary.
FILTER_BITS = 27
#: Neighbours that are generated at a time.
GENERATED = 1 << 20

KEYED = "key long, id long, letters long"


def words(docs: DataFrame, noise: int = NOISE, least_length: int = LEAST_LENGTH) -> DataFrame:
    """All occurrences of words of ``doc_id``, ``text``, one row each."""
    lower = F.translate("text", UPPER, UPPER.lower())
    # Noise only shortens a run, so shorter runs give no word.
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    marked = found.select("run", F.crc32(F.concat("name", F.lit(":"), "run")).alias("h"))
    place = (F.col("h") % F.length("run") + 1).cast("int")
    word = F.when(F.col("h") % noise == 0, F.overlay("run", F.lit(""), place, F.lit(1))).otherwise(F.col("run"))
    return marked.select(word.alias("word")).where(F.length("word") >= least_length)


def symbols(length: int) -> int:
    """Size of the alphabet for reduced words of a length."""
    return max(2, int(np.ceil(2.0 ** (CELL_BITS / max(length, 1)))))


class Reduced:
    """Equally long words reduced to the alphabet of a length, as prefix sums of hashes."""

    def __init__(self, points: np.ndarray, length: int):
        self.size, self.length = symbols(length), length
        seed = np.uint64(length) << np.uint64(32)
        self.salt = mix(np.array([length], np.uint64))
        self.values = mix(np.arange(self.size, dtype=np.uint64) + seed + np.uint64(1))
        spread = mix(points.astype(np.uint64) + np.uint64(0x5EED))
        self.symbols = (spread % np.uint64(self.size)).astype(np.int64)
        power, inverse = powers(points.shape[1] + 2)
        self.power, self.back = power, inverse[1]
        self.sums = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        np.cumsum(self.values[self.symbols] * power[: points.shape[1]], axis=1, out=self.sums[:, 1:])

    def _keys(self, sums: np.ndarray) -> np.ndarray:
        return mix(sums + self.salt)

    def whole(self) -> np.ndarray:
        return self._keys(self.sums[:, -1])

    def shorter(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each reduced word with one symbol less, each once."""
        rest = (self.sums[:, -1:] - self.sums[:, 1:]) * self.back
        new = np.ones(self.symbols.shape, bool)
        new[:, 1:] = self.symbols[:, 1:] != self.symbols[:, :-1]
        return np.nonzero(new)[0], self._keys((self.sums[:, :-1] + rest)[new])

    def same(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each reduced word with at most one symbol replaced, each once."""
        n, width = self.symbols.shape
        own = self.values[self.symbols]
        step = (self.values[None, None, :] - own[:, :, None]) * self.power[None, :width, None]
        other = np.arange(self.size)[None, None, :] != self.symbols[:, :, None]
        changed = (self.sums[:, -1][:, None, None] + step)[other]
        rows = np.concatenate([np.arange(n), np.nonzero(other)[0]])
        return rows, self._keys(np.concatenate([self.sums[:, -1], changed]))

    def longer(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each reduced word with one symbol more, each once."""
        n, width = self.symbols.shape
        moved = self.sums + (self.sums[:, -1:] - self.sums) * self.power[1]
        added = self.values[None, None, :] * self.power[None, : width + 1, None]
        # Before an equal symbol it gives what it gives after it.
        after = np.full((n, width + 1), -1)
        after[:, :-1] = self.symbols
        new = np.arange(self.size)[None, None, :] != after[:, :, None]
        return np.nonzero(new)[0], self._keys((moved[:, :, None] + added)[new])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points and ids of the words of a batch, equally long ones together."""
    points, bounds = code_points(batch.column(0).to_pylist())
    ids = batch.column(1).to_numpy()
    lengths = np.diff(bounds) - 1
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        most = max(1, GENERATED // ((int(length) + 1) * symbols(int(length))))
        for at in range(0, len(rows), most):
            part = rows[at : at + most]
            yield points[bounds[part][:, None] + np.arange(length)], ids[part]


def _parities(points: np.ndarray) -> np.ndarray:
    """Which letters, hashed to 64, a word holds an odd number of times."""
    bins = mix(points.astype(np.uint64) + np.uint64(0xB175)) % np.uint64(64)
    return np.bitwise_xor.reduce(np.uint64(1) << bins, axis=1)


def _rows(keys: np.ndarray, ids: np.ndarray, letters: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(ids), pa.array(letters.view(np.int64))],
        ["key", "id", "letters"],
    )


def reduced(vocabulary: DataFrame) -> DataFrame:
    """The hash of the reduced form of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, ids in _by_length(batch):
                yield _rows(Reduced(points, points.shape[1]).whole(), ids, _parities(points))

    return vocabulary.select("word", "id").mapInArrow(run, KEYED)


def _slot_bits(keys: Column) -> tuple[Column, Column]:
    bit = F.shiftrightunsigned(keys, 64 - FILTER_BITS)
    one = F.expr("shiftleft(1L, cast(shiftrightunsigned(key, {}) & 63 as int))".format(64 - FILTER_BITS))
    return F.shiftright(bit, 6), one


def key_filter(keyed: DataFrame) -> np.ndarray:
    """A bit for each hash in a table of ``2 ** FILTER_BITS`` bits: 16 MB at most."""
    slot, bit = _slot_bits(F.col("key"))
    found = keyed.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def neighbourhood(vocabulary: DataFrame, table: np.ndarray, least_length: int) -> DataFrame:
    """Hashes of reduced words within one edit of each word's, those in the filter."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value

        def present(keys: np.ndarray) -> np.ndarray:
            bits = keys >> np.uint64(64 - FILTER_BITS)
            return (held[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1

        for batch in batches:
            for points, ids in _by_length(batch):
                length, letters = points.shape[1], _parities(points)
                found = [Reduced(points, length).same(), Reduced(points, length + 1).longer()]
                if length > least_length:
                    found.append(Reduced(points, length - 1).shorter())
                for rows, keys in found:
                    there = present(keys)
                    rows, keys = rows[there], keys[there]
                    yield _rows(keys, ids[rows], letters[rows])

    return vocabulary.select("word", "id").mapInArrow(run, KEYED)


def _joined(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join without a broadcast: both sides grow with the vocabulary."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def near_words(vocabulary: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """Near words of every word, in both directions: ``id``, ``near_id``, ``near``, ``near_n``."""
    keyed = staged(reduced(vocabulary), "reduced-words")
    asked = neighbourhood(vocabulary, key_filter(keyed), least_length)
    held = keyed.select("key", F.col("id").alias("near_id"), F.col("letters").alias("near_letters"))
    differ = F.bit_count(F.col("letters").bitwiseXOR(F.col("near_letters")))
    pairs = _joined(asked, held, "key").where((F.col("id") != F.col("near_id")) & (differ <= 2))
    pairs = staged(pairs.select("id", "near_id"), "near-candidates")
    named = vocabulary.select("id", "word")
    others = vocabulary.select(
        F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    told = _joined(_joined(pairs, named, "id"), others, "near_id")
    return told.where(F.levenshtein("word", "near", 1) == 1).select("id", "near_id", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """The end of the chain of forms from every ``id`` to its ``form_id``."""
    links = staged(forms.select("id", F.col("form_id").alias("root_id")), "forms")
    while True:
        ahead = links.select(F.col("id").alias("root_id"), F.col("root_id").alias("ahead"))
        moved = _joined(links, ahead, "root_id", "left")
        moved = staged(
            moved.select("id", F.coalesce("ahead", "root_id").alias("root_id"), F.col("ahead").isNotNull().alias("moved")),
            "roots",
        )
        links = moved.drop("moved")
        if not moved.where("moved").head(1):
            return links


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    noise: int = NOISE,
) -> DataFrame:
    """Every frequent word with its count, its near words, its form and the root of its forms."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = words(rows, noise, least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Written once, so the numbers of words stay what they are.
    vocabulary = staged(
        counted.where(F.col("n") >= least_count).withColumn("id", F.monotonically_increasing_id()), "vocabulary"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near", "near_id")).alias("best")
    told = near_words(vocabulary, least_length).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    told = _joined(vocabulary, told, "id", "left")
    frequent = -F.col("best.minus_n") >= ratio * F.col("n")
    told = told.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *(F.when(frequent, F.col(f"best.{c}")).alias(a) for c, a in (("near", "form"), ("near_id", "form_id"))),
        F.when(frequent, -F.col("best.minus_n")).alias("form_n"),
    )
    told = staged(told, "word-forms")
    ends = roots(told.where("form_id is not null"))
    names = vocabulary.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    ends = _joined(ends, names, "root_id").select("id", "root")
    return _joined(told, ends, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
