"""Languages of texts and of the spans within them (operator 3).

Training counts letter trigrams (hashed into ``BUCKETS`` cells) and scripts per
language; Spark sums the counts, and the driver receives at most one row per cell
and language. A prediction cuts a text into words. The script of a word leaves
the languages that use it, each of them scores the word by the log-likelihood of
its trigrams, and a Viterbi path over the words of a text, which pays
``SWITCH_PENALTY`` for every change of language, labels spans. The language of a
text is the one with most letters on the path, its score their share.

Texts are handled in batches of bounded size. The path is found for all texts of
a batch side by side, one word after another.

Cases: a text that is null or has no letter is ``und`` with score 0 and no span.
Rows without a language or text are not learned from. Equal shares go to the
language that comes first by name. Without any language to learn from, all texts
are ``und``. Null and repeated ids are predicted row by row; an empty table gives
no row. Columns other than the id, text and language are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import chunks
from tellurion.llm.textops import code_points, mix, runs, sums

UNKNOWN = "und"
BUCKETS = 1 << 17
SWITCH_PENALTY = 12.0
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
BATCH_CHARS = 3_000_000

#: First code points of Unicode blocks and the script of their letters (fixed values).
SCRIPTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"),
    (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0x4DC0, "other"), (0x4E00, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0xFF21, "latin"), (0xFF5B, "other"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
_SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_OF = np.array([_SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

PREDICTED = (
    "doc_id long, lang_pred string, score double,"
    " spans array<struct<start: long, end: long, lang: string>>"
)
_TABLES: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: letter, part of a word (letter or mark), lower case."""
    if not _TABLES:
        every = [chr(i) for i in range(0x110000)]
        letter = np.array([c.isalpha() for c in every])
        mark = np.array([unicodedata.category(c)[0] == "M" for c in every])
        lower = np.arange(0x110000, dtype=np.uint32)
        for i in np.flatnonzero(letter):
            small = every[i].lower()
            lower[i] = ord(small) if len(small) == 1 else i
        _TABLES.extend([letter, letter | mark, lower])
    return tuple(_TABLES)


@dataclass
class Words:
    """Words of a batch: where they lie, whose they are, their letters and trigram cells."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    script: np.ndarray
    cells: np.ndarray
    first_cell: np.ndarray
    letters: np.ndarray
    bounds: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    points, bounds = code_points(texts)
    letter, inside, lower = _letters()
    mask = inside[points]
    starts, ends = runs(mask)
    # A word of marks alone is none.
    count = sums(letter[points], np.stack([starts, ends], 1).reshape(-1))[::2] if len(starts) else starts
    keep = count > 0
    starts, ends, count = starts[keep], ends[keep], count[keep]
    small = np.where(mask, lower[points], 0).astype(np.uint64)
    before = np.concatenate([[0], small[:-1]]).astype(np.uint64)
    after = np.concatenate([small[1:], [0]]).astype(np.uint64)
    cells = mix(before << np.uint64(42) | small << np.uint64(21) | after) % np.uint64(BUCKETS)
    lengths = ends - starts
    at = np.zeros(len(points), bool)
    at[:] = mask
    if not keep.all():
        for a, b in zip(*(x[~keep] for x in runs(mask))):
            at[a:b] = False
    return Words(
        starts,
        ends,
        np.searchsorted(bounds, starts, "right") - 1,
        _SCRIPT_OF[np.searchsorted(_SCRIPT_STARTS, points[starts], "right") - 1]
        if len(starts)
        else starts,
        cells[at].astype(np.int64),
        np.cumsum(lengths) - lengths,
        count,
        bounds,
    )


@dataclass
class Model:
    """Languages, log-likelihoods of trigram cells, and the languages of each script."""

    langs: list[str]
    log_likelihood: np.ndarray
    candidates: np.ndarray
    penalty: float = SWITCH_PENALTY

    @classmethod
    def of_counts(cls, rows: list[tuple[str, int, int]], penalty: float = SWITCH_PENALTY) -> Model:
        langs = sorted({lang for lang, _, _ in rows})
        place = {lang: k for k, lang in enumerate(langs)}
        counts = np.zeros((BUCKETS + len(_SCRIPT_NAMES), len(langs)))
        for lang, cell, n in rows:
            counts[cell, place[lang]] = n
        grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
        likely = (grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * BUCKETS)
        uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
        uses[~uses.any(1)] = True
        return cls(langs, np.log(likely).astype(np.float32), uses, penalty)

    def scores(self, words: Words) -> np.ndarray:
        """Log-likelihood of every word in every language."""
        if not len(words.starts):
            return np.zeros((0, len(self.langs)), np.float32)
        found = np.add.reduceat(self.log_likelihood[words.cells], words.first_cell, axis=0)
        found[~self.candidates[words.script]] = -1e6
        return found

    def path(self, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Best labels of the words of all texts; ``counts`` are their numbers of words."""
        order = np.argsort(-counts, kind="stable")
        sizes = counts[order]
        firsts = (np.cumsum(counts) - counts)[order]
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), "left")
        value = np.zeros((len(counts), len(self.langs)), np.float32)
        came = np.zeros(scores.shape, np.uint16)
        own = np.arange(len(self.langs), dtype=np.uint16)
        for t in range(longest):
            a = active[t]
            at, now = firsts[:a] + t, value[:a]
            best = now.argmax(1)
            now -= np.take_along_axis(now, best[:, None], 1)
            came[at] = np.where(now >= -self.penalty, own, best[:, None])
            np.maximum(now, -self.penalty, out=now)
            now += scores[at]
        labels = np.zeros(len(scores), np.int64)
        state = value.argmax(1)
        for t in range(longest - 1, -1, -1):
            a = active[t]
            at = firsts[:a] + t
            labels[at] = state[:a]
            state[:a] = came[at, state[:a]]
        return labels

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, pa.Array]:
        """Language, score and spans of each text."""
        words = words_of(texts)
        n, wide = len(texts), len(self.langs)
        if not wide or not len(words.starts):
            return self._nothing(n)
        counts = np.bincount(words.doc, minlength=n)
        labels = self.path(self.scores(words), counts)
        letters = np.bincount(words.doc * wide + labels, words.letters, n * wide).reshape(n, wide)
        best, total = letters.argmax(1), letters.sum(1)
        score = letters[np.arange(n), best] / np.maximum(total, 1)
        names = [self.langs[b] if t else UNKNOWN for b, t in zip(best, total)]
        new = np.flatnonzero(np.diff(words.doc * wide + labels, prepend=-1))
        last = np.concatenate([new[1:], [len(labels)]]) - 1
        base = words.bounds[words.doc[new]]
        spans = pa.StructArray.from_arrays(
            [
                pa.array(words.starts[new] - base),
                pa.array(words.ends[last] - base),
                pa.array(self.langs, pa.string()).take(pa.array(labels[new])),
            ],
            ["start", "end", "lang"],
        )
        ends = np.concatenate([[0], np.cumsum(np.bincount(words.doc[new], minlength=n))])
        return names, score, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)

    def _nothing(self, n: int):
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
        return [UNKNOWN] * n, np.zeros(n), pa.array([[]] * n, pa.list_(kind))


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", penalty: float = SWITCH_PENALTY
) -> Model:
    """Learn from all rows that have a text and a language.

    Memory of the model is ``BUCKETS`` cells for each language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            sizes = np.fromiter((len(t.as_py()) for t in batch.column(0)), np.int64, len(langs))
            for a, b in chunks(sizes, BATCH_CHARS):
                words = words_of(batch.column(0).slice(a, b - a).to_pylist())
                names, lang = np.unique(langs[a:b], return_inverse=True)
                of_word = lang[words.doc]
                of_cell = np.repeat(of_word, words.ends - words.starts)
                for k, name in enumerate(names):
                    own = counts.setdefault(str(name), np.zeros(BUCKETS + len(_SCRIPT_NAMES), np.int64))
                    own[:BUCKETS] += np.bincount(words.cells[of_cell == k], minlength=BUCKETS)
                    mine = of_word == k
                    own[BUCKETS:] += np.bincount(
                        words.script[mine], words.letters[mine], len(_SCRIPT_NAMES)
                    ).astype(np.int64)
        for name, own in counts.items():
            cell = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cell), pa.string()), pa.array(cell), pa.array(own[cell])],
                ["lang", "cell", "n"],
            )

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    counted = rows.mapInArrow(run, "lang string, cell long, n long")
    summed = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    return Model.of_counts([tuple(r) for r in summed.collect()], penalty)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Language, score and labelled spans of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = np.fromiter((len(t.as_py() or "") for t in texts), np.int64, len(texts))
            for a, b in chunks(sizes, BATCH_CHARS):
                names, score, spans = model.predict(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(names), pa.array(score), spans],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PREDICTED)
