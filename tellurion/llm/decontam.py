"""Passages of benchmark items in documents, with edits (operator 7).

Items and documents are sequences of words without case and punctuation. A word is
a run of letters, marks and numbers by their Unicode class, in the full case folding
of its upper case (``ß`` is ``ss``, accents stay); in scripts that are written
without spaces (``UNSPACED``) each letter with its marks is a word. An item
of ``m`` words is found where a stretch of a document is within ``k`` word edits of
it, with ``k`` the largest number for which ``m - k`` is ``percent`` of ``m``.

* Windows of an item's size start at every word. A window within ``k`` edits keeps
  ``m - 1 - 2 k`` of the item's word pairs; windows with fewer pairs from any item
  of their size class are passed over. This loses nothing.
* A CGK walk maps a word sequence to another one in which edits become
  substitutions: at step ``j`` it writes the current word and moves on if a random
  bit of (j, word) says so. After an edit, two walks tend to fall in step again.
* Each repetition draws new bits and samples at most ``SAMPLED`` places of the walk as
  the key of a window. Items with an equal key are candidates. The longer an item,
  the fewer steps two walks share, so each size class measures itself: planted
  sequences at the threshold must be found at ``TARGET``, or the class samples fewer
  places and then draws more repetitions than ``REPEATS``.
  ``tests/llm/test_duplicates.py`` measures recall against brute force.
* Candidates are verified by exact edit distance.

Documents are mapped one by one and are not shuffled. Items travel to the tasks in
blocks of at most ``BLOCK_BYTES`` of text, one pass over the documents for each
block.

Cases: null and empty texts and items match nothing. Repeated items are found
under each id, repeated documents row by row; null ids are passed on. Texts of any
length are searched whole. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import KEPT, chunks, released, utf8
from tellurion.llm.textops import BASE, BYTE_VALUES, Spans, mix, words_in

PERCENT = 80
REPEATS, SAMPLED = 64, 3
#: Share of planted sequences that a size class must find, of so many.
TARGET, PLANTED = 0.98, 100
#: Sizes of items in a class differ by this factor at most.
CLASS_STEP = 1.15
BLOCK_BYTES = 4 << 20
BATCH_BYTES = 1 << 19
#: Cells of word pairs for each word of the items, at least.
CELLS = 8

MATCHES = (
    "doc_id long, item_id long, distance long, item_words long, start_byte long, end_byte long"
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.array([i < 128 and chr(i).isalnum() for i in range(256)])

#: First and last code points of scripts that put no space between words (fixed values): Thai,
#: Lao, Myanmar, Khmer, Tai, kana, bopomofo, han.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),
    (0x3005, 0x3006), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)
#: What a code point is to a word.
OUTSIDE, INSIDE, ALONE, MARK = range(4)
#: Added to the class of what folds to several code points.
LONGER = 4
_TABLES: list = []
KEPT["decontam"] = _TABLES.clear


def _points() -> tuple[np.ndarray, np.ndarray, dict[int, list[int]], np.ndarray]:
    """For every code point: class, folded form, that of several code points, 64-bit value."""
    if not _TABLES:
        kind = np.zeros(0x110000, np.uint8)
        folded = np.arange(0x110000, dtype=np.uint32)
        longer: dict[int, list[int]] = {}
        of_class = {"L": INSIDE, "N": INSIDE, "M": MARK}
        for i in range(0x110000):
            char = chr(i)
            name = unicodedata.category(char)[0]
            if name not in of_class:
                continue
            kind[i] = of_class[name]
            if name == "L" and any(a <= i <= b for a, b in UNSPACED):
                kind[i] = ALONE
            small = char.upper().casefold()
            folded[i] = ord(small[0])
            if len(small) > 1:
                longer[i] = [ord(c) for c in small]
                kind[i] += LONGER
        values = mix(np.arange(1, 0x110001, dtype=np.uint64) * BASE)
        _TABLES.extend([kind, folded, longer, values])
    return tuple(_TABLES)


def _decoded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, where each starts, and which are beyond ASCII."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[at].astype(np.uint32)
    wide = np.flatnonzero(points >= 0xC0)
    lead = points[wide]
    more = 1 + (lead >= 0xE0) + (lead >= 0xF0)
    value = lead & (0x3F >> more).astype(np.uint32)
    for k in range(1, 4):
        follow = data[np.minimum(at[wide] + k, len(data) - 1)] & 0x3F
        value = np.where(more >= k, value << np.uint32(6) | follow, value)
    points[wide] = np.minimum(value, 0x10FFFF)
    return points, at, wide


def word_hashes(data: np.ndarray, bounds: np.ndarray):
    """Hashes, starts and ends (in bytes) of all words, and the first word of each text."""
    if not (data & 0x80).any():
        starts, ends, first = words_in(_IN_WORD[data], bounds)
        return Spans(BYTE_VALUES[_LOWER[data]]).of(starts, ends), starts, ends, first
    kind, folded, longer, values = _points()
    points, at, wide = _decoded(data)
    after = np.append(at[1:], len(data))
    several = wide[kind[points[wide]] >= LONGER]
    small = folded[points]
    if len(several):
        times = np.ones(len(points), np.int64)
        times[several] = [len(longer[int(p)]) for p in points[several]]
        place = (np.cumsum(times) - times)[several]
        small, at, after = (np.repeat(v, times) for v in (small, at, after))
        for k, p in zip(place, points[several]):
            small[k : k + len(longer[int(p)])] = longer[int(p)]
    own = kind[small] % LONGER
    limits = np.searchsorted(at, bounds)
    cuts = None
    if own.max(initial=OUTSIDE) >= ALONE:
        # A mark belongs to what it follows in its text; after nothing it is in no word.
        heads = own != MARK
        heads[limits[limits < len(own)]] = True
        base = np.maximum.accumulate(np.where(heads, np.arange(len(own)), 0))
        own = own[base]
        alone = own == ALONE
        cuts = np.flatnonzero(heads[1:] & (alone[1:] | alone[:-1])) + 1
    starts, ends, first = words_in((own == INSIDE) | (own == ALONE), limits, cuts)
    return Spans(values[small]).of(starts, ends), at[starts], after[ends - 1], first


def walk_keys(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray
) -> np.ndarray:
    """Keys of the sequences ``words[start:end]``: a row per repetition.

    Row ``r`` of ``places`` names the steps of walk ``r`` that make up its key. All
    walks go on side by side; after the end of its sequence a walk writes 0.
    """
    repeats = np.arange(1, len(places) + 1, dtype=np.uint64)[:, None]
    keys = np.repeat(repeats, len(starts), axis=1)
    at = np.repeat(starts[None, :], len(places), axis=0)
    last = len(words) - 1
    for j in range(int(places.max()) + 1):
        now = np.where(at < ends, words[np.minimum(at, last)], np.uint64(0))
        taken = (places == j).any(1)
        keys[taken] = mix(keys[taken] + now[taken])
        bit = mix(now ^ mix(repeats << np.uint64(20) | np.uint64(j)))
        at += (bit & np.uint64(1)).astype(np.int64)
    return keys


def planted(rng: np.random.Generator, size: int, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences of distinct words, each followed by a copy with ``edits`` edits: words, starts, ends."""
    parts = []
    for _ in range(PLANTED):
        own = rng.integers(1, 1 << 62, size).astype(np.uint64)
        # Edits on different words: dropped, replaced, or another word set before.
        at = rng.choice(size, edits, replace=False)
        kind = np.zeros(size, np.int64)
        kind[at] = rng.integers(1, 4, edits)
        new = rng.integers(1, 1 << 62, size).astype(np.uint64)
        both = np.stack([new, np.where(kind == 2, new + np.uint64(1), own)], 1)
        kept = np.stack([kind == 3, kind != 1], 1)
        parts += [own, both[kept]]
    ends = np.cumsum([len(p) for p in parts])
    return np.concatenate(parts), ends - [len(p) for p in parts], ends


def edit_distance(items: np.ndarray, sizes: np.ndarray, texts: np.ndarray, free: bool):
    """Least edit distance of each item to a stretch of its text, and where that ends.

    Rows of ``items`` are padded after ``sizes`` words, rows of ``texts`` with zeros. A
    stretch begins anywhere if ``free``, else at the start.
    """
    n, wide = items.shape
    place = np.arange(wide + 1)
    rows = np.arange(n)
    now = np.broadcast_to(place, (n, wide + 1)).astype(np.int32)
    best, end = now[rows, sizes].copy(), np.zeros(n, np.int64)
    for j in range(texts.shape[1]):
        word = texts[:, j]
        new = np.empty_like(now)
        new[:, 0] = 0 if free else j + 1
        differs = items != word[:, None]
        np.minimum(now[:, :-1] + differs, now[:, 1:] + 1, out=new[:, 1:])
        new = np.minimum.accumulate(new - place, axis=1) + place
        now = new.astype(np.int32)
        found = now[rows, sizes]
        better = (found < best) & (word != 0)
        best[better], end[better] = found[better], j + 1
    return best, end


@dataclass
class SizeClass:
    """Items of similar size: the mark of their word pairs and the keys of their walks."""

    low: int
    high: int
    edits: int
    items: np.ndarray
    mark: np.uint64
    places: np.ndarray
    keys: np.ndarray
    owners: np.ndarray


@dataclass
class Index:
    """The items of one block, ready to be searched for."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    percent: int = PERCENT
    repeats: int = REPEATS
    sampled: int = SAMPLED
    classes: list[SizeClass] = field(default_factory=list)
    #: For each cell of word pairs, a bit per size class that has it (the last for all further ones).
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))

    @classmethod
    def of(cls, ids: list, texts: list[str | None], percent: int = PERCENT, repeats: int = REPEATS) -> Index:
        data, bounds = utf8(pa.array(texts, pa.string()))
        words, _, _, first = word_hashes(data, bounds)
        made = cls(ids, words, first, percent, repeats)
        made.pairs = np.zeros(1 << max(16, (CELLS * len(words)).bit_length()), np.uint64)
        sizes = np.diff(first)
        low = 1
        while low <= sizes.max(initial=0):
            high = max(low, int(low * CLASS_STEP))
            chosen = np.flatnonzero((sizes >= low) & (sizes <= high))
            if len(chosen):
                made.classes.append(made._class(low, high, chosen))
            low = high + 1
        return made

    def edits(self, size):
        return size - -(-self.percent * size // 100)

    def _class(self, low: int, high: int, items: np.ndarray) -> SizeClass:
        bit = np.uint64(1 << min(len(self.classes), 63))
        for i in items:
            self.pairs[_pairs(self.words[self.first[i] : self.first[i + 1]], len(self.pairs))] |= bit
        places = self._places(low, high)
        made = SizeClass(low, high, int(self.edits(high)), items, bit, places, *[np.zeros(0)] * 2)
        keys = walk_keys(self.words, self.first[items], self.first[items + 1], places)
        order = np.argsort(keys, axis=None, kind="stable")
        made.keys, made.owners = keys.reshape(-1)[order], np.tile(items, len(places))[order]
        return made

    def _places(self, low: int, high: int) -> np.ndarray:
        """Sampled places of the walks of a size class that reach the target recall."""
        rng = np.random.default_rng(low)
        steps = max(1, low + low // 2)
        sampled, repeats = min(self.sampled, steps), self.repeats
        words, starts, ends = planted(rng, high, int(self.edits(high)))
        while True:
            places = np.stack([np.sort(rng.choice(steps, sampled, replace=False)) for _ in range(repeats)])
            keys = walk_keys(words, starts, ends, places)
            recall = (keys[:, 0::2] == keys[:, 1::2]).any(0).mean()
            if recall >= TARGET or repeats >= 64 * self.repeats:
                return places
            if sampled > 1:
                sampled -= 1
            else:
                repeats *= 2

    def search(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple]:
        """Best match of each item in each text: text, item, distance, first and last byte."""
        words, starts, ends, first = word_hashes(data, bounds)
        if not len(words):
            return []
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        stop = first[1:][text]
        # A pair that crosses the end of a text is none.
        marks = self.pairs[_pairs(words, len(self.pairs))] * (text[1:] == text[:-1])
        of_any = _running(marks != 0, max((c.low for c in self.classes), default=0))
        found: dict[tuple[int, int], tuple] = {}
        for c in self.classes:
            place = self._likely(c, marks, of_any)
            for at in range(0, len(place), 4096):
                own = place[at : at + 4096]
                keys = walk_keys(words, own, np.minimum(own + c.high, stop[own]), c.places)
                left = np.searchsorted(c.keys, keys, "left")
                count = np.searchsorted(c.keys, keys, "right") - left
                hit = np.nonzero(count)
                if not len(hit[0]):
                    continue
                times = count[hit]
                ranks = np.repeat(left[hit] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                items, windows = c.owners[ranks], np.repeat(own[hit[1]], times)
                self._verify(c, words, first, text, items, windows, found)
        return [
            (t, self.ids[i], d, int(self.first[i + 1] - self.first[i]), starts[a] - bounds[t], ends[b] - bounds[t])
            for (t, i), (d, a, b) in sorted(found.items())
        ]

    def _likely(self, c: SizeClass, marks: np.ndarray, of_any: np.ndarray) -> np.ndarray:
        """Starts of windows with enough of the word pairs of a class."""
        n, wide = len(marks) + 1, c.low - 1
        need = wide - 2 * c.edits
        if need <= 0:
            return np.arange(n)
        enough = np.flatnonzero(of_any[wide : wide + n] - of_any[:n] >= need)
        if not len(enough):
            return enough
        own = _running((marks & c.mark) != 0, c.low)
        return enough[own[enough + wide] - own[enough] >= need]

    def _verify(self, c, words, first, text, items, windows, found) -> None:
        """Exact distances of candidate items around their windows."""
        block = windows // c.high
        rows = np.unique(np.stack([items, text[windows], block], 1), axis=0)
        margin = c.edits + 1
        for at in range(0, len(rows), 4096):
            item, doc, block = rows[at : at + 4096].T
            begin = np.maximum(block * c.high - margin, first[doc])
            end = np.minimum((block + 2) * c.high + margin, first[doc + 1])
            sizes = self.first[item + 1] - self.first[item]
            own = _padded(self.words, self.first[item], sizes, c.high)
            near = _padded(words, begin, end - begin, int((end - begin).max()))
            distance, stop = edit_distance(own, sizes, near, True)
            good = distance <= self.edits(sizes)
            if not good.any():
                continue
            item, doc, begin, sizes = item[good], doc[good], begin[good], sizes[good]
            distance, stop = distance[good], stop[good]
            # From its end backwards, a match of that distance shows its start.
            back = np.minimum(stop, sizes + distance)
            reverse = _padded(words, begin + stop - back, back, int(back.max()), True)
            _, length = edit_distance(_padded(self.words, self.first[item], sizes, c.high, True), sizes, reverse, False)
            for i, t, d, a, b in zip(item, doc, distance, begin + stop - length, begin + stop - 1):
                key = (int(t), int(i))
                match = (int(d), int(min(a, b)), int(b))
                if key not in found or match < found[key]:
                    found[key] = match


def _pairs(words: np.ndarray, cells: int) -> np.ndarray:
    """Cells of neighbouring words."""
    return (mix(words[:-1] + mix(words[1:])) & np.uint64(cells - 1)).astype(np.int64)


def _running(hits: np.ndarray, wide: int) -> np.ndarray:
    """Number of hits before each word, with the total for ``wide`` places beyond the last."""
    n = len(hits) + 1
    total = np.zeros(n + 1 + wide, np.int32)
    np.cumsum(hits, out=total[1:n])
    total[n:] = total[n - 1]
    return total


def _padded(words, starts, sizes, wide: int, backwards: bool = False) -> np.ndarray:
    """Rows of words, filled up with zeros."""
    place = np.arange(wide)
    inside = place < sizes[:, None]
    at = starts[:, None] + (sizes[:, None] - 1 - place if backwards else place)
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))


def indexes(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", percent: int = PERCENT,
    repeats: int = REPEATS, block_bytes: int = BLOCK_BYTES,
) -> Iterator[Index]:
    """Indexes of the items, a bounded block at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where("text is not null")
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        found = sorted(part.collect(), key=lambda r: (r["id"] is not None, r["id"] or 0, r["text"]))
        if found:
            yield Index.of([r["id"] for r in found], [r["text"] for r in found], percent, repeats)


def find(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = PERCENT,
    repeats: int = REPEATS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The best match of every item in every document that has one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in indexes(items, item_col, item_text_col, percent, repeats, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = utf8(batch.column(1))
                for a, b in chunks(np.diff(offsets), BATCH_BYTES):
                    found = index.search(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    if found:
                        text, *rest = (list(c) for c in zip(*found))
                        ids = batch.column(0).take(pa.array([a + int(t) for t in text]))
                        yield pa.RecordBatch.from_arrays(
                            [ids, *(pa.array(c, pa.int64()) for c in rest)],
                            [c.split()[0] for c in MATCHES.split(", ")],
                        )

        matches = rows.mapInArrow(released(run, "decontam"), MATCHES)
        out = matches if out is None else out.unionByName(matches)
    return docs.sparkSession.createDataFrame([], MATCHES) if out is None else out


def contaminated(text: Column, index: Index) -> Column:
    """Whether a text holds an item of an index; a filter on it needs no shuffle."""

    def flags(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            data, offsets = utf8(column)
            out = np.zeros(len(column), bool)
            for a, b in chunks(np.diff(offsets), BATCH_BYTES):
                for match in index.search(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                    out[a + match[0]] = True
            yield pa.array(out)

    @F.arrow_udf("boolean")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return released(flags, "decontam")(texts)

    return found(text)
