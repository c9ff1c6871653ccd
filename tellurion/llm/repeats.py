"""Long passages that an earlier document already has (operator 9).

A byte is marked if it lies in ``least`` bytes that also start in a document with a
smaller id. The search is exact and needs no index of the whole corpus:

1. Every window of ``least`` bytes has an anchor, its ``ANCHOR`` bytes of least hash.
   Equal windows have equal anchors. Documents are dealt into slots of bounded size;
   anchors travel as packed arrays to buckets, which tell the slots of the anchors
   that more than one document has. An anchor met twice on the way travels once.
2. For each such anchor a slot cuts out the fragment that its windows cover. Of
   equal fragments of a slot, that of the smallest id goes to the anchor's bucket;
   the others are marked where they are.
3. A bucket keeps each distinct fragment once, with its first owner. Equal windows have
   their anchor at the same place, and windows with about as many bytes before it hold
   the same bytes around it: a fragment that shares none of these few stretches with
   another one shares no window and needs no index. Of the others run-length indexes are
   built (``runindex``), one for so many anchors, and they are streamed through. The
   matching statistics give, for every window, the first document that has it.
4. An anchor with more than ``MOST_FRAGMENTS`` fragments in all slots (a common line
   in texts that differ) has no bucket. Its windows are dealt one by one, by their
   hash: of equal windows of a slot, that of the smallest id is told to the window's
   own bucket, which marks those that a smaller id has.
5. Slots collect the marked spans of their documents.

Texts travel compressed. A task holds one slot, or the fragments of one bucket,
whose numbers follow from the size of the input; no anchor brings more than
``MOST_FRAGMENTS`` of them.

Cases: null texts count as empty. Texts shorter than ``least`` bytes keep all.
Documents with equal ids do not mark each other; documents without an id are
neither searched nor marked. Repeated rows are handled alike. An empty table gives
no row. Columns beside the id and text are not read. Equality of anchors, fragments
and windows is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import chunks, ragged, released, staged, trim
from tellurion.llm.runindex import RunIndex
from tellurion.llm.textops import BYTE_VALUES, Spans, mix

LEAST, ANCHOR = 50, 16
SLOT_BYTES = 4 << 20
BUCKET_ANCHORS = 300_000
#: Text of one index, unless a single anchor has more.
INDEX_BYTES = 256 << 10
#: Fragments of an anchor in one bucket: about 1 MB of text in one index.
MOST_FRAGMENTS = 1 << 14
#: Bytes that are hashed at a time.
PART_BYTES = 1 << 20
#: Bits of a place within such a part and its last window.
PLACE_BITS = 21
#: Places of the anchor in a window that are told apart before an index is built.
AROUND = 7
#: Bytes of text per anchor: windows share an anchor with half of their neighbours.
BYTES_PER_ANCHOR = (LEAST - ANCHOR + 2) // 2
LEVEL = 3

ANCHORS = "bucket long, slot long, anchors binary, several binary, times binary"
NOTICES = "slot long, anchors binary, crowded binary"
FRAGMENTS = (
    "bucket long, slot long, doc_ids binary, docs binary, starts binary, sizes binary, data binary"
)
SPANS = "slot long, docs binary, starts binary, ends binary"
MARKED = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>"


def sliding_anchors(data: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: hash, and the first and last window that it is the anchor of."""
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none.astype(np.uint64), none, none
    if len(data) > PART_BYTES + least:
        # An anchor at a seam is met twice, each time with its windows on one side.
        parts = []
        for at in range(0, len(data) - least + 1, PART_BYTES):
            value, first, last = sliding_anchors(data[at : at + PART_BYTES + least - 1], least, anchor)
            parts.append((value, at + first, at + last))
        return tuple(np.concatenate(p) for p in zip(*parts))
    at = np.arange(len(data) - anchor + 1)
    hashes = Spans(BYTE_VALUES[data]).of(at, at + anchor)
    # Least hash of every window by doubling, with its place in the lowest bits.
    value, span, wide = _placed(hashes, at), 1, least - anchor + 1
    while span < wide:
        step = min(span, wide - span)
        value = np.minimum(value[:-step], value[step:])
        span += step
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    last = np.append(first[1:], len(value)) - 1
    place = (value[first] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return hashes[place], first, last


def _placed(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What anchors are chosen by: the high bits of a hash, then the place."""
    return hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | at.astype(np.uint64)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.ascontiguousarray(values).tobytes())


def _array(value, kind) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(value.as_py() if isinstance(value, pa.Scalar) else value)
    return np.frombuffer(raw, kind)


def _bucket_of(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (anchors >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchors), np.int64)


def _anchor_bucket(anchors: np.ndarray, bits: int) -> np.ndarray:
    """Anchors are least hashes and crowd at low values: their bits are spread once more."""
    return _bucket_of(mix(anchors), bits)


def _ranges(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each key with the range that it has in a sorted array."""
    first = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(sorted_keys))):
        yield int(sorted_keys[a]), int(a), int(b)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def packed_docs(
    docs: DataFrame, slots: int, id_col: str, text_col: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Documents with compressed texts, the slot each belongs to, and carried columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = pa.array([press.compress(t.as_buffer() or b"") for t in batch["text"]], pa.binary())
            yield batch.set_column(2, "text", texts)

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(slots)).alias("slot"),
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        *(F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)),
    )
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[3:]]
    return rows.mapInArrow(released(run), ", ".join(["slot long, doc_id long, text binary", *kinds]))


def _slot_docs(group: pa.Table) -> tuple[list[int | None], list[np.ndarray], np.ndarray]:
    """Ids and texts of a slot, and their rows, in an order that how they came does not change."""
    trim()
    ids, texts = group["doc_id"].to_pylist(), group["text"].to_pylist()
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k]))
    return [ids[k] for k in order], [_array(texts[k], np.uint8) for k in order], np.array(order, np.int64)


def _anchor_rows(packed: DataFrame, bits: int) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        slot = key[0].as_py()
        ids, texts, _ = _slot_docs(group)
        every = [sliding_anchors(t, LEAST, ANCHOR)[0] for i, t in zip(ids, texts) if i is not None]
        own = [np.unique(a) for a in every]
        values, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
        _, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *every]), return_counts=True)
        number = np.minimum(number, MOST_FRAGMENTS + 1).astype(np.uint32)
        # Two documents of one id share what they have with no one else: told as several, which
        # only brings fragments that match nothing.
        rows = []
        buckets = _anchor_bucket(values, bits)
        order = np.argsort(buckets, kind="stable")
        values, times, number = values[order], times[order], number[order]
        for bucket, a, b in _ranges(buckets[order]):
            low = values[a:b]
            several = np.packbits(times[a:b] > 1)
            rows.append((bucket, slot, low.tobytes(), several.tobytes(), _packed(number[a:b])))
        return pa.Table.from_batches([_rows(ANCHORS, rows)])

    return packed.groupBy("slot").applyInArrow(run, ANCHORS)


def _notices(anchors: DataFrame) -> DataFrame:
    """For each slot, those of its anchors that several documents have, and which are crowded."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        trim()
        lists = [np.frombuffer(a.as_buffer(), np.uint64) for a in group["anchors"].combine_chunks()]
        flags = [
            np.unpackbits(np.frombuffer(s.as_buffer(), np.uint8), count=len(a)).astype(bool)
            for s, a in zip(group["several"].combine_chunks(), lists)
        ]
        every = np.sort(np.concatenate(lists))
        twice = every[1:][every[1:] == every[:-1]]
        shared = np.unique(np.concatenate([twice, *(a[f] for a, f in zip(lists, flags))]))
        at = [np.searchsorted(shared, a[_among(a, shared)]) for a in lists]
        total = np.zeros(len(shared), np.int64)
        for own, anchors, times in zip(at, lists, group["times"].combine_chunks()):
            total[own] += _array(times, np.uint32)[_among(anchors, shared)]
        crowded = total > MOST_FRAGMENTS
        rows = []
        for slot, own in zip(group["slot"].to_pylist(), at):
            if len(own):
                rows.append((slot, shared[own].tobytes(), shared[own[crowded[own]]].tobytes()))
        return pa.Table.from_batches([_rows(NOTICES, rows)])

    return anchors.groupBy("bucket").applyInArrow(run, NOTICES)


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _fragment_rows(packed: DataFrame, notices: DataFrame, bits: int) -> DataFrame:
    """Fragments for the buckets; a bucket below 0 holds spans marked within a slot.

    Buckets from ``2 ** bits`` on hold hashes of windows of crowded anchors.
    """

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows or not told.num_rows:
            return pa.Table.from_batches([_rows(FRAGMENTS, [])])
        slot = key[0].as_py()
        shared, crowded = (
            np.sort(np.concatenate([np.frombuffer(a.as_buffer(), np.uint64) for a in told[name].combine_chunks()]))
            for name in ("anchors", "crowded")
        )
        ids, texts, _ = _slot_docs(docs)
        anchor, doc, start, size, whole = [], [], [], [], []
        single = []
        for k, (i, text) in enumerate(zip(ids, texts)):
            if i is None:
                continue
            value, first, last = sliding_anchors(text, LEAST, ANCHOR)
            own = np.flatnonzero(_among(value, shared))
            if not len(own):
                continue
            spans = Spans(BYTE_VALUES[text])
            many = _among(value[own], crowded)
            if many.any():
                a = first[own[many]]
                a = ragged(a, last[own[many]] - a + 1)
                single.append((spans.of(a, a + LEAST), np.full(len(a), k), a))
                own = own[~many]
            a, n = first[own], last[own] - first[own] + LEAST
            anchor.append(value[own])
            doc.append(np.full(len(own), k))
            start.append(a)
            size.append(n)
            whole.append(spans.of(a, a + n))
        if not anchor:
            return pa.Table.from_batches([_rows(FRAGMENTS, [])])
        anchor, doc, start, size, whole = map(np.concatenate, (anchor, doc, start, size, whole))
        of_doc = np.array([-1 if i is None else i for i in ids], np.int64)
        rows = []
        if single:
            window, where, at = map(np.concatenate, zip(*single))
            order, later = _followers(window, of_doc[where], at)
            window, where, at = (x[order] for x in (window, where, at))
            if later.any():
                d, s = where[later], at[later]
                rows.append((-1 - slot, slot, None, _packed(d), _packed(s), _packed(s + LEAST), None))
            window, where, at = (x[~later] for x in (window, where, at))
            # Sorted by their hash, and so by its highest bits.
            for bucket, a, b in _ranges(_bucket_of(window, bits)):
                rows.append(
                    (
                        bucket + (1 << bits), slot, _packed(of_doc[where[a:b]]), _packed(where[a:b]),
                        _packed(at[a:b]), None, _packed(window[a:b]),
                    )
                )
        # Equal fragments: those of the smallest id stand for all, the others are marked.
        order, later = _followers(whole, of_doc[doc], start)
        anchor, doc, start, size, whole = (x[order] for x in (anchor, doc, start, size, whole))
        if later.any():
            d, s, e = doc[later], start[later], start[later] + size[later]
            rows.append((-1 - slot, slot, None, _packed(d), _packed(s), _packed(e), None))
        keep = np.flatnonzero(~later)
        keep = keep[np.argsort(_anchor_bucket(anchor[keep], bits), kind="stable")]
        first_byte = np.cumsum([0, *map(len, texts)])
        data = np.concatenate(texts)
        for bucket, a, b in _ranges(_anchor_bucket(anchor[keep], bits)):
            own = keep[a:b]
            cut = data[ragged(first_byte[doc[own]] + start[own], size[own])]
            rows.append(
                (
                    bucket, slot, _packed(of_doc[doc[own]]), _packed(doc[own]), _packed(start[own]),
                    _packed(size[own]), _packed(cut),
                )
            )
        return pa.Table.from_batches([_rows(FRAGMENTS, rows)])

    return packed.groupBy("slot").cogroup(notices.groupBy("slot")).applyInArrow(run, FRAGMENTS)


def _followers(hashes: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash, owner and start, and what comes in it after an equal one of a smaller owner."""
    order = np.lexsort((start, owner, hashes))
    hashes, owner = hashes[order], owner[order]
    new = np.diff(hashes, prepend=hashes[:1] + np.uint64(1)) != 0
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return order, owner > owner[leader]


def _span_rows(fragments: DataFrame, bits: int) -> DataFrame:
    """Marked spans of the fragments of each bucket, by slot."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return group.select(["slot", "docs", "starts", "sizes"]).rename_columns(
                ["slot", "docs", "starts", "ends"]
            )
        if key[0].as_py() >= 1 << bits:
            return _window_spans(group)
        trim()
        fields = {n: [] for n in ("doc_ids", "docs", "starts", "sizes", "data")}
        for name, found in fields.items():
            kind = np.uint8 if name == "data" else np.int64
            found += [_array(v, kind) for v in group[name].combine_chunks()]
        slot = np.repeat(group["slot"].to_numpy(), [len(d) for d in fields["docs"]])
        owner, doc, start, size, data = (np.concatenate(v) for v in fields.values())
        offsets = np.concatenate([[0], np.cumsum(size)])
        whole = _hashes(data, offsets)
        # Each distinct fragment once, with its first owner, in the order of anchors.
        order = np.lexsort((owner, whole))
        new = np.diff(whole[order], prepend=whole[order[:1]] + np.uint64(1)) != 0
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        anchor, at = _anchors_of(data, offsets[order[new]])
        related = _related(data, offsets[order[new]], size[order[new]], at)
        by_anchor = np.argsort(anchor, kind="stable")
        lead, anchor = order[new][by_anchor], anchor[by_anchor]
        place = np.empty(len(lead), np.int64)
        place[by_anchor] = np.arange(len(lead))
        which = place[which]
        # Fragments of one anchor share an index; several anchors do up to a bounded size.
        among = np.flatnonzero(related[by_anchor])
        anchor = anchor[among]
        begin = np.flatnonzero(np.diff(anchor, prepend=anchor[:1] + np.uint64(1)) != 0)
        begin = np.append(begin, len(among))
        ends = np.concatenate([[0], np.cumsum(size[lead[among]])])
        spans = [_earlier(data, offsets, size, owner, lead[:0])]
        for a, b in chunks(np.diff(ends[begin]), INDEX_BYTES):
            own = among[begin[a] : begin[b]]
            piece, *bounds = _earlier(data, offsets, size, owner, lead[own])
            spans.append((own[piece], *bounds))
        piece, left, right = (np.concatenate(v) for v in zip(*spans))
        # The first owner of a fragment loses windows of smaller ids, all later ones every window.
        first = owner[lead][which]
        later, holders = np.flatnonzero(owner > first), np.flatnonzero(owner == first)
        per = np.bincount(piece, minlength=len(lead))
        times = per[which[holders]]
        row = ragged((np.cumsum(per) - per)[which[holders]], times)
        held = np.repeat(holders, times)
        docs = np.concatenate([doc[later], doc[held]])
        starts = np.concatenate([start[later], start[held] + left[row]])
        stops = np.concatenate([start[later] + size[later], start[held] + right[row]])
        return _by_slot(np.concatenate([slot[later], slot[held]]), docs, starts, stops)

    return fragments.groupBy("bucket").applyInArrow(run, SPANS)


def _by_slot(slot: np.ndarray, docs: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Table:
    """Spans as rows, one for each slot."""
    rows: list[tuple] = []
    order = np.lexsort((starts, docs, slot))
    for name, a, b in _ranges(slot[order]):
        own = order[a:b]
        rows.append((name, _packed(docs[own]), _packed(starts[own]), _packed(stops[own])))
    return pa.Table.from_batches([_rows(SPANS, rows)])


def _window_spans(group: pa.Table) -> pa.Table:
    """Windows of crowded anchors that a smaller id has, in a bucket of windows."""
    doc_ids, docs, starts, windows = (
        [_array(v, kind) for v in group[name].combine_chunks()]
        for name, kind in (("doc_ids", np.int64), ("docs", np.int64), ("starts", np.int64), ("data", np.uint64))
    )
    slot = np.repeat(group["slot"].to_numpy(), [len(d) for d in docs])
    owner, doc, start, window = map(np.concatenate, (doc_ids, docs, starts, windows))
    order, later = _followers(window, owner, start)
    own = order[later]
    return _by_slot(slot[own], doc[own], start[own], start[own] + LEAST)


def _hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each fragment."""
    out = [np.zeros(0, np.uint64)]
    for a, b in chunks(np.diff(offsets), PART_BYTES):
        own = offsets[a : b + 1] - offsets[a]
        out.append(Spans(BYTE_VALUES[data[offsets[a] : offsets[b]]]).of(own[:-1], own[1:]))
    return np.concatenate(out)


def _anchors_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of fragments and their places: those of their first window, which all windows share."""
    out, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(starts), PART_BYTES // LEAST):
        own = starts[at : at + PART_BYTES // LEAST]
        spans = Spans(BYTE_VALUES[data[ragged(own, np.full(len(own), LEAST))]])
        first = np.arange(len(own)) * LEAST
        hashes = np.stack([spans.of(first + k, first + k + ANCHOR) for k in range(LEAST - ANCHOR + 1)])
        place = _placed(hashes, np.arange(len(hashes))[:, None]).argmin(0)
        out.append(hashes[place, np.arange(len(own))])
        places.append(place)
    return np.concatenate(out), np.concatenate(places)


def _related(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether a fragment may share a window with another.

    Windows that have from ``low`` to ``high`` bytes before their anchor all hold the ``low`` bytes
    before it and the ``LEAST - ANCHOR - high`` bytes after it: that much must be in both.
    """
    out = np.zeros(len(starts), bool)
    for low in range(0, LEAST - ANCHOR + 1, AROUND):
        high = min(low + AROUND - 1, LEAST - ANCHOR)
        begin, wide = place - low, low + LEAST - high
        rows = np.flatnonzero((begin >= 0) & (begin + wide <= sizes))
        found = [np.zeros(0, np.uint64)]
        for k in range(0, len(rows), PART_BYTES // wide):
            own = (starts + begin)[rows[k : k + PART_BYTES // wide]]
            first = np.arange(len(own)) * wide
            spans = Spans(BYTE_VALUES[data[ragged(own, np.full(len(own), wide))]])
            found.append(spans.of(first, first + wide))
        hashes = np.concatenate(found)
        order = np.argsort(hashes)
        same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        out[rows[order[same]]] = out[rows[order[same + 1]]] = True
    return out


def _earlier(data, offsets, size, owner, lead) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that a smaller owner has: fragment (of ``lead``), first and last byte."""
    if not len(lead):
        none = np.zeros(0, np.int64)
        return none, none, none
    part = data[ragged(offsets[lead], size[lead])]
    cuts = np.concatenate([[0], np.cumsum(size[lead])])
    found = RunIndex(part, cuts, owner[lead], LEAST).first_owners(part, cuts)
    piece = np.repeat(np.arange(len(lead)), size[lead])
    hit = found < owner[lead][piece]
    same = piece[1:] == piece[:-1]
    begin, stop = hit.copy(), hit.copy()
    begin[1:] &= ~(hit[:-1] & same)
    stop[:-1] &= ~(hit[1:] & same)
    first, last = np.flatnonzero(begin), np.flatnonzero(stop)
    return piece[first], first - cuts[piece[first]], last - cuts[piece[last]] + LEAST


def _united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def _marked(packed: DataFrame, spans: DataFrame, as_text: bool) -> DataFrame:
    carried = [f for f in packed.schema if f.name.startswith("carry_")]

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, found: pa.Table) -> pa.Table:
        ids, texts, taken = _slot_docs(docs)
        parts = [
            np.concatenate([np.zeros(0, np.int64), *(_array(v, np.int64) for v in column.combine_chunks())])
            for column in (found["docs"], found["starts"], found["ends"])
        ]
        order = np.argsort(parts[0], kind="stable")
        doc, start, end = (p[order] for p in parts)
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        rows, kept = [], []
        for k, text in enumerate(texts):
            a, b = bounds[k], bounds[k + 1]
            s, e = _united(start[a:b], end[a:b])
            rows.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
            keep = np.ones(len(text), bool)
            for x, y in zip(s, e):
                keep[x:y] = False
            left = text[keep].tobytes()
            kept.append(left.decode("utf-8", "ignore") if as_text else left)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "spans": pa.array(rows, kind),
                "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
            }
            | {f.name: docs[f.name].take(pa.array(taken)) for f in carried}
        )

    kind = "kept string" if as_text else "kept binary"
    schema = ", ".join([MARKED, kind, *(f"{f.name} {f.dataType.simpleString()}" for f in carried)])
    return packed.groupBy("slot").cogroup(spans.groupBy("slot")).applyInArrow(run, schema)


def mark_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    as_text: bool = False,
) -> DataFrame:
    """Marked spans (in bytes) of every document, and the bytes that are left.

    Columns named in ``carry`` come along with their document. With ``as_text``
    what is left is a text, without characters of which only a part is left.
    """
    size = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    slots = max(1, -(-size // SLOT_BYTES))
    bits = max(0, (size // BYTES_PER_ANCHOR // BUCKET_ANCHORS).bit_length())
    packed = staged(packed_docs(docs, slots, id_col, text_col, carry), "packed")
    # One job: all three steps that need the texts share one exchange of them.
    notices = _notices(_anchor_rows(packed, bits))
    spans = _span_rows(_fragment_rows(packed, notices, bits), bits)
    marked = _marked(packed, spans, as_text)
    return marked.withColumnsRenamed({f"carry_{k}": c for k, c in enumerate(carry)})
