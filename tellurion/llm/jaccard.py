"""Near-duplicate classes by word n-gram Jaccard similarity (operator 8).

A document's set holds the hashes of its distinct ``width``-word shingles. The
exact join runs on a token-group matrix:

1. Documents with equal sets are one class, kept once.
2. Classes with an equal minimum hash, under several hash functions, are compared
   with the first of them by bitmaps of hashed tokens. Those that may overlap by
   ``GROUP_PERCENT`` are similar: each joins the first class that most others joined,
   linked to it or not. Such groups are cut into parts of about ``PART`` classes and
   bounded size; all other classes are parts of their own. Pairs that may be links
   are compared exactly, and linked classes are one component from here on.
3. The matrix holds, for each token, the parts that have it among the first
   ``n - ceil(t * n) + 1`` tokens of a member, in an order that puts frequent
   tokens last. Sets of similarity ``t`` share such a token, so no link is lost; at
   the first one they share, enough tokens must follow in both.
   Tokens seen in one class are dropped where they are counted.
4. A class is a query to its own part and to other parts that share a token with it, of
   each two parts one asks the other, unless all members with that token are of its component. So a family of
   similar documents costs a query for each class and part, whether its members are
   linked or stay just below the threshold. A part stores the union of its members'
   tokens as a bitmap. A cell that the query has and the union lacks is a token
   outside the union, so the cells bound the overlap from above. Queries bounded
   below ``ceil(t * n)`` are dismissed; only for the others the part is opened, and
   the query's tokens are looked up in those of all members at once. A block gives the
   links that join components, fewer than it has queries and members.
   Queries go in rounds: a class asks its own part and a drawn one first, then ``ROUND``
   times as many each time. Links of a round join components before the next one, which
   drops queries to parts that are whole of the query's component. So a linked family gives
   links in proportion to its classes, not one for each class and part.
5. Links are between components, which are named by the least document id; repeated
   minimum labels and pointer jumps give the components of the next round.

Queries of a part are dealt into blocks of bounded numbers and bounded tokens. Token
sets are computed from the texts where they are needed, once for each class, and are
never written.

The order of tokens is a matter of speed, not of results: it uses counts of the
``HOT`` most frequent tokens, a table of fixed size, and hashes for the rest.

Cases: null and empty texts, and texts of white space, have no shingle and link
with nothing. Fewer words than ``width`` make one shingle. Repeated rows are
copies. A document without an id gets its count and no class. An empty table
gives no row. Columns beside the id and text are not read. Equality of shingles
and of sets is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellurion.llm.common import binary, chunks, ragged, released, staged, utf8
from tellurion.llm.textops import BYTE_VALUES, Spans, mix, words_in

WIDTH, PERCENT = 5, 80
MINIMA = 4
#: Least overlap, by bitmaps, of a class with the first class of its group.
GROUP_PERCENT = 60
PART, BLOCK = 64, 256
#: Tokens of the members of a part, and of the queries of a block, about.
PART_TOKENS, BLOCK_TOKENS = 1 << 18, 1 << 19
#: Parts that a class asks in the first round, and by how much later rounds ask more.
FIRST_PARTS, ROUND = 2, 8
HOT = 300_000
#: Tokens counted at a time when frequent ones are looked for, and the least count.
COUNTED, LEAST_COUNT = 2_000_000, 2
#: Documents whose ids are broadcast to read their texts again; beyond it they are joined.
MOST_BROADCAST = 1_000_000
BATCH_BYTES = 1 << 20

#: Cells of a bitmap for each token of its set, at least.
CELLS = 4

DOCS = "doc_id long, n long, key long, minima array<long>, bits binary, token long, times long"
#: ``sizes`` holds the size of the set and, in the lower half, its tokens from this one on.
POSTED = "token long, key long, sizes long"
TOKENS = "key long, n long, tokens binary"
LINKED = "a long, b long"
ROLE_MEMBER, ROLE_QUERY = 0, 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_SEEDS = mix(np.arange(101, 101 + MINIMA, dtype=np.uint64))


def token_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = utf8(column)
    for a, b in chunks(np.diff(offsets), BATCH_BYTES):
        own, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = words_in(~_IS_SPACE[own], bounds)
        words = Spans(BYTE_VALUES[_LOWER[own]]).of(starts, ends)
        counts = np.diff(first)
        spans = Spans(words)
        at = np.arange(max(0, len(words) - width + 1))
        shingles = spans.of(at, at + width)
        for k, n in enumerate(counts):
            if n >= width:
                yield np.unique(shingles[first[k] : first[k] + n - width + 1])
            elif n:
                yield spans.of(first[k : k + 1], first[k : k + 1] + n)
            else:
                yield np.zeros(0, np.uint64)


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def bitmap(tokens: np.ndarray) -> bytes:
    """The set as bits of hashed tokens; the number of bits is a power of two."""
    size = 1 << max(6, int(CELLS * len(tokens) - 1).bit_length())
    cells = np.zeros(size, bool)
    cells[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(cells, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap with fewer cells, each the union of those that fall on it."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _least(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any similar set."""
    return -(-percent * n // 100)


def described(rows: DataFrame, width: int) -> DataFrame:
    """A row for each document and, marked by ``times``, rows of locally frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def frequent():
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= LEAST_COUNT
            n = int(often.sum())
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()),
                 pa.array(_signed(values[often])), pa.array(times[often])],
                ["doc_id", "n", "key", "minima", "bits", "token", "times"],
            )

        for batch in batches:
            n, keys, minima, bits = [], [], [], []
            for tokens in token_sets(batch.column(1), width):
                n.append(len(tokens))
                keys.append(set_key(tokens) if len(tokens) else None)
                low = [_signed(mix(tokens ^ s).min(keepdims=True))[0] for s in _SEEDS] if len(tokens) else []
                minima.append(low)
                bits.append(bitmap(tokens))
                if len(tokens) and keys[-1] not in seen:
                    seen.add(keys[-1])
                    held.append(tokens)
                    size += len(tokens)
                if size > COUNTED:
                    yield frequent()
                    held, size, seen = [], 0, set()
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(minima, pa.list_(pa.int64())), pa.array(bits, pa.binary()), none, none],
                ["doc_id", "n", "key", "minima", "bits", "token", "times"],
            )
        if held:
            yield frequent()

    return rows.mapInArrow(released(run), DOCS)


def _frequent(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens in ascending order, and their counts: ``HOT`` rows at most."""
    counted = found.where("times is not null").groupBy("token").agg(F.sum("times").alias("times"))
    counted = staged(counted, "frequent")
    # The least count that so few tokens reach: the driver sees a row for each count.
    least, rows = None, 0
    for level in sorted(counted.groupBy("times").count().collect(), reverse=True):
        rows += level["count"]
        if rows > HOT:
            break
        least = level["times"]
    top = counted.where(F.lit(False) if least is None else F.col("times") >= least).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["times"].to_numpy(np.int64)[order]


def posted(
    rows: DataFrame, hot: tuple[np.ndarray, np.ndarray], width: int, percent: int
) -> DataFrame:
    """The first tokens of every set in the common order; copies within a batch count once."""
    hot_tokens, hot_times = hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, parts, keys, sizes = set(), [], [], []
            for tokens in token_sets(batch.column(0), width):
                if not len(tokens) or (key := set_key(tokens)) in seen:
                    continue
                seen.add(key)
                times = np.zeros(len(tokens), np.int64)
                if len(hot_tokens):
                    at = np.minimum(np.searchsorted(hot_tokens, tokens), len(hot_tokens) - 1)
                    times = np.where(hot_tokens[at] == tokens, hot_times[at], 0)
                first = np.argsort(times, kind="stable")[: len(tokens) - _least(len(tokens), percent) + 1]
                parts.append(tokens[first])
                keys.append(key)
                sizes.append(len(tokens))
            if parts:
                times = [len(p) for p in parts]
                place = np.concatenate([np.arange(t) for t in times])
                n = np.repeat(np.array(sizes, np.int64), times)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(np.concatenate(parts))),
                        pa.array(np.repeat(np.array(keys, np.int64), times)),
                        pa.array(n << 32 | n - place),
                    ],
                    ["token", "key", "sizes"],
                )

    return rows.select("text").mapInArrow(released(run), POSTED)


def _shared(postings: DataFrame) -> DataFrame:
    """Postings of tokens that several classes have; rows come sorted by token and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row is held back: whether it is shared depends on the row after it.
        held = np.zeros((0, 3), np.int64)
        held_shared = False
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            rows = np.concatenate([held, rows])
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            rows = rows[new]
            same = rows[1:, 0] == rows[:-1, 0]
            shared = np.zeros(len(rows), bool)
            if len(rows):
                shared[0] = held_shared and len(held) > 0
            shared[1:] |= same
            shared[:-1] |= same
            if len(rows):
                held, held_shared = rows[-1:], bool(shared[-1])
                yield _rows(rows[:-1][shared[:-1]])
        if held_shared:
            yield _rows(held)

    def _rows(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], ["token", "key", "sizes"]
        )

    ordered = postings.repartition("token").sortWithinPartitions("token", "key")
    return ordered.mapInArrow(run, POSTED)


def _token_rows(rows: DataFrame, classes: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """Token sets of the given classes, from the text of one document of each."""
    ids = classes.join(keys, "key").select(F.col("first_id").alias("doc_id"), "key")
    if ids.count() <= MOST_BROADCAST:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = batch.column(1).to_pylist(), []
            kept, n, seen = [], [], set()
            for key, tokens in zip(keys, token_sets(batch.column(0), width)):
                # Of several texts with one document id, that of the class is meant.
                if len(tokens) and key not in seen and set_key(tokens) == key:
                    seen.add(key)
                    kept.append(key)
                    n.append(len(tokens))
                    sets.append(tokens)
            if kept:
                flat = np.concatenate(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kept, pa.int64()),
                        pa.array(n, pa.int64()),
                        binary(flat.view(np.uint8), np.concatenate([[0], 8 * np.cumsum(n)])),
                    ],
                    ["key", "n", "tokens"],
                )

    wanted = rows.join(ids, "doc_id").select("text", "key")
    # Rows that repeat an id and its text would give the set again.
    return wanted.mapInArrow(released(run), TOKENS).dropDuplicates(["key"])


def _dealt(members: DataFrame, queries: DataFrame) -> DataFrame:
    """Members and queries of parts, the queries in blocks, the members in each block."""
    number = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS))
    blocks = queries.groupBy("part").agg(number.alias("blocks"))
    asked = queries.join(blocks, "part").select(
        "part",
        "key",
        "label",
        F.pmod(F.xxhash64("key", "part"), "blocks").alias("block"),
        F.lit(ROLE_QUERY).alias("role"),
    )
    held = members.join(blocks, "part").select(
        "part",
        "key",
        "label",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(ROLE_MEMBER).alias("role"),
    )
    return asked.unionByName(held)


def _qualifying(members: DataFrame, queries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Queries whose bound against the union of a part does not dismiss them.

    ``bound`` is the number of tokens that the query and the union may share.
    """

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        roles = group["role"].to_numpy()
        bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in group["bits"].combine_chunks()]
        inside, asked = np.flatnonzero(roles == ROLE_MEMBER), np.flatnonzero(roles == ROLE_QUERY)
        kept, bounds = [], []
        if len(inside):
            size = min(len(bits[k]) for k in inside)
            union = np.bitwise_or.reduce([folded(bits[k], size) for k in inside], axis=0)
            n = group["n"].to_numpy()
            for k in asked:
                least = min(size, len(bits[k]))
                outside = folded(bits[k], least) & ~folded(union, least)
                bound = int(n[k]) - int(np.bitwise_count(outside).sum())
                if bound >= _least(int(n[k]), percent):
                    kept.append(int(k))
                    bounds.append(bound)
        found = group.select(["part", "key", "label", "n"]).take(pa.array(kept, pa.int64()))
        return found.append_column("bound", pa.array(bounds, pa.int64()))

    rows = _dealt(members, queries).join(classes.select("key", "n", "bits"), "key")
    kind = queries.schema["part"].dataType.simpleString()
    return rows.groupBy("part", "block").applyInArrow(
        run, f"part {kind}, key bigint, label bigint, n bigint, bound bigint"
    )


def _opened(members: DataFrame, queries: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links between components of queries and of members of parts.

    Links that the earlier ones of a block imply are left out: there are fewer links
    than queries and members, however many of them are similar.
    """

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        roles, keys, labels = (group[c].to_numpy() for c in ("role", "key", "label"))
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in group["tokens"].combine_chunks()]
        inside = np.flatnonzero(roles == ROLE_MEMBER)
        found: list[tuple[int, int]] = []
        if len(inside):
            sizes = np.array([len(sets[k]) for k in inside])
            held = np.concatenate([sets[k] for k in inside])
            order = np.argsort(held, kind="stable")
            held, owner = held[order], np.repeat(np.arange(len(inside)), sizes)[order]
            own = set(keys[inside].tolist())
            above = dict.fromkeys(labels.tolist())

            def top(label: int) -> int:
                while above[label] is not None:
                    label = above[label]
                return label

            for q in np.flatnonzero(roles == ROLE_QUERY):
                at = np.searchsorted(held, sets[q])
                count = np.searchsorted(held, sets[q], "right") - at
                both = np.bincount(owner[ragged(at, count)], minlength=len(inside))
                similar = 100 * both >= percent * (len(sets[q]) + sizes - both)
                similar &= (labels[inside] != labels[q]) & (both > 0)
                if keys[q] in own:  # within a part each pair is met from both sides
                    similar &= keys[inside] < keys[q]
                for label in np.unique(labels[inside[similar]]).tolist():
                    mine, other = top(int(labels[q])), top(label)
                    if mine != other:
                        above[mine] = other
                        found.append((int(labels[q]), label))
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
        return pa.table(columns, ["a", "b"])

    rows = _dealt(members, queries).join(tokens, "key")
    return rows.groupBy("part", "block").applyInArrow(run, LINKED)


def components(edges: DataFrame) -> DataFrame:
    """The least vertex reachable from each vertex of the edges ``a``, ``b``.

    Each step takes the least label among neighbours and then the label of that
    label, and is written to the shared folder, so a step is never computed twice.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.where("a <> b").distinct(), "links")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = staged(labels.select(F.col("a").alias("v"), "label"), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("v"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, F.col("v") == F.col("a")).select(
            "v", F.col("label").alias("old"), F.least("label", "near").alias("mid")
        )
        heads = labels.select(F.col("v").alias("head"), F.col("label").alias("jump"))
        moved = lower.join(heads, F.col("mid") == F.col("head"), "left").select(
            "v", "old", F.least("mid", F.coalesce("jump", "mid")).alias("label")
        )
        moved = staged(moved, "labels")
        labels = moved.drop("old")
        if not moved.where("label <> old").head(1):
            return labels


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the new label of their label, where it has one."""
    new = labels.select(F.col("v").alias("label"), F.col("label").alias("least"))
    return rows.join(new, "label", "left").withColumn("label", F.coalesce("least", "label")).drop("least")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """Set size and class of every document: its least document id reachable by links."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = staged(described(rows, width), "shingled")
    described_docs = found.where("times is null").drop("token", "times")
    classes = staged(
        described_docs.where("key is not null and doc_id is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("first_id"), *(F.first(c).alias(c) for c in ("n", "minima", "bits"))),
        "classes",
    )

    # Groups: classes that are similar to the first class with an equal minimum hash.
    cells = classes.select("key", "n", "first_id", F.posexplode("minima").alias("which", "minimum"))
    first = cells.groupBy("which", "minimum").agg(
        F.min("key").alias("head"), F.min_by("n", "key").alias("head_n"), F.count(F.lit(1)).alias("rows")
    )
    loose = min(percent, GROUP_PERCENT)
    near = 100 * F.least("n", "head_n") >= loose * F.greatest("n", "head_n")
    pairs = cells.join(first.where("rows > 1"), ["which", "minimum"]).where(near & (F.col("key") != F.col("head")))
    own = F.col("first_id").alias("label")
    pairs = staged(pairs.select(F.col("head").alias("part"), "key", own, "n").distinct(), "pairs")

    def first_classes(of: DataFrame) -> DataFrame:
        heads = of.select("part").distinct()
        return heads.join(classes, F.col("part") == F.col("key")).select("part", "key", own)

    pairs = staged(_qualifying(first_classes(pairs), pairs, classes, loose), "pairs-left")

    # Links to those first classes, and the components that they give.
    likely = pairs.where(100 * F.col("bound") >= percent * F.col("n"))
    heads = first_classes(likely)
    keys = likely.select("key").unionByName(heads.select("key")).distinct()
    links = staged(
        _opened(heads, likely, _token_rows(rows, classes, keys, width), percent), "group-links"
    )

    # Each class joins the first class that most others joined; parts have bounded size.
    joined = pairs.groupBy("part").agg(F.count(F.lit(1)).alias("followers"))
    chosen = pairs.join(joined, "part").groupBy("key").agg(
        F.max_by("part", F.struct("followers", "part")).alias("group")
    )
    alone = joined.select(F.col("part").alias("key"), F.col("part").alias("group")).join(chosen, "key", "left_anti")
    groups = chosen.unionByName(alone).join(classes.select("key", "n"), "key")
    slots = groups.groupBy("group").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / PART), F.ceil(F.sum("n") / PART_TOKENS)).alias("slots")
    )
    slot = F.pmod(F.xxhash64("key"), "slots").alias("slot")
    groups = groups.join(slots, "group").select("key", "group", slot)
    parts = _relabelled(classes.select("key", own), components(links)).join(groups, "key", "left").select(
        "key",
        F.struct(
            F.coalesce("group", "key").alias("group"), F.coalesce("slot", F.lit(0).cast("long")).alias("slot")
        ).alias("part"),
        "label",
    )
    parts = staged(parts, "parts")

    # The matrix, and the queries to parts.
    shared = staged(_shared(posted(rows, _frequent(found), width, percent)), "matrix")
    placed = shared.join(parts, "key").select(
        "token",
        "key",
        F.shiftright("sizes", 32).alias("n"),
        F.col("sizes").bitwiseAND(0xFFFFFFFF).alias("rest"),
        "part",
        "label",
    )
    placed = staged(placed, "placed")
    matrix = placed.groupBy("token", F.col("part").alias("to")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("part_rest"),
        F.min("label").alias("least_label"), F.max("label").alias("most_label"),
    )
    # At the first token that two sets share, what follows must make up the overlap that their
    # sizes need. Similar sets pass there; at later tokens they share they may fail.
    least = F.greatest(100 * F.col("low"), percent * F.col("n"))
    needed = percent * (100 * F.col("n") + least)
    enough = 100 * (100 + percent) * F.least("rest", "part_rest") >= needed
    fits = (100 * F.col("low") <= F.col("n") * F.lit(10_000) / percent) & (
        100 * F.col("high") >= percent * F.col("n")
    )
    settled = (F.col("least_label") == F.col("label")) & (F.col("most_label") == F.col("label"))
    # Which of two parts asks is drawn, so that no part is asked by all others of its family.
    drawn = F.xxhash64(F.least("to", "part"), F.greatest("to", "part")) % 2 == 0
    asks = (F.col("to") == F.col("part")) | ((F.col("to") < F.col("part")) == drawn)
    asked = (
        placed.join(matrix, "token")
        .where(asks & ~settled & fits & enough)
        .select(F.col("to").alias("part"), "key", "n", (F.col("to") == F.col("part")).alias("own"))
        .distinct()
    )
    drawn = Window.partitionBy("key").orderBy(F.desc("own"), F.xxhash64("key", "part"), "part")
    asked = staged(asked.select("part", "key", "n", F.row_number().over(drawn).alias("place")), "queries")

    # Rounds of queries; a part that is whole of the query's component has no link to give.
    last, most = 0, FIRST_PARTS
    longest = asked.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0]
    while last < longest:
        turn = asked.where((F.col("place") > last) & (F.col("place") <= most))
        ends = parts.groupBy("part").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        whole = (F.col("low") == F.col("label")) & (F.col("high") == F.col("label"))
        turn = turn.join(parts.select("key", "label"), "key").join(ends, "part").where(~whole)
        turn = staged(turn.select("part", "key", "label", "n"), "asked")
        members = staged(parts.join(turn.select("part").distinct(), "part", "left_semi"), "members")
        turn = staged(_qualifying(members, turn, classes, percent), "queries-left")
        members = members.join(turn.select("part").distinct(), "part", "left_semi")
        keys = turn.select("key").unionByName(members.select("key")).distinct()
        links = staged(_opened(members, turn, _token_rows(rows, classes, keys, width), percent), "links")
        if links.head(1):
            parts = staged(_relabelled(parts, components(links)), "parts")
        last, most = most, ROUND * most

    named = parts.select("key", F.col("label").alias("component"))
    own = F.when(F.col("key").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    return described_docs.select("doc_id", "n", "key").join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )
