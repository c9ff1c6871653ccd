"""Running values over long ordered groups, as a prefix scan over blocks.

A window over a whole group sends that group to one task. Here the order column
is cut at measured quantiles, so that no block holds more than about a given
number of rows, whatever the unit of that column. Rows are dealt once by group
and block. Each block gives one summary; summaries are combined along the blocks
of a group and come back to the rows as a carry. Both the summaries and the rows
read the same exchange, so the input is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK, CARRY = "_block", "_carry"
# Group and block of a row in one column, and the group alone.
PLACE, GROUP = "_place", "_group"
# Rows that one task may have to order.
BLOCK_ROWS = 1 << 23
# Counts of groups are taken for so many hashes of their keys.
GROUP_BUCKETS = 1 << 16
_DIGEST, _SPLIT = "_digest", "_split"


def cuts(rows: DataFrame, order: str, block_rows: int = BLOCK_ROWS) -> list:
    """Values of ``order`` that cut all rows into blocks of about ``block_rows``.

    Reads only that column; where it is a column of the stored table, measure
    it there rather than on rows that are expensive to derive. Tables of at
    most ``block_rows`` rows have no cut.
    """
    n = rows.count()
    parts = -(-n // block_rows)
    if parts < 2:
        return []
    shares = F.array(*(F.lit(k / parts) for k in range(1, parts)))
    found = rows.agg(F.percentile_approx(order, shares, max(10_000, 20 * parts)).alias("at"))
    return sorted(set(found.head()["at"] or []))


def in_long_groups(rows: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> Column | None:
    """Whether a row may be of a group of more than ``block_rows`` rows; None if no group is that long.

    Rows are counted by a hash of their group, so that the counts stay few; no shorter
    count hides a long group.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(GROUP_BUCKETS))
    counts = rows.groupBy(bucket.alias("bucket")).count()
    found = [r["bucket"] for r in counts.where(F.col("count") > block_rows).select("bucket").collect()]
    return bucket.isin(found) if found else None


def _values(at: Sequence) -> Column:
    """The values as one constant; many whole numbers travel as one text."""
    if len(at) > 64 and all(type(v) is int for v in at):
        return F.split(F.lit(",".join(map(str, at))), ",").cast("array<bigint>")
    return F.array(*(F.lit(v) for v in at))


def block_of(value: Column, at: Sequence) -> Column:
    """The block of a value: how many cuts are not above it, found by halving."""
    steps = [1 << k for k in reversed(range(len(at).bit_length()))]
    cuts_at = _values(at)

    def reached(below: Column, step: Column) -> Column:
        # Beyond the last cut there is none: NULL, as for a NULL value, keeps what is reached.
        return F.when(F.get(cuts_at, below + step - 1) <= value, below + step).otherwise(below)

    return F.aggregate(F.array(*(F.lit(s) for s in steps)), F.lit(0), reached).cast("bigint")


def scanned(
    rows: DataFrame,
    keys: Sequence[str],
    block: Column,
    summary: dict[str, Column],
    combined: Callable[[DataFrame], DataFrame],
    within: Callable[[DataFrame, Window], DataFrame],
    split: Column | None = None,
) -> DataFrame:
    """Rows of every block with what earlier blocks of their group carry in.

    ``within`` adds columns by windows over the rows of a block, given the
    partition of a block; ``summary`` aggregates its result; ``combined`` turns
    the summaries, with ``GROUP`` and ``BLOCK``, into the carried columns. The
    rows come back with both. NULL keys are a group like any other. Groups without
    ``split`` lie in one block each: their summaries go nowhere.
    """
    # A structure is never NULL: joins on it filter neither side.
    place = F.struct(F.struct(*keys).alias("group"), block.alias("block"))
    tagged = rows.withColumn(PLACE, place)
    dealt = within(tagged.repartition(PLACE), Window.partitionBy(PLACE))
    # The digest makes summaries depend on all columns. Otherwise they would be read from a
    # narrower exchange of their own, and the input twice.
    digest = F.max(F.xxhash64(*(_touched(f) for f in tagged.schema))).alias(_DIGEST)
    # Seen after the exchange, not before it: a filter on the rows would not read the same exchange.
    cut = F.max(F.lit(True) if split is None else split).alias(_SPLIT)
    summaries = dealt.groupBy(PLACE).agg(*(v.alias(k) for k, v in summary.items()), digest, cut)
    summaries = (summaries if split is None else summaries.where(_SPLIT)).drop(_SPLIT)
    placed = summaries.withColumns({GROUP: F.col(f"{PLACE}.group"), BLOCK: F.col(f"{PLACE}.block")})
    carried = combined(placed)
    names = [c for c in carried.columns if c not in placed.columns]
    kept = carried.where(F.col(_DIGEST) >= F.lit(-(1 << 63))).select(PLACE, *names)
    return dealt.join(kept, PLACE, "left").drop(PLACE)


def _touched(field: T.StructField) -> Column:
    """A cheap value that depends on a column and can be hashed."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.octet_length(column)
    if isinstance(field.dataType, T.MapType | T.ArrayType):
        return F.size(column)
    if isinstance(field.dataType, T.VariantType):
        return F.is_variant_null(column)
    return column


def with_running_max(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    block: Column | None,
    name: str,
    inclusive: bool = False,
    split: Column | None = None,
) -> DataFrame:
    """Add the greatest ``value`` among the earlier rows of each group.

    ``block`` must not decrease along ``order`` within a group, and equal values
    of the first order column must share a block; without it a group is ordered
    as a whole. With ``inclusive`` the row itself counts too. Groups without
    ``split`` must lie in one block each.
    """
    last = 0 if inclusive else -1
    unbounded = Window.unboundedPreceding

    def within(own: DataFrame, part: Window) -> DataFrame:
        return own.withColumn(name, F.max(value).over(part.orderBy(*order).rowsBetween(unbounded, last)))

    if block is None:
        return within(rows, Window.partitionBy(*keys))

    def combined(summaries: DataFrame) -> DataFrame:
        earlier = Window.partitionBy(GROUP).orderBy(BLOCK).rowsBetween(unbounded, -1)
        return summaries.withColumn(CARRY, F.max("_block_max").over(earlier))

    found = scanned(rows, keys, block, {"_block_max": F.max(value)}, combined, within, split)
    return found.withColumn(name, F.greatest(name, CARRY)).drop(CARRY)


def lookback(
    rows: DataFrame, keys: Sequence[str], position: str, span: int, blocks_per_span: int = 24
) -> tuple[DataFrame, list[str], Column]:
    """Copy rows so that every block holds all rows within ``span`` before it.

    ``position`` is a number. Returns the rows, the keys that partition them and
    a condition that keeps each row once, in its own block. A block is
    ``blocks_per_span`` look-backs long, so few rows are copied.
    """
    width = span * blocks_per_span
    at = F.col(position)

    def block_of(value: Column) -> Column:
        return F.floor(value / F.lit(width)).cast("bigint")

    spread = rows.withColumn("_home", block_of(at)).withColumn(
        BLOCK, F.explode(F.sequence(F.col("_home"), block_of(at + span)))
    )
    return spread, [*keys, BLOCK], F.col(BLOCK) == F.col("_home")
