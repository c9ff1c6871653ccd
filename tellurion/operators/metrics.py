"""Queries over metric samples ``(metric, labels MAP, ts TIMESTAMP, value DOUBLE)``.

Selection and aggregation of samples, changes and rates over a look-back,
alert states. A series is a metric with one set of labels; within a series
sample times are distinct.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellurion.operators import blocks

SECOND = 1_000_000
MINUTE = 60 * SECOND
# How long a sample stays visible, and the look-backs of the shipped queries.
STALE_AFTER = 5 * MINUTE
CHANGES_SPAN = 10 * MINUTE
RATE_SPAN = 5 * MINUTE
FLAPPING_ABOVE = 4
TARGET_DOWN_FOR = 2 * MINUTE
FLAPPING_FOR = 5 * MINUTE

SERIES = ("metric", "series")


def with_series(samples: DataFrame) -> DataFrame:
    """Add ``us``, the sample time in microseconds, and ``series``, the labels as text."""
    entries = F.array_sort(F.map_entries("labels"))
    return samples.withColumns(
        {
            "us": F.unix_micros(F.col("ts").cast("timestamp")),
            "series": F.to_json(F.map_from_entries(entries)),
        }
    )


def label(name: str) -> Column:
    """Value of a label, empty when the series does not have it."""
    return F.coalesce(F.try_element_at(F.col("labels"), F.lit(name)), F.lit(""))


def selected(
    samples: DataFrame,
    metric: str | None = None,
    metric_pattern: str | None = None,
    equals: Mapping[str, str] | None = None,
    differs: Mapping[str, str] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Samples of a metric whose labels match; patterns match whole values."""
    condition = F.lit(True)
    if metric is not None:
        condition = condition & (F.col("metric") == metric)
    if metric_pattern is not None:
        condition = condition & F.col("metric").rlike(f"^(?:{metric_pattern})$")
    for name, wanted in (equals or {}).items():
        condition = condition & (label(name) == wanted)
    for name, unwanted in (differs or {}).items():
        condition = condition & (label(name) != unwanted)
    for name, pattern in (patterns or {}).items():
        condition = condition & label(name).rlike(f"^(?:{pattern})$")
    return samples.filter(condition)


def instant(samples: DataFrame, at: int, stale_after: int = STALE_AFTER) -> DataFrame:
    """Newest sample of each series in ``(at - stale_after, at]``.

    Result columns: ``metric, series, labels, us, value`` with ``us`` set to ``at``.
    """
    at_time = F.timestamp_micros(F.lit(at))
    from_time = F.timestamp_micros(F.lit(at - stale_after))
    recent = samples.filter((F.col("ts") > from_time) & (F.col("ts") <= at_time))
    return (
        with_series(recent)
        .groupBy(*SERIES)
        .agg(F.first("labels").alias("labels"), F.max_by("value", "us").alias("value"))
        .withColumn("us", F.lit(at))
    )


def at_steps(samples: DataFrame, step: int, stale_after: int = STALE_AFTER) -> DataFrame:
    """The instant query at every multiple of ``step`` at which a series is visible.

    Only the newest sample between two steps can be visible, so the samples are
    reduced to one per series and step before they are spread over the steps.
    """
    us = F.col("us")
    first = (F.floor((us + (step - 1)) / F.lit(step)) * step).cast("bigint")
    last = (F.floor((F.col("seen") + (stale_after - 1)) / F.lit(step)) * step).cast("bigint")
    newest = (
        with_series(samples)
        .groupBy(*SERIES, first.alias("first"))
        .agg(
            F.first("labels").alias("labels"),
            F.max_by("value", "us").alias("value"),
            F.max("us").alias("seen"),
        )
        .withColumn("last", last)
        .filter(F.col("first") <= F.col("last"))
    )
    spread = newest.withColumn("us", F.explode(F.sequence("first", "last", F.lit(step).cast("bigint"))))
    return spread.groupBy(*SERIES, "us").agg(
        F.first("labels").alias("labels"), F.max_by("value", "seen").alias("value")
    )


def aggregated(vector: DataFrame, function: str, by: Iterable[str] = ()) -> DataFrame:
    """Sum, count or max of a vector per time and labels; no input gives no row."""
    functions = {"sum": F.sum("value"), "count": F.count("value"), "max": F.max("value")}
    names = list(by)
    return vector.groupBy("us", *[label(n).alias(n) for n in names]).agg(
        functions[function].alias("value")
    )


def last_non_null(
    samples: DataFrame, until: int | None = None, over: int = 6 * 60 * MINUTE
) -> DataFrame:
    """Last value that is not null per series within the time shown."""
    if until is not None:
        samples = samples.filter(
            (F.col("ts") > F.timestamp_micros(F.lit(until - over)))
            & (F.col("ts") <= F.timestamp_micros(F.lit(until)))
        )
    return (
        with_series(samples.filter(F.col("value").isNotNull()))
        .groupBy(*SERIES)
        .agg(
            F.first("labels").alias("labels"),
            F.max_by("value", "us").alias("value"),
            F.max("us").alias("us"),
        )
    )


def _over_lookback(samples: DataFrame, span: int) -> tuple[DataFrame, list[str], Column]:
    return blocks.lookback(with_series(samples), SERIES, "us", span)


def _counted(samples: DataFrame, span: int, amount: Column) -> DataFrame:
    """What the samples in ``(us - span, us]`` add up to, at every sample.

    ``amount``, which may use ``_before``, the previous value, is counted at each
    sample but the first of the look-back. Adds ``_amount``, ``_first_us`` and
    ``_first_value`` of that first sample and the number of samples ``_n``.

    No sample visits its look-back. Time is cut into parts of one ``span``, so a
    look-back is the end of one part and the start of the next: each sample knows
    the sum from the start of its part to itself and from itself to the end. The
    first sample of a look-back is the one after the newest that has left it; a
    sample leaves ``span`` after its time, when a mark of it joins the order and
    carries its successor. Nothing is subtracted but the first amount, so values
    outside a look-back, infinite ones too, do not reach it.
    """
    spread, keys, own = _over_lookback(samples, span)
    spread = spread.withColumns({"_own": own, "_part": F.floor(F.col("us") / F.lit(span)).cast("bigint")})
    part = Window.partitionBy(*keys, "_part")
    # The part grows with the time: one order serves the block and its parts.
    ordered = Window.partitionBy(*keys).orderBy("_part", "us")
    up_to = part.orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    onward = part.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        spread.withColumns({"_before": F.lag("value").over(ordered), "_at": F.row_number().over(ordered)})
        .withColumn("_one", amount)
        .withColumns({"_sum": F.sum("_one").over(up_to), "_count": F.count("us").over(up_to)})
        .withColumns({"_rest": F.sum("_one").over(onward), "_left": F.count("us").over(onward)})
    )
    start = F.struct(
        F.col("us").alias("us"), F.col("value").alias("value"), F.col("_one").alias("one"),
        F.col("_part").alias("part"), F.col("_rest").alias("rest"), F.col("_left").alias("left"),
    )
    # Samples of equal times keep the places they were given.
    placed = Window.partitionBy(*keys).orderBy("_at")
    linked = summed.withColumn("_start", start).withColumns(
        {"_next": F.lead("_start").over(placed), "_opening": F.first("_start").over(placed)}
    ).drop("_before", "_rest", "_left")
    # A mark stands before the samples of its time and carries only its successor.
    carried = {"_own", "_sum", "_count", "_part", *samples.columns, "us", "_opening"} - {*keys}
    shown = [F.when(F.col("_kind") == 1, F.col(c)).alias(c) for c in linked.columns if c in carried]
    timed = linked.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1)))).where("_kind = 1 OR _next IS NOT NULL")
    marks = timed.select(
        *keys, "_at", "_kind", *shown,
        (F.col("us") + F.when(F.col("_kind") == 0, F.lit(span)).otherwise(F.lit(0))).alias("_pos"),
        F.when(F.col("_kind") == 0, F.col("_next")).alias("_next"),
    )
    newest = Window.partitionBy(*keys).orderBy("_pos", "_kind", "_at").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        marks.withColumn("_from", F.last("_next", ignorenulls=True).over(newest))
        .where("_own")
        .withColumn("_from", F.coalesce("_from", "_opening"))
    )
    before = F.col("_from.part") < F.col("_part")
    total = F.coalesce("_sum", F.lit(0)) + F.when(before, F.coalesce("_from.rest", F.lit(0))).otherwise(F.lit(0))
    return found.withColumns(
        {
            "_amount": total - F.col("_from.one"),
            "_n": F.col("_count") + F.when(before, F.col("_from.left")).otherwise(F.lit(0)),
            "_first_us": F.col("_from.us"),
            "_first_value": F.col("_from.value"),
        }
    )


def changes(samples: DataFrame, span: int = CHANGES_SPAN) -> DataFrame:
    """Number of value changes in ``(us - span, us]`` at every sample.

    The first sample of the look-back is compared with nothing.
    """
    before = F.col("_before")
    changed = F.when(before.isNotNull() & (F.col("value") != before), 1).otherwise(0)
    counted = _counted(samples, span, changed).withColumnRenamed("_amount", "n_changes")
    return counted.select(*samples.columns, *SERIES[1:], "us", "n_changes")


def _growth() -> Column:
    """Increase since the previous sample; a value below it is a reset."""
    before = F.col("_before")
    return (
        F.when(before.isNull(), 0.0)
        .when(F.col("value") < before, F.col("value"))
        .otherwise(F.col("value") - before)
    )


def rates(samples: DataFrame, span: int = RATE_SPAN, extrapolate: bool = False) -> DataFrame:
    """Increase per second of a counter over ``(us - span, us]`` at every sample.

    A value below its predecessor is a reset and counts from zero. Without
    ``extrapolate`` the increase is divided by the time between the first and
    the last sample of the look-back. With it the increase is first extended
    towards the edges of the look-back: by the distance to the edge if that is
    within 1.1 mean sample distances, else by half a mean distance, and never
    below a counter of zero. One sample gives no rate.
    """
    framed = _counted(samples, span, _growth()).filter(F.col("_n") > 1)
    seconds = (F.col("us") - F.col("_first_us")) / SECOND
    rate = F.col("_amount") / seconds
    if extrapolate:
        mean_gap = seconds / (F.col("_n") - 1)
        to_edge = (F.col("_first_us") - (F.col("us") - span)) / SECOND
        within = F.when(to_edge < mean_gap * 1.1, to_edge).otherwise(mean_gap / 2)
        to_zero = F.when(
            (F.col("_amount") > 0) & (F.col("_first_value") >= 0),
            seconds * F.col("_first_value") / F.col("_amount"),
        )
        # The last sample of the look-back is where it ends.
        rate = rate * (seconds + F.least(within, to_zero)) / (span / SECOND)
    return framed.withColumn("rate", rate).select(*samples.columns, *SERIES[1:], "us", "rate")


def _ranges(samples: DataFrame, span: int, step: int, at: int | None, amount: Column) -> DataFrame:
    """What the samples in ``(t - span, t]`` add up to, per series and evaluation time.

    ``amount`` is counted at each sample but the first of a range. Times are the
    multiples of ``step``, or ``at`` alone. Every sample is copied to the times
    whose range it is in and added up there, partly before the shuffle.
    """
    spread, keys, own = _over_lookback(samples, span)
    ordered = Window.partitionBy(*keys).orderBy("us")
    us = F.col("us")
    grown = spread.withColumn("_before", F.lag("value").over(ordered)).withColumn("_grown", amount)
    first = (F.floor((us + (step - 1)) / F.lit(step)) * step).cast("bigint")
    last = (F.floor((us + (span - 1)) / F.lit(step)) * step).cast("bigint")
    times = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))
    if at is not None:
        times = F.when((us <= at) & (us > at - span), F.array(F.lit(at).cast("bigint")))
    ranged = grown.filter(own).withColumn("t", F.explode(times))
    return (
        ranged.groupBy(*SERIES, "t")
        .agg(
            F.first("labels").alias("labels"),
            F.sum("_grown").alias("_sum"),
            F.min_by(F.struct("_grown", "value"), "us").alias("_first"),
            F.min("us").alias("_first_us"),
            F.max("us").alias("_last_us"),
            F.count("us").alias("_n"),
        )
        .withColumn("_amount", F.col("_sum") - F.col("_first._grown"))
        .withColumnRenamed("t", "us")
    )


def changes_at_steps(
    samples: DataFrame, step: int, span: int = CHANGES_SPAN, at: int | None = None
) -> DataFrame:
    """Number of value changes in ``(t - span, t]`` at every evaluation time ``t``."""
    before = F.col("_before")
    changed = F.when(before.isNotNull() & (F.col("value") != before), 1.0).otherwise(0.0)
    ranged = _ranges(samples, span, step, at, changed)
    return ranged.select(*SERIES, "us", "labels", F.col("_amount").alias("value"))


def rates_at_steps(
    samples: DataFrame, step: int, span: int = RATE_SPAN, extrapolate: bool = False,
    at: int | None = None,
) -> DataFrame:
    """Increase per second of a counter over ``(t - span, t]`` at every evaluation time ``t``.

    As :func:`rates`, with the time as the end of the range. Ranges with one
    sample have no rate.
    """
    ranged = _ranges(samples, span, step, at, _growth()).filter("_n > 1")
    seconds = (F.col("_last_us") - F.col("_first_us")) / SECOND
    rate = F.col("_amount") / seconds
    if extrapolate:
        gap = seconds / (F.col("_n") - 1)

        def towards(distance: Column) -> Column:
            return F.when(distance < gap * 1.1, distance).otherwise(gap / 2)

        to_zero = F.when(
            (F.col("_amount") > 0) & (F.col("_first.value") >= 0),
            seconds * F.col("_first.value") / F.col("_amount"),
        )
        before_first = towards((F.col("_first_us") - (F.col("us") - span)) / SECOND)
        after_last = towards((F.col("us") - F.col("_last_us")) / SECOND)
        rate = rate * (seconds + F.least(before_first, to_zero) + after_last) / (span / SECOND)
    return ranged.select(*SERIES, "us", "labels", rate.alias("value"))


def flapping(samples: DataFrame, span: int = CHANGES_SPAN, above: int = FLAPPING_ABOVE) -> DataFrame:
    """Samples at which a series has changed more than ``above`` times in the look-back."""
    return changes(samples, span).filter(F.col("n_changes") > above)


def alert_states(
    samples: DataFrame, condition: Column, hold: int, alert: str, block: int | None = None,
    stale_after: int = STALE_AFTER, block_rows: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """State of an alert at every sample where its condition holds.

    ``firing`` once the condition has held at every sample for at least
    ``hold``, ``pending`` before. A series without a sample for more than
    ``stale_after`` was gone, and the condition starts anew. Adds
    ``alertname, held_since_us, alertstate``.

    One scan: a block of samples is summed up by its first and last time, its last
    state and the start of the run that is open at its end. Two summaries in
    sequence make one: the second run goes on from the first if it began with the
    block and no gap lies between. Blocks have about ``block_rows`` samples, or
    span ``block`` microseconds where that is given.
    """
    keyed = samples if "us" in samples.columns else with_series(samples)
    checked = keyed.withColumn("_holds", F.coalesce(condition, F.lit(False)))
    if block is None:
        at = blocks.cuts(checked, "us", block_rows)
        cut = blocks.block_of(F.col("us"), at) if at else F.lit(0).cast("bigint")
    else:
        at, cut = [block], F.floor(F.col("us") / F.lit(block)).cast("bigint")

    def within(own: DataFrame, part: Window) -> DataFrame:
        ordered = part.orderBy("us")
        frame = ordered.rowsBetween(Window.unboundedPreceding, 0)
        lasting = F.col("_before._holds") & (F.col("us") - F.col("_before.us") <= stale_after)
        starts = F.col("_holds") & F.col("_before").isNotNull() & ~lasting
        return own.withColumns(
            {"_before": F.lag(F.struct("us", "_holds")).over(ordered), "_first_us": F.min("us").over(frame)}
        ).withColumn("_start", F.max(F.when(starts, F.col("us"))).over(frame))

    # Without a start since the block began, a run has held from its first sample.
    own_start = F.coalesce("_start", "_first_us")
    if not at:
        since = within(checked, Window.partitionBy(*SERIES)).withColumn("held_since_us", own_start)
    else:
        summary = {
            "_from": F.min("us"),
            "_last": F.max_by(F.struct("us", "_holds", own_start.alias("start"), F.col("_start").isNull().alias("whole")), "us"),
            "_began": F.min_by("_holds", "us"),
        }
        found = blocks.scanned(checked, SERIES, cut, summary, lambda s: _open_runs(s, stale_after), within)
        since = found.withColumn("held_since_us", F.coalesce("_start", "_open", "_first_us")).drop("_open")
    firing = F.col("us") - F.col("held_since_us") >= hold
    return (
        since.filter("_holds")
        .withColumns(
            {
                "alertname": F.lit(alert),
                "alertstate": F.when(firing, F.lit("firing")).otherwise(F.lit("pending")),
            }
        )
        .drop("_holds", "_start", "_before", "_first_us")
    )


def _open_runs(summaries: DataFrame, stale_after: int) -> DataFrame:
    """The start of the run that goes on from earlier blocks into each block."""
    ordered = Window.partitionBy(blocks.GROUP).orderBy(blocks.BLOCK)
    frame = ordered.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("_last").over(ordered)
    goes_on = F.coalesce(
        before["_holds"] & (F.col("_from") - before["us"] <= stale_after) & F.col("_began"), F.lit(False)
    )
    # Blocks that one run fills from end to end do not name a start of their own.
    through = F.col("_goes_on") & F.col("_last.whole")
    named = F.when(~through, F.col("_last.start"))
    return summaries.withColumn("_goes_on", goes_on).withColumn(
        "_open", F.when(F.col("_goes_on"), F.last(named, ignorenulls=True).over(frame))
    ).drop("_goes_on")


def target_down(
    samples: DataFrame, hold: int = TARGET_DOWN_FOR, stale_after: int = STALE_AFTER
) -> DataFrame:
    return alert_states(
        selected(samples, "up"), F.col("value") == 0, hold, "TargetDown", stale_after=stale_after
    )


def target_flapping(
    samples: DataFrame, span: int = CHANGES_SPAN, hold: int = FLAPPING_FOR,
    stale_after: int = STALE_AFTER,
) -> DataFrame:
    counted = changes(selected(samples, "up"), span)
    return alert_states(
        counted, F.col("n_changes") > FLAPPING_ABOVE, hold, "PrometheusTargetFlapping",
        stale_after=stale_after,
    )


def alert_series(states: DataFrame) -> DataFrame:
    """Alert states as samples of the metric ``ALERTS`` with value 1."""
    extra = F.create_map(
        F.lit("alertname"), F.col("alertname"), F.lit("alertstate"), F.col("alertstate")
    )
    kept = F.map_filter("labels", lambda k, _: ~k.isin("alertname", "alertstate"))
    return states.select(
        F.lit("ALERTS").alias("metric"),
        F.map_concat(kept, extra).alias("labels"),
        F.timestamp_micros("us").alias("ts"),
        F.lit(1.0).alias("value"),
    )
