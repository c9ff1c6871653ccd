"""Queries over metric samples. Event data is sparse, so spans are hours, not minutes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellurion.operators import metrics
from tellurion.plans import views
from tellurion.plans.panels import Panels, panel
from tellurion.plans.registry import query

HOUR = 60 * metrics.MINUTE
SPAN = 10 * HOUR
STEP = 6 * HOUR
STALE = 5 * HOUR
SAMPLES = views.duck(views.samples)
UP = f"(SELECT event_id, job, instance, epoch_us(ts) AS us, ts, up AS value FROM {SAMPLES} s)"
SPAN_FRAME = f"RANGE BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW"
AT = 1_705_320_000_000_000
SHOWN = 6 * HOUR


def _series(spark, sf_dir, metric, column):
    rows = views.view(spark, sf_dir, views.samples)
    labels = F.create_map(F.lit("job"), F.col("job"), F.lit("instance"), F.col("instance"))
    return rows.select(
        F.lit(metric).alias("metric"), labels.alias("labels"), F.col("ts"),
        F.col(column).alias("value"),
    )


def _up(spark, sf_dir):
    return _series(spark, sf_dir, "up", "up")


def _job():
    return metrics.label("job").alias("job")


def _panels(spark, sf_dir, samples, alerts=None):
    return Panels(
        samples, lambda chosen: metrics.at_steps(chosen, STEP, STALE), SPAN, SPAN,
        extrapolate=False, alerts=alerts, step=STEP,
    )


def _visible(rows: str, value: str = "value") -> str:
    """Newest sample per series and step, stated with a window over the step."""
    first = f"CAST(ceil(us / {STEP}.0) AS BIGINT) * {STEP}"
    return f"""(SELECT job, instance, g AS us, {value} AS value FROM (SELECT *, row_number() OVER
      (PARTITION BY job, instance, g ORDER BY us DESC) AS r FROM (SELECT *, unnest(generate_series({first},
      {first} + {STALE}, {STEP})) AS g FROM {rows} q) x WHERE g < us + {STALE}) y WHERE r = 1)"""


VISIBLE = _visible(UP)


@query(f"SELECT job, instance, us, value FROM {VISIBLE} v")
def samples_at_steps(spark, sf_dir):
    """Availability of every target at regular steps."""
    vector = metrics.at_steps(_up(spark, sf_dir), STEP, STALE)
    return vector.select(_job(), metrics.label("instance").alias("instance"), "us", "value")


@query(f"""SELECT job, value FROM (SELECT *, row_number() OVER (PARTITION BY job, instance ORDER BY us DESC) AS r
  FROM {UP} u WHERE us > {AT - STALE} AND us <= {AT}) x WHERE r = 1""")
def samples_at_instant(spark, sf_dir):
    """Availability of every target at one instant."""
    return metrics.instant(_up(spark, sf_dir), AT, STALE).select(_job(), "value")


@query(f"SELECT us, job, sum(value) AS value FROM {VISIBLE} v GROUP BY 1, 2")
def up_by_job(spark, sf_dir):
    """Targets up per job and step."""
    return panel("up_by_job", _panels(spark, sf_dir, _up(spark, sf_dir))).select("us", "job", "value")


@query(f"SELECT us, sum(value) AS value FROM {VISIBLE} v GROUP BY 1")
def up_total(spark, sf_dir):
    """Targets up per step."""
    vector = metrics.at_steps(_up(spark, sf_dir), STEP, STALE)
    return metrics.aggregated(vector, "sum").select("us", "value")


@query(f"SELECT us, count(*) AS value FROM {VISIBLE} v WHERE value = 0 GROUP BY 1")
def targets_down(spark, sf_dir):
    """Number of targets down per step; steps without one have no row."""
    return panel("targets_down", _panels(spark, sf_dir, _up(spark, sf_dir))).select("us", "value")


@query(f"SELECT us, count(*) AS value FROM {VISIBLE} v WHERE value = 0 AND job IN ('job-1', 'job-2', 'job-3') GROUP BY 1")
def selected_jobs_down(spark, sf_dir):
    """Targets down among the jobs that match a pattern."""
    panels = _panels(spark, sf_dir, _up(spark, sf_dir))
    return metrics.aggregated(panels.down({"job": "job-[12]|job-3"}), "count").select("us", "value")


@query(f"SELECT us, job, sum(value) AS value, count(*) AS n FROM {VISIBLE} v WHERE value = 0 GROUP BY 1, 2")
def down_by_job(spark, sf_dir):
    """The sum of zeros per job, as shipped, next to the count."""
    panels = _panels(spark, sf_dir, _up(spark, sf_dir))
    down = panels.down()
    return down.groupBy("us", _job()).agg(F.sum("value").alias("value"), F.count("value").alias("n"))


CENTS = f"(SELECT job, instance, epoch_us(ts) AS us, cents AS value FROM {SAMPLES} s)"


@query(f"SELECT us, instance, max(value) AS value FROM {_visible(CENTS)} v GROUP BY 1, 2")
def max_by_instance(spark, sf_dir):
    """Greatest visible value per instance and step."""
    vector = metrics.at_steps(_series(spark, sf_dir, "process_resident_memory_bytes", "cents"), STEP, STALE)
    return metrics.aggregated(vector, "max", ["instance"]).select("us", "instance", "value")


@query(f"SELECT us, job, sum(value) AS value FROM {VISIBLE} v WHERE value = 1 GROUP BY 1, 2")
def matching_value_sum(spark, sf_dir):
    """Sum of the values that match, per job."""
    vector = metrics.at_steps(_up(spark, sf_dir), STEP, STALE).filter("value = 1")
    return metrics.aggregated(vector, "sum", ["job"]).select("us", "job", "value")


@query(f"""SELECT us, count(*) AS value FROM (SELECT 'u' AS m, * FROM {VISIBLE} v UNION ALL
  SELECT 'c' AS m, * FROM {_visible(CENTS)} w) x GROUP BY 1""")
def metric_pattern_count(spark, sf_dir):
    """Series whose metric name matches a pattern."""
    both = _series(spark, sf_dir, "airflow_up", "up").unionByName(
        _series(spark, sf_dir, "airflow_tasks", "cents")
    ).unionByName(_series(spark, sf_dir, "other_tasks", "cents"))
    return panel("scheduler_series", _panels(spark, sf_dir, both)).select("us", "value")


@query(f"""SELECT job, instance, max_by(gauge, us) AS value, max(us) AS us FROM
  (SELECT job, instance, gauge, epoch_us(ts) AS us FROM {SAMPLES} s
   WHERE gauge IS NOT NULL AND epoch_us(ts) > {AT - SHOWN} AND epoch_us(ts) <= {AT}) x GROUP BY 1, 2""")
def last_non_null(spark, sf_dir):
    """Last value per series that is not null within the time shown."""
    last = metrics.last_non_null(_series(spark, sf_dir, "queue_length", "gauge"), AT, SHOWN)
    return last.select(_job(), metrics.label("instance").alias("instance"), "value", "us")


CHANGED = f"""SELECT job, instance, us, coalesce(sum(flag) OVER w - first(flag) OVER w, 0) AS n_changes, value
  FROM (SELECT *, CASE WHEN lag(value) OVER (PARTITION BY job, instance ORDER BY us) <> value THEN 1 ELSE 0 END AS flag
  FROM {UP} u) f WINDOW w AS (PARTITION BY job, instance ORDER BY us {SPAN_FRAME})"""


@query(f"SELECT job, instance, us, CAST(n_changes AS BIGINT) AS n_changes FROM ({CHANGED}) c")
def value_changes(spark, sf_dir):
    """Value changes in the look-back at every sample."""
    counted = metrics.changes(_up(spark, sf_dir), SPAN)
    return counted.select(_job(), metrics.label("instance").alias("instance"), "us", "n_changes")


@query(f"SELECT job, count(*) AS n_samples, CAST(sum(n_changes) AS BIGINT) AS n_changes FROM ({CHANGED}) c WHERE n_changes > 4 GROUP BY 1")
def flapping(spark, sf_dir):
    """Flapping samples per job."""
    return metrics.flapping(_up(spark, sf_dir), SPAN).groupBy(_job()).agg(
        F.count("*").alias("n_samples"), F.sum("n_changes").alias("n_changes")
    )


def _rates(extrapolate: bool) -> str:
    rate = "(inc / covered)"
    if extrapolate:
        gap = "(covered / (n - 1))"
        edge = f"((first_us - (us - {SPAN})) / 1e6)"
        near = f"CASE WHEN {edge} < {gap} * 1.1 THEN {edge} ELSE {gap} / 2 END"
        zero = "CASE WHEN inc > 0 AND first_value >= 0 THEN covered * first_value / inc ELSE 1e18 END"
        rate = f"(inc / covered) * (covered + least({near}, {zero})) / {SPAN / 1e6}"
    return f"""SELECT job, instance, us, round({rate} * {SPAN / 1e6}, 8) AS increase FROM (SELECT job, instance, us,
      sum(g) OVER w - first(g) OVER w AS inc, (us - first(us) OVER w) / 1e6 AS covered, count(*) OVER w AS n,
      first(us) OVER w AS first_us, first(value) OVER w AS first_value
      FROM (SELECT *, CASE WHEN lag(value) OVER o IS NULL THEN 0 WHEN value < lag(value) OVER o THEN value
        ELSE value - lag(value) OVER o END AS g
        FROM (SELECT job, instance, epoch_us(ts) AS us, counter AS value FROM {SAMPLES} s) c
        WINDOW o AS (PARTITION BY job, instance ORDER BY us)) f
      WINDOW w AS (PARTITION BY job, instance ORDER BY us {SPAN_FRAME})) r WHERE n > 1"""


def _rated(spark, sf_dir, extrapolate):
    rated = metrics.rates(_series(spark, sf_dir, "requests_total", "counter"), SPAN, extrapolate)
    return rated.select(
        _job(), metrics.label("instance").alias("instance"), "us", F.round(F.col("rate") * (SPAN / metrics.SECOND), 8).alias("increase")
    )


@query(_rates(False))
def counter_rate(spark, sf_dir):
    """Counter rate over the covered time, shown per look-back."""
    return _rated(spark, sf_dir, False)


@query(_rates(True))
def counter_rate_extrapolated(spark, sf_dir):
    """Counter rate extended to the edges of the look-back, shown per look-back."""
    return _rated(spark, sf_dir, True)


HOLD = 2 * HOUR
FLAP_HOLD = 5 * HOUR


def _alerts(rows: str, condition: str, hold: int) -> str:
    return f"""SELECT job, instance, us, since, CASE WHEN us - since >= {hold} THEN 'firing' ELSE 'pending' END AS alertstate
      FROM (SELECT *, min(us) OVER (PARTITION BY job, instance, run) AS since FROM (SELECT *,
        sum(CASE WHEN {condition} AND us - before <= {STALE} THEN 0 ELSE 1 END) OVER (PARTITION BY job, instance ORDER BY us ROWS UNBOUNDED PRECEDING) AS run,
        {condition} AS holds FROM (SELECT *, lag(us) OVER (PARTITION BY job, instance ORDER BY us) AS before FROM {rows} q) g) a WHERE holds) b"""


DOWN_ALERTS = _alerts(UP, "value = 0", HOLD)
FLAP_ALERTS = _alerts(f"({CHANGED})", "n_changes > 4", FLAP_HOLD)


@query(f"SELECT job, instance, us, since, alertstate FROM ({DOWN_ALERTS}) d")
def down_alert_states(spark, sf_dir):
    """State of the target-down alert at every sample where it holds."""
    states = metrics.target_down(_up(spark, sf_dir), HOLD, STALE)
    return states.select(
        _job(), metrics.label("instance").alias("instance"), "us",
        F.col("held_since_us").alias("since"), "alertstate",
    )


@query(f"SELECT job, instance, us, since, alertstate FROM ({DOWN_ALERTS}) d")
def down_alert_states_blocks(spark, sf_dir):
    """The same states with series cut into one-day blocks."""
    states = metrics.alert_states(
        _up(spark, sf_dir), F.col("value") == 0, HOLD, "TargetDown", block=24 * HOUR, stale_after=STALE
    )
    return states.select(
        _job(), metrics.label("instance").alias("instance"), "us",
        F.col("held_since_us").alias("since"), "alertstate",
    )


def _all_alerts(spark, sf_dir):
    up = _up(spark, sf_dir)
    down = metrics.alert_series(metrics.target_down(up, HOLD, STALE))
    flapping = metrics.target_flapping(up, SPAN, FLAP_HOLD, STALE)
    return down.unionByName(metrics.alert_series(flapping))


@query(f"""SELECT alertname, alertstate, count(*) AS n FROM (SELECT 'TargetDown' AS alertname, alertstate FROM ({DOWN_ALERTS}) d
  UNION ALL SELECT 'PrometheusTargetFlapping', alertstate FROM ({FLAP_ALERTS}) f) x GROUP BY 1, 2""")
def alert_counts(spark, sf_dir):
    """Samples per alert and state."""
    alerts = _all_alerts(spark, sf_dir)
    return alerts.groupBy(
        metrics.label("alertname").alias("alertname"), metrics.label("alertstate").alias("alertstate")
    ).agg(F.count("*").alias("n"))


ALERT_ROWS = f"""(SELECT job || 'd' AS job, instance, us, 1.0 AS value, 'TargetDown' AS alertname
  FROM ({DOWN_ALERTS}) d WHERE alertstate = 'firing' UNION ALL SELECT job || 'f', instance, us, 1.0,
  'PrometheusTargetFlapping' FROM ({FLAP_ALERTS}) f WHERE alertstate = 'firing')"""


@query(f"""SELECT us, CASE WHEN suffix(job, 'd') THEN 'TargetDown' ELSE 'PrometheusTargetFlapping' END AS alertname,
  count(*) AS value FROM {_visible(ALERT_ROWS)} v GROUP BY 1, 2""")
def alerts_firing(spark, sf_dir):
    """Firing alerts by name and step."""
    panels = _panels(spark, sf_dir, _up(spark, sf_dir), _all_alerts(spark, sf_dir))
    return panel("alerts_by_name", panels).select("us", "alertname", "value")


# Samples joined to the evaluation times whose range they are in.
STEPS = f"""(SELECT unnest(generate_series(min(epoch_us(ts)) // {STEP} * {STEP}, max(epoch_us(ts)) + {SPAN}, {STEP})) AS t
  FROM {SAMPLES} s)"""


def _ranged(value: str) -> str:
    return f"""(SELECT job, instance, t, us, value, lag(value) OVER (PARTITION BY job, instance, t ORDER BY us) AS before
      FROM {STEPS} g JOIN (SELECT job, instance, epoch_us(ts) AS us, {value} AS value FROM {SAMPLES} s) v
      ON v.us <= g.t AND v.us > g.t - {SPAN})"""


CHANGED_AT = f"""(SELECT job, instance, t AS us, count(*) FILTER (before <> value)::DOUBLE AS value
  FROM {_ranged("up")} r GROUP BY 1, 2, 3)"""


@query(f"SELECT job, instance, us, value FROM {CHANGED_AT} c")
def changes_at_steps(spark, sf_dir):
    """Value changes in the range before every evaluation time."""
    counted = metrics.changes_at_steps(_up(spark, sf_dir), STEP, SPAN)
    return counted.select(_job(), metrics.label("instance").alias("instance"), "us", "value")


@query(f"""SELECT job, instance, t AS us, round(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value
    ELSE value - before END) / ((max(us) - min(us)) / 1e6) * {SPAN / 1e6}, 6) AS increase
  FROM {_ranged("counter")} r GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def rate_at_steps(spark, sf_dir):
    """Counter rate in the range before every evaluation time, shown per range."""
    rated = metrics.rates_at_steps(_series(spark, sf_dir, "requests_total", "counter"), STEP, SPAN)
    increase = F.round(F.col("value") * (SPAN / metrics.SECOND), 6).alias("increase")
    return rated.select(_job(), metrics.label("instance").alias("instance"), "us", increase)


@query(f"SELECT us, job, sum(value) AS value FROM {CHANGED_AT} c WHERE value > 4 GROUP BY 1, 2")
def flapping_by_job(spark, sf_dir):
    """Changes of flapping targets summed per job and step."""
    panels = _panels(spark, sf_dir, _up(spark, sf_dir))
    return panel("flapping_by_job", panels).select("us", "job", "value")
