"""The shipped dashboard panels, each as a DataFrame over metric samples.

A panel is a function of samples and of a vector function, which turns selected
samples into a vector, either at one instant or at regular steps. Range functions
are evaluated at the same times: ``step`` or ``at`` names them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.operators import metrics

Vector = Callable[[DataFrame], DataFrame]


class Panels:
    """Panels over one table of samples."""

    def __init__(
        self, samples: DataFrame, vector: Vector, changes_span: int = metrics.CHANGES_SPAN,
        rate_span: int = metrics.RATE_SPAN, extrapolate: bool = True,
        alerts: DataFrame | None = None, step: int = metrics.MINUTE, at: int | None = None,
    ):
        self.step, self.at = step, at
        self.samples, self.vector, self.alerts = samples, vector, alerts
        self.changes_span, self.rate_span, self.extrapolate = changes_span, rate_span, extrapolate

    def value(self, metric: str, **labels: str) -> DataFrame:
        """``metric{label="…"}``"""
        return self.vector(metrics.selected(self.samples, metric, equals=labels))

    def named(self, metric: str, name: str) -> DataFrame:
        """``metric{name!=""}``"""
        return self.vector(metrics.selected(self.samples, metric, differs={name: ""}))

    def down(self, patterns: Mapping[str, str] | None = None, **labels: str) -> DataFrame:
        """``up{…} == 0``"""
        chosen = metrics.selected(self.samples, "up", equals=labels, patterns=patterns)
        return self.vector(chosen).filter("value = 0")

    def rate(self, metric: str, differs: Mapping[str, str] | None = None, **labels: str) -> DataFrame:
        """``rate(metric{…}[5m])``"""
        chosen = metrics.selected(self.samples, metric, equals=labels, differs=differs)
        return metrics.rates_at_steps(chosen, self.step, self.rate_span, self.extrapolate, self.at)

    def changed(self) -> DataFrame:
        """``changes(up[10m])``"""
        chosen = metrics.selected(self.samples, "up")
        return metrics.changes_at_steps(chosen, self.step, self.changes_span, self.at)

    def firing(self, **labels: str) -> DataFrame:
        """``ALERTS{alertstate="firing",…}``"""
        wanted = {"alertstate": "firing", **labels}
        return self.vector(metrics.selected(self.alerts, "ALERTS", equals=wanted))


def _sum(vector: DataFrame, *by: str) -> DataFrame:
    return metrics.aggregated(vector, "sum", by)


def _count(vector: DataFrame, *by: str) -> DataFrame:
    return metrics.aggregated(vector, "count", by)


def _max(vector: DataFrame, *by: str) -> DataFrame:
    return metrics.aggregated(vector, "max", by)


# Metric names, labels and thresholds of the shipped panels.
STREAM_JOBS = "flink|seaweedfs|statsd-exporter|prometheus"
PANELS: dict[str, Callable[[Panels], DataFrame]] = {
    "prometheus_up": lambda p: p.value("up", job="prometheus"),
    "haproxy_up": lambda p: p.value("up", job="haproxy"),
    "postgres_up": lambda p: p.value("up", job="postgres-rw"),
    "object_store_up": lambda p: p.value("up", job="seaweedfs"),
    "stream_up": lambda p: p.value("up", job="flink"),
    "stream_up_total": lambda p: _sum(p.value("up", job="flink")),
    "containers_up": lambda p: p.value("up", job="cadvisor"),
    "statsd_up": lambda p: p.value("up", job="statsd-exporter"),
    "targets_down": lambda p: _count(p.down()),
    "up_by_job": lambda p: _sum(p.value("up"), "job"),
    "container_cpu": lambda p: _sum(p.rate("container_cpu_usage_seconds_total", {"name": ""})),
    "container_memory": lambda p: _sum(p.named("container_memory_working_set_bytes", "name")),
    "containers_seen": lambda p: _count(p.named("container_last_seen", "name")),
    "container_receive": lambda p: _sum(
        p.rate("container_network_receive_bytes_total", {"name": ""})
    ),
    "postgres_backends": lambda p: p.value("pg_stat_database_numbackends", datname="postgres"),
    "postgres_commits": lambda p: p.rate("pg_stat_database_xact_commit", datname="postgres"),
    "backend_status": lambda p: _sum(p.value("haproxy_backend_status"), "proxy"),
    # Sums the matching values, which are sixes, and not their number.
    "server_checks_ok": lambda p: _sum(
        p.value("haproxy_server_check_status").filter("value = 6"), "proxy"
    ),
    "scheduler_series": lambda p: _count(
        p.vector(metrics.selected(p.samples, metric_pattern="airflow_.*"))
    ),
    "stream_jobs_down": lambda p: _count(p.down({"job": STREAM_JOBS})),
    "scrape_interval": lambda p: _max(p.value("prometheus_target_interval_length_seconds"), "job"),
    "head_series": lambda p: p.value("prometheus_tsdb_head_series"),
    "head_appended": lambda p: p.rate("prometheus_tsdb_head_samples_appended_total"),
    "down_firing": lambda p: _count(p.firing(alertname="TargetDown")),
    "flapping_firing": lambda p: _count(p.firing(alertname="PrometheusTargetFlapping")),
    "alerts_firing": lambda p: _count(p.firing()),
    "alerts_by_name": lambda p: _count(p.firing(), "alertname"),
    # A sum of zeros: shows which jobs have a target down, not how many.
    "down_by_job": lambda p: _sum(p.down(), "job"),
    "down_count_by_job": lambda p: _count(p.down(), "job"),
    "flapping_by_job": lambda p: _sum(
        p.changed().filter(F.col("value") > metrics.FLAPPING_ABOVE), "job"
    ),
    "object_store_up_count": lambda p: _count(
        p.value("up", job="seaweedfs").filter("value = 1")
    ),
    "object_store_down": lambda p: _count(p.down(job="seaweedfs")),
    "object_store_scrape": lambda p: _max(
        p.value("scrape_duration_seconds", job="seaweedfs"), "instance"
    ),
    "object_store_samples": lambda p: _max(
        p.value("scrape_samples_post_metric_relabeling", job="seaweedfs"), "instance"
    ),
    "object_store_memory": lambda p: _max(
        p.value("process_resident_memory_bytes", job="seaweedfs"), "instance"
    ),
    "object_store_cpu": lambda p: _sum(
        p.rate("process_cpu_seconds_total", job="seaweedfs"), "instance"
    ),
    "flapping_targets": lambda p: _count(
        p.changed().filter(F.col("value") > metrics.FLAPPING_ABOVE)
    ),
    "down_series": lambda p: p.down(),
    "changes": lambda p: p.changed(),
}


def panel(name: str, panels: Panels) -> DataFrame:
    return PANELS[name](panels)
