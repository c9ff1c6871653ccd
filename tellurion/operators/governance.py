"""Questions over governance, compliance and security evidence.

Every function takes evidence tables and returns a table. Joins are equi joins
on record keys; arrays are exploded before they are joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.operators import blocks
from tellurion.operators.latest import compacted

# Topics of the evidence views, by prefix and by name.
_DATASET_TOPICS = (
    "governance.dataset.catalog", "governance.data_management_plans",
    "governance.repository.exports",
)
_RESILIENCE = ("security.", "resilience.", "compliance.", "cra.")
VIEWS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "security_resilience": (_RESILIENCE, ()),
    "nis2": (_RESILIENCE, ()),
    "dora": (_RESILIENCE, ()),
    "cra": (_RESILIENCE, ()),
    "compliance": (("compliance.",), ("dataact.legal_basis.checks", "cra.product.lifecycle")),
    "legal": (("compliance.",), ("dataact.legal_basis.checks", *_DATASET_TOPICS)),
    "dataset": ((), _DATASET_TOPICS),
    "data_act": (
        ("dataact.",),
        (*_DATASET_TOPICS, "governance.intermediation.log", "governance.transfer.notices"),
    ),
    "dga": (("governance.",), ("dlq.events", "compliance.reporting.channels")),
    "research": (("governance.research.",), _DATASET_TOPICS),
}
READY_PLANS = ("approved", "active")
GRANTING = ("granted", "updated")
SETTLED_FINDINGS = ("accepted_risk", "patched", "mitigated", "false_positive")


def in_view(topic: Column, view: str) -> Column:
    """Whether a topic belongs to an evidence view."""
    prefixes, names = VIEWS[view]
    hit = topic.isin(*names) if names else F.lit(False)
    for prefix in prefixes:
        hit = hit | topic.startswith(prefix)
    return hit


def select_evidence(records: DataFrame, view: str, topic: str = "topic") -> DataFrame:
    """Evidence records of one view; a filter on the topic that the scan can use."""
    return records.filter(in_view(F.col(topic), view))


def evidence_views(records: DataFrame, topic: str = "topic") -> DataFrame:
    """Each record once per view it belongs to, with the ``view`` added."""
    names = F.array(*[F.when(in_view(F.col(topic), v), F.lit(v)).otherwise("") for v in VIEWS])
    return records.withColumn("view", F.explode(F.array_remove(names, "")))


def controls_of(controls: DataFrame, regulation: str) -> DataFrame:
    """Controls whose comma list of regulations contains a text."""
    return controls.filter(F.col("regulation").contains(regulation))


def control_regulations(controls: DataFrame) -> DataFrame:
    """One row per control and named regulation."""
    return controls.withColumn("regulation", F.explode(F.split("regulation", r",\s*")))


def implemented(obligations: DataFrame) -> DataFrame:
    return obligations.filter(F.col("status") == "implemented")


def count_by_status(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(F.count("*").alias("n"))


def planes(components: DataFrame) -> DataFrame:
    """Sorted distinct planes."""
    return components.select("plane").distinct().orderBy("plane")


def component_health(
    components: DataFrame, checks: DataFrame, plane: str | None = None
) -> DataFrame:
    """Components, of one plane or of all, with their check or the unknown state."""
    if plane is not None and plane != "all":
        components = components.filter(F.col("plane") == plane)
    state = checks.select(
        "component_id", F.col("status").alias("_status"), F.col("detail").alias("_detail")
    )
    return components.join(state, "component_id", "left").select(
        *components.columns,
        F.coalesce("_status", F.lit("unknown")).alias("status"),
        F.coalesce("_detail", F.lit("not checked")).alias("detail"),
    )


def lineage(datasets: DataFrame, products: DataFrame) -> DataFrame:
    """Dataset to product to source topic, through the array columns of both."""
    used = datasets.select("dataset_id", F.explode("data_products").alias("product_id"))
    fed = products.select("product_id", F.explode("source_topics").alias("topic"))
    return used.join(fed, "product_id").select("dataset_id", "product_id", "topic")


def failing(gates: Mapping[str, Column]) -> Column:
    """Names of the gates that do not hold, in the order given."""
    flags = [F.when(F.coalesce(c, F.lit(False)), F.lit("")).otherwise(n) for n, c in gates.items()]
    return F.array_remove(F.array(*flags), "")


def release_readiness(
    datasets: DataFrame, plans: DataFrame, dossier: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Datasets with the release gates they fail.

    ``dossier`` has one row per dataset with ``dossier_status``; ``reviews`` one
    with ``disclosure_review_status``.
    """
    gates = {
        "catalogue": F.col("dataset_id").isNotNull(),
        "plan": F.col("_plan_status").isin(*READY_PLANS),
        "legal_dossier": F.col("dossier_status") == "approved",
        "disclosure_review": F.col("disclosure_review_status").isin("approved", "not_required"),
        "minimised": F.col("dataset_type") != "raw",
    }
    plan = plans.select("dmp_id", F.col("status").alias("_plan_status"))
    return (
        datasets.join(plan, "dmp_id", "left")
        .join(dossier.select("dataset_id", "dossier_status"), "dataset_id", "left")
        .join(reviews.select("dataset_id", "disclosure_review_status"), "dataset_id", "left")
        .withColumn("failing_gates", failing(gates))
        .withColumn("ready", F.size("failing_gates") == 0)
        .select(*datasets.columns, "failing_gates", "ready")
    )


def permitted_at_request(
    requests: DataFrame,
    permissions: DataFrame,
    keys: Sequence[str],
    block: int | None = None,
    block_rows: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """Access requests with the permission state at the time they were made.

    The latest permission event at or before a request decides. Requests and
    permissions are one table ordered by time, so no request meets all
    permissions of its key. Histories of more than ``block_rows`` rows are cut into
    blocks of about that number; all others are dealt whole, by their keys. With
    ``block`` every history is cut into blocks of so many microseconds.
    Needs ``request_id, requested_at`` and ``permission_id, occurred_at, event_type``.
    """
    shared = [*keys, "us", "is_request", "id", "event_type"]
    asked = requests.select(
        *keys,
        F.unix_micros(F.col("requested_at").cast("timestamp")).alias("us"),
        F.lit(1).alias("is_request"),
        F.col("request_id").alias("id"),
        F.lit(None).cast("string").alias("event_type"),
    )
    events = permissions.select(
        *keys,
        F.unix_micros(F.col("occurred_at").cast("timestamp")).alias("us"),
        F.lit(0).alias("is_request"),
        F.col("permission_id").alias("id"),
        "event_type",
    )
    event = F.when(
        F.col("is_request") == 0,
        F.struct("us", F.col("id").alias("permission_id"), "event_type"),
    )
    both = asked.select(*shared).unionByName(events.select(*shared))
    split = cut = None
    if block is None:
        split = blocks.in_long_groups(both, keys, block_rows)
        if split is not None:
            at = blocks.cuts(both.where(split), "us", block_rows)
            cut = F.when(split, blocks.block_of(F.col("us"), at)).otherwise(0) if at else None
    else:
        cut = F.floor(F.col("us") / F.lit(block)).cast("bigint")
    joined = blocks.with_running_max(both, keys, ["us", "is_request", "id"], event, cut, "permission", split=split)
    granted = F.col("permission.event_type").isin(*GRANTING)
    return joined.filter(F.col("is_request") == 1).select(
        F.col("id").alias("request_id"),
        *keys,
        F.col("us").alias("requested_us"),
        F.col("permission.permission_id").alias("permission_id"),
        F.col("permission.event_type").alias("event_type"),
        F.coalesce(granted, F.lit(False)).alias("permitted"),
    )


def export_gaps(
    exports: DataFrame, requests: DataFrame, checks: DataFrame, safeguards: DataFrame
) -> DataFrame:
    """User exports with the evidence they lack.

    ``checks`` has one row per request; ``safeguards`` may have many per product
    and is reduced to the number that block before it is joined.
    """
    blocking = (
        safeguards.filter("blocking")
        .groupBy("data_product_id")
        .agg(F.count("*").alias("n_blocking"))
    )
    asked = requests.select("request_id", F.col("status").alias("_request_status"))
    checked = checks.select("request_id", F.col("decision").alias("_decision"))
    gates = {
        "request": F.col("_request_status").isNotNull(),
        "request_approved": F.col("_request_status").isin("approved", "fulfilled"),
        "legal_basis_check": F.col("_decision").isNotNull(),
        "legal_basis_approved": F.col("_decision") == "approved",
        "no_blocking_safeguard": F.col("n_blocking") == 0,
    }
    return (
        exports.join(asked, "request_id", "left")
        .join(checked, "request_id", "left")
        .join(blocking, "data_product_id", "left")
        .withColumn("n_blocking", F.coalesce("n_blocking", F.lit(0)))
        .withColumn("gaps", failing(gates))
        .select(*exports.columns, "n_blocking", "gaps")
    )


def finding_patches(findings: DataFrame, assets: DataFrame, patches: DataFrame) -> DataFrame:
    """Findings with the criticality of their asset and the patches that name them."""
    named = patches.select(
        "patch_id", F.col("status").alias("patch_status"),
        F.explode("related_findings").alias("finding_id"),
    )
    per_finding = named.groupBy("finding_id").agg(
        F.count("*").alias("n_patches"),
        F.count_if(F.col("patch_status") == "deployed").alias("n_deployed"),
    )
    return (
        findings.join(assets.select("asset_id", "criticality"), "asset_id", "left")
        .join(per_finding, "finding_id", "left")
        .withColumns(
            {
                "n_patches": F.coalesce("n_patches", F.lit(0)),
                "n_deployed": F.coalesce("n_deployed", F.lit(0)),
            }
        )
    )


def open_critical(findings: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Critical findings whose latest record is still open: they block a release."""
    latest = compacted(findings, ["finding_id"], order)
    settled = F.col("status").isin(*SETTLED_FINDINGS)
    return latest.filter((F.col("severity") == "critical") & ~settled)


def overdue(rows: DataFrame, due: str, as_of: Column, open_when: Column, by: str) -> DataFrame:
    """Open items past their due time, counted by owner."""
    late = rows.filter(open_when & (F.col(due) < as_of))
    return late.groupBy(by).agg(F.count("*").alias("n_overdue"), F.min(due).alias("oldest_due"))


def restore_targets(
    tests: DataFrame, max_rpo: int, max_rto: int, order: Sequence[str] = ("tested_at",)
) -> DataFrame:
    """Latest restore test per system and whether it meets the targets."""
    last = compacted(tests, ["system"], order)
    meets = (
        (F.col("result") == "passed")
        & (F.col("rpo_minutes") <= max_rpo)
        & (F.col("rto_minutes") <= max_rto)
    )
    return last.withColumn("meets_targets", F.coalesce(meets, F.lit(False)))


def scope_excess(requests: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Requests with the requested fields beyond the approved list of their product."""
    joined = requests.join(allowed.select(key, "allowed_fields"), key, "left")
    nothing = F.array().cast("array<string>")
    extra = F.array_except("requested_fields", F.coalesce("allowed_fields", nothing))
    return joined.withColumn("excess_fields", F.array_sort(extra)).drop("allowed_fields")


def minimised(
    rows: DataFrame,
    identity: str,
    salt: str,
    keep: Iterable[str],
    coordinates: Mapping[str, int] | None = None,
    times: Mapping[str, str] | None = None,
) -> DataFrame:
    """A release of raw rows with a pseudonym, coarse places and coarse times.

    Only the named columns remain; the identity is replaced by a salted hash.
    """
    pseudonym = F.sha2(F.concat(F.lit(salt), F.col(identity).cast("string")), 256)
    places = [F.round(F.col(c), digits).alias(c) for c, digits in (coordinates or {}).items()]
    moments = [F.date_trunc(unit, F.col(c)).alias(c) for c, unit in (times or {}).items()]
    return rows.select(pseudonym.alias("pseudonym"), *keep, *places, *moments)


def denied_raw_access(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Requested products that the requester's profile does not open by default."""
    opened = profiles.select("profile_id", F.explode("default_access").alias("product_id"))
    return requests.join(opened, ["profile_id", "product_id"], "left_anti")


def legal_gates(gates: DataFrame, dossier: DataFrame) -> DataFrame:
    """Gates with their missing artefacts; open only when all are approved.

    ``gates`` has ``gate_id`` and the array ``required_artifacts``; ``dossier``
    has the current ``artifact_id, status``.
    """
    needed = gates.select("gate_id", F.explode("required_artifacts").alias("artifact_id"))
    state = dossier.select("artifact_id", "status")
    approved = F.coalesce(F.col("status") == "approved", F.lit(False))
    return (
        needed.join(state, "artifact_id", "left")
        .groupBy("gate_id")
        .agg(
            F.bool_and(approved).alias("is_open"),
            F.count_if(~approved).alias("n_missing"),
            F.count("*").alias("n_required"),
        )
    )


def control_rollup(
    assessments: DataFrame, statuses: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Latest status of every control, counted per regulation and status."""
    latest = compacted(assessments, ["regulation", "control_id"], order)
    counted = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in statuses]
    return latest.groupBy("regulation").agg(*counted, F.count("*").alias("n_controls"))


def evidence_gaps(channels: DataFrame, evidence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Steps of an access channel without a record.

    ``channels`` has the array ``evidence_topics`` and the key columns;
    ``evidence`` has the keys and ``topic``.
    """
    needed = channels.withColumn("topic", F.explode("evidence_topics")).drop("evidence_topics")
    return needed.join(evidence.select(*keys, "topic"), [*keys, "topic"], "left_anti")

