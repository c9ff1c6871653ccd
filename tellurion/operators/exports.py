"""Dataset exports: requests joined to the catalogue, gated, with their documents.

Joins are left to the optimizer: a small catalogue is broadcast when its
measured size allows, a large one is shuffled on its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions import exports as x
from tellurion.functions import jsonx, objects

REQUEST_FIELDS = {
    "access_right": "string",
    "publish": "boolean",
    "legal_review_approved": "boolean",
    "doi": "string",
    "landing_page_url": "string",
    "title": "string",
    "description": "string",
    "publisher": "string",
    "publication_year": "string",
    "publication_date": "string",
    "language": "string",
    "license": "string",
    "access_conditions": "string",
    "formats": "array<string>",
    "communities": "array<string>",
    "creators": "array<struct<name:string,affiliation:string>>",
}


def prefixed(requests: DataFrame) -> DataFrame:
    """Request fields under the ``req_`` prefix; absent ones become NULL."""
    present = set(requests.columns)
    fields = [
        (F.col(n) if n in present else F.lit(None)).cast(t).alias(f"req_{n}")
        for n, t in REQUEST_FIELDS.items()
    ]
    others = [c for c in requests.columns if c not in REQUEST_FIELDS]
    return requests.select(*others, *fields)


def resolved(requests: DataFrame, datasets: DataFrame, plans: DataFrame) -> DataFrame:
    """Requests whose dataset is known, with the dataset and its plan if there is one."""
    # ``plan_id`` stays NULL when a dataset names a plan that does not exist.
    linked = plans.select(
        F.col("dmp_id"), F.col("dmp_id").alias("plan_id"), F.col("status").alias("plan_status")
    )
    return (
        prefixed(requests)
        .filter(F.trim("dataset_id") != "")
        .join(datasets, "dataset_id")
        .join(linked, "dmp_id", "left")
    )


def request_errors(requests: DataFrame, datasets: DataFrame) -> DataFrame:
    """Requests that name no dataset, or one that is not in the catalogue."""
    blank = F.coalesce(F.trim("dataset_id"), F.lit("")) == ""
    code = F.when(blank, F.lit(x.NO_DATASET)).otherwise(F.lit(x.UNKNOWN_DATASET))
    unknown = requests.join(datasets.select("dataset_id"), "dataset_id", "left_anti")
    return unknown.withColumn("error_code", code)


def deposits(
    rows: DataFrame, as_of: Column, publisher: x.Publisher = x.Publisher()
) -> DataFrame:
    """Deposit metadata per resolved request; blocked requests carry only the error."""
    right = F.col("access_right")
    gated = rows.withColumn("access_right", x.deposit_right()).withColumn(
        "error_code", x.deposit_gate_error(right)
    )
    return gated.withColumn(
        "metadata",
        F.when(
            F.col("error_code").isNull(),
            x.deposit_metadata(right, F.col("plan_id"), as_of, publisher),
        ),
    )


def discoveries(
    rows: DataFrame, as_of: Column, publisher: x.Publisher = x.Publisher()
) -> DataFrame:
    """Discovery metadata per resolved request; blocked requests carry only the error."""
    right = F.col("access_right")
    gated = rows.withColumn("access_right", x.discovery_right()).withColumn(
        "error_code", x.discovery_gate_error(right, publisher)
    )
    return gated.withColumn(
        "metadata",
        F.when(
            F.col("error_code").isNull(),
            x.discovery_metadata(right, F.col("plan_id"), as_of, publisher),
        ),
    )


def _dataset() -> Column:
    names = (
        "dataset_id", "title", "dataset_type", "classification", "access_mode", "dmp_id",
        "data_products", "source_topics",
    )
    return F.struct(*[F.col(n) for n in names])


def _plan() -> Column:
    return F.when(
        F.col("plan_id").isNotNull(),
        F.struct(F.col("plan_id").alias("dmp_id"), F.col("plan_status").alias("status")),
    )


def deposit_manifest(generated_at: Column, publisher: x.Publisher) -> Column:
    """Manifest text of a deposit."""
    return jsonx.to_text(
        F.struct(
            F.lit(f"{publisher.project.lower()}.zenodo.dataset_export").alias("manifest_type"),
            generated_at.alias("generated_at"),
            F.lit("Zenodo").alias("repository"),
            F.lit(x.EVIDENCE_TOPIC).alias("evidence_topic"),
            _dataset().alias("dataset"),
            _plan().alias("data_management_plan"),
            F.array(*[F.lit(g) for g in x.DEPOSIT_GATES]).alias("release_gates"),
        )
    )


def discovery_manifest(generated_at: Column, publisher: x.Publisher) -> Column:
    """Manifest text of a discovery record."""
    return jsonx.to_text(
        F.struct(
            F.lit(f"{publisher.project.lower()}.openaire.metadata_export").alias("manifest_type"),
            generated_at.alias("generated_at"),
            F.lit("OpenAIRE").alias("catalogue"),
            F.lit("metadata_package_for_provide_or_oai_pmh").alias("export_mode"),
            F.lit(False).alias("direct_upload_supported"),
            F.lit("https://guidelines.openaire.eu/en/latest/data/index.html").alias("guidelines"),
            F.lit("https://provide.openaire.eu/").alias("provide_registration_url"),
            F.lit(x.EVIDENCE_TOPIC).alias("evidence_topic"),
            _dataset().alias("dataset"),
            _plan().alias("data_management_plan"),
            F.col("metadata"),
            F.array(*[F.lit(g) for g in x.DISCOVERY_GATES]).alias("release_gates"),
        )
    )


def export_evidence(
    rows: DataFrame, repository: str, endings: tuple[str, ...], created_at: Column
) -> DataFrame:
    """Evidence records of gated exports, in the shape of the exports topic."""
    blocked = F.col("error_code").isNotNull()
    if repository == "Zenodo":
        done = F.when(F.coalesce(F.col("req_publish"), F.lit(False)), F.lit("published")).otherwise(
            F.lit("draft_created")
        )
        gates = x.DEPOSIT_GATES
    else:
        done, gates = F.lit("metadata_package_created"), x.DISCOVERY_GATES
    files = F.array(*[objects.file_safe(F.col("dataset_id"), e) for e in endings])
    nothing = F.array().cast("array<string>")
    return rows.select(
        F.concat_ws("/", F.lit(repository), F.col("request_id").cast("string")).alias("export_id"),
        "dataset_id",
        "dmp_id",
        F.lit(repository).alias("repository"),
        F.when(F.trim("req_doi") != "", F.regexp_replace(F.trim("req_doi"), "^https://doi\\.org/", ""))
        .alias("doi"),
        "access_right",
        F.when(blocked, F.lit("blocked")).otherwise(done).alias("status"),
        F.when(blocked, nothing).otherwise(files).alias("uploaded_files"),
        F.coalesce(F.col("req_legal_review_approved"), F.lit(False)).alias("legal_review_approved"),
        F.array(*[F.lit(g) for g in gates]).alias("release_gates"),
        "error_code",
        created_at.alias("created_at"),
    )


def package_files(
    rows: DataFrame, as_of: Column, generated_at: Column, publisher: x.Publisher
) -> DataFrame:
    """XML and manifest texts of discovery exports as ``file_name, content``."""
    passed = rows.filter(F.col("error_code").isNull())
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n'),
        F.to_xml(x.datacite(F.col("metadata"), as_of), {"rowTag": "resource"}),
        F.lit("\n"),
    )
    files = F.array(
        F.struct(
            objects.file_safe(F.col("dataset_id"), x.DISCOVERY_XML_ENDING).alias("file_name"),
            xml.alias("content"),
        ),
        F.struct(
            objects.file_safe(F.col("dataset_id"), x.DISCOVERY_ENDING).alias("file_name"),
            discovery_manifest(generated_at, publisher).alias("content"),
        ),
    )
    return passed.select("request_id", F.inline(files))
