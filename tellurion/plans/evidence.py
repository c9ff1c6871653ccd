"""Queries over governance evidence: contracts, exports, gates, permissions, security."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellurion.functions import exports as rights
from tellurion.operators import conformance, exports, governance
from tellurion.plans import views
from tellurion.plans.registry import query
from tellurion.session import run_folder
from tellurion.sources import declared, packages, registry

TEXTS = views.duck(views.evidence_texts)
DATASETS = views.duck(views.datasets)
PLANS = views.duck(views.data_plans)
REQUESTS = views.duck(views.export_requests)
FINDINGS = views.duck(views.findings)
PERMISSIONS = views.duck(views.permissions)
ACCESS = views.duck(views.access_requests)
ASSESSMENTS = views.duck(views.assessments)
PUBLISHER = rights.Publisher(name="Example Publisher", project="Example", affiliation="Example Lab")



def _as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _at():
    return F.lit("2024-06-01T00:00:00+00:00")


BROKEN = """SELECT topic, record_id, unnest(CASE topic
  WHEN 'security.vulnerability.findings' THEN CASE WHEN record_id % 3 = 0
    THEN ['severity|enum', 'detected_at|format', 'note|additionalProperties'] ELSE [] END
  WHEN 'dataact.user.exports' THEN CASE WHEN record_id % 2 = 0
    THEN ['request_id|required', 'export_id|type', 'record_count|minimum'] ELSE ['delivery_channel|enum'] END
  WHEN 'resilience.backup.tests' THEN CASE WHEN record_id % 7 = 0 THEN ['|object']
    ELSE ['tested_at|format', 'rpo_minutes|type', 'findings|type'] END
  WHEN 'governance.access.requests' THEN ['requester_id|type'] ELSE [] END) AS v"""


@query(f"""SELECT topic, record_id, string_split(v, '|')[1] AS field, string_split(v, '|')[2] AS rule
  FROM ({BROKEN} FROM {TEXTS} t) b""")
def schema_violations(spark, sf_dir):
    """Rules that evidence records break."""
    contracts = declared.declared_contracts()
    return conformance.violations(
        views.view(spark, sf_dir, views.evidence_texts),
        registry.contract_table(spark, contracts), registry.topic_table(spark, contracts),
    )


@query(f"""SELECT topic, string_split(v, '|')[2] AS rule, count(*) AS n FROM ({BROKEN} FROM {TEXTS} t) b GROUP BY 1, 2""")
def schema_violation_counts(spark, sf_dir):
    """Broken rules per topic."""
    return schema_violations(spark, sf_dir).groupBy("topic", "rule").agg(F.count("*").alias("n"))


TOPIC_VIEWS = """SELECT * FROM (VALUES
  ('security.vulnerability.findings', ['security_resilience', 'nis2', 'dora', 'cra']),
  ('dataact.user.exports', ['data_act']),
  ('resilience.backup.tests', ['security_resilience', 'nis2', 'dora', 'cra']),
  ('governance.access.requests', ['dga'])) AS t(topic, views)"""


@query(f"""SELECT record_id, topic, unnest(views) AS view FROM {TEXTS} e JOIN ({TOPIC_VIEWS}) v USING (topic)""")
def evidence_topics(spark, sf_dir):
    """Evidence records with every view they belong to."""
    rows = views.view(spark, sf_dir, views.evidence_texts).select("record_id", "topic")
    return governance.evidence_views(rows).select("record_id", "topic", "view")


@query(f"SELECT record_id, topic FROM {TEXTS} e WHERE topic IN ('security.vulnerability.findings', 'resilience.backup.tests')")
def resilience_evidence(spark, sf_dir):
    """Evidence records of one view."""
    rows = views.view(spark, sf_dir, views.evidence_texts)
    return governance.select_evidence(rows, "security_resilience").select("record_id", "topic")


# ---------------------------------------------------------------- dataset exports

RESOLVED = f"""SELECT q.*, d.title AS own_title, d.dataset_type, d.classification, d.access_mode, d.dmp_id, p.dmp_id AS plan_id
  FROM {REQUESTS} q JOIN {DATASETS} d ON q.dataset_id = d.dataset_id LEFT JOIN {PLANS} p ON d.dmp_id = p.dmp_id"""
DEPOSIT = f"""SELECT *, CASE WHEN right_a = 'open' AND classification <> 'public' THEN 'open_release_blocked'
  WHEN publish AND NOT coalesce(legal_review_approved, false) THEN 'legal_review_required' END AS err
  FROM (SELECT *, CASE WHEN access_right IN ('open', 'embargoed', 'restricted') THEN access_right
    WHEN access_mode = 'open' AND classification = 'public' THEN 'open'
    WHEN access_mode = 'embargoed' THEN 'embargoed' ELSE 'restricted' END AS right_a FROM ({RESOLVED}) r) s"""
HAS_DOI = "coalesce(trim(doi), '') <> ''"
DISCOVERY = f"""SELECT *, CASE WHEN right_b = 'open' AND classification <> 'public' THEN 'open_metadata_release_blocked'
  WHEN NOT {HAS_DOI} AND landing_page_url LIKE 'http:%' THEN 'invalid_landing_page_url' END AS err,
  CASE WHEN {HAS_DOI} THEN replace(trim(doi), 'https://doi.org/', '') ELSE coalesce(landing_page_url, dataset_id) END AS ident,
  CASE WHEN {HAS_DOI} THEN 'DOI' WHEN landing_page_url IS NOT NULL THEN 'URL' ELSE 'Other' END AS ident_type
  FROM (SELECT *, CASE WHEN access_right IN ('open', 'closed', 'restricted') THEN access_right
    WHEN access_mode = 'open' AND classification = 'public' THEN 'open' ELSE 'restricted' END AS right_b
    FROM ({RESOLVED}) r) s"""
CREATOR = "CASE WHEN request_id % 3 = 0 THEN creators[1].name ELSE 'Example Publisher' END"
TITLE = "CASE WHEN title <> '' THEN title ELSE own_title END"


def _resolved(spark, sf_dir):
    return exports.resolved(
        views.view(spark, sf_dir, views.export_requests),
        views.view(spark, sf_dir, views.datasets).drop("p_partkey"),
        views.view(spark, sf_dir, views.data_plans),
    )


@query(f"SELECT request_id, dataset_id, right_a AS deposit_right, right_b AS discovery_right, plan_id FROM ({DEPOSIT}) a JOIN (SELECT request_id, right_b FROM ({DISCOVERY}) x) b USING (request_id)")
def access_rights(spark, sf_dir):
    """Access right of every request in both repositories."""
    return _resolved(spark, sf_dir).select(
        "request_id", "dataset_id", rights.deposit_right().alias("deposit_right"),
        rights.discovery_right().alias("discovery_right"), "plan_id",
    )


@query(f"""SELECT request_id, a.err AS deposit_error, b.err AS discovery_error FROM ({DEPOSIT}) a
  JOIN (SELECT request_id, err FROM ({DISCOVERY}) x) b USING (request_id)""")
def dataset_release_gates(spark, sf_dir):
    """The gate each request fails in each repository."""
    return _resolved(spark, sf_dir).select(
        "request_id",
        rights.deposit_gate_error(rights.deposit_right()).alias("deposit_error"),
        rights.discovery_gate_error(rights.discovery_right(), PUBLISHER).alias("discovery_error"),
    )


@query(f"""SELECT request_id, CASE WHEN trim(dataset_id) = '' THEN 'missing_dataset_id' ELSE 'dataset_not_found' END AS error_code
  FROM {REQUESTS} q WHERE dataset_id NOT IN (SELECT dataset_id FROM {DATASETS} d)""")
def unknown_datasets(spark, sf_dir):
    """Requests without a dataset in the catalogue."""
    errors = exports.request_errors(
        views.view(spark, sf_dir, views.export_requests), views.view(spark, sf_dir, views.datasets)
    )
    return errors.select("request_id", "error_code")


@query(f"""SELECT request_id, err AS error_code, CASE WHEN err IS NULL THEN {TITLE} END AS title,
  CASE WHEN err IS NULL THEN 'Example dataset export for ' || dataset_id || '. Classification: ' || classification ||
    '. Access mode: ' || access_mode || '. Linked Data Management Plan: ' || coalesce(plan_id, 'missing') ||
    '. This export must follow the dataset catalogue, DMP, GDPR legal-basis, Data Act and DGA release gates before publication.' END AS description,
  CASE WHEN err IS NULL THEN {CREATOR} END AS creators, CASE WHEN err IS NULL THEN '2024-06-01' END AS publication_date,
  CASE WHEN err IS NULL THEN 'telemetry,IoT,research data,' || dataset_type || ',' || classification END AS keywords,
  CASE WHEN err IS NULL AND right_a = 'open' THEN 'cc-by-4.0' END AS license,
  CASE WHEN err IS NULL AND right_a <> 'open' THEN 'Files are restricted until dataset catalogue, DMP, privacy, Data Act and DGA release checks are approved.'
    END AS conditions,
  CASE WHEN err IS NULL THEN 'Generated by the Example management console. Evidence topic: governance.repository.exports.' END AS notes FROM ({DEPOSIT}) d""")
def export_metadata(spark, sf_dir):
    """Deposit metadata of every resolved request."""
    rows = exports.deposits(_resolved(spark, sf_dir), _as_of(), PUBLISHER)
    m = F.col("metadata")
    return rows.select(
        "request_id", "error_code", m["title"].alias("title"), m["description"].alias("description"),
        F.array_join(F.transform(m["creators"], lambda c: c["name"]), ",").alias("creators"),
        m["publication_date"].alias("publication_date"),
        F.array_join(m["keywords"], ",").alias("keywords"), m["license"].alias("license"),
        m["access_conditions"].alias("conditions"), m["notes"].alias("notes"),
    )


@query(f"""SELECT request_id, err AS error_code, CASE WHEN err IS NULL THEN ident END AS identifier,
  CASE WHEN err IS NULL THEN ident_type END AS identifier_type, CASE WHEN err IS NULL THEN {TITLE} END AS title,
  CASE WHEN err IS NULL THEN {CREATOR} END AS creators,
  CASE WHEN err IS NULL THEN CASE WHEN request_id % 4 = 0 THEN '2021' ELSE '2024' END END AS publication_year,
  CASE WHEN err IS NULL THEN CASE right_b WHEN 'open' THEN 'Open Access' WHEN 'closed' THEN 'Closed Access' ELSE 'Restricted Access' END END AS rights,
  CASE WHEN err IS NULL THEN 'info:eu-repo/semantics/' || right_b || 'Access' END AS rights_uri,
  CASE WHEN err IS NULL THEN CASE WHEN dmp_id IS NULL THEN 0 ELSE 1 END END AS n_related,
  CASE WHEN err IS NULL THEN 'Example metadata export for ' || dataset_id || '. Classification: ' || classification ||
    '. Access mode: ' || access_mode || '. Linked Data Management Plan: ' || coalesce(plan_id, 'missing') ||
    '. This record is intended for OpenAIRE discovery and must not override dataset catalogue, DMP, GDPR, Data Act or DGA release gates.' END AS description,
  CASE WHEN err IS NULL THEN landing_page_url END AS landing_page_url FROM ({DISCOVERY}) d""")
def discovery_metadata(spark, sf_dir):
    """Discovery metadata of every resolved request."""
    rows = exports.discoveries(_resolved(spark, sf_dir), _as_of(), PUBLISHER)
    m = F.col("metadata")
    related = F.size(rights.related_identifiers(m["related_identifiers"]))
    return rows.select(
        "request_id", "error_code", m["identifier"].alias("identifier"),
        m["identifier_type"].alias("identifier_type"), m["title"].alias("title"),
        F.array_join(F.transform(m["creators"], lambda c: c["name"]), ",").alias("creators"),
        m["publication_year"].alias("publication_year"), m["rights"].alias("rights"),
        m["rights_uri"].alias("rights_uri"), F.when(m.isNotNull(), related).alias("n_related"),
        m["description"].alias("description"),
        m["landing_page_url"].alias("landing_page_url"),
    )


@query(f"""SELECT request_id, dataset_id, 'example.zenodo.dataset_export' AS manifest_type, 'Zenodo' AS repository, plan_id AS plan, classification,
  CASE WHEN plan_id IS NULL THEN NULL ELSE (SELECT status FROM {PLANS} p WHERE p.dmp_id = plan_id) END AS plan_status,
  6 AS n_gates FROM ({DEPOSIT}) d WHERE err IS NULL""")
def export_manifest(spark, sf_dir):
    """Fields read back from the manifest texts of deposits."""
    rows = exports.deposits(_resolved(spark, sf_dir), _as_of(), PUBLISHER).filter("error_code IS NULL")
    texts = rows.select("request_id", exports.deposit_manifest(_at(), PUBLISHER).alias("manifest"))
    schema = (
        "manifest_type STRING, repository STRING, dataset STRUCT<dataset_id: STRING, classification: STRING>, "
        "data_management_plan STRUCT<dmp_id: STRING, status: STRING>, release_gates ARRAY<STRING>"
    )
    m = F.col("m")
    return texts.select("request_id", F.from_json("manifest", schema).alias("m")).select(
        "request_id", m["dataset"]["dataset_id"].alias("dataset_id"), m["manifest_type"].alias("manifest_type"),
        m["repository"].alias("repository"), m["data_management_plan"]["dmp_id"].alias("plan"),
        m["dataset"]["classification"].alias("classification"),
        m["data_management_plan"]["status"].alias("plan_status"),
        F.size(m["release_gates"]).alias("n_gates"),
    )


@query(f"""SELECT 'Zenodo/' || request_id AS export_id, dataset_id, right_a AS access_right,
  CASE WHEN err IS NOT NULL THEN 'blocked' WHEN publish THEN 'published' ELSE 'draft_created' END AS status,
  coalesce(legal_review_approved, false) AS legal_review_approved, err AS error_code,
  CASE WHEN err IS NULL THEN dataset_id || '.zenodo-manifest.json' ELSE '' END AS files,
  CASE WHEN {HAS_DOI} THEN replace(trim(doi), 'https://doi.org/', '') END AS doi FROM ({DEPOSIT}) d
  UNION ALL SELECT 'OpenAIRE/' || request_id, dataset_id, right_b, CASE WHEN err IS NOT NULL THEN 'blocked'
    ELSE 'metadata_package_created' END, coalesce(legal_review_approved, false), err,
  CASE WHEN err IS NULL THEN dataset_id || '.openaire-datacite.xml,' || dataset_id || '.openaire-manifest.json' ELSE '' END,
  CASE WHEN {HAS_DOI} THEN replace(trim(doi), 'https://doi.org/', '') END FROM ({DISCOVERY}) d""")
def export_evidence(spark, sf_dir):
    """Evidence records of the exports to both repositories."""
    resolved = _resolved(spark, sf_dir)
    deposits = exports.export_evidence(
        exports.deposits(resolved, _as_of(), PUBLISHER), "Zenodo", (rights.DEPOSIT_ENDING,), _at()
    )
    discoveries = exports.export_evidence(
        exports.discoveries(resolved, _as_of(), PUBLISHER), "OpenAIRE",
        (rights.DISCOVERY_XML_ENDING, rights.DISCOVERY_ENDING), _at(),
    )
    return deposits.unionByName(discoveries).select(
        "export_id", "dataset_id", "access_right", "status", "legal_review_approved", "error_code",
        F.array_join("uploaded_files", ",").alias("files"), "doi",
    )


@query(f"""SELECT request_id, ident AS identifier, ident_type AS identifier_type, {TITLE} AS title
  FROM ({DISCOVERY}) d WHERE err IS NULL""")
def export_packages(spark, sf_dir):
    """Fields read back from the XML texts of discovery exports."""
    rows = exports.discoveries(_resolved(spark, sf_dir), _as_of(), PUBLISHER)
    files = exports.package_files(rows, _as_of(), _at(), PUBLISHER)
    xml = files.filter(F.col("file_name").endswith(rights.DISCOVERY_XML_ENDING))
    content = F.col("content")
    body = F.regexp_replace(content, r"^<\?xml[^>]*>\s*<resource[^>]*>", "<resource>")
    return xml.select(
        "request_id", F.xpath_string(body, F.lit("/resource/identifier")).alias("identifier"),
        F.xpath_string(body, F.lit("/resource/identifier/@identifierType")).alias("identifier_type"),
        F.xpath_string(body, F.lit("/resource/titles/title")).alias("title"),
    )


@query(f"""SELECT request_id, dataset_id, 2 AS n_files, ident AS identifier, {TITLE} AS xml_title, {TITLE} AS manifest_title,
  'example.openaire.metadata_export' AS manifest_type, classification, plan_id AS plan
  FROM ({DISCOVERY}) d WHERE err IS NULL""")
def packaged_exports(spark, sf_dir):
    """Discovery exports written into containers, and fields of both files read back by offset."""
    rows = exports.discoveries(_resolved(spark, sf_dir), _as_of(), PUBLISHER)
    path = run_folder(spark, "packages")
    packages.write(exports.package_files(rows, _as_of(), _at(), PUBLISHER), path)
    body = F.regexp_replace("content", r"^<\?xml[^>]*>\s*<resource[^>]*>", "<resource>")
    xml = F.when(F.col("file_name").endswith(rights.DISCOVERY_XML_ENDING), body)
    schema = (
        "manifest_type STRING, metadata STRUCT<title: STRING>, "
        "dataset STRUCT<dataset_id: STRING, classification: STRING>, data_management_plan STRUCT<dmp_id: STRING>"
    )
    manifest = F.when(F.col("file_name").endswith(rights.DISCOVERY_ENDING), F.from_json("content", schema))
    fields = packages.read(spark, path).select(
        "request_id", F.xpath_string(xml, F.lit("/resource/identifier")).alias("identifier"),
        F.xpath_string(xml, F.lit("/resource/titles/title")).alias("xml_title"), manifest.alias("m"),
    )
    m = F.max("m")
    return fields.groupBy("request_id").agg(
        F.count("*").cast("int").alias("n_files"), F.max("identifier").alias("identifier"), F.max("xml_title").alias("xml_title"),
        m["metadata"]["title"].alias("manifest_title"), m["manifest_type"].alias("manifest_type"),
        m["dataset"]["dataset_id"].alias("dataset_id"), m["dataset"]["classification"].alias("classification"),
        m["data_management_plan"]["dmp_id"].alias("plan"),
    )


# ---------------------------------------------------------------- catalogue views

CONTROL_ROWS = f"""SELECT p_partkey AS control_id, CASE p_partkey % 4 WHEN 0 THEN 'NIS2' WHEN 1 THEN 'NIS2, DORA'
  WHEN 2 THEN 'DORA, CRA' ELSE 'CRA' END AS regulation, CASE p_partkey % 3 WHEN 0 THEN 'implemented'
  WHEN 1 THEN 'partial' ELSE 'todo' END AS status FROM part"""


def _controls(spark, sf_dir):
    text = CONTROL_ROWS.replace("FROM part", "FROM {part}")
    return spark.sql(text, part=views.table(spark, sf_dir, "part"))


@query(f"SELECT control_id, regulation FROM ({CONTROL_ROWS}) c WHERE control_id % 4 IN (1, 2)")
def regulation_controls(spark, sf_dir):
    """Controls of one regulation, by its name in the comma list."""
    return governance.controls_of(_controls(spark, sf_dir), "DORA").select("control_id", "regulation")


@query(f"""SELECT regulation, count(*) AS n FROM (SELECT unnest(CASE control_id % 4 WHEN 0 THEN ['NIS2'] WHEN 1 THEN ['NIS2', 'DORA']
  WHEN 2 THEN ['DORA', 'CRA'] ELSE ['CRA'] END) AS regulation FROM ({CONTROL_ROWS}) c) x GROUP BY 1""")
def controls_per_regulation(spark, sf_dir):
    """Controls per named regulation."""
    return governance.control_regulations(_controls(spark, sf_dir)).groupBy("regulation").agg(
        F.count("*").alias("n")
    )


@query(f"SELECT control_id FROM ({CONTROL_ROWS}) c WHERE control_id % 3 = 0")
def implemented_obligations(spark, sf_dir):
    """Obligations that are implemented."""
    return governance.implemented(_controls(spark, sf_dir)).select("control_id")


@query(f"SELECT status, count(*) AS n FROM ({CONTROL_ROWS}) c GROUP BY 1")
def count_by_status(spark, sf_dir):
    """Controls per status."""
    return governance.count_by_status(_controls(spark, sf_dir))


COMPONENTS = "SELECT 'comp-' || c_custkey AS component_id, c_mktsegment AS plane, c_name AS name FROM customer"
HEALTH = """SELECT 'comp-' || o_custkey AS component_id, CASE WHEN o_orderkey % 3 = 0 THEN 'unreachable' ELSE 'healthy' END AS status,
  'check ' || o_orderkey AS detail, o_orderkey FROM orders"""
LAST_HEALTH = f"SELECT component_id, max_by(status, o_orderkey) AS status, max_by(detail, o_orderkey) AS detail FROM ({HEALTH}) h GROUP BY 1"


def _components(spark, sf_dir):
    components = spark.sql(
        COMPONENTS.replace("FROM customer", "FROM {t}"), t=views.table(spark, sf_dir, "customer")
    )
    checks = spark.sql(HEALTH.replace("FROM orders", "FROM {t}"), t=views.table(spark, sf_dir, "orders"))
    last = checks.groupBy("component_id").agg(
        F.max_by("status", "o_orderkey").alias("status"), F.max_by("detail", "o_orderkey").alias("detail")
    )
    return components, last


@query(f"""SELECT c.component_id, c.plane, coalesce(h.status, 'unknown') AS status, coalesce(h.detail, 'not checked') AS detail
  FROM ({COMPONENTS}) c LEFT JOIN ({LAST_HEALTH}) h USING (component_id)""")
def component_health(spark, sf_dir):
    """Components with their last check or the unknown state."""
    joined = governance.component_health(*_components(spark, sf_dir))
    return joined.select("component_id", "plane", "status", "detail")


@query(f"SELECT plane FROM ({COMPONENTS}) c GROUP BY plane")
def planes(spark, sf_dir):
    """Distinct planes."""
    return governance.planes(_components(spark, sf_dir)[0])


# ---------------------------------------------------------------- evidence rules

PRODUCTS = f"SELECT 'prod-' || s_suppkey AS product_id, {{list}} AS source_topics FROM supplier"


def _products(spark, sf_dir):
    text = PRODUCTS.format(list="array('raw.sensor', 'raw.' || s_suppkey % 3)")
    return spark.sql(text.replace("FROM supplier", "FROM {t}"), t=views.table(spark, sf_dir, "supplier"))


@query(f"""SELECT dataset_id, product_id, topic FROM (SELECT dataset_id, unnest(data_products) AS product_id FROM {DATASETS} d) a
  JOIN (SELECT 'prod-' || s_suppkey AS product_id, unnest(['raw.sensor', 'raw.' || s_suppkey % 3]) AS topic FROM supplier) b USING (product_id)""")
def lineage(spark, sf_dir):
    """Dataset to product to topic."""
    return governance.lineage(views.view(spark, sf_dir, views.datasets), _products(spark, sf_dir))


DOSSIER = "SELECT 'ds-' || c_custkey AS dataset_id, CASE WHEN c_nationkey % 3 = 0 THEN 'draft' ELSE 'approved' END AS dossier_status FROM customer"
REVIEWS = """SELECT 'ds-' || c_custkey AS dataset_id, CASE c_nationkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'approved'
  WHEN 2 THEN 'not_required' ELSE 'rejected' END AS disclosure_review_status FROM customer"""


@query(f"""SELECT dataset_id, failing, failing = '' AS ready FROM (SELECT dataset_id, array_to_string(list_filter([
  CASE WHEN coalesce(status IN ('approved', 'active'), false) THEN '' ELSE 'plan' END,
  CASE WHEN coalesce(dossier_status, '') = 'approved' THEN '' ELSE 'legal_dossier' END,
  CASE WHEN coalesce(disclosure_review_status, '') IN ('approved', 'not_required') THEN '' ELSE 'disclosure_review' END,
  CASE WHEN dataset_type = 'raw' THEN 'minimised' ELSE '' END], lambda g: g <> ''), ',') AS failing
  FROM {DATASETS} d LEFT JOIN {PLANS} p ON d.dmp_id = p.dmp_id LEFT JOIN ({DOSSIER}) o USING (dataset_id)
  LEFT JOIN ({REVIEWS}) r USING (dataset_id)) x""")
def release_readiness(spark, sf_dir):
    """Datasets with the release gates they fail."""
    customer = views.table(spark, sf_dir, "customer")
    rows = governance.release_readiness(
        views.view(spark, sf_dir, views.datasets), views.view(spark, sf_dir, views.data_plans),
        spark.sql(DOSSIER.replace("FROM customer", "FROM {t}"), t=customer),
        spark.sql(REVIEWS.replace("FROM customer", "FROM {t}"), t=customer),
    )
    return rows.select("dataset_id", F.array_join("failing_gates", ",").alias("failing"), "ready")


STATE_AT = f"""SELECT request_id, requested_us, permission_id, event_type,
  coalesce(event_type IN ('granted', 'updated'), false) AS permitted FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY occurred_at DESC, permission_id DESC) AS r
  FROM (SELECT a.rid, a.request_id, epoch_us(a.requested_at) AS requested_us, p.permission_id, p.event_type, p.occurred_at
    FROM (SELECT *, row_number() OVER () AS rid FROM {ACCESS} r) a LEFT JOIN {PERMISSIONS} p ON a.subject_id = p.subject_id AND a.product_id = p.product_id
    AND p.occurred_at <= a.requested_at) j) x WHERE r = 1"""


@query(STATE_AT)
def request_asof_permission(spark, sf_dir):
    """Permission state of every access request at the time it was made."""
    rows = governance.permitted_at_request(
        views.view(spark, sf_dir, views.access_requests), views.view(spark, sf_dir, views.permissions),
        ["subject_id", "product_id"],
    )
    return rows.select("request_id", "requested_us", "permission_id", "event_type", "permitted")


@query(f"SELECT event_type, permitted, count(*) AS n FROM ({STATE_AT}) u GROUP BY 1, 2")
def permission_outcomes(spark, sf_dir):
    """Access requests by the permission event that decides them, in small blocks of history."""
    rows = governance.permitted_at_request(
        views.view(spark, sf_dir, views.access_requests), views.view(spark, sf_dir, views.permissions),
        ["subject_id", "product_id"], block=90 * 24 * 3600 * 1_000_000,
    )
    kept = rows.select("request_id", "requested_us", "permission_id", "event_type", "permitted")
    return kept.groupBy("event_type", "permitted").agg(F.count("*").alias("n"))


EXPORTS = """SELECT l_orderkey * 10 + l_linenumber AS export_id, l_orderkey AS request_id, 'dp-' || l_suppkey AS data_product_id,
  l_extendedprice AS price FROM lineitem"""
# Keys that match nothing stand for records that a request does not have.
DATA_REQUESTS = """SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS request_id, CASE o_orderkey % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'fulfilled'
  WHEN 2 THEN 'rejected' ELSE 'submitted' END AS status FROM orders"""
BASIS = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS request_id, CASE WHEN o_orderkey % 3 = 0 THEN 'rejected' ELSE 'approved' END AS decision
  FROM orders"""
SAFEGUARDS = "SELECT 'dp-' || p_partkey % 60 AS data_product_id, p_size % 5 = 0 AS blocking FROM part"


@query(f"""SELECT export_id, price, n_blocking, array_to_string(list_filter([
  CASE WHEN status IS NULL THEN 'request' ELSE '' END,
  CASE WHEN coalesce(status, '') IN ('approved', 'fulfilled') THEN '' ELSE 'request_approved' END,
  CASE WHEN decision IS NULL THEN 'legal_basis_check' ELSE '' END,
  CASE WHEN coalesce(decision, '') = 'approved' THEN '' ELSE 'legal_basis_approved' END,
  CASE WHEN n_blocking > 0 THEN 'no_blocking_safeguard' ELSE '' END], lambda g: g <> ''), ',') AS gaps
  FROM (SELECT e.*, q.status, b.decision, coalesce(s.n, 0) AS n_blocking FROM ({EXPORTS}) e LEFT JOIN ({DATA_REQUESTS}) q USING (request_id)
  LEFT JOIN ({BASIS}) b USING (request_id) LEFT JOIN (SELECT data_product_id, count(*) AS n FROM ({SAFEGUARDS}) g WHERE blocking GROUP BY 1) s
  USING (data_product_id)) x""")
def export_evidence_gaps(spark, sf_dir):
    """User exports with the evidence they lack."""
    def over(text, table):
        return spark.sql(text.replace(f"FROM {table}", "FROM {t}"), t=views.table(spark, sf_dir, table))

    rows = governance.export_gaps(
        over(EXPORTS, "lineitem"), over(DATA_REQUESTS, "orders"), over(BASIS, "orders"), over(SAFEGUARDS, "part")
    )
    return rows.select("export_id", "price", "n_blocking", F.array_join("gaps", ",").alias("gaps"))


FINDING_ORDER = ["updated_us", "tie", "tie2", "tie3"]
LAST_FINDING = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY finding_id
  ORDER BY updated_us DESC, tie DESC, tie2 DESC, tie3 DESC) AS r FROM {FINDINGS} f) z WHERE r = 1"""


@query(f"SELECT finding_id, asset_id FROM ({LAST_FINDING}) l WHERE severity = 'critical' AND status = 'open'")
def open_critical_findings(spark, sf_dir):
    """Critical findings whose last record is open."""
    rows = governance.open_critical(views.view(spark, sf_dir, views.findings), FINDING_ORDER)
    return rows.select("finding_id", "asset_id")


PATCHES = """SELECT o_orderkey AS patch_id, CASE WHEN o_orderkey % 2 = 0 THEN 'deployed' ELSE 'planned' END AS status,
  {list} AS related_findings FROM orders"""
NAMED_FINDINGS = "'f-' || o_orderkey || '-1', 'f-' || o_orderkey || '-2', 'f-' || (o_orderkey + 1) || '-1'"
ASSETS = "SELECT CASE WHEN s_nationkey > 3 THEN 'asset-' ELSE 'absent-' END || s_suppkey AS asset_id, CASE WHEN s_nationkey % 2 = 0 THEN 'high' ELSE 'low' END AS criticality FROM supplier"


@query(f"""SELECT finding_id, criticality, coalesce(n, 0) AS n_patches, coalesce(nd, 0) AS n_deployed FROM ({LAST_FINDING}) l
  LEFT JOIN ({ASSETS}) a USING (asset_id) LEFT JOIN (SELECT finding_id, count(*) AS n, count(*) FILTER (status = 'deployed') AS nd
  FROM (SELECT status, unnest(related_findings) AS finding_id FROM ({PATCHES.format(list='[' + NAMED_FINDINGS + ']')}) p) x GROUP BY 1) y USING (finding_id)""")
def finding_patches(spark, sf_dir):
    """Latest findings with their asset and the patches that name them."""
    from tellurion.operators.latest import compacted

    patches = PATCHES.format(list="array(" + NAMED_FINDINGS + ")").replace("FROM orders", "FROM {t}")
    rows = governance.finding_patches(
        compacted(views.view(spark, sf_dir, views.findings), ["finding_id"], FINDING_ORDER),
        spark.sql(ASSETS.replace("FROM supplier", "FROM {t}"), t=views.table(spark, sf_dir, "supplier")),
        spark.sql(patches, t=views.table(spark, sf_dir, "orders")),
    )
    return rows.select("finding_id", "criticality", "n_patches", "n_deployed")


@query(f"""SELECT owner, count(*) AS n_overdue, epoch_us(min(due_at)) AS oldest_us FROM {FINDINGS} f
  WHERE status = 'open' AND due_at < TIMESTAMP '1998-06-01 00:00:00' GROUP BY 1""")
def overdue_items(spark, sf_dir):
    """Open findings past their due time, per owner."""
    rows = governance.overdue(
        views.view(spark, sf_dir, views.findings), "due_at",
        F.lit("1998-06-01 00:00:00").cast("timestamp"), F.col("status") == "open", "owner",
    )
    return rows.select("owner", "n_overdue", F.unix_micros("oldest_due").alias("oldest_us"))


TESTS = """SELECT 'sys-' || user_id AS system, event_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'passed' END AS result,
  CAST(round(value) AS INT) AS rpo_minutes, CAST(event_id % 240 AS INT) AS rto_minutes, ts AS tested_at FROM events"""


@query(f"""SELECT system, event_id, result = 'passed' AND rpo_minutes <= 60 AND rto_minutes <= 180 AS meets_targets
  FROM (SELECT *, row_number() OVER (PARTITION BY system ORDER BY tested_at DESC, event_id DESC) AS r FROM ({TESTS}) t) x WHERE r = 1""")
def restore_targets(spark, sf_dir):
    """Latest restore test per system against the targets."""
    tests = spark.sql(TESTS.replace("FROM events", "FROM {t}"), t=views.table(spark, sf_dir, "events"))
    rows = governance.restore_targets(tests, 60, 180, ("tested_at", "event_id"))
    return rows.select("system", "event_id", "meets_targets")


FIELDS = "'position', 'speed', CASE WHEN l_linenumber % 2 = 0 THEN 'identity' ELSE 'time' END"
SCOPED = "SELECT l_orderkey * 10 + l_linenumber AS request_id, l_extendedprice AS price, 'p-' || l_suppkey AS product_id, {list} AS requested_fields FROM lineitem"
ALLOWED = "SELECT CASE WHEN s_nationkey > 2 THEN 'p-' ELSE 'absent-' END || s_suppkey AS product_id, {list} AS allowed_fields FROM supplier"
ALLOWED_FIELDS = "'time', CASE WHEN s_suppkey % 2 = 0 THEN 'position' ELSE 'speed' END"


@query(f"""SELECT request_id, price, array_to_string(list_sort(list_filter(requested_fields,
  lambda f: NOT list_contains(coalesce(allowed_fields, []), f))), ',') AS excess FROM ({SCOPED.format(list='[' + FIELDS + ']')}) r
  LEFT JOIN ({ALLOWED.format(list='[' + ALLOWED_FIELDS + ']')}) a USING (product_id)""")
def scope_excess(spark, sf_dir):
    """Requested fields beyond the approved list."""
    asked = SCOPED.format(list="array(" + FIELDS + ")").replace("FROM lineitem", "FROM {t}")
    allowed = ALLOWED.format(list="array(" + ALLOWED_FIELDS + ")").replace("FROM supplier", "FROM {t}")
    rows = governance.scope_excess(
        spark.sql(asked, t=views.table(spark, sf_dir, "lineitem")),
        spark.sql(allowed, t=views.table(spark, sf_dir, "supplier")), "product_id",
    )
    return rows.select("request_id", "price", F.array_join("excess_fields", ",").alias("excess"))


@query("""SELECT sha256('salt' || user_id) AS pseudonym, event_type, round(value, 1) AS value,
  epoch_us(date_trunc('hour', ts)) AS hour_us FROM events""")
def minimised_release(spark, sf_dir):
    """Events with a pseudonym, coarse values and coarse times."""
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = governance.minimised(events, "user_id", "salt", ["event_type"], {"value": 1}, {"ts": "hour"})
    return rows.select("pseudonym", "event_type", "value", F.unix_micros("ts").alias("hour_us"))


PROFILED = "SELECT o_orderkey AS request_id, 'profile-' || o_custkey % 4 AS profile_id, CASE o_orderkey % 3 WHEN 0 THEN 'features.latest-state' WHEN 1 THEN 'telemetry.raw.sensor' ELSE 'telemetry.raw.gps' END AS product_id FROM orders"
PROFILES = "SELECT 'profile-' || n_nationkey AS profile_id, {list} AS default_access FROM nation"


@query(f"""SELECT request_id, product_id FROM ({PROFILED}) r WHERE product_id = 'telemetry.raw.gps'
  OR (product_id = 'telemetry.raw.sensor' AND profile_id IN ('profile-0', 'profile-2'))""")
def denied_raw_access(spark, sf_dir):
    """Requests for products that the profile does not open."""
    profiles = PROFILES.format(
        list="CASE WHEN n_nationkey % 2 = 0 THEN array('features.latest-state') "
        "ELSE array('features.latest-state', 'telemetry.raw.sensor') END"
    )
    rows = governance.denied_raw_access(
        spark.sql(PROFILED.replace("FROM orders", "FROM {t}"), t=views.table(spark, sf_dir, "orders")),
        spark.sql(profiles.replace("FROM nation", "FROM {t}"), t=views.table(spark, sf_dir, "nation")),
    )
    return rows.select("request_id", "product_id")


GATES = "SELECT o_orderkey AS gate_id, {list} AS required_artifacts FROM orders"
ARTIFACTS = "'art-' || o_custkey, 'art-' || (o_custkey + 1), 'art-' || o_orderkey"
HELD = "SELECT 'art-' || c_custkey AS artifact_id, CASE WHEN c_nationkey < 20 THEN 'approved' ELSE 'draft' END AS status FROM customer"


@query(f"""SELECT gate_id, bool_and(ok) AS is_open, count(*) FILTER (NOT ok) AS n_missing, count(*) AS n_required FROM
  (SELECT gate_id, coalesce(status = 'approved', false) AS ok FROM (SELECT gate_id, unnest(required_artifacts) AS artifact_id
  FROM ({GATES.format(list='[' + ARTIFACTS + ']')}) g) n LEFT JOIN ({HELD}) h USING (artifact_id)) x GROUP BY 1""")
def legal_gates(spark, sf_dir):
    """Gates with the number of artefacts that are not approved."""
    gates = GATES.format(list="array(" + ARTIFACTS + ")").replace("FROM orders", "FROM {t}")
    return governance.legal_gates(
        spark.sql(gates, t=views.table(spark, sf_dir, "orders")),
        spark.sql(HELD.replace("FROM customer", "FROM {t}"), t=views.table(spark, sf_dir, "customer")),
    )


STATUSES = ("implemented", "partial", "todo", "blocked")
COUNTED = ", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in STATUSES)


@query(f"""SELECT regulation, {COUNTED}, count(*) AS n_controls FROM (SELECT *, row_number() OVER (PARTITION BY regulation, control_id
  ORDER BY assessed_us DESC, seq DESC, price DESC) AS r FROM {ASSESSMENTS} a) x WHERE r = 1 GROUP BY 1""")
def control_rollup(spark, sf_dir):
    """Latest control states per regulation."""
    rows = views.view(spark, sf_dir, views.assessments)
    return governance.control_rollup(rows, STATUSES, ["assessed_us", "seq", "price"])


CHANNEL = "SELECT o_orderkey AS access_id, {list} AS evidence_topics FROM orders"
STEPS = "'dataact.user.access.requests', 'dataact.legal_basis.checks', 'dataact.user.exports'"
RECORDED = """SELECT l_orderkey AS access_id, CASE l_linenumber % 3 WHEN 0 THEN 'dataact.user.access.requests'
  WHEN 1 THEN 'dataact.legal_basis.checks' ELSE 'dataact.user.exports' END AS topic FROM lineitem"""


@query(f"""SELECT access_id, topic FROM (SELECT access_id, unnest(evidence_topics) AS topic FROM ({CHANNEL.format(list='[' + STEPS + ']')}) c) n
  WHERE NOT EXISTS (SELECT 1 FROM ({RECORDED}) r WHERE r.access_id = n.access_id AND r.topic = n.topic)""")
def evidence_gaps(spark, sf_dir):
    """Steps of an access without a record."""
    needed = CHANNEL.format(list="array(" + STEPS + ")").replace("FROM orders", "FROM {t}")
    return governance.evidence_gaps(
        spark.sql(needed, t=views.table(spark, sf_dir, "orders")),
        spark.sql(RECORDED.replace("FROM lineitem", "FROM {t}"), t=views.table(spark, sf_dir, "lineitem")),
        ["access_id"],
    ).select("access_id", "topic")
