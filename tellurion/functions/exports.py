"""Release rights, identifiers and metadata of dataset exports.

Columns read: dataset fields (``dataset_id, title, dataset_type,
classification, access_mode, dmp_id``) and request fields prefixed ``req_``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rights, error codes, gate names and texts that records carry.
NOT_OPEN = ("internal", "restricted", "personal", "sensitive", "mixed")
DEPOSIT_RIGHTS = ("open", "restricted", "embargoed")
DISCOVERY_RIGHTS = ("open", "restricted", "closed")
OPEN_BLOCKED = "open_release_blocked"
LEGAL_REQUIRED = "legal_review_required"
DISCOVERY_BLOCKED = "open_metadata_release_blocked"
BAD_LANDING_PAGE = "invalid_landing_page_url"
UNKNOWN_DATASET = "dataset_not_found"
NO_DATASET = "missing_dataset_id"
RIGHTS = {
    "open": ("Open Access", "info:eu-repo/semantics/openAccess"),
    "closed": ("Closed Access", "info:eu-repo/semantics/closedAccess"),
    "restricted": ("Restricted Access", "info:eu-repo/semantics/restrictedAccess"),
}
DISCOVERY_SCHEMA = "OpenAIRE Guidelines for Data Archives / DataCite"
EVIDENCE_TOPIC = "governance.repository.exports"
DEPOSIT_GATES = (
    "dataset catalogue record approved",
    "Data Management Plan active or approved",
    "GDPR legal basis and DPIA reviewed where personal data is present",
    "Data Act user entitlement and third-party safeguards reviewed",
    "DGA research protocol, ethics status and disclosure review completed",
    "raw GPS, media or personal datasets are not released openly by default",
)
DISCOVERY_GATES = (
    "dataset catalogue record approved",
    "Data Management Plan active or approved",
    "metadata access right reflects the dataset classification",
    "GDPR legal basis and DPIA reviewed where personal data is present",
    "Data Act, DGA and legal dossier gates reviewed before public discovery",
)
DEPOSIT_ENDING = ".zenodo-manifest.json"
DISCOVERY_XML_ENDING = ".openaire-datacite.xml"
DISCOVERY_ENDING = ".openaire-manifest.json"


@dataclass(frozen=True)
class Publisher:
    """Who publishes: names and defaults that a deployment sets."""

    name: str = "Research Data Platform"
    project: str = "Platform"
    affiliation: str = "Research Data Platform"
    keyword: str = "telemetry"
    licence: str = "cc-by-4.0"
    language: str = "en"
    landing_base: str = ""


def _given(column: str) -> Column:
    """A request text, NULL when absent or empty."""
    return F.nullif(F.col(column), F.lit(""))


def deposit_right() -> Column:
    """Access right in a deposit repository: the one asked for, else derived."""
    asked, mode = F.col("req_access_right"), F.col("access_mode")
    return (
        F.when(asked.isin(*DEPOSIT_RIGHTS), asked)
        .when((mode == "open") & (F.col("classification") == "public"), F.lit("open"))
        .when(mode == "embargoed", F.lit("embargoed"))
        .otherwise(F.lit("restricted"))
    )


def discovery_right() -> Column:
    """Access right in a discovery catalogue, which knows no embargo."""
    asked = F.col("req_access_right")
    public = (F.col("classification") == "public") & (F.col("access_mode") == "open")
    return (
        F.when(asked.isin(*DISCOVERY_RIGHTS), asked)
        .when(public, F.lit("open"))
        .otherwise(F.lit("restricted"))
    )


def rights_label(right: Column) -> Column:
    """Label and address of an access right."""
    cases = [
        F.when(right == name, F.struct(F.lit(label).alias("rights"), F.lit(uri).alias("rights_uri")))
        for name, (label, uri) in RIGHTS.items()
        if name != "restricted"
    ]
    label, uri = RIGHTS["restricted"]
    return F.coalesce(*cases, F.struct(F.lit(label).alias("rights"), F.lit(uri).alias("rights_uri")))


def _open_but_not_public(right: Column) -> Column:
    return (right == "open") & F.col("classification").isin(*NOT_OPEN)


def deposit_gate_error(right: Column) -> Column:
    """Code of the first release gate a deposit fails, NULL when it may go on."""
    publish = F.coalesce(F.col("req_publish"), F.lit(False))
    reviewed = F.coalesce(F.col("req_legal_review_approved"), F.lit(False))
    return F.when(_open_but_not_public(right), F.lit(OPEN_BLOCKED)).when(
        publish & ~reviewed, F.lit(LEGAL_REQUIRED)
    )


def landing_page(publisher: Publisher) -> Column:
    asked = _given("req_landing_page_url")
    if not publisher.landing_base:
        return asked
    base = publisher.landing_base.rstrip("/") + "/"
    return F.coalesce(asked, F.concat(F.lit(base), F.col("dataset_id")))


def identifier(publisher: Publisher) -> Column:
    """Identifier with its type: DOI, else landing page, else the dataset id."""
    doi = F.trim(F.col("req_doi"))
    page = landing_page(publisher)
    bare = F.regexp_replace(doi, "^https://doi\\.org/", "")

    def pair(value: Column, kind: str) -> Column:
        return F.struct(value.alias("identifier"), F.lit(kind).alias("identifier_type"))

    return (
        F.when(doi != "", pair(bare, "DOI"))
        .when(page.isNotNull(), pair(page, "URL"))
        .otherwise(pair(F.col("dataset_id"), "Other"))
    )


def discovery_gate_error(right: Column, publisher: Publisher) -> Column:
    """Code of the first gate a discovery record fails.

    The landing page matters only when it identifies the dataset.
    """
    page = landing_page(publisher)
    by_page = F.coalesce(F.trim(F.col("req_doi")), F.lit("")) == ""
    return F.when(_open_but_not_public(right), F.lit(DISCOVERY_BLOCKED)).when(
        by_page & page.isNotNull() & ~F.lower(page).startswith("https:"), F.lit(BAD_LANDING_PAGE)
    )


def publication_year(as_of: Column) -> Column:
    asked = F.col("req_publication_year")
    return F.when(asked.rlike("^[0-9]{4}$"), asked).otherwise(F.date_format(as_of, "yyyy"))


def creators(publisher: Publisher) -> Column:
    """Named creators of the request, else the publisher."""
    named = F.filter("req_creators", lambda c: F.coalesce(c["name"], F.lit("")) != "")
    default = F.array(
        F.struct(
            F.lit(publisher.name).alias("name"), F.lit(publisher.affiliation).alias("affiliation")
        )
    )
    return F.when(F.size(named) > 0, named).otherwise(default)


def description(kind: str, plan: Column, closing: str) -> Column:
    return F.concat(
        F.lit(f"{kind} for "), F.col("dataset_id"),
        F.lit(". Classification: "), F.col("classification"),
        F.lit(". Access mode: "), F.col("access_mode"),
        F.lit(". Linked Data Management Plan: "), F.coalesce(plan, F.lit("missing")),
        F.lit(". " + closing),
    )


def keywords(publisher: Publisher) -> Column:
    return F.array(
        F.lit(publisher.keyword), F.lit("IoT"), F.lit("research data"),
        F.col("dataset_type"), F.col("classification"),
    )


def deposit_metadata(right: Column, plan: Column, as_of: Column, publisher: Publisher) -> Column:
    """Metadata of a deposit: a licence when open, else conditions of access."""
    is_open = right == "open"
    conditions = (
        "Files are restricted until dataset catalogue, DMP, privacy, Data Act and DGA "
        "release checks are approved."
    )
    closing = (
        "This export must follow the dataset catalogue, DMP, GDPR legal-basis, "
        "Data Act and DGA release gates before publication."
    )
    return F.struct(
        F.coalesce(_given("req_title"), F.col("title")).alias("title"),
        F.lit("dataset").alias("upload_type"),
        F.coalesce(
            _given("req_description"), description(f"{publisher.project} dataset export", plan, closing)
        ).alias("description"),
        creators(publisher).alias("creators"),
        F.coalesce(
            _given("req_publication_date"), F.date_format(as_of, "yyyy-MM-dd")
        ).alias("publication_date"),
        right.alias("access_right"),
        keywords(publisher).alias("keywords"),
        F.lit(
            f"Generated by the {publisher.project} management console. "
            f"Evidence topic: {EVIDENCE_TOPIC}."
        ).alias("notes"),
        F.when(is_open, F.coalesce(_given("req_license"), F.lit(publisher.licence))).alias("license"),
        F.when(~is_open, F.coalesce(_given("req_access_conditions"), F.lit(conditions))).alias(
            "access_conditions"
        ),
        F.col("req_communities").alias("communities"),
    )


def related_identifiers(pairs: Column) -> Column:
    """Related identifiers that have all three parts."""
    def full(item: Column) -> Column:
        names = ("identifier", "identifier_type", "relation_type")
        present = [F.coalesce(item[n], F.lit("")) != "" for n in names]
        return present[0] & present[1] & present[2]

    return F.filter(pairs, full)


def plan_relation() -> Column:
    return F.array(
        F.struct(
            F.coalesce(F.col("dmp_id"), F.lit("")).alias("identifier"),
            F.lit("Local").alias("identifier_type"),
            F.lit("IsDocumentedBy").alias("relation_type"),
        )
    )


def discovery_metadata(right: Column, plan: Column, as_of: Column, publisher: Publisher) -> Column:
    """Metadata of a discovery record."""
    named = identifier(publisher)
    label = rights_label(right)
    closing = (
        "This record is intended for OpenAIRE discovery and must not override "
        "dataset catalogue, DMP, GDPR, Data Act or DGA release gates."
    )
    formats = F.when(F.size("req_formats") > 0, F.col("req_formats"))
    return F.struct(
        F.lit(DISCOVERY_SCHEMA).alias("schema"),
        named["identifier"].alias("identifier"),
        named["identifier_type"].alias("identifier_type"),
        creators(publisher).alias("creators"),
        F.coalesce(_given("req_title"), F.col("title")).alias("title"),
        F.coalesce(_given("req_publisher"), F.lit(publisher.name)).alias("publisher"),
        publication_year(as_of).alias("publication_year"),
        keywords(publisher).alias("subjects"),
        F.lit("Dataset").alias("resource_type"),
        F.lit("Dataset").alias("resource_type_general"),
        F.coalesce(_given("req_language"), F.lit(publisher.language)).alias("language"),
        F.coalesce(formats, F.array(F.lit("application/json"))).alias("formats"),
        label["rights"].alias("rights"),
        label["rights_uri"].alias("rights_uri"),
        F.coalesce(
            _given("req_description"), description(f"{publisher.project} metadata export", plan, closing)
        ).alias("description"),
        plan_relation().alias("related_identifiers"),
        right.alias("access_right"),
        landing_page(publisher).alias("landing_page_url"),
    )


def datacite(metadata: Column, as_of: Column) -> Column:
    """A discovery record in the shape of the DataCite XML schema."""
    def attributed(value: Column, **attributes: Column | str) -> Column:
        parts = [value.alias("_VALUE")]
        for name, content in attributes.items():
            column = content if isinstance(content, Column) else F.lit(content)
            parts.append(column.alias(f"_{name}"))
        return F.struct(*parts)

    m = metadata
    people = F.transform(
        m["creators"],
        lambda c: F.struct(
            c["name"].alias("creatorName"),
            F.nullif(c["affiliation"], F.lit("")).alias("affiliation"),
        ),
    )
    related = F.transform(
        related_identifiers(m["related_identifiers"]),
        lambda r: F.struct(
            r["identifier"].alias("_VALUE"),
            r["identifier_type"].alias("_relatedIdentifierType"),
            r["relation_type"].alias("_relationType"),
        ),
    )
    return F.struct(
        F.lit("http://datacite.org/schema/kernel-4").alias("_xmlns"),
        attributed(m["identifier"], identifierType=m["identifier_type"]).alias("identifier"),
        F.struct(people.alias("creator")).alias("creators"),
        F.struct(m["title"].alias("title")).alias("titles"),
        m["publisher"].alias("publisher"),
        m["publication_year"].alias("publicationYear"),
        F.struct(m["subjects"].alias("subject")).alias("subjects"),
        m["language"].alias("language"),
        attributed(
            m["resource_type"], resourceTypeGeneral=m["resource_type_general"]
        ).alias("resourceType"),
        F.struct(
            attributed(F.date_format(as_of, "yyyy-MM-dd"), dateType="Issued").alias("date")
        ).alias("dates"),
        F.struct(m["formats"].alias("format")).alias("formats"),
        F.struct(attributed(m["rights"], rightsURI=m["rights_uri"]).alias("rights")).alias(
            "rightsList"
        ),
        F.struct(
            attributed(m["description"], descriptionType="Abstract").alias("description")
        ).alias("descriptions"),
        F.when(F.size(related) > 0, F.struct(related.alias("relatedIdentifier"))).alias(
            "relatedIdentifiers"
        ),
    )
