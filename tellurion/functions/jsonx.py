"""JSON documents as VARIANT columns: strict parsing, presence, truthiness.

A missing key is SQL NULL; a key that holds JSON null is a non-NULL variant.
``coalesce`` over :func:`field` therefore stops at the first key that is
present, whatever its value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER_KINDS = "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"


def json_path(name: str) -> str:
    return f'$["{name}"]'


def field(document: Column, name: str) -> Column:
    """The value of one key, NULL when the key is absent."""
    return F.try_variant_get(document, json_path(name), "variant")


def members(document: str, names: Iterable[str]) -> Column:
    """Several keys of an object as a struct of variants, read in one pass.

    NULL when the document is not an object; a member is NULL when absent.
    """
    shape = ", ".join(f"`{name}`: variant" for name in names)
    return F.expr(f"try_variant_get({document}, '$', 'struct<{shape}>')")


def fields_of(document: Column) -> Column:
    """All keys with their values; NULL when the document is not an object."""
    return F.try_variant_get(document, "$", "map<string,variant>")


def with_document(rows: DataFrame, name: str, text: str) -> DataFrame:
    """Parse a text, given as SQL, that must be one whole JSON document, NULL otherwise.

    ``try_parse_json`` ignores what follows the first document. Text that ends
    early cannot close both an array and an object around it, so both wrapped
    forms must parse and must hold exactly one entry. Each is parsed once: the
    wrapped forms are columns of their own before they are read.
    """
    wrapped = rows.withColumns(
        {
            "_array": F.expr(f"try_parse_json('[' || ({text}) || ']')"),
            "_keys": F.size(fields_of(F.expr(f"""try_parse_json('{{"v":' || ({text}) || '}}')"""))),
        }
    )
    single = "try_variant_get(_array, '$[1]', 'variant') IS NULL AND _keys = 1"
    document = f"CASE WHEN {single} THEN try_variant_get(_array, '$[0]', 'variant') END"
    return wrapped.withColumn(name, F.expr(document)).drop("_array", "_keys")


def is_object(document: Column) -> Column:
    """True for a JSON object; reads no more than the header of the value."""
    return F.try_variant_get(document, "$", "struct<a:variant>").isNotNull()


def kind(document: Column) -> Column:
    """Type name of a value: VOID for JSON null, NULL when absent."""
    return F.schema_of_variant(document)


def as_string(document: Column) -> Column:
    return F.try_variant_get(document, "$", "string")


def as_double(document: Column) -> Column:
    return F.try_variant_get(document, "$", "double")


def truthy(value: str, kind: str | None = None) -> Column:
    """Whether a value counts as true: not null, zero, false or empty.

    Arguments are SQL text; ``kind`` is the type name where it is known already.
    """
    kind = kind or f"schema_of_variant({value})"
    return F.expr(
        f"""CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN false
          WHEN {kind} = 'STRING' THEN try_variant_get({value}, '$', 'string') <> ''
          WHEN {kind} = 'BOOLEAN' THEN try_variant_get({value}, '$', 'boolean')
          WHEN startswith({kind}, 'OBJECT') THEN {kind} <> 'OBJECT<>'
          WHEN startswith({kind}, 'ARRAY') THEN try_variant_get({value}, '$[0]', 'variant') IS NOT NULL
          ELSE try_variant_get({value}, '$', 'double') <> 0 END"""
    )


def text(value: str, kind: str | None = None) -> Column:
    """A value as a string: strings bare, booleans capitalised, the rest as JSON."""
    kind = kind or f"schema_of_variant({value})"
    return F.expr(
        f"""CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN NULL
          WHEN {kind} = 'STRING' THEN try_variant_get({value}, '$', 'string')
          WHEN {kind} = 'BOOLEAN' THEN initcap(try_variant_get({value}, '$', 'string'))
          ELSE to_json({value}) END"""
    )


def document(**columns: Column) -> Column:
    """A JSON object built from named columns; NULL columns become JSON null."""
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in columns.items()]))


def to_text(value: Column) -> Column:
    """Compact JSON of a struct with its fields in order, nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def with_decoded(rows: DataFrame, name: str, payload: str = "payload") -> DataFrame:
    """Message bytes as a JSON document, or wrapped in base64 when they are not."""
    raw = f"CAST({payload} AS STRING)"
    parsed = with_document(rows, "_parsed", f"CASE WHEN is_valid_utf8({raw}) THEN {raw} END")
    # The encoder may break lines, depending on a session setting.
    encoded = F.translate(F.base64(payload), "\r\n", "")
    return parsed.withColumn(name, F.coalesce("_parsed", document(payload_b64=encoded))).drop(
        "_parsed"
    )
