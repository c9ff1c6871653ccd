"""Evidence contracts: read from schema documents or declared here by rule.

A contract is a small table ``(topic, field, type, required, enum, minimum,
maximum, above, min_items, item_enum, nested)``. It is data for
:mod:`tellurion.operators.conformance`. Objects inside a record, alone or as items of
an array, have contracts of their own, which the field that holds them names.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Field:
    """One field of a contract."""

    topic: str
    field: str
    type: str
    required: bool = False
    enum: tuple[str, ...] | None = None
    minimum: float | None = None
    maximum: float | None = None
    above: float | None = None
    min_items: int | None = None
    item_enum: tuple[str, ...] | None = None
    nested: str | None = None


@dataclass(frozen=True)
class Contract:
    topic: str
    fields: tuple[Field, ...]
    closed: bool = True
    #: Contracts of the objects in its fields.
    nested: tuple[Contract, ...] = ()

    def whole(self) -> list[Contract]:
        """The contract and all contracts inside it."""
        return [self, *(inner for contract in self.nested for inner in contract.whole())]


#: Stands between a contract and the field with a contract of its own.
NESTED = "#"
CONTRACT_SCHEMA = (
    "topic STRING, field STRING, type STRING, required BOOLEAN, enum ARRAY<STRING>, "
    "minimum DOUBLE, maximum DOUBLE, above DOUBLE, min_items INT, "
    "item_enum ARRAY<STRING>, nested STRING"
)
TOPIC_SCHEMA = "topic STRING, closed BOOLEAN, fields ARRAY<STRING>, required_fields ARRAY<STRING>"

_TYPES = {
    "string": "string", "integer": "integer", "number": "number",
    "boolean": "boolean", "array": "array", "object": "object",
}


def _type_of(spec: dict) -> str:
    name = _TYPES[spec["type"]]
    if name == "string" and spec.get("format") in ("date-time", "date"):
        return "timestamp" if spec["format"] == "date-time" else "date"
    if name == "array" and spec.get("items", {}).get("type") == "string":
        return "array<string>"
    return name


def from_json_schema(topic: str, document: str) -> Contract:
    """A contract from the text of one JSON Schema.

    The schema stands alone, under the key ``schema``, or as the registry keeps
    it: as text in the content of the first version of an artifact.
    """
    schema = json.loads(document)
    version = schema.get("firstVersion")
    inner = version["content"]["content"] if version else schema.get("schema")
    if inner is not None:
        schema = json.loads(inner) if isinstance(inner, str) else inner
    if not isinstance(schema.get("properties"), dict):
        raise ValueError(f"the document of {topic} has no properties")
    return _contract_of(topic, schema)


def _contract_of(topic: str, schema: dict) -> Contract:
    required = set(schema.get("required", ()))
    fields, nested = [], []
    for name, spec in schema["properties"].items():
        items = spec.get("items", {})
        inside = next((s for s in (spec, items) if isinstance(s.get("properties"), dict)), None)
        if inside is not None:
            nested.append(_contract_of(f"{topic}{NESTED}{name}", inside))
        enum, item_enum = spec.get("enum"), items.get("enum")
        fields.append(
            Field(
                topic, name, _type_of(spec), name in required,
                tuple(enum) if enum else None,
                spec.get("minimum"), spec.get("maximum"), spec.get("exclusiveMinimum"),
                spec.get("minItems"),
                tuple(item_enum) if item_enum else None,
                nested[-1].topic if inside is not None else None,
            )
        )
    return Contract(topic, tuple(fields), schema.get("additionalProperties") is False, tuple(nested))


def registered_contracts(spark: SparkSession, path: str) -> list[Contract]:
    """Contracts from a folder of ``<topic>.json`` registry payloads.

    A registry holds one small document per topic, so its size does not grow
    with the data.
    """
    rows = spark.read.text(path, wholetext=True).selectExpr(
        "regexp_extract(input_file_name(), '([^/]+)[.]json$', 1) AS topic", "value"
    )
    return [from_json_schema(r["topic"], r["value"]) for r in rows.orderBy("topic").toLocalIterator()]


def contract_table(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    rows = []
    for contract in (inner for outer in contracts for inner in outer.whole()):
        for f in contract.fields:
            values = asdict(f)
            for name in ("minimum", "maximum", "above"):
                values[name] = None if values[name] is None else float(values[name])
            for name in ("enum", "item_enum"):
                values[name] = None if values[name] is None else list(values[name])
            rows.append(values)
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def topic_table(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    rows = [
        (
            c.topic, c.closed, [f.field for f in c.fields],
            [f.field for f in c.fields if f.required],
        )
        for outer in contracts
        for c in outer.whole()
    ]
    return spark.createDataFrame(rows, TOPIC_SCHEMA)
