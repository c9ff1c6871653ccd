"""Records against their declared contracts, as a table of violations.

The contract is data: each record gives one row per field, which meets the
contract row of its topic and field. Contract tables hold a few hundred rows
whatever the size of the records and are broadcast: a join by shuffle would send every
field of every record to one task per topic and field.
Objects with a contract of their own, alone or as items, are records of the next
level: their fields are named by their path, ``Records[0].s3.bucket.name``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions import jsonx
from tellurion.functions.once import with_once
from tellurion.sources import registry

DATE_TIME = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
)
DATE = r"^\d{4}-\d{2}-\d{2}$"


def _other_than_text(value: Column, kind: Column) -> Column:
    """Whether an array has an item that is no string; its kind does not tell null items."""
    items = F.try_variant_get(value, "$", "array<variant>")
    found = F.exists(items, lambda x: x.isNull() | (jsonx.kind(x) != "STRING"))
    return F.when(kind.startswith("ARRAY"), F.coalesce(found, F.lit(True)))


def _type_holds(value: Column, kind: Column, declared: Column) -> Column:
    number = kind.rlike(jsonx.NUMBER_KINDS)
    whole = number & (jsonx.as_double(value) == F.floor(jsonx.as_double(value)))
    is_array = kind.startswith("ARRAY")
    return (
        F.when(declared.isin("string", "timestamp", "date"), kind == "STRING")
        .when(declared == "integer", whole)
        .when(declared == "number", number)
        .when(declared == "boolean", kind == "BOOLEAN")
        .when(declared == "array<string>", is_array & ~_other_than_text(value, kind))
        .when(declared == "array", is_array)
        .otherwise(kind.startswith("OBJECT"))
    )


def _broken_rules() -> Column:
    value, kind, declared = F.col("_value"), F.col("_kind"), F.col("type")
    known, present = declared.isNotNull(), value.isNotNull()
    typed = _type_holds(value, kind, declared)
    text = jsonx.as_string(value)
    number = F.when(kind.rlike(jsonx.NUMBER_KINDS), jsonx.as_double(value))
    listed = F.try_variant_get(value, "$", "array<variant>")
    items = F.size(listed)
    timestamp_ok = text.rlike(DATE_TIME) & F.try_to_timestamp(text).isNotNull()
    date_ok = text.rlike(DATE) & F.try_to_date(text).isNotNull()

    def unlisted(item: Column) -> Column:
        return ~F.coalesce(F.array_contains("item_enum", jsonx.as_string(item)), F.lit(False))

    def rule(failed: Column, name: str) -> Column:
        return F.when(failed, F.lit(name)).otherwise("")

    return F.array_remove(
        F.array(
            rule(F.col("_broken"), "object"),
            rule(known & ~present, "required"),
            rule(~known & present & F.col("closed"), "additionalProperties"),
            rule(known & present & ~typed, "type"),
            rule(
                typed & F.col("enum").isNotNull() & ~F.array_contains("enum", text)
                | typed & F.col("item_enum").isNotNull() & F.exists(listed, unlisted),
                "enum",
            ),
            rule(
                typed & (declared == "timestamp") & ~timestamp_ok
                | typed & (declared == "date") & ~date_ok,
                "format",
            ),
            rule(number < F.col("minimum"), "minimum"),
            rule(number > F.col("maximum"), "maximum"),
            rule(number <= F.col("above"), "exclusiveMinimum"),
            rule(typed & declared.startswith("array") & (items < F.col("min_items")), "minItems"),
        ),
        "",
    )


def violations(
    records: DataFrame,
    fields: DataFrame,
    topics: DataFrame,
    value: str = "value",
    record_id: str = "record_id",
) -> DataFrame:
    """Rows ``topic, record_id, field, rule`` for every broken rule.

    ``records`` has ``topic`` and the record as text. A text that is no JSON
    object breaks the rule ``object``, as does an item that should be an object and is
    none. Topics without a contract break nothing. A level of nested contracts reads
    the records of topics that have one again; others are read once.
    """
    known = records.select(
        "topic", F.col(record_id).alias("record_id"), F.col(value).alias("_text")
    )
    depth = _depth(fields)
    rules = []
    for level in range(depth + 1):
        # Records that have no object at this level are left out before they are parsed.
        kept = topics if level == 0 else topics.join(_topics_of_depth(fields, level), "topic", "left_semi")
        parsed = jsonx.with_document(known.join(F.broadcast(kept), "topic"), "_document", "_text")
        objects = parsed.select(
            F.col("topic").alias("_root"), "topic", "record_id", F.lit("").alias("_path"),
            "closed", "required_fields", "_document",
        )
        for _ in range(level):
            objects = _inside(_members(objects), fields, topics)
        named = _members(objects).join(F.broadcast(fields), ["topic", "field"], "left")
        checked = named.withColumn("_kind", jsonx.kind(F.col("_value")))
        path = F.when(F.col("_broken"), F.rtrim("_path", F.lit("."))).otherwise(F.concat("_path", "field"))
        rules.append(
            checked.select(F.col("_root").alias("topic"), "record_id", path.alias("field"), F.explode(_broken_rules()).alias("rule"))
        )
    found = rules[0]
    for more in rules[1:]:
        found = found.unionByName(more)
    return found


def _depth(fields: DataFrame) -> int:
    """How deep contracts lie in contracts."""
    deep = F.size(F.split("nested", registry.NESTED)) - 1
    return fields.agg(F.coalesce(F.max(F.when(F.col("nested").isNotNull(), deep)), F.lit(0))).first()[0]


def _topics_of_depth(fields: DataFrame, level: int) -> DataFrame:
    parts = F.split("nested", registry.NESTED)
    deep = fields.where(F.col("nested").isNotNull() & (F.size(parts) > level))
    return deep.select(parts[0].alias("topic")).distinct()


def _members(objects: DataFrame) -> DataFrame:
    """One row per field of an object, and per required field that it lacks."""
    parsed = with_once(objects, "_map", jsonx.fields_of(F.col("_document")))
    # Required fields that are absent join the others without a value, so that one
    # pass over the fields of a record finds all its violations.
    missing = F.array_except("required_fields", F.map_keys("_map"))
    absent = F.map_from_arrays(
        missing, F.array_repeat(F.lit(None).cast("variant"), F.size(missing))
    )
    nothing = F.create_map(F.lit(""), F.lit(None).cast("variant"))
    return parsed.select(
        "_root",
        "topic",
        "record_id",
        "_path",
        "closed",
        F.col("_map").isNull().alias("_broken"),
        F.explode(F.coalesce(F.map_concat("_map", absent), nothing)).alias("field", "_value"),
    )


def _inside(members: DataFrame, fields: DataFrame, topics: DataFrame) -> DataFrame:
    """The objects in fields with a contract of their own, as records of that contract."""
    holding = fields.where(F.col("nested").isNotNull()).select("topic", "field", "type", "nested")
    held = members.join(F.broadcast(holding), ["topic", "field"])
    is_list = F.col("type").startswith("array")
    items = F.when(is_list, F.try_variant_get("_value", "$", "array<variant>")).when(
        jsonx.is_object(F.col("_value")), F.array("_value")
    )
    place = F.when(is_list, F.format_string("[%d].", "_place")).otherwise(".")
    opened = held.select("*", F.posexplode(items).alias("_place", "_document")).select(
        "_root", F.col("nested").alias("topic"), "record_id",
        F.concat("_path", "field", place).alias("_path"), "_document",
    )
    return opened.join(F.broadcast(topics.select("topic", "closed", "required_fields")), "topic")
