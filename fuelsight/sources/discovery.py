"""JSON lines whose schema is not known (S2): found by one aggregate over variants, with what does not fit set apart.

Each line is parsed once into a VARIANT; its top-level fields are exploded and counted by type with partial
aggregates, so what comes to the driver is one row per field.  A field's column type is the least that holds its
values: whole numbers, numbers, booleans, text, or JSON (objects and arrays).  Where types are mixed, a field is a number if at least
``NUMERIC_SHARE`` of its values are numbers or spell one, else text; nothing is dropped: a value that its column cannot hold
is named in ``drift``, and the line stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC_SHARE = 0.5
MAX_FIELDS = 10_000

_FAMILY = """CASE WHEN t = 'BIGINT' THEN 'whole' WHEN t LIKE 'DECIMAL%' OR t IN ('DOUBLE', 'FLOAT') THEN 'number' WHEN t = 'BOOLEAN' THEN 'boolean'
  WHEN t = 'VOID' THEN 'null' WHEN t = 'STRING' THEN 'string' ELSE 'nested' END"""


def fields(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per top-level field of each line that is a JSON object: ``key``, ``type`` (family) and ``text``."""
    parsed = lines.select(F.try_parse_json(F.col(col).cast("string")).alias("_v")).where("schema_of_variant(_v) LIKE 'OBJECT%'")
    view = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    return (view.select("key", F.col("value").alias("_x"), F.schema_of_variant("value").alias("t"))
            .select("key", F.expr(_FAMILY).alias("type"), F.variant_get("_x", "$", "string").alias("text")))


def field_types(lines: DataFrame, col: str = "value") -> DataFrame:
    """How often each field has each type: ``key, type, n`` (strings that spell a number are ``numeric_string``)."""
    kind = F.when((F.col("type") == "string") & F.col("text").try_cast("double").isNotNull(), "numeric_string").otherwise(F.col("type"))
    return fields(lines, col).groupBy("key", kind.alias("type")).agg(F.count("*").alias("n"))


def choose(counts: dict[str, int], numeric_share: float = NUMERIC_SHARE) -> str:
    """The column type of a field from the counts of its types."""
    n = {k: c for k, c in counts.items() if k != "null" and c}
    total = sum(n.values())
    if not total:
        return "string"
    numbers = n.get("whole", 0) + n.get("number", 0)
    if set(n) == {"whole"}:
        return "bigint"
    if set(n) == {"boolean"}:
        return "boolean"
    if numbers and numbers + n.get("numeric_string", 0) >= numeric_share * total:
        return "double"
    return "string"


def discover(lines: DataFrame, col: str = "value", numeric_share: float = NUMERIC_SHARE, max_fields: int = MAX_FIELDS) -> dict[str, str]:
    """Column types by field.  Lines with more than ``max_fields`` different names (ids as keys) have no table schema: an error."""
    per_field = field_types(lines, col).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("types"))
    rows = per_field.limit(max_fields + 1).collect()
    if len(rows) > max_fields:
        raise ValueError(f"more than {max_fields} different fields: read them as VARIANT")
    return {r.key: choose(r.types, numeric_share) for r in sorted(rows, key=lambda r: r.key)}


def _text(key: str) -> Column:
    """A field of the parsed line as text; a path cannot escape a quote, so odd names go through a map."""
    if "'" in key or "\\" in key:
        return F.try_variant_get(F.try_variant_get("_v", "$", "map<string,variant>")[key], "$", "string")
    return F.try_variant_get("_v", f"$['{key}']", "string")


def read_lines(lines: DataFrame, schema: dict[str, str], col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the lines that are no JSON object.

    A row has a column per field, ``drift`` (names of fields whose value its column cannot hold) and ``extra`` (names of fields
    that the schema does not have).
    """
    v = F.try_parse_json(F.col(col).cast("string"))
    parsed = lines.withColumn("_v", v).withColumn("_object", F.coalesce(F.schema_of_variant("_v").like("OBJECT%"), F.lit(False)))

    def typed(key: str, kind: str) -> Column:
        return _text(key) if kind == "string" else _text(key).try_cast(kind)

    lost = [F.when(typed(k, t).isNull() & _text(k).isNotNull(), F.lit(k)) for k, t in schema.items()]
    names = F.map_keys(F.try_variant_get("_v", "$", "map<string,variant>"))
    rows = parsed.where("_object").select(
        *[typed(k, t).alias(k) for k, t in schema.items()], F.array_compact(F.array(*lost) if lost else F.array().cast("array<string>")).alias("drift"),
        F.array_except(names, F.array(*[F.lit(k) for k in schema]) if schema else F.array().cast("array<string>")).alias("extra"))
    return rows, parsed.where("NOT _object").drop("_v", "_object")
