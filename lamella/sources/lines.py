"""JSON lines, read strictly or leniently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lenient(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def line_error(line: Column, allowed: list[str] | None = None) -> Column:
    """What is wrong with a JSON line: blank, no JSON (a repeated key included), no object, or an unknown field."""
    parsed = F.try_parse_json(line)
    unknown = F.lit(False)
    if allowed is not None:
        unknown = F.size(F.array_except(F.coalesce(F.json_object_keys(line), F.array().cast("array<string>")), F.array(*(F.lit(a) for a in allowed)))) > 0
    return (
        F.when(F.trim(line) == "", "blank_line")
        .when(parsed.isNull(), "invalid_json")
        .when(~F.startswith(F.ltrim(line), F.lit("{")), "not_an_object")
        .when(unknown, "unknown_field")
    )


def read_strict(spark: SparkSession, path: str, schema: T.StructType | str, shown: int = 5) -> DataFrame:
    """The rows of a JSON-lines file; a bad line raises with its file and error. Values of the wrong type raise when read."""
    from lamella.operators.checks import require

    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    errors = lines.select("file", F.substring("value", 1, 80).alias("line"), line_error(F.col("value"), schema.fieldNames()).alias("error")).filter("error is not null")
    require(errors, f"bad lines in {path}", shown)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def typed_field(line: Column, field: str, kind: str) -> Column:
    """Whether a field of a JSON object has exactly this type (BIGINT, BOOLEAN, STRING…); a quoted number is no number."""
    return F.coalesce(F.schema_of_variant(F.variant_get(F.try_parse_json(line), f"$.{field}", "variant")) == kind, F.lit(False))
