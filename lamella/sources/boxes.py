"""Annotation boxes: one text per image, a line of class and four numbers per box."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOX = "yolo_cxcywh_normalized"


def boxes(texts: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """keys, line (from 1), class_id, coordinates, error: one row for each line that is not blank. error names what is wrong
    with it. Lines become rows first, so that everything else is plain columns."""
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text), r"\r\n|\r|\n")).alias("pos", "one")).select(
        *keys, (F.col("pos") + 1).alias("line"), F.split(F.trim(F.regexp_replace("one", r"\s+", " ")), " ").alias("t")
    ).filter(F.get("t", F.lit(0)) != "")
    number = lambda i: F.get("t", F.lit(i)).try_cast("double")
    parsed = lines.select(*keys, "line", F.size("t").alias("n"), F.get("t", F.lit(0)).try_cast("int").alias("class_id"), *(number(i).alias(f"c{i}") for i in range(1, 5)))
    values = [F.col(f"c{i}") for i in range(1, 5)]
    missing = F.lit(False)
    outside = F.lit(False)
    for i, v in enumerate(values, 1):
        missing = missing | ((F.col("n") > i) & v.isNull())
        outside = outside | ~(v.between(0, 1) & ~F.isnan(v))
    error = (
        F.when(F.col("n") != 5, "token_count").when(F.col("class_id").isNull() | missing, "not_a_number").when(outside, "outside").when((values[2] <= 0) | (values[3] <= 0), "empty_box")
    )
    present = F.least(F.greatest(F.col("n") - 1, F.lit(0)), F.lit(4))
    return parsed.select(*keys, "line", "class_id", F.slice(F.array(*values), F.lit(1), present).alias("coordinates"), error.alias("error"))


def labelled_boxes(found: DataFrame, classes: DataFrame) -> DataFrame:
    """boxes with their class name; a class id that is not in classes (class_id, label) becomes an error."""
    joined = found.join(classes, "class_id", "left")
    return joined.withColumn("error", F.coalesce("error", F.when(F.col("label").isNull(), "unknown_class"))).withColumn("format", F.lit(BOX))
