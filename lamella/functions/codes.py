"""Culture codes in captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name spaces of culture codes and how a code of each is written.
CODES = {
    "CPHST_BL": r"\bCPHST\s+BL\s*(?:[-:]\s*)?(\d+[A-Za-z]?)\b",
    "CBS": r"\bCBS\s+(\d+(?:\.\d+)?)\b",
    "P": r"\bP(\d+)\b",
    "PH": r"\bPH\s?(\d+)\b",
    "SE": r"\bSE\s+(\d+)\b",
    "CH": r"\bCH(\d+[A-Z]+\d+)\b",
    "GF": r"\bGF(\d+)\b",
    "TOKU": r"\bToku(\d+)\b",
    "VI": r"\bVI\s+(\d+-[A-Z0-9]+)\b",
    "AKWA": r"\bAKWA\s*(\d+(?:\.\d+)?-\d+)\b",
    "RHS": r"\bRHS\s+(\d+(?:\.\d+)?)\b",
}


def references(text: Column, codes: dict[str, str] = CODES) -> Column:
    """namespace, identifier, matched_text of every code in a text, by name space and place. Case does not matter in
    matching and is kept in what is found."""

    def of(space: str, pattern: str) -> Column:
        p = F.lit("(?iU)" + pattern)
        identifiers, whole = F.regexp_extract_all(text, p, F.lit(1)), F.regexp_extract_all(text, p, F.lit(0))
        return F.zip_with(identifiers, whole, lambda i, m: F.struct(F.lit(space).alias("namespace"), i.alias("identifier"), m.alias("matched_text")))

    return F.concat(*(of(*x) for x in codes.items()))


def caption_references(captions: DataFrame, *keys: str) -> DataFrame:
    """One row for each code: the keys, source_field, namespace, identifier, relationship_key, matched_text of a table with
    keys, source_field and caption."""
    return captions.select(*keys, "source_field", F.explode(references(F.col("caption"))).alias("r")).select(
        *keys, "source_field", "r.namespace", "r.identifier", F.concat_ws(":", F.lit("idphy:culture"), "r.namespace", "r.identifier").alias("relationship_key"), "r.matched_text"
    )
