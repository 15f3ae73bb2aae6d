"""Rules for text and files that should not be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.paths import name

MAX_BYTES = 1 << 20
#: File name extensions of data and model artifacts.
ARTIFACTS = (
    "arrow", "avi", "bin", "bmp", "bz2", "ckpt", "csv", "gif", "gz", "h5", "hdf5", "heic", "jpeg", "joblib", "jpg", "jsonl", "keras", "m4v", "mov", "mp4", "npy", "npz", "onnx", "parquet", "pb", "pickle", "pkl", "png", "pt", "pth", "safetensors", "tar", "tflite", "tif", "tiff", "tsv", "webp", "xz", "zip", "7z",
)
#: The patterns of the six text rules.
TEXT_RULES = {
    "personal-machine-path": r"""(?i)/(?:Users|home)/[A-Za-z0-9._-]+(?:/|\b)|/(?:Volumes)/[A-Za-z0-9][^\r\n"'`<>]*|[A-Za-z]:[\\/](?:Users|Documents and Settings)[\\/][^\s\\/"']+""",
    "email-address": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "authenticated-url": r"(?i)https?://[^/\s@]+@",
    "private-key": r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----",
    "credential-token": r"gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|sk-[A-Za-z0-9_-]{20,}|AKIA[0-9A-Z]{16}|xox[baprs]-[A-Za-z0-9-]{10,}",
    "credential-assignment": r"""(?i)\b(?:password|passwd|api[_-]?key|secret|access[_-]?token|auth[_-]?token)\s*[:=]\s*["'][^"'\r\n]{8,}["']""",
}


def text_findings(text: Column) -> Column:
    """The rules a text breaks, in the order of TEXT_RULES."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(rule)) for rule, p in TEXT_RULES.items())))


def path_findings(path: Column) -> Column:
    """`dataset-or-model-artifact` where any of a name's extensions is one."""
    extensions = F.slice(F.split(F.lower(name(path)), r"\."), 2, 1000)
    return F.when(F.arrays_overlap(extensions, F.array(*(F.lit(x) for x in ARTIFACTS))), F.array(F.lit("dataset-or-model-artifact"))).otherwise(F.array().cast("array<string>"))


def content_findings(content: Column) -> Column:
    """The rules a file's bytes break; bytes that are no UTF-8 are held against no text rule."""
    text = F.decode(F.when(F.is_valid_utf8(content), content), "UTF-8")
    binary = F.when(F.instr(text, "\x00") > 0, F.array(F.lit("binary-file"))).otherwise(F.array().cast("array<string>"))
    return F.when(~F.is_valid_utf8(content), F.array(F.lit("non-UTF8-file"))).otherwise(F.concat(binary, text_findings(text)))


def file_findings(files: DataFrame, pinned: dict[str, str] | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """path, rule of a table (path, length, content): distinct, sorted. pinned: the SHA-256 that files of these paths must have
    instead of keeping the rules."""
    pins = F.create_map(*(F.lit(x) for pair in (pinned or {}).items() for x in pair)) if pinned else F.create_map().cast("map<string,string>")
    expected = F.try_element_at(pins, F.col("path"))
    found = (
        F.when(F.col("length") > max_bytes, F.concat(path_findings(F.col("path")), F.array(F.lit("over-1-MiB"))))
        .when(expected.isNotNull(), F.when(F.sha2("content", 256) != expected, F.array(F.lit("public-asset-sha256-mismatch"))).otherwise(F.array().cast("array<string>")))
        .otherwise(F.concat(path_findings(F.col("path")), content_findings(F.col("content"))))
    )
    return files.select("path", F.explode(found).alias("rule")).distinct().orderBy("path", "rule")
