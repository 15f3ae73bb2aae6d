"""Outputs: canonical text forms, and publishing a folder as one immutable, checksum-bound artifact."""

from __future__ import annotations

import hashlib
import json
import os
import platform
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path
from typing import Any

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella import __version__
from lamella.functions.ids import python_object_hash
from lamella.operators.checks import ViolationError


def write_json(path: str, value: Any) -> None:
    """Pretty JSON with sorted keys, replaced in one step; NaN is refused."""
    text = json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, allow_nan=False) + "\n"
    partial = f"{path}.part"
    Path(partial).write_text(text, encoding="utf-8")
    os.replace(partial, path)


def json_lines(df: DataFrame) -> DataFrame:
    """One column `value`: every row as a JSON object with sorted keys and explicit nulls; raw JSON text columns stay text."""
    return df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns))), {"ignoreNullFields": "false"}).alias("value"))


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*(F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields))


def _single(df: DataFrame, write: Callable[[DataFrame, str], None], path: str) -> None:
    """One file from an ordered table: for exports that are one file by definition. Everything else stays a folder of Parquet."""
    folder = f"{path}.dir"
    write(df.coalesce(1), folder)
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    with open(path, "wb") as out:
        for p in parts:
            with open(f"{folder}/{p}", "rb") as f:
                shutil.copyfileobj(f, out)
    shutil.rmtree(folder)


def write_lines(df: DataFrame, path: str, *order: str) -> None:
    ordered = df.orderBy(*order) if order else df
    _single(json_lines(ordered), lambda d, p: d.write.text(p), path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """CSV with a header, CRLF lines, doubled quotes, and empty text for NULL."""
    ordered = csv_ready(df.orderBy(*order) if order else df)
    # A header goes out with every part file; coalesce(1) leaves one.
    options = {"header": "true", "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\r\n"}
    _single(ordered, lambda d, p: d.write.options(**options).csv(p), path)


def write_partitions(df: DataFrame, path: str, column: str = "split") -> None:
    """Parquet, a folder for each partition, so a reader of one reads no other."""
    df.write.mode("errorifexists").partitionBy(column).parquet(path)


def link_tree(rows: list[tuple[str, str]], root: str, target: str) -> None:
    """Symbolic links target/<name> to root/<path>, relative, for rows (path, name)."""
    for path, name in rows:
        link = Path(target) / name
        link.parent.mkdir(parents=True, exist_ok=True)
        link.symlink_to(os.path.relpath(Path(root) / path, link.parent))


def write_tensor(path: str, tensor, metadata: dict) -> None:
    """NPZ and a JSON sidecar beside it; neither may exist."""
    import numpy as np

    side = os.path.splitext(path)[0] + ".json"
    if not path.endswith(".npz") or os.path.lexists(path) or os.path.lexists(side):
        raise ViolationError("an .npz path is needed where neither it nor its sidecar exists")
    with open(path, "xb") as f:
        np.savez_compressed(f, image=tensor)
    write_json(side, metadata)


def schema_json(schema: T.StructType) -> dict:
    return json.loads(schema.json())


def environment() -> dict:
    """Versions and a hash of this package's files."""
    base = Path(__file__).resolve().parents[1]
    code = {str(p.relative_to(base)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(base.rglob("*.py")) if "llm" not in p.parts}
    return {"python": platform.python_version(), "spark": pyspark.__version__, "lamella": __version__, "implementation_sha256": python_object_hash(code)}


def file_hashes(folder: str) -> dict[str, str]:
    """relative path -> SHA-256 of every regular file, read in blocks."""
    out = {}
    for p in sorted(Path(folder).rglob("*")):
        if p.is_file() and not p.is_symlink():
            h = hashlib.sha256()
            with p.open("rb") as f:
                while block := f.read(1 << 20):
                    h.update(block)
            out[p.relative_to(folder).as_posix()] = h.hexdigest()
    return out


def check_isolated(output: str, *inputs: str) -> None:
    """The output must not exist and must lie outside every input folder."""
    if os.path.lexists(output):
        raise ViolationError(f"output exists: {output}")
    for folder in inputs:
        if Path(output).resolve().is_relative_to(Path(folder).resolve()):
            raise ViolationError(f"output lies inside {folder}")


def publish(output: str, metadata_name: str, id_prefix: str, fill: Callable[[str], dict]) -> dict:
    """Write all files into a staging folder beside output, bind them by hash, derive the id from the content, and rename in
    one step. Any failure leaves nothing behind; an identical artifact that is already there is reused."""
    parent = Path(output).parent
    parent.mkdir(parents=True, exist_ok=True)
    staging = tempfile.mkdtemp(prefix=f".{Path(output).name}.", dir=parent)
    try:
        metadata = fill(staging)
        metadata["file_sha256"] = file_hashes(staging)
        metadata["id"] = f"{id_prefix}-{python_object_hash(metadata)[:16]}"
        write_json(f"{staging}/{metadata_name}", metadata)
        if os.path.lexists(output):
            there = Path(output) / metadata_name
            if there.is_file() and json.loads(there.read_text(encoding="utf-8")).get("id") == metadata["id"]:
                shutil.rmtree(staging)
                return metadata
            raise ViolationError(f"output exists: {output}")
        os.rename(staging, output)
        return metadata
    except BaseException:
        shutil.rmtree(staging, ignore_errors=True)
        raise


def verify_bound(folder: str, metadata_name: str, id_prefix: str | None = None) -> dict:
    """The metadata of an artifact after its identity and every bound file's hash have been checked."""
    metadata = json.loads((Path(folder) / metadata_name).read_text(encoding="utf-8"))
    stated = metadata.get("id")
    if id_prefix and stated != f"{id_prefix}-{python_object_hash({k: v for k, v in metadata.items() if k != 'id'})[:16]}":
        raise ViolationError("the artifact's id does not fit its content")
    actual = {k: v for k, v in file_hashes(folder).items() if k != metadata_name}
    if actual != metadata.get("file_sha256"):
        differing = sorted(k for k in actual.keys() | metadata["file_sha256"].keys() if actual.get(k) != metadata["file_sha256"].get(k))
        raise ViolationError(f"bound files differ: {differing[:5]}")
    return metadata


def bound_hash_mismatches(spark: SparkSession, folder: str, bound: dict[str, str]) -> DataFrame:
    """path, code of bound files that are missing or differ, hashed by executors: for artifacts with many or large files."""
    from lamella.sources.inventory import files

    expected = spark.createDataFrame(list(bound.items()) or [("", "")], "path string, expected string").filter("path <> ''")
    read = files(spark, folder, content=True).select("path", F.sha2("content", 256).alias("actual"))
    return expected.join(read, "path", "left").select("path", F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("expected"), "differs").alias("code")).filter("code is not null")
