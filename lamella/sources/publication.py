"""What a folder would publish: its files as git lists them, and the staged blobs, which can differ from them."""

from __future__ import annotations

import os
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.scan import MAX_BYTES, file_findings, path_findings

_READ = "path string, length bigint, content binary, kind string"
#: Files whose bytes go on in one batch.
_TOGETHER = 32


def _git(command: list[str], *args: str, **more) -> bytes:
    return subprocess.run([*command, *args], capture_output=True, check=True, **more).stdout


def repository(root: str) -> list[str] | None:
    """git on the repository whose work tree is root, or None."""
    probe = subprocess.run(["git", "-C", root, "rev-parse", "--show-toplevel"], capture_output=True, text=True, check=False)
    return ["git", "-C", root, "-c", "core.excludesFile=/dev/null"] if probe.returncode == 0 and Path(probe.stdout.strip()).resolve() == Path(root).resolve() else None


def _names(listed: bytes) -> list[str]:
    return [os.fsdecode(n) for n in sorted(set(listed.split(b"\0")) - {b""})]


def listed(root: str) -> list[str]:
    """Tracked files, ignored or not, and others that are not ignored. Without a repository, an empty one elsewhere applies the rules."""
    with tempfile.TemporaryDirectory() as elsewhere:
        command = repository(root)
        if command is None:
            _git(["git"], "init", "--bare", "--quiet", elsewhere)
            command = ["git", f"--git-dir={elsewhere}", f"--work-tree={root}", "-C", root, "-c", "core.excludesFile=/dev/null"]
        return _names(_git(command, "ls-files", "--cached", "--others", "--exclude-standard", "-z"))


def _table(spark: SparkSession, rows: list[tuple], schema: str, read) -> DataFrame:
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), _TOGETHER):
                found = [x for row in frame.iloc[at : at + _TOGETHER].itertuples(index=False) if (x := read(*row)) is not None]
                yield pd.DataFrame(found, columns=["path", "length", "content", "kind"])

    return spark.createDataFrame(rows, schema).mapInPandas(batches, _READ)


def _findings(read: DataFrame, prefix: str = "") -> DataFrame:
    files = file_findings(read.filter("kind is null").select("path", "length", "content"))
    # A link in the index keeps the rule of its name; one in the work tree is a link only.
    odd = F.concat(path_findings(F.col("path")), F.array("kind")) if prefix else F.array("kind")
    other = read.filter("kind is not null").select("path", F.explode(odd).alias("rule"))
    return files.unionByName(other).select("path", F.concat(F.lit(prefix), "rule").alias("rule"))


def work_findings(spark: SparkSession, root: str) -> DataFrame:
    """path, rule of the listed files as they lie in the work tree."""

    def read(path: str):
        at = Path(root)
        for part in Path(path).parts:
            at = at / part
            if at.is_symlink():
                return path, 0, None, "symlink"
        if not at.exists():
            return None
        if not at.is_file():
            return path, 0, None, "non-regular-file"
        size = at.stat().st_size
        return path, size, None if size > MAX_BYTES else at.read_bytes(), None

    return _findings(_table(spark, [(p,) for p in listed(root)], "path string", read))


def staged_findings(spark: SparkSession, root: str) -> DataFrame | None:
    """path, rule (`staged-...`, `ignored-tracked-file`) of what the index holds; None without a repository."""
    command = repository(root)
    if command is None:
        return None
    entries = [(*meta.decode().split()[:2], os.fsdecode(name)) for e in _git(command, "ls-files", "--stage", "-z").split(b"\0") if e for meta, name in [e.split(b"\t", 1)]]
    names = b"".join(os.fsencode(n) + b"\0" for _, _, n in entries)
    checked = subprocess.run([*command, "check-ignore", "--no-index", "--stdin", "-z"], input=names, capture_output=True, check=False)
    if checked.returncode not in (0, 1):
        raise OSError("git check-ignore failed")

    def read(mode: str, blob: str, path: str):
        if mode not in ("100644", "100755"):
            return path, 0, None, "symlink" if mode == "120000" else "non-regular-file"
        size = int(_git(command, "cat-file", "-s", blob))
        return path, size, None if size > MAX_BYTES else _git(command, "cat-file", "blob", blob), None

    ignored = spark.createDataFrame([(n, "ignored-tracked-file") for n in _names(checked.stdout)], "path string, rule string")
    return _findings(_table(spark, entries, "mode string, blob string, path string", read), "staged-").unionByName(ignored)


def findings(spark: SparkSession, root: str) -> DataFrame:
    """path, rule of all findings, distinct and sorted."""
    root = str(Path(root).resolve(strict=True))
    found, staged = work_findings(spark, root), staged_findings(spark, root)
    return (found if staged is None else found.unionByName(staged)).distinct().orderBy("path", "rule")
