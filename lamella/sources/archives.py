"""Entries of zip archives, without unpacking them to disk."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes an archive may unpack to.
MAX_BYTES = 10 << 30


def entries(archives: DataFrame) -> DataFrame:
    """archive, name, size, is_link, unsafe for every file entry of a table (path, content)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for e in z.infolist():
                        if not e.is_dir():
                            parts = e.filename.split("/")
                            unsafe = e.filename.startswith("/") or "\\" in e.filename or ".." in parts
                            rows.append((path, e.filename, e.file_size, (e.external_attr >> 16) & 0o170000 == 0o120000, unsafe))
            yield pd.DataFrame(rows, columns=["archive", "name", "size", "is_link", "unsafe"])

    return archives.select("path", "content").mapInPandas(work, "archive string, name string, size bigint, is_link boolean, unsafe boolean")


def archive_totals(found: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """archive, files, images, bytes, code: code says why an archive must not be unpacked."""
    image = F.lower(F.regexp_extract("name", r"(\.[^./]+)$", 1)).isin(*suffixes)
    return found.groupBy("archive").agg(
        F.count("*").alias("files"), F.count_if(image).alias("images"), F.sum("size").alias("bytes"),
        F.when(F.bool_or("unsafe"), "unsafe_path").when(F.bool_or("is_link"), "symlink").when(F.sum("size") > MAX_BYTES, "too_large").alias("code"),
    )
