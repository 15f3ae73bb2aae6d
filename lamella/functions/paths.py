"""Relative POSIX paths, file names and addresses as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(path: Column) -> Column:
    return F.split(path, "/")


def name(path: Column) -> Column:
    return F.element_at(parts(path), -1)


def suffix(path: Column) -> Column:
    """The last extension with its dot, lower case; empty if there is none (a leading dot begins no extension)."""
    return F.lower(F.regexp_extract(name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]+$", "")


def parent(path: Column) -> Column:
    """The name of the folder a file lies in; NULL for a file without one."""
    return F.try_element_at(parts(path), F.lit(-2))


def first(path: Column) -> Column:
    return F.element_at(parts(path), 1)


def is_safe(path: Column) -> Column:
    """Not empty, relative, without `..` and backslash. NULL is not safe."""
    return F.coalesce((F.length(path) > 0) & ~path.startswith("/") & (F.instr(path, "\\") == 0) & ~F.array_contains(parts(path), ".."), F.lit(False))


def is_normal(path: Column) -> Column:
    """Safe and written in the one normal form: no empty or `.` parts."""
    return is_safe(path) & F.forall(parts(path), lambda p: (p != "") & (p != "."))


def is_portable(path: Column) -> Column:
    """Normal, and without a drive letter's colon in the first part or a NUL anywhere."""
    return is_normal(path) & (F.instr(first(path), ":") == 0) & (F.instr(path, "\x00") == 0)


def sample_name(file_name: Column) -> Column:
    """label, parent_id, role of a name `Label_parent[_crop…].ext`: more than two parts make a crop."""
    p = F.split(stem(file_name), "_")
    return F.struct(
        F.element_at(p, 1).alias("label"),
        F.array_join(F.slice(p, 1, 2), "_").alias("parent_id"),
        F.when(F.size(p) > 2, "crop").otherwise("full_field").alias("role"),
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@\s]*@)?([^/:?#\s]+)", 1))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*(/[^?#\s]*)?", 1)


def may_fetch(url: Column, file_name: Column, hosts: list[str]) -> Column:
    """https, an allowed host, and a bare file name."""
    bare = (F.length(file_name) > 0) & (F.instr(file_name, "/") == 0) & (F.instr(file_name, "\\") == 0) & ~file_name.isin(".", "..")
    return F.coalesce((scheme(url) == "https") & host(url).isin(hosts) & bare, F.lit(False))


def named_digest(text: Column) -> Column:
    """algorithm and value of `algorithm:hex`."""
    return F.struct(F.lower(F.split_part(text, F.lit(":"), F.lit(1))).alias("algorithm"), F.lower(F.split_part(text, F.lit(":"), F.lit(2))).alias("value"))
