"""File paths as column expressions, and the few file calls outside of scans."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs as pafs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CALLS_AT_ONCE = 32

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _fs(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def working_uri(spark: SparkSession, uri: str | None = None) -> str:
    """``uri``, or the default file system's working directory, fully qualified."""
    fs, path = _fs(spark, uri or ".")
    return fs.makeQualified(path).toString()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs(spark, uri)
    return fs.exists(path)


def remove(spark: SparkSession, uri: str) -> None:
    fs, path = _fs(spark, uri)
    fs.delete(path, True)


def existing(spark: SparkSession, uris: list[str]) -> list[str]:
    with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
        found = pool.map(lambda uri: exists(spark, uri), uris)
        return [uri for uri, there in zip(uris, found) if there]


def child_names(spark: SparkSession, uri: str) -> list[str]:
    fs, path = _fs(spark, uri)
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def is_filled(spark: SparkSession, uri: str) -> bool:
    """True when a folder holds anything a scan of it would read."""
    return any(name[0] not in "_." for name in child_names(spark, uri))


def qualify(path: Column, base: str) -> Column:
    """Absolute form of manifest paths, spelled as Spark's file sources spell it.
    ``base`` is a qualified directory: its scheme and authority complete absolute
    paths, all of it completes relative ones.  ``.`` and ``..`` are not resolved."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]+)?)(/.*)?", base)
    if not found:
        raise ValueError(f"{base!r} has no scheme")
    root, folder = found.group(1), (found.group(2) or "").rstrip("/")
    full = (
        F.when(path.rlike(_SCHEME), path)
        .when(path.startswith("/"), F.concat(F.lit(root), path))
        .otherwise(F.concat(F.lit(root + folder + "/"), path))
    )
    # scheme:/x and scheme:///x are the same place; repeated slashes count once
    head = F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]+)?)", 1)
    tail = F.regexp_replace(F.regexp_replace(full.substr(F.length(head) + 1, F.length(full)), "/+", "/"), "(.)/$", "$1")
    return F.concat(head, tail)


def parent(path: Column) -> Column:
    """Folder of a qualified path; the root's own name ends in a slash."""
    folder = F.regexp_replace(path, r"/[^/]*$", "")
    return F.when(folder.rlike(r"^[A-Za-z][^/]*:(//[^/]+)?$"), F.concat(folder, F.lit("/"))).otherwise(folder)


def root_of(path: Column) -> Column:
    """File system of a qualified path: scheme and authority, and a slash."""
    return F.concat(F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]+)?)", 1), F.lit("/"))


# What the JVM's URI class leaves as it is in a path, besides letters and digits.
_PLAIN = frozenset("-_.!~'()*,;:$&+=@/")


def spelled_uri(path: str) -> str:
    """A qualified path as scans spell it in their metadata: what cannot stand in a
    URI is escaped."""
    root, name = re.match(r"([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]+)?)(.*)", path, re.S).groups()
    escaped = "".join(
        c
        if c in _PLAIN or c.isascii() and c.isalnum() or not c.isascii() and not c.isspace() and c.isprintable()
        else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogateescape"))
        for c in name
    )
    return root + escaped


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def is_hidden(path: Column) -> Column:
    """Names Spark's file listing leaves out."""
    name = file_name(path)
    return (
        name.startswith(".")
        | (name.startswith("_") & ~name.contains("="))
        | name.endswith("._COPYING_")
    )


def is_z(path: Column) -> Column:
    return path.endswith(".Z")


def literal_glob(path: str) -> str:
    """A path as a glob pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def opener():
    """For tasks: a function from a URI or plain local path to its file system
    and the path in it.  It connects to each file system once."""
    connected = {}

    def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
        if uri.startswith("file:") or not re.match(_SCHEME, uri):
            path = "/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri
            return pafs.LocalFileSystem(), path
        found = re.match(r"([^:]+://[^/]*)(.*)", uri.replace("s3a://", "s3://", 1), re.S)
        if not found:
            raise ValueError(f"{uri!r} names no file system")
        root, path = found.groups()
        if root not in connected:
            connected[root] = pafs.FileSystem.from_uri(f"{root}/")
        fs, top = connected[root]
        return fs, top.rstrip("/") + path

    return open_fs
