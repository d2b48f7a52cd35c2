"""Versioned tables: content lies below paths that never change, and a manifest names the paths that make up the tables now.

A writer puts new content beside the old one and commits the next manifest: one small file that appears under its number as a whole
or not at all. Readers take the newest manifest, so they see every table of a commit or none, nothing is copied to publish it, and a
writer that stops before its commit leaves no trace but files that no manifest names. Two writers that start from one version
cannot both commit; the later one gets ``Conflict``. The swap is a rename that refuses to replace a file, which is one atomic step on
HDFS and the like.

A table is a set of parts (months of a fact, buckets of an index, or the part ``""``) with the folders of each.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scholarmart.session import shuffles_freed

FOLDER, DATA = "_versions", "_data"
Parts = Mapping[str, list[str]]


class Conflict(RuntimeError):
    """Another writer has committed since the manifest was read."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    tables: Mapping[str, Parts] = field(default_factory=dict)
    runs: tuple[str, ...] = ()
    at: float = 0.0

    def folders(self) -> set[str]:
        return {path for parts in self.tables.values() for paths in parts.values() for path in paths}


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _file(root: str, version: int) -> str:
    return f"{root}/{FOLDER}/{version:012d}.json"


def _load(spark: SparkSession, path: str) -> Manifest:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        whole = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(whole["version"], whole["tables"], tuple(whole["runs"]), whole["at"])


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; version 0 without tables where nothing was committed."""
    names = [n for n in _names(spark, f"{root}/{FOLDER}") if n.endswith(".json")]
    return _load(spark, f"{root}/{FOLDER}/{names[-1]}") if names else Manifest()


def is_versioned(spark: SparkSession, root: str) -> bool:
    return _fs(spark, root).exists(_path(spark, f"{root}/{FOLDER}"))


def new_folder() -> str:
    """A fresh folder for content, below the root; the time in its name lets ``vacuum`` spare running writers."""
    return f"{DATA}/{int(time.time())}-{uuid.uuid4().hex}"


def parts_of(spark: SparkSession, root: str, folder: str) -> dict[str, list[str]]:
    """The parts of a table that was written with one partition column."""
    names = [n for n in _names(spark, f"{root}/{folder}") if "=" in n]
    return {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in names}


def commit(
    spark: SparkSession, root: str, base: Manifest, replaced: Mapping[str, Parts] | None = None, changed: Mapping[str, Parts] | None = None,
    added: Mapping[str, Parts] | None = None, run: str | None = None, forget_runs: bool = False,
) -> Manifest:
    """The next version: whole tables replaced, single parts changed, or folders added to parts; all or nothing.

    ``run`` is remembered, so that a load can tell that it was done; ``forget_runs`` starts that list anew.
    """
    tables: dict[str, dict[str, list[str]]] = {n: {p: list(f) for p, f in parts.items()} for n, parts in base.tables.items()}
    for name, parts in (replaced or {}).items():
        tables[name] = {p: list(f) for p, f in parts.items()}
    for name, parts in (changed or {}).items():
        tables.setdefault(name, {}).update({p: list(f) for p, f in parts.items()})
    for name, parts in (added or {}).items():
        for part, folders in parts.items():
            tables.setdefault(name, {}).setdefault(part, []).extend(folders)
    new = Manifest(base.version + 1, tables, (() if forget_runs else base.runs) + ((run,) if run else ()), time.time())
    content = json.dumps({"version": new.version, "at": new.at, "tables": tables, "runs": new.runs})
    waiting = f"{root}/{FOLDER}/.{uuid.uuid4().hex}"
    stream = _fs(spark, root).create(_path(spark, waiting), False)
    stream.write(content.encode())
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(_fs(spark, root).getUri(), spark._jsc.hadoopConfiguration())
    kinds = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)  # without OVERWRITE
    try:
        files.rename(_path(spark, waiting), _path(spark, _file(root, new.version)), kinds)
    except Py4JJavaError as error:
        _fs(spark, root).delete(_path(spark, waiting), False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            raise Conflict(f"version {new.version} of {root} is there already") from error
        raise
    return new


def scan(spark: SparkSession, root: str, now: Manifest, name: str, schema: T.StructType, parts: Collection[str] | None = None) -> DataFrame:
    """A table as a manifest has it, or some of its parts; only their folders are listed and read."""
    kept = now.tables.get(name, {})
    folders = [f"{root}/{f}" for part in sorted(kept) if parts is None or part in parts for f in kept[part]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_parts(df: DataFrame, root: str, folder: str, by: str | None = None, **options: str) -> dict[str, list[str]]:
    """Write content below a fresh folder, by the values of one column if named; returns its parts for a commit."""
    spark = df.sparkSession
    writer = df.write.mode("error").options(**options)
    with shuffles_freed(spark):
        (writer if by is None else writer.partitionBy(by)).parquet(f"{root}/{folder}")
    if by is None:
        return {"": [folder]}
    return parts_of(spark, root, folder)


def drop(spark: SparkSession, root: str, folder: str) -> None:
    """Delete content that was never committed."""
    _fs(spark, root).delete(_path(spark, f"{root}/{folder}"), True)


def replace(frames: Mapping[str, DataFrame], root: str) -> Manifest:
    """Replace whole tables together."""
    spark = next(iter(frames.values())).sparkSession
    base, folder = manifest(spark, root), new_folder()
    return commit(spark, root, base, replaced={n: write_parts(df, root, f"{folder}/{n}") for n, df in frames.items()})


def vacuum(spark: SparkSession, root: str, spare_seconds: float = 7 * 86400) -> list[str]:
    """Delete the manifests that were followed by another more than ``spare_seconds`` ago, and older content that no other one names.

    So a reader may go on with a manifest for that long after it was replaced, and a writer may take that long to commit.
    """
    until = time.time() - spare_seconds
    names = [n for n in _names(spark, f"{root}/{FOLDER}") if n.endswith(".json")]
    known = [_load(spark, f"{root}/{FOLDER}/{n}") for n in names]
    past = [n for n, following in zip(names, known[1:]) if following.at < until]
    used = {f.split("/")[1] for one in known[len(past) :] for f in one.folders() if f.startswith(f"{DATA}/")}
    old = [n for n in _names(spark, f"{root}/{DATA}") if n not in used and int(n.split("-")[0]) < until]
    for path in [f"{FOLDER}/{n}" for n in past] + [f"{DATA}/{n}" for n in old]:
        _fs(spark, root).delete(_path(spark, f"{root}/{path}"), True)
    return old
