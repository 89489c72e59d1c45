"""Small records in shared folders: written under another name and renamed, so a reader sees whole ones only."""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder in order; none if it is not there."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def whole(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the tables in a folder whose writing came to its end, in order of name."""
    fs, p = _at(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [f"{folder}/{n}" for n in names(spark, folder) if fs.exists(path(p, f"{n}/_SUCCESS"))]


def chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """The content of a file, piece by piece."""
    if path.startswith("file:") or "://" not in path:
        with open(re.sub("^file:/*", "/", path), "rb") as f:
            while piece := f.read(size):
                yield piece
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner) as f:
        while piece := f.read(size):
            yield piece


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def stamp() -> str:
    """A name that sorts by time and is nobody else's."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _write(fs, p, record: dict) -> None:
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()


def claim(spark: SparkSession, folder: str, name: str, record: dict) -> bool:
    """Add a record under this name unless another writer has; whether it is ours. Of any number of writers one has it."""
    fs, part = _at(spark, f"{folder}/.{name}-{stamp()}")
    target = _at(spark, f"{folder}/{name}")[1]
    _write(fs, part, record)
    try:
        if fs.getScheme() == "file":  # a rename would replace there, a link does not
            os.link(part.toUri().getPath(), target.toUri().getPath())
            return True
        return not fs.exists(target) and fs.rename(part, target)
    except FileExistsError:
        return False
    finally:
        fs.delete(part, False)


def put(spark: SparkSession, folder: str, record: dict) -> str:
    """Add a record to a folder; returns its name. Records are never changed, so writers cannot harm each other."""
    name = f"{stamp()}.json"
    fs, part = _at(spark, f"{folder}/.{name}")
    _write(fs, part, record)
    if not fs.rename(part, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)):
        raise OSError(f"cannot name {folder}/{name}")
    return name


def records(spark: SparkSession, folder: str) -> list[dict]:
    """The records of a folder, oldest first; what cannot be read as one does not count."""
    found = []
    fs, p = _at(spark, folder)
    jvm = spark.sparkContext._jvm
    for name in names(spark, folder):
        if name.startswith(".") or not name.endswith(".json"):
            continue
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(p, name))
        try:
            found.append(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        except ValueError:
            continue
        finally:
            stream.close()
    return [r for r in found if isinstance(r, dict)]
