"""Readers: case folders, extracted texts, page reads and descriptions. External programs run behind adapters."""

from __future__ import annotations

import re
import shutil
import subprocess
import tempfile
from collections.abc import Callable
from pathlib import Path
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def pdf_files(spark: SparkSession, root: str, kinds: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """(folder, dir, file, bytes, path, modified) of <root>/<folder>[/<dir>]/<file>.<kind>, contents not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{{{','.join(kinds)}}}").load(root).select("path", F.col("length").alias("bytes"), F.unix_micros("modificationTime").alias("modified"))
    # the path as written by the file system, percent escapes resolved
    rest = F.split(F.regexp_extract(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"^.*?" + _tail(root) + r"/(.*)$", 1), "/")
    return f.select(F.get(rest, 0).alias("folder"), F.when(F.size(rest) > 2, F.get(rest, 1)).otherwise("").alias("dir"), F.element_at(rest, -1).alias("file"), "bytes", "path", "modified").where(F.size(rest).between(2, 3))


def _tail(root: str) -> str:
    return re.escape(root.rstrip("/").rpartition("/")[2])


def case_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder): all folders of a root, also those without a file, listed through the file system of the root."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    names = sorted(s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path) if s.isDirectory())
    return spark.createDataFrame([(n,) for n in names], "folder string")


Extractor = Callable[[bytes], tuple[str, int]]


def run_program(args: list[str], data: bytes | None = None, timeout: int = 300) -> str:
    if not shutil.which(args[0]):
        raise FileNotFoundError(args[0])
    return subprocess.run(args, input=data, capture_output=True, timeout=timeout, check=False).stdout.decode("utf-8", "replace")


def pdf_pages(pdf: bytes) -> int:
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(pdf)
        f.flush()
        for line in run_program(["pdfinfo", f.name], timeout=60).splitlines():
            if line.startswith("Pages:") and line.split()[-1].isdigit():
                return int(line.split()[-1])
    return 0


def pdf_text(pdf: bytes) -> tuple[str, int]:
    """The text layer with its columns kept, and the number of pages."""
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(pdf)
        f.flush()
        return run_program(["pdftotext", "-layout", f.name, "-"]), pdf_pages(pdf)


def pdf_ocr(pdf: bytes, dpi: int = 300) -> tuple[str, int]:
    """Pages rendered in grey and read one by one; a page that fails is left out."""
    pages = []
    with tempfile.TemporaryDirectory() as d:
        source = Path(d) / "in.pdf"
        source.write_bytes(pdf)
        run_program(["pdftoppm", "-r", str(dpi), "-gray", "-png", str(source), f"{d}/p"], timeout=1800)
        images = sorted(Path(d).glob("p-*.png"))
        for image in images:
            try:
                pages.append(run_program(["tesseract", str(image), "-", "--psm", "6"]))
            except (subprocess.SubprocessError, OSError):
                continue
    return "\n".join(pages), len(images)


def read_bytes(path: str) -> bytes:
    """The content of a file where it is needed: local ones plainly, others by pyarrow's file systems."""
    if path.startswith("file:") or "://" not in path:
        return Path(unquote(re.sub("^file:/*", "/", path))).read_bytes()
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner) as f:
        return f.read()


def tasks_for(rows: DataFrame, size, bytes_a_task: int = 128 << 20) -> int:
    """Tasks for rows whose contents have `size` bytes each: a core's worth at least, ten thousand at most."""
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).cast("long")).first()[0]
    return min(10_000, max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // bytes_a_task)))


def extracted(files: DataFrame, extract: Extractor, out: str = "text", read=read_bytes) -> DataFrame:
    """files (path, bytes, ...) and the text an extractor gives; an error leaves the text null and says why.

    Only the rows of files are dealt over tasks; each task opens its files itself, so that no
    content crosses a shuffle.
    """

    def run(frames):
        for pdf in frames:
            got = []
            for path in pdf["path"]:
                try:
                    got.append((*extract(read(path)), None))
                except Exception as e:  # noqa: BLE001 - kept in the row, never taken for an empty text
                    got.append((None, None, f"{type(e).__name__}: {e}"))
            yield pdf.assign(**{out: [g[0] for g in got], "pages": pd.array([g[1] for g in got], "Int64"), "error": [g[2] for g in got]})

    rows = files.drop("pages")
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes] + [f"{out} string, pages long, error string"])
    return rows.repartition(tasks_for(rows, F.col("bytes") if "bytes" in rows.columns else F.lit(1 << 20)), "path").mapInPandas(run, schema)


def plain_text(content: bytes) -> tuple[str, int]:
    """A text file's words as one page."""
    return content.decode("utf-8", "replace"), 1


def descriptions(rows: DataFrame, mapping: dict[int, str]) -> DataFrame:
    """(param_id, description) of (number, item, text): whole numbers that are mapped, white space put in order."""
    n = F.when(X.strip(F.col("number").cast("string")).rlike(r"^\d+$"), X.strip(F.col("number").cast("string")).cast("int"))
    keys = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    d = rows.select(F.element_at(keys, n).alias("param_id"), F.regexp_replace(X.strip("text"), r"(?U)\s+", " ").alias("description"))
    return d.where("param_id is not null and description <> ''")
