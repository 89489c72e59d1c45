"""Reads of single pages: rendered where they are read, so that no image crosses a shuffle.

A page is rendered in the task that needs it: once for the witness and the digest of its
image, and again only if no stored answer of the vision model is found under that digest.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pages import page_ranges
from . import completions, readers

#: (file, first page, last page) -> images of these pages
Renderer = Callable[[bytes, int, int], list[bytes]]
#: image -> words
PageReader = Callable[[bytes], str]


def rendered(pdf: bytes, first: int, last: int, dpi: int = 150, grey: bool = False) -> list[bytes]:
    """PNG images of pages; needs poppler."""
    with tempfile.TemporaryDirectory() as d:
        source = Path(d) / "in.pdf"
        source.write_bytes(pdf)
        readers.run_program(["pdftoppm", "-f", str(first), "-l", str(last), "-r", str(dpi), *(["-gray"] if grey else []), "-png", str(source), f"{d}/p"], timeout=1800)
        return [p.read_bytes() for p in sorted(Path(d).glob("p-*.png"), key=lambda p: int(p.stem.rpartition("-")[2]))]


def witnessed(image: bytes) -> str:
    """An OCR program's read of a page, which cannot make words up; needs tesseract."""
    with tempfile.NamedTemporaryFile(suffix=".png") as f:
        f.write(image)
        f.flush()
        return readers.run_program(["tesseract", f.name, "-", "--psm", "6"])


def vision_reader(url: str, model: str, prompt: str, key: str = "", max_tokens: int = 3000, **options) -> PageReader:
    """A chat endpoint that is sent the page as an image; an empty answer is asked for again, then stays empty."""
    ask = completions.http_completer(url, model, key, **options)

    def read(image: bytes) -> str:
        said = ""
        content = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": {"url": f"data:image/png;base64,{base64.b64encode(image).decode()}"}}]
        for _ in range(3):
            said = ask("", content, max_tokens)
            if said.strip():
                break
        return said

    return read


def witness_reads(files: DataFrame, render: Renderer = rendered, witness: PageReader = witnessed, keys=("case_id", "file"), read=readers.read_bytes) -> DataFrame:
    """(*keys, path, page, digest, text, error) for every page of files (*keys, path, pages).

    A witness that fails saw nothing; a page that cannot be rendered has no digest and says why.
    """

    def run(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                own = [getattr(r, k) for k in keys]
                span = range(int(r.first_page), int(r.last_page) + 1)
                try:
                    images = render(read(r.path), span[0], span[-1])
                    if len(images) != len(span):
                        raise ValueError(f"{len(images)} images of {len(span)} pages")
                except Exception as e:  # noqa: BLE001 - kept in the row
                    out += [(*own, r.path, p, None, None, f"{type(e).__name__}: {e}") for p in span]
                    continue
                for p, image in zip(span, images, strict=True):
                    try:
                        text = witness(image)
                    except Exception:  # noqa: BLE001 - nothing seen
                        text = ""
                    out.append((*own, r.path, p, hashlib.sha256(image).hexdigest(), text, None))
            yield pd.DataFrame(out, columns=[*keys, "path", "page", "digest", "text", "error"])

    ranges = page_ranges(files.select(*keys, "path", "pages"))
    ranges = ranges.repartition(readers.tasks_for(ranges, F.lit(32 << 20)), "path", "first_page")  # names and numbers only
    return ranges.mapInPandas(run, ", ".join(f"{k} string" for k in keys) + ", path string, page int, digest string, text string, error string")


def vision_reads(pages: DataFrame, store: str, reader: PageReader, model: str, render: Renderer = rendered, keys=("case_id", "file"), read=readers.read_bytes, batch: int = 500) -> DataFrame:
    """(*keys, page, response, error) of pages (*keys, path, page, digest, error) by the vision model.

    Answers are stored under the digest of the image and the model; a page is rendered and
    sent only if no good one is there, so equal pages are read once and a run that was
    stopped goes on where it was. Pages that could not be rendered keep their error.
    """
    asked = pages.where("digest is not null").withColumn("request_id", F.sha2(F.concat_ws("\x1f", F.lit(model), "digest"), 256))

    def ask(wanted: DataFrame) -> DataFrame:
        def run(frames):
            for pdf in frames:
                out = []
                for r in pdf.itertuples(index=False):
                    try:
                        out.append((r.request_id, reader(render(read(r.path), int(r.page), int(r.page))[0]), None))
                    except Exception as e:  # noqa: BLE001 - a failure is a row of its own kind
                        out.append((r.request_id, None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(out, columns=["request_id", "response", "error"])

        return wanted.mapInPandas(run, completions.ANSWER)

    answers = completions.cached(asked.select("request_id", "path", "page"), store, ask, batch)
    got = asked.select(*keys, "page", "request_id").join(answers, "request_id").select(*keys, "page", "response", "error")
    return got.unionByName(pages.where("digest is null").select(*keys, "page", F.lit(None).cast("string").alias("response"), "error"))
