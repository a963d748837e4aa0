"""Pages of PDF files, by an extractor that gives a file's text with a form feed after each page."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

#: An extractor gives the text of a file's bytes.
Extractor = Callable[[bytes], str]


def with_pdftotext(body: bytes, seconds: int = 30) -> str:
    """By the command of that name, which must be installed on every executor; empty where it fails or takes too long."""
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:  # read by the command, gone with this call
        f.write(body)
        f.flush()
        try:
            done = subprocess.run(["pdftotext", "-layout", f.name, "-"], capture_output=True, timeout=seconds, check=False)
        except (OSError, subprocess.TimeoutExpired):
            return ""
    return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else ""


def stored_text(body: bytes) -> str:
    """Files that hold the extracted text itself."""
    return body.decode("utf-8", "replace")


def pages(df: DataFrame, key: str, body: str, extractor: Extractor = with_pdftotext) -> DataFrame:
    """(key, page_no, text) of each page that has text, counted from 1; null files have no pages."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys, numbers, texts = [], [], []
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, page in enumerate(extractor(b).split("\f") if b is not None else ()):
                    if page.strip(" "):
                        keys.append(k)
                        numbers.append(i + 1)
                        texts.append(page.strip(" "))
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], names=[key, "page_no", "text"])

    return df.select(key, body).mapInArrow(run, f"`{key}` {kind}, page_no long, text string")
