"""Files in a folder: listing, contents, hashes, and extraction of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, name, modified_time, size_bytes) of a folder and those below it.
    The contents are never read: the reader prunes that column."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return found.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("modified_time"), F.col("length").alias("size_bytes")
    )


def processing_order(files: DataFrame) -> DataFrame:
    """Versions are taken by modified time, then name, then path."""
    return files.orderBy("modified_time", "name", "path")


def with_contents(spark: SparkSession, files: DataFrame, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Add content and sha256 to the chosen files only; the join prunes the
    rest, by a way that Spark chooses by the size of the list."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return raw.join(files, "path").withColumn("sha256", F.sha2("content", 256))


#: Takes a file's bytes and name, yields its rows as dictionaries.
Extractor = Callable[[bytes, str], Iterator[dict[str, Any]]]


def extract(files: DataFrame, extractor: Extractor, schema: T.StructType) -> DataFrame:
    """Rows of all files by ``extractor``, with path, sha256 and error.

    A file that can't be read gives one row with its error and null values, so
    one broken file doesn't stop the others.
    """
    out = T.StructType([T.StructField("path", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("error", T.StringType()), *schema.fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name, sha, content in batch[["path", "name", "sha256", "content"]].itertuples(index=False):
                try:
                    rows = [[path, sha, None, *(r.get(n) for n in names)] for r in extractor(bytes(content), name)]
                except Exception as problem:  # noqa: BLE001  any reader's failure is that file's result
                    rows = [[path, sha, f"{type(problem).__name__}: {problem}", *(None for _ in names)]]
                yield pd.DataFrame(rows, columns=out.fieldNames()).astype(object)

    return files.select("path", "name", "sha256", "content").mapInPandas(run, out)


def pdf_extractor(content: bytes, name: str) -> Iterator[dict[str, Any]]:
    """Annotations of a PDF by an optional library; fails where it is missing."""
    try:
        import io

        from pypdf import PdfReader
    except ImportError as problem:
        raise RuntimeError("reading PDF files needs the optional package pypdf") from problem
    order = 0
    for number, page in enumerate(PdfReader(io.BytesIO(content)).pages, 1):
        for ref in page.get("/Annots") or []:
            a = ref.get_object()
            parent = a.get("/IRT")
            box = [float(x) for x in a.get("/Rect", (0, 0, 0, 0))]
            yield {
                "ord": order, "source_file": name, "pdf_page": number, "annotation_type": str(a.get("/Subtype", "")).lstrip("/"), "comment": str(a.get("/Contents", "") or ""), "raw_author": str(a.get("/T", "") or ""),
                "subject": str(a.get("/Subj", "") or ""), "created": str(a.get("/CreationDate", "") or ""), "modified": str(a.get("/M", "") or ""), "annotation_id": str(a.get("/NM", "") or ""),
                "xref": getattr(ref, "idnum", 0), "parent_xref": getattr(parent, "idnum", 0) if parent is not None else 0, "relation_raw": str(a.get("/RT", "") or ""),
                "rect_x0": box[0], "rect_y0": box[1], "rect_x1": box[2], "rect_y1": box[3],
            }
            order += 1
