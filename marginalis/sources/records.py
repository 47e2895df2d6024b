"""Readers and writers of JSON, CSV and tables of cells."""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

DEFAULTS: dict[str, Any] = {"reviewer_aliases": {}, "generic_author_values": list(S.GENERIC_AUTHORS), "empty_annotation_rules": {"default": "keep"}, "reviewer_output_tabs": {}}


def load_config(path: str | None) -> dict[str, Any]:
    """A pipeline's settings; what the file doesn't name has its default."""
    if path is None:
        return dict(DEFAULTS)
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    if not isinstance(given, dict):
        raise ValueError("the configuration must be an object")
    return DEFAULTS | given


def document_key(config: dict[str, Any], environment: dict[str, str] | None = None) -> str:
    """The configured document key, the environment before the file."""
    named = (os.environ if environment is None else environment).get("DOCUMENT_KEY") or config.get("document_key") or ""
    key = "_".join(str(named).strip().upper().replace("-", "_").split())
    if not key:
        raise ValueError("no document key is configured")
    return key


def historical_authors(spark: SparkSession, path: str) -> DataFrame:
    """(entry_id, canonical_author) from a JSON map, flat or under
    entry_id_to_author; blank ids or names fail."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    if not isinstance(found, dict):
        raise ValueError("the historical map must be an object")
    pairs = found.get("entry_id_to_author", {k: v for k, v in found.items() if k not in ("schema_version", "source")})
    if not isinstance(pairs, dict):
        raise ValueError("entry_id_to_author must be an object")
    for k, v in pairs.items():
        if not str(k).strip() or not isinstance(v, str) or not v.strip():
            raise ValueError(f"blank id or author in the historical map: {k!r}")
    return spark.createDataFrame([(k.strip(), v.strip()) for k, v in pairs.items()], "entry_id string, canonical_author string")


def keyed_json(spark: SparkSession, path: str, value: T.StructType, key: str) -> DataFrame:
    """Rows of a JSON file that holds a list of objects, or a map of objects by
    ``key``; both are read by the cluster, in one pass over the text."""
    whole = spark.read.text(path, wholetext=True)
    as_list = F.from_json("value", T.ArrayType(value))
    as_map = F.from_json("value", T.MapType(T.StringType(), value))
    listed = whole.where(F.ltrim("value").startswith("[")).select(F.explode(as_list).alias("r")).select("r.*")
    mapped = whole.where(F.ltrim("value").startswith("{")).select(F.explode(as_map).alias("_key", "r")).select("_key", "r.*").withColumn(key, F.coalesce(key, "_key")).drop("_key")
    return listed.unionByName(mapped)


def master_index(spark: SparkSession, path: str) -> DataFrame:
    """(fingerprint, book_page, master_pdf_page) from a JSON map."""
    schema = T.StructType.fromDDL("fingerprint string, book_page string, master_pdf_page int")
    return keyed_json(spark, path, schema, "fingerprint")


def records_of(spark: SparkSession, cells: list[list[Any]]) -> DataFrame:
    """A table from rows of cells, the first of which names the columns: blank
    rows go, short ones are padded, columns without a name are left out."""
    if not cells:
        return spark.createDataFrame([], T.StructType([]))
    header = [str(c or "").strip() for c in cells[0]]
    kept = [i for i, h in enumerate(header) if h]
    text = lambda v: "" if v is None else str(v)
    rows = [[text(r[i]) if i < len(r) else "" for i in kept] for r in cells[1:] if any(text(c).strip() for c in r)]
    return spark.createDataFrame(rows, T.StructType([T.StructField(header[i], T.StringType()) for i in kept]))


def write_outputs(rows: DataFrame, folder: str, columns: list[str]) -> None:
    """JSON lines and CSV with a header, each with the named columns in order."""
    chosen = rows.select(*columns)
    chosen.write.mode("overwrite").json(f"{folder}/annotations_json")
    chosen.write.mode("overwrite").option("header", "true").csv(f"{folder}/annotations_csv")
