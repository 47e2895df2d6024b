"""Incremental ingestion: new files of extracted rows as a stream of batches.

State lives in the store, so no watermark or stateful operator is needed: each
micro-batch runs the batch pipeline, and a batch that is delivered again finds
its versions known and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Version, process_versions
from ..schemas import ANNOTATION
from ..sources.store import Store


def ingest(batch: DataFrame, store: Store, document_key: str, processed_at: str, aliases: dict[str, str] | None = None) -> list[dict]:
    """Run the pipeline over one batch of extracted rows, one version per
    content hash.  Rows without one can't be taken: each of their source files
    is logged as an error.  The hashes of a batch are listed on the driver: one per file
    that arrived, which the source's maxFilesPerTrigger bounds."""
    rows = batch.persist()
    try:
        sha = F.coalesce("source_sha256", F.lit(""))
        # files are told apart where no hash does
        file = F.when(sha == "", F.coalesce("source_file", F.lit("")))
        heads = rows.groupBy(sha.alias("sha"), file.alias("file")).agg(F.min("source_file").alias("name"), F.max("modified").alias("modified")).collect()
        versions = [
            (Version(document_key, h["sha"], pdf_name=h["name"] or "", modified_time=h["modified"] or "", processed_at=processed_at), rows.where((sha == h["sha"]) & file.eqNullSafe(h["file"])))
            for h in heads
        ]
        return process_versions(store, versions, aliases=aliases)
    finally:
        rows.unpersist()


def start(spark: SparkSession, folder: str, checkpoint: str, store: Store, document_key: str, processed_at: str, files_per_trigger: int = 16) -> StreamingQuery:
    """Watch a folder of Parquet files with extracted rows; stops when all
    present files are taken."""
    stream = spark.readStream.schema(ANNOTATION).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return (
        stream.writeStream.foreachBatch(lambda batch, _: ingest(batch, store, document_key, processed_at))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
