"""Session helpers: table paths, lineage cuts, spreading of few rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="marginalis-")
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` and read it back: cuts its lineage, survives lost executors.

    A table in the cluster's ``spark.checkpoint.dir``; only where that is unset
    (tests, local mode) in a temporary folder.  Unlike a checkpoint it doesn't
    keep the size that was estimated for the plan, which in a loop of joins
    gets twice as many digits each round until planning takes for ever, and
    readers take only the columns they need.  Deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def digest(*cols) -> "F.Column":
    """128-bit key of several text columns; null and '' are the same part."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (F.col(x) if isinstance(x, str) else x for x in cols)]
    return F.unhex(F.md5(parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores.

    For steps that compute long on few rows of a file.  The scan alone tells
    the number of its partitions; a plan with a shuffle isn't run to learn it,
    and stays as it is, as inputs with more partitions do.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" or plan.execute().getNumPartitions() >= want:
        return df
    return df.repartition(want)
