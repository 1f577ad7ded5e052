"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Event times are read and rendered in UTC. The adaptive settings are Spark's
# defaults, named here because the curated write and the dimension join rely on
# them: skewed rebalance partitions and skewed join partitions are split.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # of repeated JSON keys the last counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the library's settings; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# The JVM leaves methods beyond so many bytes to its interpreter.
METHOD_BYTES = 8000
_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Stages that would be one method beyond ``METHOD_BYTES`` run as several smaller ones."""
    before = spark.conf.get(_METHOD_KEY)
    spark.conf.set(_METHOD_KEY, METHOD_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_METHOD_KEY, before)


_local: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only where that setting is missing
    and the master is local; on a cluster the setting is required.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="quayflow-"))
        shared = _local[0]
    return f"{shared.rstrip('/')}/quayflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the application's scratch folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what the application stored on the way; results that read it must be written."""
    folder = scratch_folder(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is used several times to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
