"""Session settings, small files on the cluster's storage, and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

from lakelayers import settings

# Results depend on these, so every context pins them.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plans depend on these: run-time join choice, skew splitting, small-partition merging, run-time filters.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Bloom filters of merge keys: from the size of one shuffle task on, and of more changes than by default.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "128MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}

SHUFFLE_BYTES_PER_TASK = 128 << 20
# Parquet to shuffle rows: what is decoded takes more than what was stored.
DECODED_PER_STORED = 2


def build_session(app: str = "lakelayers", run: str = "daily", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session for one run kind; the master comes from the submitter.

    ``input_bytes``, the stored size of what the run will read, sets the width
    of shuffles at one task per 128 MB of rows, at any size; adaptive execution
    merges the ones that turn out small. Nothing changes it later, and a setting
    given in ``conf`` wins.
    """
    width = settings.SHUFFLE_PARTITIONS[run] if input_bytes is None else shuffle_width(input_bytes)
    builder = SparkSession.builder.appName(app)
    for key, value in {**RESULT_CONF, **PLAN_CONF, "spark.sql.shuffle.partitions": str(width), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(input_bytes: int) -> int:
    return max(1, math.ceil(input_bytes * DECODED_PER_STORED / SHUFFLE_BYTES_PER_TASK))


def bytes_of(spark: SparkSession, setting: str) -> int:
    """A size that a session is set to, such as ``64MB``, in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def pin(spark: SparkSession) -> None:
    for key, value in {**RESULT_CONF, **PLAN_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage for ``path``."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place in one step; False if it is there already."""
    fs, jpath = hadoop_path(spark, path)
    _, part = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    if fs.exists(jpath):
        return False
    stream = fs.create(part)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return fs.rename(part, jpath)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share,
    or, where that is not set, under the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
