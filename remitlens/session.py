"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Settings the jobs are written for.  None of them changes a result.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot member or provider may own a third of the claims: split it even when
    # that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sides are broadcast only when Spark has measured them below this size;
    # above it the same join runs as a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A shuffled side whose measured partitions are all small is hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    # The JVM never compiles a method above 8000 bytecodes; a stage whose generated code is
    # longer runs faster operator by operator.
    METHOD_LIMIT: "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "remitlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="remitlens-checkpoint-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


@contextmanager
def method_limit(spark: SparkSession):
    """Writes inside run with the method limit the jobs are written for; the session's own settings come back afterwards.

    Stages as wide as the raw text's otherwise run as one method that the JVM only interprets.  A write's shuffle files go as
    soon as it ends, instead of whenever the driver collects its garbage: nothing reads them once the rows are written.
    """
    wanted = {METHOD_LIMIT: SETTINGS[METHOD_LIMIT], FREE_SHUFFLES: "true"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, for a result that is read several times.

    The copy is columnar, so later reads fetch only their columns, its size is known to
    the optimizer, and losing an executor never recomputes what stands before it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/remitlens-{uuid.uuid4().hex}"
    with method_limit(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that Spark knows to be empty: joins with it fall away instead of shuffling their other side."""
    return spark.range(0).filter(F.lit(False)).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    )
