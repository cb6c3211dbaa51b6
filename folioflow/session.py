"""Session settings the plans rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# All are runtime SQL settings, so they can be applied to a session someone else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even when that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes of code. Wide payload projections fused into
    # one method would stay interpreted; unfused they are compiled piece by piece.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A limit per key is taken before the shuffle whatever its size.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000000",
    # Of a key that an object repeats, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: once per application, as a zip."""
    context = spark.sparkContext
    if getattr(context, "_folioflow_shipped", False):
        return
    package = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="folioflow-"), package.name)
    context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
    context._folioflow_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the session's checkpoint folder, a local one only in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Put an intermediate result down in the shared folder and go on from the files.

    Written once, as Parquet: a lost executor costs no recomputation, and later reads are pruned
    to the columns they need. The folder carries the application's id.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
