"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a repeated key in a JSON text is legal and the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the plans rely on to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: str | int = "*", app: str = "cartlens", settings: dict[str, str] | None = None
) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is missing and the master
    is local, because executors of a cluster could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="cartlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there afterwards.

    For results that several later jobs scan: they survive the loss of executors
    and are not computed again.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read from there afterwards.

    Like ``durable``, for results that are scanned by column or filtered: their columns and row
    groups can be left out.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
