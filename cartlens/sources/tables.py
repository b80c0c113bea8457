"""Reading raw files and tables, writing and re-reading results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.sources.runs import published_path

NAMESPACES = ("raw", "staging", "intermediate", "seeds", "analytics")
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
#: Columns of a row's place in the files.
FILE, ROW_IN_FILE = "_file", "_row_in_file"
FLAT_TABLES = ("fct_events", "fct_sessions", "fct_daily_metrics", "fct_product_performance")


def read_event_files(
    spark: SparkSession, folder: str, schema: T.StructType | None = None, places: bool = False
) -> DataFrame:
    """All ``events_*.parquet`` of a folder as one table; an error if there is none.

    Without a schema the table has the columns of all files; a row is null in those that its
    file lacks. Files whose timestamps count nanoseconds are read to the microsecond. With ``places``
    every row knows its file and its place in it (``FILE`` and ``ROW_IN_FILE``).
    """
    pattern = f"{folder}/events_*.parquet"

    def placed(df: DataFrame) -> DataFrame:
        if not places:
            return df
        return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW_IN_FILE))

    if schema is not None:
        return placed(spark.read.schema(schema).parquet(pattern))
    try:
        return placed(spark.read.option("mergeSchema", True).parquet(pattern))
    except AnalysisException as error:
        if not _counts_nanoseconds(error):
            raise
    # the reading tasks need it as well
    spark.conf.set(NANOS_AS_LONG, "true")
    plain, counting = _by_unit(spark, pattern)
    merged = spark.read.option("mergeSchema", True)
    parts = [placed(merged.parquet(*plain))] if plain else []
    if counting:
        numbers = placed(merged.parquet(*counting))
        parts.append(numbers.withColumn("timestamp", _moment_of_number(F.col("timestamp"))))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _by_unit(spark: SparkSession, pattern: str) -> tuple[list[str], list[str]]:
    """The files whose timestamps Spark can read as such, and the others that have rows.

    Two jobs over all files, whatever their number: one asks for the timestamps and skips files
    where they have another type, the other lists the files with rows. The driver sees paths.
    """

    asked = spark.read.schema("timestamp timestamp_ntz").option("ignoreCorruptFiles", True).parquet(pattern)
    # an aggregate of the time, so that it is read and not only the place
    read = asked.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("timestamp").alias("n"))
    plain = {row["path"] for row in read.collect()}
    places = spark.read.schema("event_id string").parquet(pattern).select("_metadata.file_path").distinct()
    every = {row["file_path"] for row in places.collect()}
    return sorted(plain), sorted(every - plain)


def _counts_nanoseconds(error: AnalysisException) -> bool:
    return error.getCondition() == "PARQUET_TYPE_ILLEGAL" and "TIMESTAMP(NANOS" in str(error)


def _moment_of_number(number: Column) -> Column:
    """The time of a count of nanoseconds; smaller numbers are left to validation's rule for them.

    10^17 nanoseconds end in March 1973, as many milliseconds in the year 3,170,843.
    """
    nanoseconds = F.abs(number) >= 10**17
    micros = F.when(nanoseconds, F.expr("timestamp div 1000"))
    seconds = F.when(F.abs(number) <= 10**10, F.timestamp_seconds(number)).otherwise(F.timestamp_millis(number))
    return F.when(nanoseconds, F.timestamp_micros(micros)).otherwise(seconds).cast("timestamp_ntz")


def with_row_numbers(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows that know their place, numbered from 0 over all files in the order of their paths.

    ``files`` are all rows of the files; they are counted per file, and only those counts are put
    in order, a row per file. So any part of the rows can be numbered without sorting the rest.
    """
    earlier = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    counts = files.groupBy(FILE).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(FILE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    numbered = rows.join(starts, FILE).withColumn("row", F.col("_start") + F.col(ROW_IN_FILE))
    return numbered.drop("_start", FILE, ROW_IN_FILE)


def source(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """A source table of the catalog."""
    return spark.table(f"{namespace}.{table}")


def create_namespaces(spark: SparkSession, names: Iterable[str] = NAMESPACES) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_file(df: DataFrame, folder: str, name: str) -> str:
    """Replace ``<folder>/<name>.parquet``."""
    path = f"{folder}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_table(df: DataFrame, name: str, namespace: str = "analytics") -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{namespace}.{name}")


def register_table(
    spark: SparkSession, path: str, name: str, namespace: str = "analytics", by: str | None = None
) -> None:
    """Make written files known as a catalog table without copying them."""
    spark.sql(f"DROP TABLE IF EXISTS {namespace}.{name}")
    spark.catalog.createTable(f"{namespace}.{name}", path=path, source="parquet")
    if by is not None:
        spark.catalog.recoverPartitions(f"{namespace}.{name}")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A view: computed again wherever it is used."""
    df.createOrReplaceTempView(name)
    return df


def read_file(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A written table, of the newest published run if there is one; None when it is absent."""
    path = published_path(spark, folder, name)
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_flat_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The flat tables that exist."""
    tables = {name: read_file(spark, folder, name) for name in FLAT_TABLES}
    return {name: df for name, df in tables.items() if df is not None}


def export_reference_data(products: DataFrame, users: DataFrame, folder: str) -> None:
    """Catalogue and user profiles; e-mail addresses are left out."""
    write_file(products, folder, "products")
    write_file(users.drop("email"), folder, "users")


def read_reference_data(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Catalogue and user profiles as exported; an error if one is absent."""
    return spark.read.parquet(f"{folder}/products.parquet"), spark.read.parquet(f"{folder}/users.parquet")
