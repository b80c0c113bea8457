"""What the operators share: tables, stored results, keys and small column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.session import shared_folder

#: Stands for a missing doc_id inside a job, so that joins and orders are defined; sorts first.
NO_ID = -(2**63)
#: White space of the word definitions: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and read it from there.

    Cuts the lineage and survives the loss of executors; the columns can be pruned.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(df: DataFrame) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(df["text"], F.lit(""))


def id_of(df: DataFrame) -> Column:
    """The doc_id, a missing one as ``NO_ID``."""
    return F.coalesce(df["doc_id"].cast("long"), F.lit(NO_ID))


def shown_id(name: str) -> Column:
    """The doc_id as it was given."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each value starts and ends."""
    wide = pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if not len(array) or array.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
