"""Runs that publish all their tables or none.

A run writes its tables into a folder of its own, ``<target>/runs/<run>``, and notes each one as it
is complete. When all are there, one file with a row per table is added to ``<target>/manifest``.
Readers follow the newest entry of the manifest, so they see the tables of one run, and those of
the run before as long as a run lasts or if it fails. A run that is repeated under its name over
the same inputs keeps the tables it has noted and builds the rest.

Nothing is renamed or deleted: folders of earlier runs can go when nobody reads them any more.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NOTES = "table string, rows bigint, inputs string, figures string"
MANIFEST = "number bigint, run string, inputs string, table string, path string"


def _entries(spark: SparkSession, path: str, schema: str) -> list:
    try:
        return spark.read.schema(schema).json(path).collect()  # a row per table of each run
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def fingerprint(spark: SparkSession, pattern: str) -> str:
    """Changes when files are added, removed or written again."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("*")).alias("hash")).first()
    return f"{found['n']}-{found['hash']}"


class Run:
    """The tables of one run; ``name`` lets a later call go on with it."""

    def __init__(self, spark: SparkSession, target: str, name: str | None = None, inputs: str = "") -> None:
        self.spark, self.target, self.inputs = spark, target, inputs
        name = name or uuid.uuid4().hex
        entries = _entries(spark, f"{target}/manifest", MANIFEST)
        self.newest = max((entry["number"] for entry in entries), default=0)
        published = [entry for entry in entries if entry["run"].split("/")[0] == name]
        same = [entry["run"] for entry in published if entry["inputs"] == inputs]
        # what is published stays as it is: other inputs get another folder
        self.name = same[0] if same else f"{name}/{len({entry['number'] for entry in published})}"
        self.published = bool(same)
        self.folder = f"{target}/runs/{self.name}"
        notes = _entries(spark, f"{self.folder}/notes/*", NOTES)
        self.notes = {note["table"]: note for note in notes if note["inputs"] == inputs}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def has(self, table: str) -> bool:
        return table in self.notes

    @property
    def loaded(self) -> dict[str, int]:
        """Rows of the complete tables."""
        return {table: note["rows"] for table, note in self.notes.items()}

    def figures(self, table: str) -> dict:
        return json.loads(self.notes[table]["figures"])

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def write(self, df: DataFrame, table: str, by: str | None = None, watched: Observation | None = None) -> None:
        """Write a table unless it is complete, count its rows on the way and note it.

        ``watched`` are figures that the plan observes itself; they are noted too. With ``by`` there is
        a folder per value of that column: rows of a value are brought together first, and split again
        where they are many, so that neither many small files nor a hot task come of it.
        """
        if self.has(table):
            return
        seen = Observation(f"rows of {table}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if by is None:
            counted.write.mode("overwrite").parquet(self.path(table))
        else:
            spread = counted.hint("rebalance", F.col(by))
            spread.write.mode("overwrite").partitionBy(by).parquet(self.path(table))
        figures = json.dumps(watched.get if watched else {})
        note = {"table": table, "rows": seen.get["rows"], "inputs": self.inputs, "figures": figures}
        # a folder each, because tables are written at the same time
        written = self.spark.createDataFrame([tuple(note.values())], NOTES).coalesce(1)
        written.write.mode("append").json(f"{self.folder}/notes/{table}")
        self.notes[table] = note

    def publish(self, tables: list[str]) -> None:
        """Let readers see these tables, which must be complete, instead of those of the run before."""
        if self.published:
            return
        missing = [table for table in tables if not self.has(table)]
        if missing:
            raise ValueError(f"not written yet: {', '.join(missing)}")
        # in the order of time, also where a clock goes back
        number = max(self.newest + 1, time.time_ns() // 1000)
        rows = [(number, self.name, self.inputs, table, f"runs/{self.name}/{table}.parquet") for table in tables]
        # one file, whose appearance is what publishes the run
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(f"{self.target}/manifest")
        self.published = True


def published_path(spark: SparkSession, folder: str, table: str) -> str | None:
    """Where the newest run has a table; a file of that name where no run ever had it.

    None if earlier runs had the table and the newest has not.
    """
    entries = _entries(spark, f"{folder}/manifest", MANIFEST)
    newest = max((entry["number"] for entry in entries), default=None)
    for entry in entries:
        if entry["number"] == newest and entry["table"] == table:
            return f"{folder}/{entry['path']}"
    if any(entry["table"] == table for entry in entries):
        return None
    return f"{folder}/{table}.parquet"
