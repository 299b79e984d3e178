"""Ingest jobs: a directory of tool output into a feature table, its malformed lines into a rejects table.

    <out>/features/analysis=<a>/seq_region=<r>/   rows, with path and batch (no region folder where rows have none)
    <out>/features_by_file/analysis=<a>/          the same with seq_region in the files, for runs over very many regions
    <out>/rejects/analysis=<a>/                   path, line, batch
    <out>/manifest/analysis=<a>/                  path, size, modified, batch, columns, by_file: what has been read, and how

A run reads the files that the manifest doesn't have with this size and time, and adds its batch to the manifest last. So
a run that breaks off leaves rows of a batch that nobody knows and nobody reads, and the next one reads those files anew. A
file that has changed is read again; its rows of earlier batches count no more. Empty files are not listed, and a file
that is gone keeps its rows. One run at a time writes an analysis.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.tables import drop_saved, save
from .regions import list_files
from .tools import Paths

Reader = Callable[[SparkSession, list[str]], tuple[DataFrame, DataFrame]]
_MANIFEST = "path string, size bigint, modified timestamp, batch string, columns string, by_file boolean"
#: A run over more regions than this writes no folder for each: folders are made, listed and opened one by one.
MOST_FOLDERS = 1000


def _at(out: str, table: str, analysis: str) -> str:
    return f"{out.rstrip('/')}/{table}/analysis={analysis}"


def manifest(spark: SparkSession, out: str, analysis: str) -> DataFrame:
    """(path, size, modified, batch) of all runs that ended."""
    try:
        return spark.read.schema(_MANIFEST).parquet(_at(out, "manifest", analysis))
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], _MANIFEST)


def _current(known: DataFrame) -> DataFrame:
    return known.groupBy("path").agg(F.max("batch").alias("batch"))


def new_files(spark: SparkSession, path: Paths, known: DataFrame) -> DataFrame:
    """(file, path, size, modified) of files that known has not, or with another size or time. Contents are not read."""
    found = list_files(spark, path)
    seen = known.join(_current(known), ["path", "batch"], "left_semi").select("path", "size", "modified")
    return found.join(seen, ["path", "size", "modified"], "left_anti")


def write_features(rows: DataFrame, rejects: DataFrame, out: str, analysis: str, batch: str) -> bool:
    """Rows by region: a rebalance gives each region few files and splits a region that has many rows. Over MOST_FOLDERS
    regions the files are ordered by region instead, so that a filter skips what they don't hold; True is returned then."""
    told = rows.withColumn("batch", F.lit(batch))
    by_file = False
    if "seq_region" in rows.columns:
        parsed = save(told)  # lines are parsed once, to count regions and to write
        by_file = parsed.select("seq_region").distinct().limit(MOST_FOLDERS + 1).count() > MOST_FOLDERS
        dealt = parsed.hint("rebalance", "seq_region")
        if by_file:
            dealt.sortWithinPartitions("seq_region").write.mode("append").parquet(_at(out, "features_by_file", analysis))
        else:
            dealt.write.mode("append").partitionBy("seq_region").parquet(_at(out, "features", analysis))
        drop_saved(parsed)
    else:
        told.write.mode("append").parquet(_at(out, "features", analysis))
    rejects.select("path", "line").withColumn("batch", F.lit(batch)).write.mode("append").parquet(_at(out, "rejects", analysis))
    return by_file


def ingest(spark: SparkSession, reader: Reader, path: Paths, out: str, analysis: str) -> int:
    """Read what is new below path by reader(spark, files) -> (rows with path, rejects); how many files that were."""
    known = manifest(spark, out, analysis)
    fresh = new_files(spark, path, known).collect()  # a row a file
    if not fresh:
        return 0
    batch = f"{known.select('batch').distinct().count():08d}-{uuid.uuid4().hex}"  # later ones sort after earlier ones
    rows, rejects = reader(spark, [f.file for f in fresh])
    by_file = write_features(rows, rejects, out, analysis, batch)
    entries = [(f.path, f.size, f.modified, batch, rows.schema.json(), by_file) for f in fresh]
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(_at(out, "manifest", analysis))
    return len(fresh)


def _written(spark: SparkSession, at: str, columns: list[str | None]) -> DataFrame:
    """A table of runs with these columns, which the manifest tells; runs of before it did are asked for theirs."""
    schemas = [StructType.fromJson(json.loads(c)) for c in columns if c]
    if None in columns:
        schemas.append(spark.read.option("mergeSchema", True).parquet(at).schema)
    fields = {f.name: f for schema in schemas for f in schema} | {"batch": StructField("batch", StringType())}
    # Regions are names, also where they look like numbers.
    return spark.read.schema(StructType([StructField(n, StringType()) if n == "seq_region" else f for n, f in fields.items()])).parquet(at)


def _current_rows(rows: DataFrame, known: DataFrame) -> DataFrame:
    old = known.join(_current(known), ["path", "batch"], "left_anti").select("path", "batch")
    ended = known.select("batch").distinct()
    rows = rows.join(F.broadcast(ended), "batch", "left_semi")  # a row a run
    return (rows if old.isEmpty() else rows.join(old, ["path", "batch"], "left_anti")).drop("batch")


def read_features(spark: SparkSession, out: str, analysis: str) -> DataFrame:
    """The rows of an analysis; a filter on seq_region chooses folders before anything is read, and skips parts of files of
    runs that wrote no folders."""
    known = manifest(spark, out, analysis)
    runs = known.select("columns", F.coalesce("by_file", F.lit(False)).alias("by_file")).distinct().collect()  # few: a row for each form
    rows = None
    for table, by_file in (("features", False), ("features_by_file", True)):
        columns = [r.columns for r in runs if r.by_file == by_file]
        if columns or (not runs and not by_file):
            one = _written(spark, _at(out, table, analysis), columns or [None])
            rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return _current_rows(rows, known)


def read_rejects(spark: SparkSession, out: str, analysis: str) -> DataFrame:
    rows = spark.read.schema("path string, line string, batch string").parquet(_at(out, "rejects", analysis))
    return _current_rows(rows, manifest(spark, out, analysis))
