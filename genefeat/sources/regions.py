"""Which files of a GTF folder hold which regions, so that a reader of some regions opens only their files.

The index is a small Parquet table in the folder's `_regions` (names that begin with _ are not read as data): path, size, modified,
seq_region, n_lines. A line that has not nine columns may belong to any region, and is counted under a null one. Files
that the index doesn't know with this size and time are always read, so an index that is old, or is missing, costs time
only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INDEX = "path string, size bigint, modified timestamp, seq_region string, n_lines bigint"
_FILE = ["path", "size", "modified"]


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, path, size, modified) of files that aren't empty; file is a name to read it by. Contents are not read."""
    meta = "_metadata"
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col(f"{meta}.file_path").alias("path"), F.col(f"{meta}.file_size").alias("size"), F.col(f"{meta}.file_modification_time").alias("modified"))


def _at(path: str, index: str | None) -> str:
    return index or f"{path.rstrip('/')}/_regions"


def write_region_index(spark: SparkSession, path: str, index: str | None = None) -> None:
    """Index the GTF files below path; again, if they have changed. One pass over their first columns, partly summed in each
    task: a row for each region of each file is all that is shuffled."""
    meta = "_metadata"
    lines = spark.read.text(path).select(*(F.col(f"{meta}.file_{x}").alias(n) for x, n in (("path", "path"), ("size", "size"), ("modification_time", "modified"))), F.regexp_replace("value", r"\r$", "").alias("line"))
    fields = F.split("line", "\t")
    region = F.when(F.size(fields) == 9, fields[0])
    data = lines.filter(~F.col("line").startswith("#") & (F.trim("line") != "")).groupBy(*_FILE, region.alias("seq_region")).agg(F.count("*").alias("n_lines"))
    # Files of comments only are listed too: they have no region that anyone asks for.
    empty = lines.select(*_FILE).distinct().join(data.select(*_FILE), _FILE, "left_anti").select(*_FILE, F.lit("").alias("seq_region"), F.lit(0).cast("bigint").alias("n_lines"))
    data.unionByName(empty).orderBy("seq_region", "path").write.mode("overwrite").parquet(_at(path, index))


def region_index(spark: SparkSession, path: str, index: str | None = None) -> DataFrame:
    try:
        return spark.read.schema(_INDEX).parquet(_at(path, index))
    except AnalysisException:  # none was written
        return spark.createDataFrame([], _INDEX)


def region_files(spark: SparkSession, path: str, regions: list[str], index: str | None = None) -> list[str]:
    """The files below path that may hold lines of these regions (or malformed ones)."""
    asked = F.col("seq_region").isNull() | F.col("seq_region").isin(*regions)
    known = region_index(spark, path, index).groupBy(*_FILE).agg(F.bool_or(asked).alias("hit"))
    found = list_files(spark, path).join(known, _FILE, "left").filter(F.coalesce("hit", F.lit(True)))
    return sorted(r.file for r in found.select("file").collect())  # a row a file
