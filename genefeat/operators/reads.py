"""Protein sets, read samples and aligned reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import save


def dedup_proteins(proteins: DataFrame, min_length: int = 100) -> DataFrame:
    """(name, seq): one row a sequence of min_length or more, with its largest header."""
    return proteins.filter(F.length("seq") >= min_length).groupBy("seq").agg(F.max("name").alias("name")).select("name", "seq")


def reheader_proteins(proteins: DataFrame) -> DataFrame:
    """Headers cut to taxon_version:id; others stay."""
    return proteins.withColumn("name", F.coalesce(F.nullif(F.regexp_extract("name", r"^(>?[0-9]+_[0-9]:\w+)", 1), F.lit("")), F.col("name")))


def sample_size(n: int, limit: int | None, fraction: float | None, method: int | None) -> int:
    """How many of n reads are wanted. Without a fraction the limit; with one, method 1 takes the share alone, 0 (and no
    method) the smaller of both. Shares are rounded half to even."""
    if method not in (None, 0, 1):
        raise ValueError(f"unknown method {method}")
    if fraction is None:
        return n if limit is None else min(n, limit)
    share = round(n * fraction)
    return min(n, share if method == 1 or limit is None else min(limit, share))


_DIGIT = 12


def smallest(values: DataFrame, column: str, n: int) -> tuple[Column, int, int | None]:
    """(condition on the bigint column that the rows with a smaller prefix meet, how many rows of the last value it leaves
    out, that value). The n-th smallest value is found digit by digit: each pass counts rows by the next 12 bits among
    those with the prefix so far, so only counts leave a task. Stops as soon as a prefix ends at exactly n rows."""
    ordered = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))  # in order as an unsigned number
    bits, prefix, left = 64, 0, n
    while bits:
        shift = max(0, bits - _DIGIT)
        within = values if bits == 64 else values.filter(F.shiftrightunsigned(ordered, bits) == prefix)
        digit = F.shiftrightunsigned(ordered, shift).bitwiseAND(F.lit((1 << (bits - shift)) - 1))
        counts = dict(within.groupBy(digit.alias("digit")).count().collect())  # 4,096 rows at most
        for d in sorted(counts):
            if left <= counts[d]:
                break
            left -= counts[d]
        prefix, bits = (prefix << (bits - shift)) | d, shift
        if bits and left == counts[d]:
            return F.shiftrightunsigned(ordered, bits) <= prefix, 0, None
    value = prefix - (1 << 63)
    return (F.col(column) < value, left, value) if left < counts[d] else (F.col(column) <= value, 0, None)


def subsample_reads(reads: DataFrame, limit: int | None = None, fraction: float | None = None, method: int | None = None, key: Column | None = None, seed: int = 0) -> DataFrame:
    """reads (read_no, ...) of an exact number of read numbers, the same ones for both mates, by smallest key (a bigint, by
    default a hash of the read number), then smallest number. Nothing is left out where all reads are wanted.

    Read numbers are those of the first mate, as a pair of files numbers both alike; without a column `mate` they are
    the distinct ones. The last key to be taken is found by counts, and reads are filtered where they lie."""
    own = F.xxhash64(F.lit(seed), "read_no") if key is None else key
    keyed = reads.withColumns({"__k": own.cast("bigint"), "__no": F.col("read_no").cast("bigint")})
    if "mate" in reads.columns:
        numbers = keyed.filter(F.col("mate").eqNullSafe(F.lit(reads.agg(F.min("mate")).first()[0]))).select("__k", "__no")
    else:
        numbers = keyed.select("__k", "__no").distinct()
    numbers = save(numbers.filter("__no is not null"))
    n = numbers.count()
    target = sample_size(n, limit, fraction, method)
    if target >= n:
        return reads
    if target <= 0:
        return reads.limit(0)
    taken, left, value = smallest(numbers, "__k", target)
    if left:
        tied = numbers.filter(F.col("__k") == value)
        also, more, last = smallest(tied, "__no", left)
        if more:  # numbers that repeat within a mate
            also = also | (F.col("__no") == last)
        taken = taken | ((F.col("__k") == value) & also)
    return keyed.filter(taken).select(*reads.columns)


def bed12_to_exons(bed: DataFrame) -> DataFrame:
    """A row for each block with a size: (name, seq_region, strand, rank, start, end)."""
    blocks = F.posexplode(F.arrays_zip(F.col("sizes").alias("size"), F.col("starts").alias("at")))
    told = bed.select("name", "seq_region", "strand", "offset", blocks.alias("rank", "b"))
    start = F.col("offset") + F.col("b.at") + 1
    out = told.select("name", "seq_region", "strand", (F.col("rank") + 1).cast("bigint").alias("rank"), start.alias("start"), (start + F.col("b.size") - 1).alias("end"))
    return out.filter("end >= start")


def bed12_to_transcripts(bed: DataFrame) -> DataFrame:
    from .models import build_transcripts

    return build_transcripts(bed12_to_exons(bed).withColumnRenamed("name", "transcript_id"))


def clade_members(levels: DataFrame, level2species: DataFrame, taxon: str) -> DataFrame:
    """(species): members of a clade, by its name or number. levels (level_id, name); level2species (level_ids, species,
    ..): level_ids holds the clade's number, and the species is the last of the comma-separated path."""
    wanted = levels.filter((F.col("name") == taxon) | (F.col("level_id").cast("string") == taxon)).select(F.col("level_id").cast("string").alias("level_id"))
    path = level2species.withColumn("__path", F.split(F.regexp_replace("path", r"[{}\s]", ""), ","))
    each = path.select("species", F.element_at("__path", -1).alias("last"), F.explode("__path").alias("level_id"))
    return each.join(wanted, "level_id", "left_semi").select("species").distinct()
