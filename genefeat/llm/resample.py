"""Quality classifier (4): importance resampling with hashed n-gram models, sampled by Gumbel top-k.

Two generative models over hashed word unigrams and bigrams: the raw one counts every document, the target one the
documents that labels call good. A document's log weight is the log ratio of its probabilities under the two, the sum
over its n-grams, divided by `temperature` (1: importance resampling as such; more of it brings the draw nearer to a
uniform one). Adding Gumbel noise and keeping the largest k is sampling k documents without replacement in proportion to
the weights.

The target model is fitted on at most `most_targets` labelled documents (those of the smallest id hashes); the raw model,
the scores and the selection cover all documents. The kth largest key is found by counting: each round splits the range
that holds it into 4,096 parts, so the driver sees 4,096 counts at a time whatever k is.

Defined results: null and empty texts come last (log weight EMPTY); ids that repeat share their noise; equal keys are
kept by smaller id as far as k goes, and identical ids with them all together. Ids may be of any type; other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, binary_list, save, windows
from .mixing import uniform


#: Log weight of a text without words: below all others.
EMPTY = -1e9


def places(text: bytes | None, hashes: Hashes, buckets: int) -> np.ndarray:
    """Buckets of the text's unigrams and bigrams."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    h = hashes.of(words)
    found = [h] if len(h) < 2 else [h, windows(h, 2)]
    return (np.concatenate(found) % np.uint64(buckets)).astype(np.int64)


def fit(docs: DataFrame, good_ids: DataFrame, id_col: str, text_col: str, buckets: int, most_targets: int) -> np.ndarray:
    """Log ratios of target to raw by bucket, both smoothed by one count."""
    chosen = good_ids.select(F.col(id_col).cast("string").alias("id")).filter("id is not null").distinct()
    sent = docs.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in chosen.orderBy(F.xxhash64("id"), "id").limit(most_targets).collect()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, both = Hashes(), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), binary_list(batch.column("text")), strict=True):
                own = np.bincount(places(text, hashes, buckets)) if text else ()
                if len(own):
                    both[0, : len(own)] += own
                    if i in sent.value:
                        both[1, : len(own)] += own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(both[0]), pa.array(both[1])], ["bucket", "raw", "target"])

    partial = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    raw, target = np.ones(buckets), np.ones(buckets)
    for b, r, t in partial.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # one row a bucket
        raw[b] += r
        target[b] += t
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratios: np.ndarray, id_col: str, text_col: str, temperature: float) -> DataFrame:
    """(id, n_ngrams, log_weight)."""
    kind, buckets = docs.schema[id_col].dataType.simpleString(), len(ratios)
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            found = [places(text, hashes, buckets) for text in binary_list(batch.column("text"))]
            weights = [float(sent.value[x].sum()) / temperature if len(x) else EMPTY for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x) for x in found], pa.int64()), pa.array(weights, pa.float64())], ["id", "n_ngrams", "log_weight"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"id {kind}, n_ngrams bigint, log_weight double").withColumnRenamed("id", id_col)


def kth_largest(keys: DataFrame, column: str, k: int, parts: int = 4096) -> tuple[float, int]:
    """(value, how many of the rows equal to it belong to the k largest), found by counting in ever smaller ranges."""
    lo, hi, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return math.inf, 0
    if k >= n:
        return lo, keys.filter(F.col(column) == lo).count()
    while lo < hi:
        width = (hi - lo) / parts
        inside = keys.filter(F.col(column).between(lo, hi))
        if not width or lo + width == lo:
            break
        part = F.least(F.floor((F.col(column) - lo) / width), F.lit(parts - 1))
        found = inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("part")).collect()  # at most `parts` rows
        for _, count, a, b in found:
            if k <= count:
                lo, hi = a, b
                break
            k -= count
    if lo < hi:  # neighbouring floats: count them one by one
        for value, count in keys.filter(F.col(column).between(lo, hi)).groupBy(column).count().orderBy(F.desc(column)).collect():
            if k <= count:
                return value, k
            k -= count
    return lo, k


def resample(docs: DataFrame, good_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = 0.8, buckets: int = 10_000, temperature: float = 1.0, most_targets: int = 50_000, seed: int = 0) -> DataFrame:
    """A row for each row of docs: id, n_ngrams, log_weight, gumbel_key, kept (the k = fraction * rows largest keys)."""
    ratios = fit(docs, good_ids, id_col, text_col, buckets, most_targets)
    noise = -F.log(-F.log((uniform(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed) * float(1 << 52) + 0.5) / float(1 << 52)))
    scored = save(log_weights(docs, ratios, id_col, text_col, temperature).withColumn("gumbel_key", F.col("log_weight") + noise))
    k = math.floor(scored.count() * fraction)
    edge, ties = kth_largest(scored, "gumbel_key", k)
    last = scored.filter(F.col("gumbel_key") == edge).select(id_col).orderBy(F.col(id_col)).limit(max(ties, 0)).agg(F.max(id_col)).first()[0] if ties else None
    at_edge = (F.col("gumbel_key") == edge) & F.coalesce(F.col(id_col) <= last, F.lit(True)) if ties else F.lit(False)
    return scored.withColumn("kept", (F.col("gumbel_key") > edge) | at_edge)
