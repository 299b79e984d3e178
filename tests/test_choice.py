"""Choice among overlapping hits against brute force, on deep spots, and along chains over many pieces."""

import random

import pytest
from pyspark.sql import functions as F

from genefeat.operators.choice import resolve_overlaps

HITS = "seq_region string, strand string, start bigint, end bigint, accession string, score double, __id int, note string"


def brute_force(rows, mode):
    """Indexes of the rows that stay: greedily, or beaten by any better one. Rows without a place overlap nothing."""
    none = lambda x: (x is not None, x)
    order = lambda r: (none(None if r[5] is None else -r[5]), none(r[4]), r[2], r[3])
    hit = lambda a, b: None not in a[:4] + b[:4] and a[:2] == b[:2] and a[2] <= b[3] and b[2] <= a[3]
    if mode == "beaten":
        return [i for i, r in enumerate(rows) if not any(hit(r, b) and order(b) < order(r) for b in rows)]
    kept = []
    for i in sorted((i for i, r in enumerate(rows) if None not in r[:4]), key=lambda i: order(rows[i])):
        if not any(hit(rows[i], rows[k]) for k in kept):
            kept.append(i)
    return kept + [i for i, r in enumerate(rows) if None in r[:4]]


@pytest.mark.parametrize("mode", ["greedy", "beaten"])
@pytest.mark.parametrize("piece", [1, 7, 50, 1_000_000])
def test_choice_is_brute_force(spark, mode, piece):
    random.seed(piece)
    rows = []
    for i in range(220):
        start = random.randint(0, 900)
        score = random.choice([None, 1.0, 2.0, 2.0, 3.5, float(random.randint(0, 500))])
        rows.append((random.choice("ab"), random.choice("+-"), start, start + random.choice([0, 3, 12, 12, 150]), random.choice([None, "x", "y", "z"]), score, i, None))
    rows += [(None, "+", 5, 10, "x", 9.0, 500, "no region"), ("a", None, 5, 10, "x", 9.0, 501, "no strand"), ("a", "+", None, None, "x", 9.0, 502, "no place")]
    rows = list({r[:6]: r for r in rows}.values())  # one of equals, as greedy may keep any
    got = resolve_overlaps(spark.createDataFrame(rows, HITS), mode, piece=piece)
    assert got.columns == ["seq_region", "strand", "start", "end", "accession", "score", "__id", "note"]
    assert sorted(r["__id"] for r in got.collect()) == sorted(rows[i][6] for i in brute_force(rows, mode))


def test_turned_repeated_and_equal_hits(spark):
    rows = [("a", "+", 30, 10, "x", 1.0, 1, "p"), ("a", "+", 30, 10, "x", 1.0, 1, "p"), ("a", "+", 10, 30, "x", 1.0, 2, "q"), ("a", "+", 10, 30, "y", 1.0, 3, "r")]
    hits = spark.createDataFrame(rows, HITS)
    assert sorted(r["__id"] for r in resolve_overlaps(hits).collect()) == [1, 2]
    one = resolve_overlaps(hits, "greedy").collect()
    assert len(one) == 1 and one[0].start == 10 and one[0]["__id"] in (1, 2)
    for mode in ("greedy", "beaten"):
        assert resolve_overlaps(hits.limit(0), mode).collect() == []
    with pytest.raises(ValueError):
        resolve_overlaps(hits, "best")


@pytest.mark.parametrize("mode", ["greedy", "beaten"])
def test_a_hundred_thousand_hits_on_one_spot(spark, mode):
    """All overlap, so there are 5 * 10^9 pairs; hits elsewhere stay."""
    i = F.col("id")
    deep = spark.range(100_000).select(F.lit("r").alias("seq_region"), F.lit("+").alias("strand"), (i % 1000).alias("start"), (2000 + i).alias("end"), F.lit("m").alias("accession"), (i * 7919 % 100_003).cast("double").alias("score"))
    far = deep.filter("score = 5").withColumns({"start": F.lit(500_000).cast("bigint"), "end": F.lit(500_010).cast("bigint")})
    got = sorted((r.start, r.score) for r in resolve_overlaps(deep.unionByName(far), mode, piece=10_000).collect())
    top = max((k * 7919 % 100_003, k % 1000) for k in range(100_000))
    assert got == [(top[1], float(top[0])), (500_000, 5.0)]


@pytest.mark.parametrize("piece", [100, 1_000_000])
def test_a_chain_of_five_thousand(spark, piece):
    """Each hit overlaps the next one and is better than it: every second one stays, decided from one end on."""
    i = F.col("id")
    chain = spark.range(5000).select(F.lit("r").alias("seq_region"), F.lit("+").alias("strand"), (i * 10).alias("start"), (i * 10 + 12).alias("end"), F.lit("m").alias("accession"), (-i).cast("double").alias("score"))
    got = sorted(r.start for r in resolve_overlaps(chain, "greedy", piece=piece).collect())
    assert got == list(range(0, 50_000, 20))
    assert [r.start for r in resolve_overlaps(chain, piece=piece).collect()] == [0]
