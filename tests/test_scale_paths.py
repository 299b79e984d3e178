"""Sub-chains, clusters by pieces and interval levels against brute force, on what is deep or long."""

import random

import pytest
from pyspark.sql import functions as F

from genefeat.operators import clusters, evidence, intervals

CHAINS = "cluster string, chain array<struct<start:bigint,end:bigint>>"


def told(chain):
    return "".join(f"{a}..{b}:" for a, b in chain)


@pytest.mark.parametrize("by_text", [True, False])
def test_sub_chains_are_brute_force(spark, by_text):
    random.seed(3)
    rows = {("x", ((5100, 5200), (6000, 6100))), ("x", ((100, 5200), (6000, 6100))), ("x", ((100, 5200),)), ("y", ((100, 5200),)), ("x", ())}
    for _ in range(150):
        at = sorted(random.sample(range(10, 130), random.choice([2, 4, 6, 10])))
        rows.add((random.choice("ab"), tuple((at[i], at[i + 1]) for i in range(0, len(at), 2))))
    for cluster, chain in list(rows):
        if len(chain) > 1:
            i = random.randrange(len(chain))
            rows.add((cluster, chain[i : i + random.randint(1, len(chain))]))
    part = lambda a, b: (told(a) in told(b)) if by_text else any(b[i : i + len(a)] == a for i in range(len(b)))
    want = {(c, a) for c, a in rows if a and any(d == c and b != a and part(a, b) for d, b in rows)}
    got = evidence.sub_chains(spark.createDataFrame([(c, list(a)) for c, a in rows], CHAINS), by_text).collect()
    assert {(r.cluster, tuple(map(tuple, r.chain))) for r in got} == want and len(got) == len(want) > 5


def test_ten_thousand_chains_of_one_cluster(spark):
    """All share introns, so that chains meet in all positions."""
    first = F.col("id").cast("bigint") % 100
    chain = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct((i * 1000 + F.when(i == 9, F.col("id")).when(i == 0, first).otherwise(0)).cast("bigint").alias("start"), (i * 1000 + 500).cast("bigint").alias("end")))
    whole = spark.range(10_000).select(F.lit("c").alias("cluster"), chain.alias("chain"))
    parts = whole.select("cluster", F.slice("chain", 3, 4).alias("chain")).limit(1).unionByName(whole.limit(50).select("cluster", F.slice("chain", 1, 9).alias("chain")))
    got = evidence.sub_chains(whole.unionByName(parts).distinct())
    assert got.count() == 51


def tx(spark, exons):
    rows = [(i, "r", s, min(a for a, _ in e), max(b for _, b in e), [{"start": a, "end": b} for a, b in e], min(a for a, _ in e), max(b for _, b in e)) for i, s, e in exons]
    return spark.createDataFrame(rows, "transcript_id string, seq_region string, strand string, start bigint, end bigint, exons array<struct<start:bigint,end:bigint>>, cds_start bigint, cds_end bigint")


@pytest.mark.parametrize(("piece", "most_edges"), [(1_000_000, 4_000_000), (300, 4_000_000), (300, 12), (1000, 0)])
def test_clusters_by_pieces_are_brute_force(spark, piece, most_edges):
    random.seed(piece + most_edges)
    exons = []
    for i in range(160):
        at = random.randint(0, 5000)
        own = []
        for _ in range(random.choice([1, 1, 2, 3])):
            own.append((at, at + random.choice([3, 10, 40])))
            at += random.randint(50, random.choice([100, 100, 900]))
        exons.append((f"t{i:03d}", random.choice("+-"), own))
    label = list(range(len(exons)))
    hit = lambda a, b: a[1] == b[1] and any(x <= v and u <= y for x, y in a[2] for u, v in b[2])
    pairs = [(i, j) for i in range(len(exons)) for j in range(i) if hit(exons[i], exons[j])]
    for _ in exons:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    got = {r.transcript_id: (r.cluster, r.cluster_size) for r in clusters.cluster_by_coding_exon(tx(spark, exons), piece, most_edges).collect()}
    assert got == {exons[i][0]: (exons[label[i]][0], label.count(label[i])) for i in range(len(exons))}


@pytest.mark.parametrize("spans", [((10,), (10,)), ((10, 70_000), (10,)), ((10,), (9_000, 5_000_000)), ((5_000_000,), (10, 600, 9_000, 70_000)), ((10,), ())])
def test_pairs_over_levels(spark, spans):
    random.seed(len(spans[0]))
    side = lambda sizes, n: [("r", "+", s := random.randint(1, 3_000_000), s + random.choice(sizes), i) for i in range(n)] if sizes else []
    a, b = side(spans[0], 150), side(spans[1], 150)
    shape = "seq_region string, strand string, start bigint, end bigint, id int"
    got = [(r.l.id, r.r.id) for r in intervals.overlap_pairs(spark.createDataFrame(a, shape), spark.createDataFrame(b, shape)).collect()]
    want = [(x[4], y[4]) for x in a for y in b if x[2] <= y[3] and y[2] <= x[3]]
    assert sorted(got) == sorted(want)
