import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from genefeat.operators import intervals
from genefeat.operators.graph import connected_components

SCHEMA = "id int, seq_region string, strand string, start bigint, end bigint"
rows = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from("+-"), st.integers(1, 5000), st.sampled_from([0, 1, 30, 999, 1000, 40_000])), max_size=25)
slow = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, found):
    return spark.createDataFrame([(i, r, s, a, a + n) for i, (r, s, a, n) in enumerate(found)], SCHEMA)


@slow
@given(rows, rows)
def test_overlap_join_is_the_nested_loop(spark, left, right):
    a, b = table(spark, left), table(spark, right)
    got = sorted((x.l.id, x.r.id) for x in intervals.overlap_join(a, b, width=100).collect())
    assert got == sorted((i, j) for i, (r, s, x, n) in enumerate(left) for j, (q, t, y, m) in enumerate(right) if r == q and s == t and x <= y + m and y <= x + n)
    inside = sorted((x.l.id, x.r.id) for x in intervals.containment_join(a, b, width=100).collect())
    assert inside == sorted((i, j) for i, (r, s, x, n) in enumerate(left) for j, (q, t, y, m) in enumerate(right) if r == q and x <= y and y + m <= x + n)


@slow
@given(rows)
def test_span_clusters_are_components(spark, found):
    got = {x.id: x.cluster_start for x in intervals.cluster_by_span(table(spark, found), piece=500).collect()}
    label = {i: i for i in range(len(found))}
    for _ in found:
        for i, (r, s, x, n) in enumerate(found):
            for j, (q, t, y, m) in enumerate(found):
                if r == q and s == t and x <= y + m and y <= x + n:
                    label[i] = label[j] = min(label[i], label[j])
    firsts = {}
    for i, (_, _, x, _) in enumerate(found):
        firsts[label[i]] = min(x, firsts.get(label[i], x))
    assert got == {i: firsts[label[i]] for i in label}


def test_touching_and_adjacent(spark):
    a = table(spark, [("a", "+", 10, 10)])
    assert intervals.overlap_pairs(a, table(spark, [("a", "+", 20, 5)])).count() == 1
    assert intervals.overlap_pairs(a, table(spark, [("a", "+", 21, 5)])).count() == 0
    assert intervals.overlap_pairs(a, table(spark, [("a", "-", 10, 5)])).count() == 0
    assert intervals.overlap_join(a, table(spark, []), how="anti", key="id").count() == 1


def test_components_are_union_find(spark):
    random.seed(4)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: root(x) for x in parent}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


@pytest.mark.parametrize("a,b,n", [((1, 10), (5, 20), 6), ((1, 10), (11, 20), 0), ((1, 10), (10, 10), 1)])
def test_overlap_length(spark, a, b, n):
    from pyspark.sql import functions as F

    assert spark.range(1).select(intervals.overlap_length(F.lit(a[0]), F.lit(a[1]), F.lit(b[0]), F.lit(b[1])).alias("n")).first().n == n
