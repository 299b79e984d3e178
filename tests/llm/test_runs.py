"""Periodic runs against brute force: tiles, stitching, planted tails, nulls, repeats, long texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from genefeat.llm import runs

from .test_operators import documents


def smallest_runs(w):
    """{(start, stop): smallest period} of all maximal runs, by definition."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return out


def plain(doc_id, text, seed):
    w = [x.decode() for x in (text or "").encode().split()]
    n = len(w)
    if seed is not None and seed % 10 == 0 and n:
        g = seed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted((s, q, e - s) for (s, e), q in smallest_runs(w).items())
    gone = {i for s, q, m in found for i in range(s + q, s + m)}
    best = min(found, key=lambda x: (-x[2] / x[1], x[0], x[1]), default=None)
    told = "".join(f"{s},{m},{q}\n" for s, q, m in found)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    head = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(found), *head, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def made(seed=2, n=60):
    random.seed(seed)
    out = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "ab " * 7 + "ab", "x " + "a b " * 3 + "a b y", "a b a b a b a"]
    for _ in range(n):
        words = []
        for _ in range(random.randint(1, 5)):
            unit = [random.choice("abcdé") for _ in range(random.choice([1, 2, 3, 5, 8, 13, 30]))]
            words += (unit * random.choice([1, 4, 5, 9]))[: random.randint(1, 300)]
            words += [f"z{random.random()}" for _ in range(random.randint(0, 4))]
        out.append(random.choice([" ", "\n", " \t"]).join(words))
    return out + out[-4:]


@pytest.mark.parametrize("tile_words", [32, 65_536])
def test_runs_are_brute_force(spark, tile_words):
    texts = made()
    ids = [None if i % 17 == 0 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids).withColumn("seed", F.crc32(F.col("doc_id").cast("string"))).withColumn("period", F.lit("x"))
    got = runs.periodic_runs(docs, seed_col="seed", tile_words=tile_words)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [plain(i, t, None if i is None else zlib.crc32(str(i).encode())) for i, t in zip(ids, texts, strict=True)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert any(w[1] > 1 for w in want)


@pytest.mark.parametrize("k", range(6))
def test_tiles_are_solved_alone(k):
    """Each tile's stretches of an octave are what its own words say, wherever it lies in the batch."""
    rng = np.random.default_rng(k)
    parts = []
    for _ in range(20):
        unit = rng.integers(1, 4, int(rng.integers(1, 70)), dtype=np.uint64)
        parts.append(np.concatenate([rng.integers(1, 3, 5, dtype=np.uint64), np.tile(unit, 9), rng.integers(1, 3, 9, dtype=np.uint64)])[: int(rng.integers(6, 400))])
    parts += parts[-3:]
    tile, q, start, stop = runs.solve(parts, k)
    got = set(zip(tile.tolist(), q.tolist(), start.tolist(), stop.tolist(), strict=True))
    assert len(got) == len(tile)
    s = 1 << k
    for t, w in enumerate(parts):
        for p in range(s, 2 * s):
            i = 0
            while i + p < len(w):
                j = i
                while j + p < len(w) and w[j] == w[j + p]:
                    j += 1
                if j + p - i >= 3 * s + p:
                    assert (t, p, i, j + p) in got
                i = max(j, i + 1)
    assert all(stop[x] <= len(parts[t]) and (parts[t][start[x] : stop[x] - q[x]] == parts[t][start[x] + q[x] : stop[x]]).all() for x, t in enumerate(tile))


def test_a_long_text_over_many_tiles(spark):
    unit = [f"u{i}" for i in range(999)]
    words = ["head"] * 10 + [f"w{i}" for i in range(50_000)] + unit * 90 + ["end"]
    r = runs.periodic_runs(documents(spark, [" ".join(words)]), tile_words=1024, with_text=True).first()
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (2, 50_010, 999 * 90, 999, 90_000)
    assert r.collapsed.split() == ["head"] + words[10:50_010] + unit + ["end"]
    same = runs.periodic_runs(documents(spark, ["a " * 200_000])).first()
    assert (same.n_runs, same.length, same.period) == (1, 200_000, 1)


def test_nothing(spark):
    assert runs.periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(documents(spark, ["a"]), min_exponent=2)
