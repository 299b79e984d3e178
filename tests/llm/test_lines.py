"""Line dedup against brute force, with nulls, repeats, ties, long texts and clashing columns."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from genefeat.llm import lines

from .test_operators import documents

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(texts, ids, min_docs, min_chars, keep_first):
    split = [(t or "").split("\n") for t in texts]
    owners = {}
    for r, ls in enumerate(split):
        for k in {key(x) for x in ls}:
            owners.setdefault(k, []).append(r)
    gone = {k: min(o, key=lambda r: (ids[r] is not None, ids[r] or 0, r)) for k, o in owners.items() if len(o) >= min_docs and len(k) >= min_chars}
    out = []
    for r, ls in enumerate(split):
        kept, used = [], set()
        for x in ls:
            k = key(x)
            if k not in gone or keep_first and gone[k] == r and k not in used:
                kept.append(x)
                used.add(k)
        out.append((ids[r], len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=str)


def made(n=140, seed=5):
    random.seed(seed)
    pool = [random.choice(["  ", "", "\t"]) + random.choice(["Ä line ", "a LINE ", "x", "é"]) + str(i) + random.choice(["", " ", "\r"]) for i in range(60)]
    texts = [None, "", "\n", " \n\t", "\n\n\n"]
    for _ in range(n):
        own = [random.choice(pool[: random.choice([3, 20, 60])]) for _ in range(random.randint(0, 12))] + [f"own {random.random()}"]
        texts.append("\n".join(own))
    return texts + texts[-9:]


@pytest.mark.parametrize(("min_docs", "min_chars", "keep_first"), [(10, 1, False), (2, 1, True), (4, 3, True), (10, 5, False)])
def test_line_dedup_is_brute_force(spark, min_docs, min_chars, keep_first):
    texts = made()
    ids = [None if i % 31 == 0 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids).coalesce(1) if keep_first else documents(spark, texts, ids)
    got = lines.dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first, with_text=True)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(texts, ids, min_docs, min_chars, keep_first)


def test_nothing_and_no_repeats(spark):
    assert lines.dedup_lines(documents(spark, [])).count() == 0
    got = lines.dedup_lines(documents(spark, ["a\nb", "c", None])).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_dropped) for r in got] == [(2, 0), (1, 0), (1, 0)]
    with pytest.raises(ValueError):
        lines.dedup_lines(documents(spark, ["a"]), min_docs=1)


def test_string_ids_and_a_long_text(spark):
    long = "\n".join(f"line {i} of a long text" for i in range(60_000)) + "\nshared"
    docs = spark.createDataFrame([(f"d{i}", t, 1, "x") for i, t in enumerate([long, *["Shared\nown"] * 10])], "doc_id string, text string, row int, hash string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs, with_text=True).collect()}
    assert got["d0"].n_lines == 60_001 and got["d0"].n_dropped == 1 and got["d0"].kept_text == long.removesuffix("\nshared")
    assert all(got[f"d{i}"].kept_text == "" for i in range(1, 11))  # "own" is in ten documents too


def test_filters_miss_no_repeat():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 3000, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(20)]
    pack = lambda xs: pa.array([x.tobytes() for x in xs], pa.binary())
    table = pa.table({"slice": [0] * 20, "__part": pa.array(range(20), pa.int32()), "once": pack(rows), "again": pack([x[:1] for x in rows])})
    got = lines._suspect(table)
    found = {p: set(np.frombuffer(x, np.uint64).tolist()) for p, x in zip(got.column("__part").to_pylist(), got.column("hashes").to_pylist(), strict=True)}
    counts = {}
    for x in rows:
        for h in x.tolist():
            counts[h] = counts.get(h, 0) + 1
    firsts = {int(x[0]) for x in rows}
    extra = 0
    for p, x in enumerate(rows):
        real = {h for h in x.tolist() if counts[h] > 1 or h in firsts}
        assert real <= found.get(p, set())
        extra += len(found.get(p, set()) - real)
    assert extra <= 0.05 * sum(map(len, rows))
