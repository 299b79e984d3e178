"""The pipeline's stages on a small table, and the entry file with and without this subpackage."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from genefeat.llm import rules


def test_stages(spark, tmp_path):
    common = ["the", "of", "and", "in", "to", "is", "was", "for", "on", "with"]
    clean = [" ".join(common[(i * 7 + k * k) % 10] if k % 3 == 0 else f"word{(i * 131 + k * 17) % 977}" for k in range(160)) + "." for i in range(30)]
    bench = " ".join(f"q{i}" for i in range(25))
    secret = "0123456789abcdef01234567"
    texts = [*clean, clean[0] + " tail", clean[1] + " " + bench, clean[2][::-1] + f" token: {secret}", "short", None]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    judged = {r.doc_id for r in rules.quality_rules(docs).filter("kept").collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == judged and set(range(30)) <= judged
    single = corpus_pipeline.ngram_jaccard_join(spark, kept, str(tmp_path))
    ids = {r.doc_id for r in single.collect()}
    assert 30 not in ids and 0 in ids and single.columns == corpus_pipeline.COLUMNS
    free = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert {r.doc_id for r in free.collect()} == set(range(len(texts))) - {31}
    masked = corpus_pipeline.secret_scans(spark, docs, str(tmp_path)).filter("doc_id = 32").first()
    assert secret not in masked.text and masked.n_chars == len(masked.text)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= ids


def test_secrets_with_a_few_owners_are_masked(spark, tmp_path):
    """A key that is mirrored or used in a second source is as live as before; one that is everywhere is an example."""
    used_again, opaque, example = "0123456789abcdef01234567", "abcDEF123456789012345678", "AKIA" + "A1" * 8
    rows = [(i, f"token: {used_again} and {opaque}", "en", f"s{i}", 60) for i in range(3)]
    rows += [(10 + i, f"such as {example} here", "en", f"s{i}", 33) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    texts = {r.doc_id: r.text for r in corpus_pipeline.secret_scans(spark, docs, str(tmp_path)).collect()}
    assert all(texts[i] == "[SECRET] and [SECRET]" for i in range(3))
    assert all(texts[10 + i] == f"such as {example} here" for i in range(12))


def test_entry_registers_all_eleven():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}


# The whole pipeline once more, on lists in memory and by plain definitions.


def js(p, q):
    a, b = sum(p.values()), sum(q.values())
    out = 0.0
    for k in set(p) | set(q):
        x, y = p[k] / a, q[k] / b
        m = (x + y) / 2
        out += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(0.0, out / 2))


def kind_of(c):
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"), ("space", " \t\n\v\f\r"), ("symbol", "#*$%&|<>"), ("point", "!\"'(),-./:;?@[\\]^_`{}~+=")):
        if c in chars:
            return name
    return "other"


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def good_quality(docs):
    texts = {i: d["text"] or "" for i, d in enumerate(docs)}
    classes, words = {}, {}
    for i, d in enumerate(docs):
        classes.setdefault(d["lang"], Counter()).update(map(kind_of, texts[i]))
        words.setdefault(d["lang"], Counter()).update(WORDS.findall(texts[i]))
    out = []
    for i, d in enumerate(docs):
        w = WORDS.findall(texts[i])
        triples = Counter(zip(w, w[1:], w[2:], strict=False))
        repeated = {j for k, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if triples[t] > 1 for j in (k, k + 1, k + 2)}
        if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
            continue
        total = sum(words[d["lang"]].values())
        common = {x for x, n in words[d["lang"]].items() if n * 500 >= total}
        told = lambda counts: Counter({x: n for x, n in counts.items() if x in common}) + Counter({None: sum(n for x, n in counts.items() if x not in common)})
        far = js(Counter(map(kind_of, texts[i])), classes[d["lang"]]) > 0.31 or (len(w) >= 100 and js(told(Counter(w)), told(words[d["lang"]])) ** 2 > 0.34**2 + 500 / total)
        if not far:
            out.append(d)
    return out


def shingles_of(text, k=5):
    w = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    k = min(k, len(w))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()


def one_of_each(docs):
    sets, label = [shingles_of(d["text"]) for d in docs], [d["doc_id"] for d in docs]
    for _ in docs:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 5 * len(a & b) >= 4 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return [d for d, x in zip(docs, label, strict=True) if d["doc_id"] == x]


def without_items(docs, items):
    held = lambda text, item: (x := shingles_of(item)) and 5 * len(x & shingles_of(text, len(next(iter(x))))) >= 4 * len(x)
    return [d for d in docs if not any(held(d["text"], item) for item in items)]


def masked(docs):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = []
    for d in docs:
        t = d["text"] or ""
        base = [(m.start(), m.end(), m.group(2)) for m in assign.finditer(t) if len(m.group(2)) >= 6]
        base += [(m.start(), m.end(), m.group()) for p in (r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}") for m in re.finditer(p, t)]
        loose = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t) if all(re.search(c, m.group()) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        found.append(base + [x for x in loose if not any(b[0] < x[1] and x[0] < b[1] for b in base)])
    owners = {}
    for d, spans in zip(docs, found, strict=True):
        for *_, v in spans:
            owners.setdefault(v, set()).add(d["source"])
    out = []
    for d, spans in zip(docs, found, strict=True):
        text, at = "", 0
        for a, b, v in sorted(spans):
            if len(owners[v]) <= 3 and b > at:
                text, at = text + d["text"][at : max(a, at)] + ("[SECRET]" if a >= at else ""), b
        out.append({**d, "text": None if d["text"] is None else text + d["text"][at:]})
    return out


def topic_of(text):
    if not text:
        return "empty"
    if text.count("|") * 100 >= len(text):
        return "table"
    if len(re.findall("[A-Z]", text)) * 3 > len(text):
        return "shouting"
    return "long" if len(text) > 5000 else "short" if len(text) < 600 else "prose"


def probabilities(docs, rate=0.5, powers=(0.5, 0.7, 0.5)):
    cells = Counter()
    for d in docs:
        cells[d["source"], d["lang"], topic_of(d["text"])] += len(WORDS.findall(d["text"] or ""))
    total, factor, target = sum(cells.values()), [{}, {}, {}], []
    for i, power in enumerate(powers):
        own = Counter()
        for c, n in cells.items():
            own[c[i]] += n
        asked = {v: n**power for v, n in own.items()}
        want, full = {}, set()
        while True:
            left = 1 - sum(own[v] / total / rate for v in full)
            free = sum(asked[v] for v in asked if v not in full)
            want = {v: own[v] / total / rate if v in full else left * asked[v] / free for v in asked}
            if not (new := {v for v in asked if v not in full and want[v] >= own[v] / total / rate}):
                break
            full |= new
        target.append(want)
        factor[i] = {v: 1e12 if v in full else 1.0 for v in own}
    p = lambda c: min(1.0, rate * factor[0][c[0]] * factor[1][c[1]] * factor[2][c[2]])
    for _ in range(400):
        for i in range(3):
            now = Counter()
            for c, n in cells.items():
                now[c[i]] += n * p(c)
            for v in factor[i]:
                if factor[i][v] < 1e12:
                    factor[i][v] *= target[i][v] * rate * total / now[v]
    return {c: p(c) for c in cells}


def test_pipeline_is_brute_force(spark, tmp_path):
    rng = random.Random(11)
    common = ["the", "of", "and", "in", "to", "is", "was", "for", "on", "with"]
    prose = lambda n: " ".join(rng.choice(common) if k % 3 == 0 else f"word{rng.randrange(900)}" for k in range(n)) + "."
    bench = [" ".join(f"q{i}" for i in range(25)), "tiny item"]
    rows = []
    for i in range(90):
        text = prose(rng.choice([70, 90, 160, 200]))
        if i % 9 == 4:
            text += f" token: {'%024x' % (i // 2)} and {'abcDEF' + '%016d' % i} x"
        if i % 10 == 7:
            text = (text + " " + bench[0]) if i % 20 == 7 else text.upper()
        if i % 11 == 5 and rows:
            text = rows[-1][1] + " tail" if rows[-1][1] else text
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("aabc"), len(text)))
    rows += [(200, None, "en", "a", 0), (201, "", "de", "b", 0), (202, "few words", "en", "a", 9), (203, "x y z " * 60, "en", "c", 360), (204, prose(200) + " tiny item", None, None, 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(bench)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [dict(zip(("doc_id", "text", "lang", "source"), r, strict=False)) for r in rows]
    quality = good_quality(docs)
    single = one_of_each(quality)
    clean = without_items(single, bench)
    safe = [{**d, "lang": d["lang"] or "", "source": d["source"] or ""} for d in masked(clean)]
    assert len(docs) > len(quality) > len(single) > len(clean) and any("[SECRET]" in d["text"] for d in safe)
    own = probabilities(safe)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    for d in safe:
        p = own[d["source"], d["lang"], topic_of(d["text"])]
        u = int(hashlib.md5(f"0:{d['doc_id']}".encode()).hexdigest()[:13], 16) / (1 << 52)
        if abs(u - p) > 1e-4:
            assert (d["doc_id"] in got) == (u < p)
        if d["doc_id"] in got:
            r = got[d["doc_id"]]
            assert r.text == d["text"] and r.n_chars == len(d["text"]) and r.topic == topic_of(d["text"]) and r.probability == pytest.approx(p, abs=1e-4)
    assert set(got) <= {d["doc_id"] for d in safe}


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
