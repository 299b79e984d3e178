"""Each operator on nulls, empty and repeated rows, clashing extra columns, and against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from genefeat.llm import chat, decontam, jaccard, licenses, mixing, pst, resample, rules, secrets, suffixes
from genefeat.llm.common import distinct, ordered

#: Extra columns have the names that operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n int, kept string, hashes string"


def documents(spark, texts, ids=None, lang="en", source="s"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source if isinstance(source, str) else source[k], 0, "x", 1, "y", "z") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=3, n=60):
    """Sentences of a small vocabulary, with copies, near copies, nulls, empties and repeats."""
    random.seed(seed)
    words = [f"w{i}" for i in range(40)] + ["Über", "É|x", "the"]
    base = [[random.choice(words) for _ in range(random.randint(30, 90))] for _ in range(6)]
    out = [None, "", " \t\n", "one", "a b c", "a b c", "A B C"]
    for _ in range(n):
        own = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 6])):
            own[random.randrange(len(own))] = random.choice(words)
        if random.random() < 0.3:
            own = own[: random.randint(5, len(own))]
        out.append(" ".join(own) + random.choice(["", "\n", "  "]))
    return out


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard_components_are_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(documents(spark, texts)).collect()}
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 5 * len(a & b) >= 4 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}


def test_jaccard_of_nothing_and_of_null_ids(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0
    got = jaccard.jaccard_components(documents(spark, ["a b c d e f"] * 4, ids=[None, 5, 5, 9])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got if r.doc_id is not None) == [(5, 5), (5, 5), (9, 5)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_products_count_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(25)]
    got = jaccard.product(sets[:12], sets[12:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def removed(texts, size=100):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            w = b[k : k + size]
            if w in seen:
                gone[k : k + size] = b"\1" * size
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_are_brute_force(spark):
    random.seed(7)
    base = ["".join(random.choice("abcd é") for _ in range(random.randint(60, 500))) for _ in range(5)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 101, "a" * 350, "xy" * 120, *base, *base]
    texts += ["".join(random.choice(base)[random.randint(0, 50) :][: random.randint(20, 300)] for _ in range(3)) for _ in range(40)]
    docs = documents(spark, texts).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.duplicate_spans(docs, chunk_bytes=2500).collect()}
    assert got == dict(enumerate(removed(texts)))


def test_difference_cover():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


@pytest.mark.parametrize("descending", [False, True])
def test_sampled_positions_and_first_occurrences(descending):
    """Sampled positions are listed by document, and powers made once for all chunks of a worker, whatever their sizes."""
    rng = random.Random(11)
    for n in (0, 1, 7, 40):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 43, 44, 45, 150, 400]))) for _ in range(n)]
        lens = np.array([len(t) for t in texts], np.int64)
        ids = list(range(n))[:: -1 if descending else 1]
        chunk = suffixes.Chunk({"bytes": b"".join(texts), "lens": lens.tobytes(), "ids": ids}, 100)
        at, keys, place = chunk.tuples()
        starts = np.cumsum(lens) - lens
        assert at.tolist() == [int(s) + o for s, m in zip(starts, lens, strict=True) for o in range(m - 43) if o % suffixes.PERIOD in suffixes.COVER]
        named = [bytes(chunk.b[a : a + 44]) for a in at]
        assert len(keys) == len(set(named)) == len(set(zip(named, place.tolist(), strict=True)))
        found, first, where = chunk.firsts(keys[place], at)
        least = {}
        for a, name in zip(at.tolist(), named, strict=True):
            doc = int(np.searchsorted(starts, a, "right")) - 1
            least[name] = min(least.get(name, (n, 0, 0)), (ids[doc], a - int(starts[doc]), a))
        assert found.tolist() == keys.tolist() and where.tolist() == place.tolist()
        assert [first[p] for p in place] == [least[name][2] for name in named]


def test_suffixes_of_nothing_and_of_equal_ids(spark):
    assert suffixes.duplicate_spans(documents(spark, [])).count() == 0
    got = suffixes.duplicate_spans(documents(spark, ["q" * 50 + "r" * 70] * 3, ids=[4, 4, None]).coalesce(1), with_text=True).collect()
    assert sorted(r.n_removed for r in got) == [0, 120, 120] and [r.n_removed for r in got if r.doc_id is None] == [0]


def tree_scores(docs, train, least, divergence, mu):
    """(tokens, known, base, score) of each document, by counting every run of words; and the states by depth."""
    at_most = max(map(len, docs)) + 1
    grams = [Counter() for _ in range(at_most + 1)]
    for i in train:
        h = [b"\t"] + docs[i]
        for n in range(1, at_most + 1):
            grams[n].update(tuple(h[k : k + n]) for k in range(len(h) - n + 1))
    c = {w[0]: n for w, n in grams[1].items()}
    total, kinds = sum(n for w, n in c.items() if w != b"\t"), len([w for w in c if w != b"\t"])
    p0 = lambda w: (c.get(w, 0) + 1) / (total + kinds + 1)
    states, candidates, depths = set(), set(), []

    def p(context, w):  # of a state, or a candidate whose suffix is one
        if not context:
            return p0(w)
        return (grams[len(context) + 1][(*context, w)] + mu * p(context[1:], w)) / (grams[len(context)][context] + mu)

    for d in range(1, at_most):
        own = {x for x, n in grams[d].items() if n >= least and x[-1] != b" " and (d == 1 or (x[1:] in states and x[:-1] in candidates))}
        gain = Counter()
        for x, n in grams[d + 1].items():
            if x[:-1] in own:
                q = p(x[1:-1], x[-1])
                gain[x[:-1]] += n * math.log((n - 1 + mu * q) / (grams[d][x[:-1]] - 1 + mu) / q)
        new = {x for x in own if gain[x] > divergence * grams[d][x]}
        candidates |= own
        states |= new
        depths.append(len(new))
        if not new:
            break
    out = []
    for d in docs:
        h, score = [b"\t"] + d, 0.0
        for k in range(1, len(h)):
            context = ()
            while len(context) < k and (longer := (h[k - 1 - len(context)], *context)) in states:
                context = longer
            score += math.log10(p(context, h[k]))
        out.append((len(d), sum(c.get(w, 0) > 0 for w in d), sum(math.log10(p0(w)) for w in d), score))
    return total, out, depths


def phrases(seed=5, n=90):
    """Texts in which what follows depends on up to five words before."""
    rng = random.Random(seed)
    stock = ["go to the house by sea", "go to the mill by road", "we saw the house by air", "was at the mill by sea"]
    texts = [" ".join(rng.choice([*stock, *(f"w{rng.randrange(25)}" for _ in range(6))]) for _ in range(rng.randint(1, 12))) for _ in range(n)]
    return [*texts, None, "", " ".join(rng.choice([*stock, f"w{rng.randrange(25)}"]) for _ in range(400))]


@pytest.mark.parametrize("chunk_tokens", [700, 60_000])
def test_suffix_tree_is_brute_force(spark, chunk_tokens):
    """The last text is longer than a small chunk, so it is scored in pieces."""
    texts = [*corpus(n=50), *phrases()]
    options = {"least": 3, "divergence": 0.01, "mu": 5.0}
    got = {r.doc_id: r for r in pst.score(documents(spark, texts), chunk_tokens=chunk_tokens, **options).collect()}
    docs = [[w for w in (t or "").encode().lower().split()] + [b" "] for t in texts]
    total, expected, depths = tree_scores(docs, [i for i in range(len(docs)) if zlib.crc32(str(i).encode()) % 7 != 2], **options)
    assert len(depths) > 3 and depths[2] > 0, depths  # states of three words and more
    assert len(got) == len(texts)
    for i, (n, known, base, score) in enumerate(expected):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.score == pytest.approx(score) and r.base_score == pytest.approx(base)


def test_texts_split_together_have_their_words(monkeypatch):
    texts = ["  A b\x0bc\x1c d É \x85x ", None, "", " \n", "Q" * 50 + " y z", "İ K"]
    want = [[xxhash.xxh3_64_intdigest(w) for w in (t or "").encode().lower().split()] for t in texts]
    for size in (4 << 20, 20, 1):  # all together, some, each alone
        monkeypatch.setattr(pst, "_TEXTS", size)
        assert [[int(h) for part in parts for h in part] for parts in pst.hashed(pa.array(texts), pst.Hashes())] == want


def test_ordered_is_a_stable_argsort():
    rng = np.random.default_rng(3)
    ties = np.array([*range(50), 2**64 - 1, *range(49, -1, -1)], np.uint64)  # low bits alone tell these apart
    for h in (ties, *(rng.integers(0, most, n, dtype=np.uint64) for n in (0, 1, 2, 900) for most in (1, 2, 700, 2**63))):
        by, found = ordered(h)
        assert by.tolist() == np.argsort(h, kind="stable").tolist() and found.tolist() == np.sort(h).tolist()
        assert [x.tolist() for x in distinct(h)] == [x.tolist() for x in np.unique(h, return_inverse=True)]


def test_counts_by_part_are_those_of_all(spark):
    """N-grams of all tokens are counted a part of the keys at a time, which bounds the disk that their shuffles take."""
    chunks = pst.encode(documents(spark, corpus(n=50)), "doc_id", "text", 700, 64)
    parts = [(0, 1), (0, 2), (1, 2)]
    whole, first, second = ({r.chunk: pst._totals(r.a).tolist() for r in pst.answered(chunks, 10, lambda row: pst.Chunk(row, {}).unigrams(), True, 3, part).collect()} for part in parts)
    assert whole == {k: first[k] + second[k] for k in whole} and sum(map(len, first.values())) < 0.6 * sum(map(len, whole.values()))


def test_suffix_tree_of_nothing_and_held_out_gain(spark):
    assert pst.score(documents(spark, [])).count() == 0
    rows = pst.score(documents(spark, corpus(n=150))).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]  # the tree predicts what it has not seen better than word counts do


def test_contamination(spark):
    long = " ".join(f"x{i}" for i in range(3000))
    item = " ".join(f"q{i}" for i in range(30))
    near = item.replace("q3 ", "zz ")  # 26 shingles, 4 of them changed
    far = item.replace("q10 ", "zz ").replace("q20 ", "zz ")
    texts = [None, "", f"{long} {item.upper()}\n{long}", f"{long} {near}", f"{long} {far}", "tiny\tITEM here", long]
    items = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None), (4, ""), (5, "never")], "item_id bigint, text string")
    for size in (16 << 20, 40):  # one block, and several
        got = sorted((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in decontam.contaminated(documents(spark, texts), items, block_bytes=size).collect())
        assert got == [(2, 1, 26, 26), (3, 1, 26, 22), (5, 2, 1, 1)]
        kept = decontam.without_contaminated(documents(spark, texts), items, block_bytes=size)
        assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 4, 6] and kept.columns == documents(spark, []).columns
    assert decontam.contaminated(documents(spark, texts), items.limit(0)).count() == 0
    named = items.withColumn("item_id", F.concat(F.lit("i"), "item_id"))
    got = decontam.contaminated(documents(spark, texts).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), named)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [("d2", "i1"), ("d3", "i1"), ("d5", "i2")]


def test_secrets(spark):
    hex_, key = "0123456789abcdef01234567", "AKIA" + "A1" * 8
    opaque = "abcDEF123456789012345678"
    texts = [None, "", f"é TOKEN = \"{hex_}\"", f"x {key} y", "secret=token: abcdef12", f"see {opaque}", f"{hex_}", "password: short", "api_key='abcdef'"]
    rows = secrets.secret_report(documents(spark, texts, source=list("aabbbaacc")), max_owners=1).orderBy("doc_id").collect()
    assert [r.spans for r in rows] == ["", "", "assign:2:35,hex:11:35", "access:2:22", "", "owned:4:28", "hex:0:24", "", "assign:0:15"]
    assert rows[2].base_sha256 == hashlib.sha256(b"assign:2:35,hex:11:35").hexdigest() and rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (rows[2].n_copied, rows[3].n_live) == (2, 1)  # two owners have the same hex value
    assert secrets.secret_report(documents(spark, [])).count() == 0


def test_masking(spark):
    hex_ = "0123456789abcdef01234567"
    docs = documents(spark, [None, f"é token: {hex_}! b", "plain", "plain"])
    assert sorted(r.text or "" for r in secrets.mask_live_secrets(docs).collect()) == ["", "plain", "plain", "é [SECRET]! b"]
    shared = documents(spark, [f"token: {hex_}"] * 2, source=["a", "b"])
    assert {r.text for r in secrets.mask_live_secrets(shared, max_owners=1).collect()} == {f"token: {hex_}"}
    assert {r.text for r in secrets.mask_live_secrets(shared).collect()} == {"[SECRET]"}  # a few owners: used again


def test_secrets_of_a_few_owners_are_live_and_of_many_copied(spark):
    hex_, opaque = "0123456789abcdef01234567", "abcDEF123456789012345678"
    few = documents(spark, [f"{hex_} {opaque}"] * 3, source=list("abc"))
    assert {(r.spans, r.n_live, r.n_copied) for r in secrets.secret_report(few).collect()} == {("hex:0:24,owned:25:49", 2, 0)}
    many = documents(spark, [f"{hex_} {opaque}"] * 4, source=list("abcd"))
    assert {(r.spans, r.n_live, r.n_copied) for r in secrets.secret_report(many).collect()} == {("hex:0:24", 0, 1)}
    one_owner = few.withColumns({"source": F.lit("a"), "repository": F.col("doc_id").cast("string")})
    assert {(r.n_live, r.most_repos) for r in secrets.secret_report(one_owner, repo_col="repository").collect()} == {(2, 3)}


def test_spread_over_owners_counts_their_repositories(spark):
    """One owner's key, in nine of its repositories, stays live though five others have copied it: 14^2 / (81 + 5) < 3.
    The same owners with two repositories each have an example, and so has a corpus of many more owners."""
    key = "0123456789abcdef01234567"
    mine = [(key, "a", f"a{i}") for i in range(9)] + [(key, x, x) for x in "bcdef"]
    even = [(key, x, f"{x}{i}") for x in "abcdef" for i in range(2)]
    others = [("plain", f"o{i}", "r") for i in range(5000)]
    for rows, live in ((mine, True), (even, False), (mine + others, True), (even + others, False)):
        docs = documents(spark, [r[0] for r in rows]).drop("source")
        names = spark.createDataFrame([(i, r[1], r[2]) for i, r in enumerate(rows)], "doc_id bigint, source string, repository string")
        got = secrets.secret_report(docs.join(names, "doc_id"), repo_col="repository").filter("n_hex > 0").select("n_live", "n_copied").distinct().collect()
        assert [tuple(r) for r in got] == [(1, 0) if live else (0, 1)]


def test_common_and_rare_values_are_judged_alike(spark, monkeypatch):
    texts = [f"token: {'%024x' % (i % 40 if i % 2 else 7)}" for i in range(200)]
    docs = documents(spark, texts, source=[f"s{i % 5}" for i in range(200)])
    wanted = sorted(secrets.secret_report(docs).collect())
    for part in (1, 5, 100):
        monkeypatch.setattr(secrets, "COMMON_PART", part)
        assert sorted(secrets.secret_report(docs).collect()) == wanted


def test_the_word_test_has_no_edge(spark):
    """Languages of 490 to 510 words, half of them one stray document's, keep it alike; of 20,000 words it goes."""
    stray = lambda n: " ".join(f"xx{k}" for k in range(n))
    rng = random.Random(3)
    usual = lambda n: " ".join(rng.choices([f"mot{k}" for k in range(60)], k=n))
    for size, kept in ((490, True), (499, True), (500, True), (510, True), (20_000, False)):
        texts = [usual(size - 110), stray(110)]
        rows = {r.doc_id: r for r in rules.quality_rules(documents(spark, texts, lang="wa"), max_class_distance=1.0).collect()}
        assert rows[1].kept == kept and not rows[1].base_failed


def test_a_text_of_very_many_secrets(spark):
    """Positions and masks of 20,000 matches in one text, which grow with the text and not with its square."""
    parts = [f"é{i} {'%024x' % i}" for i in range(20_000)]
    r = secrets.secret_spans(documents(spark, [" ".join(parts)])).first()
    assert len(r.base) == 20_000
    at = 0
    for i, part in enumerate(parts):
        assert r.base[i].start == at + len(part) - 24
        at += len(part) + 1
    out = secrets.mask_live_secrets(documents(spark, [" ".join(parts)])).first().text
    assert out == " ".join(f"é{i} [SECRET]" for i in range(20_000))


def test_rules(spark):
    common = ["the", "of", "and", "in", "to", "is", "was", "for", "on", "with"]
    prose = [" ".join(common[(i * 7 + k * k) % 10] if k % 3 == 0 else f"word{(i * 131 + k * 17) % 977}" for k in range(160)) + "." for i in range(40)]
    bad = ["THE!! " * 30 + " ".join(f"SHOUT{k}!!" for k in range(100)), " ".join(f"x{k}$$$" for k in range(150))]
    texts = [None, "", "few words", "a b\na b\nc #\n \n", *bad, *prose]
    rows = rules.quality_rules(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.kept for r in rows[:6]] == [False] * 6 and all(r.kept for r in rows[6:])
    r = rows[3]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (6, 6, 1, 1, 0)
    kept = rules.quality_rules(documents(spark, texts), keep_columns=True)
    assert kept.count() == 40 and kept.columns == documents(spark, []).columns
    clash = documents(spark, texts).withColumns({c: F.lit("own") for c in ("__text", "__lang", "__kept", "__id")})
    kept = rules.quality_rules(clash, keep_columns=True)
    assert kept.count() == 40 and kept.columns == clash.columns and {r["__kept"] for r in kept.collect()} == {"own"}
    assert rules.quality_rules(documents(spark, [])).count() == 0


def test_small_languages_have_their_own_reference(spark, monkeypatch):
    """A document's verdict is the same whatever share of the corpus its language has."""
    small = [" ".join(random.Random(i).choices("и в не на я быть он с что а по это она этот к но они мы весь который".split(), k=200)) for i in range(20)]
    other = "QQQ$$$ ### " * 5 + " ".join(f"X{k}$$$" for k in range(100))
    rare = documents(spark, [*small, other], lang="ru")
    few = documents(spark, [" ".join(f"mot{k}" for k in range(120))], ids=[50], lang="wa")
    monkeypatch.setattr(rules, "MIN_SHARE", 0.1)  # so that a small corpus has both cases
    for copies in (1, 20):  # of 20,000 words: the 4,100 Russian ones are over MIN_SHARE, then under it
        big = spark.range(100, 100 + copies).select(F.col("id").alias("doc_id"), F.repeat(F.lit("the of and in "), 5000).alias("text"), F.lit("en").alias("lang"))
        both = rare.unionByName(few).unionByName(big, allowMissingColumns=True)
        rows = {r.doc_id: r for r in rules.quality_rules(both).collect()}
        assert [rows[i].kept for i in range(21)] == [True] * 20 + [False]
        assert rows[50].kept and rows[50].word_distance < 0.01  # its own reference
        assert all(rows[i].word_distance < 0.3 for i in range(20)) and rows[20].word_distance > 0.34
        assert {r.doc_id for r in rules.quality_rules(both, keep_columns=True).filter("doc_id < 100").collect()} == {*range(20), 50}


def test_repeated_words_count_positions(spark):
    r = rules.quality_rules(documents(spark, ["a b c x a b c y b c x"])).first()
    assert r.n_repeat_words == 10  # windows abc and bcx twice each: all but y


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = [None, "", "prose of some length\nReleased under the MIT License.\nmore of it", "released UNDER the mit license", mit.replace(" to ", "\nto "), "We were released under the bridge.", "Licensed under CC BY-NC 4.0.\n\nLicensed under CC BY-NC 4.0."]
    rows = licenses.license_scan(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_matches, r.licenses) for r in rows] == [(0, ""), (0, ""), (1, "MIT"), (1, "MIT"), (1, "MIT"), (0, ""), (3, "CC-BY-NC-4.0")]  # both lines, and the text
    assert rows[2].best_dice == 1.0


def test_equal_dice_goes_by_name(spark):
    both = {"b": ["free for all uses in one place"], "a": ["free for all uses in two place"]}
    row = licenses.license_scan(documents(spark, ["free for all uses in"]), templates=both, num=3, den=5).first()
    assert (row.n_matches, row.licenses) == (1, "a")


def test_anchors_are_in_every_match():
    for texts in licenses.TEMPLATES.values():
        for t in texts:
            b = licenses.bigrams_of(t)
            found = licenses.anchors(b, 4, 5)
            assert len([x for x in b if not set(x.split()) & found]) < licenses.least_shared(len(b), 4, 5)


def test_chats(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (2, 2, "user", "c"), (3, 0, "user", "a"), (3, 1, "bot", "x"), (4, 5, "user", "a"), (4, 6, "bot", "b"), (4, 7, "user", "c"), (5, 0, None, None), (5, 0, None, None), (None, 0, "user", "a"), (6, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("number", F.lit("x"))
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(df).collect()}
    assert got[2] == (3, 2, "<|user|>\na\n<|end|>\n<|bot|>\nb\n<|end|>\n<|user|>\nc\n<|end|>\n")
    assert set(got) == {2, 3, 5, 6, None}
    assert got[5][0] == 1 and got[None] == (1, 1, "<|user|>\na\n<|end|>\n")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chats_without_an_id_drop_no_others_and_ties_go_by_text(spark):
    rows = [(None, 0, "u", "a"), (None, 1, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 0, "u", "b"), (3, 0, None, "z"), (4, None, "u", "n"), (4, 0, "u", "m")]
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    block = lambda role, text: f"<|{role}|>\n{text}\n<|end|>\n"
    assert got[None] == (2, 1, block("u", "a") + block("u", "b"))
    assert got[2] == (2, 1, block("u", "a") + block("u", "b")) and 1 not in got
    assert got[3][2] == block("", "z") + block("u", "a") + block("u", "b") and got[4][2] == block("u", "n") + block("u", "m")


def test_long_chats_are_parts_of_one_order(spark):
    df = spark.range(1000).select(F.lit(7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.format_chats(df, part_turns=300).orderBy("part").collect()
    assert [r.part for r in got] == [0, 1, 2, 3]
    assert "".join(r.rendered for r in got) == "".join(f"<|u|>\n{i}\n<|end|>\n" for i in range(1000))


def test_raking_meets_marginals(spark):
    cells = spark.createDataFrame([("a", "en", "x", 900), ("a", "de", "x", 50), ("b", "en", "x", 30), ("b", "de", "y", 20), ("a", "en", "y", 100)], "source string, lang string, topic string, tokens bigint")
    targets = {d: mixing.tempered_targets(cells, d, 0.5) for d in mixing.DIMENSIONS}
    fitted = mixing.Fit(cells, targets, rate=0.02)  # so low that no probability comes near 1
    kept = fitted.probabilities().withColumn("x", F.col("tokens") * F.col("probability") / 0.02)
    for d, t in targets.items():
        share = {r[0]: r.s / 1100 for r in kept.groupBy(d).agg(F.sum("x").alias("s")).collect()}
        assert share == pytest.approx({r[0]: r.target for r in t.collect()}, abs=1e-3)


def test_sampled_marginals_are_those_asked_for_or_the_bound(spark):
    """Of the probabilities themselves, not of the weights before they are cut."""
    texts, sources, tokens = [], [], {}
    for s, lang_size, topic in [("a", 900, "x"), ("a", 60, "y"), ("b", 40, "x"), ("b", 90, "y"), ("c", 300, "x"), ("c", 20, "y")]:
        for _ in range(10):
            texts.append(" ".join([topic] * lang_size))
            sources.append(s)
    docs = documents(spark, texts, source=sources)
    rate, powers = 0.5, {"source": 0.5, "lang": 0.7, "topic": 0.5}
    rows = mixing.mix(docs, topic=F.substring("text", 1, 1), powers=powers, rate=rate).collect()
    assert all(0 < r.probability <= 1 for r in rows)
    kept, own = Counter(), Counter()
    for r in rows:
        n = len(r.text.split())
        for d in ("__source", "__topic"):
            kept[d, r[d]] += n * r.probability
            own[d, r[d]] += n
    total = sum(n for (d, _), n in own.items() if d == "__topic")
    assert sum(n for (d, _), n in kept.items() if d == "__topic") == pytest.approx(rate * total, rel=0.01)
    for d in ("__source", "__topic"):
        asked = {v: n**0.5 for (e, v), n in own.items() if e == d}
        asked = {v: n / sum(asked.values()) for v, n in asked.items()}
        most = {v: own[d, v] / total / rate for v in asked}
        target, over = dict(asked), set()
        while new := {v for v in target if v not in over and target[v] > most[v]}:
            over |= new
            left = (1 - sum(most[v] for v in over)) / sum(asked[v] for v in asked if v not in over)
            target = {v: most[v] if v in over else asked[v] * left for v in asked}
        assert {v: kept[d, v] / (rate * total) for v in asked} == pytest.approx(target, abs=0.005)


def test_mixing_reports_what_is_infeasible(spark):
    cells = spark.createDataFrame([("a", "en", "x", 980), ("b", "en", "x", 20)], "source string, lang string, topic string, tokens bigint")
    targets = {d: mixing.tempered_targets(cells, d, 0.5) for d in mixing.DIMENSIONS}
    rows = {(r.dimension, r.value): r for r in mixing.Fit(cells, targets, 0.5).expected_shares().collect()}
    b = rows["source", "b"]
    assert b.asked > 0.12 and b.target == pytest.approx(0.04) and b.expected == pytest.approx(0.04, abs=1e-3)
    assert rows["source", "a"].expected == pytest.approx(0.96, abs=1e-3)


def test_mixing_edges(spark):
    docs = documents(spark, [None, "", "a b c", "a b c", "d e"], ids=[0, 1, 2, 2, 3], source=["a", None, "a", "a", "b"])
    rows = mixing.mix(docs).orderBy("doc_id").collect()
    assert [r.probability for r in rows[:2]] == [0.0, 0.0] and rows[2].kept == rows[3].kept
    assert mixing.mix(documents(spark, [])).count() == 0


def test_mixing_takes_explicit_targets_and_clashing_names(spark):
    docs = documents(spark, ["a b c d"] * 40, source=["a", "b"] * 20).withColumn("probability", F.lit("mine"))
    wanted = {"source": spark.createDataFrame([("a", 0.8), ("b", 0.2), ("none", 0.5)], "source string, target double")}
    rows = mixing.mix(docs, targets=wanted, rate=0.25).collect()
    assert {(r["__source"], round(r.probability, 6)) for r in rows} == {("a", 0.4), ("b", 0.1)}
    assert {r.hashes for r in rows} == {"z"} and isinstance(rows[0].kept, bool)


def test_mixing_where_targets_contradict_each_other(spark):
    """A source of one language only cannot have another share than it: the sources' shares are those that hold."""
    cells = spark.createDataFrame([("a", "en", "x", 600), ("b", "de", "x", 400)], "source string, lang string, topic string, tokens bigint")
    targets = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, target double"), "lang": spark.createDataFrame([("en", 0.7), ("de", 0.3)], "lang string, target double"), "topic": mixing.tempered_targets(cells, "topic", 1.0)}
    fitted = mixing.Fit(cells, targets, 0.2, sweeps=12)
    rows = {(r.dimension, r.value): r.expected for r in fitted.expected_shares().collect()}
    assert rows["source", "a"] == pytest.approx(0.5) and fitted.sweeps_done == 12


def test_resampling(spark):
    good = [" ".join(random.Random(i).choices(["alpha", "beta", "gamma", "delta"], k=60)) for i in range(40)]
    junk = [" ".join(random.Random(i).choices(["zzz", "qqq", "xxx"], k=60)) for i in range(20)]
    docs = documents(spark, [None, "", *good, *junk])
    labels = spark.createDataFrame([(i,) for i in [*range(2, 30), 2, None]], "doc_id bigint")
    rows = resample.resample(docs, labels, fraction=0.65).collect()
    assert sum(r.kept for r in rows) == 40
    held = [r for r in rows if 30 <= r.doc_id < 42]  # good documents without a label
    assert all(r.kept for r in held) and not any(r.kept for r in rows if r.doc_id >= 42)
    assert resample.resample(documents(spark, []), labels).count() == 0


def test_resampling_is_brute_force(spark):
    """Log weights from counts by bucket, Gumbel keys, and the kept set by a whole sort; ids are texts, and some tie."""
    texts = [*corpus(n=40), " ".join(f"w{i % 40}" for i in range(60_000))]
    ids = [f"d{i}" for i in range(len(texts))]
    ids[10], texts[10], texts[11] = ids[11], texts[11], texts[11]  # the same id twice, with the same text
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id string, text string").withColumn("n_ngrams", F.lit("mine"))
    good = [f"d{i}" for i in range(8, 30)]
    rows = resample.resample(docs, spark.createDataFrame([(x,) for x in [*good, None]], "doc_id string"), fraction=0.5, buckets=500, temperature=2.0).collect()
    hashes = resample.Hashes()
    grams = [resample.places((t or "").encode(), hashes, 500) for t in texts]
    raw, target = np.ones(500), np.ones(500)
    for i, x in zip(ids, grams, strict=True):
        np.add.at(raw, x, 1)
        if i in good:
            np.add.at(target, x, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    key = {}
    for i, x in zip(ids, grams, strict=True):
        weight = sum(ratio[x]) / 2 if len(x) else resample.EMPTY
        u = (int(hashlib.md5(f"0:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        key[i] = (weight, weight - math.log(-math.log(u)))
    for r in rows:
        assert (r.log_weight, r.gumbel_key) == pytest.approx(key[r.doc_id], rel=1e-9)
    order = sorted(((key[i][1], i) for i in ids), key=lambda x: (-x[0], x[1]))
    edge = order[math.floor(len(ids) * 0.5) - 1]
    assert {r.doc_id for r in rows if r.kept} == {i for k, i in order if k > edge[0] or (k == edge[0] and i <= edge[1])}


@pytest.mark.parametrize("k", [0, 1, 7, 50, 99, 100, 101])
def test_kth_largest(spark, k):
    values = [random.Random(i).choice([1.5, 2.5, i / 7, -3.0]) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    edge, ties = resample.kth_largest(df, "x", k, parts=4)
    expected = sorted(values, reverse=True)[:k]
    assert sorted([v for v in values if v > edge] + [edge] * ties, reverse=True) == expected or k > 100
