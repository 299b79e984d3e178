"""LM scoring (10): a probabilistic suffix tree over words, learned from part of the corpus, scores all of it.

States are contexts, runs of up to `most_depth` (64) preceding words; longer contexts are not built. The root predicts by add-one counts. A context of one word
is a candidate if training text has it at least `least` times; a longer one if it does, its suffix (all but its first
word) is in the tree, and all but its last word was a candidate too. A candidate is retained if it diverges from its
suffix: the mean, over its training occurrences, of log(own / suffix prediction), each occurrence left out of its own
count, is over `divergence`. A state's next-symbol distribution is smoothed by its suffix's, (count + mu * suffix's) /
(total + mu). A token is scored by the longest retained suffix of what precedes it in its document. Levels are built one
after the other until none of a level's candidates is retained, or to `most_depth` words.

Documents are encoded once into chunks of about `chunk_tokens` tokens, a table bucketed by chunk. A level takes two
exchanges: chunks send their distinct n-grams with their own counts, blocks by range of key add them, and each chunk
gets the totals of its n-grams back in order; then chunks send, for each of their contexts, by how much the gain there
exceeds the bound, and get one bit back. An n-gram that is everywhere is one entry a chunk, the encoded corpus is never
shuffled, and no count of the corpus passes through the driver but the numbers of training tokens, documents and
distinct tokens. From the third level on, a chunk's remaining candidates are a table, and what came before is dropped.

A document longer than a chunk is scored in pieces that begin with the last `most_depth` tokens before them, which are
looked at and not counted again, so memory does not follow the longest text.

Defined results: a null or empty text is one end symbol; rows that repeat are learned and scored each; a null id is
hashed as the empty text. With no training documents every count is 0. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, distinct, drop_saved, mix, partitions, release, save_bucketed, word_slices

_M1 = np.uint64(0x9E3779B97F4A7C15)
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" ", b"\t"))  # no word has a space
_END = np.array([END])
_BLOCK = 2_000_000  # entries of a block on average
_FEW = 250_000  # entries that are worth a block, or tokens worth a bucket, where there are fewer than one for each partition
_PARTS = 2  # in which the n-grams of all tokens are counted
_TEXTS = 4 << 20  # bytes of texts that are split together


def held_out(doc_id, fold: int = 2, folds: int = 7) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == fold


def hashed(texts: pa.Array, hashes: Hashes) -> Iterator[Iterator[np.ndarray]]:
    """For each text in order, its words' hashes, in parts. Texts are split together, `_TEXTS` bytes at a time; a longer
    one alone, so that it is never a list of words as a whole."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = int(np.searchsorted(ends, done + _TEXTS, "right"))
        if to <= at:
            yield map(hashes.of, word_slices(texts[at].as_py().encode()))
            at += 1
            continue
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(at, to - at)))
        words = split.flatten()
        some = pc.binary_length(words).to_numpy() > 0
        before = np.concatenate([[0], np.cumsum(some)])
        offsets = split.offsets.to_numpy()
        cuts = before[offsets - offsets[0]]
        coded = words.filter(pa.array(some)).dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[coded.indices.to_numpy()]
        yield from (iter([h[a:z]]) for a, z in zip(cuts, cuts[1:], strict=False))
        at = to


def pieces(parts: Iterator[np.ndarray], most: int, lead: int) -> Iterator[tuple[np.ndarray, int]]:
    """(hashes of tokens, how many of the first were in the piece before): the whole text, `most` new tokens at a time."""
    before, pending, size = np.empty(0, np.uint64), [], 0
    for part in parts:
        pending.append(part)
        size += len(part)
        while size >= most:
            h = np.concatenate(pending)
            made = np.concatenate([before, h[:most]])
            yield made, len(before)
            before, pending, size = made[-lead:], [h[most:]], len(h) - most
    yield np.concatenate([before, *pending, _END]), len(before)


def encode(docs: DataFrame, id_col: str, text_col: str, chunk_tokens: int, lead: int) -> DataFrame:
    """A row for each chunk: by piece rows (a number for each row of docs), ids, lens, leads (tokens of each, and those
    not counted), train and starts (a byte each); tokens (places in words), words (sorted hashes, as differences), n_tokens, n_train,
    d_train. Saved as a table bucketed by chunk."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = Hashes(), TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size, doc = 0, number

        def row():
            ids, rows, made, leads, train, starts = zip(*held, strict=True)
            words, tokens = distinct(np.concatenate(made))
            lens, leads = np.array([len(x) for x in made], np.int32), np.array(leads, np.int32)
            new, trained = (lens - leads).astype(np.int64), np.array(train, np.int64)
            ids = pa.concat_arrays(ids)
            packed = (x.tobytes() for x in (np.array(rows, np.int64), lens, leads, np.array(train, np.uint8), np.array(starts, np.uint8)))
            packed = (*packed, _planes(tokens.astype(np.uint32)), _thin(words))
            values = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in packed), *(pa.array([int(x)], pa.int64()) for x in (new.sum(), (new * trained).sum(), (trained * np.array(starts)).sum()))]
            return pa.RecordBatch.from_arrays(values, ["chunk", "ids", "rows", "lens", "leads", "train", "starts", "tokens", "words", "n_tokens", "n_train", "d_train"])

        for batch in batches:
            ids = batch.column("id")
            for i, (parts, doc_id) in enumerate(zip(hashed(batch.column("text"), hashes), ids.to_pylist(), strict=True)):
                learned = not held_out(doc_id)
                for k, (h, n_lead) in enumerate(pieces(parts, chunk_tokens, lead)):
                    held.append((ids.slice(i, 1), doc, h, n_lead, learned, k == 0))
                    size += len(h)
                    if size >= chunk_tokens:
                        yield row()
                        held, size, number = [], 0, number + 1
                doc += 1
        if held:
            yield row()

    schema = f"chunk bigint, ids array<{kind}>, rows binary, lens binary, leads binary, train binary, starts binary, tokens binary, words binary, n_tokens bigint, n_train bigint, d_train bigint"
    return save_bucketed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(make, schema), "chunk")


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte place: high bytes are mostly zeros, which compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _unplaned(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _thin(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _thick(data: bytes) -> np.ndarray:
    return np.cumsum(_unplaned(data, np.uint64), dtype=np.uint64)


def _add(counts: bool):
    """The answers to a block's rows, in the order of their keys: sums of counts, or a bit for each sum over 0."""

    def add(table: pa.Table) -> pa.Table:
        keys = [_thick(x) for x in table.column("keys").to_pylist()]
        weights = np.concatenate([_unplaned(x, np.uint32 if counts else np.float32) for x in table.column("weights").to_pylist()])
        found, place = distinct(np.concatenate(keys))
        total = np.bincount(place, weights=weights, minlength=len(found))
        cuts, n = np.cumsum([0] + [len(k) for k in keys]), np.zeros(len(keys), np.int64)
        n[:1] = (total > 0).sum()
        if counts:
            back = total[place].astype(np.uint32 if total.max(initial=0) < 2**32 else np.uint64)
            answers = [_planes(back[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        else:
            back = (total > 0)[place]
            answers = [np.packbits(back[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.table({"chunk": table.column("chunk"), "block": table.column("block"), "n": pa.array(np.diff(cuts).astype(np.int32)), "answer": pa.array(answers, pa.binary()), "positive": pa.array(n)})

    return add


def answered(chunks: DataFrame, entries: int, keys_of, counts: bool, buckets: int | None = None, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """(chunk, a: array of (block, n, answer), positive): for what keys_of(row) gives, sorted distinct keys and numbers,
    the answers of _add() over all chunks, in the keys' order. A table bucketed as the chunks are: joining them moves
    neither side (buckets: how many the chunks have). Few entries are few blocks, as each is a row a chunk. part: (which, of how many)
    of the ranges of keys that the blocks make up, so that the shuffles of one part at a time take up disk."""
    blocks = max(part[1], min(partitions(chunks.sparkSession), -(-entries // _FEW)), -(-entries // _BLOCK))
    edges = np.array([(b << 64) // blocks for b in range(1, blocks)], dtype=np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                keys, sums = keys_of(row)
                cut = np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]])
                some = [b for b in range(part[0] * blocks // part[1], (part[0] + 1) * blocks // part[1]) if cut[b] < cut[b + 1]]
                sums = sums.astype(np.uint32 if counts else np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array([_thin(keys[cut[b] : cut[b + 1]]) for b in some], pa.binary()), pa.array([_planes(sums[cut[b] : cut[b + 1]]) for b in some], pa.binary())], ["chunk", "block", "keys", "weights"])

    dealt = chunks.mapInArrow(deal, "chunk bigint, block int, keys binary, weights binary")
    added = dealt.groupBy("block").applyInArrow(_add(counts), "chunk bigint, block int, n int, answer binary, positive bigint")
    return save_bucketed(added.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("block", "n", "answer"))).alias("a"), F.sum("positive").alias("positive")), "chunk", buckets)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _totals(parts: list[dict] | None) -> np.ndarray:
    found = [_unplaned(x["answer"], np.uint32 if len(x["answer"]) == 4 * x["n"] else np.uint64).astype(np.float64) for x in parts or []]
    return np.concatenate(found) if found else np.empty(0)


def _bits(parts: list[dict] | None) -> np.ndarray:
    found = [np.unpackbits(np.frombuffer(x["answer"], np.uint8), count=x["n"]) for x in parts or []]
    return np.concatenate(found).astype(bool) if found else np.empty(0, bool)


class Level:
    """Tokens (places in the chunk, ascending) whose context of some length is a candidate. keys: sorted hashes, of which
    context[i] is the place of token i's context; its count and the prediction of its suffix; the tokens' own hashes,
    and whether they are training tokens."""

    def __init__(self, at, keys, context, total, parent, word, train):
        self.at, self.keys, self.context, self.total, self.parent, self.word, self.train = at, keys, context, total, parent, word, train

    def grams(self):
        """Distinct hashes of contexts with the token that follows, and each token's place there."""
        return distinct(mix(self.keys[self.context] * _M1 + self.word))

    def used(self):
        """The contexts' hashes, sorted, and each token's place there."""
        there = np.bincount(self.context, minlength=len(self.keys)) > 0
        return self.keys[there], (np.cumsum(there) - 1)[self.context]

    FIELDS = {"at": np.uint32, "keys": np.uint64, "context": np.uint32, "total": np.uint64, "parent": np.float64, "word": np.uint64, "learned": np.uint8}

    def packed(self) -> list[bytes]:
        there, context = self.used()
        made = {"at": self.at, "keys": there, "context": context, "total": self.total, "parent": self.parent, "word": self.word, "learned": self.train}
        return [_planes(np.ascontiguousarray(made[k].astype(kind))) for k, kind in self.FIELDS.items()]

    @classmethod
    def unpacked(cls, row: dict) -> Level:
        x = {k: _unplaned(row[k], kind) for k, kind in cls.FIELDS.items()}
        return cls(x["at"].astype(np.int64), x["keys"], x["context"].astype(np.int64), x["total"].astype(np.float64), x["parent"], x["word"], x["learned"].astype(bool))


class Chunk:
    """A chunk's tokens. Its row has the answers for words in a0, and for the contexts and n-grams of the levels in
    `pending` those in b{d} and, by part, n{d}_0, n{d}_1; once a table of remaining candidates was made, its fields are all that is needed."""

    def __init__(self, row: dict, model: dict):
        self.m, self.row = model, row
        self.lens, self.leads = np.frombuffer(row["lens"], np.int32), np.frombuffer(row["leads"], np.int32)
        self.starts = np.cumsum(self.lens) - self.lens
        self.first = np.zeros(int(self.lens.sum()), bool)
        self.first[self.starts] = True

    def encoded(self):
        """Words (sorted hashes), tokens as places among them, whether they count and are training tokens."""
        row = self.row
        words, t = _thick(row["words"]), _unplaned(row["tokens"], np.uint32).astype(np.int64)
        train = np.repeat(np.frombuffer(row["train"], np.uint8).astype(bool), self.lens)
        if not self.leads.any():
            return words, t, np.ones(len(t), bool), train
        new = np.arange(len(t)) - np.repeat(self.starts, self.lens) >= np.repeat(self.leads, self.lens)
        return words, t, new, train & new

    def unigrams(self):
        words, t, _, train = self.encoded()
        return words, np.bincount(t[train], minlength=len(words))

    def level(self, scored: bool = False) -> Level:
        """Of the level that comes next; scored: sums by piece (n_known, base, score) follow in self.sums."""
        row, m, self.sums = self.row, self.m, None
        if row.get("at") is not None:
            if scored:
                self.sums = [np.frombuffer(row["n_known"], np.int64), *(np.frombuffer(row[c], np.float64) for c in ("base", "score"))]
            level = Level.unpacked(row)
        else:
            words, t, new, train = self.encoded()
            c = _totals(row["a0"])
            p = (c + 1) / (m["tokens"] + m["distinct"] + 1)
            if scored:
                add = lambda x: np.add.reduceat(np.where(new, x, 0), self.starts)
                base = add(np.log10(p)[t])
                self.sums = [add((c > 0).astype(np.int64)[t]), base, base.copy()]
            # Before a document's first token is START; before the first of a piece further on, nothing known.
            place = np.searchsorted(words, START)
            keys, c = np.insert(words, place, START), np.insert(c, place, m["docs"])
            prev = np.roll(t + (t >= place), 1)
            prev[self.starts] = place
            n = c[prev]
            n[self.starts[np.frombuffer(row["starts"], np.uint8) == 0]] = 0
            at = np.flatnonzero(n >= m["least"])
            level = Level(at, keys, prev[at], n[at], p[t[at]], words[t[at]], train[at])
        for d in m["pending"]:
            level = self.advance(level, self.totals(d), _bits(row[f"b{d}"]))
        return level

    def totals(self, d: int) -> np.ndarray:
        return np.concatenate([_totals(self.row[x]) for k in range(_PARTS) if (x := f"n{d}_{k}") in self.row])

    def gram_counts(self):
        level = self.level()
        keys, place = level.grams()
        return keys, np.bincount(place[level.train], minlength=len(keys))

    def excess(self, d: int):
        """Of each context, the sum over its training occurrences here of its gain less the bound on its mean."""
        level = self.level()
        n = self.totals(d)[level.grams()[1]]
        mu, p = self.m["mu"], level.parent
        gain = np.log((np.maximum(n - 1, 0) + mu * p) / (np.maximum(level.total - 1, 0) + mu) / p) - self.m["divergence"]
        used, where = level.used()
        return used, np.bincount(where[level.train], weights=gain[level.train], minlength=len(used))

    def advance(self, level: Level, totals: np.ndarray, retained: np.ndarray) -> Level:
        """The next level's candidates; what this one's retained states say of their tokens goes to the sums, if asked for."""
        keys, place = level.grams()
        n = totals[place]
        kept = retained[level.used()[1]]
        p = (n + self.m["mu"] * level.parent) / (level.total + self.m["mu"])
        if self.sums:
            doc = np.searchsorted(self.starts, level.at, "right") - 1
            lead = level.at - self.starts[doc] < self.leads[doc]
            gain = np.where(kept & ~lead, np.log10(p) - np.log10(level.parent), 0)
            self.sums[2] = self.sums[2] + np.bincount(doc, weights=gain, minlength=len(self.starts))
        # A retained token goes on if the one before it, in its piece, was a candidate whose n-gram is frequent.
        follows = np.zeros(len(level.at), bool)
        follows[1:] = (level.at[1:] == level.at[:-1] + 1) & ~self.first[level.at[1:]] & (n[:-1] >= self.m["least"])
        on = np.flatnonzero(kept & follows)
        return Level(level.at[on], keys, place[on - 1], n[on - 1], p[on], level.word[on], level.train[on])


_KEPT = ("rows", "lens", "leads", "train", "starts")
_LEFT = (*Level.FIELDS, "n_known", "base", "score")


def _remaining(known: DataFrame, model: dict, id_kind: str, buckets: int) -> DataFrame:
    """A row for each chunk: its pieces, candidates of the next level, sums by piece. Saved, in as many buckets as what is
    left is worth; tokens are needed no more."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row, model)
                level = chunk.level(scored=True)
                packed = (*(row[x] for x in _KEPT), *level.packed(), *(x.tobytes() for x in chunk.sums))
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), batch.column("ids").slice(i, 1), pa.array([len(level.at)], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], ["chunk", "ids", "n_left", *_KEPT, *_LEFT])

    return save_bucketed(known.mapInArrow(tell, f"chunk bigint, ids array<{id_kind}>, n_left bigint, " + ", ".join(f"{x} binary" for x in (*_KEPT, *_LEFT))), "chunk", buckets)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 8, divergence: float = 0.02, mu: float = 10.0, chunk_tokens: int = 600_000, most_depth: int = 64) -> DataFrame:
    """A row for each row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    chunks = encode(docs, id_col, text_col, chunk_tokens, most_depth)
    tokens, train, trained = (int(x or 0) for x in chunks.agg(F.sum("n_tokens"), F.sum("n_train"), F.sum("d_train")).first())
    model = {"tokens": train, "docs": trained, "distinct": 0, "least": least, "divergence": divergence, "mu": mu, "pending": []}

    def joined(known: DataFrame, found: DataFrame, name: str) -> DataFrame:
        return known.join(found.select("chunk", F.col("a").alias(name)).hint("shuffle_hash"), "chunk", "left")

    buckets = 2 * partitions(spark)

    def asked(known: DataFrame, entries: int, step, counts: bool, part: tuple[int, int] = (0, 1)) -> DataFrame:
        found = answered(known, entries, lambda row, model=dict(model): step(Chunk(row, model)), counts, buckets, part)
        release(spark)
        return found

    def positive(found: DataFrame) -> int:
        return int(found.agg(F.sum("positive")).first()[0] or 0)

    words = asked(chunks, tokens, Chunk.unigrams, True)
    model["distinct"] = positive(words)
    known, left, temporary, state = joined(chunks, words, "a0"), tokens, [words], None
    for d in range(1, most_depth + 1):
        told, parts = known, _PARTS if d == 1 else 1
        for k in range(parts):
            counts = asked(known, left, Chunk.gram_counts, True, (k, parts))
            told = joined(told, counts, f"n{d}_{k}")
            temporary.append(counts)
        bits = asked(told, left, lambda chunk, d=d: chunk.excess(d), False)
        retained = positive(bits)
        temporary.append(bits)
        if not retained:
            break
        known, model = joined(told, bits, f"b{d}"), model | {"pending": [*model["pending"], d]}
        if d > 1:
            # A tenth of the tokens went on from the second level in what was measured; later it is known.
            buckets = max(1, min(buckets, -(-left // _FEW) if state is not None else -(-buckets // 4)))
            made = _remaining(known, model, kind, buckets)
            drop_saved(*temporary, chunks if state is None else state)
            temporary, known, state, model = [], made, made, model | {"pending": []}
            left = int(state.agg(F.sum("n_left")).first()[0] or 0)
            if not left:
                break

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                chunk = Chunk(row.to_pylist()[0], model)
                chunk.level(scored=True)
                columns = [pa.array(np.frombuffer(chunk.row["rows"], np.int64)), row.column("ids").flatten(), pa.array(np.frombuffer(chunk.row["train"], np.uint8) == 0), pa.array((chunk.lens - chunk.leads).astype(np.int64)), *map(pa.array, chunk.sums)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = known.mapInArrow(judge, f"row bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    whole = scored.groupBy("row").agg(F.first("id").alias(id_col), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.lit(train).cast("bigint").alias("train_tokens"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return whole.drop("row")
