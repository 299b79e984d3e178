"""Benchmark decontamination (2): size-partitioned MinHash containment search, then exact shingle containment.

A document is contaminated by an item when it holds at least `num`/`den` of the item's distinct word shingles (five
words, A-Z in lower case; a shorter item is one shingle of all its words). Items are partitioned by size, and the
sketch of an item of n shingles is its k(n) smallest shingle hashes (a bottom-k MinHash), k(n) = n - ceil(n*num/den) + 1.
A text that misses all k(n) of them lacks too many of the item's shingles, however long the text is, so the candidate
search has no misses; sketches of other sizes in one index would be too short for large items or too long for small
ones. A candidate is then counted on the words themselves.

Items are taken in blocks of about `block_bytes` of text, each sent to the tasks once (a block is about four times that
in memory); every block is held against all documents, so a larger benchmark costs more passes and no more memory.

Defined results: null or empty texts and items have no shingles and match nothing; repeated rows match each on their
own; ids may be of any type; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, binary_list, windows

K = 5
_BITS = 1 << 20


class Sketches:
    """The sketches of one block of items, by shingle width and by class of size (powers of two of the number of
    shingles). Of an item only its text and its hashes are held; its shingles as words are made when it is a candidate."""

    def __init__(self, items: list[tuple], num: int, den: int):
        hashes = Hashes()
        self.items: list[tuple] = []
        sketches: dict[int, dict[int, list[np.ndarray]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = (text := (text or "").encode().lower()).split()
            if not words:
                continue
            k = min(K, len(words))
            n = len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
            hashed = np.unique(windows(hashes.of(words), k))
            sketch = hashed[: n - -(-n * num // den) + 1]
            sketches[k][n.bit_length()].append((sketch, np.full(len(sketch), len(self.items))))
            self.items.append((item_id, n, k, text, hashed))
        self.by_width = {}
        for k, classes in sketches.items():
            seen, indexes = np.zeros(_BITS, dtype=bool), []
            for _, parts in sorted(classes.items()):
                keys, places = (np.concatenate(x) for x in zip(*parts, strict=True))
                by = np.argsort(keys, kind="stable")
                indexes.append((keys[by], places[by]))
                seen[keys & np.uint64(_BITS - 1)] = True
            self.by_width[k] = (seen, indexes)
        self.num, self.den, self.recent = num, den, {}

    def shingles(self, i: int) -> set[tuple]:
        if len(self.recent) > 500:
            self.recent.clear()
        if i not in self.recent:
            _, _, k, text, _ = self.items[i]
            words = text.split()
            self.recent[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)}
        return self.recent[i]

    def found(self, text: bytes | None, hashes: Hashes) -> list[tuple]:
        """(item, its shingles, how many of them the text holds) of each item that the text contains."""
        words = text.lower().split() if text else []
        if not words:
            return []
        own, out = hashes.of(words), []
        for k, (seen, indexes) in self.by_width.items():
            if len(words) < k:
                continue
            made = windows(own, k)
            near = made[seen[made & np.uint64(_BITS - 1)]]
            if not len(near):
                continue
            near, likely = np.unique(near), set()
            for keys, places in indexes:
                lo, hi = np.searchsorted(keys, near, "left"), np.searchsorted(keys, near, "right")
                likely.update(int(places[j]) for a, b in zip(lo, hi, strict=True) for j in range(a, b))
            for i in sorted(likely):
                item_id, n, _, _, hashed = self.items[i]
                at = np.flatnonzero(np.isin(made, hashed))
                shared = len({t for p in at if (t := tuple(words[p : p + k])) in self.shingles(i)})
                if shared * self.den >= n * self.num:
                    out.append((item_id, n, shared))
        return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about block_bytes of text: their number follows the benchmark's size."""
    picked = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    total = picked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        yield [tuple(r) for r in picked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", num: int = 4, den: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc id, item id, n_item_shingles, n_shared): a row for each row of docs and item that it contains."""
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (items, item_id_col)))
    picked, out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), None
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Sketches(block, num, den))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hashes = Hashes()
            for batch in batches:
                hits = [(i, *x) for i, text in enumerate(binary_list(batch.column("text"))) for x in sent.value.found(text, hashes)]
                if hits:
                    places, items_found, *rest = zip(*hits, strict=True)
                    ids = batch.column("id").take(pa.array(places, pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(items_found), *(pa.array(x, pa.int64()) for x in rest)], ["id", "item_id", "n_item_shingles", "n_shared"])

        one = picked.mapInArrow(search, f"id {kind}, item_id {item_kind}, n_item_shingles bigint, n_shared bigint")
        out = one if out is None else out.unionByName(one)
    return out.withColumnsRenamed({"id": id_col, "item_id": item_id_col})


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", num: int = 4, den: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """docs without the rows that contain an item."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Sketches(block, num, den))

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hashes = Hashes()
            for batch in batches:
                yield batch.filter(pa.array([not sent.value.found(text, hashes) for text in binary_list(batch.column(text_col))], pa.bool_()))

        docs = docs.mapInArrow(clean, schema)
    return docs
