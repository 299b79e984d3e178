"""Quality rules (9): word and line counts, then distance of a document's histograms from its language's reference.

The method is distribution divergence. A reference is learned for every language from all of its documents: the shares
of character classes, and the shares of its common words (those with at least 1/COMMON of its words, so there are at
most COMMON of them). A document is rejected when the Jensen-Shannon distance (base 2, 0 to 1) of either histogram to
its reference is above a bound. Short texts have noisy histograms, so each test waits for a minimum of words.

Defined results: null and empty texts have no words and fail the base rules; a null language is the language "".
Every language has its own reference, whatever its share of the corpus. One learned from few words is off by itself:
the square of the bound on word distances is wider by COMMON / (the language's words), which is over what chance can
add; it fades out as a language grows, and leaves no test to languages of hardly more than COMMON words. References of languages with at least
MIN_SHARE of all words (so 1/MIN_SHARE of them at most, of COMMON words each) go to the workers as one dictionary, the
others' as a table joined on the language; a verdict does not depend on which.
Other columns of the input are not looked at, and pass through whatever their names are where columns are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, binary_list, save, unused, windows

SYMBOLS = b"#*$%&|<>"
COMMON = 500
MIN_SHARE = 1e-3
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "other")
_CLASS = np.full(256, 6, dtype=np.int64)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r", SYMBOLS, b"!\"'(),-./:;?@[\\]^_`{}~+=")):
    _CLASS[list(_set)] = _i
_CLASS[0x80:0xC0] = 7  # continuation bytes: not characters of their own


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits of two histograms, each taken to shares."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


def char_classes(text: bytes) -> np.ndarray:
    found = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    return np.bincount(_CLASS, weights=found, minlength=8)[:7].astype(np.int64)


def language_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, kind, key, n): counts over all documents of every word (kind w) and character class (kind c)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def rows():
            flat = [(lang, "w", w, n) for lang, c in words.items() for w, n in c.items()]
            flat += [(lang, "c", CLASSES[i].encode(), int(n)) for lang, c in classes.items() for i, n in enumerate(c) if n]
            words.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*flat), (pa.string(), pa.string(), pa.binary(), pa.int64()), strict=True)], ["lang", "kind", "key", "n"])

        for batch in batches:
            for text, lang in zip(binary_list(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                if text:
                    words.setdefault(lang, Counter()).update(text.split())
                    classes[lang] = classes.get(lang, 0) + char_classes(text)
            if sum(map(len, words.values())) > 1_000_000:
                yield rows()
        if words:
            yield rows()

    picked = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    partial = picked.mapInArrow(count, "lang string, kind string, key binary, n bigint")
    return partial.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


Reference = tuple[np.ndarray, dict[bytes, int], np.ndarray]


def reference_of(entries: list[dict], total: int) -> Reference:
    """Class counts, common word -> place, their counts and then that of all other words."""
    classes, words = np.zeros(len(CLASSES)), {}
    for x in entries:
        if x["kind"] == "c":
            classes[CLASSES.index(bytes(x["key"]).decode())] = x["n"]
        else:
            words[bytes(x["key"])] = x["n"]
    order = sorted(words)
    return classes, {w: i for i, w in enumerate(order)}, np.array([words[w] for w in order] + [total - sum(words.values())], dtype=float)


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON) -> tuple[dict[str, Reference], DataFrame]:
    """The references of the languages with at least MIN_SHARE of all words (so at most 1/MIN_SHARE of them, of at most
    `common` words), and a row for each other language: lang, total, entries (kind, key, n)."""
    counts = save(language_counts(docs, text_col, lang_col))
    totals = counts.filter("kind = 'w'").groupBy("lang").agg(F.sum("n").alias("total"))
    totals = totals.join(F.broadcast(totals.agg(F.sum("total").alias("everything"))), F.lit(True))
    totals = save(totals.select("lang", "total", (F.col("total") >= F.col("everything") * MIN_SHARE).alias("large")))
    # A row a language: sent to all tasks, as a join by language would bring a large one's words to one of them.
    few = F.broadcast(totals) if totals.count() <= 100_000 else totals
    kept = counts.join(few, "lang").filter((F.col("kind") == "c") | (F.col("n") * common >= F.col("total")))
    rows = save(kept.groupBy("lang", "total", "large").agg(F.collect_list(F.struct("kind", "key", "n")).alias("entries")))
    large = {r["lang"]: reference_of(r["entries"], r["total"]) for r in rows.filter("large").collect()}
    return large, rows.filter("not large").select("lang", "total", "entries")


def base_counts(text: bytes, words: list[bytes], hashes: Hashes) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    chars = int(found.sum() - found[0x80:0xC0].sum() - found[9:14].sum() - found[32])
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 3:
        h = windows(hashes.of(words), 3)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(h), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(words), dtype=bool)
        for j in range(3):
            covered[j : j + len(h)] |= twice
        repeated = int(covered.sum())
    return chars, int(found[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_class_distance: float = 0.31,
    max_word_distance: float = 0.34,
    min_words_classes: int = 50,
    min_words_common: int = 100,
    keep_columns: bool = False,
) -> DataFrame:
    """One row for each row of docs: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance and word_distance (null under the minimum lengths). keep_columns: the input's own columns beside
    `kept` alone, for use as a filter."""
    large, small = language_references(docs, text_col, lang_col)
    ID, TEXT, LANG, TOTAL, ENTRIES, KEPT = (unused(x, docs.columns) for x in ("__id", "__text", "__lang", "__total", "__entries", "__kept"))
    references = docs.sparkSession.sparkContext.broadcast(large)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, own_of = Hashes(), {}
        for batch in batches:
            rows = []
            for i, (text, lang) in enumerate(zip(binary_list(batch.column(TEXT)), batch.column(LANG).to_pylist(), strict=True)):
                words = (text := text or b"").split()
                n, counts = len(words), base_counts(text, words, hashes)
                failed = n < 50 or 100 * counts[3] > 50 * n
                by_class = by_word = widest = None
                reference = references.value.get(lang) or own_of.get(lang)
                if not reference and n and ENTRIES in batch.schema.names:
                    if len(own_of) >= 1000:
                        own_of.clear()
                    reference = own_of[lang] = reference_of(batch.column(ENTRIES)[i].as_py(), batch.column(TOTAL)[i].as_py())
                if reference and n >= min_words_classes:
                    by_class = js_distance(char_classes(text).astype(float), reference[0])
                if reference and n >= min_words_common:
                    other = len(reference[2]) - 1
                    get = reference[1].get
                    by_word = js_distance(np.bincount(np.fromiter((get(w, other) for w in words), dtype=np.int64, count=n), minlength=other + 1).astype(float), reference[2])
                    widest = max_word_distance**2 + COMMON / reference[2].sum()
                kept = not failed and (by_class or 0) <= max_class_distance and (by_word is None or by_word**2 <= widest)
                rows.append((n, *counts, failed, kept, by_class, by_word))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            if keep_columns:
                own = [x for x in batch.schema.names if x not in (TEXT, LANG, TOTAL, ENTRIES)]
                yield pa.RecordBatch.from_arrays([batch.column(x) for x in own] + [made[6]], own + [KEPT])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(ID), *made], [id_col, *names, "base_failed", "kept", "class_distance", "word_distance"])

    def judged(picked: DataFrame, schema: str) -> DataFrame:
        if small.isEmpty():
            return picked.mapInArrow(judge, schema)
        # Rows of large languages (and those without words) stay where they are; the others meet their reference.
        named = small.select(F.col("lang").alias(LANG), F.col("total").alias(TOTAL), F.col("entries").alias(ENTRIES))
        is_large = F.col(LANG).isin(list(large))
        rest = picked.filter(~is_large).join(named, LANG, "left").select(*picked.columns, TOTAL, ENTRIES)
        return picked.filter(is_large).mapInArrow(judge, schema).unionByName(rest.mapInArrow(judge, schema))

    used = [F.col(text_col).alias(TEXT), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias(LANG)]
    if keep_columns:
        own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return judged(docs.select("*", *used), f"{own}, `{KEPT}` boolean").filter(F.col(KEPT)).drop(KEPT)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{x} bigint" for x in names) + ", base_failed boolean, kept boolean, class_distance double, word_distance double"
    return judged(docs.select(F.col(id_col).alias(ID), *used), schema)
