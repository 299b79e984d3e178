"""Mixing sources to target weights (3): iterative proportional fitting, then sampling by calibrated probabilities.

Documents are summed to cells (source, language, topic) of token counts. A cell's documents are kept with probability
least(1, rate * a * b * c), a factor for its source, one for its language and one for its topic, chosen so that the
tokens expected of the sample meet the target share of each source, language and topic: raking under the bound that no
probability passes 1. A value that asks for more than all of its tokens gets all of them, and its siblings share the
rest in proportion to what they asked for; expected_shares() tells what was asked, can be had and is met. Raking goes on
until no share is off by more than `tolerance`; where targets contradict each other (a source with one language only)
it ends after `sweeps` rounds, and the sources' shares are those that hold. A document's uniform number comes from a
hash of its id, so a rerun keeps the same documents.

The documents are read once to be summed and once to be sampled; nothing of their size is shuffled. A source's cells are
one row, at most languages times topics of them, so its factor is worked out within the row; languages and topics are
vocabularies (at most MOST_VALUES each, checked), whose factors the driver holds and sends with each pass over the
sources, which gives back one sum for each.

Defined results: a null source or language is "", a null text has no tokens and topic "empty"; a value without a
target keeps its own share; documents without tokens have probability 0; rows that repeat share one fate; a null id is
hashed as an empty one. Extra columns pass through where docs are returned, but for columns called probability or kept,
which give way to the result's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, save

DIMENSIONS = ("source", "lang", "topic")
#: Languages, and topics, that there may be: two vectors of this length are what the driver holds and sends.
MOST_VALUES = 100_000
#: Cells up to which the table of probabilities is sent to all tasks instead of being joined by a shuffle.
_SENT_CELLS = 200_000
_LEAST, _MOST = 1e-30, 1e30

def format_topic(text: Column) -> Column:
    """A topic for tables without one, by form: table (at least one | in 100 characters), shouting (capitals over a
    third), long (over 5,000 characters), short (under 600), prose."""
    size = F.length(text)
    bars = size - F.length(F.replace(text, F.lit("|"), F.lit("")))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return F.when(text.isNull() | (size == 0), "empty").when(bars * 100 >= size, "table").when(capitals * 3 > size, "shouting").when(size > 5000, "long").when(size < 600, "short").otherwise("prose")


def described(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """docs with __source, __lang and __topic."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.withColumns({"__source": of(source_col), "__lang": of(lang_col), "__topic": format_topic(F.col(text_col)) if topic is None else F.coalesce(topic, F.lit(""))})


def n_tokens(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(dimension, target): own shares to a power, as shares again; powers under 1 lift what is rare."""
    own = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("w"))
    return own.join(F.broadcast(own.agg(F.sum("w").alias("all_w"))), F.lit(True)).select(dimension, F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w")).otherwise(0.0).alias("target"))


def asked_shares(cells: DataFrame, dimension: str, targets: DataFrame, total: float) -> DataFrame:
    """(value, own, asked, most): tokens, the share asked for (own share where there is no target; all sum to 1)."""
    own = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("own"))
    told = own.join(targets.select(F.col(dimension).alias("value"), "target"), "value", "left").withColumn("asked", F.coalesce("target", F.col("own") / total)).drop("target")
    whole = told.agg(F.sum("asked")).first()[0] or 1.0
    return save(told.withColumn("asked", F.col("asked") / whole))


def level(own: np.ndarray, asked: np.ndarray, rate: float) -> float:
    """x with sum(least(bound, x * asked)) = 1, bound: the share that a value has of a sample of `rate` if all of it is
    kept. The sum is concave in x, so x is the largest of the solutions of its linear pieces."""
    bound = own / own.sum() / rate
    by = np.argsort(bound / np.maximum(asked, 1e-300), kind="stable")
    before = np.cumsum(bound[by]) - bound[by]
    after = np.cumsum(asked[by][::-1])[::-1]
    return float(np.max((1 - before[after > 0]) / after[after > 0]))


def level_of_rows(rows: DataFrame, total: float, rate: float) -> float:
    """level() of a table of any number of values: the values at their bound only become more, so this ends."""
    x, bound = 1.0, F.col("own") / F.lit(total * rate)
    while True:
        over = F.col("asked") * F.lit(x) >= bound
        full, free = rows.agg(F.sum(F.when(over, bound)), F.sum(F.when(~over, F.col("asked")))).first()
        new = (1 - (full or 0.0)) / free if free else x
        if new <= x * (1 + 1e-13):
            return x
        x = new


class Fit:
    """A fitted mix: cells by source, factors of languages and topics, targets by dimension."""

    def __init__(self, cells: DataFrame, targets: dict[str, DataFrame], rate: float, sweeps: int = 60, tolerance: float = 1e-10):
        if not 0 < rate <= 1:
            raise ValueError("rate must be over 0 and at most 1")
        cells = save(cells.filter("tokens > 0").select(*DIMENSIONS, F.col("tokens").cast("double").alias("tokens")))
        self.rate, self.total, self.sweeps_done = rate, cells.agg(F.sum("tokens")).first()[0] or 0.0, 0
        if not self.total:
            self.rows = None
            self.cells = cells
            return
        shares = {d: asked_shares(cells, d, targets[d], self.total) for d in DIMENSIONS}
        self.values, self.asked, self.target, self.full, self.factor = {}, {}, {}, {}, {}
        for d in DIMENSIONS[1:]:
            found = shares[d].orderBy("value").limit(MOST_VALUES + 1).collect()
            if len(found) > MOST_VALUES:
                raise ValueError(f"more than {MOST_VALUES} values of {d}: the dimension of many values must be the source")
            own, self.asked[d] = (np.array([r[k] for r in found]) for k in ("own", "asked"))
            self.values[d] = [r["value"] for r in found]
            bound, wanted = own / self.total / rate, level(own, self.asked[d], rate) * self.asked[d]
            self.target[d] = np.minimum(bound, wanted)
            # All of a value at its bound is kept: a factor that needs no fitting.
            self.full[d] = wanted * (1 + 1e-12) >= bound
            self.factor[d] = np.where(self.full[d], _MOST, 1.0)
        x = level_of_rows(shares["source"], self.total, rate)
        self.sources = shares["source"].withColumn("target", F.least(F.col("own") / F.lit(self.total * rate), F.col("asked") * F.lit(x)))
        each = cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells"))
        self.rows = save(each.join(self.sources.select(F.col("value").alias("source"), "target"), "source"))
        for _ in range(sweeps):
            self.sweeps_done += 1
            if max(self._step(d) for d in DIMENSIONS[1:]) <= tolerance:
                break

    def _solved(self):
        """A function of a batch of rows: for each source its cells' languages, topics (places among the values), tokens
        and probabilities."""
        places = {d: {v: i for i, v in enumerate(self.values[d])} for d in DIMENSIONS[1:]}
        factor, rate, total = {d: f.copy() for d, f in self.factor.items()}, self.rate, self.total

        def solve(batch: pa.RecordBatch):
            for source, cells, target in zip(batch.column("source").to_pylist(), batch.column("cells").to_pylist(), batch.column("target").to_pylist(), strict=True):
                lang, topic = (np.array([places[d][c[d]] for c in cells]) for d in DIMENSIONS[1:])
                tokens = np.array([c["tokens"] for c in cells])
                w = factor["lang"][lang] * factor["topic"][topic]
                by = np.argsort(-w, kind="stable")
                kept = tokens[by] / rate
                own = np.max((target * total - (np.cumsum(kept) - kept)) / np.cumsum((tokens * w)[by][::-1])[::-1])
                yield source, lang, topic, tokens, np.minimum(1.0, rate * own * w)

        return solve

    def _step(self, dimension: str) -> float:
        """Fit one dimension's factors; how far its shares were off."""
        solve, n, first = self._solved(), len(self.factor[dimension]), dimension == "lang"

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(n)
            for batch in batches:
                for _, lang, topic, tokens, p in solve(batch):
                    np.add.at(sums, lang if first else topic, tokens * p)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["i", "kept"])

        now = np.zeros(n)
        for i, kept in self.rows.mapInArrow(add, "i bigint, kept double").groupBy("i").agg(F.sum("kept")).collect():  # a row a value
            now[i] = kept / self.rate / self.total
        wanted = self.target[dimension]
        ratio = np.where(now > 0, wanted / np.maximum(now, 1e-300), 1.0)
        free = ~self.full[dimension]
        self.factor[dimension] = np.where(free, np.clip(self.factor[dimension] * ratio, _LEAST, _MOST), _MOST)
        return float(np.max(np.abs(now - wanted)[free], initial=0.0))

    def probabilities(self) -> DataFrame:
        """(source, lang, topic, tokens, probability)."""
        if self.rows is None:
            return self.cells.withColumn("probability", F.lit(0.0))
        solve, values = self._solved(), self.values

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for source, lang, topic, tokens, p in solve(batch):
                    columns = [pa.array([source] * len(p), pa.string()), pa.array([values["lang"][i] for i in lang], pa.string()), pa.array([values["topic"][i] for i in topic], pa.string()), pa.array(tokens), pa.array(p)]
                    yield pa.RecordBatch.from_arrays(columns, [*DIMENSIONS, "tokens", "probability"])

        return self.rows.mapInArrow(tell, "source string, lang string, topic string, tokens double, probability double")

    def expected_shares(self) -> DataFrame:
        """(dimension, value, asked, target, expected): token shares asked for, to be had at this rate (under what was
        asked where that is infeasible), and expected of the sample."""
        kept = save(self.probabilities().withColumn("x", F.col("tokens") * F.col("probability")))
        whole = kept.agg(F.sum("x")).first()[0] or 1.0
        out = None
        for d in DIMENSIONS:
            told = self.sources.select("value", "asked", "target") if d == "source" else kept.sparkSession.createDataFrame([(v, float(a), float(t)) for v, a, t in zip(self.values[d], self.asked[d], self.target[d], strict=True)], "value string, asked double, target double")
            one = told.join(kept.groupBy(F.col(d).alias("value")).agg((F.sum("x") / whole).alias("expected")), "value").select(F.lit(d).alias("dimension"), "value", "asked", "target", "expected")
            out = one if out is None else out.unionByName(one)
        return out


def uniform(key: Column, seed: int = 0) -> Column:
    """In [0, 1), from a hash of the key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def cells_of(told: DataFrame, text_col: str = "text") -> DataFrame:
    """(source, lang, topic, tokens) of docs as described() gives them."""
    return told.groupBy(*(F.col(f"__{d}").alias(d) for d in DIMENSIONS)).agg(F.sum(n_tokens(text_col)).alias("tokens"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None, powers: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None, rate: float = 0.5, sweeps: int = 60, seed: int = 0) -> DataFrame:
    """docs with __source, __lang, __topic, probability and kept. targets: by dimension, a table (dimension, target) of
    shares; else powers: by dimension, the power to which its own shares are taken for its targets."""
    powers = {"source": 0.5, "lang": 0.7, "topic": 0.5} | (powers or {})
    told = described(docs.drop("probability", "kept"), text_col, source_col, lang_col, topic)
    cells = save(cells_of(told, text_col))
    wanted = {d: (targets or {}).get(d, None) for d in DIMENSIONS}
    wanted = {d: tempered_targets(cells, d, powers[d]) if t is None else t for d, t in wanted.items()}
    fitted = save(Fit(cells, wanted, rate, sweeps).probabilities().select(*(F.col(d).alias(f"__{d}") for d in DIMENSIONS), "probability"))
    sent = F.broadcast(fitted) if fitted.count() <= _SENT_CELLS else fitted
    joined = told.join(sent, ["__source", "__lang", "__topic"], "left")
    p = F.when(F.coalesce(F.regexp_instr(F.col(text_col), F.lit(WORD)), F.lit(0)) > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return joined.withColumn("probability", p).withColumn("kept", uniform(F.col(id_col), seed) < F.col("probability"))
