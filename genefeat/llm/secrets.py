"""Secret scans (1): credentials in whole texts, and how widely each one is copied. DataFrame functions only.

Every text is scanned for three base kinds (assign, access, hex). The method then looks at ownership over the whole
corpus: each candidate's SHA-256 is counted by distinct repositories of each owner. What decides is how evenly its
repositories lie among owners: (sum of r)^2 / (sum of r^2) over owners with r repositories each, which is the number of
owners where each has as many, and near 1 where one has most. Up to `max_owners` the value belongs to a few and is
live-looking, beyond it is a copied example. The size of the corpus does not enter. Opaque tokens (a run of 20 or more
token characters with lower case, upper case and a digit) are too loose a pattern to report alone: they are added, as
kind `owned`, only where they are live-looking by ownership and lie outside the base spans.

Defined results: a null text is empty; a null owner or repository counts as one more owner or repository; rows that
repeat are scanned and returned each on its own, and add nothing to distinct counts. Positions are code points from 0,
end exclusive. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import largest_before, sums_before
from .common import save, unused

KINDS = ("assign", "access", "hex", "owned")
_ANY_CASE = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"


#: Owners that a live value may have at most, as its repositories spread over them.
FEW = 3
#: A value that is at least this part of all finds is sent to their tasks: there are at most so many such values.
COMMON_PART = 10_000


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """array<struct<start, stop, kind, value>> of a pattern's leftmost non-overlapping matches. What split() leaves
    between the matches gives their positions."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.split(text, pattern, -1)
    parts = F.transform(F.arrays_zip(whole.alias("whole"), value.alias("value"), F.slice(gaps, 1, F.size(whole)).alias("gap")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("size"), x["value"].alias("value")))

    def placed(parts: Column) -> Column:
        at = sums_before(F.transform(parts, lambda x: x["gap"] + x["size"]))
        return F.transform(F.arrays_zip(at.alias("at"), parts.alias("part")), lambda x: F.struct((x["at"] + x["part"]["gap"]).alias("start"), (x["at"] + x["part"]["gap"] + x["part"]["size"]).alias("stop"), F.lit(kind).alias("kind"), x["part"]["value"].alias("value")))

    none = F.array().cast("array<struct<start:bigint,stop:bigint,kind:int,value:string>>")
    return F.when(text.rlike(pattern), F.transform(F.array(parts), placed)[0]).otherwise(none)


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(row, id, repo, owner, base, loose): what the patterns find in each row; the text itself is left behind."""
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    assign = F.filter(_matches(text, ASSIGN, 0, 2), lambda x: F.length(x["value"]) >= 6)
    base = F.array_sort(F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2)))
    live = lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[a-z]") & x["value"].rlike("[A-Z]")
    hashed = lambda c: F.transform(c, lambda x: x.withField("value", F.sha2(x["value"], 256)))
    scanned = picked.select("row", "id", "repo", "owner", hashed(base).alias("base"), hashed(F.filter(_matches(text, OPAQUE, 3), live)).alias("loose"))
    outside = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))
    return scanned.withColumn("loose", F.when(F.size("loose") > 0, outside).otherwise(F.col("loose")))


def ownership(found: DataFrame) -> DataFrame:
    """(value, times, owners, repos, squares): finds of each candidate's hash, its distinct owners and repositories, and
    the sum of the squares of each owner's repositories. The groupings narrow one after the other, each with partial
    sums, so a value that a third of all rows have is a row a task."""
    each = found.select("owner", "repo", F.explode(F.concat("base", "loose")).alias("c")).select("owner", "repo", F.col("c.value").alias("value"))
    by_repo = each.groupBy("value", "owner", "repo").agg(F.count("*").alias("times"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("times").alias("times"))
    return by_owner.groupBy("value").agg(F.sum("times").alias("times"), F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum(F.col("repos") * F.col("repos")).alias("squares"))


def with_ownership(each: DataFrame, owned: DataFrame) -> DataFrame:
    """each (with a column value) and its value's ownership. The rows of common values stay in their tasks."""
    total = owned.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    common = F.col("times") * COMMON_PART >= total
    few, rest = F.broadcast(owned.filter(common)), owned.filter(~common)
    return each.join(few, "value").unionByName(each.join(few.select("value"), "value", "left_anti").join(rest, "value"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source", max_owners: int = FEW) -> DataFrame:
    """A row for each row of docs: id, base (spans of the base kinds), spans (with the added ones; array of
    start, kind, stop, owners, repos, live), live and copied (how many of them spread over at most, or over more than,
    max_owners owners)."""
    found = save(candidates(docs, id_col, text_col, repo_col, owner_col))
    each = found.select("row", F.explode(F.concat("base", "loose")).alias("c")).select("row", "c.*")
    owned = save(ownership(found).withColumn("live", F.col("repos") * F.col("repos") <= F.col("squares") * max_owners))
    judged = with_ownership(each, owned).filter("kind < 3 or live")
    span = F.struct("start", "kind", "stop", "owners", "repos", "live")
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"), F.count_if("live").alias("live"), F.count_if(~F.col("live")).alias("copied"))
    none = F.array().cast(by_row.schema["spans"].dataType)
    joined = found.join(by_row, "row", "left")
    return joined.select(F.col("id").alias(id_col), "base", F.coalesce("spans", none).alias("spans"), F.coalesce("live", F.lit(0)).alias("live"), F.coalesce("copied", F.lit(0)).alias("copied"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Counts and digests of secret_spans()."""
    found = secret_spans(docs, id_col, **options)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"), F.col("live").alias("n_live"), F.col("copied").alias("n_copied"), F.coalesce(F.array_max(F.transform("spans", lambda x: x["repos"])), F.lit(0)).cast("bigint").alias("most_repos"))


def mask_live_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """docs with each live-looking secret's characters replaced by `mask`; copied examples stay, and so do all rows.
    Only texts that match a pattern are joined with their spans. options: those of secret_spans()."""
    text, KEY, HIT, SPANS = F.coalesce(F.col(text_col), F.lit("")), *(unused(x, docs.columns) for x in ("__key", "__hit", "__spans"))
    keyed = docs.withColumn(KEY, F.xxhash64(id_col, text_col)).withColumn(HIT, text.rlike("|".join((ASSIGN, ACCESS, HEX, OPAQUE))))
    hit, rest = keyed.filter(F.col(HIT)), keyed.filter(~F.col(HIT))
    spans = secret_spans(hit, KEY, text_col, **options)
    live = spans.select(F.col(KEY), F.filter("spans", lambda x: x["live"]).alias(SPANS)).filter(F.size(SPANS) > 0)
    joined = hit.join(live.groupBy(KEY).agg(F.first(SPANS).alias(SPANS)), KEY, "left")

    def masked(spans: Column) -> Column:
        """For each span, what is left of the text before it and a mask, unless it begins within one before it."""
        both = F.arrays_zip(spans.alias("span"), largest_before(F.transform(spans, lambda x: x["stop"])).alias("at"))
        left = lambda x: F.substring(F.col(text_col), x["at"].cast("int") + 1, F.greatest(F.lit(0), x["span"]["start"] - x["at"]).cast("int"))
        parts = F.transform(both, lambda x: F.when(x["span"]["stop"] > x["at"], F.concat(left(x), F.when(x["span"]["start"] >= x["at"], F.lit(mask)).otherwise(""))).otherwise(""))
        return F.concat(F.array_join(parts, ""), F.substring(F.col(text_col), F.array_max(F.transform(spans, lambda x: x["stop"])).cast("int") + 1, F.length(text_col)))

    changed = joined.withColumn(text_col, F.when(F.col(SPANS).isNull(), F.col(text_col)).otherwise(F.transform(F.array(F.col(SPANS)), masked)[0]))
    return changed.select(docs.columns).unionByName(rest.select(docs.columns))
