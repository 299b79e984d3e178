"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def running_before(numbers: Column, combine: Callable[[Column, Column], Column], group: int = 256) -> Column:
    """array<bigint>: for each number what combine() makes of 0 and those before it, combine being associative and 0
    neutral. Results are appended within groups and over groups, so an array of n costs n * group steps, not n * n."""
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")

    def running(values: Column) -> Column:
        start = F.struct(zero.alias("at"), none.alias("found"))
        add = lambda acc, x: F.struct(combine(acc["at"], x).cast("bigint").alias("at"), F.concat(acc["found"], F.array(acc["at"])).alias("found"))
        return F.aggregate(values, start, add, lambda acc: acc["found"])

    n = F.size(numbers)
    firsts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / group).cast("int"))).otherwise(F.array().cast("array<int>"))
    groups = F.transform(firsts, lambda g: F.slice(numbers, g * group + 1, F.lit(group)))
    totals = F.transform(groups, lambda g: F.aggregate(g, zero, lambda acc, x: combine(acc, x).cast("bigint")))
    both = F.arrays_zip(groups.alias("own"), running(totals).alias("before"))
    return F.flatten(F.transform(both, lambda b: F.transform(running(b["own"]), lambda x: combine(x, b["before"]))))


def sums_before(sizes: Column) -> Column:
    return running_before(sizes, lambda a, b: a + b)


def largest_before(numbers: Column) -> Column:
    """Of numbers that are 0 or more."""
    return running_before(numbers, lambda a, b: F.greatest(a, b))
