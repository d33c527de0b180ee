"""Running values along an order that need no group in one task.

A window over ``partitionBy(doc).orderBy(pos)`` puts a whole document into one task. These scans cut each
document into blocks of positions instead: running values are computed inside each block, one summary row of
each block is scanned along the document, and its carry is added back. A document of any length
is thus spread over many tasks, and only a row for each ``BLOCK`` positions meets in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512


def placed(df: DataFrame, key: str, pos: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``__block``, hash-partitioned by key and block."""
    return df.withColumn("__block", F.floor(F.col(pos) / block)).repartition(key, "__block")


def in_blocks(df: DataFrame, key: str, pos: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``__block``, hash-partitioned by key and block, exact duplicates of rows dropped."""
    return placed(df, key, pos, block).distinct()


def at_positions(df: DataFrame, key: str, pos: str, *values: Column, block: int = BLOCK) -> DataFrame:
    """One row for each key and position with aggregated ``values``, as input of :func:`scan`; like ``in_blocks``, with one shuffle for both."""
    return placed(df, key, pos, block).groupBy(key, "__block", pos).agg(*values)


def scan(
    df: DataFrame,
    key: str,
    pos: str,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` (from :func:`in_blocks`) with running columns along ``pos`` within ``key``.

    ``sums``: sum up to and with the row. ``lasts``: last value that isn't null up to and with the row.
    ``previous``: the value of the row before, null at the first. ``pos`` must be unique within a key.
    """
    sums, lasts, previous = sums or {}, lasts or {}, previous or {}
    if not (sums or lasts or previous):
        return df
    order = Window.partitionBy(key, "__block").orderBy(pos)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    local = df
    for name, value in sums.items():
        local = local.withColumn(f"__v_{name}", value)
    for name, value in (lasts | previous).items():
        local = local.withColumn(f"__v_{name}", value)
    parts = [F.sum(f"__v_{n}").alias(f"__c_{n}") for n in sums]
    parts += [F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col(pos))).alias(f"__c_{n}") for n in lasts]
    parts += [F.max_by(F.struct(f"__v_{n}"), pos).alias(f"__c_{n}") for n in previous]
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = local.groupBy(key, "__block").agg(*parts).select(
        key,
        "__block",
        *(F.coalesce(F.sum(f"__c_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in sums),
        *(F.last(f"__c_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in lasts),
        *(F.last(f"__c_{n}").over(before).alias(f"__c_{n}") for n in previous),
    )
    out = local
    for n in sums:
        out = out.withColumn(f"__r_{n}", F.sum(f"__v_{n}").over(upto))
    for n in lasts:
        out = out.withColumn(f"__r_{n}", F.last(f"__v_{n}", ignorenulls=True).over(upto))
    for n in previous:
        out = out.withColumn(f"__r_{n}", F.lag(F.struct(f"__v_{n}")).over(order))
    out = out.join(carried, [key, "__block"])
    for n in sums:
        out = out.withColumn(n, (F.col(f"__c_{n}") + F.col(f"__r_{n}")).cast("int"))
    for n in lasts:
        out = out.withColumn(n, F.coalesce(f"__r_{n}", f"__c_{n}"))
    for n in previous:
        out = out.withColumn(n, F.coalesce(F.col(f"__r_{n}"), F.col(f"__c_{n}"))[f"__v_{n}"])
    return out.drop(*(f"__{kind}_{n}" for n in (*sums, *lasts, *previous) for kind in "vrc"))


def gather(rows: DataFrame, groups: DataFrame, key: str, pos: str, group: str, columns: list[str]) -> DataFrame:
    """``key``, ``group`` and ``members``: the ``pos`` and ``columns`` of each group's rows, in order.

    ``groups`` (key, pos, group, from :func:`scan`) has narrow rows that number the positions; groups are runs of positions. Wide rows move once, to
    their block, where they meet their numbers; only the first and last group of a block, which may reach over it, move again. Of rows at one
    position the greatest counts.
    """
    block = Window.partitionBy(key, "__block")
    ends = (F.col(group) == F.min(group).over(block)) | (F.col(group) == F.max(group).over(block))
    marks = groups.select(key, pos, group, "__block", ends.alias("__ends"))
    tagged = rows.select(key, pos, F.lit(True).alias("__row"), *columns).unionByName(marks.drop("__block"), allowMissingColumns=True)
    here = Window.partitionBy(key, "__block", pos)
    met = placed(tagged, key, pos).withColumns({group: F.max(group).over(here), "__ends": F.max("__ends").over(here)}).where(F.col("__row") & F.col(group).isNotNull())
    pieces = met.groupBy(key, "__block", group).agg(F.max("__ends").alias("__ends"), F.collect_list(F.struct(pos, *columns)).alias("members"))
    spread = pieces.where("__ends").groupBy(key, group).agg(F.flatten(F.collect_list("members")).alias("members"))
    every = pieces.where("not __ends").select(key, group, "members").unionByName(spread).withColumn("members", F.array_sort("members"))
    last = lambda m, i: (i == F.size("members") - 1) | (F.get("members", i + 1)[pos] != m[pos])
    return every.withColumn("members", F.filter("members", last))
