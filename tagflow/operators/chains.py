"""Places and running sums over ordered rows, and chains along them, without one task for each key.

A chain starts at the first row of a key; every row knows where the link that starts there would end, so the links are the
rows that are reached from the first. They are found by pointer doubling: jumps of 1, 2, 4, ... links are joined with
themselves, then the rows reached so far jump by every power, the largest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.sources.scratch import written

#: Rows of a key that one window holds.
BLOCK = 1 << 16


def placed(rows: DataFrame, key: list[str], order: list[Column | str], size: str) -> DataFrame:
    """`rows`, written, with `pos` (from 0) and `before` (the sum of `size` over the rows before) within their key.

    The order is a sort over ranges; places come from the counts and sums of the ranges before. Equal rows are told apart
    by where they were read.
    """
    own = rows.withColumn("__row", F.monotonically_increasing_id())
    by = [*key, *order, "__row"]  # names with two strokes are not the caller's
    laid = own.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}).drop("__row")
    laid = written(laid)
    here = Window.partitionBy(*key, "__range").orderBy("__at")
    inside = laid.withColumns({"__n": F.row_number().over(here), "__sum": F.sum(size).over(here)})
    sums = laid.groupBy(*key, "__range").agg(F.count("*").alias("__rows"), F.sum(size).alias("__total"))
    earlier = Window.partitionBy(*key).orderBy("__range")  # one row for each range of a key
    sums = sums.select(*key, "__range", (F.sum("__rows").over(earlier) - F.col("__rows")).alias("__pos"), (F.sum("__total").over(earlier) - F.col("__total")).alias("__before"))
    found = inside.join(sums, [*key, "__range"])
    return written(found.select(*rows.columns, (F.col("__pos") + F.col("__n") - 1).cast("long").alias("pos"), (F.col("__before") + F.col("__sum") - F.col(size)).cast("long").alias("before")))


def _held_before(rows: DataFrame, key: list[str], at: str, value: str, block: Column) -> DataFrame:
    """`rows` with `held`, the last `value` that is not null at or before their `at`; windows hold a block of a key each."""
    cut = rows.withColumn("__block", block)
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy(*key, "__block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0))
    lasts = cut.groupBy(*key, "__block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at))).alias("__last"))
    carried = lasts.withColumn("__carried", F.last("__last", ignorenulls=True).over(Window.partitionBy(*key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))).drop("__last")
    return cut.withColumn("__inside", inside).join(carried, [*key, "__block"]).withColumn("held", F.coalesce("__inside", "__carried")).drop("__block", "__inside", "__carried")


def ends_of_links(items: DataFrame, key: list[str], size: str, budget: int, over: bool) -> DataFrame:
    """Key, pos and `to`: where the next link starts after one that starts at pos (null: at no row).

    A link holds what fits in `budget`, one row at least; with `over` it goes on to the row that fills it. `items` has pos and before.
    """
    # next start: first row whose running sum passes the link's room (over: the row after the one that reaches it)
    mark = F.col("before") + F.lit(budget) - (1 if over else 0)
    asked = items.select(*key, mark.alias("at"), F.lit(1).alias("kind"), "pos", F.lit(None).cast("long").alias("hit"))
    held = items.select(*key, F.col("before").alias("at"), F.lit(0).alias("kind"), "pos", F.col("pos").alias("hit"))
    # the row that holds a place of the running sum is the last that starts at or before it
    both = asked.unionByName(held.where(F.col(size) > 0) if size in held.columns else held)
    ordered = both.withColumn("__o", F.struct("at", "kind", "pos"))
    found = _held_before(ordered, key, "__o", "hit", F.floor(F.col("at") / F.lit(max(budget, 1) * 4)))
    inside = found.where("kind = 1").select(*key, "pos", "held")
    to = F.greatest(F.col("held") + (1 if over else 0), F.col("pos") + 1)
    last = items.groupBy(*key).agg(F.max("pos").alias("__last"), F.max(F.col("before") + F.col(size)).alias("__whole"))
    ends = inside.join(items.select(*key, "pos", "before"), [*key, "pos"]).join(last, key)
    fits = (F.col("before") + F.lit(budget) > F.col("__whole")) if over else (F.col("before") + F.lit(budget) >= F.col("__whole"))
    return ends.select(*key, "pos", F.when(~fits & (to <= F.col("__last")), to).alias("to"))


def reached(links: DataFrame, key: list[str]) -> DataFrame:
    """Key, pos and `link` (from 0) of the rows where links start, from the first row (pos 0) of every key."""
    jump = written(links.where("to IS NOT NULL"))
    jumps = []
    while not jump.isEmpty():
        jumps.append(jump)
        a, b = jump, jump.select(*(F.col(k).alias(f"_{k}") for k in key), F.col("pos").alias("__pos"), F.col("to").alias("__to"))
        same = [F.col(k) == F.col(f"_{k}") for k in key]
        jump = written(a.join(b, [*same, F.col("to") == F.col("__pos")]).select(*key, "pos", F.col("__to").alias("to")))
    found = links.where("pos = 0").select(*key, "pos", F.lit(0).cast("long").alias("link"))
    for k, jump in reversed(list(enumerate(jumps))):
        there = found.join(jump, [*key, "pos"]).select(*key, F.col("to").alias("pos"), (F.col("link") + F.lit(1 << k)).alias("link"))
        found = written(found.unionByName(there))
    return found


def linked(rows: DataFrame, key: list[str], order: list[Column | str], size: str, budget: int, over: bool = False) -> DataFrame:
    """`rows` with `pos` and `link`, the number of the link that holds them.

    In order, a row joins the link before it if both fit in `budget`, else it starts the next; one larger than the
    budget is alone. With `over` a link takes rows until it has `budget` or more. Sizes are not negative.
    """
    items = placed(rows, key, order, size)
    starts = reached(ends_of_links(items, key, size, budget, over), key)
    marked = items.join(starts, [*key, "pos"], "left")
    return _held_before(marked, key, "pos", "link", F.floor(F.col("pos") / BLOCK)).drop("link", "before").withColumnRenamed("held", "link")
