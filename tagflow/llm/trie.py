"""Operator 13: the prefix trie of conversations by partition refinement.

Turns travel as two 64-bit hashes and a length. Equal conversations are made one first, with their number. All
conversations start as one class; a round takes every active class to the depth where its members part (the next turns of
all are compared by a smallest and a largest hash), emits the nodes passed on the way as one unary segment, and splits the
class by the turn after it. Classes of one are retired with their tail as a segment. Rounds are thus as many as
branchings lie on one path, however long the turns between them. The fold goes the same rounds back.
No table has texts after the first sort; keys that many rows share are counted map-side or looked up by salts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagflow.llm.common import SALT_ROWS, looked_up, parts, written

#: Conversations of one hundred share the first turns of the first of them, at most HEAD - 1.
HUNDRED, HEAD = 100, 6
#: Nodes of a segment that are summed up in one window.
BLOCK = 4096
#: Ids of equal conversations that one piece of text holds, on the way to their digest.
PIECE = 8192
EMPTY = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns of every conversation with their place (from 1): conv_id, pos, t1, t2, chars.

    The order is a sort over ranges of all columns, so the turns of a long conversation are spread; places come from
    the counts of the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "row"]
    hashes = F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", "role", F.lit(1)).alias("t2")
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", *hashes, F.length("text").cast("long").alias("chars"), F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    laid = written(laid)
    each = laid.groupBy(F.col("conv_id").alias("c"), F.col("range").alias("r")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("r")) - F.col("n")  # one row for each range of a conversation
    joined = laid.join(each.withColumn("before", before), (F.col("conv_id") == F.col("c")) & (F.col("range") == F.col("r")))
    return joined.select("conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "t1", "t2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ids (c), and the turns of the rebuilt conversations: c, d, t1, t2, chars.

    The first h turns are those of the first conversation of the hundred (all if it has fewer), then come the own ones
    after the first h; h is the CRC-32 of the id modulo HEAD.
    """
    sizes = written(turns.groupBy(F.col("conv_id").alias("c")).agg(F.max("pos").alias("size")))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % HEAD
    base = F.col("c") - F.col("c") % HUNDRED
    asks = sizes.select("c", h.alias("h"), base.alias("base"))
    heads = turns.where(F.col("pos") < HEAD).withColumnRenamed("conv_id", "b")  # HEAD - 1 rows of each
    shared = asks.where("h > 0").join(heads, (F.col("base") == F.col("b")) & (F.col("pos") <= F.col("h"))).select("c", F.col("pos").alias("d"), "t1", "t2", "chars")
    firsts = sizes.where(F.col("c") % HUNDRED == 0).select(F.col("c").alias("b"), "size")
    taken = asks.join(firsts, F.col("base") == F.col("b"), "left").select(F.col("c").alias("k"), F.struct("h", F.least(F.col("h"), F.coalesce("size", F.lit(0))).alias("taken")).alias("up"))
    salts = parts(turns.count(), SALT_ROWS)
    own = looked_up(turns, "conv_id", "pos", taken, salts).where("pos > up.h")
    own = own.select(F.col("conv_id").alias("c"), (F.col("pos") - F.col("up.h") + F.col("up.taken")).alias("d"), "t1", "t2", "chars")
    return sizes.select("c"), written(shared.unionByName(own))


def copies(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """Every conversation with its size and the smallest id of those equal to it: c, size, rep."""
    marks = turns.groupBy("c").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("d", "t1", "t2")).alias("f1"), F.bit_xor(F.xxhash64("t2", "t1", "d")).alias("f2"))
    zero = F.lit(0).cast("long")
    whole = ids.join(marks, "c", "left").select("c", F.struct(*(F.coalesce(x, zero).alias(x) for x in ("size", "f1", "f2"))).alias("f"))
    whole = written(whole)
    least = whole.groupBy(F.col("f").alias("k")).agg(F.min("c").alias("up"))
    found = looked_up(whole, "f", "c", least, parts(whole.count(), SALT_ROWS))
    return written(found.select("c", F.col("f.size").alias("size"), F.col("up").alias("rep")))


def _pieces(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (rep, c) as texts of ids in a row: rep, first, ids."""
    rep, held = None, []

    def out() -> pd.DataFrame:
        return pd.DataFrame({"rep": [rep], "first": [held[0]], "ids": [",".join(map(str, held))]})

    for frame in rows:
        for r, c in zip(frame["rep"].tolist(), frame["c"].tolist(), strict=True):
            if held and (r != rep or len(held) == PIECE):
                yield out()
                held = []
            rep = r
            held.append(c)
    if held:
        yield out()


def _digests(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted pieces as one digest for each rep; a piece at a time is held."""
    rep, state = None, None
    for frame in rows:
        for r, ids in zip(frame["rep"].tolist(), frame["ids"], strict=True):
            if state is not None and r == rep:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                yield pd.DataFrame({"rep": [rep], "ends": [state.hexdigest()]})
            rep, state = r, hashlib.sha256(ids.encode())
    if state is not None:
        yield pd.DataFrame({"rep": [rep], "ends": [state.hexdigest()]})


def ends(members: DataFrame) -> DataFrame:
    """The digest of the ids of equal conversations: rep, m (their number), ends.

    A digest is one sequence, so ids meet in one place, but as pieces of PIECE ids that ranges of the sorted ids made.
    """
    many = members.groupBy("rep").agg(F.count("*").alias("m"))
    many = written(many)
    one = many.where("m = 1").select("rep", "m", F.sha2(F.col("rep").cast("string").cast("binary"), 256).alias("ends"))
    more = many.where("m > 1")
    # of a group only the others need a look-up: the first one is its rep
    grouped = members.where("c <> rep").select("rep", "c").unionByName(more.select("rep", F.col("rep").alias("c")))
    pieces = grouped.repartitionByRange("rep", "c").sortWithinPartitions("rep", "c").mapInPandas(_pieces, "rep long, first long, ids string")
    met = pieces.repartition("rep").sortWithinPartitions("rep", "first").mapInPandas(_digests, "rep long, ends string")
    return one.unionByName(more.join(met, "rep").select("rep", "m", "ends"))


def refined(distinct: DataFrame, turns: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Segments of every round, classes and the tails of those that the round leaves alone.

    A segment is rep, start, stop (depths), n (members), ender (the conversation that ends at `stop`, if one does), prep, pstart (the segment
    above). `distinct` has c, size, m; `turns` has c, d, t1, t2 of these.
    """
    least = distinct.agg(F.min("c")).first()[0]
    if least is None:
        return []
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    active = distinct.select("c", "size", "m", F.lit(least).alias("rep"), zero.alias("start"), none.alias("prep"), none.alias("pstart"))
    rounds, here = [], turns.select("c", "d", "t1", "t2")
    left = distinct.count()
    while left:
        # where members part: the first depth at which their turns differ, or the end of the shortest
        each = active.groupBy("rep", "start", "prep", "pstart").agg(F.min(F.struct("size", "c")).alias("low"), F.sum("m").alias("n"))
        ahead = active.select("c", "rep", "start").join(here, "c").where("d > start")
        span = ahead.groupBy("rep", "d").agg(F.min("t1").alias("a"), F.max("t1").alias("b"), F.min("t2").alias("e"), F.max("t2").alias("f"))
        differ = span.where("a <> b OR e <> f").groupBy(F.col("rep").alias("r")).agg((F.min("d") - 1).alias("same"))
        stop = F.least("low.size", "same")  # a null is no bound
        seen = each.join(differ, F.col("rep") == F.col("r"), "left").select("rep", "start", stop.alias("stop"), "n", F.when(F.col("low.size") == stop, F.col("low.c")).alias("ender"), "prep", "pstart")
        classes = written(seen)
        salts = parts(left, SALT_ROWS)
        on = looked_up(active.select("c", "size", "m", "rep", "start"), "rep", "c", classes.select(F.col("rep").alias("k"), F.col("stop").alias("up")), salts).where("size > up")
        at = here.select(F.col("c").alias("tc"), "d", "t1", "t2")
        asked = written(on.join(at, (F.col("c") == F.col("tc")) & (F.col("d") == F.col("up") + 1)).select("c", "size", "m", F.struct("rep", "start", "d", "t1", "t2").alias("key")))
        fresh = asked.groupBy(F.col("key").alias("k")).agg(F.struct(F.min("c").alias("rep"), F.count("*").alias("members")).alias("up"))
        split = written(looked_up(asked, "key", "c", fresh, salts).select("c", "size", "m", F.col("up.rep").alias("rep"), F.col("key.d").alias("start"), F.col("key.rep").alias("prep"), F.col("key.start").alias("pstart"), F.col("up.members").alias("members")))
        tails = split.where("members = 1").select("rep", "start", F.col("size").alias("stop"), F.col("m").alias("n"), F.col("c").alias("ender"), "prep", "pstart")
        rounds.append((classes, tails))
        active = split.where("members > 1").drop("members")
        left = active.count()
    return rounds


KEY = ["rep", "start"]


def folded(rounds: list[tuple[DataFrame, DataFrame]], saved: DataFrame) -> DataFrame:
    """All segments with leaves, children (of the last node) and below (what is saved under the last node).

    `saved` has rep, start and own, what is saved on a segment itself. Under the classes of a round hang its tails and the
    classes of the round after.
    """
    zero = F.lit(0).cast("long")
    own = saved.select(F.col("rep").alias("r"), F.col("start").alias("s"), "own")

    def hanging(segments: DataFrame) -> DataFrame:
        with_own = segments.join(own, (F.col("rep") == F.col("r")) & (F.col("start") == F.col("s")), "left")
        return with_own.select("prep", "pstart", "leaves", (F.col("below") + F.coalesce("own", zero)).alias("saved"))

    done, under = [], None
    for classes, tails in reversed(rounds):
        low = tails.withColumns({"leaves": F.lit(1).cast("long"), "children": zero, "below": zero})
        hang = hanging(low) if under is None else hanging(low.unionByName(under))
        sums = hang.groupBy(F.col("prep").alias("pr"), F.col("pstart").alias("ps")).agg(F.sum("leaves").alias("leaves"), F.count("*").alias("children"), F.sum("saved").alias("below"))
        joined = classes.join(sums, (F.col("rep") == F.col("pr")) & (F.col("start") == F.col("ps")), "left").drop("pr", "ps")
        under = written(joined.withColumns({"leaves": F.coalesce("leaves", F.lit(1)).cast("long"), "children": F.coalesce("children", zero), "below": F.coalesce("below", zero)}))
        done += [low, under]
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `conversations` has conv_id, turn, role, text. Null roles and texts are empty; turns without a number come first, and
    turns of one number are ordered by role and text (equal rows are turns each); rows without a conv_id are no
    conversation; an empty table has no root and gives no rows; extra columns are ignored. A very long conversation is
    spread over ranges of its turns; a very long text is hashed whole.
    """
    ids, turns = rebuilt(numbered(conversations))
    members = copies(ids, turns)
    distinct = written(members.groupBy("rep").agg(F.first("size").alias("size"), F.count("*").alias("m")).withColumnRenamed("rep", "c"))
    first = written(turns.join(distinct.select("c"), "c", "left_semi"))
    rounds = refined(distinct, first)
    if not rounds:
        kinds = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], kinds)
    plain = rounds[0][0]
    for part in [rounds[0][1], *(x for pair in rounds[1:] for x in pair)]:
        plain = plain.unionByName(part)
    turn = first.select(F.col("c").alias("tc"), "d", "chars")
    passed = plain.select(*KEY, "stop", "n").join(turn, (F.col("rep") == F.col("tc")) & F.col("d").between(F.col("start"), F.col("stop"))).select(*KEY, "n", "d", "chars")
    passed = written(passed.withColumn("block", F.floor(F.col("d") / BLOCK)))
    # code points from a node's own turn to the segment's last, by blocks: no window holds more than BLOCK nodes of a segment
    shared = passed.where("n > 1")
    blocks = shared.groupBy(*KEY, "block").agg(F.sum("chars").alias("total"))
    later = blocks.withColumn("later", F.sum("total").over(Window.partitionBy(*KEY).orderBy(F.desc("block"))) - F.col("total")).drop("total")
    inner = F.sum("chars").over(Window.partitionBy(*KEY, "block").orderBy(F.desc("d")))
    from_here = shared.withColumn("inner", inner).join(later, [*KEY, "block"]).select(*KEY, "d", ((F.col("n") - 1) * (F.col("inner") + F.col("later"))).alias("own"))
    whole = shared.groupBy(*KEY).agg(F.sum((F.col("n") - 1) * F.col("chars")).alias("own"))
    digests = ends(members).select(F.col("rep").alias("er"), "ends")
    segments = folded(rounds, whole)
    segments = written(segments.join(digests, F.col("ender") == F.col("er"), "left").drop("er", "ender"))
    zero = F.lit(0).cast("long")
    root = segments.where("start = 0").select(*KEY, zero.alias("d")).join(whole, KEY, "left").select(*KEY, "d", F.coalesce("own", zero).alias("own"))
    nodes = passed.where("n = 1").select(*KEY, "d", zero.alias("own")).unionByName(from_here).unionByName(root).join(segments, KEY)
    last, top = F.col("d") == F.col("stop"), F.col("d") == F.col("start")
    return nodes.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.when(top, F.col("prep")).otherwise(F.col("rep")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("own") + F.col("below")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
    )
