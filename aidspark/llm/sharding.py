"""Sharding by balanced label propagation.

Each row starts in a shard drawn by its hash, so shards are even. Rows that
share a group (an equal text, or the values of any given expressions) are
linked. In each round

* every group tallies its members by shard, an aggregate with map-side sums;
* it names where its members should be: the shard that has most of them (every
  other round: most among those with room for the rest), or, for a group too
  large for that, as many of its fullest shards as it needs;
* its other members ask to move there; rows of several groups follow the
  groups with most members;
* the requests from shard to shard, ``shards`` squared numbers, are cut on the
  driver to quotas under which no shard grows over its capacity when all moves
  are made, and each request is granted by a hash of its group (of its row, in
  a group too large for one shard), so groups move as a whole.

After the last round rows without links fill the shards exactly, so that row
counts are at most one apart; linked rows leave a shard only if it is over its
count. Slots are places in the order of a hash, by prefix sums over blocks.

Only numbers travel: 64-bit hashes of groups, row numbers, shards. A group that
holds more than 1 / ``HOT`` of all rows (at most ``HOT`` a group column, so they
can be broadcast) is dealt over cells of that size wherever its members are
joined. Each round is written to the shared folder.

Defined cases: a null text counts as empty, and empty texts are equal; a null
value of a group expression links with nothing; a null id and repeated rows are
rows like others; ties go by a hash of group and shard; an empty table gives no
rows; texts of any length are only hashed and measured; columns other than the
id, the text and the named groups are not read. Two unlike texts of one 64-bit
hash would be kept together, which breaks no rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidspark.llm.common import materialize

SHARDS = 40
ROUNDS = 8
#: A group with more than one in so many rows is dealt over several tasks.
HOT = 1_000
#: Rows of a shard that are put in order by one task.
BLOCK_ROWS = 100_000
#: A group over one in so many of a shard's rows moves row by row.
LARGE = 8
#: Rounds end when fewer than one in so many linked rows moved.
SETTLED = 1_000


def _uniform(*cols) -> Column:
    """A number in [0, 1) from the hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _nodes(docs: DataFrame, id_col: str, text_col: str, groups: Sequence[Column] | None, shards: int) -> DataFrame:
    """One row of numbers for each row of ``docs``, written once: so a row's
    number stays its own when a task is repeated."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    keys = [F.when(g.isNotNull(), F.xxhash64(F.lit(i), g)) for i, g in enumerate([text] if groups is None else groups)]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.array_distinct(F.array_compact(F.array(*keys))).alias("groups"))
    return materialize(rows.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _links(nodes: DataFrame, n: int, shards: int) -> DataFrame:
    """``node, shard, g, cell, cells, n`` of the rows that share a group with
    another: its group, the cell it is joined in, their number, the group's size."""
    first = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")
    member = nodes.select("node", first.alias("shard"), F.explode("groups").alias("g"))
    size = materialize(member.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1"), "groups")
    most = max(1, n // HOT)
    cells = F.ceil(F.col("n") / most).cast("int")
    # at most HOT groups of each group column are so large
    hot = size.filter(F.col("n") > most).select("g", cells.alias("cells"))
    dealt = (member.join(F.broadcast(hot), "g", "left")
             .withColumn("cell", F.pmod(F.xxhash64("node"), F.coalesce("cells", F.lit(1))).cast("int")).drop("cells"))
    spread = size.withColumn("cells", cells).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    return materialize(dealt.join(spread, ["g", "cell"]).select("node", "shard", "g", "cell", "cells", "n"), "links")


def _destinations(links: DataFrame, room: list[int], capacity: int, heed: bool) -> DataFrame:
    """For each cell of a group that is not yet together: ``to``, the shards where
    its members are to meet, ``upto``, running sums of their room, and ``key`` (null: a
    grant is drawn for each row). ``heed``: only shards with room for the rest."""
    held = (links.groupBy("g", "shard").agg(F.count("*").alias("have"), F.max("cells").alias("cells"), F.max("n").alias("n"))
            .groupBy("g").agg(F.max("cells").alias("cells"), F.max("n").alias("n"), F.collect_list(F.struct(
                (-F.col("have")).alias("less"), F.xxhash64("g", "shard").alias("tie"), F.col("shard").alias("s"))).alias("held"))
            .filter(F.size("held") > 1).withColumn("held", F.array_sort("held")))  # an entry a shard, fullest first
    rooms = F.array(*[F.lit(max(0, r)) for r in room])
    space = lambda s: F.element_at(rooms, s + 1)
    holds = lambda x: space(x["s"]) - x["less"]
    whole = F.filter("held", lambda x: holds(x) >= F.col("n"))
    free = [s for s, r in enumerate(room) if r > 0] or [0]
    other = F.element_at(F.array(*map(F.lit, free)), F.pmod(F.xxhash64("g"), F.lit(len(free))).cast("int") + 1)
    # the fullest shards until they hold the group
    before = F.transform("held", lambda x, i: F.struct(x["s"].alias("s"), F.aggregate(
        F.slice("held", F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + holds(y)).alias("before")))
    many = F.transform(F.filter(before, lambda x: x["before"] < F.col("n")), lambda x: x["s"])
    small = F.col("n") * LARGE <= capacity
    to = F.when(F.size("whole") > 0, F.array(F.col("whole")[0]["s"])).when(
        small & (space(F.col("other")) >= F.col("n")), F.array("other")).otherwise(many)
    if not heed:
        to = F.when(small, F.array(F.col("held")[0]["s"])).otherwise(to)
    upto = F.transform("to", lambda s, i: F.aggregate(
        F.slice("to", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, y: a + F.greatest(space(y), F.lit(1))))
    return (held.withColumn("whole", whole).withColumn("other", other).withColumn("to", to)
            .select("g", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), "to", upto.alias("upto"),
                    F.when(small, F.col("g")).alias("key")))


def quotas(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Shares of the requests (from, to) under which no shard gains more than its
    room: requests into a shard that would are cut, until what leaves and what
    comes are in keeping everywhere."""
    grant = asked.astype(float)
    for _ in range(1000):
        over = grant.sum(0) - np.maximum(grant.sum(1) + room, 0)
        if (over <= 0.5).all():
            break
        grant *= np.where(over > 0, np.maximum(0, 1 - over / np.maximum(grant.sum(0), 1e-9)), 1.0)[None, :]
    return np.divide(grant, asked, out=np.zeros_like(grant), where=asked > 0)


def _one_wish(wishes: DataFrame) -> DataFrame:
    """Rows of several groups follow the shard that groups with most members name."""
    vote = wishes.groupBy("node", "wish").agg(F.sum("n").alias("votes"), F.min("key").alias("key"))
    top = vote.groupBy("node").agg(F.max_by(F.struct("wish", "key"), F.struct("votes", F.xxhash64("node", "wish"))).alias("top"))
    return wishes.drop("wish", "key").join(top.select("node", "top.*"), "node")


def propagate(links: DataFrame, capacity: list[int], rounds: int = ROUNDS, several: bool = False) -> DataFrame:
    """``links`` with the shards after the moves of all rounds; ``several``: a row may
    be in more than one group."""
    shards, now = len(capacity), links
    rows = F.count_distinct("node") if several else F.count("*")
    for turn in range(rounds):
        load = {r["shard"]: r["c"] for r in now.groupBy("shard").agg(rows.alias("c")).collect()}  # a number a shard
        room = [capacity[s] - load.get(s, 0) for s in range(shards)]
        there = _destinations(now, room, min(capacity), heed=turn % 2 == 1)
        pick = F.col("upto")[F.size("upto") - 1] * _uniform("node", "g")
        # a member in a named shard stays, another one goes where its hash falls in the room
        wish = F.when(F.array_contains("to", F.col("shard")), F.col("shard")).otherwise(
            F.col("to")[F.size(F.filter("upto", lambda u: u <= pick))])
        wishes = now.join(there, ["g", "cell"], "left").select(
            *now.columns, F.coalesce(wish, F.col("shard")).alias("wish"), F.coalesce("key", "node").alias("key"))
        wishes = materialize(_one_wish(wishes) if several else wishes, "wishes")
        asked = np.zeros((shards, shards))
        for r in wishes.filter("shard <> wish").groupBy("shard", "wish").agg(rows.alias("c")).collect():  # shards squared
            asked[r["shard"], r["wish"]] = r["c"]
        share = quotas(asked, np.array(room))
        granted = F.element_at(F.array(*map(F.lit, share.ravel().tolist())), F.col("shard") * shards + F.col("wish") + 1)
        moves = (F.col("shard") != F.col("wish")) & (_uniform("key", F.lit(turn)) < granted)
        now = wishes.withColumn("shard", F.when(moves, F.col("wish")).otherwise(F.col("shard"))).select(*links.columns)
        if (asked * share).sum() * SETTLED < sum(load.values()) and (turn or not asked.sum()):
            break
    return now


def _placed(rows: DataFrame, by: list[str], blocks: int, name: str) -> DataFrame:
    """``rows`` with their place from 0 among those equal in ``by``: places within
    blocks of a hash, and sums over the blocks before."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.lit(blocks)).cast("int"))
    totals = rows.groupBy(*by, "block").agg(F.count("*").alias("c"))
    before = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*by, "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    at = F.row_number().over(Window.partitionBy(*by, "block").orderBy(F.xxhash64("node", F.lit("order")), "node"))
    return (rows.withColumn("at", at).join(base, [*by, "block"])
            .withColumn(name, F.col("base") + F.col("at") - 1).drop("at", "base", "block"))


def shard(docs: DataFrame, shards: int = SHARDS, groups: Sequence[Column] | None = None, rounds: int = ROUNDS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's ``doc_id, size`` (bytes of its text and 16), ``text_crc32``,
    ``shard`` and ``slot``. ``groups``: expressions over ``docs`` whose equal values
    link rows (default: the text). The shards' row counts are at most one apart."""
    nodes = _nodes(docs, id_col, text_col, groups, shards)
    n = nodes.count()
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    blocks = max(8, math.ceil(n / shards / BLOCK_ROWS))
    several = groups is not None and len(groups) > 1
    links = propagate(_links(nodes, n, shards), capacity, rounds, several)
    linked = links.select("node", "shard").distinct() if several else links.select("node", "shard")
    load = {r["shard"]: r["count"] for r in linked.groupBy("shard").count().collect()}
    over = [s for s in range(shards) if load.get(s, 0) > capacity[s]]
    if over:  # the last of a shard that holds too many linked rows give way
        limit = F.element_at(F.array(*map(F.lit, capacity)), F.col("shard") + 1)
        kept = _placed(linked.filter(F.col("shard").isin(over)), ["shard"], blocks, "place").filter(F.col("place") < limit)
        linked = materialize(linked.filter(~F.col("shard").isin(over)).unionByName(kept.drop("place")), "linked")
    lacking = np.cumsum([capacity[s] - min(load.get(s, 0), capacity[s]) for s in range(shards)]).tolist()
    # the others fill the shards up, in the order of their places
    upto = F.array(*[F.lit(int(x)) for x in lacking])
    rest = _placed(nodes.join(linked, "node", "left_anti").select("node", F.lit(0).alias("all")), ["all"], blocks * shards, "place")
    filled = rest.select("node", F.size(F.filter(upto, lambda u: u <= F.col("place"))).alias("shard"))
    dealt = materialize(nodes.drop("groups").join(linked.unionByName(filled), "node"), "dealt")
    return _placed(dealt, ["shard"], blocks, "slot").drop("node")
