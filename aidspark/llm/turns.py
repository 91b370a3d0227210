"""Repair of conversation structure by secondary-sorted streaming.

A conversation should be an optional system turn and then pairs of a user and
an assistant turn. Its rows are edited to that at least cost: kept, given the
role user or assistant, deleted (blank and repeated rows must be), or an empty
user or assistant turn is inserted.

The rows are repartitioned by conversation once. Within its partition a
conversation then streams through three sorts, each of which Spark spills when
it must:

* by role and text: a row that an earlier one equals is a duplicate;
* by turn, last first: ``mapInPandas`` carries the cost from each of the four
  states to the end across Arrow batches, and writes to each row which edit is
  the cheapest from each state, two bits for each of four states, one byte in
  all. As each edit leads from a state to one other, taking the first in ASCII
  order of the equally cheap ones gives the least string of edits;
* by turn, first first: the bytes are followed from the start and the edits,
  counters and digest come out at the conversation's end.

So the backpointers of a giant conversation are spilled by Spark's sorter
beside their rows; a task holds one batch, a few numbers and one byte a row for
the string of edits. A lost executor repeats its partition.

Defined cases: nulls count as one space where they are read as text (a null
turn is sorted first and is outside every gap); rows of one turn go by role and
text; equal rows are all taken, the later ones as duplicates; a conversation
that lost all its rows has zeros, no edits and the digest of the empty text; an
empty table gives no rows; other columns, whatever their names, are not read;
texts and conversations of any length stream through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidspark.llm.common import short_batches

# Fixed by the task: costs, blanks, ends of a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
END = ".!?"

# States: nothing yet, after the system turn, after a user turn, after a pair.
_NONE, _SYSTEM, _USER, _PAIR = range(4)
#: The state that a row with this initial leads to from each state.
_NEXT = {"s": (_SYSTEM, None, None, None), "u": (_USER, _USER, None, _USER), "a": (None, None, _PAIR, None)}
#: The role that a new or reroled turn has in each state, and where it leads.
_ROLE = ("user", "user", "assistant", "user")
_TO = (_USER, _USER, _PAIR, _USER)
_LETTERS = "DIKR"
#: Costs to the end behind the last row: two inserts after a system turn, one after a user turn.
_LAST = (0, 2 * INSERT, INSERT, 0)


@lru_cache(maxsize=4096)
def step(kind: str, ahead: tuple[int, int, int, int]) -> tuple[tuple[int, int, int, int], int]:
    """Costs to the end before a row of this kind, from those behind it, and
    the cheapest edit from each state, two bits each. ``kind``: ``x`` for a row
    that must go, else its initial, with ``t`` if truncated."""
    cost, letter = [], []
    extra = TRUNCATED if kind.endswith("t") else 0
    keep = _NEXT.get(kind[:1], (None,) * 4) if kind != "x" else (None,) * 4
    for q in range(4):
        # in the order of the letters without the insert, which stays before this row
        ways = [(ahead[q] + DELETE, 0)]
        if keep[q] is not None:
            ways.append((ahead[keep[q]] + extra, 2))
        if kind != "x":
            ways.append((ahead[_TO[q]] + REROLE + extra, 3))
        c, a = min(ways)
        cost.append(c)
        letter.append(a)
    for q in (_USER, _PAIR, _NONE, _SYSTEM, _USER):  # an insert leads on to another state
        c = cost[_TO[q]] + INSERT
        if c < cost[q] or c == cost[q] and letter[q] > 1:
            cost[q], letter[q] = c, 1
    return tuple(cost), sum(a << 2 * q for q, a in enumerate(letter))


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, last turn first, with their ``edits`` byte and the ``cost`` to the
    end of the conversation from its start (at its first row)."""
    now, ahead, base = None, _LAST, 0
    for rows in batches:
        edits, costs = [], []
        for conv, kind in zip(rows["conv"], rows["kind"]):
            if conv != now:
                now, ahead, base = conv, _LAST, 0
            ahead, byte = step(kind, ahead)
            low = min(ahead)
            base += low
            ahead = tuple(c - low for c in ahead)  # few different ones, so the steps are remembered
            edits.append(byte)
            costs.append(base + ahead[_NONE])
        yield rows.assign(edits=pd.Series(edits, dtype="int32"), cost=pd.Series(costs, dtype="int64"))


class _Conversation:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, conv: str, cost: int):
        self.conv, self.cost = conv, cost
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.state, self.audit, self.digest, self.lines = _NONE, bytearray(), hashlib.sha256(), 0

    def write(self, role: str, text: str):
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self):
        self.audit += b"I"
        self.write(_ROLE[self.state], "")
        self.state = _TO[self.state]

    def row(self, turn: int | None, role: str, text: str, fault: str, edits: int):
        initial = role[:1]
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        while (edit := edits >> 2 * self.state & 3) == 1:
            self.insert()
        self.audit += _LETTERS[edit].encode()
        if edit == 2:
            self.write(role, text)
            self.state = _NEXT[initial][self.state]
        elif edit == 3:
            self.write(_ROLE[self.state], text)
            self.state = _TO[self.state]

    def done(self) -> tuple:
        while self.state in (_SYSTEM, _USER):
            self.insert()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(),
                self.digest.hexdigest())


_RESULT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_READ = ("conv", "known", "turn", "role", "text", "fault", "edits", "cost")


def _forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, talk = None, None
    for rows in batches:
        out = []
        for conv, known, turn, role, text, fault, edits, cost in zip(*(rows[c].tolist() for c in _READ)):
            if conv != now:
                if talk is not None:
                    out.append(talk.done())
                now, talk = conv, _Conversation(conv, cost)
            talk.row(turn if known else None, role, text, fault, edits)
        if out:
            yield pd.DataFrame(out, columns=_NAMES)
    if talk is not None:
        yield pd.DataFrame([talk.done()], columns=_NAMES)


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that the task plants, drawn
    by the crc32 of ``conv_id:turn``."""
    draw = F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))).cast("binary")) % 20
    text, role = _spaced(F.col("text")), _spaced(F.col("role"))
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
                        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, END, "")).otherwise(text).alias("text"),
                        draw.alias("draw"))
            .filter("draw <> 0")
            .withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row for each conversation of ``rows``: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    # numbers with nulls would reach pandas as floats, so a conversation travels as
    # text (null: empty) and a turn with a mark of being there
    src = rows.select(F.coalesce(rows[conv_col].cast("long").cast("string"), F.lit("")).alias("conv"),
                      rows[turn_col].isNotNull().cast("int").alias("known"),
                      F.coalesce(rows[turn_col].cast("long"), F.lit(0)).alias("turn"),
                      _spaced(rows[role_col]).alias("role"), _spaced(rows[text_col]).alias("text"))
    earlier = Window.partitionBy("conv", "role", "text").orderBy("known", "turn")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(bare == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.substring(bare, -1, 1).isin(*END), "truncated").otherwise(""))
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "x").otherwise(
        F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
                 F.when(F.col("fault") == "truncated", "t").otherwise("")))
    judged = (short_batches(src).repartition("conv").withColumn("nth", F.row_number().over(earlier))
              .withColumn("fault", fault).withColumn("kind", kind))
    order = ["known", "turn", "role", "text", "nth"]
    back = judged.sortWithinPartitions("conv", *[F.desc(c) for c in order])
    edited = back.mapInPandas(_backward, "conv string, known int, turn long, role string, text string, nth int, "
                                         "fault string, kind string, edits int, cost long")
    found = edited.sortWithinPartitions("conv", *order).mapInPandas(_forward, _RESULT)
    return found.withColumn("conv_id", F.col("conv_id").try_cast("long"))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, with every original conversation."""
    found = repair(damage(rows))
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = found.withColumnRenamed("conv_id", "found_id").withColumn("found", F.lit(True))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (every.join(found, every["conv_id"].eqNullSafe(found["found_id"]), "left")
            .select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
