"""Near-duplicates by SetSketch registers (Ertl, 2021).

A document is the set of its word shingles. Register ``i`` is
``floor(1 - log_b(min h_i))`` over the set, with ``h_i`` exponentially
distributed: a truncated minimum on an exponential scale, so sketches merge by
the larger register and equal registers tell similarity. The steps:

* documents with the same set form a class; classes are compared from here on;
* bands of registers give candidate buckets. In each bucket all members are
  compared with its first class only (star); the joint likelihood of two
  sketches estimates their similarity, and what may reach the threshold is
  verified on the full sets. Links give components;
* members of one bucket that ended up in different components are then compared
  with one another, so that no link inside a bucket is missed. This is done
  inside tasks, on the sketches: a pair leaves its task only if the sketches
  allow the threshold, in large buckets only if the full sets confirm it. Large
  buckets are dealt as pairs of blocks of bounded size; a pair that shares
  several buckets is compared in the first. Members that a star has joined are
  never compared.

With ``rows`` registers to a band, a pair at the threshold shares no bucket with
probability below ``miss``; the number of bands follows from that. The least
number of equal registers, and with it the least estimate, follow from ``miss``
in the same way, so a pair exactly at the threshold is lost with probability
3 ``miss`` at most (bands, equal registers, estimate), and one over it with less.
Very long texts are shingled whole; ties of the smallest id go by the text's
hash; columns other than id and text are not read.

Defined cases: a text of fewer words than a shingle is one shingle of all its
words; a null or empty text has an empty set and is linked with nothing; rows
that repeat an id and text are one document; a null id sorts after all others
(a component of such rows only has a null component id); an empty table gives
no rows. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import LAST_ID, WordHash, bucket_count, keyed, materialize, mix, ngram_hashes, packed, unpacked
from aidspark.llm.graph import components

BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
ROWS = 4
MISS = 1e-5
#: Registers of a sketch (at least; the bands use the first of them).
REGISTERS = 192
#: Step of the estimate, by which it may be off.
STEP = 0.01
#: Members and bytes of sets of a block; buckets of more than ``SMALL`` members
#: are compared with their sets at hand.
BLOCK, BLOCK_BYTES, SMALL = 512, 16_000_000, 32


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def least_equal(percent: int, m: int, miss: float = MISS) -> int:
    """Equal registers of ``m`` that a pair at the threshold has but with probability
    ``miss`` (binomial: each register of the two is equal with a probability of the
    similarity at least). Pairs of fewer are dropped unverified."""
    t, below = percent / 100, 0.0
    for k in range(m + 1):
        below += math.comb(m, k) * t ** k * (1 - t) ** (m - k)
        if below > miss:
            return k
    return m


def shingles(words: list[bytes], hashes: WordHash, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(hashes.of(words), min(size, len(words))))


def _seeds(m: int) -> tuple[np.ndarray, np.ndarray]:
    at = mix(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return at[:m], at[m:] | np.uint64(1)


def registers(flat: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """``m`` registers of each set; ``flat`` holds the (non-empty) sets one
    after the other."""
    out = np.empty((len(starts), m), dtype=np.uint16)
    for i, (flip, odd) in enumerate(zip(*_seeds(m))):
        low = np.minimum.reduceat((flat ^ flip) * odd, starts)
        h = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, LIMIT + 1)
    return out


def _collision(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 101) -> np.ndarray:
    """Jaccard similarity that makes the counts of larger, smaller and equal
    registers likeliest, given the set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    alpha = na / (na + nb)
    beta = 1 - alpha
    best, found = np.full(len(a), -np.inf), np.zeros(len(a))
    top = np.minimum(alpha / beta, beta / alpha)
    for j in np.linspace(0, 1, steps):
        x = j * top
        up, down = _collision(alpha - beta * x), _collision(beta - alpha * x)
        like = (more * np.log(np.maximum(up, 1e-9)) + less * np.log(np.maximum(down, 1e-9))
                + same * np.log(np.maximum(1 - up - down, 1e-9)))
        better = like > best
        best, found = np.where(better, like, best), np.where(better, x, found)
    return found


def _sketch(size: int, m: int):
    def run(batches):
        hashes = WordHash()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.encode().lower().split(), hashes, size) for t in part.column("text").to_pylist()]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                some = np.flatnonzero(n)
                regs, cids = [None] * len(sets), [None] * len(sets)
                if len(some):
                    flat = np.concatenate(sets)
                    starts = (np.cumsum(n) - n)[some]
                    r = registers(flat, starts, m)
                    c = mix(np.add.reduceat(mix(flat), starts) + n[some].astype(np.uint64)) ^ np.bitwise_xor.reduceat(
                        mix(flat + np.uint64(7)), starts)
                    for i, row, cid in zip(some.tolist(), r, c.view(np.int64).tolist()):
                        regs[i], cids[i] = row.tobytes(), cid
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in ("doc_id", "rid", "rhash")), pa.array(n),
                     pa.array(cids, pa.int64()), pa.array(regs, pa.binary())],
                    names=["doc_id", "rid", "rhash", "n_shingles", "cid", "registers"])
    return run


def sketches(docs: DataFrame, size: int, m: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rid, rhash, n_shingles, cid`` (hash of the set, null if empty)
    and ``registers`` (little-endian uint16) of every row."""
    return keyed(docs, id_col, text_col).mapInArrow(
        _sketch(size, m), "doc_id long, rid long, rhash long, n_shingles long, cid long, registers binary")


def _band_keys(rows: int, bands: int):
    """(cid, n, registers) -> one row per band with its bucket."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.stack([np.frombuffer(b, "<u2") for b in batch.column("registers").to_pylist()]).astype(np.uint64)
            keys = np.zeros((len(r), bands), np.uint64)
            for k in range(rows):
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + r[:, k:bands * rows:rows] + np.uint64(1)
            keys = mix(keys + mix(np.arange(1, bands + 1, dtype=np.uint64)))
            back = np.repeat(np.arange(len(r)), bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(r))), *(batch.column(c).take(pa.array(back)) for c in ("cid", "rid", "n"))],
                names=["bucket", "band", "cid", "rid", "n"])
    return run


def _may_reach(regs_a, regs_b, na, nb, percent: int, miss: float) -> np.ndarray:
    """Whether the joint estimate of each pair is as near to the threshold as that
    of a pair at it is but with probability ``miss``."""
    m = regs_a.shape[1]
    return estimate(regs_a, regs_b, na, nb) >= least_equal(percent, m, miss) / m - STEP


def _likely(percent: int, miss: float):
    """Keeps pairs whose estimate may reach the threshold."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.stack([np.frombuffer(b, "<u2") for b in batch.column(c).to_pylist()]) for c in ("ra", "rb"))
            na, nb = (np.asarray(batch.column(c)).astype(float) for c in ("na", "nb"))
            ok = _may_reach(ra, rb, na, nb, percent, miss)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                both = len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
                ok.append(100 * both >= percent * (len(x) // 8 + len(y) // 8 - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _sets(size: int):
    def run(batches):
        hashes = WordHash()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.encode().lower().split(), hashes, size).astype("<u8").tobytes()
                        for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("cid"), pa.array(sets, pa.binary())], names=["cid", "set"])
    return run


def _crossing(regs: np.ndarray, n: np.ndarray, root: np.ndarray, side: np.ndarray | None, band: int,
              rows: int, percent: int, miss: float):
    """Index pairs of different roots that the sketches allow and that share no
    earlier band; with ``side``, pairs between the two sides only. A pair needs so
    many equal registers and, among those that have them, the joint estimate."""
    least = least_equal(percent, regs.shape[1], miss)
    for lo in range(0, len(regs), 32):
        i = np.arange(lo, min(lo + 32, len(regs)))
        ok = (root[i, None] != root[None]) & (100 * n[i, None] >= percent * n[None]) & (100 * n[None] >= percent * n[i, None])
        ok &= (i[:, None] < np.arange(len(regs))) if side is None else (~side[i, None] & side[None])
        a, b = np.nonzero(ok)
        for at in range(0, len(a), 20_000):
            x, y = i[a[at:at + 20_000]], b[at:at + 20_000]
            same = regs[x] == regs[y]
            k = same.sum(1) >= least
            if band:
                k &= ~same[:, :band * rows].reshape(len(x), band, rows).all(2).any(1)
            x, y = x[k], y[k]
            k = _may_reach(regs[x], regs[y], n[x].astype(float), n[y].astype(float), percent, miss)
            yield x[k], y[k]


def _table_arrays(table: pa.Table):
    regs = np.stack([np.frombuffer(b, "<u2") for b in table.column("registers").to_pylist()])
    return regs, *(table.column(c).to_numpy() for c in ("n", "root", "cid", "band"))


def _pairs_table(found: list) -> pa.Table:
    cols = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4)]
    return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["a", "b", "na", "nb"])


def _small_buckets(rows: int, percent: int, miss: float):
    """Pairs of the small buckets of one part."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        regs, n, root, cid, band = _table_arrays(table)
        bucket = table.column("bucket").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        found = []
        for s, e in zip(cuts[:-1], cuts[1:]):
            for x, y in _crossing(regs[s:e], n[s:e], root[s:e], None, int(band[s]), rows, percent, miss):
                found.append((cid[s:e][x], cid[s:e][y], n[s:e][x], n[s:e][y]))
        return _pairs_table(found)
    return run


def _block_pair(rows: int, percent: int, miss: float):
    """Links between two blocks of a large bucket (or within one)."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        regs, n, root, cid, band = _table_arrays(table)
        sets = [np.frombuffer(b, "<u8") for b in table.column("set").to_pylist()]
        side = None if key[1] == key[2] else table.column("block").to_numpy() == key[2].as_py()
        found = []
        for x, y in _crossing(regs, n, root, side, int(band[0]), rows, percent, miss):
            keep = []
            for i, j in zip(x.tolist(), y.tolist()):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                keep.append(100 * both >= percent * (n[i] + n[j] - both))
            keep = np.array(keep, dtype=bool)
            found.append((cid[x][keep], cid[y][keep], n[x][keep], n[y][keep]))
        return _pairs_table(found)
    return run


class _Links:
    """Classes, their sketches and sets, and the links verified so far."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int, miss: float):
        self.classes, self.sets, self.percent, self.miss = classes, sets, percent, miss

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (``a, b, na, nb``) those that reach the threshold."""
        p = self.percent
        regs = self.classes.select("cid", "registers")
        sized = pairs.filter((100 * F.col("na") >= p * F.col("nb")) & (100 * F.col("nb") >= p * F.col("na")))
        # written, as with broadcast sets both Python steps would share a stage and
        # hold two workers for each task
        likely = materialize(sized.join(regs.toDF("a", "ra"), "a").join(regs.toDF("b", "rb"), "b")
                             .mapInArrow(_likely(p, self.miss), "a long, b long"), "likely")
        return (likely.join(self.sets.toDF("a", "sa"), "a").join(self.sets.toDF("b", "sb"), "b")
                .select("a", "b", "sa", "sb").mapInArrow(_verify(p), "a long, b long"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = ROWS, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, rid, rhash, n_shingles, component_id`` (smallest id
    reachable by links of ``100 * intersection >= percent * union``) and
    ``first`` (this row is the component's first by id and text hash)."""
    bands = bands_for(percent, rows, miss)
    m = max(REGISTERS, rows * bands)
    rows_of = materialize(sketches(docs, size, m, id_col, text_col), "sketches")
    some = rows_of.filter("cid IS NOT NULL")
    classes = materialize(some.groupBy("cid").agg(
        F.min(F.struct("rid", "rhash")).alias("key"), F.first("n_shingles").alias("n"),
        F.first("registers").alias("registers")).select("cid", "key.rid", "key.rhash", "n", "registers"), "classes")
    banded = (classes.select("cid", "rid", "n", "registers")
              .mapInArrow(_band_keys(rows, bands), "bucket long, band int, cid long, rid long, n long"))
    centre = (banded.groupBy("bucket").agg(F.min(F.struct("rid", "cid", "n")).alias("c"), F.count("*").alias("size"))
              .filter("size > 1").select("bucket", "c"))
    members = materialize(banded.join(centre, "bucket"), "buckets")
    used = members.select("cid").distinct()
    text_of = classes.select("cid", "rid", "rhash").join(used, "cid")
    sets = materialize(
        keyed(docs, id_col, text_col).select("rid", "rhash", "text").join(text_of, ["rid", "rhash"])
        .select("cid", "text").mapInArrow(_sets(size), "cid long, set binary").dropDuplicates(["cid"]), "sets")
    links = _Links(classes, sets, percent, miss)
    star = (members.filter("cid != c.cid")
            .select(F.col("cid").alias("a"), F.col("c.cid").alias("b"), F.col("n").alias("na"), F.col("c.n").alias("nb"))
            .distinct())
    edges = materialize(links.verified(star), "links")
    joined = components(edges, "a", "b")

    # members of one bucket in different components
    placed = (members.join(joined.withColumnRenamed("node", "cid"), "cid", "left")
              .select("bucket", "band", "cid", "n", F.coalesce("root", "cid").alias("root")))
    mixed = (placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                          F.count("*").alias("size"), F.sum("n").alias("shingles")).filter("lo < hi"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    open_ = materialize(placed.join(mixed.select("bucket", "size", blocks.alias("blocks")), "bucket")
                        .join(classes.select("cid", "registers"), "cid"), "open")
    pair = "a long, b long, na long, nb long"
    parts = bucket_count(docs, text_col)
    small = (open_.filter(F.col("size") <= SMALL).withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(parts)))
             .groupBy("part").applyInArrow(_small_buckets(rows, percent, miss), pair))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    large = (open_.filter(F.col("size") > SMALL).join(sets, "cid").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .groupBy("bucket", "lo", "hi").applyInArrow(_block_pair(rows, percent, miss), pair))
    more = materialize(links.verified(small.distinct()).union(large.select("a", "b").distinct()), "links")
    if more.head(1):
        joined = components(edges.union(more), "a", "b")

    root = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "rid", "rhash", F.coalesce("root", "cid").alias("root"))
    least = root.groupBy("root").agg(F.min(F.struct("rid", "rhash")).alias("least"))
    of_class = root.join(least, "root").select("cid", "least")
    out = rows_of.drop("registers").join(of_class, "cid", "left")
    own = F.struct("rid", "rhash")
    least = F.coalesce("least", own)
    return out.select(
        "doc_id", "rid", "rhash", "n_shingles",
        F.when(least["rid"] != F.lit(LAST_ID), least["rid"]).alias("component_id"), (least == own).alias("first"))


def first_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that come first in their component (rows that repeat
    an id and text are one), with all columns."""
    first = (near_duplicates(docs, size, percent, id_col=id_col, text_col=text_col)
             .filter("first").select("rid", "rhash").distinct())
    rows = packed(docs, id_col, text_col).dropDuplicates(["rid", "rhash"])
    return unpacked(rows.join(first, ["rid", "rhash"], "left_semi"), docs.columns)
