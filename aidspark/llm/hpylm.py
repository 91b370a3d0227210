"""Language-model scoring with a hierarchical Pitman-Yor bigram model.

Each context word is a restaurant of the Chinese-restaurant process: the words
that follow it are its customers, the words served at its tables its dishes. All
context restaurants share one parent, the unigram restaurant, whose customers
are their tables and whose own parent is uniform over the vocabulary and one
unknown word. Given the parent's probability of a word, the number of tables a
word has in a restaurant is resampled by Gibbs from its exact conditional (with
generalised Stirling numbers, so the seating itself is summed out; see Teh 2006,
and Buntine and Hutter 2010); predictive probabilities are averaged over the
samples kept. A text's score is the sum of log10 predictive probabilities of its
words and its end; perplexity follows from it.

How it is distributed:

1. Every task counts the words of its texts; the counts are summed up by word.
   This is the vocabulary. The sampler starts from the seating in which every
   customer has a table: a word's count is its customers in the unigram restaurant.
2. The words of training texts go to buckets by their context, as counts of
   (context, word) of a stretch of texts, so each restaurant is whole in one
   bucket, and its tables are resampled there (``BURN_IN`` sweeps).
3. The tables of all restaurants are summed up by word: these are the customers of
   the unigram restaurant, which is sampled over the vocabulary (``ROOT_SWEEPS``
   sweeps, each one aggregate).
4. All words go to the buckets by their context; each restaurant is sampled there
   again, now with its parent's new probabilities, and its words are scored; sums
   come back per document. A bucket holds about ``CHARS_PER_BUCKET`` characters'
   worth. Contexts of more than ``HOT`` words are split over buckets by the
   following word; the share of tables of a part stands for the whole.

Within one sweep the restaurants of a bucket and the parent use the state of the
sweep before (the usual approximation of distributed Gibbs samplers); the tables
come to the parent once, between steps 2 and 4. The words of the ``HEAD``
commonest entries of the vocabulary are known to every task (a table of fixed
size); of the others a bucket gets those that its restaurants seat, with their
counts; in step 2, before the parent is sampled, they have their mean probability.
All counts are exact, of all training rows. Samples depend on hashes only, so a
task that is run again gives the same result.

Defined cases: a null or empty text is its end alone; repeated rows are trained
on and scored each; with no training rows every word has the uniform
probability of the unknown word; a context unseen in training has its parent's
probabilities; very long texts are read whole, in stretches; equal counts need
no order; columns other than the id and the text are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, bucket_count, keyed, materialize, mix

DISCOUNT, STRENGTH = 0.85, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
BURN_IN, SAMPLES, ROOT_SWEEPS = 2, 3, 3
HEAD = 1 << 19
HOT = 500_000
CHUNK_WORDS = 1_000_000
#: Texts of a stretch, so that their numbers fit two bytes.
CHUNK_TEXTS = 30_000
#: Customers up to which table counts have their exact conditional; beyond, the
#: further tables follow the expected growth with its spread.
EXACT = 64
END, START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)


def _stirling(d: float, n: int = EXACT) -> np.ndarray:
    """log of generalised Stirling numbers S(c, t), c and t from 0 to n."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(n):
        t = np.arange(n + 1)
        with np.errstate(divide="ignore"):
            stay = out[c] + np.log(np.maximum(c - d * t, 0))
        out[c + 1] = np.logaddexp(np.concatenate([[-np.inf], out[c, :-1]]), stay)
    return out


_TABLES: dict[float, np.ndarray] = {}


def uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from hashes."""
    x = mix(key + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def sample_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, strength: float,
                  u: np.ndarray) -> np.ndarray:
    """Table counts of dishes with ``c`` customers, given the ``others`` tables
    of the restaurant, the parent's probability ``p`` and uniform numbers."""
    log_s = _TABLES.setdefault(d, _stirling(d))
    t = np.minimum(c, 1).astype(np.float64)
    small = np.minimum(c, EXACT)
    order = np.argsort(small, kind="stable")
    cuts = np.searchsorted(small[order], np.arange(2, EXACT + 2))
    for n in range(2, EXACT + 1):
        k = order[cuts[n - 2]:cuts[n - 1]]
        step = 400_000 // n
        for lo in range(0, len(k), step):
            part = k[lo:lo + step]
            j = np.arange(n)
            w = np.cumsum(np.log(strength + d * (others[part, None] + j)) + np.log(p[part, None]), 1) + log_s[n, 1:n + 1]
            w = np.exp(w - w.max(1, keepdims=True)).cumsum(1)
            t[part] = 1 + (w < u[part, None] * w[:, -1:]).sum(1)
    big = np.flatnonzero(c > EXACT)
    if len(big):
        i, more, to = np.full(len(big), float(EXACT)), np.zeros(len(big)), c[big].astype(float)
        base, pb, t0 = others[big], p[big], t[big]
        while (i < to).any():
            step = np.minimum(i / 4, to - i)
            new = (strength + d * (base + t0 + more)) * pb
            more += step * new / (new + i + step / 2 - d * (t0 + more))
            i += step
        spread = np.sqrt(more) * np.sqrt(12) * (uniform(u[big].view(np.uint64), 1) - 0.5)
        t[big] = np.clip(np.round(t0 + more + spread), 1, to)
    return t


def _read(batch, hashes: WordHash):
    """(document key, train, word hashes with the end) of each row."""
    for dk, train, text in zip(*(batch.column(c).to_pylist() for c in ("dk", "train", "text"))):
        yield dk, bool(train), np.concatenate([hashes.of(text.encode().lower().split()), [END]])


def _chunks(batches, chunk_words: int):
    hashes, rows, size = WordHash(), [], 0
    for batch in batches:
        for row in _read(batch, hashes):
            rows.append(row)
            size += len(row[2])
            if size >= chunk_words or len(rows) >= CHUNK_TEXTS:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _pairs(rows):
    """Context and word of every word of the rows, one after the other."""
    w = np.concatenate([r[2] for r in rows])
    n = np.array([len(r[2]) for r in rows])
    u = np.concatenate([[START], w[:-1]])
    u[np.cumsum(n) - n] = START
    return u, w, n


def _count(chunk_words: int):
    def run(batches):
        for rows in _chunks(batches, chunk_words):
            words = [r[2] for r in rows if r[1]]
            if not words:
                continue
            ids, c = np.unique(np.concatenate(words), return_counts=True)
            for lo in range(0, len(ids), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000]) for x in (ids.view(np.int64), c.astype(np.int64))],
                                                 names=["w", "c"])
    return run


def _root_sweep(total_tables: float, base: float, sweep: int, d: float, strength: float):
    def run(batches):
        for b in batches:
            w, k = (np.asarray(b.column(c)) for c in ("w", "k"))
            was = np.asarray(b.column("t")).astype(np.float64)
            t = sample_tables(k, total_tables - was, np.full(len(k), base), d, strength,
                              uniform(w.view(np.uint64), 100 + sweep))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("w", "c", "k")), pa.array(np.rint(t).astype(np.int64))],
                                             names=["w", "c", "k", "t"])
    return run


@dataclass(frozen=True)
class Root:
    """The unigram restaurant: the probability of a word with ``k`` customers at
    ``t`` tables follows from all customers and tables."""
    train_tokens: int
    types: int
    texts: int          # texts trained on
    customers: float
    tables: float

    @property
    def unknown(self) -> float:
        """Probability of the unknown word."""
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.tables) / (self.types + 1) / (ROOT_STRENGTH + self.customers)

    def p(self, k: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.maximum(k - ROOT_DISCOUNT * t, 0) / (ROOT_STRENGTH + self.customers) + self.unknown

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the task's smoothed unigram share."""
        return np.log10((c + 0.5) / (self.train_tokens + 0.5 * (self.types + 1)))


def _vocabulary(src: DataFrame, chunk_words: int) -> tuple[DataFrame, Root]:
    """``w, c`` of every word, and the start of the unigram restaurant: all its
    customers, at one table a word."""
    vocab = materialize(src.mapInArrow(_count(chunk_words), "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "vocabulary")
    ends = F.sum(F.when(F.col("w") == int(END.view(np.int64)), F.col("c")))
    n = vocab.agg(F.sum("c").alias("N"), F.count("*").alias("V"), ends.alias("texts")).first()
    total, types = n["N"] or 0, n["V"]
    return vocab, Root(total, types, n["texts"] or 0, float(total), float(types))


def _sample_root(vocab: DataFrame, seats: DataFrame, start: Root) -> tuple[DataFrame, Root]:
    """``w, c, k, t``: the vocabulary with the customers ``k`` that the restaurants'
    tables (``seats``: ``w, k``) make, and their resampled tables ``t``."""
    vocab = (vocab.join(seats.groupBy("w").agg(F.sum("k").alias("k")), "w")
             .withColumn("t", F.lit(1).cast("long")))
    base, tables = 1 / (start.types + 1), float(start.types)
    for sweep in range(ROOT_SWEEPS):
        # written, as the next sweep starts from these tables
        vocab = materialize(vocab.mapInArrow(_root_sweep(tables, base, sweep, ROOT_DISCOUNT, ROOT_STRENGTH),
                                             "w long, c long, k long, t long"), "root")
        n = vocab.agg(F.sum("t").alias("t"), F.sum("k").alias("k")).first()
        tables = float(n["t"] or 0)
    return vocab, Root(start.train_tokens, start.types, start.texts, float(n["k"] or 0), tables)


@dataclass(frozen=True)
class Head:
    """The commonest words, numbered by falling count: hash, count, customers as a
    context, and probability in the unigram restaurant by number; and the
    numbers by sorted hash."""
    w: np.ndarray
    c: np.ndarray
    m: np.ndarray
    p: np.ndarray
    hashes: np.ndarray
    number: np.ndarray

    def find(self, w: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those outside (sorted search)."""
        ids, back = np.unique(w, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, ids), len(self.w) - 1)
        return np.where(self.hashes[at] == ids, self.number[at], -1)[back]


def _head(vocab: DataFrame, head_words: int, root: Root) -> Head:
    """The commonest words, at most ``head_words``: all above a count that a
    histogram of the counts (a few hundred steps) gives; and the start of a text,
    whose restaurant has a customer for each document, whatever the vocabulary."""
    step = F.floor(F.log2(F.greatest("c", F.lit(1))) * 16)
    least, n = None, 0
    for r in vocab.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        n += r["n"]
        if n > head_words:
            break
        least = r["step"]
    rows = vocab.filter(F.lit(False) if least is None else step >= least).toArrow()
    w, c = rows.column("w").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    order = np.lexsort((w, -c))
    w, c = np.concatenate([w[order], [START]]), np.concatenate([c[order], [0]])
    # every word but the end of a text has one word after it
    m = np.where(w == END, 0, np.where(w == START, root.texts, c))
    by_hash = np.argsort(w)
    return Head(w, c, m, root.p(c, np.minimum(c, 1)), w[by_hash], by_hash.astype(np.int32))


def _with_root(head: Head, vocab: DataFrame, root: Root) -> Head:
    """The head with the probabilities of the sampled unigram restaurant."""
    least = int(head.c[:-1].min()) if len(head.w) > 1 else None
    rows = vocab.filter(F.lit(False) if least is None else F.col("c") >= least).toArrow()
    at = head.find(rows.column("w").to_numpy().view(np.uint64))
    p = np.full(len(head.w), root.unknown)
    p[at] = root.p(rows.column("k").to_numpy(), rows.column("t").to_numpy())
    return replace(head, p=p)


def _restaurants(head: Head, u: np.ndarray, w: np.ndarray, n: np.ndarray):
    """Number of each word in the head, and the key of its restaurant, or of the
    part of a hot one; ``n`` are the words of each text."""
    at = head.find(w)
    before = np.concatenate([[0], at[:-1]])
    before[np.cumsum(n) - n] = head.find(np.array([START]))[0]
    parts = np.where(before >= 0, -(-head.m[np.maximum(before, 0)] // HOT), 1)
    hot = np.flatnonzero(parts > 1)
    r = u.copy()
    r[hot] = mix(u[hot] + mix(w[hot]) % parts[hot].astype(np.uint64) + np.uint64(1))
    return at, r


def _dealt(r: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each restaurant, and its bucket, which rises with the hash's upper bits."""
    h = mix(r)
    return h, (((h >> np.uint64(20)) * np.uint64(buckets)) >> np.uint64(44)).astype(np.int64)


def _sorting(h: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sort key by bucket, restaurant and word. Restaurants that share the upper bits
    may lie mixed, which makes more runs of them and nothing else."""
    return h & ~np.uint64(0xFFFFF) | number.astype(np.uint64) & np.uint64(0xFFFFF)


def _hot_sizes(head: Head) -> dict[int, int]:
    """Customers of the whole restaurant, by the key of each part."""
    out = {}
    for i in np.flatnonzero(head.m > HOT):
        for part in range(int(-(-head.m[i] // HOT))):
            out[int(mix(head.w[i:i + 1] + np.uint64(part + 1))[0])] = int(head.m[i])
    return out


_PAIR_SQL = ("bucket int, r array<long>, n array<int>, low array<smallint>, high array<tinyint>, count array<int>, "
             "rr array<long>, rw array<long>, rcount array<int>")
_SEAT_SQL = "bucket int, number array<int>, t array<int>, w array<long>, k array<int>"
_BLOB_SQL = ("bucket int, dk array<long>, train array<boolean>, r array<long>, n array<int>, low array<smallint>, "
             "high array<tinyint>, doc array<smallint>, rr array<long>, rw array<long>, rdoc array<smallint>, "
             "sdk array<long>, stokens array<long>, sknown array<long>, sbase array<double>")
_PART_SQL = "shard int, dk array<long>, copies array<long>, n_tokens array<long>, n_known array<long>, base array<double>, score array<double>"


def _names(sql: str) -> list[str]:
    return [x.split()[0] for x in sql.split(", ")]


def _lists(values, cuts, kind):
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _halves(number: np.ndarray, cuts) -> list:
    """Numbers of the head as lists of two bytes and of one, which is seldom not 0."""
    return [_lists((number & 0xFFFF).astype(np.uint16).view(np.int16), cuts, pa.int16()),
            _lists((number >> 16).astype(np.int8), cuts, pa.int8())]


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.int16).view(np.uint16).astype(np.int64) + (high.astype(np.int64) << 16)


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys starts."""
    new = np.zeros(len(sorted_keys[0]), dtype=bool)
    new[:1] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _distinct(x: np.ndarray, below: int) -> np.ndarray:
    """Distinct numbers of ``x``, in order; by marks where they are many."""
    if len(x) * 8 < below:
        return np.unique(x)
    seen = np.zeros(below, dtype=bool)
    seen[x] = True
    return np.flatnonzero(seen)


def _cuts(bucket: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each of the buckets ``ids`` starts in a sorted column, and its end."""
    return np.concatenate([np.searchsorted(bucket, ids), [len(bucket)]])


def _runs(r: np.ndarray, cuts: np.ndarray) -> list:
    """Restaurants and their sizes, as lists by bucket."""
    new = _starts(r)
    size = np.diff(np.concatenate([new, [len(r)]]))
    rcuts = np.searchsorted(new, cuts)
    return [_lists(r[new].view(np.int64), rcuts, pa.int64()), _lists(size.astype(np.int32), rcuts, pa.int32())]


def _pair_counts(shared, buckets: int, chunk_words: int):
    """The (context, word) of training texts and how often a stretch has each, by
    bucket of their restaurant; words outside the head by hash, and those of other
    texts too (0 times), so that the bucket gets their counts."""
    def run(batches):
        head = shared.value
        for rows in _chunks(batches, chunk_words):
            u, w, n = _pairs(rows)
            train = np.repeat(np.array([x[1] for x in rows]), n)
            at, r = _restaurants(head, u, w, n)
            del u
            h, bucket = _dealt(r, buckets)
            known = np.flatnonzero(train & (at >= 0))
            known = known[np.argsort(_sorting(h[known], at[known]))]
            rare = np.flatnonzero(at < 0)
            rare = rare[np.lexsort((w[rare], h[rare]))]
            found = []
            for k, word in ((known, at), (rare, w)):
                b, room, word = bucket[k], r[k], word[k]
                new = _starts(room, word)
                count = np.add.reduceat(train[k], new, dtype=np.int32) if len(k) else np.empty(0, np.int32)
                found.append((b[new], room[new], word[new], count))
            (b, r, word, n), (rb, rr, rw, rn) = found
            ids = np.union1d(b, rb)
            cuts, rcuts = _cuts(b, ids), _cuts(rb, ids)
            out = pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int32()), *_runs(r, cuts), *_halves(word, cuts), _lists(n, cuts, pa.int32()),
                _lists(rr.view(np.int64), rcuts, pa.int64()), _lists(rw.view(np.int64), rcuts, pa.int64()),
                _lists(rn, rcuts, pa.int32())], names=_names(_PAIR_SQL))
            yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))
    return run


def _common(shared, root: Root, buckets: int, chunk_words: int):
    """The words, by bucket of their restaurant, and each document's counts and
    base score as far as the head goes."""
    def run(batches):
        head = shared.value
        for rows in _chunks(batches, chunk_words):
            u, w, n = _pairs(rows)
            at, r = _restaurants(head, u, w, n)
            del u
            doc = np.repeat(np.arange(len(rows)), n)
            known = at >= 0
            base = np.bincount(doc[known], weights=root.base(head.c[at[known]]), minlength=len(rows))
            found = np.bincount(doc[known], minlength=len(rows))
            key, bucket = _dealt(r, buckets)
            rare = np.flatnonzero(~known)
            rare = rare[np.argsort(bucket[rare], kind="stable")]
            rr, rw, rdoc, rbucket = r[rare], w[rare], doc[rare], bucket[rare]
            del w
            order = np.flatnonzero(known)
            order = order[np.argsort(_sorting(key[order], at[order]))]
            del key
            r, at, doc, bucket = r[order], at[order], doc[order], bucket[order]
            dks = np.array([x[0] for x in rows], dtype=np.int64)
            train = np.array([x[1] for x in rows])
            # a document's sums travel with one bucket
            home = (mix(dks.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            h = np.argsort(home, kind="stable")
            ids = np.unique(np.concatenate([bucket, rbucket, home]))
            cuts, rcuts, hcuts = _cuts(bucket, ids), _cuts(rbucket, ids), _cuts(home[h], ids)
            used_l, dcuts, local, rlocal = [], [0], np.empty(len(doc), np.int16), np.empty(len(rdoc), np.int16)
            place = np.empty(len(rows), np.int16)
            for i in range(len(ids)):
                here, rhere = slice(cuts[i], cuts[i + 1]), slice(rcuts[i], rcuts[i + 1])
                used = _distinct(np.concatenate([doc[here], rdoc[rhere]]), len(rows))
                place[used] = np.arange(len(used))
                local[here], rlocal[rhere] = place[doc[here]], place[rdoc[rhere]]
                used_l.append(used)
                dcuts.append(dcuts[-1] + len(used))
            used = np.concatenate(used_l)
            i64 = pa.int64()
            out = pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int32()), _lists(dks[used], dcuts, i64), _lists(train[used], dcuts, pa.bool_()),
                *_runs(r, cuts), *_halves(at, cuts), _lists(local, cuts, pa.int16()),
                _lists(rr.view(np.int64), rcuts, i64), _lists(rw.view(np.int64), rcuts, i64), _lists(rlocal, rcuts, pa.int16()),
                _lists(dks[h], hcuts, i64), _lists(n[h], hcuts, i64), _lists(found[h], hcuts, i64),
                _lists(base[h], hcuts, pa.float64())], names=_names(_BLOB_SQL))
            yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))
    return run


def _sweeps(rest: np.ndarray, count: np.ndarray, p: np.ndarray, key: np.ndarray, whole: np.ndarray,
            sweeps: int, salt: int = 0):
    """The tables of each (restaurant, dish) after each sweep, and those of the
    whole restaurants."""
    size = np.bincount(rest, weights=count, minlength=len(whole))
    scale = np.where(size > 0, whole / np.maximum(size, 1), 1.0)
    t = np.minimum(count, 1).astype(np.float64)
    many = np.flatnonzero(count > 1)        # one customer always has one table
    for sweep in range(sweeps):
        tables = np.bincount(rest, weights=t, minlength=len(whole)) * scale
        if len(many):
            t[many] = sample_tables(count[many], tables[rest[many]] - t[many], p[many], DISCOUNT, STRENGTH,
                                    uniform(key[many], salt + sweep))
        yield t, np.bincount(rest, weights=t, minlength=len(whole)) * scale


def sample_restaurants(rest: np.ndarray, count: np.ndarray, p: np.ndarray, key: np.ndarray,
                       whole: np.ndarray) -> np.ndarray:
    """Averaged predictive probability of each (restaurant, dish): ``rest``
    numbers the restaurants from 0 in order, ``count`` are training customers,
    ``p`` the parent's probabilities, ``whole`` the customers of the restaurant
    (more than its counts give where this is a part of a hot one)."""
    total = np.zeros(len(rest))
    for sweep, (t, tables) in enumerate(_sweeps(rest, count, p, key, whole, BURN_IN + SAMPLES)):
        if sweep >= BURN_IN:
            total += (count - DISCOUNT * t + (STRENGTH + DISCOUNT * tables[rest]) * p) / (STRENGTH + whole[rest])
    return total / SAMPLES


def _flat(col: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten()) for c in col.chunks] or [np.empty(0, np.int64)])


def _dishes(r: np.ndarray, word: np.ndarray, weights: np.ndarray, words: int, hot: dict):
    """Restaurants, and of each (restaurant, word): number of the restaurant, word,
    customers; customers of the whole restaurants; and the place of each entry."""
    rooms, rest = np.unique(r, return_inverse=True)
    types, of = np.unique(rest * np.int64(words) + word, return_inverse=True)
    count = np.bincount(of, weights=weights, minlength=len(types))
    rest, word = types // words, types % words
    whole = np.bincount(rest, weights=count, minlength=len(rooms))
    if hot:
        whole = np.array([hot.get(x, y) for x, y in zip(rooms.tolist(), whole.tolist())])
    return rooms, rest, word, count, whole, of


def _seat(shared, hot_shared, rare_p: float):
    """The tables of a bucket's restaurants, summed up by word: by number for the
    head, by hash for the others."""
    def run(pairs: pa.Table) -> pa.Table:
        head, hot = shared.value, hot_shared.value
        bucket = pairs.column("bucket")[0].as_py()
        rw, rback = np.unique(_flat(pairs.column("rw")).astype(np.int64), return_inverse=True)
        r = np.concatenate([np.repeat(_flat(pairs.column("r")).astype(np.int64), _flat(pairs.column("n")).astype(np.int64)),
                            _flat(pairs.column("rr")).astype(np.int64)]).view(np.uint64)
        word = np.concatenate([_whole(_flat(pairs.column("low")), _flat(pairs.column("high"))), rback + len(head.w)])
        n = np.concatenate([_flat(pairs.column("count")), _flat(pairs.column("rcount"))])
        words = len(head.w) + len(rw)
        rooms, rest, word, count, whole, _ = _dishes(r, word, n, words, hot)
        del r, n
        key = mix(rooms[rest]) + np.concatenate([head.w, rw.view(np.uint64)])[word]
        p = np.concatenate([head.p, np.full(len(rw), rare_p)])[word]
        for t, _ in _sweeps(rest, count, p, key, whole, BURN_IN, 50):
            pass
        k = np.rint(np.bincount(word, weights=t, minlength=words)).astype(np.int64)
        number = np.flatnonzero(k[:len(head.w)])
        lists = ((number, pa.int32()), (k[number], pa.int32()), (rw, pa.int64()), (k[len(head.w):], pa.int32()))
        return pa.Table.from_arrays([pa.array([bucket], pa.int32()), *(_lists(x, [0, len(x)], kind) for x, kind in lists)],
                                    names=_names(_SEAT_SQL))
    return run


def _tables(shared):
    """The restaurants' tables by word, summed up over a task's buckets."""
    def run(batches):
        head = shared.value
        sums = np.zeros(len(head.w), np.int64)
        for b in batches:
            np.add.at(sums, np.asarray(b.column("number").flatten()), np.asarray(b.column("t").flatten()))
            w, k = np.asarray(b.column("w").flatten()), np.asarray(b.column("k").flatten()).astype(np.int64)
            w, k = w[k > 0], k[k > 0]
            for lo in range(0, len(w), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000]) for x in (w, k)], names=["w", "k"])
        at = np.flatnonzero(sums)
        for lo in range(0, len(at), 100_000):
            part = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(head.w[part].view(np.int64)), pa.array(sums[part])], names=["w", "k"])
    return run


def _score_bucket(shared, root: Root, hot_shared, shards: int):
    def run(common: pa.Table, rare: pa.Table) -> pa.Table:
        head, hot = shared.value, hot_shared.value
        lens = lambda c: np.concatenate([np.asarray(x.value_lengths()) for x in common.column(c).chunks] or [np.empty(0, int)])
        docs_in = lens("dk")
        skip = np.cumsum(docs_in) - docs_in
        dk, train = _flat(common.column("dk")).astype(np.int64), _flat(common.column("train")).astype(bool)
        # the rare words continue the numbering of the head; those without counts
        # were not trained on
        rw = _flat(common.column("rw")).astype(np.int64)
        rdoc = _flat(common.column("rdoc")).astype(np.int64) + np.repeat(skip, lens("rw"))
        ids, rback = np.unique(rw, return_inverse=True)
        given = rare.column("w").to_numpy()
        order = np.argsort(given)
        at = np.minimum(np.searchsorted(given[order], ids), max(len(given) - 1, 0))
        c, p = np.zeros(len(ids), np.int64), np.full(len(ids), root.unknown)
        if len(given):
            met = given[order][at] == ids
            row = order[at[met]]
            c[met] = rare.column("c").to_numpy()[row]
            p[met] = root.p(rare.column("k").to_numpy()[row], rare.column("t").to_numpy()[row])
        word = np.concatenate([_whole(_flat(common.column("low")), _flat(common.column("high"))), rback + len(head.w)])
        r = np.concatenate([np.repeat(_flat(common.column("r")).astype(np.int64), _flat(common.column("n")).astype(np.int64)),
                            _flat(common.column("rr")).astype(np.int64)]).view(np.uint64)
        doc = np.concatenate([_flat(common.column("doc")).astype(np.int64) + np.repeat(skip, lens("doc")), rdoc])
        if len(r):
            rooms, rest, word, count, whole, of = _dishes(r, word, train[doc], len(head.w) + len(ids), hot)
            del r
            key = mix(rooms[rest]) + np.concatenate([head.w, ids.view(np.uint64)])[word]
            q = sample_restaurants(rest, count, np.concatenate([head.p, p])[word], key, whole)
            score = np.bincount(doc, weights=np.log10(q)[of], minlength=len(dk))
        else:
            score = np.zeros(len(dk))
        # rare words' share of counts and base scores
        rk = np.bincount(rdoc, weights=c[rback] > 0, minlength=len(dk)).astype(np.int64)
        rb = np.bincount(rdoc, weights=root.base(c)[rback], minlength=len(dk))
        sdk = _flat(common.column("sdk")).astype(np.int64)
        z, zi = np.zeros, np.int64
        a, b = len(dk), len(sdk)
        cols = [np.concatenate([dk, sdk]), np.concatenate([z(a, zi), np.ones(b, zi)]),
                np.concatenate([z(a, zi), _flat(common.column("stokens"))]),
                np.concatenate([rk, _flat(common.column("sknown"))]),
                np.concatenate([rb, _flat(common.column("sbase"))]), np.concatenate([score, z(b)])]
        return _by_shard(cols, shards)
    return run


def _by_shard(cols: list, shards: int) -> pa.Table:
    """Sums per document, gathered into one row per shard."""
    dk, back = np.unique(cols[0], return_inverse=True)
    sums = [np.bincount(back, weights=c, minlength=len(dk)) for c in cols[1:]]
    shard = (mix(dk.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ids = np.unique(shard)
    cuts = np.concatenate([np.searchsorted(shard[order], ids), [len(order)]])
    kinds = [pa.int64()] * 3 + [pa.float64()] * 2
    return pa.Table.from_arrays(
        [pa.array(ids, pa.int32()), _lists(dk[order], cuts, pa.int64()),
         *(_lists(np.rint(s[order]).astype(np.int64) if k == pa.int64() else s[order], cuts, k) for s, k in zip(sums, kinds))],
        names=_names(_PART_SQL))


def _sum_shard(table: pa.Table) -> pa.Table:
    names = _names(_PART_SQL)[1:]
    dk, back = np.unique(_flat(table.column("dk")), return_inverse=True)
    sums = [np.bincount(back, weights=_flat(table.column(n)), minlength=len(dk)) for n in names[1:]]
    # rows that repeat id and text were added up under one key
    copies = np.maximum(sums[0], 1)
    return pa.Table.from_arrays(
        [pa.array(dk.astype(np.int64)), *(pa.array(np.rint(s / copies).astype(np.int64)) for s in sums[1:3]),
         *(pa.array(s / copies) for s in sums[3:])], names=["dk", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          buckets: int | None = None, chunk_words: int = CHUNK_WORDS, head_words: int = HEAD) -> DataFrame:
    """Per row: ``doc_id, train, n_tokens, n_known`` (words seen in training),
    ``train_tokens, base_score, score, perplexity``. ``train`` is a condition on
    ``doc_id``; by default all rows are trained on."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    src = (keyed(docs, id_col, text_col).withColumn("train", F.coalesce(F.lit(True) if train is None else train, F.lit(False)))
           .withColumn("dk", F.xxhash64("rid", "rhash")))
    texts = src.select("dk", "train", "text")
    buckets = buckets or bucket_count(src)
    vocab, start = _vocabulary(texts, chunk_words)
    head = _head(vocab, head_words, start)
    first, hot = sc.broadcast(head), sc.broadcast(_hot_sizes(head))
    others = max(start.types - (len(head.w) - 1), 1)
    rare_p = float(start.p((start.train_tokens - head.c.sum()) / others, 1.0))
    seats = materialize(texts.mapInArrow(_pair_counts(first, buckets, chunk_words), _PAIR_SQL)
                        .groupBy("bucket").applyInArrow(_seat(first, hot, rare_p), _SEAT_SQL), "tables")
    vocab, root = _sample_root(vocab, seats.mapInArrow(_tables(first), "w long, k long"), start)
    shared = sc.broadcast(_with_root(head, vocab, root))
    rare = (seats.select("bucket", F.explode("w").alias("w")).join(vocab, "w")
            .select("bucket", "w", *[F.col(x).cast("int").alias(x) for x in ("c", "k", "t")]))
    common = texts.mapInArrow(_common(shared, root, buckets, chunk_words), _BLOB_SQL)
    parts = common.groupBy("bucket").cogroup(rare.groupBy("bucket")).applyInArrow(
        _score_bucket(shared, root, hot, buckets), _PART_SQL)
    sums = parts.groupBy("shard").applyInArrow(
        _sum_shard, "dk long, n_tokens long, n_known long, base_score double, score double")
    return (src.select("doc_id", "train", "dk").join(sums, "dk").select(
        "doc_id", "train", "n_tokens", "n_known", F.lit(root.train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")))
