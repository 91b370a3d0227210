"""Toxicity by class-conditional Kneser-Ney bigram models.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary training
texts, give each word of a text a log-likelihood ratio. Compared are
length-normalised sums: over the whole text, over its best short window, and of
what the ratios have over 1, as a few words make a long text toxic. Both classes
back off to the same distribution, the continuation counts of the pooled sample
(and from there to a uniform one), so a word that a class never saw is judged
by shared evidence and unknown words are neutral. The sample has two halves, each
with models of its own; a logistic, fitted on the texts of each half by the models
of the other, turns these sums into a probability. A text's sums are the means of
those by both halves' models, as the logistic holds for models of a half: those
of the whole sample trust its rare words more, and reject ordinary texts.

The models are learned from a bounded sample of the labelled rows: at most
``docs_per_class`` texts and about ``words_per_class`` words of each class, taken
in the order of a hash. So the model, which every task gets, is bounded. Pairs,
continuations and contexts of the sample are counted by Spark aggregates and
the back-off values are joined to them there; the driver fetches the finished
values and the features of the sample's texts, which tasks compute. One text
adds at most 1 / ``LEAST_TEXTS`` of a class's words, in ``PIECES`` pieces spread
evenly over it, so a few very long texts cannot become a class's sample. Words
are counted as they are told apart. The halves that the logistic is fitted on
take turns in the order of the sample, so neither lacks a class of two texts.

Defined cases: null and empty texts have ratio 0; several labels for one id
count by their mean (0.5 and over: 1), null labels are left out; with labels of
fewer than two classes the score is the smoothed share of the class; repeated
rows are scored each; ties in the sample order go by id and text; very long
texts are scored whole; columns other than id, text and label are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, documents, keyed, materialize, mix, short_batches
from aidspark.llm.qda import labels_by_id

DOCS_PER_CLASS = 6_000
WORDS_PER_CLASS = 3_000_000
#: A class's sample holds at least so many texts, if there are so many.
LEAST_TEXTS = 100
PIECES = 8
#: Taken off every count, so that n-grams seen up to so many times fall back on
#: the shared counts.
DISCOUNT = 3.0
#: Words of the short windows.
SPAN = 5
FEATURES = ("pair_mean", "pair_excess", "word_excess", "span_max", "word_max")
_WORD = re.compile(r"[^\W_]+")
_SPARK_WORD = r"[\p{L}\p{N}]+"  # the same for Spark
_START = np.uint64(1)


def tokens(text: str, hashes: TokenHash) -> np.ndarray:
    return hashes.of(_WORD.findall(text.lower()))


class TokenHash(WordHash):
    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        import xxhash
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * np.uint64(0x9E3779B97F4A7C15) + w)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float):
    """Values at ``wanted`` (sorted search over its distinct keys)."""
    if not len(keys) or not len(wanted):
        return np.full(len(wanted), default), np.zeros(len(wanted), dtype=bool)
    q, back = np.unique(wanted, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    hit = keys[at] == q
    return np.where(hit, values[at], default)[back], hit[back]


@dataclass(frozen=True)
class Ratio:
    """log P_toxic - log P_ordinary: of ``pairs`` that either class has more often
    than the discount takes off, else the sum of the context's and the word's
    share of the back-off."""
    pairs: np.ndarray
    pair_value: np.ndarray
    words: np.ndarray
    word_value: np.ndarray
    contexts: np.ndarray
    context_value: np.ndarray

    def features(self, toks: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """``FEATURES`` of each text; ``toks`` are the texts' words one after the
        other, ``cuts`` their ends."""
        out = np.zeros((len(cuts), len(FEATURES)))
        cuts = np.asarray(cuts, dtype=np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), cuts[:-1]])
        some = np.flatnonzero(cuts > starts)
        if not len(some):
            return out
        starts, cuts = starts[some], cuts[some]
        n = cuts - starts
        before = np.concatenate([[_START], toks[:-1]])
        before[starts] = _START
        word = _lookup(self.words, self.word_value, toks, 0.0)[0]
        pair, hit = _lookup(self.pairs, self.pair_value, _pair(before, toks), 0.0)
        rest = ~hit
        pair[rest] = word[rest] + _lookup(self.contexts, self.context_value, before[rest], 0.0)[0]
        total = lambda v: np.add.reduceat(v, starts) / n
        # sums of windows that end at each word and do not reach into another text
        run = np.concatenate([[0.0], np.cumsum(word)])
        at = np.arange(len(word))
        first = np.maximum(at - (SPAN - 1), np.repeat(starts, n))
        span = (run[at + 1] - run[first]) / SPAN
        out[some] = np.stack([total(pair), np.sqrt(total(np.maximum(pair - 1, 0))),
                              np.sqrt(total(np.maximum(word - 1, 0))),
                              np.maximum.reduceat(span, starts), np.maximum.reduceat(word, starts)], 1)
        return out


def _sums(keys: np.ndarray, values: np.ndarray):
    u, back = np.unique(keys, return_inverse=True)
    return u, np.bincount(back, weights=values, minlength=len(u))


def kneser_ney_ratio(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], d: float = DISCOUNT) -> Ratio:
    """The ratio from (context, word, count) arrays of the ordinary and the toxic
    class: what ``fit_ratio`` gives, for counts that one process holds."""
    both_u, both_w = (np.concatenate([c[i] for c in counts]) for i in (0, 1))
    pairs, first = np.unique(_pair(both_u, both_w), return_index=True)
    # shared continuation counts: contexts that precede each word, in either class
    words, cont = _sums(both_w[first], np.ones(len(first)))
    n = max(1.0, cont.sum())
    off = np.minimum(cont, d)
    shared = (cont - off) / n + off.sum() / n / (len(words) + 1)
    contexts = np.unique(both_u)
    wi = np.searchsorted(words, both_w[first]).astype(np.int32)
    ui = np.searchsorted(contexts, both_u[first]).astype(np.int32)
    del both_u, both_w, first
    log_uni, log_gamma, log_pair = [], [], []
    for u, w, c in counts:
        # class unigram: own continuation counts over the shared distribution
        own, k = _sums(w, np.ones(len(w)))
        total = max(1.0, k.sum())
        off = np.minimum(k, d)
        uni = shared * (off.sum() / total if len(own) else 1.0)
        uni[np.searchsorted(words, own)] += (k - off) / total
        cu, mass = _sums(u, c.astype(float))
        _, freed = _sums(u, np.minimum(c, d))
        gamma, size = np.ones(len(contexts)), np.ones(len(contexts))
        gamma[np.searchsorted(contexts, cu)] = freed / mass
        size[np.searchsorted(contexts, cu)] = mass
        own_pairs = _pair(u, w)
        order = np.argsort(own_pairs)
        got = _lookup(own_pairs[order], c[order].astype(float), pairs, 0.0)[0]
        log_pair.append(np.log(1e-12 + np.maximum(got - d, 0) / size[ui] + gamma[ui] * uni[wi]))
        log_uni.append(np.log(uni))
        log_gamma.append(np.log(gamma))
    f = lambda x: (x[1] - x[0]).astype(np.float32)
    return Ratio(pairs, f(log_pair), words, f(log_uni), contexts, f(log_gamma))


def _pair_counts(batches):
    """(pair, context, word, part, count) of the sample's texts; the part is twice
    the class and the fold."""
    for batch in batches:
        part = 2 * batch.column("y").to_numpy() + batch.column("fold").to_numpy()
        toks = [np.frombuffer(w.as_py(), np.uint64) for w in batch.column("words")]
        for p in np.unique(part):
            own = [t for t, q in zip(toks, part) if q == p and len(t)]
            if not own:
                continue
            u, w = np.concatenate([np.concatenate([[_START], t[:-1]]) for t in own]), np.concatenate(own)
            key, at, n = np.unique(_pair(u, w), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (key, u[at], w[at])] + [pa.array(np.full(len(key), p, np.int32)), pa.array(n.astype(np.int64))],
                names=["pair", "u", "w", "part", "n"])


def count_pairs(hashed: DataFrame) -> DataFrame:
    """``pair, u, w`` and the counts ``n0`` to ``n3`` in each part, of all pairs of
    the sample."""
    rows = hashed.mapInArrow(_pair_counts, "pair long, u long, w long, part int, n long")
    return materialize(rows.groupBy("pair").agg(
        F.first("u").alias("u"), F.first("w").alias("w"),
        *[F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"n{p}") for p in range(4)]), "pairs")


def _fetch(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in unsigned order and their values."""
    got = df.toArrow()
    key = got.column(0).to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], got.column(1).to_numpy()[order].astype(np.float32)


def fit_ratio(pairs: DataFrame, folds: tuple[int, ...], d: float = DISCOUNT) -> Ratio:
    """The ratio of two interpolated Kneser-Ney models learned from these folds of
    the counted pairs. Every table is bounded by the sample's words."""
    least = lambda c: F.least(F.col(c).cast("double"), F.lit(d))
    t = pairs.select("pair", "u", "w", *[sum((F.col(f"n{2 * y + f}") for f in folds[1:]), F.col(f"n{2 * y + folds[0]}")).alias(f"c{y}")
                                         for y in (0, 1)]).filter("c0 + c1 > 0")
    # shared continuation counts: contexts that precede each word, in either class; own ones
    words = materialize(t.groupBy("w").agg(F.count("*").alias("cont"), *[F.count_if(F.col(f"c{y}") > 0).alias(f"k{y}") for y in (0, 1)]),
                        "words")
    s = words.agg(F.count("*").alias("kinds"), *[f(c).alias(f"{name}_{c}") for c in ("cont", "k0", "k1")
                                                 for name, f in (("sum", F.sum), ("off", lambda c: F.sum(least(c))))]).first()
    n = max(1.0, float(s["sum_cont"] or 0))
    shared = (F.col("cont") - least("cont")) / n + (s["off_cont"] or 0.0) / n / (s["kinds"] + 1)
    uni = []
    for y in (0, 1):
        total = max(1.0, float(s[f"sum_k{y}"] or 0))
        kept = (s[f"off_k{y}"] / total) if s[f"sum_k{y}"] else 1.0
        uni.append(shared * kept + (F.col(f"k{y}") - least(f"k{y}")) / total)
    words = words.select("w", uni[0].alias("p0"), uni[1].alias("p1"))
    contexts = materialize(t.groupBy("u").agg(*[x for y in (0, 1) for x in (F.sum(f"c{y}").alias(f"m{y}"), F.sum(least(f"c{y}")).alias(f"f{y}"))])
                           .select("u", *[x for y in (0, 1) for x in (
                               F.greatest(F.col(f"m{y}"), F.lit(1)).alias(f"size{y}"),
                               F.when(F.col(f"m{y}") > 0, F.col(f"f{y}") / F.col(f"m{y}")).otherwise(1.0).alias(f"gamma{y}"))]), "contexts")
    p = [F.greatest(F.col(f"c{y}") - d, F.lit(0.0)) / F.col(f"size{y}") + F.col(f"gamma{y}") * F.col(f"p{y}") for y in (0, 1)]
    # a pair of which the discount takes all in both classes has just what its word and its context give
    kept = t.filter((F.col("c0") > d) | (F.col("c1") > d))
    return Ratio(*_fetch(kept.join(words, "w").join(contexts, "u").select("pair", (F.log(p[1]) - F.log(p[0])).cast("float"))),
                 *_fetch(words.select("w", (F.log("p1") - F.log("p0")).cast("float"))),
                 *_fetch(contexts.select("u", (F.log("gamma1") - F.log("gamma0")).cast("float"))))


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column | None,
            docs_per_class: int, words_per_class: int) -> tuple[DataFrame, list[int]]:
    """The rows of ``sample`` with their whole texts."""
    rows = docs if train is None else docs.filter(train)
    known = rows.select("doc_id", "rid", "rhash").join(labels_by_id(labels, label_col), "doc_id")
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("rid", "rhash"), "rid", "rhash"]
    tops = [known.filter(F.col("y") == y).dropDuplicates(["rid", "rhash"]).orderBy(*order).limit(docs_per_class)
            .select("rid", "rhash", "y") for y in (0, 1)]
    cap = text_words(words_per_class)
    sized = (docs.join(F.broadcast(tops[0].union(tops[1])), ["rid", "rhash"])  # at most 2 * docs_per_class rows of three numbers
             .dropDuplicates(["rid", "rhash"])
             .select("rid", "rhash", "y", F.least(F.regexp_count("text", F.lit(_SPARK_WORD)), F.lit(cap)).alias("words")))
    each = Window.partitionBy("y").orderBy(*order)  # over at most docs_per_class rows
    chosen = (sized.withColumns({"before": F.sum("words").over(each.rowsBetween(Window.unboundedPreceding, -1)),
                                 "fold": F.pmod(F.row_number().over(each), F.lit(2)).cast("int")})
              .filter(F.coalesce("before", F.lit(0)) < words_per_class).select("rid", "rhash", "y", "fold"))
    return (docs.join(F.broadcast(chosen), ["rid", "rhash"]).dropDuplicates(["rid", "rhash"])
            .select("y", "fold", "text"), [n.get(0, 0), n.get(1, 0)])


def sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column | None,
           docs_per_class: int, words_per_class: int) -> tuple[DataFrame, list[int]]:
    """The bounded training sample (``y, fold, text``) and the numbers of all
    training rows of each class."""
    rows, n = _sample(docs, labels, label_col, train, docs_per_class, words_per_class)
    return rows.withColumn("text", _spread(text_words(words_per_class))("text")), n


def text_words(words_per_class: int) -> int:
    """Words that one text may add to a class's sample."""
    return max(PIECES, words_per_class // LEAST_TEXTS)


def spread(text: str, cap: int) -> str:
    """A text of more than ``cap`` words as ``PIECES`` pieces of it, evenly apart."""
    spans = [m.span() for m in _WORD.finditer(text)] if len(text) > cap else []
    if len(spans) <= cap:
        return text
    size = cap // PIECES
    starts = [(len(spans) - size) * i // (PIECES - 1) for i in range(PIECES)]
    return "\n".join(text[spans[a][0]:spans[a + size - 1][1]] for a in starts)


def _spread(cap: int):
    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: spread(t, cap))
    return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Slopes and intercept (last) by Newton's method, slopes held by a ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    hold = ridge * np.diag([1.0] * x.shape[1] + [1e-6])
    beta = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (weight * (y - p)) - hold @ beta
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + hold, grad)
        beta = beta + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass(frozen=True)
class Model:
    ratio: Ratio | None  # of one half of the sample
    other: Ratio | None  # of the other half
    beta: np.ndarray    # of the standardised features, intercept last
    centre: np.ndarray
    scale: np.ndarray

    def features(self, toks: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Means of the features by both halves' models."""
        if self.ratio is None:
            return np.zeros((len(cuts), len(FEATURES)))
        return (self.ratio.features(toks, cuts) + self.other.features(toks, cuts)) / 2

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.centre) / self.scale @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _hashed(cap: int):
    """The words of each text's part in the sample. Pieces are cut here too: a second
    Python step in the stage would hold a second worker for every task."""
    def run(batches):
        hashes = TokenHash()
        for batch in batches:
            words = [tokens(spread(t, cap), hashes).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("fold"), pa.array(words, pa.binary())],
                                             names=["y", "fold", "words"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str, train: Column | None = None,
        docs_per_class: int = DOCS_PER_CLASS, words_per_class: int = WORDS_PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    chosen, n = _sample(keyed(docs, id_col, text_col), labels, label_col, train, docs_per_class, words_per_class)
    if min(n) == 0:
        k = len(FEATURES)
        return Model(None, None, np.array([0.0] * k + [np.log((n[1] + 1) / (n[0] + 1))]), np.zeros(k), np.ones(k))
    hashed = materialize(chosen.mapInArrow(_hashed(text_words(words_per_class)), "y int, fold int, words binary"), "toxic-sample")
    pairs = count_pairs(hashed)
    halves = [fit_ratio(pairs, (fold,)) for fold in (0, 1)]
    # a few numbers of each of at most 2 * docs_per_class texts
    rows = [r for fold in (0, 1) for r in _features(hashed.filter(F.col("fold") == fold), halves[1 - fold])]
    ys, x = np.array([r["y"] for r in rows], dtype=int), np.array([r["x"] for r in rows])
    share = np.array([n[k] / max(1, (ys == k).sum()) for k in (0, 1)])
    weight = share[ys] * len(ys) / share[ys].sum()
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    beta = _logistic((x - centre) / scale, ys.astype(float), weight)
    return Model(*halves, beta, centre, scale)


def _features(hashed: DataFrame, ratio: Ratio) -> list:
    """``y, x`` of the sample's texts."""
    shared = hashed.sparkSession.sparkContext.broadcast(ratio)  # bounded by words_per_class

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):  # few words at once
                few = batch.slice(at, 128)
                toks = [np.frombuffer(w.as_py(), np.uint64) for w in few.column("words")]
                x = shared.value.features(np.concatenate([np.empty(0, np.uint64), *toks]), np.cumsum([len(t) for t in toks]))
                yield pa.RecordBatch.from_arrays([few.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    found = hashed.select("y", "words").mapInArrow(run, "y int, x array<double>").collect()
    shared.destroy()
    return found


def _score_texts(model: Model, texts: list, hashes: TokenHash) -> tuple[np.ndarray, np.ndarray]:
    """Ratios and scores, a few texts at a time to hold few words at once."""
    parts = [_score_few(model, texts[i:i + 128], hashes) for i in range(0, len(texts), 128)]
    return tuple(np.concatenate([np.empty(0), *(p[k] for p in parts)]) for k in (0, 1))


def _score_few(model: Model, texts: list, hashes: TokenHash) -> tuple[np.ndarray, np.ndarray]:
    toks = [tokens(t, hashes) for t in texts]
    flat = np.concatenate([np.empty(0, np.uint64), *toks])
    cuts = np.cumsum([len(t) for t in toks]).astype(np.int64)
    x = model.features(flat, cuts)
    return x[:, 0], model.score(x)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, ratio`` (of the whole text), ``score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by words_per_class

    def run(batches):
        hashes = TokenHash()
        for batch in batches:
            ratio, s = _score_texts(shared.value, batch.column("text").to_pylist(), hashes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ratio), pa.array(s)],
                                             names=["doc_id", "ratio", "score"])

    return (documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ratio double, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def rejected(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> Column:
    """A condition on rows of ``docs``: the text is toxic."""
    shared = short_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = TokenHash()
        for texts in batches:
            yield pd.Series(_score_texts(shared.value, texts.tolist(), hashes)[1])

    return scores(F.coalesce(docs[text_col].cast("string"), F.lit(""))) >= threshold
