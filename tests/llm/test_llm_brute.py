"""Operators against brute force on small fixtures."""

import collections
import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import llm_cases as cases  # noqa: E402

from aidspark.llm import (bm25, common, divergence, hpylm, licenses, packing, qda, queries, rlz, setsketch,  # noqa: E402
                          toxicity, winnow)
from aidspark.llm.graph import components  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def copies(seed, n=40):
    """Documents that share passages, with near and exact copies."""
    rng = random.Random(seed)
    shared = [cases.text(rng, 30, lines=True) for _ in range(4)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            out.append(rng.choice(out))
        elif out and kind < 0.4:
            words = rng.choice(out).split(" ")
            words[rng.randrange(len(words))] = "changed"
            out.append(" ".join(words))
        else:
            out.append("\n".join([cases.text(rng, rng.randrange(1, 60), lines=True), rng.choice(shared),
                                  cases.text(rng, rng.randrange(1, 40), lines=True)]))
    return out


# 1 ---------------------------------------------------------------------------------------------
def test_base_scores_and_counts(spark, small):
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [0] for r in small.collect()}
    counts = collections.Counter()
    for d, t in texts.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            counts.update(t)
    total, kinds = sum(counts.values()), len(counts)
    base = held = score = 0.0
    for r in hpylm.score(small, common.crc_fold(F.col("doc_id"), 5) != 1, chunk_words=5_000, head_words=300, buckets=5).collect():
        t = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(counts[w] > 0 for w in t), total)
        want = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        if not r.train:
            base, score, held = base + want, score + r.score, held + 1
    assert held and score > base  # the model predicts unseen texts better than smoothed unigrams


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    count = rng.integers(0, 90, 50)
    p = rng.dirichlet(np.ones(50)) * 0.9    # a tenth of the parent's mass lies on dishes not listed
    q = hpylm.sample_restaurants(np.zeros(50, np.int64), count, p, np.arange(50, dtype=np.uint64), np.array([count.sum()]))
    rest = 1 - q.sum()
    assert (q > 0).all() and 0 < rest < 0.2


def test_table_counts_follow_the_exact_conditional():
    """Gibbs draws of one dish against enumerating all seatings of 6 customers."""
    d, strength, others, p, n = 0.5, 1.0, 3.0, 0.05, 6
    weight = collections.Counter()

    def seat(tables, left, w):
        if not left:
            weight[len(tables)] += w
            return
        for i, size in enumerate(tables):
            seat(tables[:i] + [size + 1] + tables[i + 1:], left - 1, w * (size - d))
        seat(tables + [1], left - 1, w * (strength + d * (others + len(tables))) * p)

    seat([], n, 1.0)
    total = sum(weight.values())
    m = 40_000
    t = hpylm.sample_tables(np.full(m, n), np.full(m, others), np.full(m, p), d, strength,
                            hpylm.uniform(np.arange(m, dtype=np.uint64), 9))
    for k in range(1, n + 1):
        assert (t == k).mean() == pytest.approx(weight[k] / total, abs=0.01)


def test_repeated_rows_are_scored_each(spark):
    got = hpylm.score(cases.table(spark, ["a b c", "a b c", "a d"], [1, 1, 2])).collect()
    same = [r for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1] and same[0].n_tokens == 4 and same[0].train_tokens == 11


def test_hot_contexts_are_split(spark, monkeypatch):
    docs = cases.table(spark, [f"the w{i % 7} the w{i % 3}" for i in range(60)])
    monkeypatch.setattr(hpylm, "HOT", 20)
    got = hpylm.score(docs, buckets=3).collect()
    assert len(got) == 60 and all(r.score < 0 for r in got)


# 2 ---------------------------------------------------------------------------------------------
def kept_words(docs, window):
    first = {}
    for i in sorted(docs):
        w = docs[i]
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = {}
    for i, w in docs.items():
        mask = [True] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                mask[k:k + window] = [False] * window
        out[i] = [x for x, keep in zip(w, mask) if keep]
    return out


@pytest.mark.parametrize("seed, window, chunk", [(1, 13, 10 ** 6), (2, 6, 150), (3, 5, 1)])
def test_substring_dedup(spark, seed, window, chunk):
    texts = copies(seed) + ["of " * 200, "of " * 90, ""]
    docs = {i: t.encode().split() for i, t in enumerate(texts)}
    want = kept_words(docs, window)
    got = rlz.remove_duplicates(cases.table(spark, texts), window, buckets=3, chunk_words=chunk).collect()
    assert len(got) == len(texts)
    for r in got:
        kept = b" ".join(want[r.doc_id])
        assert (r.n_words, r.n_removed) == (len(docs[r.doc_id]), len(docs[r.doc_id]) - len(want[r.doc_id]))
        assert r.kept_text == kept.decode() and r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_factors_point_to_equal_words(spark):
    texts = copies(4)
    docs = [t.encode().split() for t in texts]
    found = rlz.factors(cases.table(spark, texts), 6, buckets=2).collect()
    assert found
    for f in found:
        n = f.n + 5
        assert f.ref_rid < f.rid
        assert docs[f.rid][f.start:f.start + n] == docs[f.ref_rid][f.ref_start:f.ref_start + n]


# 3, 7 ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("name, label", [("op3_qda", "quality"), ("op7_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.01"
    got = queries.registry()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in got:
        fold = zlib.crc32(str(r.doc_id).encode())
        assert r.held_out == ((fold % 5 == 0) if name == "op3_qda" else (fold % 4 == 2))
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r[label] for r in held) / len(held) >= 0.9


def test_qda_scores_are_density_ratios(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (200, len(qda.FEATURES))), rng.normal(1, 2, (100, len(qda.FEATURES)))])
    y = [0] * 200 + [1] * 100
    rows = spark.createDataFrame([(v.tolist(), k) for v, k in zip(x, y)], "x array<double>, y int")
    model = qda.fit(rows, pooling=0.2, ridge=0.1)
    z = (x - x.mean(0)) / x.std(0)
    cov = [np.cov(z[np.array(y) == k].T, bias=True) for k in (0, 1)]
    pooled = (200 * cov[0] + 100 * cov[1]) / 300
    logs = []
    for k in (0, 1):
        c = 0.8 * cov[k] + 0.2 * pooled
        c = 0.9 * c + 0.1 * np.trace(c) / len(c) * np.eye(len(c))
        diff = z - z[np.array(y) == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(c), diff) - 0.5 * np.linalg.slogdet(c)[1])
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + np.log(101 / 201), -500, 500)))
    assert np.allclose(model.score(x), want, atol=1e-6)


def test_kneser_ney_ratio_swaps_with_the_classes():
    u = [np.array(a, dtype=np.uint64) for a in ([1, 2, 2, 3], [1, 2, 3, 3, 9])]
    w = [np.array(a, dtype=np.uint64) for a in ([5, 6, 7, 5], [5, 5, 8, 6, 7])]
    n = [np.array(a) for a in ([4, 2, 6, 1], [7, 1, 1, 5, 2])]
    ratio = toxicity.kneser_ney_ratio(list(zip(u, w, n)), d=0.75)
    swapped = toxicity.kneser_ney_ratio(list(zip(u, w, n))[::-1], d=0.75)
    assert np.allclose(ratio.pair_value, -swapped.pair_value, atol=1e-5)
    assert np.allclose(ratio.word_value, -swapped.word_value, atol=1e-5)
    toks = np.array([5, 6, 7, 4, 4], dtype=np.uint64)
    x = ratio.features(toks, np.array([0, 3, 3, 5]))
    assert x.shape == (4, len(toxicity.FEATURES)) and not x[0].any() and not x[2].any()
    assert not x[3][2:].any()  # unknown words are neutral


def kneser_ney_by_hand(texts, d):
    """log P of each seen pair and each word for one class after the other, by the
    formula; ``texts``: the ordinary and the toxic ones as lists of words."""
    pairs = [collections.Counter((u, w) for t in own for u, w in zip(["<"] + t, t)) for own in texts]
    both = set(pairs[0]) | set(pairs[1])
    cont = collections.Counter(w for _, w in both)
    n = len(both)
    spare = sum(min(c, d) for c in cont.values()) / n / (len(cont) + 1)
    shared = {w: max(c - d, 0) / n + spare for w, c in cont.items()}
    word, pair, context = [], [], []
    for own in pairs:
        k = collections.Counter(w for _, w in own)
        total = sum(k.values())
        left = sum(min(c, d) for c in k.values()) / total
        uni = {w: max(k[w] - d, 0) / total + left * shared[w] for w in cont}
        mass = collections.Counter()
        for (u, _), c in own.items():
            mass[u] += c
        gamma = {u: sum(min(c, d) for (v, _), c in own.items() if v == u) / mass[u] if mass[u] else 1.0 for u, _ in both}
        pair.append({(u, w): math.log((max(own[u, w] - d, 0) / mass[u] if mass[u] else 0.0) + gamma[u] * uni[w]) for u, w in both})
        word.append({w: math.log(p) for w, p in uni.items()})
        context.append({u: math.log(g) for u, g in gamma.items()})
    return [{key: two[1][key] - two[0][key] for key in two[0]} for two in (pair, word, context)]


@pytest.mark.parametrize("d, folds", [(0.75, (0, 1)), (3.0, (0,)), (0.75, (1,))])
def test_kneser_ney_fit_equals_the_formula(spark, d, folds):
    rng = random.Random(8)
    rows = [(y, f, [rng.choice("abcdefg" if y else "defghij") for _ in range(rng.randrange(1, 30))]) for y in (0, 1) for f in (0, 1) for _ in range(5)]
    hashes = toxicity.TokenHash()
    code = lambda w: int(toxicity._START) if w == "<" else hashes[w]
    table = spark.createDataFrame([(y, f, bytearray(toxicity.tokens(" ".join(t), hashes).tobytes())) for y, f, t in rows] + [(0, 0, bytearray())],
                                  "y int, fold int, words binary").repartition(3)
    ratio = toxicity.fit_ratio(toxicity.count_pairs(table), folds, d)
    pair, word, context = kneser_ney_by_hand([[t for y, f, t in rows if y == k and f in folds] for k in (0, 1)], d)
    key = lambda u, w: int(toxicity._pair(np.array([code(u)], np.uint64), np.array([code(w)], np.uint64))[0])
    # pairs that are not held have what their word and their context give
    held, of = dict(zip(ratio.pairs.tolist(), ratio.pair_value.tolist())), {"w": dict(zip(ratio.words.tolist(), ratio.word_value.tolist())),
                                                                            "u": dict(zip(ratio.contexts.tolist(), ratio.context_value.tolist()))}
    assert set(held) <= {key(u, w) for u, w in pair} and (d > 1 or held)
    for (u, w), v in pair.items():
        assert held.get(key(u, w), of["w"][code(w)] + of["u"][code(u)]) == pytest.approx(v, abs=1e-4)
    for keys, values, want in ((ratio.words, ratio.word_value, {code(w): v for w, v in word.items()}),
                               (ratio.contexts, ratio.context_value, {code(u): v for u, v in context.items()})):
        assert keys.tolist() == sorted(want)
        assert np.allclose(values, [want[k] for k in keys.tolist()], atol=1e-4)


def test_toxic_sample_is_bounded(spark):
    docs = cases.table(spark, [f"word{i} idiot" if i % 2 else f"word{i} fine day" for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    chosen, n = toxicity.sample(common.keyed(docs), labels, "toxic", None, 10, 1000)
    assert n == [30, 30]
    assert {r.y: r["count"] for r in chosen.groupBy("y").count().collect()} == {0: 10, 1: 10}
    few, _ = toxicity.sample(common.keyed(docs), labels, "toxic", None, 10, 4)
    assert few.count() < 6


def test_long_texts_do_not_fill_the_toxic_sample(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["stone", "river", "cloud"]) for _ in range(30_000 if i % 10 == 0 else 40)) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    chosen, _ = toxicity.sample(common.keyed(cases.table(spark, texts)), labels, "toxic", None, 300, 10_000)
    rows = chosen.collect()
    for y in (0, 1):
        own = [r for r in rows if r.y == y]
        assert len(own) >= toxicity.LEAST_TEXTS and {r.fold for r in own} == {0, 1}
        assert max(len(r.text.split()) for r in own) <= 10_000 // toxicity.LEAST_TEXTS
    # words between line breaks and marks count as the tokenizer tells them apart
    lines = cases.table(spark, ["\n".join(f"w{i}x{k}_y" for k in range(50)) for i in range(400)])
    chosen, _ = toxicity.sample(common.keyed(lines), labels, "toxic", None, 300, 10_000)
    assert chosen.filter("y = 1").count() == 100
    assert toxicity.spread("a b c", 2 * toxicity.PIECES) == "a b c"


# 4 ---------------------------------------------------------------------------------------------
def test_quality_counts(spark, small):
    texts = [r.text for r in small.collect()] + ["a b c a b c d", "x\n \nx\nx y\nx y", "é é é é", "# $ <|>"]
    got = {r.doc_id: r for r in divergence.judge(cases.table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        seen, again = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_js_distance():
    p, q = np.array([3.0, 1.0, 0.0]), np.array([0.0, 0.0, 5.0])
    assert divergence.js_distance(p, q) == pytest.approx(1.0)
    assert divergence.js_distance(p, 2 * p) == pytest.approx(0.0, abs=1e-7)


def test_references_count_all_documents(spark):
    rules = divergence.Rules(top_words=2, min_reference_words=5)
    refs = divergence.fit_references(cases.table(spark, ["a a b", "a b c", None]), rules)
    assert refs.words["en"][0] == {b"a": 0, b"b": 1} and refs.words["en"][1].tolist() == [3, 2, 1]
    assert refs.of("fr") is None and refs.words[None][1].tolist() == [3, 2, 1]


def test_references_put_ties_in_the_order_of_the_words(spark):
    texts = ["zz zz zz b\x00 b a \u00e9 " + "x" * 15 + " " + "x" * 16 + " " + "x" * 40] * 2
    words = texts[0].encode().split()
    for top in range(1, 9):
        refs = divergence.fit_references(cases.table(spark, texts), divergence.Rules(top_words=top, min_reference_words=5))
        n = collections.Counter(words)
        want = sorted(n, key=lambda w: (-n[w], w[:15], min(len(w), 16)))[:top]
        got = list(refs.words["en"][0])
        assert [w[:16] for w in got] == [w[:16] for w in want] and len(got) == top
        assert refs.words["en"][1].tolist() == [2 * n[w] for w in got] + [2 * (len(words) - sum(n[w] for w in got))]


def test_references_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["w%d" % (i * i) for i in range(300)]) for _ in range(200)) for _ in range(60)]
    one = divergence.fit_references(cases.table(spark, texts, parts=1), divergence.Rules(min_reference_words=5))
    many = divergence.fit_references(cases.table(spark, texts, parts=9), divergence.Rules(min_reference_words=5))
    assert list(one.words["en"][0]) == list(many.words["en"][0])
    assert all((one.words[k][1] == many.words[k][1]).all() and (one.classes[k] == many.classes[k]).all() for k in ("en", None))


# 5 ---------------------------------------------------------------------------------------------
def near_components(texts, size, percent):
    sets = {}
    for i, t in enumerate(texts):
        w = t.encode().lower().split()
        n = min(size, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("seed, size, percent", [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates(spark, seed, size, percent):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 120))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(6)):  # chains of edits
            words = list(words)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(3000)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
    texts += ["", "solo", "SOLO", "two words", "two words", " "]
    want, sizes = near_components(texts, size, percent)
    got = setsketch.near_duplicates(cases.table(spark, texts), size, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.first == (r.doc_id == r.component_id) for r in got)


def test_similarity_estimate():
    rng = np.random.default_rng(1)
    for j in (0.5, 0.8, 0.95):
        n = 2000
        both = int(n * 2 * j / (1 + j))
        a = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        b = np.concatenate([a[:both], rng.integers(0, 2 ** 63, n - both, dtype=np.uint64)])
        r = setsketch.registers(np.concatenate([a, b]), np.array([0, n]), 512)
        got = setsketch.estimate(r[:1], r[1:], np.array([n]), np.array([n]))[0]
        assert got == pytest.approx(j, abs=0.1)
        # sketches of unions are the larger registers
        union = setsketch.registers(np.concatenate([a, b]), np.array([0]), 512)
        assert (union[0] == np.maximum(r[0], r[1])).all()


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {i: find(i) for a, b in pairs if a != b for i in (a, b)}
    got = components(spark.createDataFrame(pairs, "u long, v long"), "u", "v").collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


# 6 ---------------------------------------------------------------------------------------------
def test_license_scan(spark):
    rng = random.Random(7)
    texts = ["Licensed under CC BY-NC 4.0.", "cc by cc by", "All rights reserved. ALL RIGHTS RESERVED", "cc", "by cc",
             "the general public  license, version 3", "Released under the MIT License.", "ÀLL rights reserved"]
    sets = licenses._template_sets(licenses.TEMPLATES)
    for _ in range(60):
        words = [w for _, s in rng.sample(sets, 2) for w in rng.sample(s, rng.randrange(len(s) + 1))] + ["other", "words"]
        rng.shuffle(words)
        texts.append(" ".join(words) + "\n" + cases.text(rng, 10))
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = {r.doc_id: r for r in licenses.scan(cases.table(spark, texts)).collect()}
    met = 0
    for i, t in enumerate(texts):
        t = t.translate(low)
        words = rx.findall(t)
        places, base = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            hits = [k for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
            places += hits
            base |= {label} if hits else set()
        labels, best = set(), 0.0
        for line in t.split("\n"):
            own = set(rx.findall(line))
            for label, s in sets:
                both = len(own & set(s))
                if both >= math.ceil(licenses.THRESHOLD * len(s) - 1e-9):
                    labels.add(label)
                    best = max(best, both / len(s))
        met += bool(labels)
        r = got[i]
        assert (r.n_words, sorted(r.places), set(r.base_labels), set(r.method_labels)) == (len(words), sorted(places), base, labels)
        assert r.score == pytest.approx(1.0 if places else best)
    assert met > 5


def test_license_notices_wrap_over_lines(spark):
    import textwrap
    notice = dict((t[:9], (label, t)) for label, t in licenses.TEMPLATES)
    wrapped = [notice[k] for k in ("Permissio", "you can r", "Redistrib", "This Sour")]
    texts = ["The text.\n" + "\n".join(mark + x for x in textwrap.wrap(t, 44)) + "\n" + mark + "and more"
             for _, t in wrapped for mark in ("", "# ", " * ")]
    want = [label for label, _ in wrapped for _ in range(3)]
    spread = ["other"] * 1000
    for k, w in enumerate("released under the mit license".split()):
        spread[100 + 150 * k] = w
    long = ["other"] * 1000
    long[500:500] = notice["Permissio"][1].split()
    texts += [" ".join(spread), " ".join(long), "released\n\nunder the mit\n \nlicense"]
    got = {r.doc_id: list(r.method_labels) for r in licenses.scan(cases.table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [*([w] for w in want), [], ["mit"], []]


def test_license_plan_is_native(spark, small):
    plan = licenses.scan(small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# 8 ---------------------------------------------------------------------------------------------
def test_packing_round_trip(spark, small):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    texts = [r.text for r in small.collect()] + [
        None, "", "Hello wor ld  café don't I'LL <|endoftext|>x　y  ́a 12three \x1c\x1d z\x85q", "İstanbul ΣΑΣ ß ﬁ ﻿ 𝒜 😀\x00a",
        "a" * 5000, "'s 't  \n"]
    got = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in packing.pack(cases.table(spark, texts), window=256).collect():
        got[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        pieces = sorted(got[i], key=lambda r: r.start)
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == ids
        assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    assert sorted(seqs) == list(range(len(seqs)))
    for s, pieces in seqs.items():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total == 256 or s == len(seqs) - 1
        assert {r.sequence_length for r in pieces} == {total}
        assert {r.padded_length for r in pieces} == {total if total & (total - 1) == 0 else 256}


# 9 ---------------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed, run", [(1, 2), (2, 3), (3, 1)])
def test_line_dedup(spark, seed, run):
    rng = random.Random(seed)
    pool = [cases.text(rng, 4) for _ in range(12)]
    texts = ["\n".join(rng.choice([*pool, "", " ", "  " + pool[0]]) for _ in range(rng.randrange(1, 12))) for _ in range(30)]
    texts += ["A\nA\nA\nA", texts[0], ""]
    solid = {i: [(k, s.strip(" \t\r\x0b\x0c")) for k, s in enumerate(t.split("\n")) if s.strip(" \t\r\x0b\x0c")]
             for i, t in enumerate(texts)}
    seen, gone = set(), collections.defaultdict(set)
    for i in range(len(texts)):
        for p in range(len(solid[i]) - run + 1):
            key = tuple(s for _, s in solid[i][p:p + run])
            if key in seen:
                gone[i] |= {k for k, _ in solid[i][p:p + run]}
            seen.add(key)
    for r in winnow.dedup_lines(cases.table(spark, texts), run).collect():
        left = [s for k, s in enumerate(texts[r.doc_id].split("\n")) if k not in gone[r.doc_id]]
        assert r.text == "\n".join(left)
        assert tuple(r.line_dedup) == (len(solid[r.doc_id]), len(gone[r.doc_id]))


def without_passages(texts, window):
    """Words of each text that no window of an earlier place covers."""
    seen, out = set(), []
    for t in texts:
        words = t.split()
        gone = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            gone |= set(range(p, p + window)) if key in seen else set()
            seen.add(key)
        out.append([w for k, w in enumerate(words) if k not in gone])
    return out


@pytest.mark.parametrize("seed, window", [(1, 50), (2, 12), (3, 5)])
def test_passage_dedup(spark, seed, window):
    texts = [*copies(seed), "of " * 200, "of " * 120, "a b\tc\n" * 60]
    want = without_passages(texts, window)
    got = {r.doc_id: r for r in winnow.dedup_passages(cases.table(spark, texts), window).collect()}
    for i, t in enumerate(texts):
        assert got[i].text.split() == want[i]
        assert tuple(got[i].passage_dedup) == (len(t.split()), len(t.split()) - len(want[i]))
    assert any(len(w) < len(t.split()) for w, t in zip(want, texts))


def test_pipeline_removes_passages_inside_lines(spark, tmp_path):
    import corpus_pipeline
    words = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    passage = words("p", 60)
    texts = [f"{words('a', 30)} {passage} {words('b', 30)}\n{words('c', 9)}",  # the first copy stays
             f"{words('d', 9)}\n{words('e', 40)} {passage} {words('f', 7)}\n{words('g', 9)}",
             f"{words('h', 20)} {passage} {words('i', 20)}",                   # a lone line
             f"{words('j', 9)}\n{passage}\n{words('k', 9)}",                   # a line whose neighbours differ
             words("l", 20) + " " + passage.replace("p30 ", "p30\n") + " " + words("m", 20),  # over a line break
             passage]
    got = {r.doc_id: r for r in corpus_pipeline.dedup_lines(spark, cases.table(spark, texts), str(tmp_path)).collect()}
    assert got[0].text == texts[0]
    assert sorted(got) == [0, 1, 2, 3, 4]
    for i in (1, 2, 3, 4):
        assert got[i].text.split() == [w for w in texts[i].split() if not w.startswith("p")]
        assert got[i].n_chars == len(got[i].text)


def test_winnowing_selects_shared_positions():
    rng = np.random.default_rng(4)
    run = rng.integers(0, 2 ** 63, 9, dtype=np.uint64)
    a = np.concatenate([rng.integers(0, 2 ** 63, 5, dtype=np.uint64), run])
    b = np.concatenate([rng.integers(0, 2 ** 63, 2, dtype=np.uint64), run, run[:1]])
    pick = lambda h: {int(h[i]) for i in winnow.selected(h, 4)}
    assert len(pick(a) & pick(b)) >= 2


# 10 --------------------------------------------------------------------------------------------
def test_decontamination(spark):
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(4000)] + ["the", "of", "and"] * 400
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [prose(rng.choice([6, 20, 55, 150])) + ". " + prose(7) + "." for _ in range(60)] + ["Short one"]
    texts, want = [], set()
    for i in range(80):
        body = [prose(rng.randrange(0, 300))]
        if i % 3 == 0:
            k = rng.randrange(len(items) - 1)
            want.add((i, k))
            words = items[k].split()
            if i % 2 and len(words) > 40:
                words[5] = "edited"
            body.append(" ".join(words).upper() if i % 4 == 0 else " ".join(words))
        elif i % 3 == 1:
            body.append(" ".join(items[i % 60].split()[:4]))  # a few words are no copy
        body.append(prose(rng.randrange(0, 200)))
        texts.append("\n".join(body))
    docs = cases.table(spark, texts)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = bm25.contaminated(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    left = {r.doc_id for r in bm25.clean(docs, table).collect()}
    assert left == set(range(80)) - {d for d, _ in want}


def test_block_max_pruning_is_exact():
    """Pruned retrieval against scoring every passage with every segment."""
    rng = random.Random(10)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = {i: (i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 40)))) for i in range(50)}
    postings, df = [], collections.Counter()
    for i, (_, t) in texts.items():
        for s, part in enumerate(bm25.segments(bm25.words(t))):
            for term in sorted(set(part)):
                postings.append({"item": i, "segment": s, "size": len(part), "term": term, "tf": part.count(term)})
                df[term] += 1
    postings = [r | {"df": df[r["term"]]} for r in postings]
    mean = sum({(r["item"], r["segment"]): r["size"] for r in postings}.values()) / 50
    index = bm25.build(postings, texts, 50, mean, 0.5)
    own = collections.defaultdict(float)
    impact = collections.defaultdict(dict)
    for r in postings:
        idf = math.log1p((50 - r["df"] + 0.5) / (r["df"] + 0.5))
        v = idf * r["tf"] * 2.2 / (r["tf"] + 1.2 * (0.25 + 0.75 * r["size"] / mean))
        impact[r["item"]][r["term"]] = v
        own[r["item"]] += v
    asked = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 300))] for _ in range(40)]
    for words, found in zip(asked, bm25.retrieve(index, asked)):
        want = set()
        for at in range(0, max(1, len(words)), bm25.SEGMENT):
            passage = set(words[at:at + 2 * bm25.SEGMENT])
            want |= {i for i in impact if sum(v for t, v in impact[i].items() if t in passage) >= 0.5 * own[i] - 1e-9}
        assert set(found) == want


def test_question_answer():
    assert bm25.question_answer("What is it? It is a stone.") == ("What is it?", "It is a stone.")
    assert bm25.question_answer("Only one sentence.") == ("Only one sentence.", "Only one sentence.")
    assert bm25.question_answer("") == ("", "")


def test_queries_have_the_agreed_columns(spark):
    want = {
        "op1_hpylm": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op2_rlz": "doc_id n_words n_removed kept_sha256",
        "op3_qda": "doc_id held_out score predicted",
        "op4_divergence": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op5_setsketch": "doc_id n_shingles component_id kept",
        "op6_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
        "op7_toxicity": "doc_id held_out score predicted",
        "op8_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op9_winnowing": "doc_id n_lines n_removed kept_sha256",
        "op10_bm25": "doc_id item_id score",
    }
    for name, columns in want.items():
        got = queries.registry()[name](spark, SMALL)
        assert set(columns.split()) <= set(got.columns), name
        kinds = dict(got.dtypes)
        assert kinds["doc_id"] == "bigint" and kinds.get("held_out", "boolean") == "boolean"
