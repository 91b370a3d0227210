"""The tables that the restaurants of the language model resample are the
customers of the unigram restaurant."""

import pytest

pytest.importorskip("xxhash")

import llm_cases as cases  # noqa: E402
import numpy as np  # noqa: E402
import xxhash  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aidspark.llm import hpylm  # noqa: E402


@pytest.fixture()
def rooted(monkeypatch):
    """The vocabulary as the unigram restaurant is sampled on it."""
    found, real = {}, hpylm._sample_root

    def record(vocab, seats, start):
        out = real(vocab, seats, start)
        found.update({r["w"]: r for r in out[0].collect()})
        found["root"] = out[1]
        return out
    monkeypatch.setattr(hpylm, "_sample_root", record)
    return found


def of(found, word):
    return found[int(np.uint64(xxhash.xxh64_intdigest(word)).view(np.int64))]


@pytest.mark.parametrize("head_words", [hpylm.HEAD, 0])
def test_parent_customers_are_resampled_tables(spark, rooted, head_words):
    """One pair of words in every text, in as many stretches as there are texts, and
    a word that follows as many others: the first has a few tables, the second one
    in each of its restaurants."""
    docs = cases.table(spark, [f"san marino w{i} fine" for i in range(200)]).repartition(4)
    assert hpylm.score(docs, buckets=3, chunk_words=4, head_words=head_words).count() == 200
    pair, wide = of(rooted, b"marino"), of(rooted, b"fine")
    assert pair["c"] == wide["c"] == 200
    assert wide["k"] == 200
    assert 1 <= pair["k"] < 100      # one table a stretch made these 200
    for x in (pair, wide):
        assert 1 <= x["t"] <= x["k"] <= x["c"]
    assert rooted["root"].customers == sum(r["k"] for w, r in rooted.items() if w != "root")


def test_customers_of_the_parent_change_scores_and_stretches_do_not(spark):
    docs = cases.table(spark, [f"san marino w{i % 50} fine w{i % 7}" for i in range(120)])
    fold = F.col("doc_id") % 5 != 1
    a, b = ({r["doc_id"]: r for r in hpylm.score(docs, fold, buckets=3, chunk_words=n, head_words=40).collect()}
            for n in (3, 1_000_000))
    assert a.keys() == b.keys()
    for i in a:
        assert a[i]["score"] == pytest.approx(b[i]["score"], rel=1e-12)


def test_rare_words_of_held_out_texts_keep_their_counts(spark):
    """A word outside the head that another context's restaurant was trained on."""
    docs = cases.table(spark, ["a zeta b", "b zeta a", "c zeta c"], [1, 2, 3])
    got = {r["doc_id"]: r for r in hpylm.score(docs, F.col("doc_id") != 3, buckets=7, head_words=0).collect()}
    assert (got[3]["n_tokens"], got[3]["n_known"], got[3]["train_tokens"]) == (4, 2, 8)
