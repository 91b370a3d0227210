"""Texts are scored by the models that the logistic was fitted on, those of the
sample's halves: models of the whole sample rate its rare words higher, so that
ordinary texts were rejected for them."""

import random

import numpy as np
import pytest

pytest.importorskip("xxhash")

import llm_cases as cases  # noqa: E402

from aidspark.llm import toxicity  # noqa: E402


def test_scores_are_by_the_models_of_the_halves(spark, monkeypatch):
    rng, made, real = random.Random(3), [], toxicity.fit_ratio

    def record(pairs, folds, *args):
        made.append((folds, real(pairs, folds, *args)))
        return made[-1][1]
    monkeypatch.setattr(toxicity, "fit_ratio", record)
    texts = [" ".join([rng.choice(cases.WORDS) for _ in range(30)] + ["vile"] * (i % 4 == 0)) for i in range(80)]
    docs = cases.table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "toxic")
    assert sorted(folds for folds, _ in made) == [(0,), (1,)]
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [got[i].predicted for i in range(80)] == [int(i % 4 == 0) for i in range(80)]
    words = toxicity.tokens(texts[0], toxicity.TokenHash())
    x = np.mean([r.features(words, np.array([len(words)])) for _, r in made], axis=0)
    assert got[0].score == pytest.approx(model.score(x)[0]) and got[0].ratio == pytest.approx(x[0, 0])
