"""A quality score does not depend on the rows around it."""

from __future__ import annotations

import numpy as np

from orderloom.llm import quality_model


def test_scores_of_a_batch_equal_those_one_by_one():
    texts = ["a b .", "Go .", ". .", "x", "y x", None, "x", "y x z x", ".", "w ."]
    weights = np.random.default_rng(2).normal(0, 1, quality_model.DIMENSIONS).astype(np.float32)
    alone = [quality_model.features([text])[0].tolist() for text in texts]
    grams, counts = quality_model.features(texts)
    assert [part.tolist() for part in np.split(grams, np.cumsum(counts)[:-1])] == alone
    each = [quality_model.scores([text], weights, 0.25)[0] for text in texts]
    assert np.allclose(quality_model.scores(texts, weights, 0.25), each)
