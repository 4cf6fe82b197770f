import numpy as np
import pytest

from fieldprep.llm import secrets, toxicity


def _slope(z, toxic, weight, scale, shift):
    """The gradient of the calibration's loss."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    want = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.stack([z, np.ones_like(z)], axis=1), np.array([scale, shift])
    p = 1 / (1 + np.exp(-x @ beta))
    return x.T @ (weight * (p - want)) + 1e-3 * (beta - [1.0, -2.0])


@pytest.mark.parametrize("gap, n1, n0", [(0.5, 8, 40), (3.0, 300, 2000), (40.0, 20, 20), (2.0, 1, 1), (1.0, 1, 5000)])
def test_calibration_converges(gap, n1, n0):
    draws = np.random.default_rng(1)
    z = np.concatenate([draws.normal(gap, 1.5, n1), draws.normal(0, 1.5, n0)])
    toxic = np.repeat([1, 0], [n1, n0])
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    scale, shift = toxicity._calibrate(z, toxic, weight)
    assert np.isfinite([scale, shift]).all()
    if scale > 0.1:
        assert np.abs(_slope(z, toxic, weight, scale, shift)).max() < 1e-3 * weight.sum()


def test_documents_with_clashing_columns_are_learnt_from(spark):
    said = ["you are a zorgling fool " * 4 if i % 2 else "a calm and friendly note about rivers " * 4 for i in range(60)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in enumerate(said)], "doc_id bigint, text string, toxic int, take int, n int, rows string")
    labels = spark.createDataFrame([(i, i % 2, 0, "y") for i in range(60)], "doc_id bigint, toxic int, quality int, text string")
    model = toxicity.fit_on(docs, labels)
    assert {r.doc_id for r in toxicity.score(docs, model).filter("predicted = 1").collect()} == set(range(1, 60, 2))
    assert toxicity.drop_toxic(docs, model).columns == docs.columns


def test_a_token_as_typical_as_the_threshold_is_found():
    model = secrets.fit({"hex": [f"{i:016x}"[::-1] for i in range(1000, 1400)]}, ["ordinary", "words", "of", "texts", "and", "more"] * 20)
    token = "Zq3kP0dWm8RtY2xL"
    model.thresholds = model.gains(token)
    assert [t for _, _, _, t in model.spans(f"see {token} there")[1]] == [token]
