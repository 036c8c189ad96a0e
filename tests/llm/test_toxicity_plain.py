"""Toxicity against plain versions: the corrected risk, the choice of grams and the score."""

import math

import numpy as np

from riskweft.llm import toxicity
from tests.llm import helpers as H


def plain_risk(zp, zu, prior):
    loss = lambda z, y: math.log1p(math.exp(-z if y else z))
    rest = sum(loss(z, 0) for z in zu) / len(zu) - prior * sum(loss(z, 0) for z in zp) / len(zp)
    return prior * sum(loss(z, 1) for z in zp) / len(zp) + max(0.0, rest)


def test_risk_equals_plain_version():
    rng = np.random.default_rng(3)
    for shift in (0.0, 4.0):
        z, prior = np.concatenate((rng.normal(shift, 1, 9), rng.normal(-0.5, 1, 14))), 0.3
        value, gradient = toxicity.risk(z, 9, prior)
        assert math.isclose(value, plain_risk(z[:9], z[9:], prior), abs_tol=1e-12)
        for k in range(len(z)):
            step = np.zeros(len(z))
            step[k] = 1e-6
            slope = (plain_risk(*np.split(z + step, [9]), prior) - plain_risk(*np.split(z - step, [9]), prior)) / 2e-6
            if plain_risk(z[:9], z[9:], prior) > prior * np.logaddexp(0, -z[:9]).mean() + 1e-9:
                assert math.isclose(gradient[k], slope, abs_tol=1e-7)
    # Below zero the step goes back from the negative part alone.
    value, gradient = toxicity.risk(np.array([9.0, 9.0, -9.0]), 2, 0.9)
    assert math.isclose(value, 0.9 * math.log1p(math.exp(-9.0))) and (gradient[:2] > 0).all() and gradient[2] < 0


def test_score_equals_plain_version(spark):
    words = ["awful", "dreadful", "plain", "Ünder"]
    model = toxicity.Model({g: 0.25 * (k + 1) for k, w in enumerate(words) for g in toxicity.grams(w.lower().encode())}, -1.0, 0.1)
    rows = [(1, "Awful, awful DREADFUL"), (2, "plain text"), (3, None), (4, ""), (5, "nothing " * 500), (5, "awful")]
    got = {(r["doc_id"], r["text"]): (r["score"], r["predicted"]) for r in toxicity.score(H.docs_frame(spark, rows), model).collect()}
    for i, text in rows:
        own = {g for w in H.alnum(text) for g in toxicity.grams(w.encode())}
        want = 1 / (1 + math.exp(1.0 - sum(model.weights.get(g, 0.0) for g in own)))
        assert math.isclose(got[i, text][0], want, abs_tol=1e-12) and got[i, text][1] == int(want >= 0.5)
