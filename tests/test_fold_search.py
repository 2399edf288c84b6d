"""Searches from fold sums against fits on the rows themselves."""

import math
import random

import numpy as np
import pytest

from ledgerloom.operators import fold_search as fs


def rows_of(n=400, seed=3):
    chance = random.Random(seed)
    out = []
    for i in range(n):
        y = int(chance.random() < 0.4)
        out.append((i, chance.gauss(y, 1), chance.gauss(0, 5) + 100, chance.choice("ab") if y else chance.choice("bc"), chance.choice(["u", None]), y, i % 5))
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, "id long, p double, q double, g string, h string, label int, fold int").repartition(6)
    kinds = fs.categories(df, ["g", "h"])
    learners = {
        "ridge": fs.Ridge([1e-3, 10.0, 1e4]), "gaussian": fs.Gaussian([1e-9, 0.1]),
        "categorical": fs.Categorical([0.5, 20.0], [len(k) for k in kinds]), "bernoulli": fs.Bernoulli([(0.5, 1.0), (1.01, 3.0)], [0.4, 100.0]),
    }
    got = fs.search(df, learners, ["p", "q"], ["g", "h"], kinds).collect()
    return rows, kinds, {(r["model"], r["draw"], r["fold"]): (r["n"], r["correct"]) for r in got}


def split(rows, k):
    return [r for r in rows if r[6] != k], [r for r in rows if r[6] == k]


def test_every_draw_and_fold_is_scored(found):
    rows, _, got = found
    assert len(got) == 5 * (3 + 2 + 2 + 2) and all(n == 80 for n, _ in got.values())


def test_ridge_equals_least_squares_on_the_rows(found):
    rows, _, got = found
    for k in range(5):
        train, held = split(rows, k)
        x, y = np.array([r[1:3] for r in train]), np.array([2.0 * r[5] - 1 for r in train])
        mean, sd = x.mean(0), x.std(0)
        for d, penalty in enumerate([1e-3, 10.0, 1e4]):
            # the penalty as rows of its own
            z = np.vstack([(x - mean) / sd, math.sqrt(penalty) * np.eye(2)])
            w = np.linalg.lstsq(z, np.r_[y - y.mean(), 0, 0], rcond=None)[0]
            margin = (np.array([r[1:3] for r in held]) - mean) / sd @ w + y.mean()
            assert got["ridge", d, k][1] == sum((m > 0) == r[5] for m, r in zip(margin, held))


def test_bayes_learners_equal_their_definitions(found):
    rows, kinds, got = found
    for k in range(5):
        train, held = split(rows, k)
        of = {c: [r for r in train if r[5] == c] for c in (0, 1)}

        def right(score):
            return sum((score(r, 1) > score(r, 0)) == r[5] for r in held)

        prior = {c: math.log(len(of[c]) / len(train)) for c in of}
        widest = max(np.var([r[i] for r in train]) for i in (1, 2))
        for d, share in enumerate([1e-9, 0.1]):
            def bell(r, c):
                v = [np.var([s[i] for s in of[c]]) + share * widest for i in (1, 2)]
                m = [np.mean([s[i] for s in of[c]]) for i in (1, 2)]
                return prior[c] - 0.5 * sum(math.log(2 * math.pi * v[i]) + (r[i + 1] - m[i]) ** 2 / v[i] for i in (0, 1))

            assert got["gaussian", d, k][1] == right(bell)
        for d, alpha in enumerate([0.5, 20.0]):
            def table(r, c):
                seen = lambda i: sum(s[i] == r[i] for s in of[c])
                return prior[c] + sum(math.log((seen(i) + alpha) / (len(of[c]) + alpha * len(kinds[i - 3]))) for i in (3, 4))

            assert got["categorical", d, k][1] == right(table)
        for d, (cut, alpha) in enumerate([(0.5, 1.0), (1.01, 3.0)]):
            def coins(r, c):
                total = prior[c]
                for i, scale in ((1, 0.4), (2, 100.0)):
                    share = (sum(s[i] > cut * scale for s in of[c]) + alpha) / (len(of[c]) + 2 * alpha)
                    total += math.log(share if r[i] > cut * scale else 1 - share)
                return total

            assert got["bernoulli", d, k][1] == right(coins)
