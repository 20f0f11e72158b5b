"""Multi-label errors, text probabilities and histogram gain against plain Python."""
import math
from collections import Counter

import numpy as np
import pytest

from noisyframe.operators import gain as G
from noisyframe.operators import latent as LT
from noisyframe.operators import pruning as P
from noisyframe.operators.text_rates import token_rate_psx
from noisyframe.session import cut_lineage


def multi_frame(spark, n=300, K=3, seed=5):
    g = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        labels = sorted({int(x) for x in g.integers(0, K, g.integers(0, 3))})
        psx = [round(float(min(1, max(0, g.normal(0.7 if (k in labels) ^ (i % 6 == 0) else 0.2, 0.15)))), 2) for k in range(K)]
        rows.append((i, labels if i % 50 else None, psx))
    return rows, cut_lineage(spark.createDataFrame(rows, "row_id long, labels array<int>, psx array<double>"))


@pytest.mark.parametrize("method", ["prune_by_class", "prune_by_noise_rate", "both"])
def test_multi_label_errors_equal_plain_python(spark, method):
    rows, df = multi_frame(spark)
    K = 3
    cj = {(r["k_s"], r["k_y"]): r["v"] for r in LT.multilabel_joint(df, K).collect()}
    b = LT.multilabel_boundary(df, K).where("best").first()["boundary"]
    by_class, by_count = set(), set()
    for k in range(K):
        inside = [(i, p) for i, labels, p in rows if labels and k in labels]
        m = sum(cj[k, j] for j in range(K) if j != k)
        if m > 0:
            own = sorted(p[k] for _, p in inside)
            by_class |= {i for i, p in inside if m >= len(own) or p[k] < own[m]}
        for j in range(K):
            n = cj[k, j]
            if j != k and n > 0:
                margins = sorted((p[k] - p[j] for _, p in inside))
                by_count |= {i for i, p in inside if n > len(margins) or p[k] - p[j] <= margins[n - 1]}
    want = {"prune_by_class": by_class, "prune_by_noise_rate": by_count, "both": by_class & by_count}[method]
    want = {i for i, labels, p in rows if i in want and {k for k in range(K) if p[k] > b} != set(labels or [])}
    got = P.find_label_errors_multi(df, K, method=method)
    marked = {r["row_id"] for r in got.where("is_error").collect()}
    assert marked == want and len(want) > 5 and got.count() == len(rows)
    score = {i: sum(p[k] for k in labels) / len(labels) - max(p) for i, labels, p in rows if i in want}
    order = [r["row_id"] for r in P.order_label_errors_multi(got).orderBy("pos").collect()]
    assert [round(score[i], 9) for i in order] == sorted(round(s, 9) for s in score.values())


def test_text_probabilities_equal_plain_python(spark):
    g = np.random.default_rng(1)
    pool = ["a", "B", "b", "the", "x!", "é", "zz"]
    rows = [(i, i % 3, None if i % 10 == 9 else i % 2,
             None if i == 4 else " ".join(pool[j] for j in g.integers(0, len(pool) - i % 2, g.integers(0, 12)))) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, fold int, label int, text string")

    def toks(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    size = len({t for r in rows for t in toks(r[3])})
    got = {r["row_id"]: r["psx"] for r in token_rate_psx(df).collect()}
    assert len(got) == 40
    for i, fold, _, text in rows:
        other = [r for r in rows if r[1] != fold and r[2] is not None]
        said = {k: Counter(t for r in other if r[2] == k for t in toks(r[3])) for k in (0, 1)}
        docs = {k: sum(r[2] == k for r in other) for k in (0, 1)}
        s = [math.log((docs[k] + 1) / (len(other) + 2)) + sum(
            math.log((said[k][t] + 1) / (sum(said[k].values()) + size)) for t in toks(text)) for k in (0, 1)]
        p1 = 1 / (1 + math.exp(s[0] - s[1]))
        assert got[i] == pytest.approx([1 - p1, p1], abs=2e-9)
    assert token_rate_psx(df.limit(0)).count() == 0


def brute_gain(rows, features, levels, bins):
    ends = {c: (min(r[c] for r in rows if r[c] is not None), max(r[c] for r in rows if r[c] is not None)) for c in features}

    def at(r, c):
        lo, hi = ends[c]
        return -1 if r[c] is None else 0 if lo == hi else min(int((r[c] - lo) / (hi - lo) * bins), bins - 1)

    def impurity(part):
        s = sum(r["label"] for r in part)
        return 2 * s * (len(part) - s) / len(part) if part else 0.0
    total, nodes = Counter(), [rows]
    for _ in range(levels):
        below = []
        for part in nodes:
            best = []
            for c in features:
                cuts = sorted({at(r, c) for r in part})[:-1]
                found = [(impurity(part) - impurity([r for r in part if at(r, c) <= b]) - impurity([r for r in part if at(r, c) > b]), -b) for b in cuts]
                if found:
                    gain, b = max(found, key=lambda x: (round(x[0], 9), x[1]))
                    total[c] += gain
                    best.append((-round(gain, 9), c, -b))
            if best and min(best)[0] < 0:
                _, c, b = min(best)
                below += [[r for r in part if at(r, c) <= b], [r for r in part if at(r, c) > b]]
        nodes = below
    return total


def test_gain_equals_plain_python(spark):
    g = np.random.default_rng(8)
    rows = []
    for i in range(300):
        x, z = float(g.integers(0, 40)), int(g.integers(0, 6))
        rows.append(dict(row_id=i, n_1=None if i % 17 == 0 else x, c_1=z, n_2=3.0, n_3=float(g.random()),
                         label=int(x > 15) if g.random() < 0.8 else int(z > 3)))
    d = spark.createDataFrame([tuple(r.values()) for r in rows], "row_id long, n_1 double, c_1 int, n_2 double, n_3 double, label int")
    features = ["n_1", "c_1", "n_2", "n_3"]
    for levels in (1, 3):
        got = {r["feature"]: r["gain"] for r in G.histogram_gain(d, features, 0.0, levels=levels, bins=16).collect()}
        want = brute_gain(rows, features, levels, 16)
        assert got == pytest.approx({c: want[c] for c in features}, abs=1e-6)
    ranked = [r["feature"] for r in G.histogram_gain(d, features, 0.5, top=2, bins=16).collect()]
    assert ranked[0] == "n_1" and len(ranked) == 2
    with pytest.raises(ValueError, match="levels"):
        G.histogram_gain(d, features, levels=0)
