"""Signals against a direct count, exact bounds against a sum of terms."""
import math
import re

import pytest
from pyspark.sql import functions as F

from noisyframe.llm import quality_rules as M

from .frames import docs, words

TEXTS = [None, "", " \n\t", "a b c", "a b c d", "a b a b a b", "x y z x y z\n\nx y z", "one\ntwo\none\none\n \n \ntwo ",
         "# * $ % & | < >", "ÄÖ ñ 🙂 x", "a" * 4000, "a b c " * 2000, words(1, 300), words(2, 3000, 30), "A\r\nA\r\n", "w\x0bw\x0cw\x0dw"]


def direct(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_signals(spark):
    got = {r["doc_id"]: r for r in M.signals(docs(spark, list(enumerate(TEXTS)))).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(TEXTS):
        assert tuple(got[i][n] for n in names) == direct(text), text


def test_binomial_bound_is_exact(spark):
    cases = [(n, x, p) for n in (0, 1, 10, 500) for x in (0, 1, 3, 9, 500) for p in (0.004, 0.02, 0.3)]
    for p in (0.004, 0.02, 0.3):
        rows = [(n, x) for n, x, q in cases if q == p]
        got = spark.createDataFrame(rows, "n long, x long").select(
            "n", "x", M.binomial_cdf(F.col("n"), F.col("x"), p).alias("cdf")).collect()
        for r in got:
            want = sum(math.comb(r["n"], k) * p ** k * (1 - p) ** (r["n"] - k) for k in range(min(r["x"], r["n"]) + 1))
            assert r["cdf"] == pytest.approx(want, rel=1e-9)


def rows():
    good = [(k, words(k + 1, 100)) for k in range(4000)]
    bad = [(10000 + k, " ".join(w + "%%%" for w in words(k + 9000, 100).split())) for k in range(300)]
    return good, bad


def test_cutoffs_follow_labels_and_strata(spark):
    good, bad = rows()
    frame = docs(spark, [*good, *bad]).union(docs(spark, [(20000, bad[0][1]), (20001, None)], lang=None))
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (7, None), (99999, 0), (8, 1)],
                                   "doc_id long, quality int")
    got = {r["doc_id"]: r for r in M.rated(frame, labels).collect()}
    assert len(got) == 4302
    assert all(got[i]["kept"] for i, _ in good)
    assert not any(got[i]["kept"] for i, _ in bad)
    assert got[20000]["kept"] and not got[20000]["base_failed"]      # nothing is certified without labels
    assert got[20001]["base_failed"] and not got[20001]["kept"]


def test_few_labels_certify_nothing(spark):
    good, bad = rows()
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:50]] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    frame = docs(spark, [*good[:50], *bad])
    assert all(r["kept"] for r in M.rated(frame, labels).collect())
    assert M.rated(docs(spark, []), labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in M.rated(frame, labels.limit(0)).collect())


def test_binomial_bounds_of_very_many_labels_end(spark):
    rows = [(10 ** 9, 10 ** 6, 0.002), (10 ** 9, 1_900_000, 0.002), (10 ** 9, 2_100_000, 0.002), (4 * 10 ** 9, 3 * 10 ** 9, 0.002)]
    for n, x, p in rows:
        got = spark.createDataFrame([(n, x)], "n long, x long").select(M.binomial_cdf(F.col("n"), F.col("x"), p).alias("cdf")).first()[0]
        assert 0 <= got <= 1 and (got < 1e-12) == (x < n * p * 0.97) and (got > 0.999) == (x > n * p * 1.03)


def test_binomial_sums_of_some_thousand_terms(spark):
    for n, p in ((3000, 0.004), (20_000, 0.02)):
        xs = [0, 1, int(n * p) - 1, int(n * p), int(n * p) + 1, int(n * p * 1.5), n - 1, n]
        log = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(n + 1)]
        got = {r["x"]: r["cdf"] for r in spark.createDataFrame([(n, x) for x in xs], "n long, x long").select(
            "x", M.binomial_cdf(F.col("n"), F.col("x"), p).alias("cdf")).collect()}
        for x in xs:
            assert got[x] == pytest.approx(math.fsum(map(math.exp, log[:x + 1])), rel=1e-7), (n, x)
