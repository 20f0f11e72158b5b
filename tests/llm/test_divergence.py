"""Term counts, the pointer sort and the audit against plain Python."""
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisyframe.llm import divergence as M
from noisyframe.llm.common import lay_out, word_spans

from .frames import docs

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.lower() for t in TERM.findall((text or "").encode())]  # bytes.lower changes A-Z only


def brute(rows, min_docs, top):
    rows = [((lang or ""), (source or ""), terms(text)) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df = Counter(t for r in rows if r[0] == lang for t in set(r[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        counts = {s: Counter() for x, s, _ in rows if x == lang}
        for x, s, found in rows:
            if x == lang:
                counts[s].update(t for t in found if df[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def rate(c):
            over = sum(c.values()) + 5 * len(kept)
            return {t: 1 + floor(Fraction(10**9 * (c[t] + 5), over)) for t in kept}
        p, q = {s: rate(c) for s, c in counts.items()}, rate(whole)
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            own = [(q[t] - p[s][t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **options):
    given = spark.createDataFrame(
        [(None if i % 5 == 0 else i, *r, "x", 3) for i, r in enumerate(rows)],
        "doc_id long, lang string, source string, text string, term string, place long")
    return sorted(tuple(r) for r in M.audit(given, **options).collect())


def corpus(seed, n):
    g = np.random.default_rng(seed)
    pool = ["the", "The", "THE", "über", "Über", "日本語", "a", "abcdefgh", "abcdefghi", "abcdefghij" * 3,
            "abcdefghij" * 3 + "k", "x1y", "don't", "_", "99", "zz", "é", "É"]
    rows = []
    for _ in range(n):
        picks = g.choice(len(pool), g.integers(0, 30), p=np.arange(len(pool), 0, -1) / sum(range(len(pool) + 1)))
        rows.append((str(g.choice(["en", "de"])), f"s{g.integers(0, 5)}", " ".join(pool[i] for i in picks)))
    return rows


@pytest.mark.parametrize("tile_terms, tile_sources, shard", [(512, 256, 1 << 20), (3, 2, 200)])
def test_equals_plain_python(spark, monkeypatch, tile_terms, tile_sources, shard):
    rows = corpus(1, 150) + [(None, None, None), (None, "s1", "the the"), ("en", "empty", ""), ("fr", "only", "a " * 40),
                             ("xx", "a", "rare"), ("xx", "b", None), ("en", "s0", "abcdefgh" * 4000)] + corpus(1, 20)
    monkeypatch.setattr(M, "TILE_TERMS", tile_terms)
    monkeypatch.setattr(M, "TILE_SOURCES", tile_sources)
    monkeypatch.setattr(M, "SHARD_BYTES", shard)
    for min_docs, top in ((3, 4), (30, 50)):
        assert run(spark, rows, min_docs=min_docs, top=top) == brute(rows, min_docs, top)


def test_empty_table(spark):
    assert M.audit(docs(spark, [])).count() == 0


def test_rates_of_large_counts_are_exact(spark):
    n = 4_000_000_000_000
    row = spark.range(1).select(M._rate(F.lit(n), F.lit(n + 7), F.lit(3)).alias("p")).first()
    assert row["p"] == 1 + (10**9 * (n + 5)) // (n + 7 + 15)


def test_pointer_sort_is_stable_and_whole():
    texts = [t.encode() for t in ("b a abcdefgh abcdefghi", "abcdefghi a abcdefgh" + "z" * 9, "a" * 40, "a" * 40 + " a" * 3)]
    buf, _ = lay_out(texts)
    begin, end = word_spans(buf, M.term_bytes())
    order, first = M.sort_pointers(buf, begin, end)
    got = [(bytes(buf[begin[i]:end[i]]), int(begin[i])) for i in order]
    assert got == sorted(got)
    assert [i for i in range(len(got)) if not i or got[i][0] != got[i - 1][0]] == first.tolist()
    assert [len(x) for x in M.sort_pointers(buf[:0], begin[:0], end[:0])] == [0, 0]
