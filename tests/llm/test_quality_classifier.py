"""Held-out accuracy on the labelled documents, gradients, and frames with odd rows."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisyframe.llm import quality_classifier as M
from noisyframe.llm.common import table

from .frames import docs, words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return M.query(spark, SF).cache()


def test_held_out_accuracy(spark, scored):
    rows = scored.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert len(good) > 40 and np.mean(good) >= 0.98 and np.mean(bad) <= 0.3


def test_every_document_is_scored_once(spark, scored):
    ids = [r["doc_id"] for r in table(spark, SF, "documents").collect()]
    rows = scored.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_labels_held_out_change_nothing(spark, scored):
    labels = table(spark, SF, "labels")
    spoiled = labels.withColumn("quality", F.when(M.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = M.classify(table(spark, SF, "documents"), spoiled)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))


def test_chunks_cover_the_whole_text():
    for size in (0, 1, M.CHUNK - 1, M.CHUNK, M.CHUNK + 1, M.STRIDE + M.CHUNK, 5000):
        text = bytes(np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8))
        rows = M.chunk_matrix(text)
        whole = rows[0].tobytes() + b"".join(r.tobytes()[M.CHUNK - M.STRIDE:] for r in rows[1:-1])
        end = len(text) - M.CHUNK
        if len(rows) > 1:
            assert end <= len(whole) and rows[-1].tobytes() == text[end:]
            whole = whole[:end] + rows[-1].tobytes()
        assert whole == text.ljust(M.CHUNK, b"\0")
    assert len(M.chunk_matrix(b"x" * 100_000, 16)) == 16 and len(M.chunk_matrix(None)) == 1


def test_symbols_mark_what_is_said_twice():
    text = b"abc abc defgh ijk".ljust(M.CHUNK, b"\0")
    marked = M.symbols(np.frombuffer(text, np.uint8)[None, :])[0] >= 256
    for p in range(M.CHUNK):
        gram = text[p - M.ECHO + 1:p + 1]
        want = p >= M.ECHO - 1 and any(text[p - g - M.ECHO + 1:p - g + 1] == gram
                                       for g in range(1, M.LAG + 1) if p - g - M.ECHO + 1 >= 0)
        assert marked[p] == want, p


def test_gradients_equal_differences():
    network = M.ByteNetwork(3)
    for k in network.weights:
        network.weights[k] = network.weights[k].astype(np.float64)
    g = np.random.default_rng(0)
    chunks = g.integers(97, 123, (7, M.CHUNK)).astype(np.uint16)
    first, labels, weight = np.array([0, 3, 4]), np.array([1, 0, 1.0]), np.array([0.2, 0.5, 0.3])
    _, grads = network.step(chunks, first, labels, weight)
    for name, at in (("out", (3,)), ("hidden", (5, 2)), ("hidden", (20, 4)), ("hidden", (40, 1)), ("hidden_bias", (1,)),
                     ("out_bias", (0,)), ("filters", (0, int(chunks[0, 9]), 1)), ("filters", (4, 110, 6))):
        old = network.weights[name][at]
        losses = []
        for d in (1e-4, -1e-4):
            network.weights[name][at] = old + d
            losses.append(network.step(chunks, first, labels, weight)[0])
        network.weights[name][at] = old
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=0.02, abs=1e-5), (name, at)


def test_blocks_of_chunks_change_nothing(monkeypatch):
    network = M.ByteNetwork(5)
    texts = [b"", None, words(1, 900).encode(), b"a b c", words(2, 60).encode()]
    want = network.score(texts)
    monkeypatch.setattr(M, "SCORE_CHUNKS", 3)
    assert np.allclose(network.score(texts), want, atol=1e-6)
    assert want[0] == want[1]


def test_nulls_and_few_labels(spark):
    given = docs(spark, [(1, None), (2, ""), (None, "a b"), (3, "words " * 30_000), (3, "words " * 30_000)])
    none = spark.createDataFrame([], "doc_id long, quality int, score string")
    assert {r["score"] for r in M.classify(given, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, "x") for i in (2, 3, 3, None)] + [(1, None, "x")], "doc_id long, quality int, score string")
    assert {r["score"] for r in M.classify(given, one).collect()} == {1.0}
    both = spark.createDataFrame([(2, 0), (3, 1), (3, 1), (3, 0), (99, 1), (None, 0)], "doc_id long, quality int")
    rows = M.classify(given, both).collect()
    assert len(rows) == 5 and len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert M.classify(docs(spark, []), both).count() == 0
