"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes, each starting ``STRIDE`` bytes after the one
before and the last one ending with the text, so that they overlap and cover the whole
document, and each pattern of ``WIDTH`` bytes lies in some chunk.  A byte's symbol is its value and whether the ``ECHO`` bytes up to it stand up
to ``LAG`` bytes earlier in the chunk too, so that a filter can see a word said twice.
``FILTERS`` learned filters run over a chunk's symbols: a filter's answer at a place is the
sum of one learned weight for each of its ``WIDTH`` symbols (the convolution of one-hot
symbols, done by table lookup), and each filter keeps its largest answer in the chunk.  A document's vector holds, for each filter, the mean, the largest and the smallest over
all its chunks (a chunk of few different words answers to few filters); a hidden layer and a logistic unit combine it into one probability.

Fit: labelled documents, about ``fit_rows`` of each label chosen by a hash of the id, and of
each at most ``FIT_CHUNKS`` chunks spread evenly over the whole text; both bounds hold what
reaches the driver (4,000 documents x 16 chunks x 256 bytes = 16 MB).  The two labels weigh
the same in the loss of training.  Then the probability is made that of the labelled corpus,
by adding the logarithm of its odds, counted over all labels.  Weights start from a
seed, and rows are taken in the order of their hash, so that a fit is repeatable.
Scoring reads every chunk of every text, ``SCORE_CHUNKS`` at a time, so that memory
doesn't grow with a text beyond its own bytes.

Defined cases: null and empty texts are one chunk of zero bytes and get its score.  Null
labels, null ids and null texts aren't learned from; a doc_id with several labels counts
with their mean, from 0.5 on as 1.  With no label to learn from, or only one kind, every score is
the share of label 1 (0.5 without labels).  Repeated rows get equal scores; extra columns
are ignored; a null doc_id isn't held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, small_batches, table

CHUNK = 256
STRIDE = 224
WIDTH = 5
ECHO = 3
LAG = 32
SYMBOLS = 512
FILTERS = 16
HIDDEN = 16
FIT_ROWS = 2000
FIT_CHUNKS = 16
EPOCHS = 12
STEPS = 400
BATCH = 64
DECAY = 0.02
RATE = 0.01
SEED = 11
SCORE_CHUNKS = 512
THRESHOLD = 0.3


def chunk_matrix(text: bytes | None, most: int | None = None) -> np.ndarray:
    """The chunks of a text as rows of bytes, a text below one chunk filled up with zeros; if
    there are more than most, as many of them evenly spread, the first and the last included."""
    buf = np.frombuffer((text or b"").ljust(CHUNK, b"\0"), np.uint8)
    start = np.append(np.arange(0, len(buf) - CHUNK, STRIDE), len(buf) - CHUNK)
    if most is not None and len(start) > most:
        start = start[np.linspace(0, len(start) - 1, most).round().astype(np.int64)]
    return np.lib.stride_tricks.sliding_window_view(buf, CHUNK)[start]


def symbols(chunks: np.ndarray) -> np.ndarray:
    """A symbol for each byte: the byte, plus 256 if the ECHO bytes up to it are said again."""
    again = np.zeros(chunks.shape, bool)
    for lag in range(1, LAG + 1):
        same = chunks[:, lag:] == chunks[:, :-lag]
        run = same[:, ECHO - 1:].copy()
        for k in range(1, ECHO):
            run &= same[:, ECHO - 1 - k:same.shape[1] - k]
        again[:, lag + ECHO - 1:] |= run
    return chunks + again.astype(np.uint16) * np.uint16(256)


class ByteNetwork:
    """Filters (WIDTH, SYMBOLS, FILTERS), and the two dense layers over means, maxima and minima."""

    def __init__(self, seed: int = SEED):
        g = np.random.default_rng(seed)
        f32 = np.float32
        self.weights = {
            "filters": np.tile(g.normal(0, 0.3, (WIDTH, 256, FILTERS)), (1, SYMBOLS // 256, 1)).astype(f32),
            "hidden": g.normal(0, (1 / FILTERS) ** 0.5, (3 * FILTERS, HIDDEN)).astype(f32),
            "hidden_bias": np.zeros(HIDDEN, f32),
            "out": g.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN).astype(f32),
            "out_bias": np.zeros(1, f32),
        }
        # added to the log-odds when scoring
        self.shift = 0.0
        self.constant: float | None = None

    def answers(self, chunks: np.ndarray) -> np.ndarray:
        """The filters' answers at each place of chunks of symbols: chunks x places x filters."""
        places = CHUNK - WIDTH + 1
        filters = self.weights["filters"]
        out = filters[0][chunks[:, :places]]
        for k in range(1, WIDTH):
            out += filters[k][chunks[:, k:k + places]]
        return out

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's largest answer in each chunk."""
        return np.tanh(_largest(self.answers(chunks)))

    def head(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.maximum(vectors @ w["hidden"] + w["hidden_bias"], 0)
        return hidden, hidden @ w["out"] + w["out_bias"][0]

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        most = np.full((len(texts), FILTERS), -np.inf, np.float32)
        least = np.full((len(texts), FILTERS), np.inf, np.float32)
        sums = np.zeros((len(texts), FILTERS), np.float64)
        counts = np.zeros(len(texts), np.int64)
        waiting, owners, held = [], [], 0

        def run() -> None:
            pooled = self.pooled(symbols(np.concatenate(waiting)))
            at = 0
            for i, n in owners:
                mine = pooled[at:at + n]
                sums[i] += mine.sum(axis=0)
                counts[i] += n
                np.maximum(most[i], mine.max(axis=0), out=most[i])
                np.minimum(least[i], mine.min(axis=0), out=least[i])
                at += n

        for i, text in enumerate(texts):
            rows = chunk_matrix(text)
            for a in range(0, len(rows), SCORE_CHUNKS):
                part = rows[a:a + SCORE_CHUNKS]
                waiting.append(part)
                owners.append((i, len(part)))
                held += len(part)
                if held >= SCORE_CHUNKS:
                    run()
                    waiting, owners, held = [], [], 0
        if held:
            run()
        vectors = np.concatenate([sums / np.maximum(counts, 1)[:, None], most, least], axis=1, dtype=np.float32)
        return _logistic(self.head(vectors)[1].astype(np.float64) + self.shift)

    def step(self, chunks: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients for documents whose chunks start at first."""
        w = self.weights
        answers = self.answers(chunks)
        place = answers.argmax(axis=1)                                  # chunks x filters
        pooled = np.tanh(np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0])
        count = np.diff(np.append(first, len(chunks)))
        mean = np.add.reduceat(pooled, first) / count[:, None]
        most = np.maximum.reduceat(pooled, first)
        least = np.minimum.reduceat(pooled, first)
        vectors = np.concatenate([mean, most, least], axis=1)
        hidden, odds = self.head(vectors)
        p = _logistic(odds.astype(np.float64)).astype(np.float32)
        loss = -float((weight * (labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7))).sum())
        d_odds = (weight * (p - labels)).astype(np.float32)
        grads = {"out": hidden.T @ d_odds, "out_bias": d_odds.sum(keepdims=True)}
        d_hidden = np.outer(d_odds, w["out"]) * (hidden > 0)
        grads["hidden"], grads["hidden_bias"] = vectors.T @ d_hidden, d_hidden.sum(axis=0)
        d_vectors = d_hidden @ w["hidden"].T
        doc = np.repeat(np.arange(len(first)), count)
        d_pooled = (d_vectors[:, :FILTERS] / count[:, None])[doc]
        d_pooled += _to_first(pooled == most[doc], first, doc) * d_vectors[doc, FILTERS:2 * FILTERS]
        d_pooled += _to_first(pooled == least[doc], first, doc) * d_vectors[doc, 2 * FILTERS:]
        d_answers = (d_pooled * (1 - pooled ** 2)).astype(np.float32)
        d_filters = np.zeros_like(w["filters"])
        column = np.arange(FILTERS)
        for k in range(WIDTH):
            byte = np.take_along_axis(chunks, place + k, axis=1)
            np.add.at(d_filters[k], (byte, column[None, :]), d_answers)
        grads["filters"] = d_filters
        return loss, grads

    def train(self, documents: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """For documents as chunks of symbols: Adam with decaying weights over minibatches, STEPS of them at least; the two labels weigh the same."""
        g = np.random.default_rng(seed)
        share = labels.mean()
        each = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        first_moment = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second_moment = {k: np.zeros_like(v) for k, v in self.weights.items()}
        in_epoch = -(-len(documents) // BATCH)
        epochs = max(epochs, -(-STEPS // in_epoch))
        t, steps = 0, epochs * in_epoch
        for _ in range(epochs):
            order = g.permutation(len(documents))
            for a in range(0, len(order), BATCH):
                rows = order[a:a + BATCH]
                chunks = np.concatenate([documents[i] for i in rows])
                first = np.append(0, np.cumsum([len(documents[i]) for i in rows]))[:-1]
                _, grads = self.step(chunks, first, labels[rows].astype(np.float32), each[rows] / len(rows))
                t += 1
                rate = RATE * (1 - t / (steps + 1))
                for k, value in self.weights.items():
                    m = first_moment[k] = 0.9 * first_moment[k] + 0.1 * grads[k]
                    v = second_moment[k] = 0.999 * second_moment[k] + 0.001 * grads[k] ** 2
                    move = (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8) + DECAY * value
                    value -= (rate * move).astype(np.float32)


def _to_first(hit: np.ndarray, first: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each filter only the first hit of each document: it takes the gradient of a maximum or minimum."""
    seen = np.cumsum(hit, axis=0)
    before = np.where(first[:, None] > 0, seen[np.maximum(first - 1, 0)], 0)
    return hit & (seen - before[doc] == 1)


def _largest(answers: np.ndarray) -> np.ndarray:
    """The largest answer over all places, by halves (long contiguous operations)."""
    while answers.shape[1] > 1:
        half = answers.shape[1] // 2
        rest = answers[:, 2 * half:]
        answers = np.maximum(answers[:, :half], answers[:, half:2 * half])
        if rest.shape[1]:
            answers[:, :1] = np.maximum(answers[:, :1], rest)
    return answers[:, 0]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def held_out() -> F.Column:
    """The remainder of crc32 over the id's text by 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ByteNetwork:
    """Learn from docs (doc_id, text) and labels (doc_id, label 0 or 1; one row per document).

    The sample is drawn from the labels, which are ids and numbers, before any text is
    read: it is small by its bound, and goes to the texts by broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where("doc_id is not null and label is not null")
    per_label = {int(r["label"]): r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    network = ByteNetwork()
    total = sum(per_label.values())
    if len(per_label) < 2:
        network.constant = per_label.get(1, 0) / total if total else 0.5
        return network
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    share = {k: min(1.0, fit_rows / n) for k, n in per_label.items()}
    drawn = known.where(draw < F.when(F.col("label") == 1, share[1]).otherwise(share[0])).select("doc_id", "label")
    texts = docs.where("text is not null").join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chunk_matrix(t, FIT_CHUNKS).tobytes() for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array(rows, pa.binary())], ["order", "label", "chunks"])

    rows = texts.select(F.xxhash64("doc_id", "text").alias("order"), F.col("label").cast("int").alias("label"), "text") \
        .mapInArrow(run, "order long, label int, chunks binary").collect()
    rows.sort(key=lambda r: (r["order"], bytes(r["chunks"])))
    kinds = np.array([r["label"] for r in rows])
    if len(set(kinds.tolist())) < 2:       # very few rows, or labels without their documents
        network.constant = per_label[1] / total
        return network
    network.train([symbols(np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK)) for r in rows], kinds)
    network.shift = float(np.log(per_label[1] / per_label[0]))
    return network


def predict(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """doc_id, held_out and score of every text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted, learned from the labelled rows not held out."""
    marked = labels.where(~held_out()).groupBy("doc_id").agg(F.avg(label).alias("label")).select(
        "doc_id", (F.col("label") >= 0.5).cast("int").alias("label"))
    network = fit(docs.select("doc_id", "text").where(~held_out()), marked)
    return predict(docs, network).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERY = "op11_quality_classifier"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
