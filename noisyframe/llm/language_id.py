"""Language ID by language-bitmask n-gram filters.

A filter is a Bloom filter whose slots hold one bit per language (bit-sliced:
slot s of language l is bit l of word s), so that one lookup of an n-gram, the
AND over its slots, returns the set of all languages that contain it.  A text's
n-grams are looked up in one go, the bits are counted per language, and each
count is corrected for the false positives that the filter's fill predicts:

    corrected = (count - n * fp) / (1 - fp),     fp = fill ** hashes

The language with the largest corrected count wins; ties go to the first in
sorted order.  The score is the winner's share of all corrected counts.

Fit: byte n-grams of labelled texts are counted in Spark (pre-aggregated per
Arrow batch); a language's set is its ``ngrams_per_language`` most frequent
n-grams that are at least ``contrast`` times as frequent in it as over all
languages together.  The fit reads a bounded sample of labelled rows (about
``fit_rows`` documents of each language, chosen by a hash of the id); everything
else covers all rows.  Sizes that reach the driver and the workers:
``ngrams_per_language`` numbers per language, and ``slots`` words per 64
languages (2 MB at 2**18).

Defined cases: null text, empty text or text without a letter gives ``und`` and
score 0; a text with letters but no known n-gram gives the most frequent learned
language and score 0; with nothing to learn from, every text gives ``und``.
Labels of null documents ids, null labels and null texts are not learned from.
Repeated rows are predicted alike, columns beyond the named ones are untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, free_name, lay_out, mix64, small_batches, table

NGRAM = 5
SLOTS = 1 << 18
HASHES = 2
NGRAMS_PER_LANGUAGE = 6000
CONTRAST = 1.5
FIT_ROWS = 4000
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
# Probability that a text of unknown n-grams is taken for one in a language.
NOISE = 0.01


def _fold_table() -> np.ndarray:
    """Letters in lower case, bytes of other scripts as they are, the rest a space."""
    t = np.full(256, 0x20, np.uint64)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


def ngrams(buf: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """The n-gram that ends at every byte, as an integer; 0 before the n-th byte
    and where two spaces meet inside it."""
    folded = _fold_table()[buf]
    out = np.zeros(len(buf), np.uint64)
    if len(buf) < n:
        return out
    grams = np.zeros(len(buf) - n + 1, np.uint64)
    blank = folded == 0x20
    double = blank[1:] & blank[:-1]
    bad = np.zeros(len(grams), bool)
    for i in range(n):
        grams = (grams << np.uint64(8)) | folded[i:len(folded) - n + 1 + i]
        if i:
            bad |= double[i - 1:len(double) - n + 1 + i]
    grams[bad] = 0
    out[n - 1:] = grams
    return out


def _batch_ngrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of every text (framed by spaces) and the text each belongs to."""
    framed = [b" " + t + b" " if t else None for t in texts]
    buf, starts = lay_out(framed)
    grams = ngrams(buf)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = np.arange(len(buf)) - starts[owner] >= NGRAM - 1
    use = inside & (grams != 0)
    return grams[use], owner[use]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = byte_texts(batch.column("text"))
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            grams, times = np.unique(_batch_ngrams(own)[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(grams), pa.string()),
                "gram": pa.array(grams.view(np.int64)), "n": pa.array(times.astype(np.int64))})


class NgramFilter:
    """Slots of language bits, with the false-positive rate of each language."""

    def __init__(self, langs: list[str], sets: dict[str, np.ndarray], default: str,
                 slots: int = SLOTS, hashes: int = HASHES):
        self.langs, self.default, self.slots, self.hashes = langs, default, slots, hashes
        words = max(1, -(-len(langs) // 64))
        self.bits = np.zeros((words, slots), np.uint64)
        for k, lang in enumerate(langs):
            for at in self._slots(sets[lang]):
                np.bitwise_or.at(self.bits[k // 64], at, np.uint64(1) << np.uint64(k % 64))
        fill = np.array([np.count_nonzero(self.bits[k // 64] >> np.uint64(k % 64) & np.uint64(1))
                         for k in range(len(langs))]) / slots
        self.false_rate = fill ** hashes

    def _slots(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        h = mix64(grams.astype(np.uint64))
        for i in range(self.hashes):
            yield ((h >> np.uint64(i * (64 // self.hashes))) % np.uint64(self.slots)).astype(np.int64)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram, one row of bits per 64 languages."""
        found = None
        for at in self._slots(grams):
            found = self.bits[:, at] if found is None else found & self.bits[:, at]
        return found

    def counts(self, texts: list[bytes | None]) -> np.ndarray:
        """Corrected counts, a row per text and a column per language."""
        grams, owner = _batch_ngrams(texts)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        masks = self.masks(grams)
        known = np.flatnonzero(masks.any(axis=0))
        masks, owner = masks[:, known], owner[known]
        out = np.zeros((len(texts), len(self.langs)))
        for k, fp in enumerate(self.false_rate):
            hit = (masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)).astype(bool)
            seen = np.bincount(owner[hit], minlength=len(texts))
            out[:, k] = np.maximum(0.0, (seen - total * fp) / (1 - fp)) if fp < 1 else 0.0
        return out

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts = self.counts(texts)
        best, total = counts.argmax(axis=1), counts.sum(axis=1)
        score = np.divide(counts.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
        names = []
        for i, t in enumerate(texts):
            if not t or not LETTER.search(t.decode("utf-8", "replace")):
                names.append(UNKNOWN)
                score[i] = 0.0
            else:
                names.append(self.langs[best[i]] if total[i] > 0 else self.default)
        return names, score


    def recognised(self, texts: list[bytes | None]) -> np.ndarray:
        """Texts with a letter and, in some language, more n-grams than false positives explain.

        Distinct n-grams, as a repeated false positive is one.  By Chernoff's bound
        ``seen`` or more of ``n`` are false positives with a probability of at most
        exp(-n * KL(seen / n, fp)); over all languages it may be ``NOISE``.  If nothing
        was learned, a letter is all that is asked for.
        """
        letter = np.array([bool(t and LETTER.search(t.decode("utf-8", "replace"))) for t in texts], bool)
        if not self.bits.any():
            return letter
        grams, owner = _batch_ngrams(texts)
        at = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in np.flatnonzero(letter):
            masks = self.masks(np.unique(grams[at[i]:at[i + 1]]))
            n = masks.shape[1]
            masks = masks[:, masks.any(axis=0)]
            seen = np.array([np.count_nonzero(masks[k // 64] >> np.uint64(k % 64) & np.uint64(1))
                             for k in range(len(self.langs))])
            letter[i] = bool((_evidence(seen, n, self.false_rate) >= np.log(len(self.langs) / NOISE)).any())
        return letter


def _evidence(seen: np.ndarray, n: int, rate: np.ndarray) -> np.ndarray:
    """n * KL(seen / n, rate) where seen / n is above the rate, else 0."""
    share = seen / max(1, n)
    above = (share > rate) & (rate > 0)
    x, p = np.where(above, share, 0.5), np.where(above, rate, 0.5)
    return np.where(above, n * (x * np.log(x / p) + (1 - x) * np.log(np.maximum(1 - x, 1e-300) / (1 - p))), 0.0)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS,
        ngrams_per_language: int = NGRAMS_PER_LANGUAGE, contrast: float = CONTRAST) -> NgramFilter:
    """Learn a filter from columns doc_id, text and lang."""
    spark = labelled.sparkSession
    small_batches(spark)
    known = labelled.where("doc_id is not null and text is not null and lang is not null")
    per_lang = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n"))
                .orderBy("lang").limit(4097).collect()}
    if len(per_lang) > 4096:
        raise ValueError("more than 4,096 language labels: no bounded filter can hold them")
    if not per_lang:
        return NgramFilter([], {}, UNKNOWN)
    share = F.create_map(*[F.lit(x) for k, n in per_lang.items() for x in (k, min(1.0, fit_rows / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    counts = (known.where(draw < share[F.col("lang")]).select("lang", "text")
              .mapInArrow(_count_batches, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    in_lang = Window.partitionBy("lang")
    # at most fit_rows texts a language went in, so these windows are bounded
    rate = counts.withColumn("rate", F.col("n") / F.sum("n").over(in_lang))
    mean = F.avg("rate").over(Window.partitionBy("gram")) * F.count("*").over(
        Window.partitionBy("gram")) / F.lit(float(len(per_lang)))
    kept = (rate.withColumn("mean", mean).where(F.col("rate") >= F.least(F.lit(contrast), F.lit(
        float(len(per_lang)))) * F.col("mean") * (1 - 1e-9))
            .withColumn("place", F.row_number().over(in_lang.orderBy(F.desc("n"), "gram")))
            .where(F.col("place") <= ngrams_per_language).select("lang", "gram").collect())
    langs = sorted(per_lang)
    sets = {x: np.array([r["gram"] for r in kept if r["lang"] == x], np.int64).view(np.uint64) for x in langs}
    return NgramFilter(langs, sets, max(langs, key=lambda x: (per_lang[x], x)))


def predict(docs: DataFrame, model: NgramFilter, keep_text: bool = False) -> DataFrame:
    """The columns of docs (text only if asked for), then ``predicted(docs)``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if keep_text or f.name != "text"]
    names, new = [f.name for f in kept], predicted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, score = shared.value.predict(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(langs, pa.string()), pa.array(score)],
                [*names, *new])

    return docs.mapInArrow(run, T.StructType(list(kept)).add(new[0], "string").add(new[1], "double"))


def in_a_language(docs: DataFrame, model: NgramFilter) -> DataFrame:
    """The rows of docs whose texts the model recognises as some language or languages."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.recognised(byte_texts(batch.column("text"))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predicted(docs: DataFrame) -> list[str]:
    """Names of the added columns: lang_pred and score, unless docs has such columns."""
    return [free_name(docs, "lang_pred"), free_name(docs, "score")]


def held_out() -> F.Column:
    """The remainder of crc32 over the id's text is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows not held out."""
    source = docs if labelled is None else labelled
    model = fit(source.select("doc_id", "text", "lang").where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string")), model)


QUERY = "op8_language_id"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
