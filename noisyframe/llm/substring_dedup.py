"""Substring dedup: content-defined chunks of a gear rolling hash, kept once each.

The gear hash runs over the bytes of a text (``h = (h << 1) + gear[byte]``, 32
bits, so that it depends on the last 32 bytes only).  A chunk ends after the word
in which the hash falls under ``2**32 / MEAN_CHUNK``: cuts depend on nearby
content alone, and an insertion moves the cuts around it but no later ones.  A
chunk's digest is a 64-bit hash of its words, whatever the white space between.

Of equal chunks the first one (smallest doc_id, then the earliest in the text)
stays, and so does the first one of equal pairs of neighbouring chunks.  Repeated
chunks form a passage where each pair of neighbours in it repeats as a pair: phrases
that come from different places don't join.  A passage is removed from the text if it
has at least ``MIN_WORDS`` words: short phrases that any two texts may share stay, and
a chance collision of one digest has no effect.  A passage of 50 words lies over about
nine cuts, so that nearly all of it is in whole chunks.

Plan: texts -> arrays of digests (one pass, written to the shared folder), digests
counted with pre-aggregation, then one join back for the rows whose digest repeats; hot
digests are split by the adaptive skew join.  The repeated chunks of each text are written
to the shared folder; pairs are made of these alone, and counted and joined back the same
way.  Places come back to the texts by doc_id, with the words of each chunk, so that only
texts with a passage are cut into chunks again.

Defined cases: null text stays null, with no chunks; an empty text has none.
Rows are told apart by doc_id and a 32-bit hash of the text: repeated rows of one
doc_id and text count as one document.  A null doc_id
takes no part: its text stays as it is.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import (byte_texts, free_name, mix64, small_batches, space_words, table, word_hashes,
                     word_spans)

MEAN_CHUNK = 28
MIN_WORDS = 10

_SPACE = space_words()
# the gear: one random-looking number for each byte, from a rule
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte: sum of gear[byte i back] << i, by doubling."""
    h = _GEAR[buf]
    for span in (1, 2, 4, 8, 16):
        back = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += back
    return h


def chunks(text: bytes, mean: int = MEAN_CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each chunk, its digest and its number of words."""
    buf = np.frombuffer(text, np.uint8)
    begin, end = word_spans(buf, _SPACE)
    none = np.zeros(0, np.int64)
    if not len(begin):
        return none, none, none, none
    fires = np.flatnonzero(gear_hashes(buf) < np.uint32((1 << 32) // mean))
    # a cut after the word that holds, or comes before, the byte where the hash fires
    word = np.searchsorted(begin, fires, side="right") - 1
    last = np.unique(np.append(word[word >= 0], len(begin) - 1))
    first = np.append(0, last[:-1] + 1)
    hashes = word_hashes(buf, begin, end)
    place = np.arange(len(hashes)) - np.repeat(first, last - first + 1)
    mixed = mix64(hashes + mix64(place.astype(np.uint64)))
    digest = mix64(np.add.reduceat(mixed, first) ^ (last - first + 1).astype(np.uint64))
    return begin[first], end[last], digest.view(np.int64), last - first + 1


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for batch in batches:
        found = [chunks(t)[2:] if t else (none, none) for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "copy": batch.column("copy"),
                                          "digests": pa.array([f[0] for f in found], pa.list_(pa.int64())),
                                          "words": pa.array([f[1] for f in found], pa.list_(pa.int32()))})


def _marked(rows: DataFrame, key: str) -> DataFrame:
    """The rows (doc_id, copy, place, key, ...) whose key repeats, with later: not the first one of its key."""
    at = F.struct("doc_id", "copy", "place")
    first = rows.groupBy(key).agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(first, key).select(*rows.columns, (at != F.col("first")).alias("later"))


def _places(later: bool) -> F.Column:
    return F.sort_array(F.collect_set(F.when(F.col("later"), F.col("place")) if later else F.col("place")))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, copy, n_chunks, and sorted places of chunks, or pairs of a chunk and the next one.

    repeats: chunks kept elsewhere, shared: all that repeat, shared_words: their words;
    repeat_pairs and shared_pairs: the places of pairs.
    """
    small_batches(docs.sparkSession)
    digests = cut_lineage(docs.mapInArrow(
        _digest_batches, "doc_id long, copy int, digests array<long>, words array<int>"))
    rows = digests.select("doc_id", "copy", F.posexplode(F.arrays_zip("digests", "words")).alias("place", "chunk")).select(
        "doc_id", "copy", "place", F.col("chunk.digests").alias("digest"), F.col("chunk.words").alias("words"))
    met = cut_lineage(_marked(rows, "digest").groupBy("doc_id", "copy").agg(
        F.sort_array(F.collect_set(F.struct("place", "digest", "later", "words"))).alias("met")))
    # a pair can only repeat where both of its chunks do
    behind = F.size("met") - 1
    pairs = F.zip_with(F.slice("met", 1, behind), F.slice("met", 2, behind), lambda x, y: F.struct(
        x["place"].alias("place"),
        F.when(y["place"] == x["place"] + 1, F.xxhash64(x["digest"], y["digest"])).alias("pair")))
    paired = met.select("doc_id", "copy", F.inline(pairs)).where("pair is not null")
    found = _marked(paired, "pair").groupBy("doc_id", "copy").agg(
        _places(True).alias("repeat_pairs"), _places(False).alias("shared_pairs"))
    sizes = digests.groupBy("doc_id", "copy").agg(F.max(F.size("digests")).cast("long").alias("n_chunks"))
    return sizes.join(met, ["doc_id", "copy"], "left").join(found, ["doc_id", "copy"], "left").select(
        "doc_id", "copy", "n_chunks", F.expr("transform(filter(met, m -> m.later), m -> m.place)").alias("repeats"),
        F.col("met.place").alias("shared"), F.col("met.words").alias("shared_words"), "repeat_pairs", "shared_pairs")


def runs(places: np.ndarray, words: np.ndarray, pairs: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Runs of the given chunk places, over the given pairs, with enough words: first place, last place, words."""
    if not len(places):
        return []
    breaks = np.flatnonzero((np.diff(places) > 1) | ~np.isin(places[:-1], pairs))
    from_, to = np.append(0, breaks + 1), np.append(breaks, len(places) - 1)
    total = np.append(0, np.cumsum(words))
    return [(int(places[a]), int(places[b]), int(total[b + 1] - total[a]))
            for a, b in zip(from_, to, strict=True) if total[b + 1] - total[a] >= min_words]


def _rewrite(text: bytes | None, repeats: list[int], shared: list[int], words: list[int], repeat_pairs: list[int],
             shared_pairs: list[int]) -> tuple[bytes | None, list, int, int]:
    """New text, removed spans (in characters), words removed, words in shared passages."""
    if not text or not shared:
        return text, [], 0, 0
    places, words = np.asarray(shared, np.int64), np.asarray(words, np.int64)
    seen = runs(places, words, np.asarray(shared_pairs, np.int64))
    later = np.isin(places, np.asarray(repeats, np.int64))
    cut = runs(places[later], words[later], np.asarray(repeat_pairs, np.int64))
    if not cut:
        return text, [], 0, sum(x[2] for x in seen)
    begin, end, _, _ = chunks(text)
    spans, left, at, chars = [], [], 0, 0
    for first, last, _ in cut:
        a, b = int(begin[first]), int(end[last])
        left.append(text[at:a])
        start = chars + len(left[-1].decode("utf-8", "replace"))
        chars = start + len(text[a:b].decode("utf-8", "replace"))
        spans.append({"start": start, "end": chars})
        at = b
    left.append(text[at:])
    # the white space on both sides of a removed passage becomes that on its left
    out = left[0]
    for piece in left[1:]:
        out += piece.lstrip(_BLANK) if not out or out[-1:] in _BLANK else piece
    return out, spans, sum(x[2] for x in cut), sum(x[2] for x in seen)


_BLANK = b" \t\n\v\f\r"
_OUT = [("new_text", T.StringType()),
        ("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))),
        ("n_chunks", T.LongType()), ("removed_words", T.LongType()), ("shared_words", T.LongType())]


def deduplicated(docs: DataFrame) -> DataFrame:
    """All columns of docs, plus new_text, spans, n_chunks, removed_words, shared_words.

    The added columns get a leading underscore for each name that docs has already;
    use ``added(docs)`` for their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names = added(docs)
    copy = free_name(docs, "copy")
    given_names = ("n_chunks", "repeats", "shared", "shared_words", "repeat_pairs", "shared_pairs")
    places = {n: free_name(docs, f"found_{n}") for n in given_names}
    given = docs.withColumn(copy, F.hash(F.col("text").cast("string")))
    keyed = given.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(copy).alias("copy"),
                         F.col("text").cast("string").alias("text")).where("doc_id is not null")
    found = repeated_chunks(keyed).select(
        F.col("doc_id"), F.col("copy").alias(copy), *(F.col(n).alias(own) for n, own in places.items()))
    joined = given.join(found, ["doc_id", copy], "left")
    kept = [f for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chunks, *found = (batch.column(c) for c in places.values())
            rows = [_rewrite(t, *(x or [] for x in found)) for t, *found in zip(
                byte_texts(batch.column("text")), *(c.to_pylist() for c in found), strict=True)]
            columns = [pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()),
                       pa.array([r[1] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                       pc.fill_null(n_chunks, 0), *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns],
                                             [*(f.name for f in kept), *names])

    schema = T.StructType(list(kept))
    for name, (_, kind) in zip(names, _OUT, strict=True):
        schema = schema.add(name, kind)
    return joined.select(*docs.columns, *places.values()).mapInArrow(run, schema)


def added(docs: DataFrame) -> list[str]:
    """Names of the added columns: new_text, spans, n_chunks, removed_words, shared_words."""
    return [free_name(docs, n) for n, _ in _OUT]


QUERY = "op4_substring_dedup"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).drop("text").withColumnRenamed("new_text", "text")
