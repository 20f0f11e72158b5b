"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z went to
lower case.  The automaton takes each item in turn (so that no match runs from
one item into the next).  Streaming a text's words through it gives, at every
word, the longest run of words ending there that some item contains.

A window is ``SPAN`` consecutive words of an item; an item with fewer words, but
at least one, is one window.  A word of a text is hit if it lies in an occurrence
of a window: where the match is SPAN words or longer, its last SPAN words are,
and where the match ends in a whole short item, that item's words are.  The items
of a hit are read off the automaton's state for the window.

Words outside the items' vocabulary end every match, so a vectorised lookup of
word hashes first finds the runs of known words that are long enough for any
window; only those, confirmed word by word, are streamed.

The automaton is built on each worker from the items, which are sent out in
shards of at most ``SHARD_WORDS`` words.  One shard is the usual case; a larger
benchmark takes a pass over the texts for each shard, each over the texts as given,
and the hits are merged by document before anything follows from them.

Defined cases: null texts and items have no words.  Null item_ids are left out.
Items of one id and different texts count as one item.  Every row of documents
gives a row, repeated or not.  An empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (alnum_words, ascii_lower, byte_texts, free_name, lay_out, small_batches, table,
                     word_hashes, word_spans)

SPAN = 10
SHARD_WORDS = 200_000
# A text loses its hit spans, or goes as a whole if they cover this share of its words.
COVERAGE = 0.8

_LOWER, _ALNUM = ascii_lower(), alnum_words()


def words_of(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    buf = _LOWER[np.frombuffer(text, np.uint8)]
    begin, end = word_spans(buf, _ALNUM)
    low = buf.tobytes()
    return [low[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


class SuffixAutomaton:
    """All runs of words of the items, with the items of every window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], span: int = SPAN):
        self.span = span
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        # per state: the items whose window (of that many words) the state stands for
        self.windows: dict[int, dict[int, set[str]]] = {}
        self.shortest = min([min(len(w), span) for _, w in items if w], default=0)
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        for item, words in items:
            self._mark(item, words)
        self.vocabulary = {w for _, words in items for w in words}
        self._short = self._short_suffixes()

    def _state(self, length: int, link: int, follow: dict[bytes, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, target: int) -> int:
        """A state of its own for the runs of target that are no longer than at's, plus word."""
        twin = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = twin
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = twin
            at = self.link[at]
        return twin

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            fits = self.length[target] == self.length[at] + 1
            self.link[new] = target if fits else self._split(at, word, target)
        return new

    def _mark(self, item: str, words: list[bytes]) -> None:
        size = min(len(words), self.span)
        if not size:
            return
        for state, length, _ in self.stream(words):
            if length >= size:
                self.windows.setdefault(self.state_of(state, size), {}).setdefault(size, set()).add(item)

    def state_of(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a match that ends in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """After each word: the state, the length of the longest match that ends there, the place."""
        state, length = 0, 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length, place

    def _short_suffixes(self) -> dict[int, list[int]]:
        """Per state, the states on its chain of suffix links that hold windows, itself included."""
        found: dict[int, list[int]] = {-1: []}
        for state in sorted(range(len(self.next)), key=lambda s: self.length[s]):
            up = found[self.link[state]]
            found[state] = [state, *up] if state in self.windows else up
        return found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [from, to) of the windows that occur, and their items."""
        spans, items = [], set()
        for state, length, place in self.stream(words):
            for at in self._short[state]:
                for size, names in self.windows[at].items():
                    if size <= length:
                        items |= names
                        spans.append((place + 1 - size, place + 1))
        return spans, items


class Screen:
    """An automaton with the hashes of its vocabulary, for whole batches of texts."""

    def __init__(self, items: list[tuple[str, bytes]], span: int = SPAN):
        self.automaton = SuffixAutomaton([(name, words_of(text)) for name, text in items], span)
        known = sorted(self.automaton.vocabulary)
        buf, starts = lay_out(known)
        self.hashes = np.unique(word_hashes(buf, starts[:-1], starts[1:] - 1)) if known else np.zeros(0, np.uint64)

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, np.ndarray, set[str], np.ndarray]]:
        """Per text: number of words, which are hit, the items, and the words' byte spans of hit ones."""
        raw, starts = lay_out(texts)
        buf = _LOWER[raw]
        begin, end = word_spans(buf, _ALNUM)
        first = np.searchsorted(begin, starts)
        hit = np.zeros(len(begin), bool)
        items: dict[int, set[str]] = {}
        if len(self.hashes) and len(begin):
            hashes = word_hashes(buf, begin, end)
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            step = np.zeros(len(begin) + 2, np.int8)
            step[1:-1] = self.hashes[at] == hashes
            # runs end where a text ends: the first word of a text starts a new run
            for a, b in self._runs(step, first):
                if b - a < self.automaton.shortest:
                    continue
                spans, found = self.automaton.hits([buf[begin[i]:end[i]].tobytes() for i in range(a, b)])
                if spans:
                    for x, y in spans:
                        hit[a + x:a + y] = True
                    items.setdefault(int(np.searchsorted(first, a, side="right") - 1), set()).update(found)
        out = []
        for i in range(len(texts)):
            own = slice(first[i], first[i + 1])
            out.append((int(first[i + 1] - first[i]), hit[own], items.get(i, set()),
                        np.stack([begin[own], end[own]], axis=1) - starts[i]))
        return out

    def _runs(self, inside: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of known words within one text, as word numbers [from, to)."""
        step = np.diff(inside)
        froms, tos = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        long = tos - froms >= max(1, self.automaton.shortest)
        for a, b in zip(froms[long].tolist(), tos[long].tolist(), strict=True):
            cuts = first[(first > a) & (first < b)] if len(first) < 64 else first[
                np.searchsorted(first, a, side="right"):np.searchsorted(first, b)]
            edges = [a, *dict.fromkeys(cuts.tolist()), b]
            yield from zip(edges[:-1], edges[1:], strict=True)


def shards(items: DataFrame, limit: int = SHARD_WORDS) -> list[list[tuple[str, bytes]]]:
    """The items, read in shards of about ``limit`` words; a shard at a time is on the driver."""
    given = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    given = given.where("item_id is not null and text is not null").distinct()
    words = given.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    count = max(1, int(-(-words // (3 * limit))))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        part = given.where(place == i).collect()
        yield [(r["item_id"], r["text"].encode()) for r in sorted(part)]


_SCREENS: dict[str, Screen] = {}


class _Shared:
    """A broadcast shard with a name of its own, by which a worker keeps its screen."""

    def __init__(self, spark: SparkSession, items: list[tuple[str, bytes]], span: int):
        self.broadcast, self.name = spark.sparkContext.broadcast((items, span)), uuid.uuid4().hex

    def screen(self) -> Screen:
        """Built once per worker, and kept until another shard comes."""
        if self.name not in _SCREENS:
            _SCREENS.clear()
            _SCREENS[self.name] = Screen(*self.broadcast.value)
        return _SCREENS[self.name]


def _scan_batches(shared, out):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            yield out(batch, texts, shared.screen().scan(texts))
    return run


_FOUND = "doc_id long, row long, n_words long, hit array<long>, items array<string>"


def _found_batches(batch, texts, scans) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"), "row": batch.column("row"),
        "n_words": pa.array([s[0] for s in scans], pa.int64()),
        "hit": pa.array([np.flatnonzero(s[1]) for s in scans], pa.list_(pa.int64())),
        "items": pa.array([sorted(s[2]) for s in scans], pa.list_(pa.string()))})


def _row() -> F.Column:
    """Equal texts have equal hits, so (doc_id, this hash of the text) tells rows apart."""
    return F.xxhash64(F.col("text").cast("string"))


def _hits_by_shard(docs: DataFrame, parts: Iterable[list], span: int) -> tuple[DataFrame, int]:
    """doc_id, row, n_words, hit, items and shard: each row of docs once a shard; and the number of shards."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row().alias("row"),
                        F.col("text").cast("string").alias("text"))
    found, count = None, 0
    for part in parts:
        shared = _Shared(docs.sparkSession, part, span)
        own = given.mapInArrow(_scan_batches(shared, _found_batches), _FOUND).withColumn("shard", F.lit(count))
        found = own if found is None else found.unionByName(own)
        count += 1
    return found, count


def _merged(lists: str) -> F.Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists)))).alias(lists)


def contaminated(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings), spans of hit words."""
    small_batches(docs.sparkSession)
    found, count = _hits_by_shard(docs, shards(items), span)
    if count > 1:
        found = (found.groupBy("doc_id", "row", "n_words", "shard")
                 .agg(F.count("*").alias("times"), F.first("hit").alias("hit"), F.first("items").alias("items"))
                 .groupBy("doc_id", "row", "n_words", "times").agg(_merged("hit"), _merged("items"))
                 .withColumn("time", F.explode(F.expr("sequence(1, times)"))))
    return found.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), "items", "hit")


def cleaned(docs: DataFrame, items: DataFrame, span: int = SPAN, coverage: float = COVERAGE) -> DataFrame:
    """docs without hit spans, and without documents of which they cover too large a share.

    All shards are matched against the texts as given; their hits are merged by row
    before anything is cut and the share is taken.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    gone = free_name(docs, "gone")
    schema = T.StructType([*docs.schema, T.StructField(gone, T.BooleanType())])

    def out(batch, texts, scans):
        new, drop = [], []
        for text, (n, hit, _, spans) in zip(texts, scans, strict=True):
            new.append(_without(text, hit, spans) if hit.any() else text)
            drop.append(bool(n and hit.sum() >= coverage * n))
        columns = [pa.array(new, pa.binary()).cast(pa.string()) if c == "text" else batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(drop)], [*names, gone])

    parts = shards(items)
    held = [next(parts), *islice(parts, 1)]
    if len(held) == 1:
        marked = docs.mapInArrow(_scan_batches(_Shared(docs.sparkSession, held[0], span), out), schema)
        return marked.where(~F.col(gone)).select(*names)
    of_id, of_row, hits = (free_name(docs, c) for c in ("id_key", "row_key", "hits"))
    found, _ = _hits_by_shard(docs, chain(held, parts), span)
    merged = (found.where(F.size("hit") > 0).groupBy("doc_id", "row").agg(_merged("hit"))
              .select(F.col("doc_id").alias(of_id), F.col("row").alias(of_row), F.col("hit").alias(hits)))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (_row() == F.col(of_row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            yield out(batch, texts, _as_scans(texts, batch.column(hits)))

    marked = docs.join(merged, same, "left").select(*names, hits).mapInArrow(run, schema)
    return marked.where(~F.col(gone)).select(*names)


def _as_scans(texts: list[bytes | None], hits: pa.Array) -> list[tuple]:
    """Per text what ``Screen.scan`` gives, but for the items, from the numbers of its hit words."""
    raw, starts = lay_out(texts)
    begin, end = word_spans(_LOWER[raw], _ALNUM)
    first = np.searchsorted(begin, starts)
    out = []
    for i, places in enumerate(hits.to_pylist()):
        own = slice(first[i], first[i + 1])
        hit = np.zeros(first[i + 1] - first[i], bool)
        hit[places or []] = True
        out.append((len(hit), hit, set(), np.stack([begin[own], end[own]], axis=1) - starts[i]))
    return out


def _without(text: bytes, hit: np.ndarray, spans: np.ndarray) -> bytes:
    """The text without its runs of hit words; the characters between two hit words go as well."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    out, at = [], 0
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        out.append(text[at:spans[a, 0]])
        at = spans[b - 1, 1]
    return b"".join([*out, text[at:]])


QUERY = "op5_decontaminate"

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"""
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least({SPAN}, len(w)) AS size, unnest(list_transform(
        range(1, len(w) - least({SPAN}, len(w)) + 2), lambda k: w[k:k + least({SPAN}, len(w)) - 1])) AS run
        FROM i WHERE len(w) > 0),
place AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS k,
          unnest(list_transform(range(1, len(w) - size + 2), lambda k: w[k:k + size - 1])) AS run
          FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
hit AS (SELECT doc_id, k, size, item_id FROM place JOIN win USING (size, run)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hit)
      GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
