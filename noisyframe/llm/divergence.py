"""Source divergence audit: how far the sources of a language differ in their words.

Terms are counted shard by shard, a shard being some megabytes of texts in one byte
buffer.  Pointers to the starts of all terms are sorted by a multikey quicksort whose
characters are eight bytes long: pointers are sorted by their first character, and only
slices of equal ones that go on are sorted by the next.  Runs of equal terms then give,
for each group (lang, source) of the shard, occurrences and documents; the sort is
stable and documents lie in the order of their groups, so that both are differences of
positions.  A shard gives one row per group and term, and Spark adds them up.

A language keeps the terms in at least ``min_docs`` of its documents (rows of the table).
A group's smoothed rate of a term, in billionths, is
``1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))`` with V kept terms and N their
occurrences; for the language as a whole likewise.  Integers and decimals only: exact.

Plan: counts by (lang, source, term) with pre-aggregated shards, written once; kept terms
by one more aggregation of it.  Distances between sources are sums over terms of
``|p - q|``.  A term that neither source has contributes ``|p0 - q0|``, of the rates of
count 0, so that a distance is ``V * |p0 - q0|`` plus what the occurring terms add to
that.  Terms are dealt over tiles of about ``TILE_TERMS`` by hash and sources over blocks
of ``TILE_SOURCES``; a tile of two blocks is one small dense matrix per block, which
bounds what a task holds, and Spark adds the tiles up.  Its rows are never paired by
term.  Top terms are ranked by a window with a limit, which Spark applies before the
shuffle too.

Defined cases: null text, lang or source is ''.  Groups without any term take part with
count 0, in V and in all parts.  A language with one source has no ``pair`` rows, a
language without kept terms gives distances of 0 and no ``term`` rows.  Repeated rows
count as often as they are there; doc_id isn't read.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ascii_lower, byte_texts, lay_out, small_batches, table, word_spans

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
# bytes of text that a shard holds at least, but for a task's last one
SHARD_BYTES = 6 << 20
TILE_TERMS = 512
TILE_SOURCES = 256
# rows of one Arrow batch on the way back
OUT_ROWS = 50_000
CHARACTER = 8


def term_bytes() -> np.ndarray:
    """Byte table of the terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, after A-Z became a-z."""
    t = np.zeros(256, dtype=bool)
    t[0x61:0x7B] = t[0x80:] = True
    return t


_LOWER, _TERM = ascii_lower(), term_bytes()


def _characters(windows: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each pointer as one number, zeros behind the term's end."""
    key = windows[np.minimum(at, len(windows) - 1)].astype(np.uint64)
    behind = (8 * (CHARACTER - np.clip(left, 0, CHARACTER))).astype(np.uint64)
    gone = behind >= 64
    behind[gone] = 0
    key = key >> behind << behind
    key[gone] = 0
    return key


def sort_pointers(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the terms by their bytes, and the first position of each run of equal ones."""
    count = len(begin)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.append(buf, np.zeros(CHARACTER, np.uint8))
    windows = np.ndarray((len(buf) + 1,), dtype=">u8", buffer=raw.tobytes(), strides=(1,))
    size = end - begin
    key = _characters(windows, begin, size)
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.append(True, key[1:] != key[:-1])
    depth = 0
    while True:
        depth += CHARACTER
        # slices with equal characters so far in which some term goes on
        slice_of = np.cumsum(fresh) - 1
        goes_on = size[order] > depth
        many = np.bincount(slice_of) > 1
        some = np.zeros(len(many), bool)
        some[slice_of[goes_on]] = True
        at = np.flatnonzero((many & some)[slice_of])
        if not len(at):
            return order, np.flatnonzero(fresh)
        rows = order[at]
        key = _characters(windows, begin[rows] + depth, size[rows] - depth)
        by = np.lexsort((key, slice_of[at]))
        order[at], key = rows[by], key[by]
        fresh[at[1:]] |= key[1:] != key[:-1]


def count_shard(texts: list[bytes | None], groups: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a shard with their group, documents and occurrences; groups are ids of the texts."""
    rank = np.argsort(groups, kind="stable")
    raw, starts = lay_out([texts[i] for i in rank])
    buf = _LOWER[raw]
    begin, end = word_spans(buf, _TERM)
    order, first = sort_pointers(buf, begin, end)
    if not len(order):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.string()), none, none, none
    doc = (np.searchsorted(starts, begin, side="right") - 1)[order]
    group = groups[rank][doc]
    new_run = np.zeros(len(order), bool)
    new_run[first] = True
    new_part = new_run.copy()
    new_part[1:] |= group[1:] != group[:-1]
    new_doc = new_part.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    part = np.flatnonzero(new_part)
    n = np.diff(np.append(part, len(order)))
    n_docs = np.add.reduceat(new_doc.astype(np.int64), part)
    return _strings(buf, begin[order[part]], end[order[part]]), group[part], n_docs, n


def _strings(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """An Arrow string array of spans of the buffer."""
    size = end - begin
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[at])))


def _shards(shard_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, keys, held = [], [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        names = sorted(set(keys))
        ids = {k: i for i, k in enumerate(names)}
        term, group, n_docs, n = count_shard(texts, np.fromiter((ids[k] for k in keys), np.int64, len(keys)))
        lang, source = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        for a in range(0, len(term), OUT_ROWS):
            part = slice(a, a + OUT_ROWS)
            where = pa.array(group[part])
            yield pa.RecordBatch.from_arrays(
                [lang.take(where), source.take(where), term[part], pa.array(n_docs[part]), pa.array(n[part])],
                ["lang", "source", "term", "n_docs", "n"])

    for batch in batches:
        found = byte_texts(batch.column("text"))
        texts += found
        keys += zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        held += sum(len(t) for t in found if t)
        if held >= shard_bytes:
            yield from rows()
            texts, keys, held = [], [], 0
    if texts:
        yield from rows()


def _worker(run: Callable, size: int) -> Callable:
    """The function with a size fixed on the driver."""
    return lambda rows: run(size, rows)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, documents with the term (n_docs) and occurrences (n)."""
    small_batches(docs.sparkSession)
    return _plain(docs).mapInArrow(
        _worker(_shards, SHARD_BYTES), "lang string, source string, term string, n_docs long, n long").groupBy(
        "lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))


def _rate(count: F.Column, total: F.Column, terms: F.Column) -> F.Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), in decimals, as longs would overflow."""
    scaled = (count + F.lit(SMOOTH)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", scaled, (total + F.lit(SMOOTH) * terms).cast("decimal(20,0)"))


def _tile(sources: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over one tile's terms of |p - q| - |p0 - q0| for the sources of its two blocks.

    Each source of the blocks has one row without a term, and one for each term that it has.
    """
    block = rows["place"].to_numpy() // sources
    term, names = pd.factorize(rows["term"])
    sides = []
    for side in (rows["block_a"].iat[0], rows["block_b"].iat[0]):
        mine = block == side
        place, at = np.unique(rows["place"].to_numpy()[mine], return_inverse=True)
        zero = np.zeros(len(place), np.int64)
        zero[at] = rows["p0"].to_numpy()[mine]
        p = np.repeat(zero[:, None], len(names), axis=1)
        has = term[mine] >= 0
        p[at[has], term[mine][has]] = rows["p"].to_numpy()[mine][has].astype(np.int64)
        sides.append((place, zero, p))
    (a, a0, p_a), (b, b0, p_b) = sides
    more = np.stack([np.abs(p_b - p).sum(axis=1) - len(names) * np.abs(b0 - p0) for p, p0 in zip(p_a, a0, strict=True)])
    left, right, more = np.repeat(a, len(b)), np.tile(b, len(a)), more.ravel()
    if block.min() != block.max():
        left, right, more = np.append(left, right), np.append(right, left), np.append(more, more)
    return pd.DataFrame({"lang": rows["lang"].iat[0], "place_a": left, "place_b": right, "more": more})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources, and each source's own terms."""
    counts = cut_lineage(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n_lang")).where(
        F.col("n_docs") >= min_docs).drop("n_docs")
    # occurrences of the kept terms in each group
    rows = cut_lineage(counts.drop("n_docs").join(kept, ["lang", "term"]))
    langs = rows.select("lang", "term", "n_lang").distinct().groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = cut_lineage(
        _plain(docs).select("lang", "source").distinct().join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left").na.fill(0, ["terms", "total_lang", "total"])
        .withColumn("place", place).withColumn("places", F.count("*").over(Window.partitionBy("lang")))
        .withColumn("p0", F.when(F.col("terms") > 0, _rate(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)))
    rated = rows.join(groups, ["lang", "source"]).withColumn("p", _rate(F.col("n"), F.col("total"), F.col("terms")))
    return _pairs(rated, groups).unionByName(_terms(rated, top))


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    tiles = F.ceil(F.col("terms") / TILE_TERMS).cast("long")
    blocks = F.floor((F.col("places") - 1) / TILE_SOURCES).cast("long")
    keys = ["lang", "place", "p0", "places"]
    heads = groups.where("terms > 0").select(
        *keys, F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"), F.lit(None).cast("string").alias("term"),
        F.lit(None).cast("long").alias("p"))
    cells = rated.select(*keys, F.pmod(F.xxhash64("term"), tiles).alias("tile"), "term", "p")
    block = F.floor(F.col("place") / TILE_SOURCES)
    dealt = heads.unionByName(cells).withColumn("other", F.explode(F.sequence(F.lit(0), blocks))).select(
        "lang", "tile", F.least(block, "other").alias("block_a"), F.greatest(block, "other").alias("block_b"),
        "place", "p0", "term", "p")
    more = dealt.groupBy("lang", "tile", "block_a", "block_b").applyInPandas(
        _worker(_tile, TILE_SOURCES), "lang string, place_a long, place_b long, more long").groupBy("lang", "place_a", "place_b").agg(
        F.sum("more").alias("more"))
    one, other = (groups.select("lang", F.col("source").alias(s), F.col("place").alias(f"place_{x}"),
                                F.col("p0").alias(f"p0_{x}"), *(["terms"] if x == "a" else []))
                  for s, x in (("source", "a"), ("item", "b")))
    value = F.col("terms") * F.abs(F.col("p0_a") - F.col("p0_b")) + F.coalesce(F.col("more"), F.lit(0))
    return _ranked(one.join(other, "lang").where("place_a <> place_b").join(
        more, ["lang", "place_a", "place_b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))


def _terms(rated: DataFrame, top: int) -> DataFrame:
    q = _rate(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    return _ranked(rated.withColumn("q", q).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"))).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


QUERY = "op13_source_divergence"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, kept.term, kept.n AS n_lang, coalesce(c.n, 0) AS n
    FROM g JOIN kept USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
rates AS (SELECT lang, source, term, n,
    1 + ({SCALE}::HUGEINT * (n + {SMOOTH})) // (sum(n) OVER (PARTITION BY lang, source) + {SMOOTH} * count(*) OVER (PARTITION BY lang, source)) AS p,
    1 + ({SCALE}::HUGEINT * (n_lang + {SMOOTH})) // (sum(n_lang) OVER (PARTITION BY lang, source) + {SMOOTH} * count(*) OVER (PARTITION BY lang, source)) AS q
    FROM cells),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM rates WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
