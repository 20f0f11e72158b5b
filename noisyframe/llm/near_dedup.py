"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct shingles of five words (fewer words: the
whole sequence as one shingle; no word: the empty set, linked with nothing).
Two documents are linked if 100 * |A and B| >= link * |A or B|; link is 85 unless
given.  What follows from the 85 below follows from the link that is given.

1. One pass over the texts gives each document the size of its set, a digest of
   the set and the ``k`` smallest hashes of it: its sketch.  Equal sets fall into
   one class, whose smallest doc_id stands for it from here on; copies are never
   paired with each other.
2. Inverted lists of the retained values.  A link needs ``need(n)`` values that
   both sketches retain (see there), so of each sketch's values only the rarest
   ``size - need + 1`` enter the lists: two sketches that agree in ``need`` values
   must meet in one of them.  Values that a single class retains drop out, and a
   passage in very many documents is among the rarest only where it is most of
   the document.
3. Pairs in two rounds.  A round of stars pairs each member of a list with the
   list's first member: linear in the lists.  Each class keeps the hub it resembles
   most; if that is a link, the hub is its parent, and the trees so made become
   components.  The second round pairs members of a list whose components still
   differ; a large group of near copies is one component by then, so that its
   members don't meet again.  Sizes outside 85 : 100 are never paired.
   A list whose members would be in ``MANY`` or more pairs each, over components that
   differ, is the mark of a passage that fills most of the sketches of texts which are
   not alike, be it many single texts or a few large families of near copies.  Its members
   are paired by their full sets instead, without loss: each enters the lists of its
   rarest shingles (15 of 100 to be found by larger sets, of these 8 of 100 to find
   smaller ones), so that only texts meet which have hardly anything but common passages.
   Families that are less than a link apart by their common part alone meet there
   member by member: the definition leaves these pairs to be looked at.
4. A pair stays if ``least_common`` values of the union's sketch (the k smallest of
   both sketches together) are in both; the rest is verified on the full sets,
   computed anew from both texts.
5. Components by pointer jumping over the trees, then by alternating stars over
   the links between trees, in Spark, each step written to the shared folder.

Losses: a link is lost only if its union sketch has fewer common values.  For a
similarity of exactly 0.85 their number among k = 64 is about binomial(64, 0.85);
P(less than 40) is about 4e-6, and ``least_common`` holds any other link to
``LOSS`` as well.  Sets of up to 54 shingles (51 at 0.80) are compared without loss
(both sketches hold the full sets).

Defined cases: null or empty text: n_shingles 0, its own component, kept.  Rows
with a null doc_id take part in nothing: component null, kept.  Repeated rows of
one doc_id and text give one row; rows of one doc_id with different texts give a
row each, and their links count for that id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import (ascii_lower, byte_texts, lay_out, mix64, small_batches, space_words, table,
                     word_hashes, word_spans)

WORDS = 5
LINK_INTERSECTION, LINK_UNION = 100, 85  # op2's rule: 100 * intersection >= 85 * union
SKETCH = 64
LOSS = 5e-6  # of the links of the least similarity, at most this share is lost
MANY = 32

_LOWER, _SPACE = ascii_lower(), space_words()
_PLACES = mix64(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (signed 64 bits) of every text."""
    buf, starts = lay_out(texts)
    buf = _LOWER[buf]
    begin, end = word_spans(buf, _SPACE)
    hashes = word_hashes(buf, begin, end)
    first = np.searchsorted(begin, starts)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        rolled += hashes[i:i + len(rolled)] * _PLACES[i]
    rolled = mix64(rolled).view(np.int64)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            whole = xxhash.xxh64_intdigest(hashes[a:b].tobytes(), seed=int(b - a))
            out.append(np.array([whole], np.uint64).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _sketch_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                "sketch": pa.array([s[:k] for s in sets], pa.list_(pa.int64()))})
    return run


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, sketch (the k smallest hashes, sorted)."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        _sketch_batches(k), "doc_id long, text_hash long, n_shingles long, digest binary, sketch array<long>")


def least_common(link: int = LINK_UNION, k: int = SKETCH) -> int:
    """Values of a union's sketch that are in both sets, but for ``LOSS`` of the links."""
    p, lost = link / LINK_INTERSECTION, 0.0
    for common in range(k + 1):
        lost += comb(k, common) * p ** common * (1 - p) ** (k - common)
        if lost > LOSS:
            return common
    return k


def need(n: F.Column, k: int = SKETCH, link: int = LINK_UNION) -> F.Column:
    """Values that the sketch of a set of n must have in common with that of any linked set.

    Up to link / 100 * k both sketches are the full sets, and the intersection is at
    least link / 100 * n.  Above, the common values of the union sketch are in both.
    """
    exact = F.ceil(n * link / LINK_INTERSECTION)
    return F.when(n <= k * link // LINK_INTERSECTION, exact).otherwise(F.lit(least_common(link, k))).cast("int")


def inverted_lists(classes: DataFrame, k: int = SKETCH, link: int = LINK_UNION) -> DataFrame:
    """value, id, n: the rarest retained values of each class that another one retains too."""
    postings = classes.select("id", "n", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    own = (postings.join(shared, "value").groupBy("id", "n")
           .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("common")))
    size = F.least(F.col("n"), F.lit(k))
    alone = size - F.size("common")          # values that no other class retains come first
    enter = size - need(F.col("n"), k, link) + 1 - alone
    return (own.withColumn("enter", enter.cast("int")).where("enter > 0")
            .select("id", "n", F.explode(F.expr("slice(common, 1, enter)")).alias("c"))
            .select(F.col("c.value").alias("value"), "id", "n"))


def _similar_sizes(a: str, b: str, link: int) -> F.Column:
    return (F.least(a, b) * LINK_INTERSECTION) >= (F.greatest(a, b) * link)


def star_pairs(lists: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """Pairs (a: first member of a list, b: another member) of similar sizes."""
    hub = lists.groupBy("value").agg(F.min(F.struct("id", "n")).alias("hub"))
    return (lists.join(hub, "value").where(F.col("id") != F.col("hub.id")).where(_similar_sizes("n", "hub.n", link))
            .select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct())


def open_lists(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists with few pairs between components, and the ids in lists of many; lists of one component are done."""
    blocks = lists.groupBy("value", "component").agg(F.count("*").cast("double").alias("m"))
    width = (blocks.groupBy("value").agg(F.count("*").alias("width"), F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
             .where("width > 1").select("value", (F.col("m") * F.col("m") - F.col("own") >= MANY * F.col("m")).alias("many")))
    members = cut_lineage(lists.join(width, "value"))
    return members.where(~F.col("many")).drop("many"), members.where("many").select("id").distinct()


def cross_pairs(members: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """Pairs (a, b) of members of one list whose components differ and whose sizes allow a link.

    For lists of few components: these are paired first, then their members, so that
    members of one component are never compared.
    """
    blocks = members.select("value", "component").distinct()
    other = blocks.withColumnRenamed("component", "component2")
    block_pairs = blocks.join(other, "value").where("component < component2")
    right = members.select("value", F.col("component").alias("component2"), F.col("id").alias("id2"),
                           F.col("n").alias("n2"))
    return (block_pairs.join(members, ["value", "component"]).join(right, ["value", "component2"])
            .where(_similar_sizes("n", "n2", link)).select(*_ordered_ids()).distinct())


def set_pairs(members: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """Pairs (a, b) of members of one list of full sets (see ``full_lists``).

    The smaller set (of equal ones the smaller id) must be one that finds, and the two
    must still be able to have enough in common after the places where they meet.  At
    the first value that they share nothing before it is common, so no link is lost.
    Lists are paired component by component first, under the same conditions at their best
    for any members (for single texts they are the conditions themselves), so that what can't
    be a link isn't made and members of one component never meet.
    """
    most = F.max(F.col("n") - F.col("pos"))
    block = [F.min("n").alias("low"), F.max("n").alias("high"), most.alias("rest"), F.min("id").alias("first"), F.max("id").alias("last")]
    left = members.where("finds").groupBy("value", "component").agg(*block)
    right = members.groupBy("value", "component").agg(*block).withColumnsRenamed(
        {c: f"{c}2" for c in ("component", "low", "high", "rest", "first", "last")})
    can = ((F.least("rest", "rest2") + 1) * (LINK_INTERSECTION + link) >= (F.col("low") + F.col("low2")) * link) \
        & ((F.col("low") < F.col("high2")) | ((F.col("low") == F.col("high2")) & (F.col("first") < F.col("last2")))) \
        & (F.col("high2") * LINK_INTERSECTION >= F.col("low") * link) & (F.col("high") * LINK_INTERSECTION >= F.col("low2") * link)
    blocks = left.join(right, "value").where((F.col("component") != F.col("component2")) & can).select("value", "component", "component2")
    other = members.select("value", F.col("component").alias("component2"), F.col("id").alias("id2"),
                           F.col("n").alias("n2"), F.col("pos").alias("pos2"))
    rest = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) + 1
    enough = rest * (LINK_INTERSECTION + link) >= (F.col("n") + F.col("n2")) * link
    smaller = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("id") < F.col("id2")))
    return (blocks.join(members.where("finds"), ["value", "component"]).join(other, ["value", "component2"])
            .where(smaller & enough & _similar_sizes("n", "n2", link)).select(*_ordered_ids()).distinct())


def _ordered_ids() -> list[F.Column]:
    return [F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")]


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({
            "id": batch.column("id"),
            "shingles": pa.array(shingle_sets(byte_texts(batch.column("text"))), pa.list_(pa.int64()))})


def full_lists(texts: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """value, id, n, finds, pos: lists of the rarest shingles of the full sets of texts (id, text).

    Linked sets have link / 100 of the larger one in common, and 2 * link / (100 + link)
    of the smaller one (0.85 and 34 / 37), so that all but so many of a set's shingles must hold one of the other's.
    """
    rows = texts.mapInArrow(_set_batches, "id long, shingles array<long>").select(
        "id", F.size("shingles").alias("n"), F.explode("shingles").alias("value"))
    shared = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    own = (rows.join(shared, "value").groupBy("id", "n")
           .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("common")))
    alone = F.col("n") - F.size("common")
    found = F.col("n") - F.ceil(F.col("n") * link / LINK_INTERSECTION) + 1 - alone
    finding = F.col("n") - F.ceil(F.col("n") * (2 * link) / (link + LINK_INTERSECTION)) + 1 - alone
    return (own.withColumn("found", found.cast("int")).withColumn("finding", finding.cast("int")).where("found > 0")
            .withColumn("alone", alone.cast("int"))
            .select("id", "n", "finding", "alone", F.posexplode(F.expr("slice(common, 1, found)")).alias("place", "c"))
            .select(F.col("c.value").alias("value"), "id", F.col("n").cast("long").alias("n"),
                    (F.col("place") < F.col("finding")).alias("finds"),
                    (F.col("alone") + F.col("place") + 1).alias("pos")))


def estimated(pairs: DataFrame, classes: DataFrame, k: int = SKETCH, link: int = LINK_UNION) -> DataFrame:
    """The pairs whose union sketch has enough common values, with the estimate."""
    left = classes.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", (common / F.size(union)).alias("estimate"))
            .where(F.col("estimate") >= least_common(link, k) / k))


def _verify_batches(link: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = shingle_sets(byte_texts(batch.column("ta")))
            right = shingle_sets(byte_texts(batch.column("tb")))
            linked = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(LINK_INTERSECTION * both >= link * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def verified(pairs: DataFrame, texts: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """The pairs that are links on their full sets.  texts: id, text."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .select("a", "b", "ta", "tb").mapInArrow(_verify_batches(link), "a long, b long"))


def _digest(df: DataFrame) -> tuple:
    """Number and fingerprint of the rows (u, v): two equal ones mean that nothing has moved."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _tasks(rows: int) -> int:
    """Tasks for a small intermediate table."""
    return max(1, -(-rows // 100_000))


def roots(parents: DataFrame) -> DataFrame:
    """u, v (the root of u's tree) from u, v (u's parent), by pointer jumping."""
    tree = cut_lineage(parents.select("u", "v"))
    before = _digest(tree)
    while before[0]:
        up = tree.select(F.col("u").alias("v"), F.col("v").alias("w"))
        jumped = tree.join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v"))
        tree = cut_lineage(jumped.coalesce(_tasks(before[0])))
        now = _digest(tree)
        if now == before:
            break
        before = now
    return tree


def components(links: DataFrame) -> DataFrame:
    """u, v (the smallest id reachable from u) for every u > v in links (u, v).

    Alternates large stars (a node's larger neighbours move to its smallest one)
    and small stars (its smaller neighbours do) until the edges are stars.
    """
    edges = cut_lineage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct())
    before = _digest(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(smallest, "u").select(
            F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
        edges = cut_lineage(small.distinct().coalesce(_tasks(before[0])))
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges


def candidates(lists: DataFrame, texts: DataFrame, tree: DataFrame, link: int = LINK_UNION) -> DataFrame:
    """Pairs (a, b) of the second round: members of one list that no tree joins yet."""
    few, ids_of_many = open_lists(_with_component(lists, tree, "id"))
    by_sets = _with_component(full_lists(texts.join(ids_of_many, "id", "left_semi"), link), tree, "id")
    return cross_pairs(few, link).unionByName(set_pairs(cut_lineage(by_sets), link)).distinct()


def near_duplicates(docs: DataFrame, k: int = SKETCH, link: int = LINK_UNION) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id (the smallest id with an equal set).

    ``link`` is the least similarity of a link, in hundredths.
    """
    return groups(docs, k, link).drop("text_hash").distinct()


def groups(docs: DataFrame, k: int = SKETCH, link: int = LINK_UNION) -> DataFrame:
    """The rows of ``near_duplicates`` per document and text: with text_hash, the hash of the text as it is."""
    prepared = cut_lineage(sketches(docs, k))
    full = prepared.where("n_shingles > 0 and doc_id is not null")
    membership = full.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    # equal digests have equal sizes and sketches: any of them will do
    classes = cut_lineage(full.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    lists = cut_lineage(inverted_lists(classes, k, link))
    in_lists = lists.select("id").distinct()
    # a class is stood for by the text of one row with its digest
    texts = cut_lineage(_texts_of(docs, in_lists))
    # one hub for each class: the one it resembles most, of equal ones the smallest
    best = (estimated(star_pairs(lists, link), classes, k, link).groupBy("b")
            .agg(F.max_by("a", F.struct("estimate", F.negate("a"))).alias("a")))
    tree = roots(verified(best, texts, link).select(F.col("b").alias("u"), F.col("a").alias("v")))
    between = verified(estimated(candidates(lists, texts, tree, link), classes, k, link), texts, link)
    joined = _with_component(_with_component(between, tree, "a", "u"), tree, "b", "v")
    merged = components(joined.select("u", "v"))
    # a root that was merged takes its tree along
    group = cut_lineage(_with_component(tree.withColumnRenamed("v", "root"), merged, "root", "component")
                        .select("u", "component").unionByName(
                            merged.select("u", F.col("v").alias("component"))).distinct())
    with_class = prepared.drop("sketch").join(membership, "digest", "left")
    whole = with_class.join(group.withColumnRenamed("u", "class_id"), "class_id", "left")
    own = F.coalesce("component", "class_id", "doc_id")
    out = whole.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
                       F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")).distinct()
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"), "class_id")


def _with_component(rows: DataFrame, tops: DataFrame, key: str, name: str = "component") -> DataFrame:
    """rows with the top (u -> v) of the id in ``key``, the id itself where it has none."""
    top = tops.select(F.col("u").alias(key), F.col("v").alias(name))
    return rows.join(top, key, "left").withColumn(name, F.coalesce(name, key))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
            .join(ids, "id", "left_semi")
            .withColumn("same", F.xxhash64("text")).dropDuplicates(["id", "same"]).select("id", "text"))


QUERY = "op2_near_dedup"
ORACLE_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - least({WORDS}, len(w)) + 2),
    lambda k: array_to_string(w[k:k + least({WORDS}, len(w)) - 1], ' '))) AS run FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (run)
      WHERE x.doc_id <> y.doc_id GROUP BY ALL) p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE {LINK_INTERSECTION} * common >= {LINK_UNION} * (x.n + y.n - common)),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = doc_id"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("class_id")
