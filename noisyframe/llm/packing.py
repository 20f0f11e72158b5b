"""Conflict-constrained best-fit packing of documents into sequences.

A sequence (bin) holds ``capacity`` characters.  Texts longer than that are cut
into full pieces, which fill a bin each, and a rest.  The rests are packed
longest first.  Each bin carries its residual space and two bitmaps: the sources
and the duplicate clusters that it holds.  A rest goes to the tightest bin that
it fits and that shares neither its source nor its cluster: the search starts at
the smallest residual that is large enough and moves on to the next larger one
while the bitmaps conflict.  If no bin is compatible, a new one opens.

A duplicate cluster is a component of near copies, found by ``near_dedup`` on the documents
packed.

Bins alike in residual and bitmaps are kept together and searched as one, so that
a third of all rows being copies of one text costs one step each, not one for
every bin that such a copy sits in.

Distribution: documents are dealt by doc_id over as many partitions as their
count asks for, sorted, and packed in runs of at most ``RUN`` documents.  A run is
all that a task holds, however many rows one id or partition has.  The order is
total up to equal rows, so that a repeated task gives the same bins.

Defined cases: a null or empty text gets a row with no bin (bin_id null) and
length 0.  A null source or cluster conflicts with nothing.  Repeated rows are
packed once each, in different bins as they share a cluster.  An empty table gives
no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import near_dedup
from .common import small_batches, table

# a duplicate cluster's texts are linked by this similarity of word shingles, in hundredths
NEAR = 80
CAPACITY = 8192
RUN = 8192


class Bins:
    """Open bins in order of residual space."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []                 # distinct, ascending
        self.alike: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.count = 0

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin that takes the piece, and the piece's place in it.  Bitmaps have one bit or none."""
        at = bisect_left(self.residuals, length)
        while at < len(self.residuals):
            residual = self.residuals[at]
            fits = [(numbers[0], held) for held, numbers in self.alike[residual].items()
                    if not (held[0] & source or held[1] & cluster)]
            if fits:
                number, held = min(fits)       # of equally tight bins the oldest
                self._take(residual, held)
                self._add(number, residual - length, (held[0] | source, held[1] | cluster))
                return number, self.capacity - residual
            at += 1
        self.count += 1
        self._add(self.count - 1, self.capacity - length, (source, cluster))
        return self.count - 1, 0

    def _take(self, residual: int, held: tuple[int, int]) -> None:
        group = self.alike[residual]
        heappop(group[held])
        if not group[held]:
            del group[held]
        if not group:
            del self.alike[residual]
            del self.residuals[bisect_left(self.residuals, residual)]

    def _add(self, number: int, residual: int, held: tuple[int, int]) -> None:
        if residual not in self.alike:
            insort(self.residuals, residual)
            self.alike[residual] = defaultdict(list)
        heappush(self.alike[residual][held], number)


def pack(rows: list[tuple], capacity: int) -> Iterator[tuple]:
    """(row, piece, bin, offset in the bin, start in the text, length) for rows (id, source, cluster, length)."""
    sources = {s: 1 << i for i, s in enumerate(sorted({r[1] for r in rows if r[1] is not None}))}
    times = defaultdict(int)
    for r in rows:
        times[r[2]] += 1
    # a cluster met once conflicts with nothing and needs no bit
    clusters = {c: 1 << i for i, c in enumerate(sorted(c for c, n in times.items() if n > 1 and c is not None))}
    bins = Bins(capacity)
    for k, (_, _, _, length) in enumerate(rows):
        for piece in range(length // capacity):
            yield k, piece, bins.count, 0, piece * capacity, capacity
            bins.count += 1
        if not length:
            yield k, 0, None, None, 0, 0
    order = sorted((k for k, r in enumerate(rows) if r[3] % capacity), key=lambda k: (-(rows[k][3] % capacity), k))
    for k in order:
        _, source, cluster, length = rows[k]
        rest, full = length % capacity, length // capacity
        number, offset = bins.put(rest, sources.get(source, 0), clusters.get(cluster, 0))
        yield k, full, number, offset, full * capacity, rest


def packed(pieces: DataFrame, capacity: int = CAPACITY, run: int = RUN) -> DataFrame:
    """Placements of rows (doc_id, source, cluster, length).

    doc_id, piece, bin_id, offset (in the bin), start (in the text), length.
    bin_id is unique over all runs: partition, run and bin number in one long.
    """
    small_batches(pieces.sparkSession)
    count = pieces.count()
    parts = max(1, -(-count // run))
    dealt = (pieces.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                           F.col("cluster").cast("long"), F.col("length").cast("long"))
             .repartition(parts, F.xxhash64("doc_id")).sortWithinPartitions("doc_id", "cluster", "length", "source"))

    def out(rows: list[tuple], base: int) -> pa.RecordBatch:
        found = list(pack(rows, capacity))
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([rows[k][0] for k in columns[0]], pa.int64()),
            "piece": pa.array(columns[1], pa.int64()),
            "bin_id": pa.array([None if b is None else base + b for b in columns[2]], pa.int64()),
            "offset": pa.array(columns[3], pa.int64()), "start": pa.array(columns[4], pa.int64()),
            "length": pa.array(columns[5], pa.int64())})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition's bins are numbered on from run to run
        base, held = TaskContext.get().partitionId() << 40, []
        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            while len(held) >= run:
                made = out(held[:run], base)
                base, held = _after(made, base), held[run:]
                yield made
        if held:
            yield out(held, base)

    return dealt.mapInArrow(task, "doc_id long, piece long, bin_id long, offset long, start long, length long")


def _after(made: pa.RecordBatch, base: int) -> int:
    last = pa.compute.max(made.column("bin_id")).as_py()
    return base if last is None else last + 1


def lengths(docs: DataFrame, link: int = NEAR) -> DataFrame:
    """doc_id, source, cluster and length in characters.

    The cluster is the component of near copies (see ``near_dedup``) that the row's text is
    in; a row without an id is in no component, and its cluster a hash of its text.
    """
    text = F.col("text").cast("string")
    found = near_dedup.groups(docs, link=link).where("doc_id is not null").select(
        "doc_id", F.col("text_hash").alias("copy"), "component_id").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64(text).alias("copy"),
                       F.coalesce(F.char_length(text), F.lit(0)).alias("length"))
    return rows.join(found, ["doc_id", "copy"], "left").select(
        "doc_id", "source", F.coalesce("component_id", "copy").alias("cluster"), "length")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return packed(cut_lineage(lengths(docs)), capacity)


QUERY = "op9_packing"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
