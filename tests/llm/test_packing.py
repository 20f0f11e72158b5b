"""Packing against a plain search of all bins, and its constraints."""
from collections import defaultdict

from pyspark.sql import functions as F

from noisyframe.llm import packing as M

from .frames import docs, words

SCHEMA = "doc_id long, source string, cluster long, length long"


def plain(rows, capacity):
    """Best fit by looking at every bin, of equally tight ones the oldest: (row, piece) -> bin."""
    bins, place = [], {}
    for k, r in enumerate(rows):
        for piece in range(r[3] // capacity):
            place[k, piece] = len(bins)
            bins.append([0, set(), set()])
    order = sorted((k for k, r in enumerate(rows) if r[3] % capacity), key=lambda k: (-(rows[k][3] % capacity), k))
    fits = []
    for k in order:
        _, source, cluster, length = rows[k]
        rest = length % capacity
        free = [(b[0], i) for i, b in enumerate(bins) if b[0] >= rest and not (source is not None and source in b[1])
                and not (cluster is not None and cluster in b[2])]
        fits.append(min(free)[0] if free else None)
        if not free:
            bins.append([capacity, set(), set()])
            free = [(capacity, len(bins) - 1)]
        b = bins[min(free)[1]]
        b[0] -= rest
        b[1].add(source)
        b[2].add(cluster)
        place[k, length // capacity] = min(free)[1]
    return place, bins, fits


def sample(n=400, capacity=1000):
    return [(i, f"s{(i * i) % 7}" if i % 3 else ("hot" if i % 2 else None), i % 5 if i % 4 == 0 else None if i % 9 == 0 else 1000 + i,
             (i * 37 + i * i) % 700 if i % 50 else 3 * capacity + i) for i in range(n)]


def test_best_fit_equals_a_plain_search():
    rows = sample()
    place, bins, _ = plain(rows, 1000)
    assert {(k, piece): b for k, piece, b, _, _, n in M.pack(rows, 1000) if n} == place
    assert len(bins) > 100


def check(rows, placed, capacity):
    by_bin, by_doc = defaultdict(list), defaultdict(list)
    for r in placed:
        by_doc[r["doc_id"]].append(r)
        if r["length"]:
            by_bin[r["bin_id"]].append(r)
        else:
            assert r["bin_id"] is None
    of = {r[0]: r for r in rows}
    for group in by_bin.values():
        group.sort(key=lambda r: r["offset"])
        assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(group, group[1:])) and group[0]["offset"] == 0
        assert group[-1]["offset"] + group[-1]["length"] <= capacity
        for column in (1, 2):
            held = [of[r["doc_id"]][column] for r in group if of[r["doc_id"]][column] is not None]
            assert len(held) == len(set(held))
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert sum(r["length"] for r in pieces) == of[i][3]
        assert all(a["start"] + a["length"] == b["start"] for a, b in zip(pieces, pieces[1:]))
    assert set(by_doc) == set(of)


def test_constraints_hold_over_runs_and_partitions(spark):
    rows = sample(900)
    frame = spark.createDataFrame(rows, SCHEMA)
    placed = M.packed(frame, 1000, run=100).collect()
    check(rows, placed, 1000)
    assert sorted(map(tuple, placed)) == sorted(map(tuple, M.packed(frame.repartition(7), 1000, run=100).collect()))


def test_hot_cluster_repeated_rows_nulls_and_empty_table(spark):
    rows = [(1, "a", 5, 300)] * 500 + [(2, None, None, 0), (None, None, None, 10)]
    placed = M.packed(spark.createDataFrame(rows, SCHEMA), 1000, run=64).collect()
    assert len(placed) == 502 and len({r["bin_id"] for r in placed if r["doc_id"] == 1}) == 500
    assert M.packed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents_of_a_table(spark):
    from .frames import docs, words
    rows = [(1, None), (2, ""), (3, words(1, 3000)), (4, "ñ🙂")]
    placed = M.pack_documents(docs(spark, rows)).collect()
    assert {i: sum(r["length"] for r in placed if r["doc_id"] == i) for i, _ in rows} == {1: 0, 2: 0, 3: len(words(1, 3000)), 4: 2}


def test_near_copies_never_share_a_sequence(spark):
    base = words(4, 120)
    near = [base, base.replace(" ", "  ", 1), "z" + base, base + " tail", base.upper()]
    rows = [(i, t) for i, t in enumerate(near)] + [(10 + i, words(50 + i, 60)) for i in range(20)] + [(None, base), (None, base)]
    frame = docs(spark, rows).withColumn("source", F.concat(F.lit("s"), F.coalesce("doc_id", F.lit(99)).cast("string")))
    placed = M.pack_documents(frame).collect()
    assert len(placed) == len(rows)
    bins = [r["bin_id"] for r in placed if r["doc_id"] is not None and r["doc_id"] < 5]
    assert len(set(bins)) == 5
    assert len({r["bin_id"] for r in placed}) < len(rows)
    # one id with two texts: each text is in the component of its own copies
    two = docs(spark, [(1, base), (5, base), (5, words(77, 60))]).withColumn("source", F.lit(None).cast("string"))
    clusters = {(r["doc_id"], r["length"]): r["cluster"] for r in M.lengths(two).collect()}
    assert len(clusters) == 3 and sorted(clusters.values()) == [1, 1, 5]
