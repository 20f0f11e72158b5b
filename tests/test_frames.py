"""Declared roles, narrowing, labelled text with ids and escapes, offsets as a table."""
import pytest
from pyspark.sql import functions as F

from noisyframe.functions import ranking as R
from noisyframe.operators import features as FE
from noisyframe.session import cut_lineage, stage_path
from noisyframe.sources import text as T
from noisyframe.sources.tables import Roles, declared_frame


def test_declared_roles(spark):
    d = spark.createDataFrame([(1, "a", 2.5, 7, "x", 0)], "key long, c_num string, weight double, n_code int, other string, said int")
    d = d.withColumn("at", F.timestamp_seconds(F.lit(5)))
    f = declared_frame(d, {"n_code": "cat", "weight": "num", "c_num": "cat", "at": "time"}, "key", "said")
    assert f.columns == ["row_id", "c_1", "c_2", "n_1", "t_1", "label"]
    assert tuple(f.first())[:4] == (1, "7", "a", 2.5)
    for schema, message in (({"gone": "cat"}, "missing"), ({"c_num": "num"}, "number column"), ({"weight": "time"}, "time column"),
                            ({"weight": "text"}, "declared as")):
        with pytest.raises(ValueError, match=message):
            declared_frame(d, schema, "key")
    assert Roles.infer(d).num == ["n_code"]


def test_narrowing(spark):
    d = spark.createDataFrame([(1, 1, 0.5, 0.1, 1e300, None), (300, 2, None, 0.2, 1.5, None)],
                              "a long, b long, c double, d double, e double, f double")
    cols = ["a", "b", "c", "d", "e"]
    assert dict(FE.narrow(d, cols).dtypes) == dict(a="smallint", b="tinyint", c="float", d="double", e="double", f="double")
    lossy = FE.narrow(d, cols, lossy=True)
    assert dict(lossy.dtypes)["d"] == "float" and dict(lossy.dtypes)["e"] == "double"
    assert [tuple(r)[:3] for r in FE.narrow(d, cols).collect()] == [(1, 1, 0.5), (300, 2, None)]


BODIES = ["one\ntwo", "x\n__label__7 y", "x\n\\__label__7", "x\n\\\\__label__7\n__label__", "plain", "a __label__3 b", "tail\n\n", ""]


def records(spark, path, **options):
    return [(r["label"], r["text"]) for r in T.read_labelled_text(spark, path, **options).collect()]


def test_labelled_text_escapes_and_ids(spark):
    path = stage_path(spark)
    rows = [(i, str(i % 3), BODIES[i % len(BODIES)] + ("" if i < 8 else f" {i}")) for i in range(200)]
    T.write_labelled_text(spark.createDataFrame(rows, "doc_id long, label string, text string").repartition(3), path)
    want = sorted((y, t.strip().replace("\n", T.NEWLINE_TOKEN)) for _, y, t in rows)
    assert sorted(records(spark, path)) == want
    ids = {}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "400b", "77b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = T.read_labelled_text(spark, path, with_ids=True).collect()
            ids[size] = sorted((r["file"], r["record"], r["label"], r["text"]) for r in found)
        assert ids["128m"] == ids["400b"] == ids["77b"] and len({x[:2] for x in ids["77b"]}) == 200
        some = [x for x in ids["77b"] if x[1] % 7 == 0]
        asked = spark.createDataFrame([(x[0], x[1], "z") for x in some], "file string, record long, label string")
        assert sorted(records(spark, path, ids=asked)) == sorted(x[2:] for x in some)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_label_index_is_bounded(spark, monkeypatch):
    labels = spark.createDataFrame([(f"l{i}",) for i in range(5)], "label string")
    assert [r["code"] for r in T.label_index(labels, labels).orderBy("label").collect()] == [0, 1, 2, 3, 4]
    monkeypatch.setattr(T, "MAX_GROUPS", 4)
    with pytest.raises(ValueError, match="more than 4"):
        T.label_index(labels, labels)


def test_offsets_as_a_table_equal_literals(spark, monkeypatch):
    d = cut_lineage(spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") * 37 % 101).alias("x")))
    monkeypatch.setattr(R, "buckets_for", lambda spark, rows: 7)
    order = [F.col("x"), F.col("row_id")]
    want = sorted((r["row_id"], r["rn"]) for r in R.global_row_number(d, order).collect())
    for literal, broadcast in ((0, 500_000), (0, 0)):
        monkeypatch.setattr(R, "LITERAL_BUCKETS", literal)
        monkeypatch.setattr(R, "BROADCAST_BUCKETS", broadcast)
        ranked = R.global_row_number(d, order)
        assert sorted((r["row_id"], r["rn"]) for r in ranked.collect()) == want
        assert FE.quantile_edges(d, "x", 4) == [0.0, 25.0, 50.0, 75.0, 100.0]
