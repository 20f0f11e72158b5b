"""The exact rules of SURVEY §2.11 on hand-written edge frames."""
import numpy as np
import pytest

from pyspark.sql import functions as F

from noisyframe.operators import labels as L
from noisyframe.operators import pruning as P
from noisyframe.operators import features as FE
from noisyframe.operators import latent as LT
from noisyframe.operators import sampling as SM


def numpy_round_preserving(row):
    f = np.asarray(row, dtype=float)
    i = f.round()
    diff = int(np.round(f.sum().round() - i.sum()))
    if diff > 0:
        idx = np.argsort(f - i, kind="stable")[::-1][:diff]
        i[idx] += 1
    elif diff < 0:
        idx = np.argsort(f - i, kind="stable")[:(-diff)]
        i[idx] -= 1
    return i.astype(int)


def test_round_rows_half_steps(spark):
    mats = [[0.5, 0.5, 1.0], [2.5, 3.5, 0.0], [1.4, 1.4, 1.2], [0.6, 0.6, 0.8]]
    cells = spark.createDataFrame([(a, b, float(v)) for a, r in enumerate(mats) for b, v in enumerate(r)],
                                  "k_s int, k_y int, v double")
    got = {(r.k_s, r.k_y): r.v for r in L.round_rows(cells).collect()}
    for a, r in enumerate(mats):
        want = numpy_round_preserving(r)
        assert [got[(a, b)] for b in range(3)] == list(want)
        assert sum(got[(a, b)] for b in range(3)) == round(sum(r))


def _psx_frame(spark, rows):
    return spark.createDataFrame([(i, s, [p0, 1 - p0]) for i, (s, p0) in enumerate(rows)],
                                 "row_id long, label int, psx array<double>")


def test_cut_and_window_forms_agree_with_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(int(s), float(np.round(rng.random(), 1))) for s in rng.integers(0, 2, 400)]
    df = _psx_frame(spark, rows)
    thr = L.per_class_thresholds(df, 2)
    cj = L.confident_joint(df, thr)
    for method in ("prune_by_class", "prune_by_noise_rate", "both"):
        a = {r.row_id for r in P.find_label_errors(df, cj=cj, method=method).where("is_error").collect()}
        b = {r.row_id for r in P.find_label_errors(df, cj=cj, method=method, form="window")
             .where("is_error").collect()}
        assert a == b


def test_pruned_rows_disagree_with_argmax(spark):
    rng = np.random.default_rng(1)
    rows = [(int(s), float(rng.random())) for s in rng.integers(0, 2, 300)]
    df = _psx_frame(spark, rows)
    out = P.find_label_errors(df).where("is_error").collect()
    for r in out:
        assert int(np.argmax(r.psx)) != r.label


def test_clean_joint_prunes_nothing(spark):
    rows = [(0, 0.9)] * 20 + [(1, 0.1)] * 20
    df = _psx_frame(spark, rows)
    assert P.find_label_errors(df).where("is_error").count() == 0


def test_over_budget_marks_only_disagreeing(spark):
    rows = [(0, 0.2)] * 5 + [(1, 0.9)] * 5
    df = _psx_frame(spark, rows)
    cj = spark.createDataFrame([(0, 0, 0), (0, 1, 50), (1, 0, 50), (1, 1, 0)], "k_s int, k_y int, v bigint")
    marked = P.find_label_errors(df, cj=cj, method="both").where("is_error").count()
    assert marked == 10  # budget beyond class size: whole class, argmax disagrees everywhere


def test_absent_class_keeps_full_grid(spark):
    rows = [(0, 0.9)] * 10 + [(1, 0.8)] * 10  # class 1 is never confident
    df = _psx_frame(spark, rows)
    cj = L.confident_joint(df, L.per_class_thresholds(df, 2), calibrate=False)
    assert cj.count() == 4
    cal = {(r.k_s, r.k_y): r.v for r in L.confident_joint(df, L.per_class_thresholds(df, 2)).collect()}
    assert cal[(0, 0)] + cal[(0, 1)] == 10 and cal[(1, 0)] + cal[(1, 1)] == 10


def test_null_keys_give_null_features(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1), (2, None, 2.0, 0), (3, "a", 3.0, 1), (4, None, None, 1)],
                               "row_id long, c_1 string, n_1 double, label int")
    out = {r.row_id: r for r in FE.num_mean_by_cat(FE.cat_count(df, ["c_1"]), ["c_1"], ["n_1"]).collect()}
    assert out[1]["n_CatCnt:c_1"] == 2 and out[2]["n_CatCnt:c_1"] is None
    assert out[1]["n_NumMean2LEVEL:c_1_n_1_mean"] == 2.0 and out[4]["n_NumMean2LEVEL:c_1_n_1_mean"] is None


def test_unseen_values_are_appended(spark):
    fit = spark.createDataFrame([(1, "x", "y"), (2, "y", "x")], "row_id long, c_1 string, c_2 string")
    new = spark.createDataFrame([(3, "z", "x"), (4, "w", None)], "row_id long, c_1 string, c_2 string")
    blocks = FE.cat_blocks(fit, ["c_1", "c_2"])
    assert {r.block for r in blocks.collect()} == {1}
    enc = FE.BlockEncoder().fit(fit, blocks)
    out = {r.row_id: (r.c_1, r.c_2) for r in enc.transform(new).collect()}
    assert out[3] == (3, 0) and out[4] == (2, None)  # w, z appended after x=0, y=1


def test_constant_date_part_dropped(spark):
    df = spark.sql("SELECT 1 AS row_id, TIMESTAMP_NTZ'2020-01-06 00:00:00' AS t_1 UNION ALL "
                   "SELECT 2, TIMESTAMP_NTZ'2020-01-07 00:00:00'")
    assert FE.date_parts_fit(df, "t_1") == ["day", "weekday"]


def test_noise_injection_exact_counts(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"),
                                  (F.col("id") % 4 == 0).cast("int").alias("y_true"))
    nm = [[0.8, 0.3], [0.2, 0.7]]
    out = SM.inject_label_noise(df, nm, 3)
    cells = {(r.s, r.y_true): r["count"] for r in out.groupBy("s", "y_true").count().collect()}
    assert cells[(1, 0)] == int(0.2 * 0.75 * 1000) and cells[(0, 1)] == int(0.3 * 0.25 * 1000)
    assert SM.noise_matrix_valid(nm, [0.75, 0.25])


def test_take_smallest_is_exact_and_partition_free(spark):
    df = spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("label"))
    a = {r.row_id for r in SM.take_smallest(df, {0: 100, 1: 5, 2: 10000}, 9, by="label").collect()}
    b = {r.row_id for r in SM.take_smallest(df.repartition(7), {0: 100, 1: 5, 2: 10000}, 9,
                                            by="label").collect()}
    assert a == b and len(a) == 100 + 5 + 666


def test_converge_keeps_columns_normalised():
    py, nm, inv = LT.converge_latent([0.6, 0.4], [0.55, 0.45], [[0.9, 0.2], [0.1, 0.8]],
                                     [[0.85, 0.15], [0.25, 0.75]])
    assert abs(sum(py) - 1) < 1e-9
    assert all(abs(nm[0][b] + nm[1][b] - 1) < 1e-9 for b in range(2))
    assert all(abs(sum(inv[a]) - 1) < 1e-9 for a in range(2))


def test_null_seen_in_fit_has_a_code(spark):
    fit = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "row_id long, c_1 string")
    enc = FE.BlockEncoder().fit(fit, FE.cat_blocks(fit, ["c_1"]))
    new = spark.createDataFrame([(4, None), (5, "z"), (6, "x")], "row_id long, c_1 string")
    assert {r.row_id: r.c_1 for r in enc.transform(new).collect()} == {4: 2, 5: 3, 6: 0}


def test_labels_out_of_range_raise(spark):
    df = _psx_frame(spark, [(0, 0.9), (1, 0.2), (7, 0.5)])
    with pytest.raises(ValueError, match="label"):
        L.confident_joint(df, [0.5, 0.5])
