"""The stages on a small corpus with planted cases, each against what it must keep."""
import importlib

import corpus_pipeline as P
from noisyframe.llm import catalog

from .frames import docs, words
from .test_decontaminate import brute as windows_in
from .test_language_id import PHRASES
from .test_language_id import text as text_in
from .test_near_dedup import brute as near_groups


def corpus(spark):
    clean = [(k, f"{words(k, 120)} the end of it.") for k in range(30)]
    near = [(100 + k, " ".join(w + "x" if i == 50 else w for i, w in enumerate(t.split()))) for k, (_, t) in
            enumerate(clean[:5])] + [(110, clean[0][1]), (110, clean[0][1])]
    passage = words(900, 80)
    shared = [(200 + k, f"{words(300 + k, 60)} {passage} {words(400 + k, 60)}") for k in range(4)]
    item = words(901, 40)
    leaked = [(300, f"{words(500, 100)} {item} {words(501, 100)}"), (301, item)]
    junk = [(400, None), (401, ""), (402, "12 34 !!"), (None, words(77, 100))]
    frame = docs(spark, clean + near + shared + leaked + junk)
    return frame, spark.createDataFrame([(1, item), (2, None)], "item_id long, text string"), passage


def test_stages(spark, tmp_path):
    frame, items, passage = corpus(spark)
    sf = str(tmp_path)
    frame.write.parquet(f"{sf}/documents.parquet")
    items.write.parquet(f"{sf}/benchmark.parquet")
    at = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, stage in P.STAGES:
        before = at
        at = stage(spark, at, sf)
        at.write.parquet(f"{sf}/{name}")
        at = spark.read.parquet(f"{sf}/{name}")
        if name != "packing":
            assert at.columns == frame.columns
            assert all(r["n_chars"] == len(r["text"]) for r in at.collect())
        seen.append({r["doc_id"]: r["text"] for r in at.collect()} if "text" in at.columns else at)
        if name == "near_dedup":
            texts = [(r["doc_id"], r["text"]) for r in before.collect() if r["doc_id"] is not None]
            assert {r["doc_id"] for r in at.collect()} == {i for i, (_, c) in near_groups(texts).items() if i == c} | {None}
            assert at.where("doc_id = 110").count() == 0
    language, near, substring, clean, placed = seen
    assert not {400, 401, 402} & set(language) and {None, 301, 0} <= set(language)
    assert set(range(30)) <= set(clean) and all(near[k] == clean[k] for k in range(30))
    assert passage in substring[200] and all(passage not in substring[k] for k in (201, 202, 203))
    assert 301 not in clean and 300 in clean
    assert not any(hit for _, hit, _ in windows_in(list(clean.values()), [("1", words(901, 40))]))
    lengths = {}
    for r in placed.collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(t) for i, t in clean.items()}


def test_empty_tables(spark, tmp_path):
    frame, items, _ = corpus(spark)
    frame.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    items.limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    names = list(catalog.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(catalog.oracle_sql()) <= set(names)
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *names} <= set(entry.queries())
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_near_dedup_stage_links_at_four_fifths(spark, tmp_path):
    base = words(40, 100)
    changed = " ".join("z" + w if i in (40, 70) else w for i, w in enumerate(base.split()))     # 86 of 106 shingles
    frame = docs(spark, [(1, base), (2, changed), (3, words(41, 100))])
    assert sorted(r["doc_id"] for r in P.near_dedup_stage(spark, frame, str(tmp_path)).collect()) == [1, 3]


def test_language_stage_rejects_what_is_in_no_language(spark, tmp_path):
    natural = [(1000 * k + i, text_in(lang, i), lang) for k, lang in enumerate(PHRASES) for i in range(60)]
    noise = [(9000 + i, " ".join("qxzjvkwpbg"[(i + 3 * j + j * j) % 10:][:1] * (2 + j % 3) + f"{chr(103 + (i * j) % 20)}zx"
                                 for j in range(60))) for i in range(20)]
    foreign = [(9100, "Съешь же ещё этих мягких французских булок"), (9101, "hyvää huomenta kaikille ystäville pohjoisessa")]
    mixed = [(9200, " ".join(PHRASES.values())), (9201, noise[0][1] + " " + PHRASES["en"])]
    rows = [*((i, t, None) for i, t in noise + foreign + mixed), (9300, "12 !?", None), (9301, None, None)]
    frame = docs(spark, [])
    for i, t, lang in natural:
        rows.append((i, t, lang))
    frame = spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", 7, "y") for i, t, lang in rows], frame.schema)
    kept = {r["doc_id"] for r in P.language_stage(spark, frame, str(tmp_path)).collect()}
    assert kept == {i for i, _, _ in natural} | {9200, 9201}
    assert P.language_stage(spark, frame, str(tmp_path)).columns == frame.columns
    # nothing to learn from: nothing is held against a text
    unlabelled = frame.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    left = {r["doc_id"] for r in P.language_stage(spark, unlabelled, str(tmp_path)).collect()}
    assert left == {i for i, _, _ in rows} - {9300, 9301}


def test_a_text_without_a_copy_stays(spark):
    t, u = words(1, 90), words(2, 90)
    given = docs(spark, [(1, t), (5, t), (5, u), (5, u), (None, t), (None, t), (7, t + " more")])
    left = P.near_dedup_stage(spark, given, None).collect()
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in left) == sorted([(1, t), (5, u), (0, t), (0, t)])
    assert P.near_dedup_stage(spark, given.limit(0), None).count() == 0
