"""Near-duplicates against brute force over all pairs of shingle sets."""
import re

import pytest
from pyspark.sql import functions as F

from noisyframe.llm import near_dedup as M

from .frames import docs, words


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near(text, every):
    """The text with a changed word at each ``every``-th place."""
    return " ".join("z" + w if k % every == every - 1 else w for k, w in enumerate(text.split()))


def cases():
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five"),
            (6, "one two three four five"), (7, "a b c d e f")]
    base = words(1, 300)
    for k in range(40):      # a chain of near copies and exact copies
        rows.append((100 + k, near(base, 60 + 7 * k)))
        rows.append((200 + k, base.upper()))
    passage = words(2, 60)
    for k in range(40):      # a passage that is half or more of texts that are not alike otherwise
        rows.append((300 + k, passage + " " + words(500 + k, 20 + k)))
    for k in range(30):
        rows.append((400 + k, words(1000 + k, 3 + 4 * k)))
        rows.append((500 + k, near(words(1000 + k, 3 + 4 * k), 50 + k)))
    rows.append((600, words(9, 6000)))
    rows.append((601, near(words(9, 6000), 100)))
    return rows


@pytest.mark.parametrize("many", [M.MANY, 1])
def test_components_equal_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(M, "MANY", many)      # 1: all pairs of the second round by their full sets
    rows = cases()
    got = {r["doc_id"]: r for r in M.near_duplicates(docs(spark, rows)).collect()}
    want = brute(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = words(3, 50)
    frame = docs(spark, [(1, text), (1, text), (2, text), (None, text), (None, None)])
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"])
                 for r in M.near_duplicates(frame).collect())
    assert got == [(-1, 0, None, True), (-1, 46, None, True), (1, 46, 1, True), (2, 46, 1, False)]
    assert M.near_duplicates(docs(spark, [])).count() == 0


def test_components_and_roots_of_long_chains(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1001, 1000), (5, 300)], "u long, v long")
    got = {r["u"]: r["v"] for r in M.components(links).collect()}
    assert got == {**{i: 0 for i in [*range(1, 201), 300]}, 1001: 1000}
    tree = spark.createDataFrame([(i + 1, i) for i in range(100)] + [(500, 7)], "u long, v long")
    assert {r["u"]: r["v"] for r in M.roots(tree).collect()} == {i: 0 for i in [*range(1, 101), 500]}
    assert M.components(links.limit(0)).count() == M.roots(tree.limit(0)).count() == 0


def jaccard(a, b):
    x, y = (set(M.shingle_sets([t.encode()])[0].tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("many", [M.MANY, 1])
def test_link_is_a_parameter(spark, monkeypatch, many):
    monkeypatch.setattr(M, "MANY", many)
    rows = []
    for k in range(12):      # one changed word in 54, two in 100, eight in 400: 0.81 to 0.82
        for n, every in ((54, 30), (100, 40), (400, 48)):
            base = words(10 * k + n, n)
            rows += [(len(rows), base), (len(rows) + 1, near(base, every))]
    for k in range(20):      # a common passage, less than a link
        rows.append((len(rows), words(2, 60) + " " + words(500 + k, 30 + k)))
    assert all(0.80 <= jaccard(rows[i][1], rows[i + 1][1]) < 0.85 for i in range(0, 72, 2))
    at = {link: {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs(spark, rows), link=link).collect()}
          for link in (80, 85)}
    assert at[80] == {i: i - i % 2 if i < 72 else i for i, _ in rows}
    assert at[85] == {i: i for i, _ in rows}


def test_floor_of_the_sketches_follows_the_link():
    assert (M.least_common(85), M.least_common(80)) == (40, 36)


def families(n):
    """Two families of n near copies each (every text has two words of its own), alike in 70 % of their words."""
    common, rows = words(1, 280), []
    for f in (0, 1):
        base = (common + " " + words(10 + f, 120)).split()
        for k in range(n):
            own = list(base)
            own[7 + (37 * k + 11 * f) % 380], own[3 + (53 * k) % 390] = f"q{f}x{k}", f"p{f}x{k}"
            rows.append((f * n + k, " ".join(own)))
    return rows


@pytest.mark.parametrize("n", [100, 200])
def test_families_that_share_a_passage_are_not_paired_member_by_member(spark, n):
    rows = families(n)
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: i // n * n for i, _ in rows}
    classes = M.sketches(docs(spark, rows)).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    lists = M.inverted_lists(classes)
    texts = spark.createDataFrame(rows, "id long, text string")
    tree = spark.createDataFrame([(i, i // n * n) for i, _ in rows if i % n], "u long, v long")
    # a list that isn't paired by full sets has under MANY / 2 pairs for each member
    assert M.candidates(lists, texts, tree).count() <= M.MANY // 2 * n
