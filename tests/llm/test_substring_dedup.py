"""Passages that repeat across texts go, whatever was inserted before them."""
from noisyframe.llm import substring_dedup as M

from .frames import docs, words


def run(spark, rows):
    return {r["doc_id"]: r for r in M.deduplicated(docs(spark, rows)).collect()}


def test_chunks_cover_the_text_and_resist_shifts():
    text = words(1, 2000).encode()
    begin, end, digest, n = M.chunks(text)
    assert sum(n) == 2000 and begin[0] == 0 and end[-1] == len(text) and (begin[1:] > end[:-1]).all()
    moved = M.chunks(b"inserted words here " + text)[2]
    assert len(set(digest) - set(moved)) <= 2
    spaced = M.chunks(text.replace(b" ", b"  \n", 1))[2]
    assert len(set(digest) - set(spaced)) <= 4


def test_gear_hash_equals_its_definition():
    import numpy as np
    buf = np.frombuffer(words(5, 40).encode(), np.uint8)
    h, want = 0, []
    for b in buf:
        h = ((h << 1) + int(M._GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert M.gear_hashes(buf).tolist() == want


def test_passages_are_removed_from_later_documents(spark):
    # 80 invented words of four letters are as long as 50 natural ones
    passages = [words(100 + k, 80) for k in range(60)]
    rows = [(k, words(200 + k, 80) + " " + passages[k] + " " + words(300 + k, 70)) for k in range(60)]
    rows += [(100 + k, words(400 + k, 30 + k) + "\n" + passages[k] + "\n" + words(500 + k, 40)) for k in range(60)]
    rows += [(200 + k, words(600 + k, 150)) for k in range(20)]
    got = run(spark, rows)
    assert all(got[k]["new_text"] == got[k]["text"] for k in [*range(60), *range(200, 220)])
    caught = [k for k in range(100, 160) if got[k]["removed_words"] >= 20]
    assert len(caught) >= 59
    for k in caught:
        left = got[k]["new_text"].split()
        own = got[k]["text"].split()
        assert left[:30 + k - 100] == own[:30 + k - 100] and left[-40:] == own[-40:]
        spans = got[k]["spans"]
        assert sum(s["end"] - s["start"] for s in spans) > 0
        kept, at = "", 0
        for s in spans:
            kept, at = kept + got[k]["text"][at:s["start"]], s["end"]
        assert (kept + got[k]["text"][at:]).split() == left
    assert all(got[k]["shared_words"] > 0 for k in [c - 100 for c in caught])


def test_copies_keep_the_first(spark):
    text = words(7, 120)
    got = run(spark, [(3, text), (1, text), (2, text), (2, text), (4, None), (5, ""), (6, "short one"), (7, "short one")])
    assert got[1]["new_text"] == text and got[1]["removed_words"] == 0
    assert not got[2]["new_text"].strip() and not got[3]["new_text"].strip()
    assert got[4]["new_text"] is None and got[5]["new_text"] == "" and got[7]["new_text"] == "short one"
    assert got[4]["n_chunks"] == got[5]["n_chunks"] == 0


def test_null_ids_other_columns_and_empty_table(spark):
    text = words(8, 60)
    frame = docs(spark, [(None, text), (None, text), (1, text)])
    out = M.deduplicated(frame)
    assert out.columns[:len(frame.columns)] == frame.columns
    assert all(r["new_text"] == text for r in out.collect())
    assert M.deduplicated(docs(spark, [])).count() == 0


def scattered(text):
    """Texts that each have one chunk of text, without the chunk before it.

    Where the chunk before it is long, its words but the first have the same cut.
    """
    begin, end, _, n = M.chunks(text.encode())
    for k in range(1, len(begin)):
        before = text[begin[k - 1]:end[k - 1]].partition(" ")[2]
        if len(before) > 32 and n[k] < M.MIN_WORDS:
            yield f"{words(7000 + k, 40)} {before} {text[begin[k]:end[k]]} {words(90000 + k, 40)}"


def test_a_passage_repeats_as_a_passage(spark):
    text = words(50, 4000)
    rows = [*enumerate(scattered(text)), (1000, text)]
    # chunks that are met one by one in other texts, some of them neighbours, of ten words or more
    got = run(spark, rows)
    assert all(got[i]["new_text"] == t and got[i]["shared_words"] == 0 for i, t in rows)
    # of a passage that does repeat the first copy stays, though chunks of it are met before
    got = run(spark, [*rows, (1001, words(3, 60) + " " + text)])
    assert got[1000]["new_text"] == text and got[1000]["shared_words"] >= 3980
    assert got[1001]["removed_words"] >= 3980


def brute(rows):
    """New texts by the rule itself: chunks and neighbouring pairs counted in plain dictionaries."""
    cut = {(i, t): M.chunks(t.encode()) for i, t in rows if i is not None and t}
    order = sorted(cut, key=lambda k: (k[0], signed_hash(k[1])))
    chunks, pairs = {}, {}
    for key in order:
        digest = cut[key][2].tolist()
        for p, d in enumerate(digest):
            chunks.setdefault(d, []).append((key, p))
        for p, d in enumerate(zip(digest, digest[1:])):
            pairs.setdefault(d, []).append((key, p))
    out = {}
    for key in order:
        begin, end, digest, n = (x.tolist() for x in cut[key])
        later = [len(chunks[d]) > 1 and chunks[d][0] != (key, p) for p, d in enumerate(digest)]
        joined = [len(pairs[d]) > 1 and pairs[d][0] != (key, p) for p, d in enumerate(zip(digest, digest[1:]))]
        spans, p = [], 0
        while p < len(digest):
            q = p
            while later[p] and q + 1 < len(digest) and later[q + 1] and joined[q]:
                q += 1
            if later[p] and sum(n[p:q + 1]) >= M.MIN_WORDS:
                spans.append((begin[p], end[q]))
            p = q + 1
        raw, at, left = key[1].encode(), 0, ""
        for a, b in spans:
            left, at = left + raw[at:a].decode(), b
        out[key] = ((left + raw[at:].decode()).split(), sum(b - a for a, b in spans), len(digest))
    return out


def signed_hash(text):
    from pyspark.sql import functions as F
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().range(1).select(F.hash(F.lit(text))).first()[0]


def test_equals_the_rule_in_plain_python(spark):
    import numpy as np
    g = np.random.default_rng(4)
    pool = [words(800 + k, int(g.integers(3, 70))) for k in range(25)]
    rows = []
    for i in range(60):
        parts = [pool[j] if g.random() < 0.5 else words(10_000 + 100 * i + int(j), int(g.integers(1, 30)))
                 for j in g.integers(0, len(pool), g.integers(1, 7))]
        rows.append((int(g.integers(0, 45)), (" ", "\n", "  ")[i % 3].join(parts)))
    rows = sorted(set(rows))
    want = brute(rows)
    got = {(r["doc_id"], r["text"]): r for r in M.deduplicated(docs(spark, rows)).collect()}
    assert {k: (r["new_text"].split(), sum(s["end"] - s["start"] for s in r["spans"]), r["n_chunks"])
            for k, r in got.items()} == want
    assert sum(bool(w[1]) for w in want.values()) > 20
