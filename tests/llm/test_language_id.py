"""Filters return every language of an n-gram; predictions on held-out rows."""
import numpy as np

from noisyframe.llm import language_id as M
from noisyframe.llm.common import lay_out

from .frames import docs

PHRASES = {"en": "the other thing that they have been working with", "de": "das ist nicht der einzige weg zur neuen stadt",
           "fr": "les autres choses que nous avons vues dans la rue"}


def text(lang, seed, n=30):
    w = PHRASES[lang].split()
    return " ".join(w[(seed * 7 + i * i + i * seed) % len(w)] for i in range(n))


def labelled(spark):
    rows = [(i, text(lang, i)) for i in range(0)]
    frame = docs(spark, rows)
    for k, lang in enumerate(PHRASES):
        frame = frame.union(docs(spark, [(1000 * k + i, text(lang, i)) for i in range(120)], lang=lang))
    return frame


def test_ngrams_and_masks():
    buf, _ = lay_out([b" abc  de", b"xy"])
    for n in (2, 5):
        folded = [c if chr(c).isalpha() else 32 for c in buf.tolist()]
        want = []
        for i in range(len(folded)):
            gram = folded[i - n + 1:i + 1] if i >= n - 1 else None
            bad = gram is None or any(a == b == 32 for a, b in zip(gram, gram[1:]))
            want.append(0 if bad else int.from_bytes(bytes(gram), "big"))
        assert M.ngrams(buf, n).tolist() == want
    langs = [f"l{i:03}" for i in range(70)]       # more than one word of bits
    sets = {x: np.arange(i * 50, i * 50 + 100, dtype=np.uint64) + 1 for i, x in enumerate(langs)}
    found = M.NgramFilter(langs, sets, "l000")
    for i, x in enumerate(langs):
        masks = found.masks(sets[x])
        assert ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()      # no false negatives
    foreign = found.masks(np.arange(10 ** 6, 10 ** 6 + 20000, dtype=np.uint64))
    rate = np.mean([((foreign[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(70)])
    assert abs(rate - found.false_rate.mean()) < 1e-3


def test_corrected_counts_ignore_a_full_filter():
    sets = {"a": np.arange(1, 60000, dtype=np.uint64), "b": np.arange(10 ** 9, 10 ** 9 + 300, dtype=np.uint64)}
    found = M.NgramFilter(["a", "b"], sets, "a", slots=1 << 16)
    assert found.false_rate[0] > 0.5 and found.false_rate[1] < 1e-3


def test_held_out_accuracy_and_defined_cases(spark):
    frame = labelled(spark).union(docs(spark, [(9001, None), (9002, ""), (9003, "12 !?"), (9004, "zzzzqqqq"), (None, text("de", 1))],
                                       lang=None))
    got = {r["doc_id"]: r for r in M.identify(frame).collect()}
    truth = {1000 * k + i: lang for k, lang in enumerate(PHRASES) for i in range(120)}
    assert all(got[i]["lang_pred"] == lang for i, lang in truth.items())
    assert 0 < sum(got[i]["held_out"] for i in truth) < len(truth)
    assert [got[i]["lang_pred"] for i in (9001, 9002, 9003)] == ["und"] * 3
    assert got[9004]["lang_pred"] in PHRASES and got[9004]["score"] == 0
    assert got[None]["lang_pred"] == "de" and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nothing_to_learn_from_and_clashing_columns(spark):
    empty = docs(spark, [])
    assert M.identify(empty).count() == 0
    frame = docs(spark, [(1, text("en", 1))], lang=None)
    assert M.identify(frame).collect()[0]["lang_pred"] == "und"
    out = M.predict(frame, M.fit(frame.select("doc_id", "text", "lang")), keep_text=True)
    assert out.columns == [*frame.columns, "lang_pred", "_score"]
