"""Piece counts against a full tokenizer with the same vocabulary and tie rules."""
import pytest

from noisyframe.llm import token_counts as M

from .frames import docs

tokenizers = pytest.importorskip("tokenizers")

TEXTS = ["", "a", "  ", "a  b ", "\n\n x\t\ty", "日本語 ñ 🙂🙂 x", "▁▁a", "<0x41> <s>", "a" * 500, " lead", "trail ",
         "the cat sat on the mat " * 40, "Ünïcödé wörds", "x" * 70 + "🙂" * 3 + "y", "́zz", "   many    gaps   "]


def reference(vocabulary):
    bytes_ = [(f"<0x{i:02X}>", -1e9) for i in range(256)]
    return tokenizers.Tokenizer(tokenizers.models.Unigram(
        vocab=[("<unk>", 0.0), *vocabulary, *bytes_], unk_id=0, byte_fallback=True))


def test_counts_equal_the_tokenizer():
    vocabulary = M.read_vocabulary()
    full, counter = reference(vocabulary), M.Counter(vocabulary)
    for text in TEXTS:
        want = len(full.encode(M.MARK + text.replace(" ", M.MARK)).ids) if text else 0
        assert counter.count(text)[0] == want, text


def test_ties_take_the_longest_last_piece():
    # abc: a+bc, ab+c and abc all score -2; the whole piece ends last and is longest
    counter = M.Counter([(M.MARK, 0.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("bc", -1.0), ("ab", -1.0), ("abc", -2.0)])
    assert counter.count("abc") == (2, -2.0)
    counter = M.Counter([(M.MARK, 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0)])
    assert counter.count("ab") == (2, -2.0)


def test_memo_generations_change_nothing(monkeypatch):
    vocabulary = M.read_vocabulary()
    text = " ".join(TEXTS)
    want = M.Counter(vocabulary).count(text)
    monkeypatch.setattr(M, "MEMO", 3)
    assert M.Counter(vocabulary).count(text) == want


def test_pieces_over_word_marks_use_whole_texts():
    counter = M.Counter([(M.MARK, -1.0), ("a", -1.0), ("b", -1.0), (f"a{M.MARK}b", -1.0)])
    assert not counter.by_word
    assert counter.count("a b") == (2, -2.0)


def test_query_frame(spark):
    got = sorted((r["doc_id"], r["n_tokens"]) for r in M.token_counts(
        docs(spark, [(1, None), (2, ""), (3, "the cat"), (3, "the cat")])).collect())
    assert [g[0] for g in got] == [1, 2, 3, 3] and got[0][1] == got[1][1] == 0 and got[2] == got[3]
    assert M.token_counts(docs(spark, [])).count() == 0
