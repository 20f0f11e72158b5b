"""Alignment, link counts and digests against plain Python over the tokenizers' own output."""
import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from noisyframe.llm import token_alignment as M
from noisyframe.llm.common import table

from .frames import docs, words

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "a", " ", "  lead", "trail ", "the cat sat", "The CAT's don't\n\n  x\t y", "日本語 ñ 🙂🙂 x",
         "<|endoftext|> <s> </s> <0x41>", "▁ mark", "a" * 3000, " " * 2000, "1234567890 " * 30, "é" * 50, "\u0000 nul",
         "‘curly’ — “quotes”…", words(1, 4000), "x\r\ny", "́a", "the the the the"]


@pytest.fixture(scope="module")
def sides():
    return M.ByteBpe(M.TOKENIZER_A), M.Pieces(M.TOKENIZER_B)


def brute(texts):
    full = Tokenizer.from_file(M.TOKENIZER_A)
    full.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=M.TOKENIZER_B)
    alphabet = M.byte_alphabet()

    def a_bytes(i):
        return bytes(alphabet[c] for c in full.id_to_token(i))

    def b_bytes(i):
        return bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(
            i).replace("▁", " ").encode()
    rows = []
    for text in texts:
        groups = []
        a = full.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if text and raw == b"".join(map(a_bytes, a)) == b"".join(map(b_bytes, b)):
            left, right, ga, gb = 0, 0, [], []
            b = list(b)
            for i in a:
                ga.append(i)
                left += len(a_bytes(i))
                while b and right + len(b_bytes(b[0])) <= left:
                    right += len(b_bytes(b[0]))
                    gb.append(b.pop(0))
                if left == right:
                    groups.append((ga, gb))
                    ga, gb = [], []
        rows.append(groups)
    linked = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in rows]
    held = Counter(p for c in linked for p in c)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
             sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in c.items()),
             hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest()
             if g else "") for g, c in zip(rows, linked, strict=True)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block, wide, bands", [(2 << 20, 4096, 512), (900, 2, 1)])
def test_equals_plain_python(spark, monkeypatch, block, wide, bands):
    for name, value in (("BLOCK_BYTES", block), ("BAND_BLOCKS", bands)):
        monkeypatch.setattr(M, name, value)
    given = [*TEXTS, *TEXTS[4:9]]
    got = M.link_scores(docs(spark, list(enumerate(given)))).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in sorted(got)] == brute(given)


def test_query_on_documents(spark):
    rows = table(spark, SF, "documents").orderBy("doc_id").collect()
    got = M.query(spark, SF).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute([r["text"] for r in rows])


def test_wide_groups_count_the_same(sides, monkeypatch):
    block = M.Block([t for t in TEXTS], *sides)
    want = [x.tolist() for x in block.links()]
    monkeypatch.setattr(M, "WIDE", 0)
    assert [x.tolist() for x in block.links()] == want


def test_quick_and_full_tokenizer_agree(sides):
    a = sides[0]
    assert a.quick is not None
    for i in range(0x2060):
        c = chr(i)
        text = f"a{c}b {c}{c} 1{c}2{c} {c}.{c}\n"
        if not M.OTHER.search(text):
            assert a.quick.encode_ordinary(text) == a.full.encode(text, add_special_tokens=False).ids, hex(i)


def test_gallop_finds_the_first_end_at_or_after():
    g = np.random.default_rng(3)
    for _ in range(50):
        ends = np.unique(g.integers(1, 400, 60))
        x = np.unique(np.append(g.integers(1, ends[-1] + 1, 30), ends[-1]))
        place = np.searchsorted(ends, x)
        start = np.maximum(place - g.integers(0, 20, len(x)), 0)
        assert M.gallop(x, start, ends).tolist() == place.tolist()


def test_align_gives_ids_and_sizes(spark):
    row = M.align(docs(spark, [(1, "the cat's meow"), (2, None)])).orderBy("doc_id").collect()
    assert sum(row[0]["a_sizes"]) == len(row[0]["a"]) and sum(row[0]["b_sizes"]) == len(row[0]["b"])
    assert len(row[0]["a_sizes"]) == len(row[0]["b_sizes"]) > 0 and row[1]["a"] == []


def test_empty_table_and_null_ids(spark):
    assert M.link_scores(docs(spark, [])).count() == 0
    got = M.link_scores(docs(spark, [(None, "a b"), (None, "a b"), (3, "a b")])).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "None", "None"] and len({r["count_sum"] for r in got}) == 1


def test_parts_of_a_block_give_the_same(sides, monkeypatch):
    texts = [t for t in TEXTS if t != ""]
    whole = M.Block(texts, *sides)
    want = [x.tolist() for x in whole.links()], whole.digests()
    monkeypatch.setattr(M, "LINKS", 40)
    monkeypatch.setattr(M, "ENCODED", 2)
    parts = M.Block(texts, *sides)
    assert ([x.tolist() for x in parts.links()], parts.digests()) == want


def test_a_block_needs_little_beside_its_tokens(sides):
    """Temporaries of links and digests are bounded by a part of the block, not by all of it."""
    block = M.Block([words(i, 2000) for i in range(150)], *sides)
    tokens = len(block.a) + len(block.b)
    assert tokens > 4 * M.LINKS
    tracemalloc.start()
    try:
        kept = [block.links(), block.digests()]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert kept and most < 60 * tokens
