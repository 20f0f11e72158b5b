"""Hits of benchmark windows against a search of every window in every text."""
import random
import re

from noisyframe.llm import decontaminate as M

from .frames import docs


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, span=10):
    wins = {}
    for name, text in items:
        w = tokens(text)
        size = min(span, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            wins.setdefault(tuple(w[k:k + size]), set()).add(name)
    out = []
    for text in texts:
        w, hit, names = tokens(text), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    hit |= set(range(k, k + size))
                    names |= wins[tuple(w[k:k + size])]
        out.append((len(w), sorted(hit), sorted(names)))
    return out


def material():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(12)] + ["ñandú", "日本"]
    items = [(str(k), " ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 7, 9, 10, 11, 14, 30])))) for k in range(30)]
    items += [("2", items[3][1]), ("31", ""), ("32", "..."), ("33", "  " + items[5][1].upper() + "!")]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randrange(0, 200))) for _ in range(60)]
    for _, item in items:
        texts.append("zz " + item.replace(" ", ", ") + " yy " + " ".join(item.split()[:9]))
        texts.append(" ".join(item.split()[2:14]))
    return texts + [None, "", "!!", "w1" * 3000, items[0][1]], items


def test_hits_equal_brute_force(spark):
    texts, items = material()
    table = spark.createDataFrame([*items, (None, "w1")], "item_id string, text string")
    for span in (10, 4):
        got = {r["doc_id"]: (r["n_words"], r["hit"], r["items"]) for r in M.contaminated(
            docs(spark, list(enumerate(texts))), table, span).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, items, span)


def test_shards_give_the_same(spark, monkeypatch):
    texts, items = material()
    table = spark.createDataFrame(items, "item_id string, text string")
    frame = docs(spark, [*enumerate(texts), (0, texts[0])])
    key = lambda rows: sorted((r["doc_id"], r["n_words"], r["hit"], r["items"]) for r in rows)
    want = key(M.contaminated(frame, table).collect())
    monkeypatch.setattr(M.shards, "__defaults__", (60,))
    assert key(M.contaminated(frame, table).collect()) == want


def test_longest_matches_of_the_automaton():
    items = [("1", "a b a b c".split()), ("2", "b a b c d".split()), ("3", "a b".split())]
    found = M.SuffixAutomaton([(i, [w.encode() for w in ws]) for i, ws in items])
    text = "x a b a b c d a b b a".split()
    got = [length for _, length, _ in found.stream([w.encode() for w in text])]
    runs = {tuple(ws[i:j]) for _, ws in items for i in range(5) for j in range(i + 1, 6)}
    want = [max([n for n in range(1, 6) if tuple(text[max(0, i + 1 - n):i + 1]) in runs and n <= i + 1], default=0)
            for i in range(len(text))]
    assert got == want


def test_cleaned_texts_and_empty_tables(spark):
    item = " ".join(f"w{i}" for i in range(15))
    table = spark.createDataFrame([("1", item)], "item_id string, text string")
    other = " ".join(f"v{i}" for i in range(30))
    frame = docs(spark, [(1, f"{other} {item.upper()}. {other}"), (2, item), (3, other), (4, None), (5, "")])
    got = {r["doc_id"]: r["text"] for r in M.cleaned(frame, table).collect()}
    assert got == {1: f"{other} . {other}", 3: other, 4: None, 5: ""}
    assert M.cleaned(frame, table).columns == frame.columns
    assert M.contaminated(docs(spark, []), table).count() == 0
    assert [r["n_items"] for r in M.contaminated(frame, table.limit(0)).collect()] == [0] * 5


def by_hand(rows, items):
    """Rows without their hit words and what is between two of them, all items taken at once."""
    out = []
    for (i, text), (n, hit, _) in zip(rows, brute([t for _, t in rows], items), strict=True):
        if n and len(hit) >= M.COVERAGE * n:
            continue
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text or ""))]
        left, at = "", 0
        for k in hit:
            if k - 1 not in hit:
                left += text[at:places[k][0]]
            at = places[k][1]
        out.append((i, None if text is None else left + text[at:]))
    return out


def test_cleaned_with_several_shards_equals_one(spark, monkeypatch):
    texts, items = material()
    def run_of(letter, n):
        return [f"{letter}{k}" for k in range(n)]
    parts = [run_of(x, 30) for x in "abc"]
    whole = run_of("o", 20)
    items += [(f"p{k}", " ".join(p)) for k, p in enumerate(parts)]
    items += [("left", " ".join(whole[:12])), ("right", " ".join(whole[8:])), ("met", " ".join(run_of("m", 12)))]
    rows = list(enumerate(texts))
    # nine tenths in three items; two items that overlap; words that are an item only once another is cut out
    rows += [(900, " ".join(run_of("v", 10) + sum(parts, []))), (901, " ".join(run_of("v", 40) + whole)),
             (902, " ".join(run_of("v", 60) + run_of("m", 6) + parts[0] + run_of("m", 12)[6:])),
             (901, " ".join(run_of("u", 40) + whole)), (None, " ".join(run_of("v", 40) + whole)), (900, "none of it")]
    rows += [rows[-2], rows[1]]
    frame, table = docs(spark, rows), spark.createDataFrame(items, "item_id string, text string")
    key = lambda rows: sorted(rows, key=str)
    want = key(by_hand(rows, items))
    assert key((r["doc_id"], r["text"]) for r in M.cleaned(frame, table).collect()) == want
    for limit in (60, 25):
        monkeypatch.setattr(M.shards, "__defaults__", (limit,))
        assert len(list(M.shards(table))) > 3
        again = M.cleaned(frame, table)
        assert again.columns == frame.columns
        assert key((r["doc_id"], r["text"]) for r in again.collect()) == want
