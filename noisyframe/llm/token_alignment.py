"""Cross-tokenizer alignment: where the tokens of two tokenizers end at the same byte.

Tokenizer A is a byte-level BPE file, B a piece file with a word mark and byte fallback;
B puts a space before the text by itself, A is given space + text, so that both cut the
same bytes.  Each side's list of token ends is strictly increasing.  The shorter list of a
document drives a galloping search into the longer one: from the place of its predecessor
the step doubles until the end is passed, then a binary search closes in.  All documents
of a block gallop at once in numpy: every ``LANE``-th end starts from its document's
first token, the ends after it from where that one was found.  Ends that both lists
have cut the tokens into groups; the ranks of common ends slice both sides, and their
differences are the tokens of a group on each side.  All pairs of an A and a B token of
one group are links.

Counting: links of a block of whole documents (about ``BLOCK_BYTES`` of text) are
sorted once by (id pair, document).  A block leaves one row in the shared folder: its
documents' figures, its distinct id pairs with the documents that hold them, and the
links of each (pair, document).  Spark adds the pairs' documents up, over ``BAND_BLOCKS``
blocks first and over the bands then, so that an id pair that every block holds
(``the`` / ``the``) is never one large group, neither here nor on the way back.  The counts
of a block's pairs meet its row again by block.  Every group is bounded: by a block, a
band, or the vocabulary (at most |B| pairs for an A id).

A text of tokens that tokenizers never cut alike is one group; where a group would give
more than ``WIDE`` links, its distinct ids are multiplied instead of its tokens.

The tokenizers come from files whose paths are parameters and which every executor can
read; they are never copied.  ``tiktoken`` encodes A where it is certain to agree: its
merges are the file's (checked when it is loaded: ids in the order of merges, no
normaliser, the byte-level word pattern) and the text has no character of
``OTHER``, whose Unicode classes could differ between versions; other texts go to the
``tokenizers`` library.

Defined cases: null and empty texts, and texts whose joined bytes in A or B differ from
space + text, have no tokens and give zeros and ''.  Rows are documents: repeated rows,
null ids and equal ids count one each.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import small_batches, table

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
BAND_BLOCKS = 512
LANE = 32
WIDE = 4096
# texts that are encoded, and links that are sorted, at a time: they bound a worker's memory
ENCODED = 32
LINKS = 1 << 17
# what a document adds to a block beside its characters, so that empty ones fill it too
ROW_BYTES = 64
# characters beyond these could be classified differently by another version of Unicode
OTHER = re.compile("[^\\u0000-\\u024f\\u2010-\\u2027\\u2030-\\u205e]")
# fixed values: the word pattern and the byte alphabet of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if shown, else the next from 256 on."""
    shown = {b for a, z in SHOWN for b in range(a, z + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Tokenizer A: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocab = given["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.quick = self._ranked(given, vocab)

    def _ranked(self, given: dict, vocab: dict[str, int]):
        """The same tokenizer by ranks, or None where it could differ."""
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in given["model"]["merges"]]
        step = given.get("pre_tokenizer") or {}
        if (given.get("normalizer") or step.get("type") != "ByteLevel" or step.get("add_prefix_space")
                or not step.get("use_regex", True) or given["model"].get("ignore_merges")
                or len(vocab) != 256 + len(merges) or any(vocab.get(m) != 256 + i for i, m in enumerate(merges))):
            return None
        import tiktoken
        return tiktoken.Encoding("ranked", pat_str=PATTERN, special_tokens={},
                                 mergeable_ranks={b: i for i, b in enumerate(self.bytes)})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.quick is not None and not OTHER.search(text):
                out[i] = self.quick.encode_ordinary(text)
            else:
                rest.append(i)
        for i, found in zip(rest, self.full.encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return out


class Pieces:
    """Tokenizer B: ids of texts (it puts the space in front), and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def gallop(x: np.ndarray, start: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each x the first place at or after its start where ends is x or more."""
    low, high = start.copy(), start.copy()
    last = len(ends) - 1
    going = np.flatnonzero(ends[np.minimum(high, last)] < x)
    step = 1
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, last)
        step *= 2
        going = going[ends[high[going]] < x[going]]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < x[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(short: np.ndarray, first: np.ndarray, ends: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in short and in ends of the values that both have.

    first: the rank of each document's first value in short; start: that in ends.
    """
    if not len(short) or not len(ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(short)))
    rank = np.arange(len(short)) - np.repeat(first, size)
    place = np.repeat(start, size)
    anchors = np.flatnonzero(rank % LANE == 0)
    place[anchors] = gallop(short[anchors], place[anchors], ends)
    # the others start from the anchor of their lane
    lane = np.cumsum(rank % LANE == 0) - 1
    others = np.flatnonzero(rank % LANE != 0)
    place[others] = gallop(short[others], place[anchors[lane[others]]], ends)
    both = np.flatnonzero(ends[place] == short)
    return both, place[both]


def joined_ids(ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Ids in decimal, each with a mark behind it; and where each one ends."""
    digits = np.ones(len(ids), np.int64)
    for power in range(1, 10):
        digits += ids >= 10 ** power
    ends = np.cumsum(digits + 1)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = marks
    at, left, size = ends - 2, ids.astype(np.int64), digits
    while len(at):
        out[at] = 48 + left % 10
        more = size > 1
        at, left, size = at[more] - 1, left[more] // 10, size[more] - 1
    return out.tobytes(), ends


class Block:
    """The alignment of a block of texts, all documents laid end to end.

    a, b: token ids; a_of, b_of: where each document's tokens start (one more at the end);
    a_cut, b_cut: for each group the rank behind its last token; group_of: where each
    document's groups start.
    """

    def __init__(self, texts: list[str | None], a: ByteBpe, b: Pieces):
        given = [i for i, t in enumerate(texts) if t]
        tokens: list[tuple] = [(np.zeros(0, np.int32),) * 2] * len(texts)
        # a few texts at a time: their ids as Python numbers take ten times the room of the array
        for some in (given[i:i + ENCODED] for i in range(0, len(given), ENCODED)):
            spaced = [" " + texts[i] for i in some]
            found = zip(a.encode(spaced), b.encode([texts[i] for i in some]), strict=True)
            for i, text, (x, y) in zip(some, spaced, found, strict=True):
                raw = text.encode()
                if b"".join(map(a.bytes.__getitem__, x)) == raw == b"".join(map(b.bytes.__getitem__, y)):
                    tokens[i] = np.array(x, np.int32), np.array(y, np.int32)
        self.a, self.a_of = _flat([t[0] for t in tokens])
        self.b, self.b_of = _flat([t[1] for t in tokens])
        a_end = np.cumsum(_sizes(a)[self.a])
        b_end = np.cumsum(_sizes(b)[self.b])
        n_a, n_b = np.diff(self.a_of), np.diff(self.b_of)
        cuts = []
        for a_drives in (True, False):
            picked = np.flatnonzero((n_a <= n_b) == a_drives)
            n, of, drive, into, into_of = (
                (n_a, self.a_of, a_end, b_end, self.b_of) if a_drives else (n_b, self.b_of, b_end, a_end, self.a_of))
            rows = _ranges(of[picked], n[picked])
            first = np.append(0, np.cumsum(n[picked]))[:-1]
            i, j = common_ends(drive[rows], first, into, into_of[picked])
            cuts.append((rows[i], j) if a_drives else (j, rows[i]))
        at = np.concatenate([c[0] for c in cuts])
        order = np.argsort(at, kind="stable")
        self.a_cut = at[order] + 1
        self.b_cut = np.concatenate([c[1] for c in cuts])[order] + 1
        self.group_of = np.searchsorted(self.a_cut, self.a_of, side="right")

    @property
    def a_sizes(self) -> np.ndarray:
        return np.diff(self.a_cut, prepend=0)

    @property
    def b_sizes(self) -> np.ndarray:
        return np.diff(self.b_cut, prepend=0)

    def digests(self) -> list[str]:
        """For each document the SHA-256 of ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
        a_sizes, b_sizes = self.a_sizes, self.b_sizes
        part = (self.a_of + self.b_of)[:-1] // LINKS     # documents of about so many tokens at a time
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        return [d for x, y in zip(edges[:-1], edges[1:], strict=True) for d in self._digests(x, y, a_sizes, b_sizes)]

    def _digests(self, first: int, last: int, a_sizes: np.ndarray, b_sizes: np.ndarray) -> list[str]:
        """Those of the documents from first to before last."""
        groups = slice(self.group_of[first], self.group_of[last])
        a_of, b_of = (of[first:last + 1] - of[first] for of in (self.a_of, self.b_of))
        a, b = self.a[self.a_of[first]:self.a_of[last]], self.b[self.b_of[first]:self.b_of[last]]
        a_sizes, b_sizes = a_sizes[groups], b_sizes[groups]
        a_cut, b_cut = self.a_cut[groups] - self.a_of[first], self.b_cut[groups] - self.b_of[first]
        ids, marks = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        # an A token has all B tokens of the groups before it in front, and vice versa
        ids[np.arange(len(a)) + np.repeat(b_cut - b_sizes, a_sizes)] = a
        ids[np.arange(len(b)) + np.repeat(a_cut, b_sizes)] = b
        marks[a_cut + b_cut - b_sizes - 1] = ord("|")
        marks[a_cut + b_cut - 1] = ord(";")
        raw, ends = joined_ids(ids, marks)
        bounds = np.append(0, ends)[a_of + b_of]
        # without the last ;
        return [hashlib.sha256(memoryview(raw)[x:y - 1]).hexdigest() if y > x else ""
                for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (pair, document), in this order, and the links of each; a pair is a << 32 | b."""
        a_sizes, b_sizes = self.a_sizes, self.b_sizes
        doc = np.repeat(np.arange(len(self.group_of) - 1), np.diff(self.group_of))
        if not len(doc):
            return (np.zeros(0, np.int64),) * 3
        # (a, b, document) as one number; a block has under 2**20 documents
        wide_b, wide_doc = int(self.b.max()) + 1, int(doc.max()) + 1
        narrow = np.flatnonzero(a_sizes * b_sizes <= WIDE)
        # about LINKS of them at a time: only the distinct ones of each part are kept
        upto = np.cumsum((a_sizes * b_sizes)[narrow]) // LINKS
        parts = []
        for some in np.split(narrow, np.flatnonzero(np.diff(upto)) + 1):
            a_rows = _ranges((self.a_cut - a_sizes)[some], a_sizes[some])
            group = np.repeat(some, a_sizes[some])
            width = b_sizes[group]
            key = np.repeat(self.a[a_rows] * wide_b, width) + self.b[_ranges((self.b_cut - b_sizes)[group], width)]
            parts.append(np.unique(key * wide_doc + np.repeat(doc[group], width), return_counts=True))
        for g in np.flatnonzero(a_sizes * b_sizes > WIDE):
            x, n_x = np.unique(self.a[self.a_cut[g] - a_sizes[g]:self.a_cut[g]], return_counts=True)
            y, n_y = np.unique(self.b[self.b_cut[g] - b_sizes[g]:self.b_cut[g]], return_counts=True)
            parts.append((((x[:, None] * wide_b + y).ravel() * wide_doc + doc[g]), np.outer(n_x, n_y).ravel()))
        key, n = (np.concatenate([p[i] for p in parts]) for i in range(2))
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, np.diff(key) > 0))
        pair, held = np.divmod(key[first], wide_doc)
        a, b = np.divmod(pair, wide_b)
        return (a << np.int64(32)) | b, held, np.add.reduceat(n, first)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    of = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=of[1:])
    return np.concatenate([np.zeros(0, np.int64), *lists], dtype=np.int64), of


def _sizes(side: ByteBpe | Pieces) -> np.ndarray:
    return np.fromiter(map(len, side.bytes), np.int64, len(side.bytes))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for size numbers, one range after the other."""
    total = int(size.sum())
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(total)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows doc_id, text in batches of whole texts with about limit characters."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths):
            size += n + ROW_BYTES
            if size >= limit:
                yield pa.Table.from_batches([*held, batch.slice(at, i + 1 - at)])
                held, size, at = [], 0, i + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _lists(values: np.ndarray, of: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(values, kind))


def _given(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """doc_id, the ids of both sides (a, b), and the tokens of each group on each side (a_sizes, b_sizes)."""
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteBpe(path_a), Pieces(path_b)
        for rows in _blocks(batches, limit):
            block = Block(rows.column("text").to_pylist(), a, b)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").combine_chunks(), _lists(block.a, block.a_of, pa.int32()),
                 _lists(block.b, block.b_of, pa.int32()), _lists(block.a_sizes, block.group_of, pa.int32()),
                 _lists(block.b_sizes, block.group_of, pa.int32())], ["doc_id", "a", "b", "a_sizes", "b_sizes"])

    return _given(docs).mapInArrow(
        run, "doc_id long, a array<int>, b array<int>, a_sizes array<int>, b_sizes array<int>")


_FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
_BLOCK_ROW = ", ".join(["block long", *(f"{c} array<long>" for c in _FIGURES), "groups_sha256 array<string>",
                        "pairs array<long>", "pair_docs array<int>", "holder array<int>", "links array<long>"])


def linked_blocks(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """One row per block: figures of its documents, its id pairs (a << 32 | b) with the
    number of documents that hold each, and for each pair these documents and their links."""
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteBpe(path_a), Pieces(path_b)
        # unique among the tasks whose output is kept
        number = TaskContext.get().partitionId() << 32
        for rows in _blocks(batches, limit):
            block = Block(rows.column("text").to_pylist(), a, b)
            key, doc, links = block.links()
            pairs, held = np.unique(key, return_counts=True)
            n_links = np.zeros(rows.num_rows, np.int64)
            np.add.at(n_links, doc, links)
            columns = [rows.column("doc_id").combine_chunks(), np.diff(block.a_of), np.diff(block.b_of),
                       np.diff(block.group_of), n_links, pa.array(block.digests(), pa.string()), pairs,
                       held.astype(np.int32), doc.astype(np.int32), links]
            whole = [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 *(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in whole)],
                ["block", *_FIGURES, "groups_sha256", "pairs", "pair_docs", "holder", "links"])
            number += 1

    return _given(docs).mapInArrow(run, _BLOCK_ROW)


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of each pair per band of blocks (pair, band, n), and whole: pair, count, best."""
    n_blocks = blocks.count()
    bands = max(1, -(-n_blocks // BAND_BLOCKS))
    rows = blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(bands)).alias("band"), F.inline(
        F.arrays_zip(F.col("pairs").alias("pair"), F.col("pair_docs").alias("n"))))
    banded = rows.groupBy("pair", "band").agg(F.sum("n").alias("n"))
    whole = banded.groupBy("pair").agg(F.sum("n").alias("count"))
    top = whole.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("top"))
    rated = whole.withColumn("a", F.shiftright("pair", 32)).join(top, "a").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best"))
    return rows, banded.drop("n").join(rated, "pair")


_SCORES = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _scored(block: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block, with the counts of its pairs."""
    row = {c: block.column(c).combine_chunks().flatten() for c in block.column_names if c != "block"}
    pairs = row["pairs"].to_numpy()
    order = np.argsort(counts.column("pair").to_numpy())
    held = np.repeat(np.searchsorted(counts.column("pair").to_numpy()[order], pairs), row["pair_docs"].to_numpy())
    doc, links = row["holder"].to_numpy(), row["links"].to_numpy()
    n_best, total = (np.zeros(len(row["doc_id"]), np.int64) for _ in range(2))
    if len(pairs):
        np.add.at(total, doc, links * counts.column("count").to_numpy()[order][held])
        np.add.at(n_best, doc, links * counts.column("best").to_numpy(zero_copy_only=False)[order][held])
    return pa.table([*(row[c] for c in _FIGURES), pa.array(n_best), pa.array(total), row["groups_sha256"]],
                    [*_FIGURES, "n_best", "count_sum", "groups_sha256"])


def link_scores(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """Per document the tokens, groups and links, and how common its links are in the corpus."""
    blocks = cut_lineage(linked_blocks(docs, path_a, path_b))
    rows, counts = pair_counts(blocks)
    rated = rows.drop("n").join(counts, ["pair", "band"]).select(
        F.col("block").alias("of"), "pair", "count", "best")
    return blocks.groupBy("block").cogroup(rated.groupBy("of")).applyInArrow(_scored, _SCORES)


QUERY = "op12_token_alignment"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_scores(table(spark, sf_dir, "documents"))
