"""Token counts of a unigram tokenizer, without making the tokens.

A text is normalised (a leading and every other space becomes the word mark) and
the vocabulary's matches are enumerated by an Aho-Corasick automaton.  Dynamic
programming over the end positions carries only the best score and the number of
pieces.  The exact tie rules of the tokenizer:

* at one end position a later start replaces the best path only if its score is
  strictly larger, so that of equal scores the longest last piece wins;
* a character that is no piece by itself may be an unknown one, at the least
  score of the vocabulary minus 10; it counts as its UTF-8 bytes (byte fallback);
* scores are added in double precision, in text order.

No piece of the vocabulary holds the word mark after another character (checked
when it is loaded; a vocabulary that has such pieces is run over whole texts), so
that a text falls into chunks at its word marks, which are tokenised one by one;
a bounded memo of short chunks serves the words that recur.  Memory is bounded by
the memo and the longest text.  Best scores are integers if the vocabulary's are.

The vocabulary comes from a file whose path is a parameter.  It is read on the
driver and broadcast: ``MAX_VOCABULARY`` pieces at most.

Defined cases: null or empty text: 0 tokens, score 0.  Characters that cannot be
decoded don't occur in a string column.  Repeated rows are counted alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
MAX_VOCABULARY = 1_000_000
MEMO = 400_000
MEMO_CHUNK = 48


def read_vocabulary(path: str = TOKENIZER) -> list[tuple[str, float]]:
    """Ordinary pieces and their scores; control, unknown and byte pieces are none."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} pieces")
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Counter:
    """Counts the pieces of the best segmentation.

    Results are complex numbers, the piece count in the real part and the score in
    the imaginary one, so that a text's chunks are added up in one built-in sum.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary)
        self.matcher = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.matcher.add_word(piece, (len(piece), score))
        if vocabulary:
            self.matcher.make_automaton()
        self.memo: dict[str, complex] = {}
        self.older: dict[str, complex] = {}

    def chunk(self, text: str) -> complex:
        """Pieces and score of the best segmentation of a text with its marks."""
        size = len(text)
        best, pieces = [float("-inf")] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        # ends whose last character may be an unknown one; it is tried after all matches
        unknown = [] if self.singles.issuperset(text) else [
            i + 1 for i, c in enumerate(text) if c not in self.singles]
        matches = self.matcher.iter(text) if len(self.matcher) else ()
        if not unknown:
            # matches come by end position, the longest (earliest start) first
            for at, (length, value) in matches:
                start = at + 1 - length
                score = best[start] + value
                if score > best[at + 1]:
                    best[at + 1], pieces[at + 1] = score, pieces[start] + 1
            return complex(pieces[size], best[size])
        waiting = iter([*unknown, size + 1])
        stop = next(waiting)
        for at, (length, value) in matches:
            while stop <= at:
                self._try_unknown(text, stop, best, pieces)
                stop = next(waiting)
            start = at + 1 - length
            score = best[start] + value
            if score > best[at + 1]:
                best[at + 1], pieces[at + 1] = score, pieces[start] + 1
        while stop <= size:
            self._try_unknown(text, stop, best, pieces)
            stop = next(waiting)
        return complex(pieces[size], best[size])

    def _try_unknown(self, text: str, end: int, best: list[float], pieces: list[int]) -> None:
        score = best[end - 1] + self.unknown
        if score > best[end]:
            best[end] = score
            pieces[end] = pieces[end - 1] + len(text[end - 1].encode("utf-8", "replace"))

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if not self.by_word:
            found = self.chunk(MARK + text.replace(" ", MARK))
            return int(found.real), found.imag
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            words = _join_marks(words)
        total = 0j
        known = map(self.memo.get, words)
        for word, found in zip(words, known, strict=True):
            if found is None:
                found = self.memo.get(word)
                if found is None:
                    found = self._learn(word)
            total += found
        return int(total.real), total.imag

    def _learn(self, word: str) -> complex:
        found = self.older.get(word)
        if found is None:
            found = self.chunk(word if word[0] == MARK else MARK + word)
        if len(word) <= MEMO_CHUNK:
            if len(self.memo) >= MEMO:      # two generations: what recurs is moved on
                self.older, self.memo = self.memo, {}
            self.memo[word] = found
        return found


def _join_marks(words: list[str]) -> list[str]:
    """Each word after several spaces with all its marks; marks at the end as a word of their own."""
    out, marks = [], MARK
    for word in words:
        if word:
            out.append(word if marks == MARK else marks + word)
            marks = MARK
        else:
            marks += MARK
    return [*out, marks[1:]] if len(marks) > 1 else out


def token_counts(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, score double")


QUERY = "op1_token_counts"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
