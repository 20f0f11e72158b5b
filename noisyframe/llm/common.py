"""Shared helpers: reading tables, Arrow batches of text, word spans and hashes.

Texts travel from the JVM to the Python workers in Arrow batches.  Inside a
batch the texts are laid end to end in one byte buffer with a newline between
them, and words are found and hashed with numpy over the whole buffer, so that
no Python loop runs over characters or words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..session import import_path

# Rows of one Arrow batch.  Bounds a worker's memory by this many texts.
BATCH_ROWS = 128
# Words above this many bytes are hashed one by one, shorter ones by columns.
LONG_WORD = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of a few rows: a batch of long texts stays small."""
    import_path(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower() -> np.ndarray:
    """Byte table that maps A-Z to a-z and every other byte to itself."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_words() -> np.ndarray:
    """Byte table of the words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def alnum_words() -> np.ndarray:
    """Byte table of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of the texts of an Arrow string column, None where null."""
    return column.cast(pa.binary()).to_pylist()


def lay_out(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, a newline after each; and where each one starts."""
    lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    raw = b"\n".join(t or b"" for t in texts) + b"\n"
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer(raw, np.uint8), starts


def word_spans(buf: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of word bytes."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = word_bytes[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word, equal for equal bytes."""
    sizes = ends - starts
    out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    alive = np.flatnonzero(sizes <= LONG_WORD)
    at, left = starts[alive], sizes[alive]
    step = 0
    while len(alive):
        out[alive] = (out[alive] ^ buf[at + step]) * np.uint64(0x100000001B3D4A65)
        step += 1
        more = left > step
        if not more.all():
            alive, at, left = alive[more], at[more], left[more]
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(buf[starts[i]:ends[i]].tobytes())
    return mix64(out)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
