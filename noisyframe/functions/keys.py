"""Deterministic row keys and small column helpers.

Sampling, fold assignment and shuffles order rows by a key computed from the row
id only, so a result never depends on partitioning, task order or a re-run after
executor loss (unlike ``rand()`` or ``randomSplit``).

The key is a mixing hash of (id, seed, purpose), which DuckDB computes as well:

    key = the first 12 hex digits of md5("id|seed|purpose"), as a number

so that two seeds, and two purposes under one seed, order the rows independently.
``key_sql`` is the same expression as SQL text for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_DIGITS = 12
KEY_MODULUS = 16 ** KEY_DIGITS


def seeded_key(row_id: Column | str, seed: int, purpose: str = "sample") -> Column:
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    text = F.concat(rid.cast("bigint").cast("string"), F.lit(f"|{int(seed)}|{purpose}"))
    return F.conv(F.substring(F.md5(text), 1, KEY_DIGITS), 16, 10).cast("bigint")


def key_sql(row_id: str, seed: int, purpose: str = "sample") -> str:
    text = f"CAST({row_id} AS BIGINT) || '|{int(seed)}|{purpose}'"
    return f"CAST('0x' || substr(md5({text}), 1, {KEY_DIGITS}) AS BIGINT)"


def r6(c: Column) -> Column:
    """Round a double to 6 places: the precision oracle comparisons use."""
    return F.round(c, 6)


def argmax_first(arr: Column) -> Column:
    """0-based index of the first maximum of an array (numpy ``argmax``)."""
    return F.array_position(arr, F.array_max(arr)) - F.lit(1)
