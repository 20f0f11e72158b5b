"""Quality rules with risk-controlled thresholds.

Base signals of a text, over words ``[^\\x20\\x09-\\x0D]+``: n_words, word_chars,
n_symbols, n_dup_lines and n_repeat_words.  Base rules: n_words < 50, or more than
half of the words in repeated 3-word windows.

On top of them, each rule of ``RULES`` rejects a text whose ratio lies beyond a
cutoff, and the cutoffs are chosen from labelled rows for each stratum (language):

* The candidates are a fixed grid for each rule, so that no candidate depends on
  the labels.
* A cutoff is certified if the exact binomial test rejects "the rule rejects more
  than ``RISK / rules`` of the stratum's good texts": P(Bin(n, risk) <= x) at most
  the test's level, for x of n good texts beyond the cutoff.
* Grids are tested from the loosest cutoff on and stop at the first failure
  (fixed-sequence testing), which needs no correction along a grid.  Over strata
  and rules the level is ``DELTA`` / (strata * rules) (Bonferroni).  With
  probability 1 - DELTA the rules together reject at most RISK of the good texts in
  every stratum.
* Of the certified cutoffs the one with the largest surplus (share of bad texts
  rejected minus share of good texts rejected) is used; without surplus, or with
  too few labels to certify anything, the rule rejects nothing in that stratum.

Plan: one pass over the texts gives the signals, which are written to the shared
folder (a few numbers a row); labels meet them there, and the counts beyond all
grid points are one aggregation.  The thresholds are a row a stratum.  DataFrame
functions only, binomial sums included (a fold over the terms that count, some standard
deviations of them).

Defined cases: a null text has no words, and fails the base rules.  Null languages
are a stratum of their own.  Labels of unknown documents, null labels and null ids
are left out; of several labels of one document the lowest counts.  Every row of
documents gives a row.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import table

# Fixed values of the base rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# Risk control.
RISK, DELTA = 0.05, 0.05
# name -> (ratio is too high beyond the cutoff, cutoffs from the loosest to the strictest)
RULES = {
    "symbol_ratio": (True, [0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05]),
    "dup_line_ratio": (True, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "repeat_ratio": (True, [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "long_words": (True, [100.0, 50.0, 30.0, 20.0, 15.0, 12.0, 10.0]),
    "short_words": (False, [1.0, 1.5, 2.0, 2.5, 3.0]),
    "upper_ratio": (True, [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
}


def _let(value: F.Column, body) -> F.Column:
    """body(value), with value computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: F.Column) -> F.Column:
    """Words in 3-word windows that occur twice or more, from an array of words."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.xxhash64(
        F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))

    def covered(hashes: F.Column) -> F.Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(placed, marked)

    def marked(placed: F.Column) -> F.Column:
        n = F.size(placed)
        same = lambda i, j: F.get(placed, i)["h"] == F.get(placed, j)["h"]
        twice = F.filter(placed, lambda p, i: F.coalesce((i > 0) & same(i, i - 1), F.lit(False))
                         | F.coalesce((i < n - 1) & same(i, i + 1), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda p: p["i"]))
        return _let(places, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, i - 1)))),
            F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) < 4, 0).otherwise(_let(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w))))


def signals(docs: DataFrame) -> DataFrame:
    """doc_id, lang, and the base signals of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), text.alias("text"))
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    counted = given.select(
        "doc_id", "lang",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", string.ascii_uppercase, ""))).cast("long").alias("n_upper"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))).alias("x"),
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                       repeat_words(w).cast("long").alias("repeats"))).alias("w"))
    return counted.select(
        "doc_id", "lang", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_upper",
        (F.col("x.n") - F.col("x.distinct")).cast("long").alias("n_dup_lines"),
        F.col("w.repeats").alias("n_repeat_words"), F.col("x.n").cast("long").alias("n_lines"))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def ratios() -> dict[str, F.Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
        "short_words": F.col("word_chars") / words,
        "upper_ratio": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
    }


def _beyond(rule: str, ratio: F.Column, cutoff) -> F.Column:
    return ratio > cutoff if RULES[rule][0] else ratio < cutoff


_SMALL_FACTORIALS = [math.lgamma(i + 1) for i in range(32)]


def _log_factorial(m: F.Column) -> F.Column:
    """ln(m!), for larger m by Stirling's series."""
    x = F.greatest(m.cast("double"), F.lit(1.0))
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    small = F.get(F.array(*[F.lit(v) for v in _SMALL_FACTORIALS]), m.cast("int"))
    return F.when(m < len(_SMALL_FACTORIALS), small).otherwise(series)


def binomial_cdf(n: F.Column, x: F.Column, p: float) -> F.Column:
    """P(Bin(n, p) <= x).

    Below the mean the terms fall from x down, above it from x + 1 up (the other tail).
    They are added as multiples of the first one until none counts any more, which takes
    some standard deviations, 9.2 of them and a constant: not x terms.
    """
    below = x.cast("double") < n * F.lit(p)
    start = F.when(below, x).otherwise(x + 1)
    first = (_log_factorial(n) - _log_factorial(start) - _log_factorial(n - start)
             + start * F.lit(math.log(p)) + (n - start) * F.lit(math.log1p(-p)))
    terms = F.ceil(F.sqrt(n * F.lit(84 * p * (1 - p)))) + 100
    count = F.least(terms, F.when(below, start).otherwise(n - start))
    odds = F.lit(p / (1 - p))

    def add(acc: F.Column, i: F.Column) -> F.Column:
        down = (start - i + 1) / (n - start + i) / odds
        up = (n - start - i + 1) / (start + i) * odds
        term = acc["term"] * F.when(below, down).otherwise(up)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(count >= 1, F.sequence(F.lit(1).cast("long"), count)).otherwise(F.array().cast("array<long>"))
    tail = F.exp(first) * F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add,
                                      lambda a: a["total"])
    return F.when(n <= 0, F.lit(1.0)).when(x >= n, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.when(below, tail).otherwise(1 - tail)))


def thresholds(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """lang and one cutoff column per rule (null: the rule is off in that stratum)."""
    one = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long"))
           .agg((F.min("quality") > 0).alias("good")))
    graded = measured.where(~base_failed()).join(one, "doc_id")
    points = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("place"), F.lit(c).alias("cutoff"),
                                _beyond(rule, ratios()[rule], c).alias("beyond"))
                       for rule, (_, grid) in RULES.items() for i, c in enumerate(grid)])
    counts = cut_lineage(
        graded.select("lang", "good", F.explode(points).alias("p"))
              .groupBy("lang", "p.rule", "p.place", "p.cutoff")
              .agg(F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("p.beyond")).alias("x"),
                   F.count_if(~F.col("good")).alias("n_bad"),
                   F.count_if(~F.col("good") & F.col("p.beyond")).alias("x_bad")))
    strata = counts.select("lang").distinct().count()
    level = DELTA / (max(1, strata) * len(RULES))
    safe = binomial_cdf(F.col("n"), F.col("x"), RISK / len(RULES)) <= level
    surplus = (F.col("x_bad") / F.greatest("n_bad", F.lit(1))) - (F.col("x") / F.greatest("n", F.lit(1)))
    # a grid is an array of a few points; it is certified up to its first failure
    grids = counts.groupBy("lang", "rule").agg(F.sort_array(F.collect_list(
        F.struct("place", safe.alias("safe"), surplus.alias("surplus"), "cutoff"))).alias("grid"))
    failed = F.array_min(F.transform(F.filter("grid", lambda g: ~g["safe"]), lambda g: g["place"]))
    usable = F.filter("grid", lambda g: (g["place"] < F.coalesce(failed, F.lit(1 << 30))) & (g["surplus"] > 0))
    best = F.array_max(F.transform(usable, lambda g: F.struct(g["surplus"].alias("surplus"),
                                                              g["place"].alias("place"), g["cutoff"].alias("cutoff"))))
    return grids.select("lang", "rule", best["cutoff"].alias("cutoff")).groupBy("lang").pivot(
        "rule", list(RULES)).agg(F.first("cutoff"))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, base signals, base_failed, kept and the first rule that rejects."""
    measured = cut_lineage(signals(docs))
    cutoffs = cut_lineage(thresholds(measured, labels)).withColumnRenamed("lang", "stratum")
    joined = measured.join(cutoffs, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    rejecting = F.coalesce(*[F.when(_beyond(r, ratio, F.col(r)), F.lit(r)) for r, ratio in ratios().items()])
    return joined.select(
        *measured.columns, base_failed().alias("base_failed"), rejecting.alias("rejected_by"),
        (~base_failed() & rejecting.isNull()).alias("kept"))


QUERY = "op7_quality_rules"

_GRID = ", ".join(f"('{rule}', {i}, {c!r}, {str(high).lower()})"
                  for rule, (high, grid) in RULES.items() for i, c in enumerate(grid))
_RATIO = """CASE rule WHEN 'symbol_ratio' THEN n_symbols / greatest(word_chars, 1)
  WHEN 'dup_line_ratio' THEN n_dup_lines / greatest(n_lines, 1) WHEN 'repeat_ratio' THEN n_repeat_words / greatest(n_words, 1)
  WHEN 'upper_ratio' THEN n_upper / greatest(word_chars, 1) ELSE word_chars / greatest(n_words, 1) END"""
_BEYOND = f"CASE WHEN high THEN {_RATIO} > cutoff ELSE {_RATIO} < cutoff END"
_P = RISK / len(RULES)
ORACLE_SQL = f"""
WITH t AS MATERIALIZED (SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
g AS MATERIALIZED (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, tri) AS times
  FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS k, unnest(list_transform(range(1, len(w) - 1),
    lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS tri FROM t WHERE len(w) > 2)),
r AS (SELECT doc_id, count(DISTINCT hit) AS n FROM (SELECT doc_id, unnest(range(k, k + 3)) AS hit FROM g WHERE times > 1)
  GROUP BY doc_id),
m AS MATERIALIZED (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(w) < {MIN_WORDS} OR 100 * coalesce(r.n, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
  FROM t LEFT JOIN r USING (doc_id)),
grid(rule, place, cutoff, high) AS (VALUES {_GRID}),
one AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
c AS MATERIALIZED (SELECT lang, rule, place, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND {_BEYOND}) AS x,
    count(*) FILTER (NOT good) AS n_bad, count(*) FILTER (NOT good AND {_BEYOND}) AS x_bad
  FROM m JOIN one USING (doc_id), grid WHERE NOT base_failed GROUP BY ALL),
p AS MATERIALIZED (SELECT *, x_bad / greatest(n_bad, 1) - x / greatest(n, 1) AS surplus, CASE WHEN n = 0 OR x >= n THEN 1.0 ELSE
    (SELECT sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({_P}) + (n - k) * ln(1 - {_P})))
     FROM (SELECT unnest(range(0, x + 1)) AS k)) END
    <= {DELTA} / ((SELECT count(DISTINCT coalesce(lang, '')) FROM c) * {len(RULES)}) AS safe FROM c),
f AS (SELECT *, min(place) FILTER (NOT safe) OVER (PARTITION BY lang, rule) AS failed FROM p),
b AS (SELECT lang, rule, cutoff FROM (SELECT *, row_number() OVER (PARTITION BY lang, rule ORDER BY surplus DESC, place DESC) AS rn
    FROM f WHERE place < coalesce(failed, 1000000) AND surplus > 0) WHERE rn = 1),
bad AS (SELECT DISTINCT doc_id FROM m JOIN b ON m.lang IS NOT DISTINCT FROM b.lang
    JOIN (SELECT DISTINCT rule, high FROM grid) h USING (rule) WHERE {_BEYOND})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM m"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")
