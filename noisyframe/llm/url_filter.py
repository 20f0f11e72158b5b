"""URL filters: host-suffix and path-prefix expressions joined to a rule list.

A URL's host goes from the first ``://`` to ``/``, ``?``, ``#`` or the end, with
A-Z in lower case; its path from there to ``?``, ``#`` or the end.  Without
``://``, and for a null URL, both are empty.

Each URL is expanded into expressions host suffix + path prefix: all suffixes at
label borders, and the prefixes that end at a ``/`` (for rules whose path ends
otherwise, also those of the lengths that such rules have).  The expressions meet
the rules in an equi-join on the first four bytes of their SHA-256, then the full
digest confirms.  Of the rules that fit, the longest (host and path together)
wins; then the longer host; then block before allow.  A URL that no rule fits
gets ``DEFAULT``.

Scale: URLs are judged once for each distinct (host, path).  The join is a
broadcast only if the rules have been counted to at most ``BROADCAST_RULES``;
beyond that it is a shuffle join whose hot prefixes the adaptive skew join splits.
No expression is dropped.  DataFrame functions only.

Defined cases: null or malformed URLs have an empty host and path, fit no rule and
get the default.  Rules with a null or empty host or path fit nothing.  Of equal
rules with different verdicts, block wins.  Every row of pages gives a row.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The rules of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
DEFAULT = "allow"
PREFIX_HEX = 8
BROADCAST_RULES = 50_000
MAX_LENGTHS = 1_000


def parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host and path of a URL."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def host_suffixes(host: F.Column, most: int) -> F.Column:
    """The suffixes of a host of at most so many labels: from its last ``most`` labels on."""
    labels = F.split(host, r"\.", -1)
    last = F.when(F.size(labels) > most, F.slice(labels, -most, most)).otherwise(labels)
    return F.element_at(F.transform(F.array(last), lambda x: F.transform(
        F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), "."))), 1)


def path_prefixes(path: F.Column, lengths: list[int], longest: int) -> F.Column:
    """Prefixes of up to ``longest`` characters that end at a slash, and those of the given lengths."""
    short = F.substring(path, 1, longest)
    slashed = F.filter(F.transform(F.sequence(F.lit(1), F.length(short)), lambda i: F.substring(short, F.lit(1), i)),
                       lambda x: x.endswith("/"))
    if not lengths:
        return slashed
    fixed = F.filter(F.array(*[F.when(F.length(short) >= n, F.substring(short, 1, n)) for n in lengths]),
                     lambda x: x.isNotNull())
    return F.array_distinct(F.concat(slashed, fixed))


def rule_table(rules: DataFrame) -> DataFrame:
    """verdict, host, path -> digest, prefix, rank (larger wins), rule, verdict; one row per rule."""
    given = rules.where("host <> '' and path <> ''").select(
        F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path", "verdict")
    # 'block' sorts after 'allow': the maximum prefers it
    one = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    text = F.concat("host", "path")
    digest = F.sha2(F.concat_ws("\n", "host", "path"), 256)
    return one.select(
        digest.alias("digest"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"),
        F.struct(F.length(text).alias("size"), F.length("host").alias("host_size"), F.col("verdict"),
                 text.alias("rule")).alias("rank"))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """All columns of urls, with host, path, rule and verdict as columns of a struct ``judged``."""
    table_ = rule_table(rules)
    given = rules.where("host <> '' and path <> ''")
    lengths = sorted(r[0] for r in given.where("path not like '%/'").select(F.length("path").alias("n")).distinct()
                     .limit(MAX_LENGTHS + 1).collect())
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} lengths of rule paths that don't end at a slash")
    # no longer prefix or suffix can be a rule's
    longest, labels = given.agg(F.max(F.length("path")), F.max(F.size(F.split("host", r"\.", -1)))).first()
    host, path = parts(F.col(url).cast("string"))
    keyed = urls.withColumn("judged", F.struct(host.alias("host"), path.alias("path")))
    distinct = keyed.select("judged.host", "judged.path").distinct()
    expressions = (distinct.where("host <> '' and path <> ''")
                   .withColumn("starts", path_prefixes(F.col("path"), lengths, longest or 1))
                   .where(F.size("starts") > 0)
                   .withColumn("suffix", F.explode(host_suffixes(F.col("host"), labels or 1)))
                   .withColumn("start", F.explode("starts"))
                   .where("suffix <> ''")
                   .withColumn("digest", F.sha2(F.concat_ws("\n", "suffix", "start"), 256))
                   .select("host", "path", "digest", F.substring("digest", 1, PREFIX_HEX).alias("prefix")))
    small = table_.count() <= BROADCAST_RULES
    met = expressions.alias("e").join(
        (F.broadcast(table_) if small else table_).alias("r"),
        (F.col("e.prefix") == F.col("r.prefix")) & (F.col("e.digest") == F.col("r.digest")))
    best = met.groupBy("e.host", "e.path").agg(F.max("r.rank").alias("best"))
    joined = keyed.alias("k").join(best.alias("b"), (F.col("k.judged.host") == F.col("b.host"))
                                   & (F.col("k.judged.path") == F.col("b.path")), "left")
    return joined.select(
        *[F.col(f"k.`{c}`") for c in urls.columns if c != "judged"],
        F.struct(F.col("k.judged.host").alias("host"), F.col("k.judged.path").alias("path"),
                 F.col("b.best.rule").alias("rule"),
                 F.coalesce(F.col("b.best.verdict"), F.lit(DEFAULT)).alias("verdict")).alias("judged"))


QUERY = "op6_url_filter"

_HOST = """translate(CASE WHEN strpos(coalesce(url, ''), '://') > 0
  THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1) ELSE '' END,
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_PATH = """CASE WHEN strpos(coalesce(url, ''), '://') > 0
  THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"""
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
rules(verdict, rhost, rpath) AS (VALUES {', '.join(str(r) for r in RULES)}),
fits AS (SELECT p.*, r.verdict, r.rhost || r.rpath AS rule, length(r.rhost || r.rpath) AS size
         FROM (SELECT DISTINCT host, path FROM p) p, rules r
         WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
best AS (SELECT host, path, max_by(rule, size) AS rule, max_by(verdict, size) AS verdict FROM fits GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")
