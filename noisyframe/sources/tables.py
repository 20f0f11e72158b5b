"""Table input: the driver's Parquet tables and the weak-label frames built on them.

A weak-label frame has ``row_id BIGINT``, ``label INT`` and feature columns whose
role is given by the name prefix: ``c_`` category, ``n_`` number, ``t_`` time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The column role prefixes of the input contract.
CAT_PREFIX = "c_"
NUM_PREFIX = "n_"
TIME_PREFIX = "t_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Roles:
    """Column roles of a weak-label frame."""

    cat: list = field(default_factory=list)
    num: list = field(default_factory=list)
    time: list = field(default_factory=list)

    @property
    def raw(self) -> list:
        """Raw input columns: prefix plus one name part, as in ``c_1``, ``n_2``."""
        return [c for c in self.cat + self.num if len(c.split("_")) == 2]

    @classmethod
    def infer(cls, df: DataFrame, schema: dict | None = None) -> "Roles":
        """From a declared ``{col: 'cat'|'num'|'time'}`` map, else from prefixes."""
        if schema:
            r = cls()
            for c, kind in schema.items():
                if kind not in ("cat", "num", "time"):
                    raise ValueError(f"column {c!r} is declared as {kind!r}: cat, num or time")
                {"cat": r.cat, "num": r.num, "time": r.time}[kind].append(c)
            return r
        return cls(
            cat=[c for c in df.columns if c.startswith(CAT_PREFIX)],
            num=[c for c in df.columns if c.startswith(NUM_PREFIX)],
            time=[c for c in df.columns if c.startswith(TIME_PREFIX)],
        )

    def validate(self, df: DataFrame) -> None:
        types = dict(df.dtypes)
        for c in self.cat + self.num + self.time:
            if c not in types:
                raise ValueError(f"declared column {c!r} is missing")
        for c in self.num:
            if types[c] in ("string", "boolean", "date", "binary") or types[c].startswith(("timestamp", "array", "map", "struct")):
                raise ValueError(f"number column {c!r} has type {types[c]}")
        for c in self.time:
            if not types[c].startswith("timestamp") and types[c] != "date":
                raise ValueError(f"time column {c!r} has type {types[c]}")


def declared_frame(df: DataFrame, schema: dict, row_id: str, label: str | None = None) -> DataFrame:
    """A weak-label frame from a declared ``{col: 'cat'|'num'|'time'}`` map, whatever the names.

    Columns are checked against the map and become ``c_1 ..``, ``n_1 ..``, ``t_1 ..`` in its
    order: categories as strings, numbers as doubles.  Other columns are left out.
    """
    roles = Roles.infer(df, schema)
    roles.validate(df)
    out = [F.col(row_id).cast("bigint").alias("row_id")]
    for prefix, cols, kind in ((CAT_PREFIX, roles.cat, "string"), (NUM_PREFIX, roles.num, "double"), (TIME_PREFIX, roles.time, None)):
        out += [(F.col(c).cast(kind) if kind else F.col(c)).alias(f"{prefix}{i + 1}") for i, c in enumerate(cols)]
    return df.select(*out, *([F.col(label).alias("label")] if label else []))


# ---------------------------------------------------------------- frames (FIXTURES)

def pu_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to their customer; positives are even-keyed finished orders."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").alias("c_1"),
        F.col("c_mktsegment").alias("c_2"),
        F.col("c_nationkey").cast("string").alias("c_3"),
        F.col("o_custkey").cast("string").alias("c_4"),
        F.col("o_totalprice").alias("n_1"),
        F.col("c_acctbal").alias("n_2"),
        F.col("o_orderdate").alias("t_1"),
        F.when((F.col("o_orderstatus") == "F") & (F.pmod(F.col("o_orderkey"), F.lit(2)) == 0), 1)
        .otherwise(0).alias("label"),
    )


LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]


def lineitem_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with an exact global row number over all its columns.

    ``(l_orderkey, l_linenumber)`` is not unique, so the id is a row number over
    every column, by range partitioning on all of them.
    """
    return global_row_number(table(spark, sf_dir, "lineitem"),
                             [F.col(c).asc_nulls_last() for c in LINEITEM_ORDER], "row_id")


def noisy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rule label ``l_quantity > 25`` with every fifth row flipped."""
    li = lineitem_numbered(spark, sf_dir)
    y_true = F.when(F.col("l_quantity") > 25, 1).otherwise(0)
    return li.select(
        F.col("row_id").cast("bigint").alias("row_id"),
        F.col("l_returnflag").alias("c_1"),
        F.col("l_linestatus").alias("c_2"),
        F.floor(F.col("l_quantity") / 5).cast("int").cast("string").alias("c_3"),
        F.col("l_suppkey").cast("string").alias("c_4"),
        F.col("l_partkey").cast("string").alias("c_5"),
        F.col("l_quantity").alias("n_1"),
        F.col("l_extendedprice").alias("n_2"),
        F.col("l_discount").alias("n_3"),
        F.col("l_tax").alias("n_4"),
        F.col("l_shipdate").alias("t_1"),
        y_true.alias("y_true"),
        F.when(F.pmod(F.col("row_id"), F.lit(5)) == 0, F.lit(1) - y_true).otherwise(y_true)
        .alias("label"),
    )


def ssl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a quarter of the events carry a label (1 / -1), the rest are 0 (unlabelled)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("c_1"),
        F.col("user_id").cast("string").alias("c_2"),
        F.col("value").alias("n_1"),
        F.col("ts").alias("t_1"),
        F.when(F.pmod(F.col("event_id"), F.lit(4)) != 0, 0)
        .when(F.col("value") > 50, 1).otherwise(-1).alias("label"),
    )


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with human-style labels; unlabelled documents get NULL."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("c_1"),
        F.col("source").alias("c_2"),
        F.col("n_chars").cast("double").alias("n_1"),
        "text",
        F.col("quality").alias("label"),
        "toxic",
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-d vectors with a 10-class label."""
    return table(spark, sf_dir, "embeddings")


def multi_label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labelled documents with ``labels ARRAY<INT>``: quality, plus 2 if toxic."""
    f4 = noisy_documents(spark, sf_dir).where(F.col("label").isNotNull())
    labels = F.when(F.col("toxic") == 1, F.array(F.col("label"), F.lit(2))).otherwise(
        F.array(F.col("label")))
    return f4.withColumn("labels", labels)


FRAMES = {
    "pu_orders": pu_orders,
    "noisy_lineitem": noisy_lineitem,
    "ssl_events": ssl_events,
    "noisy_documents": noisy_documents,
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FRAMES[name](spark, sf_dir)
