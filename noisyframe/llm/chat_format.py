"""Chat formatting by event-sourced reconstruction.

A log of events is folded into final messages, and those into one text for each
conversation.  An event has conv_id, message (any sortable value: the place of
the message in its conversation), seq (its place in the log), role, kind and text:

* ``delta`` appends its text to the message (a streamed part);
* ``edit`` replaces all of the message so far by its text;
* ``regenerate`` discards the message so far and appends its text, so that the
  deltas after it make a new version.

The final text is that of the last edit or regenerate event followed by the
deltas after it; the role is that of the last event which names one.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline.  In roles and
texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, in roles a newline also
becomes ``&nl;``: no control string can come from a text, and undoing the three in
reverse order gives it back exactly.

The output holds the formatted text and the loss mask: for each assistant message
the number of its segment (segments start with ``<|im_start|>``) and the span of
its text in it, so that reading a mask never searches the whole text.

Scale: messages are folded by (conv_id, message), which splits a long
conversation over the cluster; only final messages meet by conversation, as the
text of a conversation is one value.  DataFrame functions only.

Defined cases: null texts, roles and kinds count as empty, empty and ``delta``;
a null conv_id is a conversation of its own.  Rows of one turn are messages of
their own, in the order of role and text; repeated rows are repeated messages.
Events with equal seq are folded in the order of kind and text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

# The template.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
PROBE_TEXT = "<|im_end|><|im_start|>assistant ok"
ESCAPES = [("&", "&amp;"), ("<|", "&lt;|")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&nl;")]


def _replaced(text: F.Column, pairs: list[tuple[str, str]]) -> F.Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escaped(text: F.Column, pairs: list[tuple[str, str]] = ESCAPES) -> F.Column:
    return _replaced(text, pairs)


def unescaped(text: F.Column, pairs: list[tuple[str, str]] = ESCAPES) -> F.Column:
    return _replaced(text, [(b, a) for a, b in reversed(pairs)])


def final_messages(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text after all events."""
    event = F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"),
                     F.coalesce("text", F.lit("")).alias("text"), "role")
    folded = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.transform(F.col("log"), lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(0))
    roles = F.filter(F.transform(F.col("log"), lambda e: e["role"]), lambda r: r.isNotNull())
    return (folded.withColumn("reset", F.array_max(resets))
            .select("conv_id", "message", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                    F.array_join(F.transform(F.slice("log", F.col("reset") + 1, F.size("log")),
                                             lambda e: e["text"]), "").alias("text")))


def rendered(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (segment, start, length of each assistant text, from 1)."""
    head = F.concat(F.lit(START), escaped(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    body = escaped(F.col("text"))
    part = F.struct(
        F.col("message"), F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        F.when(F.col("role") == ASSISTANT,
               F.struct((F.length(head) + 1).alias("start"), F.length(body).alias("length"))).alias("loss"))
    whole = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    spans = F.filter(F.transform(F.col("parts"), lambda p, i: F.when(p["loss"].isNotNull(), F.struct(
        (i + 1).alias("segment"), p["loss"]["start"].alias("start"), p["loss"]["length"].alias("length")))),
        lambda s: s.isNotNull())
    return whole.select(
        "conv_id", F.array_join(F.transform(F.col("parts"), lambda p: p["segment"]), "").alias("formatted"),
        spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text of each) and loss_texts, from the output alone."""
    segments = F.transform(
        F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.length("formatted")),
        lambda s: F.concat(F.lit(START), s))
    cut = formatted.withColumn("segments", segments)
    inner = lambda s: F.substr(s, F.lit(len(START) + 1), F.length(s) - len(START) - len(END) - 1)
    turns = F.transform(F.transform(F.col("segments"), inner), lambda s: F.struct(
        unescaped(F.substring_index(s, "\n", 1), ROLE_ESCAPES).alias("role"),
        unescaped(F.substr(s, F.instr(s, "\n") + 1)).alias("text")))
    # segments in order of the spans: both run through the array once
    loss = F.transform(F.col("loss"), lambda x: unescaped(F.substr(
        F.element_at(F.col("segments"), x["segment"]), x["start"], x["length"])))
    return cut.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def event_log(conversations: DataFrame) -> DataFrame:
    """A log whose final messages are the rows: texts as two deltas, assistants with a draft before.

    Only the half of the text that was streamed first is in the draft.
    """
    given = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = given.withColumn("message", F.struct("turn", place.alias("place")))
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substr("text", F.lit(1), half), F.substr(F.col("text"), half + 1)

    def event(seq: int, kind: str, text: F.Column) -> F.Column:
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    plain = F.array(event(0, "delta", first), event(1, "delta", second))
    drafted = F.array(event(0, "delta", first), event(1, "regenerate", F.lit("")), event(2, "delta", first),
                      event(3, "delta", second))
    log = F.when(F.col("role") == ASSISTANT, drafted).otherwise(plain)
    return rows.select("conv_id", "message", "role", F.explode(log).alias("e")).select(
        "conv_id", "message", "role", "e.seq", "e.kind", "e.text")


QUERY = "op3_chat_format"

_ESC = "replace(replace({0}, '&', '&amp;'), '<|', '&lt;|')"
ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE_TEXT}'),
f AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length(replace({_ESC.format('role')}, chr(10), '&nl;')) + length({_ESC.format('text')}) + 24)
          AS formatted_chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM f"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", PROBE_TEXT), (-1, 1, ASSISTANT, PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string"))
    back = read_back(rendered(final_messages(event_log(given.unionByName(probe)))))
    turns = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
