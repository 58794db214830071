"""Chat formatting with prefix-target expansion, in DataFrame operations only.

A turn is written as ``<s>[INST] role [/INST]\\n`` text ``</s>\\n``. In a role or text every control string gets one
more backslash after its first character (``<\\s>``, ``[\\INST]``), so control strings occur only as marks and taking
one backslash away restores the text exactly.

Every assistant turn is an example of its own, written out in full: its text is the formatted conversation up to and
with the reply, and only the reply's characters are under the loss mask. So the examples of one conversation grow with
the square of its turns. Each ``SPAN`` turns of a conversation that hold a reply get the turns before them once and
make their examples together, so a long conversation is expanded by many tasks, none of which holds more than
the conversation once and an example.

A store is a folder with three Parquet tables, linked by a row number:

``segments``  row, conv_id, turn, role, tie, segment, body_start, body_chars
``places``    row, conv_id, seq (from 0), start, n_chars
``examples``  row, conv_id, example (from 0), context_chars, loss_start, loss_chars, text

Places are code points from the conversation's, and so the example's, start (body_start: from the segment's). Turns are put in order by
their keys and lengths alone, dealt out by ranges of turns, so one long conversation is placed by many tasks; the
texts are written, then brought together for the examples.

Defined cases: a null text or role is empty; rows are ordered by turn, then role, nulls first, then the md5 of the text,
and repeated rows are turns of their own; a null conv_id is a conversation; one without an assistant has turns and no
examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm.common import ordered_starts, stored

OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST]\n", "</s>\n"
TRAINED = "assistant"
#: Turns of a conversation whose examples are made together.
SPAN = 64


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)(/?s>)", "<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def write_chats(conversations: DataFrame, path: str) -> None:
    """Format ``conversations`` (conv_id, turn, role, text) into a store at ``path``."""
    spark = conversations.sparkSession
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(ROLE_END))
    marked = rows.withColumns({"head": head, "body": escape(F.col("text")), "tie": F.md5("text")})
    marked.select(
        F.monotonically_increasing_id().alias("row"),
        "conv_id",
        "turn",
        "role",
        "tie",
        F.concat("head", "body", F.lit(CLOSE)).alias("segment"),
        F.length("head").cast("long").alias("body_start"),
        F.length("body").cast("long").alias("body_chars"),
    ).write.parquet(f"{path}/segments")
    keys = spark.read.parquet(f"{path}/segments").drop("segment").withColumns(
        {
            "n_chars": F.col("body_start") + F.col("body_chars") + len(CLOSE),
            "one": F.lit(1),
            "trained": (F.col("role") == TRAINED).cast("int"),
        }
    )
    starts = {"seq": "one", "example": "trained", "start": "n_chars"}
    placed = stored(ordered_starts(keys, ["conv_id"], ["turn", "role", "tie"], starts), "places")
    placed.select("row", "conv_id", "seq", "start", "n_chars").write.parquet(f"{path}/places")
    segments = spark.read.parquet(f"{path}/segments").select("row", "segment")
    _expanded(placed, segments).write.parquet(f"{path}/examples")


def _expanded(placed: DataFrame, segments: DataFrame) -> DataFrame:
    """The examples with their texts: of the turns in ``placed``, each trained one with all that comes before it."""
    span = F.floor(F.col("seq") / SPAN)
    spans = placed.where("trained = 1").select(F.col("conv_id").alias("own_id"), span.alias("span")).distinct()
    turns = placed.join(segments, "row")
    reached = turns.join(spans, turns["conv_id"].eqNullSafe(spans["own_id"]) & (span <= F.col("span")))
    reply = F.col("start") + F.col("body_start")
    turn = F.struct("seq", "segment", "row", "example", "trained", reply.alias("reply"), "body_chars")
    gathered = reached.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    joined = lambda parts: F.array_join(F.transform(parts, lambda t: t["segment"]), "")
    n_before = (F.col("span") * SPAN).cast("int")  # all of them are there, so a turn's seq is its place
    own = F.slice("turns", n_before + 1, F.lit(SPAN))
    parted = gathered.select("conv_id", joined(F.slice("turns", F.lit(1), n_before)).alias("before"), own.alias("own"))
    trained = F.filter(F.transform("own", lambda t, i: F.struct(t.alias("turn"), i.alias("at"))), lambda x: x["turn"]["trained"] == 1)
    return parted.select("conv_id", "before", "own", F.explode(trained).alias("x")).select(
        "x.turn.row",
        "conv_id",
        "x.turn.example",
        F.col("x.turn.reply").alias("context_chars"),
        F.col("x.turn.reply").alias("loss_start"),
        F.col("x.turn.body_chars").alias("loss_chars"),
        F.concat("before", joined(F.slice("own", F.lit(1), F.col("x.at") + 1))).alias("text"),
    )


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """The turns of a store, read back: conv_id, seq, role, text, n_chars, reply.

    ``reply`` is the unescaped text under an example's loss mask, read from the example, null for an untrained turn.
    """
    at = lambda text, begin, n: F.substring(text, (begin + 1).cast("int"), n.cast("int"))
    segments = spark.read.parquet(f"{path}/segments").select("row", "conv_id", "segment", "body_start", "body_chars")
    places = spark.read.parquet(f"{path}/places").select("row", "seq", "n_chars")
    masked = at(F.col("text"), F.col("loss_start"), F.col("loss_chars"))
    replies = spark.read.parquet(f"{path}/examples").select("row", unescape(masked).alias("reply"))
    return segments.join(places.join(replies, "row", "left"), "row").select(
        "conv_id",
        "seq",
        unescape(at(F.col("segment"), F.lit(len(OPEN)), F.col("body_start") - len(OPEN) - len(ROLE_END))).alias("role"),
        unescape(at(F.col("segment"), F.col("body_start"), F.col("body_chars"))).alias("text"),
        "n_chars",
        "reply",
    )


def example_texts(spark: SparkSession, path: str, conv_ids: DataFrame) -> DataFrame:
    """The examples of some conversations: conv_id, example, text, loss_start, loss_end."""
    wanted = conv_ids.select(F.col("conv_id").alias("wanted")).distinct()
    rows = spark.read.parquet(f"{path}/examples")
    own = rows.join(wanted, rows["conv_id"].eqNullSafe(wanted["wanted"]), "left_semi")  # null is a conversation too
    return own.select("conv_id", "example", "text", "loss_start", (F.col("loss_start") + F.col("loss_chars")).alias("loss_end"))


def digest(turns: DataFrame) -> DataFrame:
    """Per conversation, from ``read_turns``: n_turns, digests and lengths of its turns and replies.

    A digest runs over the whole conversation, so this gathers a conversation's text in one row.
    """
    lines = turns.withColumn("line", F.concat("role", F.lit("\n"), "text", F.lit("\n")))
    parts = F.array_sort(F.collect_list(F.struct("seq", "line", "reply")))
    gathered = lines.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), parts.alias("parts"), F.sum("n_chars").alias("formatted_chars")
    )
    replies = F.array_join(F.transform(F.col("parts"), lambda p: F.coalesce(p["reply"], F.lit(""))), "")
    return gathered.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["line"]), ""), 256).alias("turns_sha256"),
        F.length(replies).cast("long").alias("loss_chars"),
        F.sha2(replies, 256).alias("loss_sha256"),
        "formatted_chars",
    )
