"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn is written as ``### Role: text</turn>`` and a line break. Inside texts,
backslash, ``#`` and ``<`` get a backslash before them, so no text holds a
control string, and dropping those backslashes gives the text back. Roles
other than the four usual ones are written as ``@`` and their bytes in hex.

Every assistant turn becomes an example: all turns before it (and its own
heading) are context, its text alone is trainable. Written out, the contexts of
a long conversation would grow with the square of its turns, so an example
names spans of its conversation's formatted text: context [0, context_end), loss
[loss_start, loss_end). ``expanded`` writes out the examples one asks for.

Offsets are running sums over a conversation's turns. Rows are range-partitioned
by (conversation, turn, role, text), so a conversation that holds a third of
all rows spans many partitions; each partition's part of a conversation is
summed by itself, and a row for each part carries the sums on.

Turns order by turn, then role, then text (nulls first); repeated rows are turns
of their own. Null roles and texts are empty; a null conv_id is a conversation.
An empty table has no conversations; an empty assistant text is an example with
an empty loss span. A very long text is one turn and stays in one row. The columns
conv_id, turn, role and text are read only; others, whatever their names, are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import saved

ROLES = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
HEAD, COLON, END = "### ", ": ", "</turn>\n"
TRAINABLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#<])", "$1")


def role_mark(role: Column) -> Column:
    out = F.concat(F.lit("@"), F.hex(role.cast("binary")))
    for name, mark in ROLES.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def role_of(mark: Column) -> Column:
    out = F.unhex(F.substr(mark, F.lit(2))).cast("string")
    for name, shown in ROLES.items():
        out = F.when(mark == shown, F.lit(name)).otherwise(out)
    return out


def segments(conversations: DataFrame) -> DataFrame:
    """Formatted turns: ``conv_id, seg, role, formatted``, where each begins and where its text does."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEAD), role_mark(role), F.lit(COLON))
    key = ["conv_id", "turn", "role", "text"]
    # saved with places: part of the order, then row in the part
    placed = saved(
        conversations.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
        .select("conv_id", role.alias("role"), F.monotonically_increasing_id().alias("place"),
                F.concat(head, escaped(text), F.lit(END)).alias("formatted"), F.length(head).cast("long").alias("head_chars")),
        "chat-turns").withColumn("part", F.shiftright("place", 33)).withColumn("chars", F.length("formatted").cast("long"))
    parts = placed.groupBy("conv_id", "part").agg(F.sum("chars").alias("chars"), F.count("*").alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    before = parts.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"),
                          F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
                          F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"))
    own = Window.partitionBy("conv_id", "part").orderBy("place")
    rows = placed.withColumn("upto", F.sum("chars").over(own)).withColumn("nth", F.row_number().over(own))
    joined = rows.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
    begin = F.col("chars_before") + F.col("upto") - F.col("chars")
    return joined.select(
        "conv_id", (F.col("turns_before") + F.col("nth") - 1).alias("seg"), "place", "role", "formatted",
        begin.alias("begin"), (begin + F.col("head_chars")).alias("text_begin"),
        (begin + F.col("chars") - len(END)).alias("text_end"))


def examples(segs: DataFrame) -> DataFrame:
    """An example for each assistant turn, as spans of its conversation's formatted text."""
    return segs.where(F.col("role") == TRAINABLE).select(
        "conv_id", "seg", "place", F.col("text_begin").alias("context_end"),
        F.col("text_begin").alias("loss_start"), F.col("text_end").alias("loss_end"))


def formatted(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two output tables, written under the shared folder and read back: segments and examples."""
    segs = saved(segments(conversations), "chat-segments")
    return segs, saved(examples(segs), "chat-examples")


def expanded(segs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``conv_id, seg, context, target`` written out for the ``wanted`` examples (rows of the example table).

    Each example repeats its whole context; ask for those that a batch needs.
    """
    e = wanted.select(F.col("conv_id").alias("_c"), F.col("seg").alias("_s"), "loss_start", "loss_end")
    rows = segs.join(e, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("seg") <= F.col("_s")))
    head = F.when(F.col("seg") == F.col("_s"), _span(F.lit(None), F.col("loss_start"))).otherwise(F.col("formatted"))
    target = F.when(F.col("seg") == F.col("_s"), _span(F.col("loss_start"), F.col("loss_end")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", head.alias("t")))), lambda x: x["t"]), "")
    return rows.groupBy("_c", "_s").agg(text.alias("context"), F.max(target).alias("target")).select(
        F.col("_c").alias("conv_id"), F.col("_s").alias("seg"), "context", "target")


def _span(start: Column, end: Column) -> Column:
    """The part of a segment's formatted text between two places of the conversation."""
    first = F.coalesce(start, F.col("begin"))
    return F.substr("formatted", (first - F.col("begin") + 1).cast("int"), (end - first).cast("int"))


def read_back(segs: DataFrame, ex: DataFrame) -> DataFrame:
    """The contract's digests for each conversation, from the two tables alone.

    A conversation's digest needs its text in order, so here, and only here, a
    conversation is gathered into one row.
    """
    mark = F.regexp_extract("formatted", r"^### ([^:]*): ", 1)
    text_at = F.length(mark) + len(HEAD) + len(COLON)
    text = F.substr("formatted", text_at + 1, F.length("formatted") - text_at - len(END))
    loss = ex.select("place", "loss_start", "loss_end")
    rows = segs.join(loss, "place", "left").select(
        "conv_id", "seg", F.length("formatted").cast("long").alias("chars"),
        F.concat(role_of(mark), F.lit("\n"), unescaped(text), F.lit("\n")).alias("turn"),
        unescaped(_span(F.col("loss_start"), F.col("loss_end"))).alias("loss"))
    ordered = F.sort_array(F.collect_list(F.struct("seg", "turn", "loss")))
    one = rows.groupBy("conv_id").agg(ordered.alias("t"), F.sum("chars").alias("formatted_chars"))
    joined = lambda field: F.array_join(F.transform("t", lambda x: x[field]), "")  # noqa: E731  skips nulls
    return one.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(joined("turn"), 256).alias("turns_sha256"),
                      F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"),
                      "formatted_chars")
