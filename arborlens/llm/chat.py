"""Chat formatting, with Spark expressions only.

    <s>[INST] role [/INST]text[SEP]text</s><s>[INST] role [/INST]text</s>

A block is a run of neighbouring turns of one role: its role once, its texts joined by
``[SEP]``. Control strings inside roles and texts are escaped, so that they never occur
outside the template and the turns can be read back exactly: the escape sign ~ becomes ~0 and
the five control strings become ~1 to ~5. The loss mask is a list of spans (start and length
in code points of the formatted text), one for each turn of an assistant.

Rows of a conversation are ordered by turn, then role, then text; null turns come first, null
texts and roles are empty, rows with null id form a conversation of their own. Repeated rows
are turns like others. A conversation is one output row and so must fit in one. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, HEAD_END, SEP, END = "<s>[INST] ", " [/INST]", "[SEP]", "</s>"
#: Escaped forms, in the order of replacement; the escape sign itself comes first.
ESCAPES = (("~", "~0"), ("</s>", "~1"), ("<s>", "~2"), ("[INST]", "~3"), ("[/INST]", "~4"), ("[SEP]", "~5"))
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: conv_id, formatted, loss_spans (array of start, length), from rows of turns.

    One shuffle, by conversation: the windows and both aggregations share it.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("raw")
    ).withColumn("text", escape(F.col("raw")))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    new = F.coalesce(F.lag("role").over(w) != F.col("role"), F.lit(True))
    # what stands before a turn's text: the end of the last block and the head of its own, or a separator
    head = F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(HEAD_END))
    rows = rows.withColumn("new", new).withColumn("n", F.row_number().over(w))
    rows = rows.withColumn("before", F.when(F.col("n") == 1, F.char_length(head)).when(F.col("new"), F.char_length(head) + len(END)).otherwise(len(SEP)))
    rows = rows.withColumn("run", F.sum(F.col("new").cast("int")).over(w))
    rows = rows.withColumn("stop", F.sum((F.col("before") + F.char_length("text")).cast("long")).over(w))
    rows = rows.withColumn("span", F.when(F.col("role") == ASSISTANT, F.struct((F.col("stop") - F.char_length("text")).alias("start"), F.char_length("text").cast("long").alias("length"))))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("n", c))), lambda x: x[c])
    merged = rows.groupBy("conv_id", "run", "role").agg(F.array_join(in_order("text"), SEP).alias("body"), F.min("n").alias("n"), F.array_sort(F.collect_list("span")).alias("spans"))
    block = F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(HEAD_END), F.col("body"), F.lit(END))
    blocks = merged.withColumn("block", block).groupBy("conv_id")
    return blocks.agg(F.array_join(in_order("block"), "").alias("formatted"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        inner = F.substring(block, len(BEGIN) + 1, F.char_length(block))
        role, body = F.substring_index(inner, HEAD_END, 1), F.substring(inner, F.instr(inner, HEAD_END) + len(HEAD_END), F.char_length(inner))
        return F.transform(F.split(body, r"\[SEP\]", -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def digest(formatted: DataFrame) -> DataFrame:
    """What is read back from each formatted conversation, as counts and digests."""
    turns, loss = read_turns(F.col("formatted")), F.array_join(loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
