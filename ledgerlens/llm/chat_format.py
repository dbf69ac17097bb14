r"""Chat formatting by prefix-target expansion.

Method.  A turn is written as ``<|turn|>role`` newline ``text<|end|>``.  In roles
and texts a backslash is doubled and ``<|`` becomes ``<\|`` (in roles a newline
gets a backslash too), so no text can hold a mark and reading back is exact.
Every assistant turn becomes an example of its own: all preceding turns and its
own opening are context, and only its reply is trainable.  The contexts of a
conversation's examples are prefixes of one formatted text, so an example names
its context by length; ``materialised`` cuts the texts out.  Rows thus grow with
the turns, not with their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE = "<|turn|>", "<|end|>"
TRAINED_ROLE = "assistant"
#: Code points of the pieces from which spans of a formatted text are cut.
PIECE = 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, order (a struct to sort by), role, opening and reply (both
    escaped) of each row."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    opening = F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    order = F.struct(F.col("turn").isNull().alias("last"), "turn", role.alias("role"), text.alias("text"))
    return conversations.select("conv_id", order.alias("order"), role.alias("role"), opening.alias("opening"), escape(text).alias("reply"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted: one row per conversation.

    Turns go by ``turn`` (null last), then role and text; repeated rows are
    turns of their own.  Null roles and texts are empty; rows with a null
    conv_id are one conversation.  Other columns are not read.
    """
    turns = _turns(conversations).select("conv_id", F.struct("order", F.concat("opening", "reply", F.lit(CLOSE)).alias("piece")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return whole.select("conv_id", F.size("ts").cast("long").alias("n_turns"), F.array_join(F.col("ts.piece"), "").alias("formatted"))


def examples(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per turn of ``trained_role``: conv_id, example_no (from 1, in
    order), context_chars (the example's context is so long a prefix of the
    formatted conversation) and reply (escaped, as it stands after the context;
    the loss mask covers it and nothing else)."""
    in_order = Window.partitionBy("conv_id").orderBy("order")
    piece = F.length("opening") + F.length("reply") + len(CLOSE)
    before = F.coalesce(F.sum(piece).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = _turns(conversations).withColumn("context_chars", (before + F.length("opening")).cast("long")).where(F.col("role") == trained_role)
    return at.select("conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy("context_chars")).alias("example_no"), "context_chars", "reply")


def materialised(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """The examples as training rows: conv_id, example_no, text (context and
    reply), loss_start and loss_end (code points of the trainable span)."""
    ex, whole = examples(conversations, trained_role), formatted(conversations)
    both = ex.alias("e").join(whole.alias("w"), F.col("e.conv_id").eqNullSafe(F.col("w.conv_id")))
    end = F.col("e.context_chars") + F.length("e.reply")
    return both.select("e.conv_id", "e.example_no", F.substring("w.formatted", F.lit(1), end.cast("int")).alias("text"),
                       F.col("e.context_chars").alias("loss_start"), end.alias("loss_end"))


def read_back(whole: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (array of role, text) parsed from formatted texts."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p != "")
    role = lambda p: F.regexp_extract(p, r"(?s)^<\|turn\|>([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1)
    parsed = F.transform(F.col("pieces"), lambda p: F.struct(role(p).alias("r"), p.alias("p")))
    turns = F.transform(F.col("parsed"), lambda x: F.struct(
        unescape(x["r"]).alias("role"), unescape(F.substr(x["p"], F.length(x["r"]) + len(OPEN) + 2)).alias("text")))
    return whole.withColumn("pieces", pieces).withColumn("parsed", parsed).select("conv_id", "formatted", turns.alias("turns"))


def _pieces(text: Column) -> Column:
    """A text in pieces of PIECE code points, so that a span is found without a
    walk from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _span(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` (from 0) of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((start + length) / PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.substr(near, (start % PIECE + 1).cast("int"), length)


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text, the replies as the
    loss mask of the examples covers them:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    told = read_back(formatted(conversations)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), _pieces(F.col("formatted")).alias("pieces"))
    mask = examples(conversations).select("conv_id", F.struct("example_no", "context_chars", F.length("reply").alias("chars")).alias("e"))
    mask = mask.groupBy("conv_id").agg(F.array_sort(F.collect_list("e")).alias("mask"))
    both = told.alias("t").join(mask.alias("m"), F.col("t.conv_id").eqNullSafe(F.col("m.conv_id")), "left")
    said = F.transform("m.mask", lambda e: unescape(_span(F.col("t.pieces"), e["context_chars"], e["chars"])))
    both = both.select("t.*", F.array_join(said, "").alias("loss"))
    text = F.coalesce("loss", F.lit(""))
    return both.select("conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"),
                       F.sha2(text, 256).alias("loss_sha256"), "formatted_chars")
