"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is one string, all turns up to its reply in order, and one span (first code point,
length) over that string: the reply, the only trainable text. Turns after the last reply, or a
conversation without one, make a last example without a span, so the output holds every turn.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Within roles and texts ``&`` becomes
``&amp;`` and ``<|`` becomes ``&lt;|`` (in a role also a line end ``&#10;``), so no text can open or
close a turn, and ``parse`` gives back every role and text exactly.

Built-in functions only. One shuffle brings the rows of a conversation together; the examples of a
conversation hold all its prefixes, which is what the expansion is, so a row must be able to hold a
conversation and the work is in proportion to the text written.

Defined results: null roles and texts are empty; rows of the same turn are ordered by role, then
text; repeated rows are turns of their own; a null conversation id is one conversation; columns
other than the four are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    t = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(t, F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    t = F.replace(text, F.lit("&lt;|"), F.lit("<|"))
    return F.replace(t, F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def examples(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             reply_role: str = "assistant") -> DataFrame:
    """Rows (conv_id, example, last, text, span): ``example`` counts from 0, ``last`` marks the example
    that holds all turns, ``span`` is the trainable struct (first, length) in code points or null."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    head = F.concat(F.lit(START), escape_role(r), F.lit("\n"))
    body = escape(t)
    piece = F.struct(
        F.col(turn).alias("turn"), r.alias("role"), t.alias("raw"), F.concat(head, body, F.lit(END)).alias("piece"),
        F.char_length(head).alias("head"), F.char_length(body).alias("body"))
    d = df.select(F.col(conv).alias("conv_id"), piece.alias("p")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("p")).alias("p"))
    d = d.select("conv_id", "p", F.size("p").alias("n"), F.transform("p", lambda x: x["piece"]).alias("pieces"))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (i == F.col("n")) | (F.get("p", i - 1)["role"] == reply_role))
    d = d.select("conv_id", "p", "n", "pieces", F.posexplode(ends).alias("example", "upto"))
    whole = F.array_join(F.slice("pieces", F.lit(1), F.col("upto")), "")
    d = d.select("conv_id", "example", (F.col("upto") == F.col("n")).alias("last"), whole.alias("text"),
                 F.get("p", F.col("upto") - 1).alias("reply"))
    first = F.char_length("text") - F.lit(len(END)) - F.col("reply.body")
    span = F.when(F.col("reply.role") == reply_role, F.struct(first.alias("first"), F.col("reply.body").alias("length")))
    return d.select("conv_id", "example", "last", "text", span.alias("span"))


def parse(text: Column) -> Column:
    """Turns of a formatted string as array of (role, text)."""
    pieces = F.split(text, "<\\|im_end\\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(p):
        inner = F.substring(p, F.lit(len(START) + 1), F.char_length(p))
        cut = F.instr(inner, "\n")
        return F.struct(unescape_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(inner, cut + 1, F.char_length(inner))).alias("text"))
    return F.transform(pieces, turn)


def trained_text(text: Column, span: Column) -> Column:
    """The text under the mask, unescaped; null where nothing is trainable."""
    return unescape(F.substring(text, span["first"] + 1, span["length"]))


def read_back(ex: DataFrame) -> DataFrame:
    """Digests per conversation, from the examples alone."""
    turns = F.when(F.col("last"), parse(F.col("text")))
    d = ex.select("conv_id", "example", F.char_length("text").cast("long").alias("chars"), turns.alias("turns"),
                  trained_text(F.col("text"), F.col("span")).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    d = d.select("conv_id", "example", "chars", "loss", F.size("turns").cast("long").alias("size"), F.when(
        F.col("turns").isNotNull(), F.sha2(joined.cast("binary"), 256)).alias("sha"))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(
        F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))), lambda x: x["loss"]), "")
    d = d.groupBy("conv_id").agg(
        F.max(F.when(F.col("sha").isNotNull(), F.col("size"))).alias("n_turns"), F.max("sha").alias("turns_sha256"),
        loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return d.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
