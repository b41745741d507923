"""Chat formatting by prefix-target expansion, with built-in functions only.

A conversation is rendered once through the template::

    <|im_start|>role\ntext<|im_end|>\n

Every assistant turn is an example of its own: all preceding turns are its
context and only its own text is trainable. Such an example is a prefix of the
rendered conversation, so it is kept as offsets (end of the prefix, begin and
length of the trainable text) beside the one rendered text; ``example_texts``
cuts the text of each example out when it is wanted. A conversation of n turns
thus costs O(n) until then, not O(n^2).

Control strings inside texts and roles are escaped reversibly: ``&`` becomes
``&amp;`` and ``<|`` becomes ``&lt;|`` (and, in roles, a line feed ``&nl;``),
so no marker of the template can occur in a rendered text.

Defined results: turns are ordered by turn, then role, then text (nulls
first); repeated rows are turns of their own; a null text or role counts as
empty; rows with a null ``conv_id`` form one conversation; an empty table gives
an empty result; further columns are ignored. Turns of one conversation end in
one row, as its rendered text and digest ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, ASSISTANT = "<|im_start|>", "<|im_end|>", "assistant"
TAIL = END + "\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, examples (array of structs).

    An example has its number, the length of its prefix (``prefix_chars``) and
    begin (from 0) and length of the trainable text, in code points.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    body = escape(F.coalesce("text", F.lit("")))
    t = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "text")
              .withColumn("body_chars", F.char_length(body))
              .withColumn("piece", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), body, F.lit(TAIL)))
              .withColumn("at", F.row_number().over(order))
              .withColumn("prefix_chars", F.sum(F.char_length("piece").cast("long")).over(
                  order.rowsBetween(Window.unboundedPreceding, 0))))
    loss_start = F.col("prefix_chars") - len(TAIL) - F.col("body_chars")
    example = F.when(F.col("role") == ASSISTANT, F.struct(
        "at", "prefix_chars", loss_start.alias("loss_start"), F.col("body_chars").alias("loss_chars")))
    pieces = F.sort_array(F.collect_list(F.struct("at", "piece")))
    return t.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(example)).alias("examples"))


def explode_examples(formatted: DataFrame, *further: str, outer: bool = False) -> DataFrame:
    """One row per assistant turn: conv_id, the columns ``further``, example (from 0), prefix_chars, loss_start,
    loss_text (still escaped); with ``outer`` one row without an example for conversations that have none.

    Each example's reply is cut out before the rows part, so that they carry that text only.
    """
    cut = F.transform("examples", lambda e: F.struct(
        e["prefix_chars"].alias("prefix_chars"), e["loss_start"].alias("loss_start"),
        F.substring(F.col("formatted"), e["loss_start"].cast("int") + 1, e["loss_chars"]).alias("loss_text")))
    explode = F.posexplode_outer if outer else F.posexplode
    e = formatted.select("conv_id", *further, explode(cut).alias("example", "e"))
    return e.select("conv_id", *further, "example", "e.prefix_chars", "e.loss_start", "e.loss_text")


def example_texts(formatted: DataFrame) -> DataFrame:
    """The whole text of every example: context and target, with the loss mask as offsets into it."""
    e = formatted.select("conv_id", "formatted", F.posexplode("examples").alias("example", "e"))
    return e.select("conv_id", "example", F.substring("formatted", F.lit(1), F.col("e.prefix_chars").cast("int")).alias("text"),
                    "e.loss_start", "e.loss_chars")


def read_turns(formatted: Column) -> Column:
    """The turns read back from a rendered conversation: array of (role, text)."""
    pieces = F.split(formatted, r"\Q" + START + r"\E")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))      # nothing stands before the first marker

    def parse(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        text = F.substring(p, F.char_length(role) + 2, F.char_length(p) - F.char_length(role) - 1 - len(TAIL))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, parse)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what can be read back: its turns, and from its exploded examples
    the trainable text and the size of all of them."""
    said = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select("conv_id", "formatted", "examples", F.size(said).cast("long").alias("n_turns"),
                            F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"))
    rows = explode_examples(read, "n_turns", "turns_sha256", outer=True)
    parts = F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", unescape(F.col("loss_text")).alias("text")))))
    loss = rows.groupBy("conv_id", "n_turns", "turns_sha256").agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("loss"),
        F.coalesce(F.sum("prefix_chars"), F.lit(0)).cast("long").alias("formatted_chars"))
    return loss.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")
