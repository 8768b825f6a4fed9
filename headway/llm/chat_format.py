r"""Chat formatting with Spark expressions only.

A conversation becomes one string. Adjacent turns of one role share a message:

    <turn ROLE>\nTEXT<next/>TEXT</turn>\n

Inside texts a backslash becomes ``\b`` and the ``<`` that opens a control string becomes ``\l``; both are undone in
reverse, so any text survives. Roles escape line feeds and ``>`` too. The loss mask is a list of code point spans
(start, length), one for each assistant text, kept in blocks of ``BLOCK`` turns so that neither building nor reading it
takes quadratic time.

Defined cases: null text is empty; a null role is the empty role; rows of a conversation are ordered by turn (null
first), then role, then text; repeated rows are repeated turns; a null conv_id is a conversation of its own; no rows give
no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\b")), r"<(?=turn |/turn>|next/>)", r"\\l")


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")), F.lit(">"), F.lit("\\g"))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _running(values: Column, start: Column) -> Column:
    """Exclusive running sums from start, with the total as a last element."""
    return F.aggregate(values, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) rows -> conv_id, formatted, loss: array of blocks (start, length, spans).

    One shuffle on conv_id. A conversation is one string of the output, so its turns meet in one task by nature.
    """
    turns = conversations.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get(F.col("turns"), i - 1)["role"] != t["role"])
        joins = F.coalesce(F.get(F.col("turns"), i + 1)["role"] == t["role"], F.lit(False))
        return F.struct(
            F.when(opens, F.concat(F.lit("<turn "), escape_role(t["role"]), F.lit(">\n"))).otherwise("").alias("before"),
            escape(t["text"]).alias("text"),
            F.when(joins, "<next/>").otherwise("</turn>\n").alias("after"),
            (t["role"] == loss_role).alias("loss"),
        )

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    blocks = pieces.select(
        "conv_id",
        F.transform(F.sequence(F.lit(0), F.floor((F.size("pieces") - 1) / BLOCK).cast("int")), lambda b: F.slice("pieces", b * BLOCK + 1, BLOCK)).alias("blocks"),
    )
    whole = lambda p: F.concat(p["before"], p["text"], p["after"])
    texts = blocks.select("conv_id", "blocks", F.transform("blocks", lambda b: F.array_join(F.transform(b, whole), "")).alias("texts"))
    sizes = texts.select("conv_id", "blocks", "texts", _running(F.transform("texts", lambda t: F.length(t).cast("long")), F.lit(0).cast("long")).alias("starts"))

    def spans(block: Column, i: Column) -> Column:
        start = F.get(F.col("starts"), i)
        at = _running(F.transform(block, lambda p: F.length(whole(p)).cast("long")), F.lit(0).cast("long"))
        marked = F.zip_with(
            block, F.slice(at, F.lit(1), F.size(block)),
            lambda p, a: F.struct(p["loss"].alias("loss"), (start + a + F.length(p["before"])).alias("start"), F.length(p["text"]).cast("long").alias("length")),
        )
        kept = F.transform(F.filter(marked, lambda m: m["loss"]), lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length")))
        return F.struct(start.alias("start"), (F.get(F.col("starts"), i + 1) - start).alias("length"), kept.alias("spans"))

    return sizes.select("conv_id", F.array_join("texts", "").alias("formatted"), F.transform("blocks", spans).alias("loss"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array of (role, text)."""
    messages = F.split(formatted, "</turn>\n", -1)
    messages = F.slice(messages, F.lit(1), F.size(messages) - 1)

    def turns(m: Column) -> Column:
        head = F.substring_index(m, ">\n", 1)
        body = F.substr(m, F.length(head) + 3)
        role = unescape_role(F.substr(head, F.lit(7)))
        return F.transform(F.split(body, "<next/>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def masked_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""

    def of_block(b: Column) -> Column:
        part = F.substr(formatted, (b["start"] + 1).cast("int"), b["length"].cast("int"))
        return F.transform(b["spans"], lambda s: unescape(F.substr(part, (s["start"] - b["start"] + 1).cast("int"), s["length"].cast("int"))))

    return F.flatten(F.transform(loss, of_block))


def digest(formatted: DataFrame) -> DataFrame:
    """Digest columns, read back from formatted strings and masks alone."""
    read = formatted.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"), F.array_join(masked_texts(F.col("formatted"), F.col("loss")), "").alias("lost"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
