"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, runs of one role
become one block, and blocks are joined to one string:

    <s>[role]text[+]text[/role]</s>

``[+]`` parts texts that were turns of their own in one block. ``&``, ``<``, ``[`` and ``]`` in
roles and texts become ``&amp;``, ``&lt;``, ``&lb;`` and ``&rb;``, so no text can hold a mark, and the turns can
be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is escaped, in this order; read back in the other order.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), ("]", "&rb;")]
BEGIN, END, PART = "<s>", "</s>", "[+]"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, n_blocks, formatted, and loss_spans: (start, length) in code points of all text to learn from.

    One row for each conv_id of ``conversations`` (conv_id, turn, role, text); a NULL conv_id
    is a conversation too. Turns are ordered by turn, then role, then text, so ties
    have one order and repeated rows stay as turns of their own. NULL roles and
    texts are empty. An empty table gives no rows. Other columns are not read.

    A conversation is one value, as its formatted string is.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # a turn that begins a block, by place
    begins = F.expr("transform(turns, (t, i) -> i = 0 or t.role != turns[i - 1].role)")
    firsts = F.expr("filter(sequence(0, size(turns) - 1), i -> begins[i])")
    blocks = F.expr(
        """transform(firsts, (f, k) -> struct(turns[f].role as role, transform(
               slice(turns, f + 1, (if(k + 1 < size(firsts), firsts[k + 1], size(turns))) - f), t -> t.text) as texts))"""
    )
    marked = turns.withColumn("begins", begins).withColumn("firsts", firsts).withColumn("blocks", blocks)
    safe = F.transform("blocks", lambda b: F.struct(escaped(b["role"]).alias("role"), F.transform(b["texts"], escaped).alias("texts"), (b["role"] == LEARNED).alias("learned")))
    marked = marked.select("conv_id", F.size("blocks").cast("bigint").alias("n_blocks"), safe.alias("blocks"))
    # the string as pieces, each with whether it is learned from
    piece = lambda text, learned: F.struct(text.alias("text"), learned.alias("learned"))
    no = F.lit(False)

    def pieces(b: Column) -> Column:
        head = F.array(piece(F.concat(F.lit(BEGIN + "["), b["role"], F.lit("]")), no))
        parts = F.flatten(F.transform(b["texts"], lambda t, i: F.when(i == 0, F.array(piece(t, b["learned"]))).otherwise(F.array(piece(F.lit(PART), no), piece(t, b["learned"])))))
        tail = F.array(piece(F.concat(F.lit("[/"), b["role"], F.lit("]" + END)), no))
        return F.concat(head, parts, tail)

    laid = marked.select("conv_id", "n_blocks", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    # pieces' starts by a running sum of lengths; spans are gathered on the way
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        size = F.length(p["text"]).cast("bigint")
        span = F.array(F.struct(state["at"].alias("start"), size.alias("length")))
        return F.struct((state["at"] + size).alias("at"), F.when(p["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return laid.select("conv_id", "n_blocks", text.alias("formatted"), F.aggregate("pieces", zero, step, lambda s: s["spans"]).alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, n_blocks, formatted, turns (role, text) and learned (texts under the loss spans), from the strings alone."""
    blocks = F.filter(F.split("formatted", F.lit(r"\Q" + END + r"\E")), lambda b: b != "")

    def turns(b: Column) -> Column:
        role = F.regexp_extract(b, r"(?s)^<s>\[(.*?)\]", 1)
        body = F.substring(b, F.length(role) + len(BEGIN) + 3, F.length(b) - 2 * F.length(role) - len(BEGIN) - 5)
        return F.transform(F.split(body, r"\Q" + PART + r"\E", -1), lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    learned = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", "n_blocks", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), learned.alias("learned"))


def digests(chats: DataFrame) -> DataFrame:
    """The contract's columns, from what :func:`read_back` reads."""
    read = read_back(chats)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_blocks",
    )
