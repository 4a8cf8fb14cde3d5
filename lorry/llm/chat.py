"""Operator 7, chat formatting: turn rows to one training string per conversation.

Relational, Spark expressions only: the turns of a conversation are collected
as structs, sorted as an array, adjacent turns of one role are merged by
array functions, and the text is put together with ``concat``/``array_join``.

Template.  A block (one or more adjacent turns of one role) is::

    ### <role>:\\n<text>[\\n</part>\\n<text>...]\\n</turn>\\n

Inside texts and roles every backslash and every control string (``###``,
``</turn>``, ``</part>``) gets a backslash in front, so no unescaped control
string can come from a text and :func:`parse` gives back every original turn.

Defined cases: a null text or role is empty; a null ``conv_id`` is one
conversation; turns with the same number are ordered by role, then text
(repeated rows stay, one turn each); an empty table gives an empty result;
further columns of the input are ignored.  A conversation is one output
string, so its own turns (and nothing else) meet in one task; the span list
is built by copying, quadratic in the blocks of one conversation only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values of the template
HEAD, SEP, PART, END = "### ", ":\n", "\n</part>\n", "\n</turn>\n"
CONTROL = r"\\|###|</turn>|</part>"


def escape(c: Column) -> Column:
    """A backslash before every backslash and control string."""
    return F.regexp_replace(c, f"({CONTROL})", r"\\$1")


def unescape(c: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(c, rf"\\({CONTROL})", "$1")


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    # "\\n" (an escaped backslash, then n) must not become a line break, so the
    # escaped backslashes step aside while line breaks come back
    aside = F.replace(c, F.lit("\\\\"), F.lit("\n"))
    pieces = F.transform(F.split(aside, "\n", -1), lambda p: unescape(F.replace(p, F.lit("\\n"), F.lit("\n"))))
    return F.array_join(pieces, "\\")


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` is an array of ``(start, stop)`` code-point offsets into
    ``formatted``: the (escaped) texts a model is trained on, in order.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    collected = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # first turn of every block, then the blocks as slices of the sorted turns
    firsts = F.filter(F.sequence(F.lit(0), F.size("ts") - 1),
                      lambda i: (i == 0) | (F.get("ts", i).role != F.get("ts", i - 1).role))
    cut = collected.withColumn("firsts", firsts)
    blocks = F.transform("firsts", lambda s, k: F.struct(
        _escape_role(F.get("ts", s).role).alias("role"),
        F.get("ts", s).role.isin(*loss_roles).alias("loss"),
        F.transform(F.slice("ts", s + 1, F.coalesce(F.get("firsts", k + 1), F.size("ts")) - s),
                    lambda t: escape(t.text)).alias("parts")))
    merged = cut.select("conv_id", blocks.alias("blocks"))
    text = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(HEAD), b.role, F.lit(SEP), F.array_join(b.parts, PART), F.lit(END))), "")
    # every part with the length of what stands before it, then running offsets
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b.parts, lambda p, i: F.struct(
        F.when(i == 0, F.length(b.role) + len(HEAD) + len(SEP)).otherwise(len(PART)).alias("before"),
        F.length(p).alias("n"),
        F.when(i == F.size(b.parts) - 1, len(END)).otherwise(0).alias("after"),
        b.loss.alias("loss")))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))
    spans = F.aggregate(pieces, zero, lambda s, p: F.struct(
        (s.at + p.before + p.n + p.after).alias("at"),
        F.when(p.loss, F.concat(s.spans, F.array(F.struct((s.at + p.before).alias("start"),
                                                          (s.at + p.before + p.n).alias("stop")))))
        .otherwise(s.spans).alias("spans")), lambda s: s.spans)
    return merged.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """The inverse of :func:`format_conversations`: adds ``turns`` (role and
    text of every original turn, in order) and ``loss_texts`` (the unescaped
    texts under the mask, in order), both read from ``formatted`` alone."""
    blocks = F.split("formatted", END, -1)
    whole = F.slice(blocks, 1, F.size(blocks) - 1)  # what follows the last end marker is empty

    def turns_of(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        role = _unescape_role(F.substring(head, F.lit(len(HEAD) + 1), F.length(head) - len(HEAD) - 1))
        body = F.substring(b, F.length(head) + 2, F.length(b))
        return F.transform(F.split(body, PART, -1), lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return formatted.withColumns({
        "turns": F.flatten(F.transform(whole, turns_of)),
        "loss_texts": F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s.start + 1, s.stop - s.start))),
    })
