"""Chat formatting: every assistant turn becomes an example whose context is all that precedes it.

A conversation is rendered once; since each example is a prefix of that rendering, examples are
kept as offsets into it and only become text in :func:`explode_examples`. A conversation of n
turns so costs O(n) storage, not O(n^2). DataFrame functions only.

Defined results: a null text or role is empty; turns are ordered by (turn, role, text), nulls
first, so ties and repeated rows have one order and all are kept; rows with a null conv_id form
one conversation; an empty table gives no row; columns other than the four read are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import cut

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Strings that steer a chat model; inside a text they are escaped. Fixed values.
CONTROL = (
    TURN, BODY, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>",
)
#: Turns of one conversation are first gathered in runs of so many turn numbers.
RUN = 64


def escape(text: Column) -> Column:
    """Double every backslash, then part each control string after its first character with one."""
    rests = "|".join(re.escape(c[1:]) for c in CONTROL)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={rests})", r"$1\\")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`: a backslash stands for the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, rendered, examples``.

    ``examples`` is an array of ``(turn_index, chars, loss_start, loss_chars)``: the example's text
    is the first ``chars`` characters of ``rendered``, and of these only the ``loss_chars`` from
    ``loss_start`` (counted from 0) are trained on. Turns after the last reply form a last example
    with nothing to train on (``loss_chars`` 0, ``turn_index`` -1), so no turn is lost.

    Turns are gathered in two steps, by runs of turn numbers and then by conversation, so that a
    conversation with a large share of all rows reaches its task as few pre-aggregated rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    pieces = turns.select(
        "conv_id", "turn", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(2**62))).alias("run"), role.alias("role"), text.alias("text"),
    ).select(
        "conv_id", "turn", "run", "role", "text", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"), escape(F.col("text")).alias("body"),
    )
    piece = F.struct(
        "turn", "role", "text", F.concat("head", "body", F.lit(END)).alias("shown"), F.char_length("head").alias("lead"),
        F.char_length("body").alias("size"), (F.col("role") == "assistant").alias("reply"),
    )
    runs = pieces.groupBy("conv_id", "run").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    # Lengths add up along the run: an array of them, each the one before it and its own.
    ends = "aggregate(p, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + char_length(x.shown))))"
    runs = runs.select(
        "conv_id", "run", F.size("p").cast("long").alias("n"), F.expr("array_join(transform(p, x -> x.shown), '')").alias("shown"), F.expr(ends).alias("at"), "p",
    ).select(
        "conv_id", "run", "n", "shown", F.char_length("shown").cast("long").alias("chars"),
        F.expr("""filter(transform(p, (x, i) -> struct(cast(i AS bigint) AS turn_index, at[i] + char_length(x.shown) AS chars,
                  at[i] + x.lead AS loss_start, cast(x.size AS bigint) AS loss_chars, x.reply AS reply)), x -> x.reply)""").alias("e"),
    )
    # Where each run begins in its conversation: one running sum, and then one addition an example.
    before = "OVER (PARTITION BY conv_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    runs = runs.selectExpr("*", f"coalesce(sum(n) {before}, 0L) AS n0", f"coalesce(sum(chars) {before}, 0L) AS c0")
    runs = runs.selectExpr("conv_id", "run", "n", "shown", "chars", """transform(e, y -> struct(
        y.turn_index + n0 AS turn_index, y.chars + c0 AS chars, y.loss_start + c0 AS loss_start, y.loss_chars AS loss_chars)) AS e""")
    whole = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "shown", "e"))).alias("r"), F.sum("n").alias("n_turns"), F.sum("chars").alias("total"))
    whole = whole.select("conv_id", "n_turns", F.expr("array_join(transform(r, x -> x.shown), '')").alias("rendered"), "total", F.expr("flatten(transform(r, x -> x.e))").alias("e"))
    tail = "array(named_struct('turn_index', -1L, 'chars', total, 'loss_start', total, 'loss_chars', 0L))"
    return whole.select("conv_id", "n_turns", "rendered", F.expr(f"CASE WHEN try_element_at(e, -1).chars = total THEN e ELSE concat(e, {tail}) END").alias("examples"))


def explode_examples(formatted: DataFrame) -> DataFrame:
    """One row per example with its text: ``conv_id, turn_index, text, loss_start, loss_chars``."""
    rows = formatted.select("conv_id", "rendered", F.explode("examples").alias("e"))
    text = F.expr("substring(rendered, 1, cast(e.chars AS int))")
    return rows.select("conv_id", "e.turn_index", text.alias("text"), "e.loss_start", "e.loss_chars")


def read_turns(rendered: Column) -> Column:
    """Parse a rendered conversation back into an array of ``(role, text)``."""
    parts = F.split(rendered, re.escape(END))
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    cut = lambda x: F.split(F.substring(x, F.lit(len(TURN) + 1), F.char_length(x)), re.escape(BODY), 2)
    return F.transform(turns, lambda x: F.struct(unescape(cut(x)[0]).alias("role"), unescape(cut(x)[1]).alias("text")))


def digest(formatted: DataFrame) -> DataFrame:
    """Read the formatted output back: what it holds of each conversation, as counts and digests.

    Turns are parsed from the rendering; all else comes from the examples' own texts, of which only the
    trained part and the length are kept.
    """
    formatted = cut(formatted)
    lines = F.expr("array_join(transform(t, x -> concat(x.role, '\n', x.text, '\n')), '')")
    said = formatted.select("conv_id", read_turns(F.col("rendered")).alias("t"))
    said = said.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"))
    loss = unescape(F.expr("substring(text, cast(loss_start + 1 AS int), cast(loss_chars AS int))"))
    examples = explode_examples(formatted).select("conv_id", "turn_index", F.char_length("text").cast("long").alias("chars"), loss.alias("loss"))
    trained = F.when(F.col("turn_index") >= 0, F.struct("turn_index", "loss"))
    examples = examples.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"), F.array_join(F.transform(F.array_sort(F.collect_list(trained)), lambda x: x.loss), "").alias("loss")
    )
    return said.join(examples, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_examples",
    )
