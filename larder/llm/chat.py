"""Chat formatting into budgeted windows, with loss only on new assistant turns.

Prefix sums of turn tokens place the turns of a conversation on a line that is
cut into cells of one window's capacity.  Turns inside a cell form a window; a
turn that crosses the end of a cell gets a window of its own, so no window
exceeds the budget unless one turn does.  Each later window begins with the
system turn and a limited number of the turns before it; what is repeated is
masked.  All steps are window functions and per-window arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Tokens of a window, those of them kept for repeated turns, and the repeated turns at most.
BUDGET = 1024
HISTORY_BUDGET = 256
HISTORY_TURNS = 4
#: Characters counted as one token.
TOKEN_CHARS = 4

OPEN, CLOSE, END = '<turn role="', '">', "</turn>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"))


def escape(value: Column) -> Column:
    """No marker can appear in an escaped string, as none contains "<" any more."""
    for plain, coded in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def unescape(value: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def windows(turns: DataFrame, budget: int = BUDGET, history_budget: int = HISTORY_BUDGET, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """One row per window of the conversations in ``turns`` (conv_id, turn, role, text).

    Returns conv_id, window, ``formatted``, ``n_context`` (leading turns that
    are repeated) and ``loss``: start and length, in code points, of the spans
    of ``formatted`` that count.  Each assistant turn counts in one window.

    Turns are ordered by turn, then role and text, so ties and repeated rows
    have a defined place; null turns come first.  Null texts and roles are
    empty strings; rows with null conv_id form one conversation.  Other columns
    are not read; an empty table gives no window.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = order.rowsBetween(W.unboundedPreceding, 0)
    head, body = escape(F.col("role")), escape(F.col("text"))
    rendered = F.concat(F.lit(OPEN), head, F.lit(CLOSE), body, F.lit(END))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.row_number().over(order)).select(
        "conv_id", "turn", "role", "text", "place", rendered.alias("rendered"),
        (F.length(head) + len(OPEN) + len(CLOSE)).alias("skip"), F.length(body).alias("size"),
        F.ceil(F.length(rendered) / TOKEN_CHARS).alias("tokens"),
    )
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    rows = rows.withColumns({
        "system": F.first(F.when(is_system, F.col("rendered")), ignorenulls=True).over(running),
        "system_tokens": F.sum(F.when(is_system, F.col("tokens")).otherwise(0)).over(running),
        "ends": F.sum(F.when(is_system, 0).otherwise(F.col("tokens"))).over(running),
    })
    capacity = F.greatest(F.lit(1), F.lit(budget - history_budget) - F.col("system_tokens"))
    first_cell = F.floor((F.col("ends") - F.col("tokens")) / capacity)
    last_cell = F.floor((F.col("ends") - 1) / capacity)
    cell = F.when(is_system, F.struct(F.lit(0).cast("bigint").alias("cell"), F.lit(False).alias("across"))).otherwise(
        F.struct(first_cell.alias("cell"), (first_cell != last_cell).alias("across")))
    turn = F.struct("place", "rendered", "tokens", "skip", "size", "role")
    before = order.rowsBetween(-history_turns, -1)
    rows = rows.withColumn("cell", cell).withColumns({
        "begins": (F.lag("cell").over(order).isNull() | (F.lag("cell").over(order) != F.col("cell"))),
        "previous": F.collect_list(F.when(~is_system, turn)).over(before),
    })
    # The turn that opens a window carries what is repeated before it.
    rows = rows.select(
        "conv_id", turn.alias("turn"), "system", F.sum(F.col("begins").cast("int")).over(running).alias("window"),
        F.when(F.col("begins"), F.col("previous")).alias("previous"),
    )
    packed = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("turn")).alias("new"), F.max("system").alias("system"),
        F.flatten(F.collect_list("previous")).alias("previous"),
    )
    fitting = F.filter("previous", lambda x, i: F.aggregate(
        F.slice("previous", i + 1, F.size("previous")), F.lit(0).cast("bigint"), lambda s, y: s + y.tokens) <= history_budget)
    opening = F.when(F.col("new")[0].place > 1, F.array_compact(F.array(F.col("system")))).otherwise(F.array().cast("array<string>"))
    context = F.concat(F.coalesce(opening, F.array().cast("array<string>")), F.transform("history", lambda x: x.rendered))
    packed = packed.withColumn("history", fitting).select("conv_id", "window", "new", context.alias("context"))
    lead = F.array_join("context", "")
    starts = F.transform("new", lambda x, i: F.aggregate(
        F.slice("new", 1, i), F.length(lead), lambda s, y: s + F.length(y.rendered)))
    loss = F.filter(
        F.transform("new", lambda x, i: F.struct(
            (starts[i] + x.skip).alias("start"), x["size"].alias("length"), (x.role == "assistant").alias("counts"))),
        lambda s: s.counts)
    return packed.select(
        "conv_id", "window",
        F.concat(lead, F.array_join(F.transform("new", lambda x: x.rendered), "")).alias("formatted"),
        F.size("context").alias("n_context"),
        F.transform(loss, lambda s: F.struct(s.start.alias("start"), s.length.alias("length"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window, from its text and mask alone: new turns (role, text) and the text under the mask, unescaped."""
    pieces = F.filter(F.split("formatted", END, -1), lambda p: p != "")
    new = F.slice(pieces, F.col("n_context") + 1, F.greatest(F.size(pieces), F.lit(1)))
    part = lambda p, group: unescape(F.regexp_extract(p, f'(?s)^{OPEN}([^"]*){CLOSE}(.*)$', group))
    return formatted.select(
        "conv_id", "window", F.length("formatted").alias("chars"),
        F.transform(new, lambda p: F.struct(part(p, 1).alias("role"), part(p, 2).alias("text"))).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr("formatted", s.start + 1, s.length))).alias("targets"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows.

    The two digests run over a whole conversation, which is therefore one value
    here; the windows themselves are rows of bounded size.
    """
    read = read_back(windows(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    parts = read.select("conv_id", "window", "chars", F.size("turns").alias("n"), said.alias("said"), F.array_join("targets", "").alias("target"))
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "said", "target"))).alias("parts"),
    )
    target = F.array_join(F.transform("parts", lambda p: p.target), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("parts", lambda p: p.said), ""), 256).alias("turns_sha256"),
        F.length(target).cast("bigint").alias("loss_chars"), F.sha2(target, 256).alias("loss_sha256"), "formatted_chars",
    )
