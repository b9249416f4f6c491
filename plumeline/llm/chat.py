"""Conversations as training texts: windows under a token budget, with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window (about), of repeated history in it, and what a turn's marks cost.
BUDGET, HISTORY, MARKS = 1024, 192, 4
#: Rows of a conversation whose running total is one window function's work (by turn number).
STRETCH = 256
OPEN, CLOSE, END = "<|", "|>\n", "</s>\n"


def escape(text: Column) -> Column:
    """A text in which no control string can stand: after each ``<`` and ``[`` comes a backslash.

    Every control string of the usual templates has one of the two, so it is broken there; taking the
    backslash after each of them away gives the text back.
    """
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))


def escape_role(role: Column) -> Column:
    """A role also loses the bar that ends it."""
    return F.replace(escape(role), F.lit("|"), F.lit("|\\"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("|\\"), F.lit("|")))


def turn_tokens(text: Column) -> Column:
    """A turn's cost: a token per four bytes, rounded up, and its marks."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + MARKS


def budgeted_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Training texts of conversations: (conv, window, formatted, fresh, loss).

    Running totals of turn tokens cut a conversation into turn-aligned spans, one per window. A window
    opens with the conversation's leading system turn, repeats the turns of at most ``history`` tokens
    before its span, and goes on with the span. ``fresh`` tells for each turn of the text whether it
    stands in its own window; ``loss`` has (start, length) in code points, from 0, of the escaped
    texts of fresh assistant turns: repeated targets are masked.

    A span starts anew at multiples of half the room that system turn and history leave, so a window
    is over the budget only when it has a turn of more than that. Turns go by number, null last, and
    equal numbers by a hash of role and text. A null text or role is empty, a null conversation is one
    more, other columns are ignored, and an empty table gives no rows.
    """
    order = ["late", "turn", "hash", "role", "text"]
    rows = turns.select(
        turns[conv].alias("conv"),
        turns[turn].cast("long").alias("turn"),
        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text], F.lit("")).alias("text"),
    ).select(
        "*",
        F.col("turn").isNull().alias("late"),
        F.xxhash64("role", "text").alias("hash"),
        F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(1 << 62)).alias("stretch"),
        turn_tokens(F.col("text")).alias("tokens"),
    )
    # Running totals: stretches of a conversation first, then the turns within each.
    key = ["conv", "stretch"]
    before = lambda by, *sort: Window.partitionBy(*by).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*key).agg(F.sum("tokens").alias("sum"), F.min(F.struct(*order)).alias("first"))
    first = F.first("first").over(Window.partitionBy("conv").orderBy("stretch"))
    heads = heads.select(*key, F.coalesce(F.sum("sum").over(before(["conv"], "stretch")), F.lit(0)).alias("base"), first.alias("head"))
    is_system = F.col("head.role") == "system"
    heads = heads.select(
        *key, "base",
        F.when(is_system, F.col("head.text")).alias("system"),
        F.when(is_system, turn_tokens(F.col("head.text"))).otherwise(0).alias("kept"),
    )
    placed = rows.join(heads.select(*[F.col(k).alias(f"h_{k}") for k in key], "base", "kept", "system"), [F.col("conv").eqNullSafe(F.col("h_conv")), F.col("stretch") == F.col("h_stretch")])
    at = F.col("base") + F.coalesce(F.sum("tokens").over(before(key, *order)), F.lit(0))
    step = F.greatest(F.expr(f"({budget} - {history} - kept) div 2"), F.lit(1))
    placed = placed.withColumn("at", at).withColumn("step", step).withColumn("own", F.expr("at div step"))
    leading = (F.col("at") == 0) & F.col("system").isNotNull()
    placed = placed.select("conv", *order, "at", "tokens", "own", "step", leading.alias("leading"))
    spans = placed.groupBy("conv", "own").agg(F.min("at").alias("from"))
    # A turn stands in its own window, and as history in those that begin soon after it.
    seen = placed.withColumn("window", F.explode(F.when(F.col("leading"), F.array("own")).otherwise(F.sequence("own", F.expr(f"(at + {history}) div step")))))
    seen = seen.join(spans.select(F.col("conv").alias("s_conv"), F.col("own").alias("s_own"), "from"), [F.col("conv").eqNullSafe(F.col("s_conv")), F.col("window") == F.col("s_own")])
    fresh = F.col("window") == F.col("own")
    seen = seen.where(fresh | (F.col("from") - F.col("at") <= history)).select("conv", "window", "at", "role", "text", *order[:3], fresh.alias("fresh"))
    # Windows after the first get the leading system turn again.
    systems = placed.where("leading").select(F.col("conv").alias("y_conv"), "own", F.col("role").alias("y_role"), F.col("text").alias("y_text"))
    again = spans.join(systems.withColumnRenamed("own", "y_own"), [F.col("conv").eqNullSafe(F.col("y_conv")), F.col("own") > F.col("y_own")]).select(
        "conv", F.col("own").alias("window"), F.lit(-1).cast("long").alias("at"), F.col("y_role").alias("role"), F.col("y_text").alias("text"),
        F.lit(False).alias("late"), F.lit(-1).cast("long").alias("turn"), F.lit(0).cast("long").alias("hash"), F.lit(False).alias("fresh"),
    )
    marked = seen.unionByName(again).select(
        "conv", "window", "at", *order[:3],
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(CLOSE)).alias("mark"), escape(F.col("text")).alias("body"),
        "fresh", (F.col("fresh") & (F.col("role") == "assistant")).alias("target"),
    )
    packed = marked.groupBy("conv", "window").agg(F.array_sort(F.collect_list(F.struct("at", *order[:3], "mark", "body", "fresh", "target"))).alias("t"))
    texts = F.transform("t", lambda x: F.concat(x["mark"], x["body"], F.lit(END)))
    sizes = F.transform("t", lambda x: F.length(x["mark"]) + F.length(x["body"]) + len(END))
    starts = F.transform("t", lambda x, i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, b: a + b) + F.length(x["mark"]))
    loss = F.filter(F.zip_with("t", starts, lambda x, s: F.struct(s.alias("start"), F.length(x["body"]).alias("length"), x["target"].alias("target"))), lambda x: x["target"])
    return packed.select(
        F.col("conv").alias(conv), "window", F.array_join(texts, "").alias("formatted"), F.transform("t", lambda x: x["fresh"]).alias("fresh"),
        F.transform(loss, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss"),
    )


def read_back(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns, loss_text, formatted_chars), from the formatted texts and masks alone.

    ``turns`` is role, line end, text, line end of each turn in order; ``loss_text`` all text under
    the mask. A conversation's whole text comes together in one row, as its digest needs it.
    """
    parts = F.transform(
        F.filter(F.split("formatted", END, -1), lambda x: x != ""),
        lambda x: F.struct(
            unescape_role(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), CLOSE, 1)).alias("role"),
            unescape(F.substr(x, F.instr(x, CLOSE) + len(CLOSE))).alias("text"),
        ),
    )
    fresh = F.filter(F.arrays_zip(parts.alias("p"), F.col("fresh")), lambda x: x["fresh"])
    said = F.array_join(F.transform(fresh, lambda x: F.concat(x["p"]["role"], F.lit("\n"), x["p"]["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss", lambda x: unescape(F.substr("formatted", x["start"] + 1, x["length"]))), "")
    read = windows.select(F.col(conv).alias("conv"), "window", F.size(fresh).alias("n"), said.alias("said"), loss.alias("loss"), F.length("formatted").alias("chars"))
    whole = read.groupBy("conv").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return whole.select(
        F.col("conv").alias(conv), "n_turns",
        F.array_join(F.transform("w", lambda x: x["said"]), "").alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"), "formatted_chars",
    )
