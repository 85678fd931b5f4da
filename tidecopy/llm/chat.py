r"""Chat formatting in budgeted, turn-aligned windows, with DataFrame functions only.

A turn is written ``<s>[INST]role[/INST]text</s>``; inside roles and texts ``\``,
``<`` and ``[`` are written ``\b``, ``\l`` and ``\s``, so no mark can be forged
and the text comes back unchanged.

Prefix sums of the turns' tokens (words, plus ``TURN_TOKENS`` for the marks)
choose the spans: with room S for new turns, a turn lies in the cell pair
(start div S, (end - 1) div S). Turns inside one cell make a span of at most S
tokens; a turn that crosses a cell border makes a span of its own, so no turn
is cut and only a turn that is itself larger than S exceeds it. Every window
starts with the conversation's system turn (its first turn, if its role is
``system``), repeats up to ``history_turns`` turns before the span that fit
``history_tokens``, and then has the span. The loss mask holds the assistant
texts of the span; repeated turns are not learnt twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage

WORD = r"[^\x20\x09-\x0D]+"
OPEN, HEAD_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
TURN_TOKENS = 4
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\s"))


def escape(c: Column) -> Column:
    for plain, coded in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _members(turns: DataFrame, budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """One row per turn and window that shows it: conv_id, window, idx, repeated, role, text (both escaped)."""
    key = Window.partitionBy("conv_id")
    order = key.orderBy("turn", "role", "text")
    t = (turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
         .withColumn("idx", F.row_number().over(order))
         .withColumn("tokens", (F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).cast("long"))
         .withColumn("is_system", (F.col("idx") == 1) & (F.col("role") == "system"))
         .withColumn("system_tokens", F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(
             order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    body = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    t = (t.withColumn("end", F.sum(body).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("start", F.col("end") - body)
         .withColumn("room", F.greatest(F.lit(1), F.lit(budget) - F.lit(history_tokens) - F.col("system_tokens"))))
    cell = F.when(~F.col("is_system"), F.struct(F.expr("start div room").alias("a"), F.expr("(end - 1) div room").alias("b")))
    t = t.withColumn("cell", cell)
    opens = (~F.col("is_system")) & ((F.lag("is_system", 1, True).over(order)) | (F.lag("cell").over(order) != F.col("cell")))
    t = t.withColumn("opens", opens)
    t = t.withColumn("window", F.greatest(F.lit(0), F.sum(F.col("opens").cast("long")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1))
    t = t.withColumn("last_window", F.max("window").over(key))
    later = [F.when(F.lead("opens", d).over(order) & (F.lead("start", d).over(order) - F.col("start") <= history_tokens),
                    F.lead("window", d).over(order)) for d in range(1, history_turns + 1)]
    shown = F.when(F.col("is_system"), F.sequence(F.lit(0).cast("long"), F.col("last_window"))).otherwise(
        F.array_compact(F.array(F.col("window"), *later)))
    t = t.withColumn("shown", shown)
    return t.select("conv_id", "idx", "role", "text", F.col("window").alias("own"), F.explode("shown").alias("window")).select(
        "conv_id", "window", "idx", (F.col("own") != F.col("window")).alias("repeated"),
        escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"))


def chat_windows(turns: DataFrame, *, budget: int = 512, history_turns: int = 2, history_tokens: int = 128) -> DataFrame:
    """conv_id, window, text (formatted), n_repeated (leading turns repeated from
    earlier windows), loss (array of start and length in code points).

    ``turns`` has conv_id, turn, role, text. A null text or role is empty, a null
    turn comes first, equal turn numbers go by role and text, a null conv_id is a
    conversation of its own, repeated rows are turns of their own; an empty table
    gives no windows; other columns don't matter. A window's turns are gathered,
    never a conversation's.
    """
    rows = _members(turns, budget, history_turns, history_tokens)
    row = F.struct("idx", "repeated", "role", "text", F.length("role").alias("nr"), F.length("text").alias("nt"))
    w = rows.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(row)).alias("t"))
    marks = len(OPEN) + len(HEAD_END)
    size = lambda x: x["nr"] + x["nt"] + F.lit(marks + len(CLOSE))
    spans = F.transform("t", lambda x, i: F.struct(
        (F.aggregate(F.slice("t", F.lit(1), i), F.lit(0), lambda a, y: a + size(y)) + x["nr"] + F.lit(marks)).alias("start"),
        x["nt"].alias("len"), (~x["repeated"] & (x["role"] == "assistant")).alias("learnt")))
    text = F.array_join(F.transform("t", lambda x: F.concat(F.lit(OPEN), x["role"], F.lit(HEAD_END), x["text"], F.lit(CLOSE))), "")
    return w.select(
        "conv_id", "window", text.alias("text"), F.size(F.filter("t", lambda x: x["repeated"])).alias("n_repeated"),
        F.transform(F.filter(spans, lambda s: s["learnt"]), lambda s: F.struct(s["start"], s["len"])).alias("loss"))


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, window, roles and texts of the window's own turns, its loss texts, formatted_chars."""
    pattern = F.lit(r"<s>\[INST\]([^\[]*)\[/INST\]([^<]*)</s>")
    own = lambda group: F.transform(
        F.filter(F.regexp_extract_all("text", pattern, F.lit(group)), lambda x, i: i >= F.col("n_repeated")), unescape)
    return windows.select(
        "conv_id", "window", own(1).alias("roles"), own(2).alias("texts"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["len"]))).alias("learnt"),
        F.length("text").alias("formatted_chars"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows as read back: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. (Only here a conversation's text
    comes together: its digest is asked for.)"""
    said = F.array_join(F.transform(F.arrays_zip("roles", "texts"),
                                    lambda x: F.concat(x["roles"], F.lit("\n"), x["texts"], F.lit("\n"))), "")
    per = read_windows(windows).select("conv_id", F.struct(
        "window", F.size("texts").alias("n"), said.alias("said"), F.array_join("learnt", "").alias("learnt"),
        "formatted_chars").alias("w"))
    whole = per.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    learnt = F.array_join(F.transform("w", lambda x: x["learnt"]), "")
    total = lambda name: F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x[name])
    return whole.select(
        "conv_id", total("n").alias("n_turns"),
        F.sha2(F.array_join(F.transform("w", lambda x: x["said"]), ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        total("formatted_chars").alias("formatted_chars"))


def chat_digests(turns: DataFrame, **options) -> DataFrame:
    """Format, write, read back and digest."""
    return digests(Stage(turns.sparkSession, "chat").write(chat_windows(turns, **options)))
