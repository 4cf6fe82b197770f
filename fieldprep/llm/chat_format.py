"""Conversations as budgeted windows of whole turns, with a loss mask.

A turn's place in its conversation is the number of tokens before it, by a prefix sum over the
turns. New turns are dealt to windows by that place: window k has the turns that begin in the k-th
stretch of ``STRIDE`` tokens, so no turn is cut and only the last may reach beyond. Each window
begins with the system turn, if the conversation opens with one, and repeats the turns that begin in
the last ``HISTORY`` tokens before the stretch. Targets are the assistant turns; the mask covers
those of a window's own turns, not the repeated ones, so each is learnt once.

The prefix sums are made in two steps, over blocks of turn numbers and within a block, so that a
conversation of any length is never ordered in one task as a whole.

The template marks turns with strings that begin with ``<|``. Texts may hold such strings, or those
of other templates: a backslash goes before every backslash, and into every control string, so that
none is left, and a reader drops the backslash before any character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens (words, and this many for the marks of a turn) of a window's own turns and of repeated ones.
STRIDE, HISTORY, MARKS = 512, 128, 4
#: Turn numbers in a block of the prefix sum.
BLOCK = 1024

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of common chat templates, and how they look in a text.
CONTROLS = {"<|": r"<\|", "[INST]": r"[\INST]", "[/INST]": r"[\/INST]", "<s>": r"<\s>", "</s>": r"<\/s>"}


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, shown in CONTROLS.items():
        text = F.replace(text, F.lit(control), F.lit(shown))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + MARKS


def _placed(conversations: DataFrame) -> DataFrame:
    """The turns with the tokens before them and whether they are the opening system turn."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("size", tokens(F.col("text"))).withColumn("block", F.floor(F.col("turn") / BLOCK))
    blocks = turns.groupBy("conv_id", "block").agg(F.sum("size").alias("size"))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("base"))
    known = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    turns = turns.join(blocks.withColumnsRenamed({"conv_id": "c", "block": "b"}), known).drop("c", "b")
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    return turns.withColumn("opens", (F.col("before") == 0) & (F.col("role") == "system")).drop("base", "block", "size")


def _window(stride: int, turns: DataFrame) -> DataFrame:
    return turns.withColumn("window", F.floor(F.col("before") / stride))


def windows(conversations: DataFrame, stride: int = STRIDE, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, formatted, loss.

    ``formatted`` holds the turns one after another, of which the first ``n_repeated`` are the system
    turn and history that an earlier window has as its own; ``loss`` lists the spans (start, end) of
    its targets in code points. ``history`` is at most ``stride``.

    Turns are ordered by ``turn``, NULL first; turns with one number by role and text. NULL texts and
    roles are empty. Rows without conv_id form a conversation. Rows that repeat are turns of their
    own. An empty table gives no window. Other columns are not read.
    """
    if not 0 <= history <= stride:
        raise ValueError("history must be between 0 and stride")
    turns = _window(stride, _placed(conversations))
    near = F.col("before") >= (F.col("window") + 1) * stride - history
    uses = F.array(
        F.struct(F.col("window").alias("w"), F.lit(False).alias("again")),
        F.when(near & ~F.col("opens"), F.struct((F.col("window") + 1).alias("w"), F.lit(True).alias("again"))),
    )
    used = turns.withColumn("use", F.explode(F.filter(uses, lambda x: x.isNotNull())))
    used = used.select("conv_id", F.col("use.w").alias("window"), F.col("use.again").alias("again"), "before", "turn", "role", "text")
    # The opening system turn goes to every later window of its conversation.
    opening = turns.filter("opens").select(F.col("conv_id").alias("c"), F.lit(True).alias("again"), F.lit(-1).cast("bigint").alias("before"), "turn", "role", "text")
    later = turns.filter("window > 0").select("conv_id", "window").distinct()
    retained = later.join(opening, F.col("conv_id").eqNullSafe(F.col("c"))).select(used.columns)
    piece = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), escaped(F.col("text")), F.lit(END))
    parts = used.unionByName(retained).select(
        "conv_id",
        "window",
        F.struct(
            "before", "turn", "role", piece.alias("piece"), "again",
            F.length(piece).alias("chars"),
            F.length(escaped(F.col("text"))).alias("text_chars"),
            ((F.col("role") == "assistant") & ~F.col("again")).alias("target"),
        ).alias("part"),
    )
    # A window holds stride and history tokens, the system turn and the rest of its last turn.
    grouped = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    grouped = grouped.filter(F.exists("parts", lambda p: ~p["again"]))
    ends = F.aggregate("parts", F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + p["chars"])))
    grouped = grouped.withColumn("ends", ends)
    spans = F.transform(
        "parts",
        lambda p, i: F.when(
            p["target"],
            F.struct(
                (F.get("ends", i + 1) - len(END) - p["text_chars"]).alias("start"),
                (F.get("ends", i + 1) - len(END)).alias("end"),
            ),
        ),
    )
    return grouped.select(
        "conv_id",
        "window",
        F.size(F.filter("parts", lambda p: p["again"])).alias("n_repeated"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(spans, lambda s: s.isNotNull()).alias("loss"),
    )


def read_windows(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text) without the repeated ones, targets: what a window says, unescaped."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), F.col("n_repeated") + 2, F.greatest(F.size(F.split("formatted", r"<\|turn\|>")), F.lit(1)))

    def turn(piece):
        sides = F.split(piece, r"<\|text\|>")
        return F.struct(
            unescaped(F.get(sides, 0)).alias("role"),
            unescaped(F.substring_index(F.get(sides, 1), END, 1)).alias("text"),
        )

    return formatted.select(
        "conv_id",
        "window",
        F.transform(pieces, turn).alias("turns"),
        F.transform("loss", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))).alias("targets"),
        F.length("formatted").alias("formatted_chars"),
    )


def summaries(formatted: DataFrame) -> DataFrame:
    """One row per conversation: digests of its turns and targets, read back from its windows.

    A digest is over a conversation as a whole, so this gathers it; the windows themselves are not.
    """
    said = read_windows(formatted).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("learnt"),
        "formatted_chars",
    )
    whole = said.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum(F.length("learnt")).alias("loss_chars"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "said", "learnt"))).alias("parts"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["learnt"]), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )
