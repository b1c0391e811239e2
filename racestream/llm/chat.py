"""Chat formatting in windows of a token budget.

The turns of a conversation are laid out along the prefix sum of their tokens. A window takes the turns that start within one
stride of that axis, so each turn is new in exactly one window, and whole. Before them a window repeats the system turn, if the
conversation begins with one, and the latest earlier turns that fit the history's tokens. Only new assistant turns are
targets; what is repeated is masked. The budget holds a stride, the history and the system turn; a single turn that is longer than
what is left of it is not cut. A system turn that leaves less than a quarter of the budget to new turns stands whole in the first
window alone, and the others repeat a reference to it, so that the output stays in proportion to the input.

DataFrame operations only. Prefix sums are taken over blocks of turns first, then within them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from racestream.session import written

SCHEMA = "conv_id long, turn long, role string, text string"
BUDGET, HISTORY = 1024, 256
#: Turn numbers of a block of the prefix sums.
BLOCK = 256

SYSTEM, ASSISTANT = "system", "assistant"

#: The marks of the template. Inside texts and roles their first characters, and those of other common templates, are
#: written as references, so that no text can hold a mark.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: Stands for the text of a system turn too long to repeat; no escaped text holds it.
SYSTEM_ABOVE, SYSTEM_ABOVE_TOKENS = "&system;", 6
REFERENCES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("|", "&#124;")]


def escaped(text: Column) -> Column:
    for plain, reference in REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescaped(text: Column) -> Column:
    for plain, reference in reversed(REFERENCES):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def tokens_of(text: Column) -> Column:
    """An estimate: four bytes each, and four tokens for the marks."""
    return F.ceil(F.octet_length(text) / 4) + 4


def _laid_out(conversations: DataFrame) -> DataFrame:
    """Turns with their place on the axis. ``conv`` stands for the id, also for a null one."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", tokens_of(F.col("text"))).withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    )
    blocks = turns.groupBy("conv", "block").agg(F.sum("tokens").alias("tokens"), F.count("conv").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv",
        "block",
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
    )
    order = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum("tokens").over(running), F.lit(0))).withColumn(
        "nth", F.row_number().over(order) - 1
    )
    placed = placed.join(blocks, ["conv", "block"]).select(
        "conv",
        "conv_id",
        "role",
        "text",
        "tokens",
        (F.col("start") + F.col("tokens_before")).alias("start"),
        (F.col("nth") + F.col("n_before")).alias("nth"),
    )
    return placed.withColumn("is_system", (F.col("nth") == 0) & (F.col("role") == SYSTEM))


def _turn(t: Column) -> Column:
    text = F.when(t["kind"] == -1, F.lit(SYSTEM_ABOVE)).otherwise(escaped(t["text"]))
    return F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(CLOSE), text, F.lit(END))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window of ``conversations(conv_id, turn, role, text)``.

    ``conv_id``, ``window`` (growing, not always by one), ``n_repeated`` and ``n_new`` turns, ``formatted`` text, and ``loss``: the
    spans ``(start, length)`` of the targets in it, in code points.

    Turns go by number, null first, equal ones by role and text; repeated rows are further turns. A null text or role is an empty
    one, null ids form a conversation of their own. Further columns are ignored; an empty table gives an empty one. A turn of
    more tokens than the budget is not cut, and its window exceeds the budget by as much; only the first window does so by a long
    system turn.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("the history may take a quarter of the budget")
    placed = written(_laid_out(conversations), "chat-turns")  # read five times
    fits = F.col("tokens") <= budget - history - budget // 4
    system = placed.where("is_system").select(
        "conv",
        F.when(fits, F.col("tokens")).otherwise(SYSTEM_ABOVE_TOKENS).alias("system_tokens"),
        F.struct(
            F.when(fits, 0).otherwise(-1).alias("kind"), "nth", "role", F.when(fits, F.col("text")).otherwise("").alias("text")
        ).alias("system_turn"),
    )
    stride = F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0))
    placed = placed.join(system.select("conv", "system_tokens"), "conv", "left").withColumn("stride", stride)
    placed = placed.withColumn("window", F.when(F.col("is_system"), 0).otherwise(F.expr("start div stride")))
    turn = lambda kind: F.struct(F.lit(kind).alias("kind"), "nth", "role", "text").alias("t")
    new = placed.select("conv", "conv_id", "window", turn(2))
    firsts = placed.groupBy("conv", "conv_id", "window").agg(
        F.min(F.when(~F.col("is_system"), F.col("start"))).alias("first")
    )
    later = placed.where(~F.col("is_system")).withColumn("last", F.expr(f"(start + {history}) div stride"))
    later = later.where("last > window").withColumn("to", F.explode(F.sequence(F.col("window") + 1, F.col("last"))))
    later = later.select(F.col("conv").alias("c"), "to", "start", turn(1))
    repeated = firsts.join(later, (F.col("conv") == F.col("c")) & (F.col("window") == F.col("to")))
    repeated = repeated.where(F.col("first") - F.col("start") <= history).select("conv", "conv_id", "window", "t")
    again = firsts.where("window > 0").join(system, "conv").select("conv", "conv_id", "window", F.col("system_turn").alias("t"))
    rows = new.unionByName(repeated).unionByName(again)
    gathered = rows.groupBy("conv", "conv_id", "window").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    gathered = gathered.withColumn("parts", F.transform("turns", _turn))
    ends = F.transform(F.sequence(F.lit(1), F.size("turns")), lambda i: F.aggregate(
        F.slice("parts", F.lit(1), i), F.lit(0), lambda total, part: total + F.length(part)
    ))
    gathered = gathered.withColumn("ends", ends)
    spans = F.transform("turns", lambda t, i: F.struct(
        (F.get("ends", i) - F.lit(len(END)) - F.length(escaped(t["text"]))).alias("start"),
        F.length(escaped(t["text"])).alias("length"),
        ((t["kind"] == 2) & (t["role"] == ASSISTANT)).alias("target"),
    ))
    loss = F.transform(F.filter(spans, lambda s: s["target"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    n_new = F.size(F.filter("turns", lambda t: t["kind"] == 2))
    return gathered.select(
        "conv_id",
        "window",
        (F.size("turns") - n_new).alias("n_repeated"),
        n_new.alias("n_new"),
        F.array_join("parts", "").alias("formatted"),
        loss.alias("loss"),
    )


def read_back(formatted: Column, n_repeated: Column) -> Column:
    """The new turns of a window as an array of ``(role, text)``, from its formatted text."""
    parts = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.struct(
        unescaped(F.substring(p, F.lit(len(OPEN) + 1), F.instr(p, F.lit(CLOSE)) - len(OPEN) - 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, F.lit(CLOSE)) + len(CLOSE), F.length(p))).alias("text"),
    ))
    return F.slice(turns, n_repeated + 1, F.greatest(F.size(turns) - n_repeated, F.lit(0)))


def read_targets(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, end to end."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def digests(formatted_windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: its turns, and its targets, each as a digest."""
    turns = F.transform(
        read_back(F.col("formatted"), F.col("n_repeated")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    rows = formatted_windows.select(
        "conv_id",
        F.size(turns).alias("n"),
        F.length("formatted").alias("chars"),
        F.struct("window", F.array_join(turns, "").alias("turns"), read_targets(F.col("formatted"), F.col("loss")).alias("targets")).alias("w"),
    )
    whole = lambda field: F.array_join(F.transform("ws", lambda w: w[field]), "")
    return (
        rows.groupBy("conv_id")
        .agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("ws"))
        .select("conv_id", "n_turns", "formatted_chars", whole("turns").alias("turns"), whole("targets").alias("targets"))
        .select(
            "conv_id",
            "n_turns",
            F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
            F.length("targets").cast("long").alias("loss_chars"),
            F.sha2(F.col("targets").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
