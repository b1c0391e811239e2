"""Mixing of sources to target weights by iterative proportional fitting (raking).

Documents fall into cells by source, language and topic. Each cell's tokens get a weight, the product of one factor per margin, such
that the weighted tokens of every source, every language and every topic reach their target shares; the factors are fitted margin by
margin, in turns, until all margins hold. A cell's weighted tokens over its tokens, times the budget, are the expected copies of
each of its documents, which are drawn by a hash of the document. Where a document is kept at most once, expected copies are bounded by one
while the factors are fitted, so that the other cells make up for those at the bound.

DataFrame operations only. Each cell carries the product of its factors, and the cells are written between rounds.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racestream.llm.tables import fresh, n_words
from racestream.session import written

log = logging.getLogger(__name__)

MARGINS = ["source", "lang", "topic"]

#: A target share is the share of tokens to this power, made to sum to one, unless targets are given.
TEMPER = 0.7
#: Rounds end when every margin was within this of its target, relatively, or after so many; what is left is returned.
TOLERANCE, MOST_ROUNDS = 0.001, 25
#: Rounds between two looks at the margins; those of up to so many cells are one plan.
ROUNDS_AT_ONCE, FEW_CELLS = 5, 1_000_000
#: Sampled tokens, as a part of all.
BUDGET = 0.5
#: What stands for a missing value of a margin.
MISSING = "(none)"

#: A document's topic is the first whose condition holds.
TOPICS = [
    ("legal", "contains(text, 'icense') OR contains(text, 'opyright')"),
    ("contact", "contains(text, '@')"),
    ("tables", "contains(text, ' | ')"),
    ("figures", "text RLIKE '[0-9]'"),
]


def topic() -> Column:
    branches = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in TOPICS)
    return F.expr(f"CASE {branches} ELSE 'prose' END")


def _features() -> Column:
    """The margins of a row of ``documents(doc_id, text, lang, source)``, its tokens (at least one), and a uniform number."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(17))).otherwise(F.xxhash64("doc_id", F.lit(17)))
    present = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
    return F.struct(
        present("source").alias("source"),
        present("lang").alias("lang"),
        topic().alias("topic"),
        F.greatest(n_words(F.col("text")), F.lit(1)).cast("long").alias("n_tokens"),
        (F.pmod(key, F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("u"),
    )


def tempered(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """Target shares ``(value, share)`` that lie between those of the tokens (1) and equal ones (0)."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("share"))
    whole = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.withColumn("share", F.col("share") / F.lit(whole))


def _weighted(most: float | None) -> Column:
    """The tokens of a cell times its factor, by ``most`` at most."""
    weighted = F.col("tokens") * F.col("factor")
    return weighted if most is None else F.least(weighted, F.col("tokens") * F.lit(most))


def _scaled(cells: DataFrame, margin: str, most: float | None, few: bool) -> DataFrame:
    """The cells with factors scaled so that one margin holds, and how far off its value was.

    Sums of few cells are taken by a window, without a join. Otherwise they are taken before the shuffle, and a value with many cells is
    split by adaptive execution, so no task takes a value whole.
    """
    if few:
        summed = cells.withColumn("sum", F.sum(_weighted(most)).over(Window.partitionBy(margin)))
    else:
        sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum(_weighted(most)).alias("sum"))
        summed = cells.join(sums.hint("merge"), F.col(margin) == F.col("value")).drop("value")
    ratio = F.when(F.col("sum") > 0, F.col(f"goal_{margin}") / F.col("sum")).otherwise(0.0)
    off = F.when(F.col("factor") > 0, F.abs(ratio - 1)).otherwise(0.0)
    return summed.withColumn("residual", F.greatest("residual", off)).withColumn("factor", F.col("factor") * ratio).drop("sum")


def _within(goals: DataFrame, total: float) -> DataFrame:
    """Goals no larger than what their values ``hold``; the others grow alike, so that the sum stays, as far as there is enough."""
    scale = 1.0
    while True:
        scaled = F.col("goal") * F.lit(scale)
        free = F.col("hold") > scaled
        row = goals.agg(F.sum(F.when(free, scaled)).alias("free"), F.sum(F.when(~free, F.col("hold"))).alias("held")).first()
        rest = total - (row["held"] or 0.0)
        if not row["free"] or rest <= row["free"] * (1 + 1e-9):
            return goals.withColumn("goal", F.least(scaled, F.col("hold")))
        scale *= rest / row["free"]


def rake(cells: DataFrame, targets: dict[str, DataFrame], most: float | None = None) -> DataFrame:
    """Adds ``weighted`` to a written table of cells with ``tokens``: weighted tokens that meet the target shares of each margin.

    A value without a target has share zero. Shares count among those values that occur. If targets contradict each other, given
    which cells are empty, the last margin is met and the others are approached. ``residual`` tells how far off the values of a cell were,
    relatively, when the last round began: within ``TOLERANCE``, unless ``MOST_ROUNDS`` did not suffice.

    No cell's weight is above ``most``, if given; the other cells make up for it. A target beyond what its value then holds is
    lowered to that, and the others of its margin are raised.
    """
    columns = cells.columns
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    fitted = cells.withColumn("factor", F.lit(1.0))
    for margin, target in targets.items():
        hold = cells.groupBy(F.col(margin).alias("value")).agg((F.sum("tokens") * F.lit(most or 1.0)).alias("hold"))
        present = hold.join(target, "value", "left")
        present = written(present.withColumn("share", F.coalesce("share", F.lit(0.0))), "mixing-targets")
        whole = present.agg(F.sum("share")).first()[0] or 1.0
        goals = present.select("value", "hold", (F.col("share") * F.lit(total / whole)).alias("goal"))
        if most is not None:
            goals = _within(goals, total)
        fitted = fitted.join(goals.select(F.col("value").alias(margin), F.col("goal").alias(f"goal_{margin}")), margin)
    fitted = written(fitted, "mixing-cells")
    few = fitted.count() <= FEW_CELLS
    for done in range(1, MOST_ROUNDS + 1):
        fitted = fitted.withColumn("residual", F.lit(0.0))
        for margin in targets:
            fitted = _scaled(fitted, margin, most, few)
        if not few or done % ROUNDS_AT_ONCE == 0:
            fitted = written(fitted, "mixing-cells")
        if done % ROUNDS_AT_ONCE:
            continue
        worst = fitted.agg(F.max("residual")).first()[0] or 0.0
        if worst <= TOLERANCE:
            break
    else:
        log.warning("a margin was still off by %.2g of its target after %d rounds", worst, MOST_ROUNDS)
    return fitted.select(*columns, _weighted(most).alias("weighted"), "residual")


def rates(rows: DataFrame, targets: dict[str, DataFrame] | None, budget: float, once: bool = False) -> DataFrame:
    """Expected copies of a document by cell, and their residual, from rows of margins and tokens; with ``once``, one at most."""
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "mixing-cells")
    targets = targets or {margin: tempered(cells, margin) for margin in MARGINS}
    expected = F.lit(budget) * F.col("weighted") / F.col("tokens")
    expected = F.when(F.lit(once) & (expected > 1 - 1e-9), 1.0).otherwise(expected)
    return written(rake(cells, targets, 1 / budget if once else None).select(*MARGINS, expected.alias("expected"), "residual"), "mixing-rates")


def _drawn(expected: Column, u: Column) -> Column:
    """Whole copies, and one more with the probability of the rest."""
    return (F.floor(expected) + (u < expected - F.floor(expected)).cast("long")).cast("long")


def sample(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled of ``documents(doc_id, text, lang, source)``: margins, tokens, expected and drawn copies (one or more), residual.

    ``targets`` gives shares ``(value, share)`` per margin; by default they are tempered. Null sources and languages are values of
    their own; null and empty texts are prose of one token. Repeated rows are drawn alike. Further columns are ignored; an
    empty table gives an empty one.
    """
    rows = written(documents.select("doc_id", _features().alias("mix")).select("doc_id", "mix.*"), "mixing-rows")
    return (
        rows.join(rates(rows, targets, budget), MARGINS)
        .withColumn("copies", _drawn(F.col("expected"), F.col("u")))
        .where("copies > 0")
        .select("doc_id", *MARGINS, "n_tokens", "expected", "copies", "residual")
    )


def thin(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """Documents drawn to the target shares, each at most once, with all their columns. Cases are as in ``sample``.

    The features are computed twice, as that is cheaper than to write the texts.
    """
    mix, rate = fresh(documents, "mix"), fresh(documents, "expected_copies")
    featured = documents.withColumn(mix, _features())
    by_cell = rates(featured.select(f"{mix}.*"), targets, budget, once=True)
    by_cell = by_cell.select(F.struct(*MARGINS).alias("cell"), F.col("expected").alias(rate))
    cell = F.struct(*[F.col(f"{mix}.{margin}") for margin in MARGINS])
    drawn = featured.join(by_cell, cell == F.col("cell")).where(_drawn(F.col(rate), F.col(f"{mix}.u")) > 0)
    return drawn.select(*[F.col(f"`{c}`") for c in documents.columns])
