"""Quality rules of documents and of their hosts.

Every text is measured once. A document fails a rule on its own, and its failures count against its host. A host with
few documents says little about itself, so its failure rates are shrunk towards those of all hosts: the hosts' rates
are taken as draws from a beta distribution, whose mean and strength are fitted to them by moments. A host whose
shrunk rate exceeds a limit in any host rule is condemned, and its documents go with it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import fresh, with_arrow_columns
from racestream.session import written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: The characters that count as symbols, and those that separate words.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

#: A document fails a rule where its expression over the counts is true. Integers on both sides, so that no engine rounds.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
#: Failing one of these fails the base.
BASE = ["short", "repeats"]
#: Those that count against the host. Short texts say nothing about the host's longer ones.
HOST_RULES = ["repeats", "symbols", "duplicate_lines", "word_length"]

#: A host is condemned beyond this shrunk failure rate.
HOST_LIMIT = 0.5
#: Up to so many condemned hosts are broadcast, a few megabytes.
BROADCAST_HOSTS = 50_000
#: The strength of the prior, in documents, lies between these bounds.
WEAKEST, STRONGEST = 2.0, 10_000.0


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    last = dict(zip(words, range(n)))
    ids = np.fromiter(map(last.__getitem__, words), np.int64, n)
    if len(last) == n:
        return 0
    pairs = ids[:-1] * n + ids[1:]
    if n > 2_000_000:  # a third factor would overflow
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The six counts of one text; a null text is an empty one."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines)


def with_counts(docs: DataFrame, text: str, column: str) -> DataFrame:
    """Adds a struct column of the six counts to every document."""

    def counted(texts: list) -> dict[str, list]:
        return {column: [dict(zip(COUNTS, measure(t))) for t in texts]}

    return with_arrow_columns(docs, text, counted, {column: "struct<" + ",".join(f"{c}: bigint" for c in COUNTS) + ">"})


def fails(rule: str, counts: str) -> Column:
    """Whether the counts in a struct column fail a rule."""
    expression = RULES[rule]
    for name in COUNTS:
        expression = expression.replace(name, f"`{counts}`.{name}")
    return F.expr(f"({expression})")


def host_rates(counted: DataFrame, host: str, counts: str) -> DataFrame:
    """One row per host: documents, failures per rule, and the shrunk rate of each rule. Null hosts are left out."""
    failures = [F.sum(fails(rule, counts).cast("long")).alias(rule) for rule in HOST_RULES]
    hosts = (
        counted.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("docs"), *failures)
    )
    moments = []
    for rule in HOST_RULES:
        rate = F.col(rule) / F.col("docs")
        moments += [F.avg(rate).alias(f"{rule}_mean"), F.var_pop(rate).alias(f"{rule}_var")]
    row = hosts.agg(*moments, F.avg(1 / F.col("docs")).alias("noise")).first()
    for rule in HOST_RULES:
        mean, strength = beta_prior(row[f"{rule}_mean"], row[f"{rule}_var"], row["noise"])
        hosts = hosts.withColumn(f"{rule}_rate", (F.col(rule) + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength)))
    return hosts


def beta_prior(mean: float | None, variance: float | None, noise: float | None) -> tuple[float, float]:
    """Mean and strength of the beta distribution of the hosts' rates, by moments.

    The variance between hosts is what is left of the observed one without the part that their finite numbers of
    documents explain (``noise`` is the mean of 1 / documents).
    """
    mean = mean or 0.0
    spread = mean * (1 - mean)
    between = max((variance or 0.0) - spread * (noise or 0.0), 0.0)
    strength = spread / between - 1 if between > 0 else STRONGEST
    return mean, min(max(strength, WEAKEST), STRONGEST)


def with_verdicts(counted: DataFrame, host: str, counts: str, limit: float = HOST_LIMIT) -> DataFrame:
    """Adds ``_host_failed`` to counted rows. They are read twice, so they should be a written table.

    Only the condemned hosts are joined back, by broadcast if they are few. A row without a host has no verdict against it.
    """
    rates = host_rates(counted, host, counts)
    worst = F.greatest(*[F.col(f"{rule}_rate") for rule in HOST_RULES])
    condemned = written(rates.where(worst > limit).select(F.col("host").alias("_host")), "host-condemned")
    if condemned.count() <= BROADCAST_HOSTS:
        condemned = F.broadcast(condemned)
    condemned = condemned.withColumn("_condemned", F.lit(True))
    return (
        counted.join(condemned, F.col(host) == F.col("_host"), "left")
        .withColumn("_host_failed", F.coalesce("_condemned", F.lit(False)))
        .drop("_host", "_condemned")
    )


def kept(counts: str) -> Column:
    """A document stays if it fails no rule itself and its host is not condemned."""
    own = fails("short", counts)
    for rule in list(RULES)[1:]:
        own = own | fails(rule, counts)
    return ~own & ~F.col("_host_failed")


def report(documents: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of ``documents(doc_id, text, source)``: its counts, whether the base fails, and whether it is kept.

    Null texts have no words and fail the base; a null source has no host verdict; repeated rows are reported, and count
    against their host, each time; further columns are ignored; an empty table gives an empty one.
    """
    slim = documents.select("doc_id", F.col("source").alias("host"), "text")
    counted = written(with_counts(slim, "text", "counts").drop("text"), "host-quality")
    base = fails(BASE[0], "counts") | fails(BASE[1], "counts")
    return with_verdicts(counted, "host", "counts", limit).select(
        "doc_id",
        *[f"counts.{c}" for c in COUNTS[:5]],
        base.alias("base_failed"),
        kept("counts").alias("kept"),
        F.col("_host_failed").alias("host_failed"),
    )


def keep_good(documents: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that are kept, with all their columns and nothing else. Cases are as in ``report``."""
    counts = fresh(documents, "rule_counts")
    counted = written(with_counts(documents, "text", counts), "host-quality")
    return with_verdicts(counted, "source", counts, limit).where(kept(counts)).select(*documents.columns)
