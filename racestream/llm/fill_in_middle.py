"""Fill-in-the-middle: texts cut at two token boundaries, found through a piecewise-linear learned rank index.

A text is cut into tokens, and a cut is drawn by its rank among the boundaries of those tokens. The index answers which offset a
rank has. It is fitted to all boundaries: segments of lines through their end points, each split in halves until no boundary is further
than ``MOST_OFF`` from its line, and the residual of every boundary as one byte. A lookup finds the segment of a rank,
predicts the offset on its line, and adds the residual, so it is exact.

The texts of a batch share one index, whose first segments are the texts; so they are fitted together in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import map_rows

PREFIX, SUFFIX, MIDDLE = MARKS = "<P>", "<S>", "<M>"

#: Of a hundred texts, those cut at all, and of the cut ones, those whose suffix comes first.
CUT, SUFFIX_FIRST = 90, 20

#: The error bound of a segment; residuals fit a signed byte.
MOST_OFF = 127

#: Code points of the texts indexed together. A longer text is indexed alone.
TOGETHER = 1 << 20


@dataclass
class RankIndex:
    """Offsets of ranks, by segments: first rank of each, its offset, and the rise over its run to the next one's."""

    ranks: np.ndarray
    offsets: np.ndarray
    rises: np.ndarray
    runs: np.ndarray
    residuals: np.ndarray

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.ranks, ranks, "right") - 1
        return self.offsets[segment] + (ranks - self.ranks[segment]) * self.rises[segment] // self.runs[segment]

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of ranks."""
        return self.predicted(ranks) + self.residuals[ranks]


def fit(offsets: np.ndarray, starts: np.ndarray, most_off: int = MOST_OFF) -> RankIndex:
    """The index of increasing ``offsets``; ``starts`` are the ranks where first segments begin, 0 among them.

    All segments of a level are tested at once, and those with a boundary too far from their line are split.
    A segment of one step has no error, so the splitting ends.
    """
    count = len(offsets)
    residuals = np.zeros(count, np.int8)
    firsts, ends = np.asarray(starts, np.int64), np.append(starts[1:], count).astype(np.int64)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    while len(firsts):
        sizes = ends - firsts
        runs = np.maximum(sizes - 1, 1)
        rises = offsets[ends - 1] - offsets[firsts]
        owner = np.repeat(np.arange(len(firsts)), sizes)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rank = firsts[owner] + step
        off = offsets[rank] - offsets[firsts][owner] - step * rises[owner] // runs[owner]
        worst = np.maximum.reduceat(np.abs(off), np.cumsum(sizes) - sizes)
        good = worst <= most_off
        fine = good[owner]
        residuals[rank[fine]] = off[fine]
        kept.append((firsts[good], ends[good]))
        firsts, ends = firsts[~good], ends[~good]
        middles = (firsts + ends) // 2
        firsts, ends = np.concatenate([firsts, middles]), np.concatenate([middles, ends])
    firsts, ends = (np.concatenate(part) for part in zip(*kept)) if kept else (np.zeros(0, np.int64),) * 2
    order = np.argsort(firsts, kind="stable")
    firsts, ends = firsts[order], ends[order]
    return RankIndex(firsts, offsets[firsts], offsets[ends - 1] - offsets[firsts], np.maximum(ends - 1 - firsts, 1), residuals)


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all token boundaries in the texts, ends included, and the ranks where each text's begin.

    Tokens are runs of ASCII letters, and every other code point. Offsets count through the texts, one more between two of them.
    """
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - 97) < 26
    inner = np.zeros(len(points) + 1, bool)
    inner[1:-1] = letter[:-1] & letter[1:]
    lengths = np.array([len(text) for text in texts], np.int64)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    offsets = np.flatnonzero(~inner)
    return offsets, np.searchsorted(offsets, firsts)


def _numbers(doc_id: int | None) -> list[int]:
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _portions(texts: list[str]) -> Iterator[slice]:
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > TOGETHER:
            yield slice(start, i)
            start, total = i, 0
        total += len(text)
    if texts:
        yield slice(start, len(texts))


def _arranged(text: str, form: str, first: int, second: int) -> str:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def arrange(ids: list[int | None], texts: list[str], cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> dict[str, list]:
    """The columns of ``transform`` for some texts."""
    out: dict[str, list] = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
    for part in _portions(texts):
        some = texts[part]
        offsets, starts = boundaries(some)
        index = fit(offsets, starts)
        counts = np.append(starts[1:], len(offsets)) - starts - 1
        numbers = np.array([_numbers(doc_id) for doc_id in ids[part]], np.int64).reshape(-1, 4)
        ranks = np.sort(numbers[:, :2] % (counts + 1)[:, None], axis=1) + starts[:, None]
        cuts = index.offset(ranks) - index.offset(starts)[:, None]
        for text, n, (first, second), (_, _, h3, h4) in zip(some, counts.tolist(), cuts.tolist(), numbers.tolist()):
            plain = not text or h3 % 100 >= cut or any(mark in text for mark in MARKS)
            form = "plain" if plain else "spm" if h4 % 100 < suffix_first else "psm"
            out["n"].append(n)
            out["form"].append(form)
            out["prefix_chars"].append(None if plain else first)
            out["middle_chars"].append(None if plain else second - first)
            out["output"].append(text if plain else _arranged(text, form, first, second))
    return out


def transform(documents: DataFrame, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: tokens, form, code points of prefix and middle, and the output text.

    ``cut`` of a hundred texts are cut at two boundaries drawn by a hash of the id, and ``suffix_first`` of a hundred of those
    begin with their suffix. Empty texts, and texts that hold a mark, stay plain. A null text is an empty one, a null
    id hashes like an empty one, repeated rows are each cut alike, further columns are ignored, and an empty table gives an
    empty one.
    """

    def run(columns: dict[str, list]) -> dict[str, list]:
        return {"doc_id": columns["doc_id"], **arrange(columns["doc_id"], columns["text"], cut, suffix_first)}

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_rows(texts, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text behind an output. Its parts hold no mark, and no mark overlaps another, so the marks found are those set."""
    part = F.split(output, "|".join(MARKS), -1)
    prefix = F.when(form == "psm", part[1]).otherwise(part[2])
    suffix = F.when(form == "psm", part[2]).otherwise(part[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, part[3], suffix))


def digests(transformed: DataFrame) -> DataFrame:
    """The output and the text restored from it, as digests."""
    back = restored(F.col("output"), F.col("form"))
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )
