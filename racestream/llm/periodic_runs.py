"""Periodic runs of words, found by block convolution over exact integer transforms.

A run is a stretch of words with smallest period q, no shorter than ``LEAST`` and 2q, that cannot be longer. Its words equal those q
further on, over a stretch of max(q, LEAST - q) words at least, so that stretch holds a whole block of the text's division into
blocks of B words, for B about half of q. At every dyadic scale B, the blocks are correlated with the windows that
follow them at distances 2B-1 to 4B-2, and the sum of squared differences is zero where a block occurs again. The correlations
are number-theoretic transforms modulo the prime 65537, so they are exact; a sum that is a multiple of the prime without being zero is told
by comparing the words. Distances of occurrences seed an extension to both sides.

Occurrences inside a run already known, at a multiple of its period, give that run again and are left out; so a text of one word
costs as much as any other. Texts are laid side by side and all blocks of a scale are transformed together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import SPACE, doc_texts, map_rows

LEAST = 12

#: The prime 2^16 + 1, a generator of its units, and the longest block, which a transform of 65536 holds four times. Beyond that
#: scale a block stands by its first words, and its window is taken in several pieces.
PRIME, GENERATOR, LONGEST = 65537, 3, 1 << 14

#: Numbers in a transform of many blocks, and words of the texts searched together. A longer text is searched alone.
AT_ONCE, TOGETHER = 1 << 17, 1 << 18

#: Modulus and base of the hash that extends occurrences; what it says is compared with the words.
HASH_MODULUS, HASH_BASE = (1 << 31) - 1, 1_000_003


# Transforms: numbers by row, blocks by column. Rows come out in bit-reversed order and go in so.

def _fold(x: np.ndarray) -> np.ndarray:
    """The same residues, smaller by 16 bits, as 2^16 is -1."""
    low = x & 65535
    x >>= 16
    low -= x
    return low


_roots: dict[tuple[int, bool], np.ndarray] = {}


def _powers(half: int, inverse: bool) -> np.ndarray:
    if (half, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers = [1]
        for _ in range(half - 1):
            powers.append(powers[-1] * root % PRIME)
        _roots[half, inverse] = np.array(powers, np.int64)[None, :, None]
    return _roots[half, inverse]


def transform(a: np.ndarray) -> np.ndarray:
    """Forward, in place. Sums are not reduced: they double at each of at most 16 steps, which 64 bits hold."""
    size, count = a.shape
    half = size // 2
    while half:
        pairs = a.reshape(-1, 2, half, count)
        difference = pairs[:, 0] - pairs[:, 1]
        pairs[:, 0] += pairs[:, 1]
        difference *= _powers(half, False)
        pairs[:, 1] = _fold(difference)
        half //= 2
    return a


def inverse_transform(a: np.ndarray) -> np.ndarray:
    """Backward, in place, times the size."""
    size, count = a.shape
    half = 1
    while half < size:
        pairs = a.reshape(-1, 2, half, count)
        right = _fold(pairs[:, 1] * _powers(half, True))
        pairs[:, 1] = pairs[:, 0] - right
        pairs[:, 0] += right
        half *= 2
    return a


def occurrences(values: np.ndarray, squares: np.ndarray, starts: np.ndarray, block: int, first: int, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances, from ``first`` on, at which the sum of squared differences is zero modulo the prime.

    ``squares`` are the running sums of squared values. Distances that lead beyond the values may be given falsely.
    """
    size, last = 4 * block, len(values) - 1
    step = np.arange(block)[:, None]
    here = np.zeros((size, len(starts)), np.int64)
    here[-step[:, 0] % size] = values[starts + step]
    there = values[np.minimum(starts + first + np.arange(size)[:, None], last)]
    product = _fold(_fold(transform(here))) * _fold(_fold(transform(there)))
    products = inverse_transform(_fold(product))[:lags]
    at = np.minimum(starts + first + np.arange(lags + block)[:, None], last + 1)
    sums = squares[at]
    sums = sums[block:] - sums[:lags] + (squares[starts + block] - squares[starts])
    sums = _fold(_fold(sums)) * size
    sums -= 2 * products
    lag, found = np.nonzero(sums % PRIME == 0)
    return starts[found], lag + first


# Extension

class Words:
    """The words of texts side by side, as numbers, and the bounds of each word's text."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        self.ids = ids
        sizes = np.diff(bounds)
        self.low, self.high = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        powers = np.ones(len(ids) + 1, np.int64)
        done, power = 1, HASH_BASE % HASH_MODULUS
        while done < len(powers):
            more = min(done, len(powers) - done)
            powers[done : done + more] = powers[:more] * power % HASH_MODULUS
            done, power = done + more, power * power % HASH_MODULUS
        self.powers = powers
        terms = (ids + 1) * 2_654_435_761 % HASH_MODULUS * powers[:-1] % HASH_MODULUS
        self.sums = np.concatenate([[0], np.cumsum(terms) % HASH_MODULUS])

    def equal(self, at: np.ndarray, length: np.ndarray | int, distance: np.ndarray) -> np.ndarray:
        """Whether so many words equal those at a distance, as far as the hash tells: never false for equal ones."""
        one = (self.sums[at + length] - self.sums[at]) % HASH_MODULUS
        other = (self.sums[at + distance + length] - self.sums[at + distance]) % HASH_MODULUS
        return one * self.powers[distance] % HASH_MODULUS == other

    def extended(self, at: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far the words equal those at a distance, to the left of each place and from it on."""
        found = []
        for sign, most in ((-1, at - self.low[at]), (1, self.high[at] - at - distance)):
            least = np.zeros(len(at), np.int64)
            most = most.copy()
            while (least < most).any():
                middle = (least + most + 1) // 2
                good = self.equal(at - middle if sign < 0 else at, middle, distance)
                least = np.where(good, middle, least)
                most = np.where(good, most, middle - 1)
            found.append(least)
        return found[0], found[1]

    def exact(self, place: int, a: int, b: int, d: int) -> tuple[int, int]:
        """The stretch around a place whose words equal those at distance d: that given, if it is right."""
        ids, low, high = self.ids, int(self.low[place]), int(self.high[place])
        inside = (ids[a:b] == ids[a + d : b + d]).all()
        if inside and (a == low or ids[a - 1] != ids[a - 1 + d]) and (b + d == high or ids[b] != ids[b + d]):
            return a, b
        other = np.flatnonzero(ids[low : high - d] != ids[low + d : high]) + low
        nth = int(np.searchsorted(other, place))
        if nth < len(other) and other[nth] == place:
            return place, place
        return int(other[nth - 1]) + 1 if nth else low, int(other[nth]) if nth < len(other) else high - d


class Known:
    """Runs found so far: (start, end) and the smallest period."""

    def __init__(self) -> None:
        self.periods: dict[tuple[int, int], int] = {}
        self.settle()

    def add(self, start: int, end: int, period: int) -> None:
        self.periods[start, end] = min(period, self.periods.get((start, end), period))

    def settle(self) -> None:
        """Lets ``covers`` see what was added."""
        rows = np.array(sorted((*span, period) for span, period in self.periods.items()), np.int64).reshape(-1, 3)
        self.starts, self.ends, self.period = rows.T
        number = np.arange(len(rows))
        self.widest = np.maximum.accumulate(self.ends * len(rows) + number) % len(rows) if len(rows) else number

    def covers(self, at: np.ndarray, block: int, distance: np.ndarray) -> np.ndarray:
        """Whether a block and its occurrence lie in one run, at a multiple of its period.

        It looks at the run that reaches furthest of those that begin before the block.
        """
        if not len(self.starts):
            return np.zeros(len(at), bool)
        before = np.searchsorted(self.starts, at, "right")
        run = self.widest[np.maximum(before - 1, 0)]
        return (before > 0) & (self.ends[run] >= at + distance + block) & (distance % self.period[run] == 0)


def _scales(most: int) -> Iterator[tuple[int, int, int]]:
    """Blocks and distances (B, first, last) that find all periods up to ``most``."""
    scale, first, last = 2, 1, 6
    while first <= most:
        yield scale, first, last
        scale, first, last = 2 * scale, last + 1, 8 * scale - 2


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.int64) % PRIME


def _seeds(values: np.ndarray, squares: np.ndarray, words: Words, starts: np.ndarray, scale: int, first: int, last: int, known: Known):
    block = min(scale, LONGEST)
    together = max(1, AT_ONCE // (4 * block))
    places, distances = [], []
    for low in range(first, last + 1, 2 * block):
        lags = min(2 * block, last + 1 - low)
        usable = starts[starts + low + block <= words.high[starts]]
        for k in range(0, len(usable), together):
            at, distance = occurrences(values, squares, usable[k : k + together], block, low, lags)
            good = at + distance + block <= words.high[at]
            at, distance = at[good], distance[good]
            good = ~known.covers(at, block, distance)
            at, distance = at[good], distance[good]
            good = words.equal(at, block, distance)
            places.append(at[good])
            distances.append(distance[good])
    if not places:
        return starts[:0], starts[:0]
    at, distance = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # Of neighbouring blocks with the same distance, which lie in one stretch, the first.
    follows = (np.diff(at) == scale) & (np.diff(distance) == 0) & (block == scale)
    alone = np.concatenate([[True], ~follows])[: len(at)]
    return at[alone], distance[alone]


def runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs in texts side by side, by start and period; ``bounds`` are where texts begin, and the end.

    Equal words have equal ids; ``least`` is 12 or more, as the smallest scale finds no shorter runs.
    """
    if least < LEAST:
        raise ValueError(f"runs of less than {LEAST} words are not searched for")
    ids, bounds = np.asarray(ids, np.int64), np.asarray(bounds, np.int64)
    sizes, known = np.diff(bounds), Known()
    if not len(ids):
        return np.zeros((0, 3), np.int64)
    words = Words(ids, bounds)
    values = _mixed(ids)
    squares = np.concatenate([[0], np.cumsum(values * values)])
    for scale, first, last in _scales(int(sizes.max()) // 2):
        fit = sizes >= max(LEAST, 2 * first)
        counts = np.maximum((sizes - min(scale, LONGEST) - first) // scale + 1, 0) * fit
        starts = np.repeat(bounds[:-1], counts) + scale * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        at, distance = _seeds(values, squares, words, starts, scale, first, last, known)
        left, right = words.extended(at, distance)
        long = left + right + distance >= np.maximum(least, 2 * distance)
        rows = np.stack([at - left, at + right, distance, at], 1)[long]
        for place, a, b, d in sorted({(p, a, b, d) for a, b, d, p in rows.tolist()}):
            a, b = words.exact(place, a, b, d)
            if b - a + d >= max(least, 2 * d):
                known.add(a, b + d, d)
        known.settle()
    found = sorted((a, p, b - a) for (a, b), p in known.periods.items())
    return np.array([(a, length, p) for a, p, length in found], np.int64).reshape(-1, 3)


# Texts

def kept(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change)[:-1] == 0


def search(texts: list[str]) -> dict[str, list]:
    """The columns of ``find`` for some texts."""
    out: dict[str, list] = {"n_words": [], "runs": [], "collapsed": []}
    some: list[list[bytes]] = []
    total = 0

    def finish() -> None:
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(word, len(numbers)) for words in some for word in words], np.int64)
        bounds = np.cumsum([0, *map(len, some)])
        found = runs(ids, bounds)
        first = np.searchsorted(found[:, 0], bounds)
        for words, bound, a, b in zip(some, bounds.tolist(), first[:-1], first[1:]):
            mine = found[a:b] - [bound, 0, 0]
            left = words if a == b else [words[i] for i in np.flatnonzero(kept(len(words), mine))]
            out["n_words"].append(len(words))
            out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in mine.tolist()])
            out["collapsed"].append(b" ".join(left).decode())
        some.clear()

    for text in texts:
        words = text.encode().split()
        if some and total + len(words) > TOGETHER:
            finish()
            total = 0
        some.append(words)
        total += len(words)
    finish()
    return out


def find(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: words, runs by start and period, and the text without the repetitions.

    Words lie between ASCII white space. A null text has none, as an empty one; without runs, ``collapsed`` is all words joined by
    single spaces. Repeated rows are searched each, null ids stay, further columns are ignored, and an empty table gives an
    empty one. A text of any length is searched whole, in memory in proportion to it.
    """
    def run(columns: dict[str, list]) -> dict[str, list]:
        return {"doc_id": columns["doc_id"], **search(columns["text"])}

    schema = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_rows(doc_texts(documents), run, schema)


def repeated(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which about a tenth of the texts, by a hash of the id, repeat a part of their words to the end.

    With h the hash of the id as text (that of an empty text for a null id) and g = h // 10, texts with h % 10 = 0 repeat, from word a = g % n,
    the p = 1 + (n - a) // (3 + g % 8) words from there; so they hold runs to be found.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = F.filter(F.split("text", SPACE), lambda w: w != "")
    n = F.size("words")
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    part = F.slice("words", (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice("words", F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    texts = doc_texts(documents).withColumn("words", F.when(h % 10 == 0, split).otherwise(F.array().cast("array<string>")))
    return texts.select("doc_id", F.when(n > 0, F.concat_ws(" ", whole)).otherwise(F.col("text")).alias("text"))


def _line(run: Column) -> Column:
    return F.concat(run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","), run["period"].cast("string"), F.lit("\n"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest (then first, then of smallest period), and digests of all runs and of the collapsed text."""
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"].alias("period"))))
    best = found.withColumn("best", ranked)
    length, start, period = (F.col("best")[i] for i in ("length", "col2", "col3"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(1000 * length / -period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", _line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
