"""Packing of tokenized documents into sequences of bounded length, by non-negative least squares.

1. Every text is tokenized once and cut at multiples of the sequence length; the last piece of a document is shorter.
2. The pieces' lengths are rounded up to a few hundred bins. Their histogram, whose size does not depend on the data, is all
   the driver sees.
3. Combinations of up to three bins that fill a sequence are enumerated. Non-negative least squares finds how often each
   has to be used so that together they use up the histogram; the numbers are rounded down. What is left is packed by
   best fit, longest first, again on the histogram.
4. Pieces are numbered within their bin, in slices of bounded size, and the numbers are looked up in the plan.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from racestream.llm.tables import doc_texts, map_rows
from racestream.session import written

SEQUENCE = 2048
END_ID = 1
#: Entries of a worker's memory of encoded words; about 60 MB. Words beyond are encoded each time.
REMEMBERED = 250_000
#: Pieces of a bin numbered by one task.
SLICE = 1_000

# The pattern by which byte-level vocabularies of this kind split text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A space before anything but white space is where two words' encodings are independent of each other.
_BREAK = re.compile(r" (?=\S)")
_LOOSE_SPACE = re.compile(r" (?:\s|\Z)")


# Tokens

def _byte_of() -> dict[str, int]:
    """The bytes behind the printable characters in which byte-level vocabularies are written."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Remembered(dict):
    """From a word that follows a space to the bytes of its ids."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = ids
        return ids


class Encoder:
    """The ids of texts under a byte-level vocabulary file, as little-endian unsigned 32-bit integers.

    They are those of ``tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False)``. As that merges each
    word anew, and slowly, words are encoded by a faster implementation of the same merges, and remembered.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.special = [token["content"] for token in content["added_tokens"]]
        self.whole = Tokenizer.from_file(path)
        pieces = [pair if isinstance(pair, list) else pair.split(" ") for pair in content["model"]["merges"]]
        merged = [vocabulary[a + b] for a, b in pieces]
        if merged != sorted(merged) or content["normalizer"] or content["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("ids must be in the order of the merges, and texts must be taken as they are")
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.words = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.remembered = _Remembered(self._encode)

    def _encode(self, text: str) -> bytes:
        return array("I", self.words.encode_ordinary(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *others = _BREAK.split(text) if _LOOSE_SPACE.search(text) else text.split(" ")
        return self._encode(first) + b"".join(map(self.remembered.__getitem__, others))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, so that its memory of words lasts over tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized(documents: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Per document its number of ids, the end id included, and the checksum of each piece."""

    def encode(columns: dict[str, list]) -> dict[str, list]:
        ids_of, end, step = encoder(vocabulary), array("I", [end_id]).tobytes(), 4 * sequence
        counts, checksums = [], []
        for text in columns["text"]:
            ids = ids_of(text) + end
            counts.append(len(ids) // 4)
            checksums.append([zlib.crc32(ids[i : i + step]) for i in range(0, len(ids), step)])
        return {"doc_id": columns["doc_id"], "doc_tokens": counts, "checksums": checksums}

    return map_rows(doc_texts(documents), encode, "doc_id long, doc_tokens long, checksums array<long>")


# The plan, on the histogram

def bin_of(length: Column) -> Column:
    """Lengths rounded up: exact to 64, then to multiples of 4, beyond 256 of 16."""
    up = lambda step: F.ceil(length / step) * step
    return F.when(length <= 64, length).when(length <= 256, up(4)).otherwise(up(16)).cast("long")


def combinations(bins: list[int], sequence: int) -> list[dict[int, int]]:
    """Up to three bins, with repetition, that fill a sequence as far as these bins can."""
    sizes = np.array(sorted(bins))
    found: set[tuple[int, ...]] = set()
    for i, a in enumerate(sizes):
        rest = sequence - a
        if rest < sizes[0]:
            found.add((int(a),))
            continue
        found.add((int(a), int(sizes[np.searchsorted(sizes, rest, "right") - 1])))
        seconds = sizes[: i + 1]
        thirds = rest - seconds
        fits = thirds >= sizes[0]
        place = np.searchsorted(sizes, thirds[fits], "right") - 1
        found.update((int(a), int(b), int(c)) for b, c in zip(seconds[fits], sizes[place]))
    unique = {tuple(sorted(f, reverse=True)) for f in found if sequence - sum(f) < max(16, sequence // 128)}
    return [{size: f.count(size) for size in f} for f in sorted(unique, reverse=True)]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with the least squared error of ``a @ x - b``, by the active-set method."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        active[best] = True
        while active.any():
            chosen = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 0
            old = x[chosen]
            step = np.min(old[low] / np.maximum(old[low] - solved[low], 1e-300))
            x[chosen] = old + step * (solved - old)
            x[chosen[low & (x[chosen] <= 1e-12 * max(1.0, x.max()))]] = 0
            gone = chosen[x[chosen] <= 0]
            active[gone] = False
            if not len(gone):
                break
    return x


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Combinations of bins and how many sequences each fills; together they use the histogram up exactly."""
    left = {size: n for size, n in histogram.items() if n > 0}
    uses: list[tuple[dict[int, int], int]] = []
    if sequence in left:
        uses.append(({sequence: 1}, left.pop(sequence)))
    patterns = combinations(list(left), sequence) if left else []
    if patterns:
        sizes = sorted(left)
        row = {size: i for i, size in enumerate(sizes)}
        matrix = np.zeros((len(sizes), len(patterns)))
        for j, pattern in enumerate(patterns):
            for size, times in pattern.items():
                matrix[row[size], j] = times
        weight = np.array(sizes) / sequence + 0.05  # a long piece left over costs more than a short one
        wanted = np.array([left[size] for size in sizes], float)
        repeats = nnls(matrix * weight[:, None], wanted * weight)
        for j in np.argsort(-repeats, kind="stable"):
            n = min([int(repeats[j] + 1e-6), *(left[size] // times for size, times in patterns[j].items())])
            if n > 0:
                uses.append((patterns[j], n))
                for size, times in patterns[j].items():
                    left[size] -= n * times
    return uses + best_fit(left, sequence)


def best_fit(left: dict[int, int], sequence: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each piece into the fullest open sequence that takes it; equal sequences are handled together."""
    opened: dict[int, list[tuple[dict[int, int], int]]] = {}
    for size in sorted(left, reverse=True):
        n = left[size]
        while n > 0:
            space = min((s for s in opened if s >= size and opened[s]), default=None)
            if space is None:
                per = sequence // size
                for times, count in ((per, n // per), (n % per, 1)):
                    if times and count:
                        opened.setdefault(sequence - times * size, []).append(({size: times}, count))
                break
            pattern, count = opened[space].pop()
            used = min(n, count)
            if used < count:
                opened[space].append((pattern, count - used))
            opened.setdefault(space - size, []).append((pattern | {size: pattern.get(size, 0) + 1}, used))
            n -= used
    return [use for uses in opened.values() for use in uses]


# Assignment

def _numbered(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Numbers the pieces of each bin from 0, a slice of a bin per group."""
    spark = pieces.sparkSession
    slices = spark.createDataFrame([(b, -(-n // SLICE)) for b, n in histogram.items()], "bin long, slices long")
    dealt = pieces.join(F.broadcast(slices), "bin").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("slices"))
    )
    before = Window.partitionBy("bin").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("bin", "slice")
        .count()
        .select("bin", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    order = Window.partitionBy("bin", "slice").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.withColumn("number", F.row_number().over(order) - 1)
    return ranked.join(firsts, ["bin", "slice"]).withColumn("number", F.col("number") + F.col("first"))


def pack(
    documents: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row per piece of ``documents(doc_id, text)``: where it lies in its document, and in which sequence.

    A null text is an empty one and so a piece of one id, the end id. Repeated rows are packed each time. Further columns
    are ignored. An empty table gives an empty one.
    """
    spark = documents.sparkSession
    tokens = written(tokenized(documents, vocabulary, sequence, end_id), "packing-tokens")
    pieces = tokens.select("doc_id", "doc_tokens", F.posexplode("checksums").alias("nth", "ids_crc32")).select(
        "doc_id",
        (F.col("nth").cast("long") * sequence).alias("start"),
        F.least(F.lit(sequence).cast("long"), F.col("doc_tokens") - F.col("nth").cast("long") * sequence).alias("length"),
        "ids_crc32",
        "doc_tokens",
    )
    pieces = pieces.withColumn("bin", F.least(bin_of(F.col("length")), F.lit(sequence).cast("long")))
    histogram = {row["bin"]: row["count"] for row in pieces.groupBy("bin").count().collect()}
    ranges, used, first_sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, n in plan(histogram, sequence):
        for size, times in pattern.items():
            ranges.append((size, used[size], used[size] + n * times, times, first_sequence))
            used[size] += n * times
        first_sequence += n
    lookup = spark.createDataFrame(ranges, "bin long, low long, high long, times long, first_sequence long")
    inside = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    numbered = _numbered(pieces, histogram).alias("p")
    placed = numbered.join(F.broadcast(lookup).alias("l"), (F.col("p.bin") == F.col("l.bin")) & inside).withColumn(
        "sequence_id", F.expr("first_sequence + (number - low) div times")
    )
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("p.bin"), "number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )
