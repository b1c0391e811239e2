"""Language identification by prediction by partial matching.

For every language a tree of byte contexts, up to three bytes deep, holds how often each byte followed. A byte costs
-log2 of its share in the longest context that the tree has; a byte new to that context costs an escape, and is looked up
in the context one byte shorter, down to a uniform distribution over all bytes. With ``n`` bytes seen after a context, ``d`` of
them different, a byte seen ``c`` times has the share ``c / (n + d)``, the escape ``d / (n + d)``. The statistics are frozen
before scoring, so sequences of four bytes cost the same wherever they occur: those of a block of texts are looked up once each, and
the code length of a text is a sum over its bytes: exact, whole texts, no loop over bytes. The shortest code wins.

ASCII capitals count as small letters. Every text is coded after three spaces.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import map_rows

#: About so many documents of each language, up to twice as many, train its tree.
SAMPLE_DOCS = 1_500
#: Contexts of three bytes seen less often, in all languages, are left out of the trees.
LEAST_SEEN = 4
#: Bytes scored at once.
BLOCK = 1 << 20
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_START = b"   "


@dataclass
class Order:
    """What follows contexts of one length in one language: codes of a context and a byte seen after it, and of contexts, sorted."""

    follower: np.ndarray
    cost: np.ndarray  # bits of a follower
    context: np.ndarray
    escape: np.ndarray  # bits of an escape from a context


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted are among the known, which are sorted, and the places of those."""
    place = np.searchsorted(known, wanted)
    found = place < len(known)
    found[found] = known[place[found]] == wanted[found]
    return found, place[found]


@dataclass
class Trees:
    """The frozen costs of all languages. They hold what was seen only, so their size follows the learned texts."""

    languages: list[str]
    symbol: np.ndarray  # of each byte
    size: int  # symbols; the last stands for all bytes never seen
    orders: list[list[Order]]  # by language, and length of the context

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last of four symbols after the others, by sequence (a number in base ``size``) and language."""
        bits = np.zeros((len(codes), len(self.languages)), np.float32)
        for j, orders in enumerate(self.orders):
            left = np.arange(len(codes))
            for k in range(len(orders) - 1, -1, -1):
                code = codes[left] % self.size ** (k + 1)
                found, place = _find(orders[k].follower, code)
                bits[left[found], j] += orders[k].cost[place]
                left = left[~found]
                found, place = _find(orders[k].context, code[~found] // self.size)
                bits[left[found], j] += orders[k].escape[place]
            bits[left, j] += 8
        return bits

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        block: list[bytes] = []
        owners: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            text = _START + text.lower()
            for at in range(3, len(text), BLOCK):
                piece = text[at - 3 : at + BLOCK]
                block.append(piece)
                owners.append(i)
                held += len(piece)
                if held >= BLOCK:
                    self._add(total, block, owners)
                    block, owners, held = [], [], 0
        if block:
            self._add(total, block, owners)
        return total

    def _add(self, total: np.ndarray, block: list[bytes], owners: list[int]) -> None:
        s = self.symbol[np.frombuffer(b"".join(block), np.uint8)]
        n = self.size
        row, codes = pd.factorize(((s[:-3] * n + s[1:-2]) * n + s[2:-1]) * n + s[3:])
        cost = np.concatenate([self.costs(codes), np.zeros((1, len(self.languages)), np.float32)])
        lengths = np.array([len(piece) for piece in block])
        starts = np.cumsum(lengths) - lengths
        # Between two pieces three places mix bytes of both; they take the last row, which is zero.
        for k in range(3):
            row[starts[1:] - 3 + k] = len(codes)
        np.add.at(total, owners, np.add.reduceat(cost[row], starts, axis=0, dtype=np.float64))


def grow(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from the counts of four-byte sequences of each language (as big-endian numbers)."""
    languages = sorted(counts)
    if not languages:
        return Trees([], np.zeros(256, np.int64), 1, [])
    seen = np.zeros(256, bool)
    for grams, _ in counts.values():
        for k in range(4):
            seen[(grams >> 8 * k) & 255] = True
    size = int(seen.sum()) + 1
    symbol = np.full(256, size - 1, np.int64)
    symbol[seen] = np.arange(size - 1)
    coded = {}
    for language, (grams, times) in counts.items():
        code = np.zeros(len(grams), np.int64)
        for k in (3, 2, 1, 0):
            code = code * size + symbol[(grams >> 8 * k) & 255]
        coded[language] = (code, times.astype(np.int64))

    contexts, place = np.unique(np.concatenate([coded[x][0] // size for x in languages]), return_inverse=True)
    often = np.bincount(place, np.concatenate([coded[x][1] for x in languages]))
    kept = contexts[often >= LEAST_SEEN]

    def order(code: np.ndarray, times: np.ndarray) -> Order:
        follower, place = np.unique(code, return_inverse=True)
        c = np.bincount(place, times, len(follower))
        context, place = np.unique(follower // size, return_inverse=True)
        n, d = np.bincount(place, c, len(context)), np.bincount(place, minlength=len(context))
        cost, escape = np.log2((n + d)[place] / c), np.log2((n + d) / d)
        return Order(follower, cost.astype(np.float32), context, escape.astype(np.float32))

    trees = []
    for language in languages:
        code, times = coded[language]
        long = _find(kept, code // size)[0]
        shorter = [order(code % size ** (k + 1), times) for k in range(3)]
        trees.append([*shorter, order(code[long], times[long])])
    return Trees(languages, symbol, size, trees)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of ids that is never learned from; a null id is not held out."""
    return F.coalesce(_fold(doc_id) == 2, F.lit(False))


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def learn(documents: DataFrame) -> Trees:
    """Trees from about ``SAMPLE_DOCS`` documents of each language, chosen by the hash of their ids, outside the held-out fold."""
    rows = documents.select(F.col("doc_id"), F.col("text"), F.col("lang")).where(
        (_fold("doc_id") != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not sizes:
        return grow({})
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, max(1, n // SAMPLE_DOCS))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), shares[F.col("lang")]) == 0).select("lang", "text")

    def count(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"lang": [], "gram": [], "times": []}
        for language in sorted(set(columns["lang"])):
            grams = []
            for other, text in zip(columns["lang"], columns["text"]):
                if other == language:
                    raw = np.frombuffer(_START + text.encode().lower(), np.uint8).astype(np.int64)
                    grams.append(raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:])
            gram, times = np.unique(np.concatenate(grams), return_counts=True)
            out["lang"] += [language] * len(gram)
            out["gram"] += gram.tolist()
            out["times"] += times.tolist()
        return out

    counted = map_rows(sample, count, "lang string, gram long, times long", rows=None)
    table: pa.Table = counted.groupBy("lang", "gram").agg(F.sum("times").alias("times")).toArrow()
    language, gram, times = (table.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "gram", "times"))
    return grow({str(x): (gram[language == x], times[language == x]) for x in sorted(set(language))})


def predict(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents(doc_id, text, lang)``: whether it was held out, its language, and the share of that
    language in the likelihoods of all (equal priors).

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing could be learned. Of
    languages of equal code length the first by name wins. Further columns are ignored; an empty table gives an empty one.
    """
    spark = documents.sparkSession
    trees = spark.sparkContext.broadcast(learn(documents))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")

    def score(columns: dict[str, list]) -> dict[str, list]:
        model = trees.value
        texts = [text if text is not None and _LETTER.search(text) else None for text in columns["text"]]
        predicted, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [i for i, text in enumerate(texts) if text is not None] if model.languages else []
        bits = model.bits([texts[i].encode() for i in some])
        for i, row in zip(some, bits):
            best = int(row.argmin())
            predicted[i] = model.languages[best]
            scores[i] = float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum())
        return {"doc_id": columns["doc_id"], "held_out": columns["held_out"], "lang_pred": predicted, "score": scores}

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
