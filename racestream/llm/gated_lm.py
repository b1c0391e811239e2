"""Log-likelihood of whole texts under a gated recurrent language model.

Tokens are words (ASCII capitals as small letters) and one end per text. Token counts cover the whole training fold. The most
frequent tokens have output weights of their own, in classes of equal size; further ones share a class with tokens of similar
rank, and within it the probability (count + 1) / sum. The output softmax is factored accordingly: class, then token.

* Training: truncated backpropagation through time in numpy, once over all whole texts of the training fold. Texts are dealt by the
  hash of their ids to shards of about as many tokens whatever the size of the corpus, in an order that follows from the ids. A
  round trains its shards side by side from the same weights and averages them by tokens, in whole numbers, on the executors; each
  round takes twice as many shards as the one before. So the weights follow from the documents, not from partitions or tasks.
* Scoring: texts are laid end to end in lanes, a window at a time; one matrix product per step moves all lanes on, and the state
  is carried from window to window until a text ends. So every text is scored whole, whatever its length.
* Exponentials of logits stay as they are: products of them with the weights give both the sums to divide by and the gradients.
* The counts of rare tokens, whose number grows with the corpus, are joined, not broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from racestream.llm.tables import doc_texts, ship
from racestream.session import new_folder, written

#: The end of a text, as a token. No word holds white space.
END = "\n"
#: Tokens whose counts are broadcast, by falling count; at most about 10 MB. Those of all others are joined.
FREQUENT = 200_000
#: Tokens with output weights of their own cover this part of the training fold, and are so many at least; how many make a class.
COVERAGE, LEAST_LEARNED, CLASS_SIZE = 0.6, 1024, 64
#: Further classes take twice as many ranks each, up to the frequent ones; the last class holds all others.
HIDDEN = 16

#: Tokens of a shard, about: what is trained in sequence between two averages.
SHARD_TOKENS = 1 << 20
TRAIN_LANES, TRAIN_WINDOW = 256, 32
#: Step size in the first round, and the tokens behind one step; a last step of fewer is shorter.
RATE, STEP_TOKENS = 0.01, 4096
#: Averages are sums of whole numbers, so that their order does not matter: changes of weights in millionths (about), at most
#: eight, times thousands (about) of tokens. They are exact up to some 10^15 tokens. Sums travel in blocks of so many weights.
UNIT, MOST_CHANGE, BLOCK = 2.0**20, 8.0, 1 << 14
#: Tasks of a round at most; further shards share them.
MOST_TASKS = 1 << 15

LANES, WINDOW = 384, 64
#: States whose classes are weighed at a time, so that the numbers stay in the processor's cache.
SLICE = 2048
#: Memory that a worker keeps between windows, about; never touched, so it costs none by itself.
KEPT_BYTES = 16 << 20
#: Logits without their biases stay within this, so that their exponentials need no shift; those of steeper weights have one.
STEEP = 60.0
#: Bytes of text, and one text more, whose tokens a worker holds at a time.
PART_BYTES = 16 << 20


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the seventh of ids that is never learned from; a null id is neither held out nor learned from."""
    return F.coalesce(_fold(doc_id) == 2, F.lit(False))


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def part_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, as ``words`` gives them, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found, n = split.flatten().cast(pa.binary()), np.diff(split.offsets.to_numpy())
    # White space at either end of a text leaves an empty string there.
    empty = pc.binary_length(found).to_numpy() == 0
    if empty.any():
        n = n - np.bincount(np.repeat(np.arange(len(n)), n)[empty], minlength=len(n))
        found = found.filter(pa.array(~empty))
    return found, n


# Counts

def token_counts(documents: DataFrame) -> DataFrame:
    """The count of every token of the training fold. Each batch is counted before its counts are shuffled."""

    ship(documents.sparkSession)
    schema = pa.schema([("token", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [{"token": [END], "n": [batch.num_rows]}]
            for part in _parts(batch):
                found = pc.value_counts(part_words(part.column("text"))[0])
                counts.append({"token": found.field("values").cast(pa.string()), "n": found.field("counts")})
            table = pa.concat_tables(pa.Table.from_pydict(columns, schema) for columns in counts)
            if len(counts) > 2:
                table = table.group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"])
            yield from table.combine_chunks().to_batches()

    learned_from = doc_texts(documents).where(_fold("doc_id") != 2).select("text")
    counted = learned_from.mapInArrow(count, "token string, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The frequent tokens by falling count, and the classes of all."""

    tokens: list[bytes]
    counts: np.ndarray
    total: int  # tokens of the training fold
    distinct: int

    def __post_init__(self) -> None:
        self.rank = {token: i for i, token in enumerate(self.tokens)}
        self.as_array = pa.array(self.tokens, pa.binary())
        self.end = self.rank.get(END.encode())
        self.others = len(self.tokens)  # the rank of all further tokens
        ranks = np.arange(self.others + 1)
        covering = int(np.searchsorted(np.cumsum(self.counts), COVERAGE * self.total)) + 1
        #: Tokens with weights of their own, a whole number of classes.
        self.learned = max(LEAST_LEARNED, -(-min(covering, self.others) // CLASS_SIZE) * CLASS_SIZE)
        beyond = np.maximum(ranks // self.learned, 1)
        self.learned_classes = self.learned // CLASS_SIZE
        classes = np.where(ranks < self.learned, ranks // CLASS_SIZE, self.learned_classes + np.log2(beyond).astype(int))
        last = self.learned_classes + max(1, int(math.log2(max(FREQUENT // self.learned, 1))) + 1)
        classes[-1] = last
        self.token_class = classes.astype(np.int32)
        self.n_classes = last + 1
        #: What a token is as input: itself, or its class.
        self.as_input = np.where(ranks < self.learned, ranks, self.learned + classes - self.learned_classes).astype(np.int32)
        self.as_input[-1] = self.learned + last - self.learned_classes
        self.n_inputs = self.learned + self.n_classes - self.learned_classes
        #: A token of each input; training needs no more of a token than its input.
        self.of_input = np.zeros(self.n_inputs, np.int32)
        self.of_input[self.as_input[::-1]] = ranks[::-1]
        smoothed = self.counts + 1.0
        sums = np.bincount(classes[:-1], smoothed, self.n_classes)
        # One more in the last class, for tokens never seen.
        sums[last] = self.total + self.distinct - smoothed.sum() + 1
        self.rest_sum = float(max(sums[last], 1.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = np.log10(smoothed / sums[classes[:-1]])
        #: log10 of a token's share of its class; zero for those whose share the model gives, or the join.
        self.inside = np.where(ranks[:-1] < self.learned, 0.0, inside)
        self.inside = np.append(self.inside, 0.0)
        self.base = np.append(np.log10(smoothed), 0.0)
        self.known = np.append(self.counts > 0, False)

    def __getstate__(self) -> dict:
        """Tasks look tokens up by ``ids``; the Python objects of all of them stay where they were made."""
        return {name: value for name, value in vars(self).items() if name not in ("tokens", "rank")}

    def ids(self, tokens: list[bytes] | pa.Array) -> np.ndarray:
        found = pc.index_in(pa.array(tokens, pa.binary()), value_set=self.as_array)
        return found.fill_null(self.others).to_numpy()


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The frequent tokens are all those above a count such that no more than ``FREQUENT`` are.

    The count comes from a histogram on a logarithmic scale, so that no task sorts or gathers more than those tokens.
    """
    totals = counts.agg(F.sum("n").alias("total"), F.count("n").alias("distinct")).first()
    level = F.floor(F.log2(F.col("n")) * 64).cast("int")
    histogram = {row["level"]: row["count"] for row in counts.groupBy(level.alias("level")).count().collect()}
    chosen, least = 0, 1 << 30
    for at in sorted(histogram, reverse=True):
        chosen += histogram[at]
        if chosen > FREQUENT:
            break
        least = at
    table = counts.where(level >= least).toArrow()
    n = table.column("n").to_numpy().astype(np.int64)
    tokens = [t.encode() for t in table.column("token").to_pylist()]
    order = sorted(range(len(tokens)), key=lambda i: (-n[i], tokens[i]))
    tokens, n = [tokens[i] for i in order], n[order]
    if END.encode() not in tokens:
        tokens, n = [*tokens, END.encode()], np.append(n, 0)
    return Vocabulary(tokens, n, totals["total"] or 0, totals["distinct"] or 0)


# The model

Weights = dict[str, np.ndarray]


def initial(v: Vocabulary) -> Weights:
    random = np.random.default_rng(7)
    small = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
    smoothed = v.counts + 1.0
    mass = np.bincount(v.token_class[:-1], smoothed, v.n_classes)
    mass[-1] = v.rest_sum
    inside = np.full(v.learned, -30.0, np.float32)
    learned = min(v.learned, v.others)
    inside[:learned] = np.log(smoothed[:learned])
    return {
        "x": small(v.n_inputs, 3 * HIDDEN),
        "u": small(HIDDEN, 3 * HIDDEN),
        "b": np.zeros(3 * HIDDEN, np.float32),
        "c": small(HIDDEN, v.n_classes),
        "cb": np.log(np.maximum(mass, 1e-3) / max(mass.sum(), 1.0)).astype(np.float32),
        "w": small(v.learned, HIDDEN),
        "wb": inside,
    }


def _advance(
    w: Weights, h: np.ndarray, x: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All steps of a window: the states before and after each step, the gates z, r and n, and what r lets through.

    Arrays are steps by units by lanes, so that a gate of all lanes is one piece of memory; ``h`` is units by lanes.
    """
    steps, lanes = x.shape
    half = np.ones(3 * HIDDEN, w["x"].dtype)
    half[: 2 * HIDDEN] = 0.5  # the logistic function by the hyperbolic tangent of half its argument
    given = w["x"] + w["b"]
    given *= half
    gates = np.ascontiguousarray(given.take(x, 0).transpose(0, 2, 1))
    u = np.ascontiguousarray((w["u"] * half).T)
    before = np.empty((steps, HIDDEN, lanes), gates.dtype)
    after, through = np.empty_like(before), np.empty_like(before)
    begins = first.any(1)
    for t in range(steps):
        np.multiply(h, ~first[t], out=before[t]) if begins[t] else np.copyto(before[t], h)
        a = u @ before[t]
        zr, n = gates[t, : 2 * HIDDEN], gates[t, 2 * HIDDEN :]
        zr += a[: 2 * HIDDEN]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        through[t] = a[2 * HIDDEN :]
        n += zr[HIDDEN:] * through[t]
        np.tanh(n, out=n)
        h = after[t]
        np.subtract(before[t], n, out=h)
        h *= zr[:HIDDEN]
        h += n
    return before, after, gates, through


class Outputs:
    """The output weights in rows of units and a bias, for states in rows of units and a one.

    ``classes`` and ``tokens`` give logits. ``of_classes`` and ``of_tokens`` have ones in place of the biases: exponentials times
    them are sums of weights, and last the sum to divide by. States lie between -1 and 1 and biases are shifted to at most zero
    within a softmax, so the sum of a row's weights bounds its logits.
    """

    def __init__(self, w: Weights, v: Vocabulary):
        bias = w["wb"].reshape(-1, CLASS_SIZE)
        bias = (bias - bias.max(1, keepdims=True)).reshape(-1, 1)
        self.classes = np.hstack([w["c"].T, (w["cb"] - w["cb"].max())[:, None]])
        self.tokens = np.hstack([w["w"], bias])
        self.of_classes, self.of_tokens = self.classes.copy(), self.tokens.copy()
        self.of_classes[:, -1] = self.of_tokens[:, -1] = 1
        self.steep = max(np.abs(w["c"]).sum(0).max(), np.abs(w["w"]).sum(1).max()) > STEEP

    def shifted(self, logits: np.ndarray) -> np.ndarray:
        if self.steep:
            logits -= logits.max(1, keepdims=True)
        return logits


def _with_ones(states: np.ndarray) -> np.ndarray:
    used = np.ones((len(states), HIDDEN + 1), states.dtype)
    used[:, :-1] = states
    return used


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def _log_shares(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of the chosen ones, one in each row; the logits are overwritten."""
    value = logits[np.arange(len(logits)), chosen]
    np.exp(logits, out=logits)
    return value - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def log10_shares(w: Weights, v: Vocabulary, h: np.ndarray, target: np.ndarray, outputs: Outputs | None = None) -> np.ndarray:
    """log10 of each target's probability after its state, but for the share of a token of the last class."""
    outputs = outputs or Outputs(w, v)
    classes = v.token_class[target].astype(np.min_scalar_type(v.n_classes))
    order = np.argsort(classes, kind="stable")
    classes, goal, used = classes[order], target[order], _with_ones(h.take(order, 0))
    ends = np.searchsorted(classes, np.arange(v.learned_classes + 1, dtype=classes.dtype))
    shares = np.empty(len(order))
    for at in range(0, len(order), SLICE):
        part = slice(at, at + SLICE)
        shares[part] = _log_shares(outputs.shifted(used[part] @ outputs.classes.T), classes[part])
    for k in np.flatnonzero(np.diff(ends)):
        part, of = slice(ends[k], ends[k + 1]), slice(k * CLASS_SIZE, (k + 1) * CLASS_SIZE)
        shares[part] += _log_shares(outputs.shifted(used[part] @ outputs.tokens[of].T), goal[part] - k * CLASS_SIZE)
    value = np.empty(len(order))
    value[order] = shares
    return value / math.log(10) + v.inside[target]


def _in_rows(states: np.ndarray) -> np.ndarray:
    """Steps by units by lanes as rows of units, in the order of steps and lanes."""
    return np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(-1, states.shape[1])


def _keep_freed() -> None:
    """Frees a block larger than a window's arrays: the C library then keeps freed memory of that size for the next window.

    Otherwise it returns every large array to the system, which hands out zeroed pages anew, a fifth of the time. On a C library
    that does not adapt like this it does nothing.
    """
    np.empty(KEPT_BYTES, np.uint8)


class Lanes:
    """Texts one after another in lanes, laid out a window at a time: a lane that ends its text takes the next one.

    ``x``, ``y``, ``owner`` and ``first`` hold the current window, steps by lanes; without ``window``, all there is. ``kept`` are
    those lanes of the window before that go on. So memory is that of one window and of the texts in the lanes. Where few lanes
    go on, windows have as many more steps as take ``least`` tokens, so that long texts left over do not take a window for every few.
    """

    def __init__(self, texts: Iterable[np.ndarray], lanes: int, end: int, window: int | None = None, least: int = 0):
        if window is None:
            texts = list(texts)
            window = sum(len(text) + 1 for text in texts)
        self.window, self.least = window, least
        around = np.array([end], np.int32)
        #: Texts between ends: a token's target is the next one.
        self.waiting = ((i, np.concatenate([around, text, around]), 0) for i, text in enumerate(texts))
        self.places: list[tuple[int, np.ndarray, int] | None] = list(islice(self.waiting, lanes))
        self.advance()

    def advance(self) -> bool:
        """Lays out the next window; false, and an empty one, if nothing is left."""
        self.kept = np.array([k for k, place in enumerate(self.places) if place is not None], np.int64)
        self.places = [place for place in self.places if place is not None]
        window = max(self.window, self.least // max(len(self.places), 1))
        shape = (len(self.places), window)
        x, y = np.zeros(shape, np.int32), np.full(shape, -1, np.int32)
        owner, first = np.zeros(shape, np.int32), np.zeros(shape, bool)
        steps = 0
        for lane, place in enumerate(self.places):
            t = 0
            while place is not None and t < window:
                i, row, at = place
                stop = min(len(row) - 1, at + window - t)
                to = t + stop - at
                x[lane, t:to], y[lane, t:to] = row[at:stop], row[at + 1 : stop + 1]
                first[lane, t] = not at
                owner[lane, t:to] = i
                t, place = to, (i, row, stop) if stop < len(row) - 1 else next(self.waiting, None)
            self.places[lane] = place
            steps = max(steps, t)
        self.x, self.y, self.owner, self.first = (np.ascontiguousarray(a[:, :steps].T) for a in (x, y, owner, first))
        return steps > 0


def score(w: Weights, v: Vocabulary, texts: list[np.ndarray], lanes: int = LANES) -> np.ndarray:
    """log10 of each text's probability, end included, but for the shares of tokens of the last class."""
    _keep_freed()
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sums = np.zeros(len(texts))
    laid = Lanes((texts[i] for i in order), lanes, v.end, WINDOW, LANES * WINDOW)
    outputs = Outputs(w, v)
    h = np.zeros((HIDDEN, len(laid.kept)), np.float32)
    while len(laid.x):
        states = _advance(w, h[:, laid.kept], v.as_input[laid.x], laid.first)[1]
        h = states[-1]
        real = np.flatnonzero(laid.y.reshape(-1) >= 0)
        shares = log10_shares(w, v, _in_rows(states)[real], laid.y.reshape(-1)[real], outputs)
        np.add.at(sums, laid.owner.reshape(-1)[real], shares)
        laid.advance()
    total = np.zeros(len(texts))
    total[order] = sums
    return total


def train(w: Weights, v: Vocabulary, texts: Iterable[np.ndarray], rate: float = RATE) -> tuple[Weights, int]:
    """One pass over the texts: truncated backpropagation in windows whose state is carried on, with adaptive steps.

    A step takes the windows of ``STEP_TOKENS`` tokens or more, so that a few long texts left over do not steer many steps.
    Returns the weights and the tokens learned from.
    """
    _keep_freed()
    w = {name: value.copy() for name, value in w.items()}
    moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in w.items()}
    sums: Weights = {}
    laid = Lanes(texts, TRAIN_LANES, v.end, TRAIN_WINDOW, STEP_TOKENS)
    h = np.zeros((HIDDEN, len(laid.kept)), np.float32)
    outputs = Outputs(w, v)
    step = tokens = held = 0
    while len(laid.x):
        n = int((laid.y >= 0).sum())
        slopes, h = _window(w, v, h[:, laid.kept], v.as_input[laid.x], laid.y, laid.first, outputs)
        for name, slope in slopes.items():
            slope *= np.float32(n)
            if held:
                slope += sums[name]
        sums = slopes
        tokens, held = tokens + n, held + n
        more = laid.advance()
        if held < STEP_TOKENS and more:
            continue
        step += 1
        for name, value in w.items():
            _move(value, sums[name], *moments[name], held, step, rate * min(1.0, held / STEP_TOKENS))
        outputs, held = Outputs(w, v), 0
    return w, tokens


def _move(w: np.ndarray, sums: np.ndarray, first: np.ndarray, second: np.ndarray, held: int, step: int, rate: float) -> None:
    """An adaptive step of weights, in place and a cache's worth at a time, by slopes summed over ``held`` tokens."""
    rate, unbiased = rate / (1 - 0.9**step), 1 / (1 - 0.99**step)
    flat = [a.reshape(-1) for a in (w, sums, first, second)]
    for at in range(0, w.size, BLOCK):
        value, slope, m, s = (a[at : at + BLOCK] for a in flat)
        slope *= np.float32(1 / held)
        m *= np.float32(0.9)
        m += np.float32(0.1) * slope
        slope *= slope
        slope *= np.float32(0.01)
        s *= np.float32(0.99)
        s += slope
        spread = s * np.float32(unbiased)
        np.sqrt(spread, out=spread)
        spread += np.float32(1e-6)
        np.divide(m, spread, out=spread)
        spread *= np.float32(rate)
        value -= spread


def _window(
    w: Weights, v: Vocabulary, h: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray, outputs: Outputs | None = None
) -> tuple[Weights, np.ndarray]:
    """Gradients of the mean loss of a window, and the state after it."""
    before, after, gates, through = _advance(w, h, x, first)
    h = after[-1]
    slopes = {name: np.zeros_like(value) for name, value in w.items()}
    target = y.reshape(-1)
    real = np.flatnonzero(target >= 0)
    if not len(real):
        return slopes, h
    d_used, real = _output_slopes(slopes, outputs or Outputs(w, v), v, _with_ones(_in_rows(after)), target, real)
    steps, lanes = x.shape
    # States without a target take the last row, which is zero.
    place = np.full(steps * lanes, len(real))
    place[real] = np.arange(len(real))
    d_states = d_used.take(place, 0)
    d_states = np.ascontiguousarray(d_states.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
    z, r, n = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
    to_n = (1 - z) * (1 - n * n)
    to_z = (before - n) * z * (1 - z)
    to_r = through * r * (1 - r)
    d_gates, d_n = np.empty_like(gates), np.empty_like(before)
    d_h = np.zeros((HIDDEN, lanes), d_used.dtype)
    begins = first.any(1)
    for t in range(steps - 1, -1, -1):
        d_h += d_states[t]
        np.multiply(d_h, to_n[t], out=d_n[t])
        np.multiply(d_h, to_z[t], out=d_gates[t, :HIDDEN])
        np.multiply(d_n[t], to_r[t], out=d_gates[t, HIDDEN : 2 * HIDDEN])
        np.multiply(d_n[t], r[t], out=d_gates[t, 2 * HIDDEN :])
        d_h *= z[t]
        d_h += w["u"] @ d_gates[t]
        if begins[t]:
            d_h *= ~first[t]
    slopes["u"][:] = np.matmul(before, d_gates.transpose(0, 2, 1)).sum(0)
    d_gates[:, 2 * HIDDEN :] = d_n
    rows, inputs = _in_rows(d_gates), x.reshape(-1).astype(np.min_scalar_type(v.n_inputs))
    order = np.argsort(inputs, kind="stable")
    inputs = inputs[order]
    starts = _starts(inputs)
    slopes["x"][inputs[starts]] = np.add.reduceat(rows.take(order, 0), starts, axis=0)
    slopes["b"][:] = np.ones(len(rows), rows.dtype) @ rows
    norm = math.sqrt(sum(float(np.vdot(s, s)) for s in slopes.values()))
    if norm > 1:
        for s in slopes.values():
            s *= 1 / norm
    return slopes, h


def _output_slopes(
    slopes: Weights, outputs: Outputs, v: Vocabulary, states: np.ndarray, target: np.ndarray, real: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sets the gradients of the output weights; returns those of the states in ``real`` and a row of zeros, and ``real`` in order.

    States have a one as their last unit. They go by their targets, and so by class. The error, probabilities less one for the target, is never written out: its
    first part is exponentials times the states divided by their sums, its second a sum of states of each target.
    """
    inputs = v.as_input[target[real]].astype(np.min_scalar_type(v.n_inputs))
    order = np.argsort(inputs, kind="stable")
    real, inputs = real[order], inputs[order]
    classes, used = v.token_class[target[real]], states.take(real, 0)
    scale = used.dtype.type(1 / len(real))
    n, starts = int(np.searchsorted(inputs, v.learned)), _starts(inputs)
    pulls, several = np.add.reduceat(used, starts, axis=0) * -scale, _starts(classes[starts])

    of_classes = np.zeros_like(outputs.classes)
    of_classes[classes[starts[several]]] = np.add.reduceat(pulls, several, axis=0)
    d_used = np.zeros((len(real) + 1, HIDDEN), used.dtype)
    for at in range(0, len(real), SLICE):
        part = slice(at, at + SLICE)
        raised = outputs.shifted(used[part] @ outputs.classes.T)
        np.exp(raised, out=raised)
        pushed = raised @ outputs.of_classes
        inverse = scale / pushed[:, -1:]
        of_classes += raised.T @ (used[part] * inverse)
        d_used[at : at + len(pushed)] = pushed[:, :-1] * inverse
    d_used[:-1] -= scale * outputs.classes.take(classes, 0)[:, :-1]
    slopes["c"][:], slopes["cb"][:] = of_classes[:, :-1].T, of_classes[:, -1]

    of_tokens = np.zeros_like(outputs.tokens)
    own = starts < n
    of_tokens[inputs[starts[own]]] = pulls[own]
    ends = np.searchsorted(classes[:n], np.arange(v.learned_classes + 1))
    parts = [(slice(ends[k], ends[k + 1]), slice(k * CLASS_SIZE, (k + 1) * CLASS_SIZE)) for k in np.flatnonzero(np.diff(ends))]
    raised, pushed = np.empty((n, CLASS_SIZE), used.dtype), np.empty((n, HIDDEN + 1), used.dtype)
    for part, of in parts:
        np.matmul(used[part], outputs.tokens[of].T, out=raised[part])
    np.exp(outputs.shifted(raised), out=raised)
    for part, of in parts:
        np.matmul(raised[part], outputs.of_tokens[of], out=pushed[part])
    inverse = scale / pushed[:, -1:]
    divided = used[:n] * inverse
    for part, of in parts:
        of_tokens[of] += raised[part].T @ divided[part]
    d_used[:n] += pushed[:, :-1] * inverse
    d_used[:n] -= scale * outputs.tokens.take(inputs[:n], 0)[:, :-1]
    slopes["w"][:], slopes["wb"][:] = of_tokens[:, :-1], of_tokens[:, -1]
    return d_used, real


def n_shards(v: Vocabulary) -> int:
    return max(1, -(-v.total // SHARD_TOKENS))


def n_rounds(v: Vocabulary) -> int:
    """Rounds take 1, 2, 4 ... shards; the last one what is left."""
    return n_shards(v).bit_length()


def _numbered(documents: DataFrame, v: Vocabulary) -> DataFrame:
    """``(ids, dealt, shard, round)`` of every text of the training fold, written by round.

    Ids are inputs, in as few bytes as hold them; ``dealt`` gives the order within a shard.
    """
    spark = documents.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(v)
    kind = np.min_scalar_type(v.n_inputs)
    schema = "ids binary, dealt long, shard long, round int"
    target = pa.schema([("ids", pa.binary()), ("dealt", pa.int64()), ("shard", pa.int64()), ("round", pa.int32())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = known.value
        for part in (part for batch in batches for part in _parts(batch)):
            found, n = part_words(part.column("text"))
            inputs = v.as_input[v.ids(found)].astype(kind)
            ends = np.append(0, np.cumsum(n)) * kind.itemsize
            ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(inputs)])
            yield pa.RecordBatch.from_arrays([ids, *part.columns[1:]], schema=target)

    dealt = F.xxhash64("doc_id")
    shard = F.pmod(dealt, F.lit(n_shards(v)).cast("long"))
    of_round = F.length(F.bin(shard + 1)) - 1
    texts = doc_texts(documents).where(_fold("doc_id") != 2)
    texts = texts.select("text", dealt.alias("dealt"), shard.alias("shard"), of_round.cast("int").alias("round"))
    folder = new_folder(spark, "lm-train")
    texts.mapInArrow(number, schema).write.partitionBy("round").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _flat(w: Weights) -> np.ndarray:
    return np.concatenate([value.reshape(-1) for value in w.values()]).astype(np.float64)


def _shaped(flat: np.ndarray, like: Weights) -> Weights:
    cuts = np.cumsum([value.size for value in like.values()])[:-1]
    parts = np.split(flat.astype(np.float32), cuts)
    return {name: part.reshape(value.shape) for part, (name, value) in zip(parts, like.items())}


_SUMS = pa.schema([("block", pa.int32()), ("tokens", pa.int64()), ("thousands", pa.int64()), ("sums", pa.binary())])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block, of the sums of its rows; a task holds the blocks it was dealt, however many rows they have."""
    totals: dict[int, list] = {}
    for batch in batches:
        for block, tokens, thousands, raw in zip(*(column.to_pylist() for column in batch.columns)):
            total = totals.setdefault(block, [0, 0, 0])
            total[0] += tokens
            total[1] += thousands
            total[2] = total[2] + np.frombuffer(raw, np.int64)
    for block, (tokens, thousands, sums) in totals.items():
        yield pa.RecordBatch.from_pydict({"block": [block], "tokens": [tokens], "thousands": [thousands], "sums": [sums.tobytes()]}, _SUMS)


def _averaged(numbered: DataFrame, v: Vocabulary, weights: Weights, at: int) -> tuple[Weights, int]:
    """The weights after a round, and the tokens learned from."""
    spark = numbered.sparkSession
    model = spark.sparkContext.broadcast((v, weights))
    kind = np.min_scalar_type(v.n_inputs)
    rate = RATE / math.sqrt(1 + at)

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = model.value
        start = _flat(w)
        sums, tokens, thousands = np.zeros(len(start), np.int64), 0, 0
        rows = (row for batch in batches for row in zip(batch.column("shard").to_pylist(), batch.column("ids")))
        for _, shard in groupby(rows, lambda row: row[0]):
            texts = (v.of_input[np.frombuffer(raw.as_buffer(), kind)] for _, raw in shard)
            trained, learned = train(w, v, texts, rate)
            share = -(-learned // 1024)
            change = np.clip(_flat(trained) - start, -MOST_CHANGE, MOST_CHANGE)
            sums += np.rint(change * UNIT).astype(np.int64) * share
            tokens, thousands = tokens + learned, thousands + share
        if tokens:
            for block, first in enumerate(range(0, len(sums), BLOCK)):
                raw = sums[first : first + BLOCK].tobytes()
                row = {"block": [block], "tokens": [tokens], "thousands": [thousands], "sums": [raw]}
                yield pa.RecordBatch.from_pydict(row, _SUMS)

    shards = min(1 << at, n_shards(v) + 1 - (1 << at))
    schema = "block int, tokens long, thousands long, sums binary"
    dealt = numbered.where(F.col("round") == at).repartition(min(shards, MOST_TASKS), "shard")
    dealt = dealt.sortWithinPartitions("shard", "dealt", "ids").select("shard", "ids")
    blocks = -(-sum(value.size for value in weights.values()) // BLOCK)
    sums = dealt.mapInArrow(one_task, schema).repartition(blocks, "block").mapInArrow(_add_up, schema)
    rows = sorted(written(sums, "lm-sums").collect(), key=lambda row: row["block"])
    model.unpersist()
    if not rows:
        return weights, 0
    change = np.concatenate([np.frombuffer(row["sums"], np.int64) for row in rows])
    return _shaped(_flat(weights) + change / (UNIT * rows[0]["thousands"]), weights), rows[0]["tokens"]


def fit(documents: DataFrame, v: Vocabulary) -> Weights:
    """Weights from all texts of the training fold, each taken once, in rounds of shards that are averaged.

    Rows of one id lie in one shard, so those of an id that holds much of the table are trained in sequence, in bounded memory.
    What reaches the driver is one model a round, however many shards there are.
    """
    weights = initial(v)
    if not v.total:
        return weights
    numbered = _numbered(documents, v)
    for at in range(n_rounds(v)):
        weights, _ = _averaged(numbered, v, weights, at)
    return weights


# Scoring of documents

_ROWS = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_rest long, "
    "rest array<struct<token: string, n: long>>"
)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PART_BYTES`` of text; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _listed(tokens: pa.Array, of: np.ndarray, rows: int) -> pa.Array:
    """The distinct tokens of every row with their counts, as a list a row."""
    coded = tokens.dictionary_encode()
    kinds = max(len(coded.dictionary), 1)
    pairs, n = np.unique(of * kinds + coded.indices.to_numpy(), return_counts=True)
    own, code = np.divmod(pairs, kinds)
    fields = [coded.dictionary.take(pa.array(code)).cast(pa.string()), pa.array(n, pa.int64())]
    starts = np.searchsorted(own, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays(fields, ["token", "n"]))


def _first_pass(documents: DataFrame, v: Vocabulary, weights: Weights) -> DataFrame:
    """All but the shares of the tokens that are not broadcast; those are listed."""
    spark = documents.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((v, weights))
    schema = spark.createDataFrame([], _ROWS).schema

    target = to_arrow_schema(schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = model.value
        row_id = TaskContext.get().partitionId() << 40
        for part in (part for batch in batches for part in _parts(batch)):
            found, n = part_words(part.column("text"))
            ends, flat = np.cumsum(n), v.ids(found)
            ids, further = np.split(flat, ends[:-1]), np.flatnonzero(flat == v.others)
            of = np.searchsorted(ends, further, "right")
            end = v.end
            unit = math.log10(v.total + v.distinct + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": range(row_id, row_id + len(n)),
                    "doc_id": part.column("doc_id"),
                    "held_out": part.column("held_out"),
                    "n_tokens": n + 1,
                    "n_known": [int(v.known[own].sum() + v.known[end]) for own in ids],
                    "base_score": [float(v.base[own].sum() + v.base[end] - (len(own) + 1) * unit) for own in ids],
                    "score": score(w, v, ids),
                    "n_rest": np.bincount(of, minlength=len(n)),
                    "rest": _listed(found.take(pa.array(further)), of, len(n)),
                },
                target,
            )
            row_id += len(n)

    texts = doc_texts(documents).withColumn("held_out", held_out())
    return texts.mapInArrow(scored, schema)


def score_documents(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: tokens, known ones, the unigram score and the model's, in log10.

    A null text is an empty one, and so only an end. Repeated rows are scored, and learned from, each time. If there is nothing
    to learn from, all tokens are unknown. Further columns are ignored; an empty table gives an empty one.
    """
    counts = written(token_counts(documents), "lm-counts")
    v = vocabulary(counts)
    first = written(_first_pass(documents, v, fit(documents, v)), "lm-first-pass")
    rest = first.select("row_id", F.explode("rest").alias("r")).select("row_id", "r.token", "r.n")
    seen = counts.withColumnRenamed("n", "seen")
    n = F.col("n")
    rest = (
        rest.join(seen, "token", "left")
        .withColumn("seen", F.coalesce("seen", F.lit(0)))
        .groupBy("row_id")
        .agg(
            F.sum(n * F.log10(F.col("seen") + 1)).alias("rest_log"),
            F.sum(F.when(F.col("seen") > 0, n).otherwise(0)).alias("rest_known"),
        )
    )
    rest_log, rest_known = F.coalesce("rest_log", F.lit(0.0)), F.coalesce("rest_known", F.lit(0))
    return (
        first.drop("rest")
        .join(rest, "row_id", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + rest_known).alias("n_known"),
            F.lit(v.total).cast("long").alias("train_tokens"),
            (F.col("base_score") + rest_log).alias("base_score"),
            (F.col("score") + rest_log - F.col("n_rest") * math.log10(v.rest_sum)).alias("score"),
        )
    )
