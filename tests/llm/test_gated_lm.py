import math
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from conftest_llm import CLASHING, HARD, prose
from racestream.llm import gated_lm as lm


def small_vocabulary(n=60):
    tokens = [b"\n", *(f"w{i}".encode() for i in range(n))]
    counts = np.arange(n + 1, 0, -1, dtype=np.int64) * 3
    return lm.Vocabulary(tokens, counts, int(counts.sum()) + 7, n + 3)


def step_by_step(w, v, ids):
    """The likelihood of one text, token by token, in plain formulas."""
    sigmoid = lambda a: 1 / (1 + np.exp(-a))
    h = np.zeros(lm.HIDDEN)
    k = lm.HIDDEN
    end = v.rank[b"\n"]
    total, token = 0.0, end
    for target in [*ids, end]:
        g, a = w["x"][v.as_input[token]] + w["b"], h @ w["u"]
        z, r = sigmoid(g[:k] + a[:k]), sigmoid(g[k : 2 * k] + a[k : 2 * k])
        h = (1 - z) * np.tanh(g[2 * k :] + r * a[2 * k :]) + z * h
        logits = h @ w["c"] + w["cb"]
        c = v.token_class[target]
        total += math.log10(np.exp(logits[c]) / np.exp(logits).sum())
        if c < v.learned_classes:
            of = range(c * lm.CLASS_SIZE, (c + 1) * lm.CLASS_SIZE)
            inside = np.array([h @ w["w"][i] + w["wb"][i] for i in of], np.float64)
            total += math.log10(np.exp(inside[target - of[0]]) / np.exp(inside).sum())
        elif target < v.others:
            total += v.inside[target]
        token = target
    return total


def test_scores_equal_the_formulas_whatever_the_lanes():
    v, random = small_vocabulary(), np.random.default_rng(2)
    w = {name: value + random.normal(size=value.shape).astype(np.float32) * 0.3 for name, value in lm.initial(v).items()}
    texts = [random.integers(0, v.others + 1, n).astype(np.int32) for n in (0, 1, 5, 400, 33, 2)]
    expected = [step_by_step({k: x.astype(np.float64) for k, x in w.items()}, v, t) for t in texts]
    for lanes in (1, 2, 6):
        assert np.allclose(lm.score(w, v, texts, lanes), expected, rtol=1e-4)


def test_gradients_equal_differences():
    v, random = small_vocabulary(40), np.random.default_rng(3)
    w = {name: value.astype(np.float64) for name, value in lm.initial(v).items()}
    texts = [random.integers(0, 40, n).astype(np.int32) for n in (4, 7, 2)]
    laid = lm.Lanes(texts, 2, 0)
    n, h = (laid.y >= 0).sum(), np.zeros((lm.HIDDEN, 2))

    def loss(w):
        return -sum(step_by_step(w, v, text) for text in texts) * math.log(10) / n

    slopes, _ = lm._window(w, v, h, v.as_input[laid.x], laid.y, laid.first)
    for name in w:
        flat, step = w[name].reshape(-1), 1e-4
        values = slopes[name].reshape(-1)
        chosen = np.argsort(-np.abs(values))[:4]
        measured = []
        for i in chosen:
            old = flat[i]
            flat[i] = old + step
            up = loss(w)
            flat[i] = old - step
            measured.append((up - loss(w)) / (2 * step))
            flat[i] = old
        assert np.allclose(np.array(measured) / np.linalg.norm(measured), values[chosen] / np.linalg.norm(values[chosen]), atol=0.02), name


def test_probabilities_sum_to_one():
    v = small_vocabulary(2000)
    w = lm.initial(v)
    h = np.random.default_rng(4).normal(size=(1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(v.others + 1)
    shares = 10 ** lm.log10_shares(w, v, np.repeat(h, len(every), 0), every.astype(np.int32))
    assert shares.sum() == pytest.approx(1, abs=1e-4)


def words(text):
    return [w for w in (text or "").encode().lower().split()]


def brute(rows):
    """The base of the contract, over rows of (doc_id, text)."""
    from zlib import crc32

    held = [doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2 for doc_id, _ in rows]
    counts = Counter()
    for (doc_id, text), out in zip(rows, held):
        if not out and doc_id is not None:
            counts.update([*words(text), b"\n"])
    n, v = sum(counts.values()), len(counts)
    for (doc_id, text), out in zip(rows, held):
        tokens = [*words(text), b"\n"]
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        yield (str(doc_id), out, len(tokens), sum(counts[t] > 0 for t in tokens), n), score


@pytest.mark.parametrize("frequent", [200_000, 50])
def test_base_equals_brute_force(documents, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(r[0], r[1]) for r in HARD] + [(100 + i, prose(10 + i, i)) for i in range(60)]
    found = lm.score_documents(documents(rows, **CLASHING)).collect()
    got = sorted(((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]), r["base_score"]) for r in found)
    expected = sorted(brute(rows))
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert np.allclose([g[1] for g in got], [e[1] for e in expected])
    assert all(r["score"] < 0 for r in found)


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score_documents(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_empty_table(documents):
    assert lm.score_documents(documents([])).count() == 0


def test_memory_of_lanes_follows_tokens_not_the_longest_text():
    v, random = small_vocabulary(), np.random.default_rng(5)
    w = lm.initial(v)
    texts = [random.integers(0, v.others + 1, n).astype(np.int32) for n in (*[3] * 383, 20_000)]
    tracemalloc.start()
    found = lm.score(w, v, texts)
    lm.train(w, v, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # all steps of all lanes are 130 MB
    assert np.allclose(found[[0, 383]], lm.score(w, v, [texts[0], texts[383]], 1), rtol=1e-4)


def test_parts_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(lm, "PART_BYTES", 10)
    texts = ["", "a" * 4, "b" * 6, "c" * 30, "d", "", "e" * 10]
    parts = [part.to_pydict()["text"] for part in lm._parts(lm.pa.RecordBatch.from_pydict({"text": texts}))]
    assert parts == [["", "a" * 4, "b" * 6], ["c" * 30], ["d", ""], ["e" * 10]]


def test_all_texts_of_the_fold_are_learned_from(spark, documents, monkeypatch):
    rows = [(i, prose(3 + i % 9, i)) for i in range(6_000)]
    docs = documents([*rows, (None, "no id")], **CLASHING).repartition(3)
    learned = [(str(i), t) for i, t in rows if crc32(str(i).encode()) % 7 != 2]
    expected = sum(len(t.split()) + 1 for _, t in learned)
    v = lm.vocabulary(lm.token_counts(docs))
    assert v.total == expected
    for shard_tokens in (1 << 40, 5_000):
        monkeypatch.setattr(lm, "SHARD_TOKENS", shard_tokens)
        numbered = lm._numbered(docs, v)
        rows = numbered.collect()
        kind = np.min_scalar_type(v.n_inputs)
        found = sorted(np.frombuffer(r["ids"], kind).tolist() for r in rows)
        assert found == sorted(v.as_input[v.ids(lm.words(t))].tolist() for _, t in learned)
        assert {r["shard"] for r in rows} == set(range(-(-v.total // shard_tokens)))
        assert all(r["round"] == (r["shard"] + 1).bit_length() - 1 for r in rows)
        assert {r["round"] for r in rows} == set(range(lm.n_rounds(v)))
        weights = lm.initial(v)
        assert sum(lm._averaged(numbered, v, weights, at)[1] for at in range(lm.n_rounds(v))) == expected


def test_average_equals_that_of_the_shards(spark, documents, monkeypatch):
    """A round is what ``train`` gives for each of its shards, averaged by thousands of tokens."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", 9_000)
    monkeypatch.setattr(lm, "BLOCK", 1_000)
    docs = documents([(i, prose(5 + i % 40, i)) for i in range(3_000)])
    v = lm.vocabulary(lm.token_counts(docs))
    numbered, weights = lm._numbered(docs, v), lm.initial(v)
    kind, at = np.min_scalar_type(v.n_inputs), 1
    shards: dict = {}
    for row in sorted(numbered.where("round = 1").collect(), key=lambda r: (r["dealt"], r["ids"])):
        shards.setdefault(row["shard"], []).append(v.of_input[np.frombuffer(row["ids"], kind)])
    assert len(shards) == 2
    whole, expected = 0, 0.0
    for texts in shards.values():
        trained, tokens = lm.train(weights, v, texts, lm.RATE / math.sqrt(1 + at))
        share = -(-tokens // 1024)
        whole, expected = whole + share, expected + lm._flat(trained) * share
    found, _ = lm._averaged(numbered, v, weights, at)
    assert np.allclose(lm._flat(found), expected / whole, atol=3e-6)


def test_scores_follow_from_the_documents_not_from_their_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 60_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = []
    for layout in (docs.coalesce(1), docs.repartition(16)):
        found.append({r["doc_id"]: r["score"] for r in lm.score_documents(layout).collect()})
    assert found[0].keys() == found[1].keys()
    ids = list(found[0])
    assert np.allclose([found[0][i] for i in ids], [found[1][i] for i in ids], rtol=1e-5)


def test_gain_grows_with_the_shards_of_a_corpus(spark, monkeypatch):
    """With eight times the documents there are eight times the shards, and a held-out token gains no less over the base."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", 1 << 17)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    gains = []
    for n in (500, 4_000):
        rows = [r for r in lm.score_documents(docs.where(docs.doc_id < n)).collect() if r["held_out"]]
        gains.append(sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows))
    assert gains[1] > gains[0] > 0


def test_learned_tokens_follow_the_coverage():
    for n in (500, 4_000, 40_000):
        counts = np.full(n, 9, np.int64)
        v = lm.Vocabulary([b"\n", *(f"w{i}".encode() for i in range(n - 1))], counts, int(counts.sum()), n)
        assert v.learned % lm.CLASS_SIZE == 0
        assert v.learned >= max(lm.LEAST_LEARNED, lm.COVERAGE * n)
        assert len(lm.initial(v)["w"]) == v.learned
        assert (v.as_input[v.of_input[v.as_input]] == v.as_input).all()


def test_long_texts_left_over_take_few_windows(monkeypatch):
    """The cost of a shard follows its tokens, not the steps of its longest text."""
    v, random = small_vocabulary(), np.random.default_rng(6)
    w = lm.initial(v)
    texts = [random.integers(0, v.others + 1, n).astype(np.int32) for n in (*[3] * 383, 20_000)]
    windows = {"train": 0, "score": 0}

    def counted(kind, function):
        def call(*args):
            windows[kind] += 1
            return function(*args)

        return call

    monkeypatch.setattr(lm, "_window", counted("train", lm._window))
    _, tokens = lm.train(w, v, texts)
    assert tokens == sum(len(text) + 1 for text in texts)
    monkeypatch.setattr(lm, "log10_shares", counted("score", lm.log10_shares))
    lm.score(w, v, texts)
    assert windows["train"] <= tokens / lm.STEP_TOKENS + 2
    assert windows["score"] <= tokens / (lm.LANES * lm.WINDOW) + 2


@pytest.mark.parametrize("steepness", [1, 300])
def test_shares_and_gradients_of_steep_weights(steepness):
    """Against plain formulas in double precision, where exponentials of the logits themselves would overflow."""
    v, random = small_vocabulary(200), np.random.default_rng(8)
    w = {name: value * np.float32(steepness if name in ("c", "w") else 1) for name, value in lm.initial(v).items()}
    h = random.uniform(-1, 1, (50, lm.HIDDEN)).astype(np.float32)
    target = random.integers(0, v.others, 50).astype(np.int32)
    classes = v.token_class[target]
    logits = h.astype(np.float64) @ w["c"] + w["cb"]
    expected = logits[np.arange(50), classes] - logits.max(1) - np.log(np.exp(logits - logits.max(1, keepdims=True)).sum(1))
    errors = np.exp(logits - logits.max(1, keepdims=True))
    errors /= errors.sum(1, keepdims=True)
    errors[np.arange(50), classes] -= 1
    for i in np.flatnonzero(classes < v.learned_classes):
        of = slice(classes[i] * lm.CLASS_SIZE, (classes[i] + 1) * lm.CLASS_SIZE)
        inside = w["w"][of].astype(np.float64) @ h[i] + w["wb"][of]
        expected[i] += inside[target[i] - of.start] - inside.max() - np.log(np.exp(inside - inside.max()).sum())
    found = lm.log10_shares(w, v, h, target)
    assert np.isfinite(found).all()
    assert np.allclose(found, expected / math.log(10) + v.inside[target], rtol=1e-3, atol=1e-4)
    slopes = {name: np.zeros_like(value) for name, value in w.items()}
    lm._output_slopes(slopes, lm.Outputs(w, v), v, lm._with_ones(h), target, np.arange(50))
    assert np.allclose(slopes["c"], h.T @ errors / 50, rtol=1e-3, atol=1e-5)
    assert np.allclose(slopes["cb"], errors.mean(0), rtol=1e-3, atol=1e-5)


def test_words_of_a_part_equal_those_of_each_text():
    odd = ["", " \t\n ", " a", "a ", "A\x0bB\x0cc\x1cd e\x85f\xa0g", "é Ü\r\nĀ\n\n", "x" * 5_000, *(r[1] for r in HARD if r[1])]
    for part in (odd, odd[:2], odd[:1], []):
        found, n = lm.part_words(lm.pa.array(["left out", *part], lm.pa.string()).slice(1))
        assert n.tolist() == [len(lm.words(text)) for text in part]
        assert found.to_pylist() == [word for text in part for word in lm.words(text)]


def test_rare_tokens_are_listed_by_row():
    tokens, of = [b"b", b"a", b"b", "é".encode(), b"a"], np.array([0, 0, 0, 2, 2])
    listed = lm._listed(lm.pa.array(tokens, lm.pa.binary()), of, 4).to_pylist()
    found = [{pair["token"]: pair["n"] for pair in row} for row in listed]
    assert found == [{"b": 2, "a": 1}, {}, {"é": 1, "a": 1}, {}]
    assert lm._listed(lm.pa.array([], lm.pa.binary()), np.array([], np.int64), 2).to_pylist() == [[], []]
