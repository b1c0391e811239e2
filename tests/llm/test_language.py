import math
from collections import Counter

import numpy as np

from conftest_llm import CLASHING, HARD
from racestream.llm import language


def grams(text):
    raw = np.frombuffer(b"   " + text.lower(), np.uint8).astype(np.int64)
    return np.unique(raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:], return_counts=True)


def bits_by_definition(train, text, kept):
    """Walks the text byte by byte: the longest context that the tree has, escapes to shorter ones."""
    counts = Counter()
    padded = b"   " + train.lower()
    for i in range(3, len(padded)):
        for order in range(4):
            counts[padded[i - order : i + 1]] += 1
    following = {}
    for key, n in counts.items():
        following.setdefault(key[:-1], {})[key[-1]] = n
    total, padded = 0.0, b"   " + text.lower()
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            context = padded[i - order : i]
            seen = following.get(context)
            if not seen or (order == 3 and context not in kept):
                continue
            n, d = sum(seen.values()), len(seen)
            if padded[i] in seen:
                total -= math.log2(seen[padded[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_equal_the_definition():
    train = {"a": b"The cat sat on the mat, the cat ran. " * 3, "b": "der Hund läuft über die Straße, der Hund".encode() * 2}
    trees = language.grow({k: grams(v) for k, v in train.items()})
    often = Counter()
    for v in train.values():
        padded = b"   " + v.lower()
        often.update(padded[i - 3 : i] for i in range(3, len(padded)))
    kept = {c for c, n in often.items() if n >= language.LEAST_SEEN}
    texts = [b"The dog sat", "über 12 Straßen!".encode(), b"", b"q", b"\xff\xfe zzz", b"the cat " * 50]
    bits = trees.bits(texts)
    for i, text in enumerate(texts):
        for j, name in enumerate(trees.languages):
            assert math.isclose(bits[i, j], bits_by_definition(train[name], text, kept), rel_tol=1e-4, abs_tol=1e-3)


def test_blocks_do_not_matter(monkeypatch):
    trees = language.grow({"a": grams(b"some text to learn from " * 9), "b": grams(b"anderer text zum lernen " * 9)})
    text = b"some longer text, anderer text " * 40
    whole = trees.bits([text, b"", text[:77]])
    monkeypatch.setattr(language, "BLOCK", 50)
    assert np.allclose(whole, trees.bits([text, b"", text[:77]]))


def test_trees_hold_what_was_seen_only():
    """Forty languages of all bytes: the size follows the learned sequences, not contexts by symbols by languages."""
    random_ = np.random.default_rng(2)
    learned = {f"l{j}": grams(random_.integers(0, 256, 3_000, np.uint8).tobytes()) for j in range(40)}
    trees = language.grow(learned)
    held = sum(len(array) for orders in trees.orders for order in orders for array in vars(order).values())
    assert held <= 16 * sum(len(g) for g, _ in learned.values())
    assert np.isfinite(trees.bits([b"any text", bytes(range(256))])).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_hard_rows_and_extra_columns(documents):
    rows = language.predict(documents(HARD, **CLASHING)).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "und")


def test_nothing_to_learn_from(documents):
    assert language.predict(documents([])).count() == 0
    rows = language.predict(documents([(1, "text", None, "s")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
