import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from conftest_llm import CLASHING, HARD, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from racestream.llm import periodic_runs as pr


def brute(words, least=12):
    """All runs by comparing the words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t < n - q:
            if words[t] != words[t + q]:
                t += 1
                continue
            start = t
            while t < n - q and words[t] == words[t + q]:
                t += 1
            if t - start + q >= max(least, 2 * q):
                found.setdefault((start, t - start + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_kept(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def search(*texts):
    """Runs of texts side by side, by text."""
    codes = {}
    ids = [codes.setdefault(w, len(codes)) for words in texts for w in words]
    bounds = np.cumsum([0, *map(len, texts)])
    found = pr.runs(ids, bounds)
    parts = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        mine = found[(found[:, 0] >= a) & (found[:, 0] < b)] - [a, 0, 0]
        parts.append(sorted((s, n, p) for s, n, p in mine.tolist()))
    return parts


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def planted(seed, n, alphabet=300):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, alphabet, n).tolist()
    for _ in range(4):
        a, p = int(rng.integers(0, n)), int(rng.integers(1, n // 3))
        for i in range(a + p, min(n, a + int(rng.integers(2, 5)) * p)):
            words[i] = words[i - p]
    return words


CASES = [
    "",
    "a",
    "a" * 11,
    "a" * 12,
    "a" * 700,
    "ab" * 6,
    "abcdef" * 2,
    "xabcdefabcdefy",
    "abcdefg" * 2,
    "ab" * 40 + "c" + "ab" * 40 + "c" + "ab" * 40,
    "a" * 50 + "b" + "a" * 50 + "c" + "a" * 50 + "d" + "a" * 50,
    fibonacci(900),
    "abcabcabdabcabcabd" * 9 + "abc",
]


@pytest.mark.parametrize("text", CASES)
def test_runs_equal_brute_force(text):
    assert search(text) == [brute(text)]


def test_texts_side_by_side_do_not_mix():
    texts = [*CASES, "a" * 30, "a" * 30, fibonacci(100), *[planted(i, 50 + 37 * i) for i in range(12)]]
    assert search(*texts) == [brute(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=90), min_size=1, max_size=4))
def test_runs_of_any_text_equal_brute_force(texts):
    assert search(*texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_every_period_is_found(seed):
    texts = [planted(100 * seed + q, 2 * q + q % 7 + 12 + seed, 10_000) for q in range(1, 70)]
    for q, text in enumerate(texts, 1):
        for i in range(q + seed, len(text) - q % 3):
            text[i] = text[i - q]
    assert search(*texts) == [brute(t) for t in texts]


def test_what_the_hash_says_is_compared(monkeypatch):
    """With a tiny modulus nearly every extension is wrong at first."""
    monkeypatch.setattr(pr, "HASH_MODULUS", 7)
    texts = [*CASES, *[planted(i, 60 + 11 * i) for i in range(10)]]
    assert search(*texts) == [brute(t) for t in texts]


def test_scales_beyond_the_longest_block(monkeypatch):
    monkeypatch.setattr(pr, "LONGEST", 4)
    monkeypatch.setattr(pr, "AT_ONCE", 64)
    texts = [*CASES, *[planted(i, 60 + 40 * i, 5) for i in range(10)]]
    assert search(*texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("size", [8, 64, 1 << 16])
def test_transforms_are_exact(size):
    rng = np.random.default_rng(size)
    a = rng.integers(0, pr.PRIME, (size, 3))
    a[:, 2] = pr.PRIME - 1
    back = pr.inverse_transform(pr._fold(pr._fold(pr.transform(a.copy()))) % pr.PRIME)
    assert ((back - a * size) % pr.PRIME == 0).all()


def test_convolution_counts_differences():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3, 400)
    squares = np.concatenate([[0], np.cumsum(values * values)])
    starts = np.arange(0, 300, 8)
    at, distance = pr.occurrences(values, squares, starts, 8, 15, 16)
    expected = {(s, d) for s in starts for d in range(15, 31) if ((values[s : s + 8] - values[s + d : s + d + 8]) ** 2).sum() % pr.PRIME == 0}
    assert set(zip(at.tolist(), distance.tolist())) == expected


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contract(doc_id, text):
    """The query's row, word for word."""
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    digest = lambda x: sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, exponent, digest(listed), digest(" ".join(brute_kept(words, runs))))


def test_digests_equal_the_contract(documents):
    odd = ["a b " * 40, "x " * 500, "é é " * 20, "a\x1cb " * 13, "a\u0085a " * 12, "\n".join(["one two three"] * 9)]
    hard = [row for row in HARD if len(row[1] or "") < 150_000]
    rows = [*hard, *[(100 + i, t) for i, t in enumerate(odd)], *[(1000 + i, prose(1 + 2 * i, i, 40)) for i in range(150)]]
    rows += [(2000 + i, t) for i, t in enumerate(odd) for _ in range(2)]
    docs = documents(rows, runs=3, words="w", start=1, period=2, collapsed="c", **CLASHING)
    got = sorted(map(tuple, pr.digests(pr.find(pr.repeated(docs))).collect()), key=str)
    assert got == sorted((contract(r[0], r[1]) for r in rows), key=str)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0]) > 5


def test_very_long_texts():
    n = 300_000
    assert search(["w"] * n) == [[(0, n, 1)]]
    half = planted(5, 150_000, 10**6)[:70_000]
    (found,) = search(half + half + half[:20])
    assert found[-1] == (0, 140_020, 70_000) or (0, 140_020, 70_000) in found


def test_empty_table(documents):
    assert pr.digests(pr.find(pr.repeated(documents([])))).count() == 0
