import re
from hashlib import sha256

import numpy as np
from conftest_llm import CLASHING, HARD, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from racestream.llm import fill_in_middle as fim


def brute(doc_id, text):
    """The contract, word for word."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["<P", "a<P>b", "<<S<M", "><P", "🙂🙂 a", "é" * 500 + "abc", "a" * 5000 + " " + "b " * 3000 + "c" * 5000, "<S>", "S> <", "\x00a"]


def test_outputs_equal_the_contract():
    texts = [t or "" for _, t, *_ in HARD] + ODD + [prose(50 + i % 90, i) for i in range(300)] + [prose(20_000, 7)]
    ids = list(range(len(texts) - 1)) + [None]
    for first in range(0, 40, 20):
        shifted = [i if i is None else i + first * 1000 for i in ids]
        got = fim.arrange(shifted, texts)
        assert list(zip(*got.values())) == [brute(i, t) for i, t in zip(shifted, texts)]
    assert set(got["form"]) == {"plain", "psm", "spm"}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab <>PSM\né🙂", max_size=40), min_size=1, max_size=8), st.integers(-(2**63), 2**63 - 1))
def test_outputs_equal_the_contract_on_any_text(texts, seed):
    ids = [seed] * len(texts)
    assert list(zip(*fim.arrange(ids, texts).values())) == [brute(i, t) for i, t in zip(ids, texts)]


def test_index_is_exact_and_within_its_bound():
    rng = np.random.default_rng(3)
    steps = rng.integers(1, 30, 20_000)
    steps[rng.integers(0, 20_000, 40)] = 50_000
    offsets = np.cumsum(steps)
    for bound in (0, 3, 127):
        index = fim.fit(offsets, np.array([0, 5000, 5001, 12_000]), bound)
        ranks = np.arange(len(offsets))
        assert (index.offset(ranks) == offsets).all()
        assert np.abs(offsets - index.predicted(ranks)).max() <= bound
        assert {0, 5000, 5001, 12_000} <= set(index.ranks.tolist())
    assert len(index.ranks) < len(offsets) / 20


def test_texts_larger_than_a_portion_are_cut_alike(monkeypatch):
    texts = [prose(30 + i, i) for i in range(50)]
    whole = fim.arrange(list(range(50)), texts)
    monkeypatch.setattr(fim, "TOGETHER", 500)
    assert fim.arrange(list(range(50)), texts) == whole


def test_hard_rows_and_restoring(documents):
    rows = [*HARD, *[(100 + i, text) for i, text in enumerate(ODD[:-1])], *[(200 + i, prose(30 + i, i)) for i in range(60)]]
    docs = documents(rows, n=4, form="x", output="y", prefix_chars=1, **CLASHING)
    got = sorted(map(tuple, fim.digests(fim.transform(docs)).collect()), key=str)
    expected = []
    for doc_id, text, *_ in rows:
        n, form, prefix, middle, output = brute(doc_id, text)
        expected.append((doc_id, n, form, prefix, middle, sha256(output.encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_empty_table(documents):
    assert fim.transform(documents([])).count() == 0
