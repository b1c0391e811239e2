import math

import numpy as np
import pytest
from small_graph import components_of

from racestream.llm import polytope

SCHEMA = "vec_id long, embedding array<float>, label int"


def near(x, cosine, random):
    z = random.normal(size=x.shape)
    z -= (z @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def vectors():
    random = np.random.default_rng(5)
    rows = []
    for label in range(3):
        for _ in range(40):
            x = random.normal(size=64)
            rows.append((x, label))
            for cosine in random.uniform(0.9, 0.999, random.integers(0, 5)):
                rows.append((near(x, cosine, random) * random.uniform(0.1, 9), label))
        x = random.normal(size=64)
        rows += [(near(x, 0.97, random), label) for _ in range(700 if label == 0 else 60)]
        rows += [(x, label)] * 30
        rows += [(random.normal(size=16), label) for _ in range(5)]
    ids = random.permutation(len(rows))
    out = [(int(i), [float(np.float32(v)) for v in x], label) for i, (x, label) in zip(ids, rows)]
    n = len(out)
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [None] + [1.0] * 63]
    out += [(n + k, x, 0) for k, x in enumerate(odd)]
    out += [(n + 10, out[0][1], None), (n + 11, out[0][1], None), (None, out[0][1], 0), (out[0][0], out[0][1], out[0][2])]
    return out


def brute(rows, least):
    good = [i for i, (v, x, label) in enumerate(rows) if v is not None and label is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    links = []
    for size in {len(rows[i][1]) for i in good}:
        for label in {rows[i][2] for i in good}:
            mine = [i for i in good if len(rows[i][1]) == size and rows[i][2] == label]
            x = np.array([rows[i][1] for i in mine], np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
            links += [(mine[i], mine[j]) for i, j in zip(a, b)]
    counts = np.bincount(np.array(links).reshape(-1), minlength=len(rows))
    label = components_of([r[0] for r in rows], links)
    return sorted((str(r[0]), int(n), str(c), r[0] is None or r[0] == c) for r, n, c in zip(rows, counts, label))


@pytest.mark.parametrize(("block", "few"), [(512, polytope.FEW), (100, polytope.FEW), (512, 300)])
def test_links_equal_brute_force(spark, monkeypatch, block, few):
    """With ``few`` classes, one label has keys of more hashes than the others."""
    monkeypatch.setattr(polytope, "BLOCK", block)
    monkeypatch.setattr(polytope, "FEW", few)
    rows = vectors()
    found = polytope.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in found) == brute(rows, 0.93)


def test_extra_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], 0, 5, 6, "k"), (2, [2.0, 4.1], 0, 5, 6, "k")], SCHEMA + ", rep long, component long, vector string")
    rows = {r["vec_id"]: r for r in polytope.near_duplicates(frame).collect()}
    assert rows[2]["component_id"] == 1 and rows[1]["n_links"] == 1 and not rows[2]["kept"]
    assert polytope.near_duplicates(frame.limit(0)).count() == 0


def test_transform_is_hadamards():
    x = np.random.default_rng(1).normal(size=(3, 8))
    matrix = np.array([[1.0]])
    for _ in range(3):
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    assert np.allclose(polytope.hadamard(x), x @ matrix)


def test_hashes_follow_the_classes_of_a_label(spark, monkeypatch):
    monkeypatch.setattr(polytope, "FEW", 4)
    monkeypatch.setattr(polytope, "CLASSES_A_HASH", 10)
    sizes = {"a": 4, "b": 5, "c": 40, "d": 41, "e": 401}
    rows = [(i, 1, label) for label, n in sizes.items() for i in range(n)]
    found = polytope._with_hashes(spark.createDataFrame(rows, "rep long, copies long, label string"))
    assert found.count() == len(rows)
    assert {r["label"]: r["hashes"] for r in found.collect()} == {"a": 3, "b": 4, "c": 4, "d": 5, "e": 6}


@pytest.mark.parametrize("hashes", [3, 4, 5])
def test_recall_at_the_threshold(hashes):
    random = np.random.default_rng(9)
    x = random.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([near(v, 0.93, random) for v in x])
    own, others = polytope.axes(x, hashes), polytope.axes(y, hashes)
    assert own[0].shape == (5000, polytope.n_tables(hashes), hashes)
    assert polytope._meet(*own, *others).any(1).mean() >= 0.999
    # Of pairs that are not alike, a table brings fewer together with every hash.
    assert polytope._meet(*own, *(np.roll(a, 1, 0) for a in others)).mean() < 10.0 ** (1 - 2 * (hashes - 1))
