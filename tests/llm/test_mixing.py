from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest_llm import CLASHING, HARD, prose
from racestream.llm import mixing


def raked(cells, targets, rounds=300):
    """Plain iterative proportional fitting."""
    weights = {cell: float(n) for cell, n in cells.items()}
    total = sum(cells.values())
    for _ in range(rounds):
        for k, target in enumerate(targets):
            sums = defaultdict(float)
            for cell, w in weights.items():
                sums[cell[k]] += w
            whole = sum(target.get(v, 0) for v in sums)
            weights = {c: w * target.get(c[k], 0) / whole * total / sums[c[k]] if sums[c[k]] else 0.0 for c, w in weights.items()}
    return weights


def raked_within(cells, temper, most, rounds=400):
    """Plain fitting to tempered shares where no weight exceeds ``most`` times its cell; goals are lowered to what can be held."""
    total = sum(cells.values())
    goals = []
    for k in range(3):
        held = defaultdict(float)
        for cell, n in cells.items():
            held[cell[k]] += n
        whole = sum(n**temper for n in held.values())
        goal = {v: total * n**temper / whole for v, n in held.items()}
        full = set()
        while True:
            scale = (total - sum(most * held[v] for v in full)) / sum(g for v, g in goal.items() if v not in full)
            more = {v for v in goal if v not in full and scale * goal[v] >= most * held[v]}
            if not more:
                break
            full |= more
        goals.append({v: most * held[v] if v in full else scale * g for v, g in goal.items()})
    factor = dict.fromkeys(cells, 1.0)
    for _ in range(rounds):
        for k, goal in enumerate(goals):
            sums = defaultdict(float)
            for cell, n in cells.items():
                sums[cell[k]] += n * min(factor[cell], most)
            for cell in cells:
                factor[cell] *= goal[cell[k]] / sums[cell[k]]
    return {cell: n * min(factor[cell], most) for cell, n in cells.items()}


@pytest.mark.parametrize("few", [mixing.FEW_CELLS, 0])
def test_raking_equals_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW_CELLS", few)
    cells = {(f"s{i}", "ab"[j], "xyz"[k]): 10 + 7 * i + 31 * j + 13 * k * i for i in range(5) for j in range(2) for k in range(3) if (i, j) != (2, 1)}
    targets = [{f"s{i}": 1 + i for i in range(5)}, {"a": 0.3, "b": 0.7}, {"x": 0.2, "y": 0.5, "z": 0.3, "never": 9.0}]
    frame = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    frames = {m: spark.createDataFrame([(v, float(s)) for v, s in t.items()], "value string, share double") for m, t in zip(mixing.MARGINS, targets)}
    found = {(r["source"], r["lang"], r["topic"]): r["weighted"] for r in mixing.rake(frame, frames).collect()}
    expected = raked(cells, targets)
    assert found.keys() == expected.keys()
    for cell, w in expected.items():
        assert found[cell] == pytest.approx(w, rel=0.01)


def test_targets_that_contradict_leave_a_residual(spark):
    """Source a occurs in one language only, so the language cannot have less than the source."""
    frame = spark.createDataFrame([("a", "x", "t", 10), ("b", "x", "t", 5), ("b", "y", "t", 5)], "source string, lang string, topic string, tokens long")
    shares = [{"a": 0.8, "b": 0.2}, {"x": 0.5, "y": 0.5}, {"t": 1.0}]
    frames = {m: spark.createDataFrame(list(t.items()), "value string, share double") for m, t in zip(mixing.MARGINS, shares)}
    rows = mixing.rake(frame, frames).collect()
    assert max(r["residual"] for r in rows) > 10 * mixing.TOLERANCE
    by_lang = {v: sum(r["weighted"] for r in rows if r["lang"] == v) for v in "xy"}
    assert by_lang == pytest.approx({"x": 10.0, "y": 10.0})


def test_sampled_tokens_meet_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.sample(docs)
    rows = rows.select(*mixing.MARGINS, (F.col("n_tokens") * F.col("copies")).alias("tokens")).collect()
    featured = docs.select(mixing._features().alias("m")).select("m.*")
    sums = defaultdict(lambda: defaultdict(float))
    for r in featured.groupBy(*mixing.MARGINS).agg(F.sum("n_tokens").alias("n")).collect():
        for m in mixing.MARGINS:
            sums[m][r[m]] += r["n"]
    total = sum(sums["lang"].values())
    assert sum(r["tokens"] for r in rows) == pytest.approx(total * mixing.BUDGET, rel=0.05)
    for m in mixing.MARGINS:
        tempered = {v: n**mixing.TEMPER for v, n in sums[m].items()}
        for v, t in tempered.items():
            got = sum(r["tokens"] for r in rows if r[m] == v)
            assert got == pytest.approx(total * mixing.BUDGET * t / sum(tempered.values()), rel=0.15, abs=0.002 * total)


def test_draws_have_the_expected_copies(spark):
    drawn = spark.range(20_000).select(mixing._drawn(F.lit(1.3), F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("n"))
    assert set(r["n"] for r in drawn.distinct().collect()) == {1, 2}
    assert drawn.agg(F.avg("n")).first()[0] == pytest.approx(1.3, abs=0.02)


def test_hard_rows_and_extra_columns(documents):
    docs = documents(HARD, topic="mine", **CLASHING)
    rows = mixing.sample(docs, budget=1.0).collect()
    assert all(r["copies"] >= 1 and r["n_tokens"] >= 1 for r in rows)
    assert {r["source"] for r in rows} <= {"host", mixing.MISSING}
    thinned = mixing.thin(docs, budget=50.0)
    assert thinned.columns == docs.columns
    assert sorted(map(str, thinned.collect())) == sorted(map(str, docs.collect()))


def test_thinning_keeps_what_is_sampled(documents):
    docs = documents([(i, prose(20 + i % 50, i), "en" if i % 3 else "de", f"h{i % 4}") for i in range(300)])
    assert {r["doc_id"] for r in mixing.thin(docs).collect()} == {r["doc_id"] for r in mixing.sample(docs).collect()}


def test_empty_table(documents):
    assert mixing.sample(documents([])).count() == 0
    assert mixing.thin(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    docs = documents([(1, "a"), (2, "b c")])
    for frame in (mixing.sample(docs), mixing.thin(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_thinning_spends_the_budget_and_meets_what_can_be_met(spark):
    """Cells that would need more than one copy are kept whole, and the others make up for them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = docs.select(mixing._features().alias("m")).select("m.*")
    cells = [(tuple(r[m] for m in mixing.MARGINS), r["n"]) for r in rows.groupBy(*mixing.MARGINS).agg(F.sum("n_tokens").alias("n")).collect()]
    total = sum(n for _, n in cells)
    rate = {tuple(r[m] for m in mixing.MARGINS): r["expected"] for r in mixing.rates(rows, None, mixing.BUDGET, once=True).collect()}
    assert max(rate.values()) <= 1 and sum(e == 1 for e in rate.values()) > 0
    assert sum(n * rate[c] for c, n in cells) == pytest.approx(total * mixing.BUDGET, rel=0.005)
    residuals = {}
    for k, margin in enumerate(mixing.MARGINS):
        held, got = defaultdict(int), defaultdict(float)
        for c, n in cells:
            held[c[k]] += n
            got[c[k]] += n * rate[c]
        whole = sum(n**mixing.TEMPER for n in held.values())
        goal = {x: total * mixing.BUDGET * n**mixing.TEMPER / whole for x, n in held.items()}
        scale = 1.0
        for _ in range(100):
            kept = sum(held[x] for x in goal if scale * goal[x] >= held[x])
            scale = (total * mixing.BUDGET - kept) / sum(goal[x] for x in goal if scale * goal[x] < held[x])
        residuals[margin] = max(abs(got[x] / min(held[x], scale * goal[x]) - 1) for x in goal)
        print(margin, "residual", residuals[margin], "least share of the plain target", min(got[x] / goal[x] for x in goal))
    assert max(residuals.values()) < 0.01
    words = mixing.thin(docs).select(F.sum(F.greatest(mixing.n_words(F.col("text")), F.lit(1)))).first()[0]
    print("tokens drawn, of the budget", words / (total * mixing.BUDGET))
    assert words == pytest.approx(total * mixing.BUDGET, rel=0.05)
