from collections import Counter

import pytest

from conftest_llm import CLASHING, HARD
from racestream.llm import queries, sharding

NAMES = [f"s{i}" for i in range(10)]


def brute(shards, slots):
    """Every shard's whole order of preference, and the turns one by one."""
    orders = {}
    for shard in shards:
        start, stride = sharding._preference(shard, slots)
        orders[shard] = iter([(start + j * stride) % slots for j in range(slots)])
    taken = {}
    while len(taken) < slots:
        for shard in sorted(shards):
            if len(taken) < slots:
                slot = next(s for s in orders[shard] if s not in taken)
                taken[slot] = shards.index(shard)
    return [taken[s] for s in range(slots)]


@pytest.mark.parametrize(("n", "slots"), [(1, 7), (3, 101), (10, 499), (7, 7)])
def test_table_equals_brute_force(n, slots):
    shards = [f"s{i}" for i in range(n)]
    assert sharding.lookup_table(shards, slots) == brute(shards, slots)


def test_even_and_stable():
    before, after = sharding.lookup_table(NAMES), sharding.lookup_table([*NAMES, "s10"])
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after))
    assert moved < 2 * len(before) / 11


def test_wrong_tables_are_refused():
    for shards, slots in ((NAMES, 100), ([], 101), (["a", "a"], 101), (NAMES, 7), (NAMES, 1_000_033)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_rows(documents):
    placed = sharding.place(documents(HARD, slot=1, shard="x", **CLASHING), "doc_id", NAMES)
    rows = placed.collect()
    assert len(rows) == len(HARD)
    table = sharding.lookup_table(NAMES)
    assert all(r["shard"] == NAMES[table[r["slot"]]] for r in rows)
    fours = {r["shard"] for r in rows if r["doc_id"] == 4}
    assert len(fours) == 1
    assert len({r["slot"] for r in rows if r["doc_id"] is None}) == 2
    assert sharding.place(documents([]), "doc_id", NAMES).count() == 0


def test_written_shards(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(200)])
    sharding.write_shards(docs, "doc_id", NAMES, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200
    placed = {r["doc_id"]: r["shard"] for r in sharding.place(docs, "doc_id", NAMES).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == placed


def test_no_python_in_the_plan(documents):
    plan = sharding.place(documents([(1, "a")]), "doc_id", NAMES)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_rows_without_id_of_the_registered_query_do_not_share_a_slot(spark, documents, tmp_path):
    documents([*[(None, f"text {i}") for i in range(200)], (7, "a"), (7, "b")]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op7_lookup_sharding(spark, str(tmp_path)).collect()
    assert len(rows) == 202 and rows[0].asDict().keys() == {"doc_id", "slot", "shard"}
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) > 50
    assert len({r["slot"] for r in rows if r["doc_id"] == 7}) == 1
