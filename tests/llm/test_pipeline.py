import corpus_pipeline
import __spark_entry__ as contract
from conftest_llm import CLASHING, HARD, prose
from racestream.llm import host_quality
from test_minhash import brute as near

OPERATORS = range(1, 14)


def test_every_operator_is_registered():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(OPERATORS)
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_duplicates",
        "personal_data",
        "target_mixture",
        "packing",
    ]


def test_stages_hand_on_documents(spark, documents):
    texts = [(20 + i, prose(80 + i, i % 40) + (" mail ann@site.org" if i % 5 == 0 else ""), "en", f"h{i % 3}") for i in range(120)]
    docs = documents([*HARD, *texts, (500, " ".join(["$$$ word"] * 80))], **CLASHING)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, "")
    expected = [r for r in docs.collect() if all_rules(r["text"])]
    assert sorted(map(str, good.collect())) == sorted(map(str, expected))
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    one = stages["near_duplicates"](spark, good, "")
    ids = [r["doc_id"] for r in one.collect()]
    assert sorted(ids) == sorted({r[0] for r in near(rows, 5, 80) if r[3]})
    masked = stages["personal_data"](spark, one, "")
    assert masked.where("text LIKE '%ann@site.org%'").count() == 0
    assert sorted(r["doc_id"] for r in masked.collect()) == sorted(ids)
    mixed = stages["target_mixture"](spark, masked, "")
    assert 0 < mixed.count() <= len(ids)
    for frame in (good, one, masked, mixed):
        assert frame.columns == docs.columns
    packed = stages["packing"](spark, mixed, "")
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}


def all_rules(text):
    counts = dict(zip(host_quality.COUNTS, host_quality.measure(text)))
    for rule in host_quality.RULES.values():
        if eval(rule.replace(" OR ", " or "), {}, counts):  # noqa: S307  the rules are arithmetic on the counts
            return False
    return True


def test_run_is_the_stages_in_turn(spark):
    folder = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) > 50
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for doc_id in {r["doc_id"] for r in rows}:
        assert all_rules(documents[doc_id])


def test_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
