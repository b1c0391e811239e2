import random


from conftest_llm import CLASHING, HARD, prose
from racestream.llm import host_quality as hq


def brute(text):
    words = [w for w in __import__("re").split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\f\r")]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
        len(lines),
    )


def test_counts_equal_brute_force():
    pick = random.Random(3)
    for _ in range(200):
        text = "".join(pick.choice("ab é|$\n\t  ") for _ in range(pick.randint(0, 120)))
        assert hq.measure(text) == brute(text)
    assert hq.measure(None) == hq.measure("") == (0, 0, 0, 0, 0, 0)


def test_hard_rows_and_extra_columns(documents):
    rows = hq.report(documents(HARD, **CLASHING)).collect()
    assert len(rows) == len(HARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["base_failed"] and not by_id[2]["kept"]
    assert by_id[4]["kept"] and by_id[5]["kept"]
    kept = hq.keep_good(documents(HARD, **CLASHING))
    assert kept.columns == documents(HARD, **CLASHING).columns
    assert kept.where("doc_id = 4").count() == 2


def test_empty_table(documents):
    assert hq.report(documents([])).count() == 0
    assert hq.keep_good(documents([])).count() == 0


def test_bad_host_takes_its_documents_with_it(documents):
    junk = [(i, " ".join(["$$$"] * 30 + prose(60, i).split()), "en", "bad") for i in range(50)]
    good = [(100 + i, prose(80, i), "en", "good") for i in range(50)]
    lone = [(900, prose(80, 900), "en", "bad"), (901, " ".join(["$$$"] * 90), "en", "tiny"), (902, prose(80, 902), "en", "tiny")]
    rows = {r["doc_id"]: r for r in hq.report(documents(junk + good + lone)).collect()}
    assert not rows[900]["kept"] and rows[900]["host_failed"]
    assert all(rows[100 + i]["kept"] for i in range(50))
    assert not rows[901]["kept"]


def test_prior_shrinks_small_hosts():
    mean, strength = hq.beta_prior(0.2, 0.01, 0.01)
    assert mean == 0.2 and 2 <= strength <= 10_000
    assert hq.beta_prior(None, None, None) == (0.0, hq.STRONGEST)
    assert hq.beta_prior(0.5, 0.25, 0.0)[1] == hq.WEAKEST
