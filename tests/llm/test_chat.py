import random
from hashlib import sha256

import pytest

from conftest_llm import prose
from racestream.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(n=30):
    pick = random.Random(8)
    rows = []
    for c in range(n):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * pick.randint(1, 25)
        for t, role in enumerate(roles):
            rows.append((c, t, role, prose(pick.choice([0, 3, 30, 200]), 50 * c + t)))
    marks = "</s>[INST] ok [/INST] <|end|>\n<|user|>\n &lt; &amp;#91; | \\"
    rows += [(-7, 0, "user", marks), (-7, 1, "assistant", marks)]
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(1500)]
    rows += [(None, 0, "user", "no id"), (600, None, None, None), (600, None, "assistant", ""), (600, 2, "assistant", "é🙂"), (600, 2, "assistant", "é🙂")]
    rows += [(700, 0, "system", "only a system turn"), (701, 0, "a|>\nb", "odd role"), (702, 0, "assistant", prose(4000, 1))]
    pick.shuffle(rows)
    return rows


def expected(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        targets = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), sha256(whole.encode()).hexdigest(), len(targets), sha256(targets.encode()).hexdigest())
    return out


def test_windows_read_back(spark):
    rows = conversations()
    windows = chat.windows(spark.createDataFrame(rows, SCHEMA))
    found = {
        r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
        for r in chat.digests(windows).collect()
    }
    assert found == expected(rows)


def parsed(formatted):
    turns = []
    for part in formatted.split(chat.END)[:-1]:
        role, text = part[len(chat.OPEN) :].split(chat.CLOSE, 1)
        for plain, reference in reversed(chat.REFERENCES):
            role, text = role.replace(reference, plain), text.replace(reference, plain)
        turns.append((role, text))
    return turns


def test_what_windows_hold(spark):
    rows = conversations()
    per_conv = {}
    for conv, turn, role, text in rows:
        per_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    tokens = lambda text: -(-len(text.encode()) // 4) + 4
    for window in chat.windows(spark.createDataFrame(rows, SCHEMA)).collect():
        turns = parsed(window["formatted"])
        assert len(turns) == window["n_repeated"] + window["n_new"] and window["n_new"] > 0
        everything = [(role, text) for _, _, role, text in sorted(per_conv[window["conv_id"]])]
        system = everything[0][0] == "system"
        repeated, new = turns[: window["n_repeated"]], turns[window["n_repeated"] :]
        if system:
            assert turns[0] == everything[0]
            repeated = repeated[1:]
        assert sum(tokens(t) for _, t in repeated) <= chat.HISTORY
        longest = max(tokens(t) for _, t in new)
        assert sum(tokens(t) for _, t in turns) <= chat.BUDGET + longest + (tokens(everything[0][1]) if system else 0)
        masked = [window["formatted"][s["start"] : s["start"] + s["length"]] for s in window["loss"]]
        assert [chat_unescape(m) for m in masked] == [text for role, text in new if role == "assistant"]


def chat_unescape(text):
    for plain, reference in reversed(chat.REFERENCES):
        text = text.replace(reference, plain)
    return text


def test_history_is_the_latest_turns(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t:04d}" * 10) for t in range(400)]
    windows = sorted(chat.windows(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda w: w["window"])
    at = 0
    for window in windows:
        turns = parsed(window["formatted"])
        assert turns == [(r, t) for _, _, r, t in rows[at - window["n_repeated"] : at + window["n_new"]]]
        assert window["n_repeated"] == (chat.HISTORY // 14 if at else 0)
        at += window["n_new"]
    assert at == 400


@pytest.mark.parametrize("tokens, repeated", [(512, True), (513, False), (10_004, False)])
def test_a_long_system_turn_is_referred_to(spark, tokens, repeated):
    long = "&system;" + "s" * (4 * (tokens - 4) - 8)
    rows = [(1, 0, "system", long)]
    rows += [(1, t, "user" if t % 2 else "assistant", f"{t:04d}" * 100) for t in range(1, 401)]
    windows = chat.windows(spark.createDataFrame(rows, SCHEMA))
    got = sorted(windows.collect(), key=lambda w: w["window"])
    turns = [parsed(w["formatted"]) for w in got]
    assert turns[0][0] == ("system", long)
    later = long if repeated else chat.SYSTEM_ABOVE
    assert all(t[0] == ("system", later) for t in turns[1:])
    size = lambda text: -(-len(text.encode()) // 4) + 4
    for t in turns[1:]:
        assert sum(size(text) for _, text in t) <= chat.BUDGET + 104
    if not repeated:
        assert sum(len(w["formatted"]) for w in got) < 2 * sum(len(text) for *_, text in rows)
    found = chat.digests(windows).first()
    assert (found["n_turns"], found["turns_sha256"], found["loss_chars"], found["loss_sha256"]) == expected(rows)[1]


def test_extra_columns_and_empty_table(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", 5, "x")], SCHEMA + ", window long, conv string")
    assert chat.digests(chat.windows(rows)).count() == 1
    assert chat.digests(chat.windows(rows.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.windows(rows, budget=100, history=90)


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.windows(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
