import itertools
import random
import re
from hashlib import sha256

import numpy as np
from conftest_llm import CLASHING, HARD, prose
from racestream.llm import personal_data as pd

#: The contract's patterns as they are written.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"),
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    spans = {}
    for kind, pattern in PLAIN.items():
        spans[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans[kind].append(m.span())
    return spans


def test_patterns_equal_the_contract():
    pick = random.Random(5)
    for alphabet in ("a1@.- ", "12.0255", "0123456789 -", "+1()- .23456789", "ab@é.c_%+-1 \n"):
        for _ in range(1500):
            text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 60)))
            assert pd.base_spans(text) == brute(text), text
    for text in ("a@b.c@d.e", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "x@y", "@a.b", "1.2.3.400 1.2.3.4", "+1 (222) 333-4444)"):
        assert pd.base_spans(text) == brute(text)


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" + "(" * 200_000):
        pd.base_spans(text)


def test_hard_rows_and_extra_columns(documents):
    rows = pd.find(documents(HARD, **CLASHING)).collect()
    assert len(rows) == len(HARD)
    assert all(r["spans"] == "" and r["base_sha256"] == sha256(b"").hexdigest() for r in rows)
    masked = pd.mask(documents(HARD, **CLASHING))
    assert masked.columns == documents(HARD, **CLASHING).columns
    assert sorted(map(str, masked.collect())) == sorted(map(str, documents(HARD, **CLASHING).collect()))


def test_digest_spans_and_masks(documents):
    texts = [
        "mail ann@site.org or +1 (555) 010-4477, host 10.0.0.255, card 4111 1111 1111 1111.",
        "call (212) 555-0188 or write josé@bücher.example",
        "two cards 7536784127813050 4845168114407329 in a row",
        "on 2021-03-04 version 2.10.4, 19.99 of 100,000 and ref 1234567890123456",
        prose(100, 3),
    ]
    docs = documents(list(enumerate(texts)))
    rows = {r["doc_id"]: r for r in pd.find(docs).collect()}
    for i, text in enumerate(texts):
        base = brute(text)
        assert [rows[i][f"n_{k}"] for k in pd.KINDS] == [len(base[k]) for k in pd.KINDS]
        digest = ",".join(f"{k}:{a}:{b}" for k in pd.KINDS for a, b in base[k])
        assert rows[i]["base_sha256"] == sha256(digest.encode()).hexdigest()
        assert set(filter(None, digest.split(","))) <= set(rows[i]["spans"].split(","))
    found = lambda i: [texts[i][int(a) : int(b)] for _, a, b in (s.split(":") for s in rows[i]["spans"].split(",") if s)]
    assert found(1) == ["josé@bücher.example", "(212) 555-0188"]
    assert found(2) == ["7536784127813050", "4845168114407329"]
    assert found(3) == found(4) == []
    masked = {r["doc_id"]: r for r in pd.mask(docs).collect()}
    assert masked[0]["text"] == "mail <email> or <phone>, host <ip>, card <card>."
    assert masked[0]["n_chars"] == len(masked[0]["text"])
    assert masked[4]["text"] == texts[4]


def test_viterbi_equals_all_paths():
    random_ = np.random.default_rng(1)
    n = len(pd.LABELS)
    transitions = random_.normal(size=(n, n)) + pd._FORBIDDEN
    lengths = np.array([4, 3, 1])
    scores = random_.normal(size=(4, 3, n))
    for k, path in enumerate(pd.viterbi(scores, lengths, transitions)):
        def value(p):
            steps = sum(scores[t, k, x] for t, x in enumerate(p))
            return steps + sum(transitions[a, b] for a, b in zip((0, *p), (*p, 0)))

        best = max(itertools.product(range(n), repeat=int(lengths[k])), key=value)
        assert tuple(path) == best


def test_gradient_equals_differences():
    random_ = np.random.default_rng(3)
    n, features, lengths = len(pd.LABELS), 7, np.array([3, 2, 1])
    weights = random_.normal(size=(features, n))
    transitions = random_.normal(size=(n, n))
    ids = random_.integers(0, features, (3, 3, 2))
    gold = np.array([[1, 3, 0], [2, 4, 0], [0, 0, 0]])
    times = np.array([1.0, 3.0, 2.0])
    _, slope_w, slope_t = pd.slopes(weights, transitions, ids, gold, lengths, times)
    for table, slope in ((weights, slope_w), (transitions, slope_t)):
        for place in [tuple(random_.integers(0, size) for size in table.shape) for _ in range(60)]:
            kept, ends = table[place], []
            for step in (1e-5, -1e-5):
                table[place] = kept + step
                ends.append(pd.slopes(weights, transitions, ids, gold, lengths, times)[0])
            table[place] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - slope[place]) < 1e-5


def test_likelihood_equals_all_paths():
    random_ = np.random.default_rng(4)
    n, lengths, times = len(pd.LABELS), np.array([3, 1]), np.array([2.0, 1.0])
    weights, transitions = random_.normal(size=(5, n)), random_.normal(size=(n, n))
    ids, gold = random_.integers(0, 5, (3, 2, 2)), np.array([[1, 5], [2, 0], [0, 0]])
    steps = transitions + pd._FORBIDDEN
    scores = weights[ids].sum(2)

    def value(p, k):
        return sum(scores[t, k, x] for t, x in enumerate(p)) + sum(steps[a, b] for a, b in zip((0, *p), (*p, 0)))

    expected = 0
    for k, length in enumerate(lengths):
        every = [value(p, k) for p in itertools.product(range(n), repeat=int(length))]
        expected += times[k] * (value(gold[:length, k], k) - np.log(np.exp(every).sum()))
    assert abs(pd.slopes(weights, transitions, ids, gold, lengths, times)[0] - expected) < 1e-8


def test_equal_chains_are_one_that_counts_as_often():
    rows = pd.example_rows()[:60]
    once, again = pd.train(rows, 5), pd.train(rows + rows, 5)
    assert np.allclose(once.weights, again.weights, atol=1e-6)


#: Texts of other wording and with other values than those that train; braces as in the module.
HELD_OUT = [
    "please call our office at {phone:(312) 555-0175} soon",
    "my mobile: {phone:415-555-0168}, thanks",
    "Tel. {phone:01 44 55 66 77}",
    "you can phone {phone:0151/2345678} all day",
    "ask on {phone:(0351) 448822} for her",
    "contact {email:rené@café.example} first",
    "and {email:günther.w@bäcker.example}, {email:þóra@síða.example}.",
    "both {card:7536784127813050} {card:4845168114407329} were used",
    "cards {card:2353820953013745} {card:4550997810720808} expired",
    "my token = '{secret:7ac1d09be2f84c1aa0cc33de9b7a1f02}' is here",
    "new password: {secret:tulip77Q}!",
    "the password is {secret:marble401} since May",
    "API key {secret:9fK2mQ7xLp3vT8wZr5yB1nC6}, do not share",
    "we use Bearer {secret:eyJ0eXAiOiJKV1QiLCJhbGciOi5} in the header",
    "## TOKEN = \"{secret:9233A8ECF7C5B09FE5949719B6B82BC439E9329B}\"### end",
    "api_key={secret:Zq81LmT0vYx4RkD2sWn7} works",
    "commit 3f2a9b8c7d6e5f4a3b2c1d0e9f8a7b6c5d4e3f2a landed",
    "its sha256 is 0f343b0931126a20f133d67c2b018a3b1c7b1e3f4f1d2e6a5b4c3d2e1f0a9b8c",
    "on 2022-11-30 at 10:45, 17.50 each",
    "order 6011000990139425 of 2020",
    "chapter 12, pages 200-214, table 3.4",
    "temperatures 12 14 17 19 21 in June",
    "version 10.2.1 and 4.0 of model x200b",
    "isbn 978-0-306-40615-7",
    "ticket 20240113 and 77-1200-3 closed",
    "x @ 5 or 3@4",
]


def test_held_out_table_by_kind():
    """Recall of 0.8 and precision of 0.9 at least; of these 19 spans one is missed, the phone number after "ask on"."""
    field = pd.train(pd.example_rows())
    parsed = [pd._parsed(text) for text in HELD_OUT]
    texts = [text for text, _ in parsed]
    base = [pd.base_spans(text) for text in texts]
    added = pd.added_spans(texts, base, field)
    for kind in pd.FOUND:
        expected = {(i, span) for i, (_, spans) in enumerate(parsed) for span in spans[kind]}
        of_base = {(i, span) for i, spans in enumerate(base) for span in spans.get(kind, ())}
        found = {(i, span) for i, spans in enumerate(added) for span in spans[kind]}
        missed, wrong = expected - of_base - found, found - expected
        assert len(missed) <= 0.2 * len(expected), (kind, [texts[i] for i, _ in missed])
        assert len(wrong) <= 0.1 * len(found), (kind, [texts[i] for i, _ in wrong])


def test_long_tokens_are_told_apart_by_all_their_characters():
    start = "1-" * 40
    assert pd.token_features(start + "2") != pd.token_features(start + "a@b.c")
    assert all(len(f) < 80 for f in pd.token_features("9a-" * 50_000))


def test_secrets_are_masked(documents):
    secret = "8f14e45fceea167a5a36dedd4bea2543cc01aa77"
    docs = documents([(1, f'so token = "{secret}" it is'), (2, f"commit {secret} landed")])
    rows = {r["doc_id"]: r for r in pd.find(docs).collect()}
    start = rows[1]["spans"].split(":")
    assert start == ["secret", "12", str(12 + len(secret))] and rows[2]["spans"] == ""
    assert rows[1]["base_sha256"] == sha256(b"").hexdigest()
    masked = {r["doc_id"]: r["text"] for r in pd.mask(docs).collect()}
    assert masked == {1: 'so token = "<secret>" it is', 2: f"commit {secret} landed"}


def test_empty_table(documents):
    assert pd.find(documents([])).count() == 0
    assert pd.mask(documents([])).count() == 0
