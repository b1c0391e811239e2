"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags the pieces of a text, cut at white space, quotes and separators, as the begin of a secret, its inside, or outside. Its
features are the shape of a piece, the words and separators around it, the cue word before it if there is one, and features of the
whole text. It is trained on a labelled table, which is made by filling templates, and on pieces of a bounded sample of the documents,
labelled by the patterns. Pieces that neither hold a digit and have eight characters, nor follow a cue word closely, are outside by
definition; so a text falls into chains between them, and Viterbi on each of them is exact for the whole text. Chains of
similar length are decoded together in numpy.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import doc_texts, fresh, map_rows, with_arrow_columns

KINDS = ["assign", "access", "hex"]
#: The kind of spans that only the field finds.
ADDED = "secret"
ORDER = {kind: i for i, kind in enumerate([*KINDS, ADDED])}

OUTSIDE, BEGIN, INSIDE = range(3)

#: Documents whose pieces train the field beside the labelled table, and chains of them (expected; twice as many at most).
SAMPLE_DOCS = 2_000
SAMPLE_CHAINS = 4_000
#: Pieces of a chain that train; decoding takes all.
LONGEST_TRAINED = 48
#: Fillings of each template.
FILLINGS = 12

Span = tuple[int, int]


# Patterns

# The patterns of the base, their least lengths below.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("pass", "secret", "token", "api")


def _holds(text: str, parts: tuple[str, ...]) -> bool:
    low = text.lower()
    return any(part in low for part in parts)


def _assignments(text: str) -> list[tuple[int, int, Span]]:
    """Assignments of secrets, and where their values are. Most texts hold no keyword, and are not searched."""
    if not _holds(text, _KEYWORDS) or (":" not in text and "=" not in text):
        return []
    return [(*m.span(), m.span(1)) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 8]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the fixed patterns, by start and kind, in code points."""
    found = [(a, b, "assign") for a, b, _ in _assignments(text)]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def _united(spans: list[Span]) -> list[Span]:
    """The same characters as spans in order, of which none touches another."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _overlapping(span: Span, united: list[Span]) -> Span | None:
    """The first of some united spans that shares a character with a span."""
    at = bisect_right(united, (span[0],)) - 1
    if at >= 0 and united[at][1] > span[0]:
        return united[at]
    following = united[at + 1] if at + 1 < len(united) else None
    return following if following and following[0] < span[1] else None


def _values(text: str) -> list[Span]:
    """The secrets themselves in the base spans, united."""
    values = [value for _, _, value in _assignments(text)]
    return _united(values + [(a, b) for a, b, kind in base_spans(text) if kind != "assign"])


# Pieces and their features

_SEPARATORS = r"""\s"'`=:;,@<>(){}\[\]|\\"""
_PIECE = re.compile(rf"[^{_SEPARATORS}]+")
_DIGITS = re.compile(r"[0-9]+")
_MARKS = frozenset("\"'`=:;,@<>(){}[]|\\")
_CUE = re.compile(
    r"passwo?r?d|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_ -]key|credential|bearer|authorization"
    r"|(?<![A-Za-z])(?:pass|auth|key|pin|login)(?![A-Za-z])",
    re.I | re.A,
)
_CUE_PARTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth", "pin", "login")
_LEAST_LENGTH, _CUE_REACH = 8, 4
_LETTERS = re.compile(r"[A-Za-z]+")
_CODE_ENDS = (";", "{", "}", "(", ")")
_NEAR_CUES = {"password": "word", "passwd": "word", "passphrase": "word", "passcode": "word", "pwd": "word", "pass": "word", "login": "word", "pin": "word"}


def charset(piece: str) -> str:
    """What characters a piece is made of."""
    if piece.isdecimal():
        return "digits"
    low, up, digit = (any(map(test, piece)) for test in (str.islower, str.isupper, str.isdecimal))
    rest = {c for c in piece if not c.isalnum()}
    if not rest and digit and all(c in "0123456789abcdef" for c in piece):
        return "hex"
    if not rest and digit and all(c in "0123456789ABCDEF" for c in piece):
        return "HEX"
    kind = ("a" if low else "") + ("A" if up else "") + ("9" if digit else "")
    if not rest:
        return ("Aa" if piece[:1].isupper() and piece[1:].islower() else kind) if piece.isascii() else f"{kind}u"
    if rest <= set("+/-_."):
        return kind + "".join(sorted(rest))
    return f"{kind}*"


def _steps(value: float, limits: tuple[float, ...]) -> int:
    return bisect_right(limits, value)


_looks: dict[str, tuple[str, ...]] = {}


def look(piece: str) -> tuple[str, ...]:
    """Features of a piece by itself: character set, length, changes of class, variety, digits, and how it begins."""
    known = _looks.get(piece)
    if known is None:
        classes = ["9" if c.isdecimal() else "a" if c.islower() else "A" if c.isupper() else "-" for c in piece]
        n = len(piece)
        size = _steps(n, (4, 6, 8, 12, 16, 20, 24, 32, 40, 48, 64, 80))
        changes = _steps(sum(a != b for a, b in zip(classes, classes[1:])) / n, (0.05, 0.12, 0.25, 0.4, 0.6))
        variety = _steps(len(set(piece)) / min(n, 40), (0.2, 0.4, 0.6, 0.8))
        digits = _steps(classes.count("9") / n, (0.01, 0.1, 0.3, 0.6, 0.99))
        start = re.match(r"[^0-9]*", piece).group()[:4]
        known = (f"c={charset(piece)}", f"c={charset(piece)}|{size}", f"n={size}", f"x={changes}|{variety}|{size}", f"d={digits}|{changes}", f"b={start}")
        if len(_looks) < 100_000 and n <= 100:
            _looks[piece] = known
    return known


def _gap(text: str, start: int, end: int) -> str:
    """The separators between two pieces: white space as one blank, or as a line's end, and four marks at most."""
    between = text[start:end] if end - start <= 12 else text[start : start + 6] + text[end - 6 : end]
    marks = re.sub(r"\s*\n\s*", "\n", between)
    return re.sub(r"[^\S\n]+", " ", marks)[-4:]


def file_features(text: str, n_cues: int) -> tuple[str, ...]:
    """Features of the whole text: how much of it is code, digits, and whether it holds cues."""
    lines = text.split("\n")
    code = _steps(sum("=" in line or line.rstrip().endswith(_CODE_ENDS) for line in lines) / len(lines), (0.01, 0.2, 0.5))
    digits = _steps(sum(map(text.count, "0123456789")) / max(len(text), 1), (0.005, 0.03, 0.1))
    return f"code={code}", f"digits={digits}|{code}", f"cues={min(n_cues, 3)}"


@dataclass
class Chain:
    """Neighbouring pieces that can be part of a secret: their spans and features."""

    spans: list[Span]
    features: list[tuple[str, ...]]


def _digit_pieces(text: str) -> list[int]:
    """Where pieces begin that hold a digit and are long enough: found from their digits, as most pieces have none."""
    found, end = [], 0
    for m in _DIGITS.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not (text[start - 1].isspace() or text[start - 1] in _MARKS):
            start -= 1
        end = _PIECE.match(text, start).end()
        if end - start >= _LEAST_LENGTH:
            found.append(start)
    return found


def _cues(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), m.group().lower()) for m in _CUE.finditer(text)] if _holds(text, _CUE_PARTS) else []


def chains(text: str) -> list[Chain]:
    """The chains of a text, in order."""
    digits, cues = _digit_pieces(text), _cues(text)
    if not digits and not cues:
        return []
    spans = [m.span() for m in _PIECE.finditer(text)]
    starts = [a for a, _ in spans]
    active = {bisect_left(starts, a) for a in digits}
    cue_of: dict[int, tuple[int, str]] = {}
    for a, b, word in cues:
        # The piece in which the cue ends; pieces after it are within its reach.
        at = bisect_left(starts, b) - 1
        for k in range(at + 1, min(at + 1 + _CUE_REACH, len(spans))):
            cue_of[k] = (k - at, _NEAR_CUES.get(word, "key"))
            active.add(k)
    if not active:
        return []
    file = file_features(text, len(cues))
    found: list[Chain] = []
    last = -2
    piece = lambda i: text[slice(*spans[i])] if 0 <= i < len(spans) else ""
    for i in sorted(active):
        if i != last + 1:
            found.append(Chain([], []))
        before, after = piece(i - 1), piece(i + 1)
        own = look(piece(i))
        gap = _gap(text, spans[i - 1][1] if i else 0, spans[i][0])
        next_gap = _gap(text, spans[i][1], spans[i + 1][0] if i + 1 < len(spans) else len(text))
        near, cue = cue_of.get(i, (0, "none"))
        words = [w.group().lower() if (w := _LETTERS.search(x)) else "" for x in (before, after, piece(i - 2))]
        found[-1].spans.append(spans[i])
        found[-1].features.append(
            (
                *own,
                f"g={gap}",
                f"f={next_gap}",
                f"q={cue}{near}",
                f"q={cue}{near}|{own[0]}",
                f"q={cue}{near}|g={gap}",
                f"w1={words[0]}",
                f"w+={words[1]}",
                f"w2={words[2]}",
                f"p={charset(before) if before else ''}|{own[0]}",
                f"s={charset(after) if after else ''}|{own[0]}",
                f"{file[0]}|{cue}",
                f"{file[1]}",
                f"{file[2]}|{own[0]}",
            )
        )
        last = i
    return found


def tags_of(chain: Chain, secrets: list[Span]) -> list[int]:
    """The tag of each piece, given where the secrets are, in order and apart."""
    tags = []
    inside: Span | None = None
    for span in chain.spans:
        hit = _overlapping(span, secrets)
        tags.append(OUTSIDE if hit is None else INSIDE if hit == inside and tags[-1] != OUTSIDE else BEGIN)
        inside = hit
    return tags


# The labelled table

#: Texts with fillings: those in braces are secrets, those in brackets are not.
TEMPLATES = [
    "password is {pass}",
    "the password for the wiki is {pass}, please change it",
    "my passphrase is {words} ok",
    "pwd: {pass}",
    "[word] pwd is {pass} and [word]",
    "the old password was {pass}, the new one is {symbols}",
    "passphrase: {words}",
    "their passcode is {pass} for now",
    "with password {pass}",
    "db_pwd={pass}\nhost=db.example\nport=[port]",
    "user: admin\npassword: '{symbols}'\nretries: 3",
    "login admin pass {pass} then go on",
    "postgres://app:{pass}@db.example:5432/main",
    "https://bot:{alnum}@git.example/team/app.git",
    "Authorization: Bearer {jwt}",
    "curl -H 'Authorization: Bearer {alnum}' https://api.example/v1",
    "Authorization: Basic {base64}",
    "export GITHUB_TOKEN {ghp}\nexport EDITOR=vim",
    "use {ghp} to push",
    "stripe {sk_live} works",
    "slack hook {xoxb}",
    "aws_secret_access_key\t{base64}\nregion = eu-west-1",
    "secret key: \n{base64}\n",
    "SECRET_KEY -> {symbols}",
    "const accessKey = [word]; const privateKey = `{base64}`;",
    "config.set(\"credential\", \"{alnum}\");",
    "client_secret  {HEX}",
    "api-key {uuid}",
    "x-api-key: {alnum}\naccept: json",
    "fingerprint ok, key {HEX}",
    "-----BEGIN RSA PRIVATE KEY-----\n{pem}\n-----END RSA PRIVATE KEY-----\n",
    "-----BEGIN PRIVATE KEY-----\n{pem}\n-----END PRIVATE KEY-----",
    "auth {jwt}\nnext line",
    "jwt {jwt} expired",
    "the pin is [number]",
    "passwords are kept in [word] and [word]",
    "a password of [number] characters, changed on [date]",
    "reset your password at https://site.example/[word]/[number]",
    "the secret of [word] is [word] and time",
    "token count [number] of [number]",
    "each token is [word], then [word] follows",
    "the key to [word] lies in [word] [number]",
    "key: [word]\nvalue: [number]\n",
    "commit [short] by ann on [date]",
    "release [version] of [date]",
    "order [digits] shipped on [date]",
    "card [card] was charged",
    "call [phone] or [phone]",
    "host [ip] port [port]",
    "isbn [digits], page [number]",
    "mail john.smith[number]@mail[number].example.org",
    "see https://site.example/[word]/[digits]/[word].html for more",
    "id [uuid] done in [number] ms",
    "file IMG_[digits].jpg and report-[date].pdf",
    "function [word]2[word]([word]) { return [word][number]; }",
    "at [time] on [date] the [word] of [digits] items",
    "$[number],[number].00 and [number]%%% [word]### [digits]",
    "author [word], authority [word], pass the [word] on",
    "log in with your login and press [word]",
]

_CODE_POINTS = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "hex": "0123456789abcdef",
}
_MIXED = _CODE_POINTS["lower"] + _CODE_POINTS["upper"] + _CODE_POINTS["digit"]
_PROSE = "winter river garden coffee monday silver orange planet the of and to in window bread little ocean".split()


def _password(pick: random.Random) -> str:
    """A word with digits and marks, some of its letters large or replaced by digits."""
    word = pick.choice(_PROSE) + pick.choice(_PROSE)[: pick.randint(0, 4)]
    kind = pick.randrange(4)
    if kind == 0:
        word = word.title()
    elif kind == 1:
        word = "".join(c.upper() if pick.random() < 0.3 else c for c in word)
    elif kind == 2:
        word = word.translate(str.maketrans("aeio", "4310"))
    ending = "".join(pick.choice("0123456789") for _ in range(pick.randint(1, 4)))
    return word + ending + "".join(pick.choice("!#$%&*-_") for _ in range(pick.randint(0, 2)))


def _filling(name: str, pick: random.Random) -> str:
    some = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    d, low = _CODE_POINTS["digit"], _CODE_POINTS["lower"]
    makers = {
        "pass": lambda: _password(pick),
        "symbols": lambda: some(_MIXED + "!#$%^&*-_+?~", pick.randint(10, 24)),
        "words": lambda: "-".join([*(pick.choice(_PROSE) for _ in range(pick.randint(3, 5))), some(d, pick.randint(0, 2))]).strip("-"),
        "alnum": lambda: some(_MIXED, pick.randint(16, 44)),
        "base64": lambda: some(_MIXED + "+/", pick.randint(24, 44)),
        "HEX": lambda: some("0123456789ABCDEF", pick.choice((32, 40, 64))),
        "jwt": lambda: "eyJ" + ".".join(some(_MIXED + "-_", pick.randint(20, 44)) for _ in range(3)),
        "ghp": lambda: pick.choice(("ghp_", "gho_", "ghs_")) + some(_MIXED, 36),
        "sk_live": lambda: pick.choice(("sk_live_", "rk_live_", "sk_test_")) + some(_MIXED, 24),
        "xoxb": lambda: f"{pick.choice(('xoxb', 'xoxp'))}-{some(d, 12)}-{some(_MIXED, 24)}",
        "pem": lambda: "\n".join(["MII" + some(_MIXED + "+/", 61), *[some(_MIXED + "+/", 64) for _ in range(pick.randint(2, 6))]]),
        "uuid": lambda: "-".join(some(_CODE_POINTS["hex"], n) for n in (8, 4, 4, 4, 12)),
        "word": lambda: pick.choice(_PROSE),
        "number": lambda: some(d, pick.randint(1, 4)),
        "port": lambda: some(d, 4),
        "digits": lambda: some(d, pick.randint(8, 18)),
        "short": lambda: some(_CODE_POINTS["hex"], pick.choice((7, 8, 10, 12))),
        "date": lambda: f"20{some(d, 2)}-0{pick.randint(1, 9)}-{pick.randint(10, 28)}",
        "time": lambda: f"{pick.randint(10, 23)}:{pick.randint(10, 59)}",
        "version": lambda: f"v{pick.randint(1, 9)}.{pick.randint(0, 40)}.{pick.randint(0, 9)}-rc{pick.randint(1, 9)}",
        "card": lambda: some(d, 16) if pick.random() < 0.5 else " ".join(some(d, 4) for _ in range(4)),
        "phone": lambda: f"+{some(d, 2)} ({some(d, 3)}) {some(d, 3)}-{some(d, 4)}" if pick.random() < 0.5 else f"{some(d, 3)}-{some(d, 3)}-{some(d, 4)}",
        "ip": lambda: ".".join(str(pick.randint(0, 255)) for _ in range(4)),
        "mail": lambda: some(low, 6),
    }
    return makers[name]()


def labelled_table(fillings: int = FILLINGS) -> list[tuple[str, list[Span]]]:
    """Texts and where their secrets are; the same at every call. Half of them stand within prose."""
    pick, rows = random.Random(11), []
    for template in TEMPLATES:
        for k in range(fillings):
            text, secrets = "", []
            if k % 2:
                text = " ".join(pick.choice(_PROSE) for _ in range(pick.randint(3, 30))) + pick.choice((" ", ". ", "\n"))
            for plain, secret, other in re.findall(r"([^{\[]+)|\{(\w+)\}(?!;)|\[(\w+)\]", template.replace("{ ", "\x00")):
                if secret:
                    filled = _filling(secret, pick)
                    secrets.append((len(text), len(text) + len(filled)))
                    text += filled
                else:
                    text += _filling(other, pick) if other else plain.replace("\x00", "{ ")
            if k % 2:
                text += " " + " ".join(pick.choice(_PROSE) for _ in range(pick.randint(2, 20)))
            rows.append((text, secrets))
    return rows


# The field

#: Transitions that cannot be: from outside, and from before the first piece, into the inside of a secret.
_FORBIDDEN = np.zeros((3, 3))
_FORBIDDEN[OUTSIDE, INSIDE] = -1e4


def viterbi(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The best tags of chains by falling length, with scores by step, chain and tag; every chain begins from outside."""
    steps, count, _ = scores.shape
    back = np.zeros((steps, count, 3), np.int8)
    value = transitions[OUTSIDE] + scores[0]
    for t in range(1, steps):
        going = int(np.searchsorted(-lengths, -t))
        through = value[:going, :, None] + transitions
        back[t, :going] = through.argmax(1)
        value[:going] = through.max(1) + scores[t, :going]
    tags = np.zeros((steps, count), np.int8)
    rows = np.arange(count)
    at = value.argmax(1)
    for t in range(steps - 1, -1, -1):
        going = int(np.searchsorted(-lengths, -t))
        tags[t, :going] = at[:going]
        at[:going] = back[t, rows[:going], at[:going]]
    return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def likelihood(scores: np.ndarray, gold: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of the tags of all chains, and its slopes by scores and by transitions."""
    steps, count, _ = scores.shape
    inside = np.arange(steps)[:, None] < lengths
    rows = np.arange(count)
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    forward[0] = transitions[OUTSIDE] + scores[0]
    for t in range(1, steps):
        moved = _log_sum(forward[t - 1][:, :, None] + transitions, 1) + scores[t]
        forward[t] = np.where(inside[t][:, None], moved, forward[t - 1])
    for t in range(steps - 2, -1, -1):
        moved = _log_sum(transitions + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        backward[t] = np.where(inside[t + 1][:, None], moved, 0.0)
    total = _log_sum(forward[-1], 1)
    before = np.concatenate([np.full((1, count), OUTSIDE), gold[:-1]])
    own = (scores[np.arange(steps)[:, None], rows, gold] + transitions[before, gold]) * inside
    slope = -np.exp(forward + backward - total[:, None]) * inside[:, :, None]
    moves = np.zeros((3, 3))
    np.add.at(moves, (before[inside], gold[inside]), 1)
    moves[OUTSIDE] += slope[0].sum(0)
    for t in range(1, steps):
        on = inside[t]
        both = forward[t - 1][on][:, :, None] + transitions + (scores[t] + backward[t])[on][:, None, :]
        moves -= np.exp(both - total[on][:, None, None]).sum(0)
    step, row = np.nonzero(inside)
    slope[step, row, gold[step, row]] += 1
    return float(own.sum() - total.sum()), slope, moves


@dataclass
class Field:
    """Weights by feature and tag, the last row for features never seen in training, and of transitions."""

    columns: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def ids(self, features: list[tuple[str, ...]]) -> np.ndarray:
        unknown = len(self.columns)
        return np.array([[self.columns.get(f, unknown) for f in piece] for piece in features])

    def tags(self, found: list[Chain]) -> list[np.ndarray]:
        """The best tags of each chain; chains with lengths up to the same power of two go together."""
        out: list = [None] * len(found)
        groups: dict[int, list[int]] = {}
        for i, chain in enumerate(found):
            groups.setdefault((len(chain.spans) - 1).bit_length(), []).append(i)
        for members in groups.values():
            members.sort(key=lambda i: -len(found[i].spans))
            lengths = np.array([len(found[i].spans) for i in members])
            scores = np.zeros((lengths[0], len(members), 3))
            for k, i in enumerate(members):
                scores[: lengths[k], k] = self.weights[self.ids(found[i].features)].sum(1)
            best = viterbi(scores, lengths, self.transitions + _FORBIDDEN)
            for k, i in enumerate(members):
                out[i] = best[: lengths[k], k]
        return out


def train(rows: list[tuple[list[tuple[str, ...]], list[int]]], rounds: int = 120, decay: float = 0.02) -> Field:
    """Fits the field to tagged chains: gradient ascent of their log-likelihood with a penalty, steps scaled by past slopes."""
    columns: dict[str, int] = {}
    for features, _ in rows:
        for piece in features:
            for f in piece:
                columns.setdefault(f, len(columns))
    field = Field(columns, np.zeros((len(columns) + 1, 3)), np.zeros((3, 3)))
    if not rows:
        return field
    lengths = np.array([len(tags) for _, tags in rows])
    steps, width = int(lengths.max()), len(rows[0][0][0])
    ids = np.full((steps, len(rows), width), len(columns))
    gold = np.zeros((steps, len(rows)), int)
    for k, (features, tags) in enumerate(rows):
        ids[: lengths[k], k] = field.ids(features)
        gold[: lengths[k], k] = tags
    flat = ids.reshape(-1)
    past_w, past_t = np.full_like(field.weights, 1e-6), np.full_like(field.transitions, 1e-6)
    for _ in range(rounds):
        _, slope, moves = likelihood(field.weights[ids].sum(2), gold, lengths, field.transitions + _FORBIDDEN)
        by_piece = slope.reshape(-1, 3)
        change = np.stack([np.bincount(flat, np.repeat(by_piece[:, tag], width), len(columns) + 1) for tag in range(3)], 1)
        change -= decay * field.weights
        change[-1] = 0
        moves -= decay * field.transitions
        past_w += change**2
        past_t += moves**2
        field.weights += 0.4 * change / np.sqrt(past_w)
        field.transitions += 0.4 * moves / np.sqrt(past_t)
    return field


def training_rows(documents: DataFrame) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Tagged chains of the labelled table, and of a sample of documents chosen by hash, labelled by the patterns.

    About ``SAMPLE_DOCS`` documents, and of their chains the ``SAMPLE_CHAINS`` with the least hashes; only those come to the driver.
    Chains without a base span teach what is outside if they hold no letter; of others the patterns cannot tell, so they are left out.
    """
    texts = doc_texts(documents)
    share = max(1, texts.count() // SAMPLE_DOCS)
    chosen = texts.where(F.pmod(F.xxhash64(F.lit(11), "doc_id", F.length("text")), F.lit(share)) == 0)

    def cut(columns: dict[str, list]) -> dict[str, list]:
        features, tags = [], []
        for text in columns["text"]:
            secrets = _values(text)
            for chain in chains(text):
                own = tags_of(chain, secrets)[:LONGEST_TRAINED]
                if any(own) or not any(_LETTERS.search(text[a:b]) for a, b in chain.spans):
                    features.append([list(f) for f in chain.features[:LONGEST_TRAINED]])
                    tags.append(own)
        return {"features": features, "tags": tags}

    rows = map_rows(chosen, cut, "features array<array<string>>, tags array<int>")
    sample = rows.orderBy(F.xxhash64("features"), "tags").limit(SAMPLE_CHAINS).collect()
    found = [([tuple(f) for f in row["features"]], list(row["tags"])) for row in sample]
    for text, secrets in labelled_table():
        found += [(chain.features, tags_of(chain, secrets)) for chain in chains(text)]
    return found


# Spans of whole texts

def _decoded(chain: Chain, tags: np.ndarray) -> list[Span]:
    found: list[Span] = []
    for (a, b), tag in zip(chain.spans, tags.tolist()):
        if tag == BEGIN:
            found.append((a, b))
        elif tag == INSIDE:
            found[-1] = (found[-1][0], b)
    return found


def added_spans(texts: list[str], base: list[list[tuple[int, int, str]]], field: Field) -> list[list[tuple[int, int, str]]]:
    """What the field finds in each text without touching a base span."""
    added: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    taken = [_united([(a, b) for a, b, _ in spans]) for spans in base]
    owners, found = [], []
    for i, text in enumerate(texts):
        mine = chains(text)
        owners += [i] * len(mine)
        found += mine
    for i, chain, tags in zip(owners, found, field.tags(found)):
        if tags.any():
            added[i] += [(*span, ADDED) for span in _decoded(chain, tags) if not _overlapping(span, taken[i])]
    return added


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])))


def find(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: numbers of base spans, their digest, all spans as text, and those added.

    A null text is an empty one and has none. Repeated rows are reported each time, null ids stay, further columns are ignored, and an
    empty table gives an empty one. The field is trained first, on the labelled table and a sample of the same documents.
    """
    field = train(training_rows(documents))

    def search(columns: dict[str, list]) -> dict[str, list]:
        texts = columns["text"]
        base = [base_spans(text) for text in texts]
        added = added_spans(texts, base, field)
        return {
            "doc_id": columns["doc_id"],
            **{f"n_{kind}": [sum(s[2] == kind for s in b) for b in base] for kind in KINDS},
            "base_sha256": [sha256(joined(b).encode()).hexdigest() for b in base],
            "spans": [joined(b + a) for b, a in zip(base, added)],
            "n_added": [len(a) for a in added],
        }

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_rows(doc_texts(documents), search, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with ``<secret>`` in the place of each span, or of spans that overlap."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], "<secret>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(documents: DataFrame) -> DataFrame:
    """The documents without their secrets. Null texts stay null, all other columns pass unchanged; cases are as in ``find``."""
    field = train(training_rows(documents))
    column = fresh(documents, "redacted_text")

    def cover(texts: list) -> dict[str, list]:
        plain = [text or "" for text in texts]
        base = [base_spans(text) for text in plain]
        added = added_spans(plain, base, field)
        return {column: [text and redacted(text, b + a) for text, b, a in zip(texts, base, added)]}

    covered = with_arrow_columns(documents, "text", cover, {column: "string"})
    return covered.withColumn("text", F.col(column)).select(*documents.columns)
