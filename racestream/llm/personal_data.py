"""Personal data in texts: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field labels tokens with B/I tags of five kinds, those of the patterns and secrets, or as outside. Its features are the
shapes of a token and of its two neighbours, and the nearest of some cue words before it. It is trained on a small labelled table:
the examples and filled templates below, and segments from a bounded sample of the documents, labelled by the patterns where those
can tell. Tokens without a digit or an ``@`` are outside by definition, so a text falls into short chains between them, and the
best labels of each (Viterbi) are exact for the whole text. Chains of similar length are decoded together in numpy. What the field
finds is checked last: a card has to pass Luhn, an address has four parts up to 255, and so on (``is_possible``).
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream.llm.tables import doc_texts, fresh, map_rows, with_arrow_columns

KINDS = ["email", "ip", "card", "phone"]
#: All kinds of spans; the patterns know nothing of the last one.
FOUND = [*KINDS, "secret"]
LABELS = ["O", *(f"{tag}-{kind}" for kind in FOUND for tag in "BI")]

#: Documents, and segments of them, that train the field, besides the examples.
SAMPLE_DOCS = 2_000
SAMPLE_SEGMENTS = 5_000
LONGEST_TRAINED = 32

#: Labelled examples. Braces hold one span each, of the kind before the colon.
EXAMPLES = [
    "call {phone:(555) 010-7788} before noon",
    "fax {phone:(030) 555-0199} is open",
    "ring {phone:555-010-9922} or write",
    "desk {phone:212-555-0147} and desk {phone:415-555-0132}",
    "tel. {phone:020 7946 0958} today",
    "reach us on {phone:+44 20 7946 0018} in London",
    "or {phone:+1 (555) 010-4477}, ask for Jo",
    "write to {email:josé.núñez@correo.example} now",
    "mail {email:jürgen@müller.example} or {email:ann.lee@site.example.org}",
    "from {email:zoë22@località.example} with thanks",
    "please write {email:noël@été.example}",
    "{email:ada@site.example.org}",
    "mail or write to {email:søren.k@øre.example}",
    "{email:ana@peña.example}, {email:bo@site.example.org}; {email:åse@site.example}.",
    "host {ip:10.20.30.40} answered, {ip:192.168.1.77} did not",
    "paid by {card:4111 1111 1111 1111} in May",
    "card {card:5500000000000004} and {card:3400-0000-0000-009} on file",
    "order 4111111111111112 was shipped",
    "two {card:4012888888881881} {card:5105105105105100} on file",
    "the {card:30569309025904} {card:6011111111111117} were paid",
    "numbers {card:4111111111111111} {card:5555555555554444} and {card:4222222222222}",
    "ticket 1234567890123456 and 99887766554433221 closed",
    "on 2021-03-04 and 04-03-2021 at 12:30",
    "from 1999 to 2004, 12 of 30 came",
    "version 2.10.4 after 1.9 and 3.0.0.1234",
    "at 3.14, 2,718 and 100,000.50 each",
    "price 19.99 - 24.99 (save 10%)",
    "pages 12-18 and 101-110, figure (3) of 7",
    "sections 1.2.3 and (12) 100-200 in part 4",
    "key a9f83b2c11d04e77 and id 550e8400-e29b-41d4",
    "@home and user@ and 5@2 left",
    "room 101, floor 3, block 12-B",
    "item 978-3-16-148410-0 in stock",
    "score 3-1, 21-15, 30-28 after 90 minutes",
    "ref 2023/114-77 of 12.05.2023",
    "isbn 0-306-40615-2 and year (1984) 12",
    "1 2 3 4 5 6 7 8 9 10 11 12",
    "chapter 20 1946 0958 lines",
]

#: Templates of more examples. A bracket is filled by ``_filling`` with a new value each time.
TEMPLATES = [
    'token = "{secret:[hex]}" was set',
    'and token = "{secret:[hex]}" in it',
    "token: {secret:[mixed]} is old",
    "the password is {secret:[short]} for now",
    "password: {secret:[short]}",
    "passwd={secret:[short]} and go",
    "api key {secret:[mixed]} expires",
    "set api_key = '{secret:[mixed]}'.",
    "SECRET={secret:[mixed]} in the shell",
    'secret = "{secret:[hex]}", card {card:4111111111111111}',
    "Authorization: Bearer {secret:[mixed]}",
    "access key {secret:[mixed]}, mail {email:ann.lee@site.example.org}",
    "credentials {secret:[mixed]} of host {ip:10.20.30.40}",
    "phone {phone:0[d] [dd] [dd] [dd] [dd]} or later",
    "téléphone {phone:0[d] [dd] [dd] [dd] [dd]}",
    "tel {phone:0[ddd]-[ddddddd]} before five",
    "call {phone:0[ddd]/[ddddddd]}",
    "mobile {phone:6[dd] [ddd] [ddd]} or mail",
    "telefon {phone:(0[ddd]) [dddddd]}, room [dd]",
    "call {phone:([ddd]) [ddd]-[dddd]} now",
    "phone {phone:[ddd]-[ddd]-[dddd]}, fax {phone:[ddd]-[ddd]-[dddd]}",
    "phone {phone:[ddd].[ddd].[dddd]} please",
    "commit [hex] by them",
    "sha256 [hex] of the file",
    'checksum = "[hex]" holds',
    'etag "[hex]" and id [mixed]',
    "digest: [hex]",
    "file [mixed] of [dd] parts",
    "model [short] of 20[dd]",
    "version [d].[dd].[d] of [short]",
    "table [dd] [dd] [dd] [dd] [dd]",
    "order [ddddddd] of [dd].[dd].20[dd]",
    "isbn [ddd]-[d]-[ddd]-[ddddd]-[d]",
    "part [ddd]-[ddd]-[dddd] in stock",
    "pages [ddd]-[ddd], [dd] in all",
    "area 0[d] [dd] km of [dd] [ddd]",
    "in [dddd] and [dddd] came [dd] [ddd]",
]

#: Words that tell what a number or a code is; a token's feature is the nearest one among a few tokens before it.
CUES = frozenset(
    "access address api_key apikey area authorization bearer call card checksum code commit credentials desk digest email etag fax "
    "file hash host id in ip isbn item key mail md5 mobile model order pages paid part passwd password phone price ref reference "
    "ring secret server sha1 sha256 table tel telefon teléfono telephone téléphone ticket token uuid version write".split()
)
CUE_REACH = 3


# Patterns

_MARK = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    # From each @ outwards: no text is scanned twice, where a search from the left is quadratic on a long run.
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                floor = domain.end()
                found.append((start, floor))
        at = text.find("@", max(at + 1, floor))
    return found


def is_address(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def is_card(digits: str) -> bool:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of the fixed patterns, by kind, in code points."""
    if not _MARK.search(text):
        return {kind: [] for kind in KINDS}
    cards = (m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13)
    phones = (m.span() for m in _PHONE.finditer(text))
    return {
        "email": _emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if is_address(m.group().split("."))],
        "card": [(a, b) for a, b in cards if is_card(_NO_DIGIT.sub("", text[a:b]))],
        "phone": [(a, b) for a, b in phones if 9 <= len(_NO_DIGIT.sub("", text[a:b])) <= 15],
    }


# Tokens and their features

_TOKEN = re.compile(r"[^\s=]+|=+")
_BEFORE, _AFTER = "\"'<[{,;:#*$%&|", ".,;:!?\"'>]}#*$%&|"
_RUN = re.compile(r"[^\W_]+")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_shapes: dict[str, tuple[str, ...]] = {}


def _run(run: str, digits: str) -> str:
    if run.isdecimal():
        return digits or str(min(len(run), 9))
    return "a" if not any(map(str.isdecimal, run)) else "h" if _HEX.fullmatch(run) else "x"


def _shape(token: str) -> tuple[str, str]:
    """Runs of digits, letters and both as one character each, and the same with the lengths of digit runs.

    Long shapes stand by their digest.
    """
    shapes = (_RUN.sub(lambda m: _run(m.group(), digits), token) for digits in ("9", ""))
    short, long = (s if len(s) <= 64 else sha256(s.encode()).hexdigest() for s in shapes)
    return short, long


def token_features(token: str) -> tuple[str, ...]:
    """Features of a token by itself; remembered, as few tokens make most of those with a digit."""
    known = _shapes.get(token)
    if known is None:
        core = token.strip(_BEFORE + _AFTER)
        short, long = _shape(core)
        digits = _NO_DIGIT.sub("", core)
        known = (
            f"s={short}",
            f"l={long}",
            f"n={min(len(digits), 20)}",
            f"at={'@' in core and not core.startswith('@') and '.' in core.rpartition('@')[2].strip('.')}",
            f"size={min(len(core).bit_length(), 8)}",
            f"end={token[-1] in _AFTER}",
        )
        if len(_shapes) < 100_000 and len(token) <= 64:
            _shapes[token] = known
    return known


def _context(token: str | None) -> str:
    return "" if token is None else _shape(token.strip(_BEFORE + _AFTER))[1] if _MARK.search(token) else "a"


def _cue(before: list[str]) -> str:
    """The nearest cue word among the last tokens, without outer signs."""
    for token in reversed(before):
        word = token.strip(_BEFORE + _AFTER + "(").lower()
        if word in CUES:
            return word
    return ""


@dataclass
class Segment:
    """Neighbouring tokens that each hold a digit or an @: their spans without outer punctuation, and their features."""

    spans: list[Span]
    features: list[tuple[str, ...]]


def segments(text: str) -> list[Segment]:
    if not _MARK.search(text):
        return []
    tokens = [(m.start(), m.group()) for m in _TOKEN.finditer(text)]
    found: list[Segment] = []
    last = -2
    for i, (start, token) in enumerate(tokens):
        if not _MARK.search(token):
            continue
        if i != last + 1:
            found.append(Segment([], []))
        last = i
        core_start = start + len(token) - len(token.lstrip(_BEFORE))
        core_end = start + len(token.rstrip(_AFTER))
        before = _context(tokens[i - 1][1] if i else None)
        after = _context(tokens[i + 1][1] if i + 1 < len(tokens) else None)
        features = token_features(token)
        cue = _cue([t for _, t in tokens[max(0, i - CUE_REACH) : i]])
        context = (f"p={before}", f"f={after}", f"ps={before}|{features[0]}", f"sf={features[0]}|{after}", f"w={cue}")
        context += (f"ws={cue}|{features[0]}", f"wl={cue}|{features[1]}")
        found[-1].spans.append((core_start, max(core_start, core_end)))
        found[-1].features.append(features + context)
    return found


def labelled(segment: Segment, spans: dict[str, list[Span]]) -> list[str]:
    """The tag of each token under given spans."""
    tags = []
    for start, end in segment.spans:
        tag = "O"
        for kind in FOUND:
            for a, b in spans.get(kind, ()):
                if start < b and end > a:
                    tag = f"{'B' if start <= a or not tags or not tags[-1].endswith(kind) else 'I'}-{kind}"
        tags.append(tag)
    return tags


def _parsed(example: str) -> tuple[str, dict[str, list[Span]]]:
    spans: dict[str, list[Span]] = {kind: [] for kind in FOUND}
    text = ""
    for plain, kind, inside in re.findall(r"([^{]*)(?:\{(\w+):([^}]*)\})?", example):
        text += plain
        if kind:
            spans[kind].append((len(text), len(text) + len(inside)))
            text += inside
    return text, spans


_SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _filling(name: str, pick: random.Random) -> str:
    """A value for a bracket of a template: a hexadecimal code, letters and digits, a short such word, or digits."""
    if name == "hex":
        return "".join(pick.choices("0123456789abcdef", k=pick.choice([32, 40, 64])))
    if name == "mixed":
        return pick.choice(["", "", "sk_live_", "ghp_"]) + "".join(pick.choices(_SIGNS, k=pick.randint(20, 40))) + pick.choice("0123456789")
    if name == "short":
        return "".join(pick.choices("abcdefghkmnprstuvw", k=pick.randint(5, 9))) + str(pick.randint(0, 999)) + pick.choice(["", "x", "Q"])
    return "".join(pick.choices("0123456789", k=len(name)))


def filled(templates: list[str], times: int, seed: int) -> list[str]:
    pick = random.Random(seed)
    fill = lambda m: _filling(m.group(1), pick)
    return [re.sub(r"\[(hex|mixed|short|d+)\]", fill, template) for _ in range(times) for template in templates]


# The field

_N = len(LABELS)
_FORBIDDEN = np.zeros((_N, _N))
for _to, _label in enumerate(LABELS):
    if _label[0] == "I":
        for _from, _other in enumerate(LABELS):
            if _other not in (_label, f"B-{_label[2:]}"):
                _FORBIDDEN[_from, _to] = -1e4


@dataclass
class Field:
    """Weights of features by label (the last row is for unknown features, zero) and of transitions."""

    columns: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def ids(self, features: list[tuple[str, ...]]) -> np.ndarray:
        unknown = len(self.columns)
        return np.array([[self.columns.get(f, unknown) for f in token] for token in features])

    def decode(self, chains: list[list[tuple[str, ...]]]) -> list[np.ndarray]:
        """The best labels of each chain; chains whose lengths round up to the same power of two go together."""
        best: list = [None] * len(chains)
        groups: dict[int, list[int]] = {}
        for i, chain in enumerate(chains):
            groups.setdefault((len(chain) - 1).bit_length(), []).append(i)
        for members in groups.values():
            members.sort(key=lambda i: -len(chains[i]))
            lengths = np.array([len(chains[i]) for i in members])
            scores = np.zeros((lengths[0], len(members), _N))
            for k, i in enumerate(members):
                scores[: lengths[k], k] = self.weights[self.ids(chains[i])].sum(1)
            for i, path in zip(members, viterbi(scores, lengths, self.transitions + _FORBIDDEN)):
                best[i] = path
        return best


def viterbi(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> list[np.ndarray]:
    """Best paths of chains (by falling length) from and to the outside label; scores by step, chain and label."""
    steps, count, _ = scores.shape
    value = transitions[0] + scores[0]
    back = np.zeros((steps, count, _N), np.int8)
    for t in range(1, steps):
        n = int((lengths > t).sum())
        through = value[:n, :, None] + transitions
        back[t, :n] = through.argmax(1)
        value[:n] = through.max(1) + scores[t, :n]
    at = (value + transitions[:, 0]).argmax(1)
    paths = [np.zeros(n, np.int8) for n in lengths]
    for k, n in enumerate(lengths):
        label = at[k]
        for t in range(n - 1, -1, -1):
            paths[k][t] = label
            label = back[t, k, label]
    return paths


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def slopes(
    weights: np.ndarray, transitions: np.ndarray, ids: np.ndarray, gold: np.ndarray, lengths: np.ndarray, times: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of labelled chains, and its gradients by the weights and transitions.

    ``ids`` is steps by chains by features, ``gold`` steps by chains; what lies behind a chain's length does not count, and the
    chain itself counts ``times``.
    """
    longest, n, width = ids.shape
    inside = np.arange(longest)[:, None] < lengths
    chain = np.arange(n)
    trans = transitions + _FORBIDDEN
    scores = weights[ids].sum(2)
    forward = np.empty((longest, n, _N))
    forward[0] = trans[0] + scores[0]
    for t in range(1, longest):
        moved = _log_sum(forward[t - 1][:, :, None] + trans, 1) + scores[t]
        forward[t] = np.where(inside[t][:, None], moved, forward[t - 1])
    total = _log_sum(forward[-1] + trans[:, 0], 1)
    backward = np.empty((longest, n, _N))
    backward[-1] = trans[:, 0]
    for t in range(longest - 2, -1, -1):
        moved = _log_sum(trans + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        backward[t] = np.where(inside[t + 1][:, None], moved, trans[:, 0])
    share = np.exp(forward + backward - total[:, None]) * inside[:, :, None]
    error = -share
    steps, members = np.nonzero(inside)
    error[steps, members, gold[steps, members]] += 1
    error *= times[:, None]
    slope_w = np.empty_like(weights)
    for label in range(_N):
        slope_w[:, label] = np.bincount(ids.reshape(-1), np.repeat(error[:, :, label].reshape(-1), width), len(weights))
    taken = np.zeros((_N, _N))
    np.add.at(taken, (0, gold[0]), times)
    np.add.at(taken, (gold[lengths - 1, chain], 0), times)
    slope_t = taken.copy()
    slope_t[0] -= times @ share[0]
    slope_t[:, 0] -= times @ share[lengths - 1, chain]
    for t in range(1, longest):
        use = inside[t]
        steps_taken = np.zeros((_N, _N))
        np.add.at(steps_taken, (gold[t - 1][use], gold[t][use]), times[use])
        both = forward[t - 1][use][:, :, None] + trans + (scores[t] + backward[t])[use][:, None, :]
        slope_t += steps_taken - np.tensordot(times[use], np.exp(both - total[use][:, None, None]), 1)
        taken += steps_taken
    value = float(times[members] @ scores[steps, members, gold[steps, members]] + (taken * trans).sum() - times @ total)
    return value, slope_w, slope_t


def train(rows: list[tuple[list[tuple[str, ...]], list[str]]], rounds: int = 150, decay: float = 1e-3) -> Field:
    """Fits the field to labelled chains by gradient ascent of their log-likelihood (adaptive steps, fixed order).

    Equal chains are one that counts as often.
    """
    repeats = Counter((tuple(map(tuple, features)), tuple(tags)) for features, tags in rows)
    rows, times = list(repeats), np.array(list(repeats.values()), float)
    columns: dict[str, int] = {}
    for features, _ in rows:
        for token in features:
            for f in token:
                columns.setdefault(f, len(columns))
    field = Field(columns, np.zeros((len(columns) + 1, _N)), np.zeros((_N, _N)))
    if not rows:
        return field
    n, longest = times.sum(), max(len(r[0]) for r in rows)
    ids = np.full((longest, len(rows), len(rows[0][0][0])), len(columns))
    gold = np.zeros((longest, len(rows)), int)
    lengths = np.array([len(r[0]) for r in rows])
    for k, (features, tags) in enumerate(rows):
        ids[: lengths[k], k] = field.ids(features)
        gold[: lengths[k], k] = [LABELS.index(t) for t in tags]
    squares_w, squares_t = np.full_like(field.weights, 1e-8), np.full_like(field.transitions, 1e-8)
    for _ in range(rounds):
        _, slope_w, slope_t = slopes(field.weights, field.transitions, ids, gold, lengths, times)
        slope_w -= decay * n * field.weights
        slope_w[-1] = 0
        slope_t -= decay * n * field.transitions
        squares_w += slope_w**2
        squares_t += slope_t**2
        field.weights += 0.5 * slope_w / np.sqrt(squares_w)
        field.transitions += 0.5 * slope_t / np.sqrt(squares_t)
    return field


def example_rows() -> list[tuple[list[tuple[str, ...]], list[str]]]:
    """The labelled table: examples five times, templates with twelve fillings each."""
    found = []
    for example in EXAMPLES * 5 + filled(TEMPLATES, 12, 11):
        text, spans = _parsed(example)
        found += [(s.features, labelled(s, spans)) for s in segments(text)]
    return found


def patterns_can_tell(text: str, segment: Segment, tags: list[str]) -> bool:
    """Whether outside tokens of a segment are known to be outside: a long code or a valid card may be a span they miss."""
    for (start, end), tag in zip(segment.spans, tags):
        token = text[start:end]
        if tag == "O" and (is_card(_NO_DIGIT.sub("", token)) or (len(token) >= 8 and re.search("[^\\W0-9_]", token))):
            return False
    return True


def training_rows(documents: DataFrame) -> list[tuple[list[tuple[str, ...]], list[str]]]:
    """Segments of the examples, and of a bounded sample of the documents, with their labels.

    The sample takes documents whose hash falls into a share that gives about ``SAMPLE_DOCS`` of them, and of their segments
    the ``SAMPLE_SEGMENTS`` with the least hashes; only those come to the driver. Segments in which the patterns cannot tell what
    is outside are left out.
    """
    texts = doc_texts(documents)
    share = max(1, texts.count() // SAMPLE_DOCS)
    chosen = texts.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(share)) == 0)

    def cut(columns: dict[str, list]) -> dict[str, list]:
        features, tags = [], []
        for text in columns["text"]:
            spans = base_spans(text)
            for segment in segments(text):
                segment = Segment(segment.spans[:LONGEST_TRAINED], segment.features[:LONGEST_TRAINED])
                tag = labelled(segment, spans)
                if patterns_can_tell(text, segment, tag):
                    features.append([list(f) for f in segment.features])
                    tags.append(tag)
        return {"features": features, "tags": tags}

    rows = map_rows(chosen, cut, "features array<array<string>>, tags array<string>")
    sample = rows.orderBy(F.xxhash64("features"), "tags").limit(SAMPLE_SEGMENTS).collect()
    return [([tuple(f) for f in row["features"]], list(row["tags"])) for row in sample] + example_rows()


# Spans of whole texts

def is_possible(kind: str, span: str) -> bool:
    """What a span must be at least, whatever the field says of it."""
    digits = _NO_DIGIT.sub("", span)
    if kind == "card":
        return is_card(digits)
    if kind == "ip":
        return is_address(span.split(".")) if re.fullmatch("[0-9]+(?:[.][0-9]+){3}", span) else False
    if kind == "phone":
        return 7 <= len(digits) <= 15 and not re.search("[^\\W0-9_]", span)
    if kind == "email":
        local, _, domain = span.rpartition("@")
        return bool(local) and "." in domain.strip(".")
    return len(span) >= 8 and bool(re.search("[^\\W0-9_]", span))


def added_spans(texts: list[str], base: list[dict[str, list[Span]]], field: Field) -> list[dict[str, list[Span]]]:
    """What the field finds in each text beside the base spans; nothing that overlaps one of them."""
    added: list[dict[str, list[Span]]] = [{kind: [] for kind in FOUND} for _ in texts]
    owners, chains = [], []
    for i, text in enumerate(texts):
        for segment in segments(text):
            owners.append((i, segment))
            chains.append(segment.features)
    for (i, segment), path in zip(owners, field.decode(chains)):
        taken = [span for kind in KINDS for span in base[i][kind]] if path.any() else []
        for kind, start, end in _decoded(segment, path):
            if is_possible(kind, texts[i][start:end]) and not any(start < b and end > a for a, b in taken):
                added[i][kind].append((start, end))
    return added


def _decoded(segment: Segment, path: np.ndarray) -> list[tuple[str, int, int]]:
    found: list[tuple[str, int, int]] = []
    for (start, end), label in zip(segment.spans, path):
        if label and end > start:
            kind = LABELS[label][2:]
            if LABELS[label][0] == "I" and found and found[-1][0] == kind:
                found[-1] = (kind, found[-1][1], end)
            else:
                found.append((kind, start, end))
    return found


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in FOUND for a, b in sorted(spans.get(kind, ())))


def find(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: numbers of base spans, their digest, and all spans as text.

    A null or empty text has none. Repeated rows are reported each time, further columns are ignored, and an empty table
    gives an empty one. The field is trained first, from the same documents.
    """
    field = train(training_rows(documents))

    def search(columns: dict[str, list]) -> dict[str, list]:
        texts = columns["text"]
        base = [base_spans(text) for text in texts]
        added = added_spans(texts, base, field)
        both = [{kind: b.get(kind, []) + a[kind] for kind in FOUND} for b, a in zip(base, added)]
        return {
            "doc_id": columns["doc_id"],
            **{f"n_{kind}": [len(b[kind]) for b in base] for kind in KINDS},
            "base_sha256": [sha256(joined(b).encode()).hexdigest() for b in base],
            "spans": [joined(spans) for spans in both],
            "n_added": [sum(map(len, a.values())) for a in added],
        }

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_rows(doc_texts(documents), search, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def masked_text(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first covers all."""
    every = sorted((a, b, kind) for kind in FOUND for a, b in spans[kind])
    out, at, covered = [], 0, 0
    for a, b, kind in every:
        if a >= covered:
            out += [text[at:a], f"<{kind}>"]
        covered = at = max(b, covered)
    return "".join(out) + text[at:]


def mask(documents: DataFrame) -> DataFrame:
    """The documents with personal data in ``text`` masked, and ``n_chars``, where there is one, counted anew.

    Null texts stay null. All other columns pass unchanged.
    """
    field = train(training_rows(documents))
    column = fresh(documents, "masked_text")

    def cover(texts: list) -> dict[str, list]:
        plain = [text or "" for text in texts]
        base = [base_spans(text) for text in plain]
        added = added_spans(plain, base, field)
        both = [{kind: b.get(kind, []) + a[kind] for kind in FOUND} for b, a in zip(base, added)]
        return {column: [text and masked_text(text, spans) for text, spans in zip(texts, both)]}

    covered = with_arrow_columns(documents, "text", cover, {column: "string"}).withColumn("text", F.col(column))
    if "n_chars" in documents.columns:
        changed = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        covered = covered.withColumn("n_chars", changed.cast(documents.schema["n_chars"].dataType))
    return covered.select(*documents.columns)
