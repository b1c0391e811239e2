"""Texts and rows that the tests of the training-data operators share."""


def prose(n: int, seed: int = 0, words: int = 400) -> str:
    """Text without repetition worth mentioning, from an invented vocabulary."""
    letters = str.maketrans("0123456789", "ghijklmnop")
    value, out = seed * 7919 + 12345, []
    for _ in range(n):
        value = (value * 1103515245 + 12345) % 2**31
        start = "aeiou"[value % 5] + "bdfgklmnprst"[value // 7 % 12] + "aeiou"[value // 97 % 5]
        out.append(start + f"{value // 1009 % words:x}".translate(letters))
    return " ".join(out)


#: Rows that every operator on documents has to take: nulls, empty and odd texts, repeated rows, a very long text.
HARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (None, "a row without an id"),
    (None, None),
    (4, prose(60, 1), None, None),
    (4, prose(60, 1), None, None),
    (5, prose(60, 1)),
    (6, "x" * 100_000),
    (7, prose(30_000, 2)),
    (8, "é ü ñ   \x1c 漢字 🙂 <|endoftext|> 'll  two   three\n\n "),
]

#: Columns that clash with those of results and intermediate steps.
CLASHING = {"kept": True, "n_words": 5, "component_id": 3, "set_id": "s", "rule_counts": 1, "mix": 2, "copies": 7, "bucket": 1, "length": 2}
