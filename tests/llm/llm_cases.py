"""Rows that every operator must take."""

#: Nulls, empty texts, no words, repeats, ties, a missing id, one unbroken word, a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (5, "same words in the same order here and there and so on for a while"),
    (6, "same words in the same order here and there and so on for a while"),
    (6, "same words in the same order here and there and so on for a while"),
    (None, "same words in the same order here and there and so on for a while"),
    (7, "x" * 30_000),
    (8, " ".join(f"w{i % 977}" for i in range(20_000))),
    (9, "é ß Ω 漢字   x\u0085y " * 30),
]
