"""Texts that the tests of this folder share."""

import random


def words(seed, n, letters="abcdefghij"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


#: NULL, empty, white, one word, ties, repeated rows, and a very long text.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (None, words(1, 60)), (6, words(1, 60)), (6, words(1, 60)),
    (7, words(1, 59) + " other"), (8, words(2, 40_000)), (9, "x" * 300_000), (10, "Straße ünï ẞ 日本語 " * 20),
]
