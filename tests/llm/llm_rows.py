"""Rows that the tests of this folder share."""

SMALL = "/root/testdata/sf0.001"
#: Null, empty, blank, short, repeated and very long texts; ids with gaps and a null.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "a b c d e f g h"),
    (5, "a b c d e f g h"),
    (6, "Ünï côdé 日本語 \U0001f642 <|endoftext|>"),
    (7, "word " * 20_000),
    (None, "no id at all"),
]
