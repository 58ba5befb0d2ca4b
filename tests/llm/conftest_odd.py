"""Rows that every operator must bear: nulls, blanks, ties, repeats, long and odd texts."""

ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n", None, None),
    (None, "one two three four five six seven eight nine ten eleven", "en", None),
    (4, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (4, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (4, "another text under the same id with enough words to be read as a text", None, "b"),
    (5, "Größe ÉTÉ été ▁ x  y \U0001f600 <s> </s> é́", "fr", "b"),
    (6, "word " * 30_000, "en", "c"),
    (7, "x" * 200_000, "de", "c"),
]
