"""Awkward texts shared by the tests."""

LONG = "lorem ipsum dolor " * 4000
#: Nulls, empty and blank texts, ties, repeats, very long ones, control characters, no letters.
ODD = [None, "", " \n\t ", "a", "a", "A a a a a a a", LONG, "é ñ ß", "12 34 !!", "\x00\x1c x", "word", "the the\nthe the\n\nthe the"]
