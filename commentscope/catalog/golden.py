"""Hand-made comments that reach the branches the driver tables do not (ids are negative)."""

GOLDEN: list[tuple[int, str]] = [
    (-1, "Hello world"),
    (-2, ""),
    (-3, "   "),
    (-4, "STOP!!! Why?? (really...)"),
    (-5, "It's here:\r\nsee https://a.example/x?y=1 and www.b.example now"),
    (-6, "Café déjà vu 😀😀 ok"),
    (-7, "mail me at a.b@c.example from 10.0.0.1"),
    (-8, " 12:30, 5 March 2010 and 12 août 2020"),
    (-9, "a b c a b"),
    (-10, "one two two three three three"),
    (-11, "say \"\"quoted\"\" \\\\ [[link]] --> end"),
    (-12, "line1\nline2\r\nline3\ttab"),
    (-13, "Don't SHOUT at ME you're loud"),
    (-14, "x"),
]

# Texts that a file format may change (ids are negative).
EDGES: list[tuple[int, str | None]] = GOLDEN + [
    (-51, "  lead and trail  "),
    (-52, "tab\tend\t"),
    (-53, None),
    (-54, "a,b;\"c\",'d'"),
    (-55, "\n starts with a line end"),
]

# (doc_id, source, text, toxic, quality) of labelled texts without characters or words (ids are negative).
LABELLED_EDGES: list[tuple[int, str, str | None, int, int]] = [
    (-61, "edge", "", 1, 0),
    (-62, "edge", None, 0, 1),
    (-63, "edge", "Why NOT?!", 1, 1),
    (-64, "edge", " ", 0, 0),
    (-65, "edge", "", 0, 1),
]
