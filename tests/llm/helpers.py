"""Small tables and plain-Python counterparts for the tests of tillroll.llm."""

from __future__ import annotations

import random
import re

FIELDS = "doc_id long, text string"
# names that the operators use inside, to show that a table may have them as well
CLASHING = "row long, key string, size long, sequence_id long, text_hash string, n double"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def table(spark, rows, extra=True):
    """Rows of (doc_id, text), with further columns of clashing names."""
    if not extra:
        return spark.createDataFrame(rows, FIELDS)
    wide = [(*r, 1, "k", 2, 3, "h", 0.5) for r in rows]
    return spark.createDataFrame(wide, f"{FIELDS}, {CLASHING}")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in SPACE.split(lowered(text)) if w]


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def prose(seed, count, vocabulary=3000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(count)]


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, "one"),
    (5, "two words"),
    (6, " ".join(prose(6, 9000))),
    (7, "Same text, given twice. " * 3),
    (7, "Same text, given twice. " * 3),
    (8, "Same text, given twice. " * 3),
    (None, "a row without an id"),
    (None, None),
    (9, "né à l'île — 東京 \U0001f600 <|endoftext|> \x00 end"),
]
