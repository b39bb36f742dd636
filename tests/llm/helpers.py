"""Awkward tables and plain reimplementations."""

import random
import re

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(f"[^{SPACES}]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def awkward(spark, extra=""):
    """Nulls in every column, empty, odd and long texts, repeated rows and ids."""
    long = "lorem ipsum dolor " * 4000
    texts = ["one two three four five six", "", None, "   \n\t ", "a", "One Two Three Four five six", "ünï cödé – 日本語 🙂 text here",
             "one two three four five six", "x\x1cy\x85z\xa0w end", long, long, "same line\nsame line\nsame line\nother"]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[0], (0, "another text of the same id here", "en", None, 1), (50, "no lang or source", None, None, None),
             (None, "no id at all", "en", "s0", 3)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, DOCS + extra), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)
