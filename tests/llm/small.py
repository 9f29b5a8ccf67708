"""Small documents for the tests of this folder."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = ("kept", "block", "row", "group", "class", "n", "size", "shard", "weight", "whole", "keep_id", "l_id", "at", "slice", "tokens", "id")


def words_of(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared passages, repeated lines and odd white space."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdeéßx") for _ in range(pick.randint(1, 6))) for _ in range(200)]

    def text(size):
        return "".join(pick.choice(vocabulary).capitalize() if pick.random() < .2 else pick.choice(vocabulary)
                       for _ in range(1)) + "".join(pick.choice((" ", " ", " ", "\n", "\t", "  ", " ", ". ")) + pick.choice(vocabulary) for _ in range(size - 1))

    shared = text(60)
    out = []
    for i in range(n):
        kind = i % 6
        body = text(pick.randint(1, 150))
        if kind == 1 and out:
            body = out[pick.randrange(len(out))][1]
        elif kind == 2 and out:
            parts = out[pick.randrange(len(out))][1].split(" ")
            parts[pick.randrange(len(parts))] = "edit"
            body = " ".join(parts)
        elif kind == 3:
            body = body + " " + shared + "\n" + body
        elif kind == 4:
            body = body.upper() + "!!"
        out.append((i, body, pick.choice(("en", "de")), "src%d" % (0 if pick.random() < .5 else i % 5), len(body)))
    return out


def edges():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long = " ".join("w%d" % (i % 5000) for i in range(60_000))
    return [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (4, "one", "en", "a", 3), (4, "one", "en", "a", 3),
            (5, "one", None, "b", 3), (None, "one", "en", "b", 3), (None, None, None, None, None), (6, long, "en", "a", len(long)),
            (7, long, "de", None, len(long)), (8, "One two\x0bthree  four <|endoftext|> five \U0001f600", "fr", "", 1), (9, "one two three four", "en", "c", 1)]


def documents(spark, rows, clashes=True):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3, "n_chars")
    if clashes:
        from pyspark.sql import functions as F
        frame = frame.withColumns({c: F.lit(c) for c in CLASHES})
    return frame


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", "") for x in r))
