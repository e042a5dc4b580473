"""Small documents with every quirk the operators must bear."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghijklmnop") + rng.choice("aeiouéß") + rng.choice(["n", "r", "st", "ng"]) + str(rng.randrange(vocabulary)) for _ in range(n))


def odd_rows():
    """(doc_id, text, lang, source, n_chars): copies, near copies, nulls, ties, repeated rows,
    empty, blank, very long and non-Latin texts."""
    long = prose(1, 60)
    near = long.split()
    near[3] = "changed"
    rows = [
        (1, long, "en", "a"), (2, long, "en", "b"), (3, " ".join(near), "en", "a"), (4, None, None, None),
        (5, "", "en", "a"), (6, " \t\n\x0b ", "de", "b"), (7, "Word", "en", None), (8, "word", "fr", "a"),
        (9, prose(2, 12_000, 5_000), "en", "b"), (10, "日本語 テキスト " * 30, "ja", "c"), (11, "x" * 3_000, "en", "c"),
        (12, prose(3, 30) + "\n" + prose(4, 8) + "\n" + prose(4, 8), "de", "a"), (12, prose(3, 30) + "\n" + prose(4, 8) + "\n" + prose(4, 8), "de", "a"),
        (None, prose(5, 40), "en", "c"), (14, prose(6, 25) + " " + " ".join(long.split()[20:45]), "en", "b"),
        (15, "a b c d e f g h " * 10, "en", "c"), (16, " nbsp　wide\x00nul\x1cfs ünï " + prose(7, 22), "es", "a"),
        (17, "### *** $$$ <b>&amp;</b> " * 12, "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def odd(spark):
    return frame(spark, odd_rows())


def none(spark):
    return frame(spark, [])


def clashing(df):
    """The frame with further columns whose names an operator might use itself."""
    for name in ("fp", "size", "n", "chunk", "bucket", "unit", "shard", "row", "tokens", "_text", "_row", "kept", "pair", "group", "draw"):
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def table(df, *names):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
