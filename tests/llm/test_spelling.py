from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import queries as Q
from lakeloom.llm import spelling as S
from lakeloom.session import table
from tests.llm.data import LOWER, clashing, frame, none, odd, odd_rows
from tests.llm.data import table as rows_of


def slow_edit(a, b):
    """One insertion, deletion or replacement, tried at every place."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(n, ratio=5):
    near = {w: [x for x in n if slow_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w] and n[best] > n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def slow_words(docs, shortest=6, least=5, every=199):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def vocabulary(seed, size=260):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(size)}
    words |= {"", "é", "日本語", "日本", "𝒳a", "a" * 300, "a" * 301, "a" * 299 + "b", "x" * 70, "x" * 69 + "y"}
    return {w: rng.choice([0, 1, 2, 5, 10, 25, 50, 130]) for w in sorted(words)}


@pytest.mark.parametrize("node_words", [4096, 40, 3])
def test_variants_by_brute_force(spark, node_words):
    """With a small limit the trie is cut into many nodes, down to its leaves and below."""
    n = vocabulary(node_words)
    given = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(S.variants(given, node_words=node_words), *COLUMNS) == slow_variants(n)


def test_many_words_with_one_vector(spark):
    """All orders of the same letters share one vector: a leaf of more words than a task may hold."""
    n = {"".join(p): i % 40 for i, p in enumerate(itertools.permutations("abcdef"))}
    n |= {w[1:]: 200 for w in list(n)[::7]}
    given = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(S.variants(given, node_words=50), *COLUMNS) == slow_variants(n)


def test_long_chain_of_forms(spark):
    n = {"abcdefgh"[:k] + "x" * 3: 5 ** (9 - k) for k in range(1, 9)}
    out = rows_of(S.variants(spark.createDataFrame(list(n.items()), "word string, n long")), *COLUMNS)
    assert out == slow_variants(n) and len({r[2] for r in out}) == 1


def test_pairs_by_brute_force():
    rng = random.Random(3)
    words = ["".join(rng.choice("abß") for _ in range(rng.randint(0, 6))) for _ in range(120)] + ["q" * 65, "q" * 66, "q" * 64]
    words = sorted(set(words))
    letters = S.Letters(words)
    a, b = (np.array(x) for x in zip(*itertools.product(range(len(words)), repeat=2), strict=True))
    assert letters.near(a, b).tolist() == [slow_edit(words[i], words[j]) for i, j in zip(a, b, strict=True)]
    assert [S.one_edit(words[i], words[j]) for i, j in zip(a, b, strict=True)] == letters.near(a, b).tolist()


def test_odd_and_empty_tables(spark):
    repeated = spark.createDataFrame([("spelling", 3), ("spelling", 4), ("speling", None), (None, 9), ("spellings", 1)], "word string, n long")
    assert rows_of(S.variants(repeated.selectExpr("*", "1 AS node", "2 AS part", "3 AS best", "4 AS root")), *COLUMNS) == slow_variants(
        {"spelling": 7, "speling": 0, "spellings": 1})
    assert S.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    docs = [(r[0], r[1]) for r in odd_rows()]
    counted = S.count_words(clashing(odd(spark)), "A-Za-zÀ-ÿ", 2, 1, 7)
    assert {r["word"]: r["n"] for r in counted.collect()} == slow_words(docs, 2, 1, 7)
    assert S.count_words(none(spark), "A-Za-zÀ-ÿ", 6, 5, 199).count() == 0


def test_word_runs(spark):
    texts = ["Abc×déf÷ÿÀ Zebra-ZEBRA zebra'sĀx¿ÀÉ" * 3, "naïve NAÏVE naıve", "a1b2cdefgh"]
    docs = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    for every in (2, 199):
        got = S.count_words(docs, "A-Za-zÀ-ÿ", 3, 1, every)
        assert {r["word"]: r["n"] for r in got.collect()} == slow_words(list(enumerate(texts)), 3, 1, every)


def test_query_by_brute_force(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    assert rows_of(Q.QUERIES["op13_spelling_variants"](spark, data), *COLUMNS) == slow_variants(slow_words(docs))
