from __future__ import annotations

import random
import re

import numpy as np

from lakeloom.llm import decontaminate as D
from tests.llm.data import LOWER, clashing, frame, none, odd, odd_rows, prose, table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def split(text):
    return WORDS.findall((text or "").translate(LOWER))


def slow(docs, items, window=10):
    """(words, hit places, items) of each text by comparing every window."""
    windows = {}
    for name, text in items:
        w = split(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(name)
    sizes = {len(k) for k in windows}
    found = []
    for text in docs:
        w, hit, names = split(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    names |= windows[tuple(w[i:i + k])]
        found.append((len(w), sorted(hit), names))
    return found


def test_random_streams():
    rng = random.Random(5)
    for trial in range(150):
        letters = "ab" if trial % 2 else "abcdef"
        text = lambda n: " ".join(rng.choice(letters) for _ in range(n))  # noqa: E731, B023
        items = [(str(i), text(rng.randint(0, 9))) for i in range(rng.randint(0, 6))]
        docs = [text(rng.randint(0, 25)) for _ in range(5)]
        window = rng.randint(1, 5)
        made = D.build([(n, t.encode()) for n, t in items], window)
        got = [(n, hit.tolist(), names) for n, hit, names in D.scan_texts(made, [d.encode() for d in docs])]
        assert got == slow(docs, items, window), (items, docs, window)


def test_longest_matching_lengths():
    made = D.build([("x", b"a b c d"), ("y", b"c d e")], 10)
    ids = [made.vocabulary.get(w, -1) for w in b"b c d e a z c d".split()]
    assert [size for _, _, size in made.matches(ids)] == [1, 2, 3, 3, 1, 0, 1, 2]


def bench(spark):
    long = odd_rows()[0][1]
    return frame(spark, [(10, " ".join(long.split()[5:30])), (11, "Word"), (12, ""), (13, None), (None, "日本語 テキスト"), (14, "x b  y"), (10, "word")], ITEMS)


def test_match_by_brute_force(spark):
    rows = odd_rows()
    items = [(str(r["item_id"]) if r["item_id"] is not None else None, r["text"]) for r in bench(spark).collect()]
    want = sorted([(r[0], n, len(hit), sorted(i for i in names if i is not None))
                   for r, (n, hit, names) in zip(rows, slow([r[1] for r in rows], items), strict=True)], key=str)
    got = D.match(clashing(odd(spark)), bench(spark))
    assert table(got, "doc_id", "n_words", "n_hit", "items") == want
    assert all(sum(b - a + 1 for a, b in r["spans"]) == r["n_hit"] for r in got.collect())


def test_passages_are_cut_out(spark):
    passage = prose(20, 15)
    rows = [(1, f"{prose(21, 30)}, {passage}! {prose(22, 30)}", "en", "a", 5), (2, passage, "en", "a", 5),
            (3, prose(23, 40), "en", "a", 5), (4, None, "en", "a", None), (5, "", "en", "a", 0)]
    docs = clashing(frame(spark, rows))
    out = D.decontaminate(docs, frame(spark, [(1, passage)], ITEMS))
    assert out.schema == docs.schema
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert got[1]["text"] == f"{prose(21, 30)}, ! {prose(22, 30)}"
    assert got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] == rows[2][1] and got[3]["n_chars"] == 5 and got[4]["text"] is None


def test_cut_words_keeps_the_rest():
    assert D.cut_words("Añ b-c. D!".encode(), np.array([1, 2])).decode() == "Añ . D!"


def test_empty_tables(spark):
    items = frame(spark, [], ITEMS)
    assert D.match(none(spark), bench(spark)).count() == 0
    assert [r["n_hit"] for r in D.match(odd(spark), items).collect()] == [0] * len(odd_rows())
    assert D.decontaminate(odd(spark), items).count() == len(odd_rows())


def test_items_beyond_the_limit_are_refused(spark):
    try:
        D.automaton_of(frame(spark, [(1, "a b c d e f")], ITEMS), max_words=2)
    except ValueError as error:
        assert "in parts" in str(error)
    else:
        raise AssertionError


def test_items_of_equal_words_take_linear_time():
    import time
    text = b"same " * 40_000
    start = time.time()
    made = D.build([("a", text), ("b", b"same " * 30_000 + b"other " * 12)])
    hit, items = made.scan([made.vocabulary[w] for w in D.words_of(text)])
    assert hit.all() and items == {"a", "b"} and time.time() - start < 20
