from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloom.llm import ngram_model as M
from lakeloom.llm import quality as Q
from tests.llm.data import clashing, frame, none, odd, odd_rows, prose, words


def slow_measures(text):
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_measures_by_definition():
    for _, text, *_ in odd_rows():
        assert Q.measures((text or "").encode()) == slow_measures(text or "")
    assert Q.measures(b"a b c d e f g h a b c d e f g h x")[4] == 16


def slow_model(texts):
    """Modified Kneser-Ney over folded bytes, by the book: (four-gram) -> probability."""
    grams = Counter()
    for text in texts:
        s = bytes(M.ORDER - 1) + text.translate(M.FOLD)
        grams.update(s[i:i + M.ORDER] for i in range(len(s) - M.ORDER + 1))
    tables = [dict(grams)]
    for _ in range(M.ORDER - 1):
        lower = Counter()
        for gram in tables[0]:
            lower[gram[1:]] += 1
        tables.insert(0, dict(lower))

    def discount(table):
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return [0, 0.5, 0.75, 0.9]
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))]

    discounts = [discount(t) for t in tables]
    totals, lost = [], []
    for table, d in zip(tables, discounts, strict=True):
        total, off = defaultdict(int), defaultdict(float)
        for gram, n in table.items():
            total[gram[:-1]] += n
            off[gram[:-1]] += d[min(n, 3)]
        totals.append(total)
        lost.append(off)

    def p(gram):
        k = len(gram) - 1
        lower = p(gram[1:]) if k else 1 / M.SYMBOLS
        total = totals[k].get(gram[:-1], 0)
        if not total:
            return lower
        n = tables[k].get(gram, 0)
        return (n - discounts[k][min(n, 3)]) / total + lost[k][gram[:-1]] / total * lower

    return p


def test_model_by_the_book(spark):
    texts = [prose(i, 30, 9).encode() for i in range(6)]
    model = M.train(frame(spark, [(i, t.decode(), "en", "a", 1) for i, t in enumerate(texts)]))
    p = slow_model(texts)
    for probe in (texts[0], "Über ### zzz 99".encode(), b"", b"\xf0\x9f\x98\x80"):
        s = bytes(M.ORDER - 1) + probe.translate(M.FOLD)
        want = -sum(math.log(p(s[i:i + M.ORDER])) for i in range(len(s) - M.ORDER + 1))
        got = model.log_loss([probe], np.array([M.LANGUAGES.index("en")]))[0] / M.UNIT
        assert abs(got - want) < 1e-4 * (1 + len(probe))


def test_probabilities_sum_to_one(spark):
    texts = [prose(i, 40, 9).encode() for i in range(5)]
    model = M.train(frame(spark, [(i, t.decode(), "en", "a", 1) for i, t in enumerate(texts)]))
    code = M.LANGUAGES.index("en")
    for context in (0, 5 << 10 | 3 << 5 | 1, 31 << 10 | 31 << 5 | 31):
        ids = np.array([context << 5 | s for s in range(M.SYMBOLS)], np.uint32)
        total = np.exp(model.score(np.full(M.SYMBOLS, code), ids) / M.UNIT).sum()
        assert abs(total - 1) < 1e-3


def test_counts_by_definition(spark):
    want = Counter()
    for _, text, lang, *_ in odd_rows():
        code = M.LANGUAGES.index(lang) if lang in M.LANGUAGES else len(M.LANGUAGES)
        s = bytes(M.ORDER - 1) + (text or "").encode().translate(M.FOLD)
        for i in range(len(s) - M.ORDER + 1):
            gram = 0
            for x in s[i:i + M.ORDER]:
                gram = gram << M.BITS | x
            want[code, gram] += 1
    got = {(r["language"], r["gram"]): r["n"] for r in M.count_grams(clashing(odd(spark)).repartition(3)).collect()}
    assert got == dict(want)


def corpus(spark):
    rows = [(1_000 + i, prose(i, 120), "en" if i % 2 else "de", "a", 1) for i in range(60)]
    rows += [(100 + i, "### *** " * 60, "en", "a", 1) for i in range(2)]
    rows += [(200, "qzx" * 400 + " w" * 30, "de", "a", 1)]
    return frame(spark, [*rows, *odd_rows()])


def test_bands_reject_odd_texts(spark):
    got = {r["doc_id"]: r for r in Q.judge(corpus(spark)).collect()}
    assert all(got[1_000 + i]["kept"] for i in range(60))
    assert not got[100]["kept"] and not got[101]["kept"] and not got[200]["kept"]
    assert all(not r["kept"] for r in got.values() if r["base_failed"])
    for doc, text, *_ in odd_rows():
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == slow_measures(text or "")
        assert r["base_failed"] == Q.base_fails(r["n_words"], r["n_repeat_words"])


def test_filter_keeps_what_judge_keeps(spark):
    docs = clashing(corpus(spark).drop("size"))
    out = Q.filter_documents(docs)
    assert out.dtypes == docs.dtypes
    want = sorted(str(r["doc_id"]) for r in Q.judge(docs).filter("kept").collect())
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want


def test_letters_at_random_are_rejected(spark, data):
    """Every letter by another of its class: the folded view cannot tell, the letters can."""
    rng = np.random.default_rng(3)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = Q.judge(docs).filter("kept AND n_words > 100").select("doc_id").join(docs.filter("lang = 'en'"), "doc_id").orderBy("doc_id").first()
    letters = {c: same for same in ("aeiou", "bcdfghjklmnpqrstvwxyz") for c in same}
    text = "".join(str(rng.choice(list(letters[c]))) if c in letters else c for c in before["text"])
    assert text.encode().translate(M.FOLD) == before["text"].encode().translate(M.FOLD)
    more = docs.unionByName(frame(spark, [(-1, text, "en", "a", len(text))], docs.schema))
    kept = {r["doc_id"] for r in Q.judge(more).filter("kept").collect()}
    assert -1 not in kept and before["doc_id"] in kept


def test_each_language_has_its_band(spark):
    """A tenth of the corpus is in languages that no list names."""
    def text(i, letters):
        rng = np.random.default_rng(i)
        return " ".join("".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(60))

    rows = [(i, prose(i, 120), "en", "a", 1) for i in range(400)]
    rows += [(1_000 + i, text(i, "абвгдежзиклмнопрст"), "ru", "a", 1) for i in range(25)]
    rows += [(2_000 + i, text(i, "今日本語学校先生時間"), "zh", "a", 1) for i in range(25)]
    rows += [(3_000, "### *** " + text(1, "$%&#") + " qzx" * 90, "ru", "a", 1)]
    docs = frame(spark, rows)
    assert M.found_languages(docs) == ("en", "ru", "zh")
    kept = {r["doc_id"] for r in Q.judge(docs).filter("kept").collect()}
    assert sum(1_000 <= d < 1_025 for d in kept) >= 24 and sum(2_000 <= d < 2_025 for d in kept) >= 24 and 3_000 not in kept
    few = Q.judge(docs.filter("lang <> 'en'"), languages=())
    assert few.count() == 51


def test_limits_by_side():
    rng = np.random.default_rng(1)
    bulk = np.abs(np.rint(rng.normal(0, 15, 5_000)))
    assert Q._limit(bulk, np.ones(len(bulk), int), 13.0) == 13.0 * Q._middle(bulk, np.ones(len(bulk), int))
    both = np.concatenate([bulk, np.rint(rng.normal(110, 5, 400))])
    assert 60 < Q._limit(both, np.ones(len(both), int), 13.0) < 100


def test_empty_tables(spark):
    assert Q.judge(none(spark)).count() == 0
    assert Q.filter_documents(none(spark)).count() == 0
    assert Q.judge(odd(spark)).count() == len(odd_rows())


@pytest.mark.parametrize(("lang", "letters", "join"), [("ru", [chr(c) for c in range(0x430, 0x450)], " "), ("el", [chr(c) for c in range(0x3B1, 0x3CA)], " "), ("zh", [chr(c) for c in range(0x4E00, 0x4E00 + 900)], " ")])
def test_random_letters_of_other_scripts(spark, lang, letters, join):
    """Words of a language's letters in random order leave its band, words of the language stay."""
    rng = random.Random(5)
    weights = [1 / (i + 1) for i in range(len(letters))]
    vocabulary = ["".join(rng.choices(letters, weights, k=rng.randint(2, 7))) for _ in range(60)]
    rows = [(i, join.join(rng.choice(vocabulary) for _ in range(60)), lang, "a", 1) for i in range(400)]
    rows += [(1_000 + i, join.join("".join(rng.choice(letters) for _ in w) for w in rng.choices(vocabulary, k=60)), lang, "a", 1) for i in range(6)]
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(frame(spark, rows)).filter("NOT base_failed").collect()}
    clean, debris = ([k for d, k in kept.items() if (d >= 1_000) == side] for side in (False, True))
    assert sum(clean) > 0.97 * len(clean) and debris and not any(debris)
