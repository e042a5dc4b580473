from __future__ import annotations

import itertools
import random
from fractions import Fraction

from pyspark.sql import functions as F

from lakeloom.llm import mixing as X
from tests.llm.data import clashing, frame, none, odd, odd_rows, prose, table, words


def slow_targets(sizes, weights, share, cap):
    """Water level by exact arithmetic, closing one source after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = Fraction(share) * sum(sizes.values())
    closed = {}
    while True:
        left, open_ = total - sum(closed.values()), [s for s in names if s not in closed]
        if not open_:
            return closed
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > cap * sizes[s]]
        if not full:
            return closed | {s: level * weight[s] for s in open_}
        closed |= {s: Fraction(cap * sizes[s]) for s in full}


def test_targets_by_exact_arithmetic():
    rng = random.Random(2)
    for _ in range(200):
        sizes = {(None if i == 3 else f"s{i}"): rng.choice([0, rng.randint(1, 10), rng.randint(1, 10_000)]) for i in range(rng.randint(1, 9))}
        got = X.source_targets(sizes)
        want = slow_targets(sizes, X.WEIGHTS, "1.5", 2)
        assert all(abs(got[s] - float(want[s])) < 1e-6 * (1 + float(want[s])) for s in sizes)


def cheapest(patterns, targets, epochs):
    """Most that can be routed, and the least cost of that, by trying every split of the words."""
    best = (0, 0)
    names = sorted(targets)
    choices = []
    for members, size in patterns:
        own = [s for s in names if s in members]
        choices.append([dict(zip(own, split, strict=True)) for split in itertools.product(range(epochs * size + 1), repeat=len(own)) if sum(split) <= epochs * size])
    for routed in itertools.product(*choices):
        into = {s: sum(r.get(s, 0) for r in routed) for s in names}
        if any(into[s] > targets[s] for s in names):
            continue
        cost = 0
        for (_, size), r in zip(patterns, routed, strict=True):
            n = sum(r.values())
            cost += sum(e * e * min(size, max(0, n - e * size)) for e in range(epochs))
        best = max(best, (sum(into.values()), -cost))
    return best


def test_flow_is_most_and_cheapest():
    rng = random.Random(4)
    for _ in range(40):
        names = ["a", "b", "c"][:rng.randint(1, 3)]
        patterns = [(tuple(rng.sample(names, rng.randint(1, len(names)))), rng.randint(0, 2)) for _ in range(rng.randint(1, 3))]
        targets = {s: rng.randint(0, 4) for s in names}
        flow = X.min_cost_flow(patterns, targets, 2)
        used, into = {}, {}
        for (i, e, s), n in flow.items():
            assert s in patterns[i][0] and n > 0
            used[i, e] = used.get((i, e), 0) + n
            into[s] = into.get(s, 0) + n
        assert all(n <= patterns[i][1] for (i, _), n in used.items())
        assert all(into[s] <= targets[s] for s in into)
        assert (sum(into.values()), -sum(e * e * n for (_, e), n in used.items())) == cheapest(patterns, targets, 2)


def many(spark):
    rng = random.Random(8)
    rows = [(i, prose(i, rng.choice([1, 5, 20, 60])), "en", rng.choice(["hot"] * 4 + ["x", "y", None]), 1) for i in range(400)]
    return frame(spark, rows)


def test_mix_comes_near_its_targets(spark):
    docs = many(spark)
    decided, sizes, targets = X.mix(clashing(docs))
    rows = decided.collect()
    assert len(rows) == 400
    text = {r["doc_id"]: r for r in docs.collect()}
    taken = {}
    for r in rows:
        assert r["size"] == len(words(text[r["doc_id"]]["text"]))
        assert r["taken"] == len(r["copies"]) * r["size"] <= 2 * r["size"]
        assert set(r["copies"]) <= {text[r["doc_id"]]["source"]}
        taken[r["sources"][0]] = taken.get(r["sources"][0], 0) + r["taken"]
    assert sizes == {s: sum(len(words(t["text"])) for t in text.values() if t["source"] == s) for s in sizes}
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(3, 0.01 * target)
    again = X.mix(docs.repartition(7))[0]
    assert table(decided, "doc_id", "taken") == table(again, "doc_id", "taken")


def test_overlapping_sources(spark):
    docs = many(spark).withColumn("in", F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.lit("z"))))
    decided, _, targets = X.mix(docs, F.col("in"), weights=(3, 1, 1))
    into = {}
    for r in decided.collect():
        assert set(r["copies"]) <= set(r["sources"]) and len(r["copies"]) <= 2
        for s in r["copies"]:
            into[s] = into.get(s, 0) + r["size"]
    assert set(targets) == {"x", "y", "z"}
    whole = sum(r["size"] for r in decided.collect() if r["sources"] == ["x", "y"])
    assert abs(into.get("x", 0) + into.get("y", 0) - min(2 * whole, targets["x"] + targets["y"])) < 0.03 * whole


def test_a_long_document_at_the_cut(spark):
    """The documents after one that does not fit are used: what stays open is below the least of them."""
    rng = random.Random(3)
    rows = [(i, None, "en", "a" if i % 2 else "b", rng.randint(3, 50)) for i in range(1_200)]
    rows += [(10_000 + i, None, "en", "a", 100_000) for i in range(4)]
    docs = frame(spark, rows)
    for seed in range(1):
        decided, _, targets = X.mix(docs, size=F.col("n_chars"), weights=(1, 1), total=0.04, epochs=1, seed=seed)
        got = decided.collect()
        assert all(len(r["copies"]) <= 1 and set(r["copies"]) <= set(r["sources"]) for r in got)
        for s, target in targets.items():
            taken = sum(r["taken"] for r in got if r["sources"] == [s])
            unused = [r["size"] for r in got if r["sources"] == [s] and not r["copies"]]
            assert abs(taken - target) < min(unused, default=2) + 1, (seed, s, taken, target)


def test_rows_of_the_mix(spark):
    docs = clashing(many(spark))
    out = X.mixed_rows(docs)
    assert out.columns == docs.columns
    taken = {r["doc_id"]: len(r["copies"]) for r in X.mix(docs)[0].collect()}
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in taken.items() if n}


def test_rows_of_the_mix_with_null_and_repeated_ids(spark):
    """Rows that share a doc_id, over two sources, take what the decisions say for each source."""
    rng = random.Random(8)
    rows = [(None if i % 2 else i % 7, " ".join(["w"] * rng.randint(1, 20)) + f" {i // 3}", "en", "ab"[i % 3 == 0], 1) for i in range(2_000)]
    docs = frame(spark, rows)
    decided, _, targets = X.mix(docs)
    want, got = {}, {}
    for r in decided.collect():
        want[r["sources"][0]] = want.get(r["sources"][0], 0) + r["taken"]
    for r in X.mixed_rows(docs).collect():
        got[r["source"]] = got.get(r["source"], 0) + len(words(r["text"]))
    assert all(abs(got[s] - targets[s]) < 0.02 * targets[s] for s in targets)
    assert all(abs(got[s] - want[s]) < 0.02 * targets[s] for s in targets)


def test_odd_and_empty_tables(spark):
    decided, sizes, _ = X.mix(odd(spark))
    rows = decided.collect()
    assert len(rows) == len(odd_rows()) and None in sizes
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert X.mix(none(spark))[0].count() == 0
    assert X.mixed_rows(none(spark)).count() == 0
