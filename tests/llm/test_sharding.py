from __future__ import annotations

import random

from pyspark.sql import functions as F

from lakeloom.llm import sharding as S
from tests.llm.data import clashing, frame, none, odd, odd_rows


def slow_longest_first(sizes, shards):
    loads, placed = [0] * shards, {}
    for name, size in sorted(sizes, key=lambda u: (-u[1], str(u[0]))):
        placed[name] = min(range(shards), key=lambda s: (loads[s], s))
        loads[placed[name]] += size
    return placed


def test_heap_by_linear_search():
    rng = random.Random(1)
    for _ in range(50):
        units = [(f"u{i}", rng.randint(1, 30)) for i in range(rng.randint(0, 40))]
        assert S.longest_first(units, 5) == slow_longest_first(units, 5)


def check(rows, want_sizes, shards):
    by_shard, by_text = {}, {}
    for r, text in rows:
        assert r["size"] == want_sizes(text)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        by_text.setdefault(text or "", set()).add(r["shard"])
    assert set(by_shard) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_groups_slots_and_balance(spark):
    rng = random.Random(6)
    texts = ["é" * rng.randint(0, 300) + str(i) for i in range(900)] + ["same text"] * 300
    rng.shuffle(texts)
    docs = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    rows = [(r, texts[r["doc_id"]]) for r in S.shard(docs, 4).collect()]
    assert len(rows) == len(texts)
    check(rows, lambda t: len((t or "").encode()) + 1, 4)
    loads = {}
    for r, _ in rows:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    assert max(loads.values()) - min(loads.values()) < 700
    few = [(r, texts[r["doc_id"]]) for r in S.shard(docs, 4, bundles=7).collect()]
    check(few, lambda t: len((t or "").encode()) + 1, 4)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in S.shard(docs.repartition(5), 4).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r, _ in rows}


def test_own_groups(spark):
    docs = frame(spark, [(i, str(i), "en", None if i % 5 == 0 else f"s{i % 5}", 1) for i in range(50)])
    rows = S.shard(docs, 3, F.col("source"), F.lit(2), keep=(F.col("source"),)).collect()
    homes = {}
    for r in rows:
        homes.setdefault(r["source"], set()).add(r["shard"])
    assert len(homes) == 5 and all(len(h) == 1 for h in homes.values())


def test_odd_and_empty_tables(spark):
    texts = {r[0]: r[1] for r in odd_rows()}
    rows = [(r, texts[r["doc_id"]]) for r in S.shard(clashing(odd(spark).drop("size"))).collect()]
    assert len(rows) == len(odd_rows())
    check(rows, lambda t: len((t or "").encode()) + 1, 16)
    assert S.shard(none(spark)).count() == 0
