from __future__ import annotations

import numpy as np

import corpus_pipeline as P
from lakeloom.llm import decontaminate, mixing, quality, sharding, simhash
from lakeloom.session import stage, table
from tests.llm.data import none, odd, words
from tests.llm.test_decontaminate import slow as slow_match
from tests.llm.test_simhash import slow_groups, slow_print


def test_every_stage_by_brute_force(spark, data):
    """Each stage on what the one before kept, held against a plain version of it."""
    docs = table(spark, data, "documents")
    columns = docs.columns
    benchmark = [(str(r["item_id"]), r["text"]) for r in table(spark, data, "benchmark").collect()]

    kept = stage(P.quality_rules(spark, docs, data))
    judged = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == judged

    single = stage(P.near_dedup(spark, kept, data))
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()))
    prints = [(d, slow_print(t)) for d, t in rows]
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(slow_groups(prints, 4)))

    clean = stage(P.benchmark_decontamination(spark, single, data))
    rows = single.collect()
    found = {r["doc_id"]: (r, m) for r, m in zip(rows, slow_match([r["text"] for r in rows], benchmark), strict=True)}
    got = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == columns
    assert set(got) == {d for d, (_, (n, hit, _)) in found.items() if len(hit) <= 0.5 * n}
    for d, r in got.items():
        old, (_, hit, _) = found[d]
        assert r["text"] == (old["text"] if not hit else decontaminate.cut_words(old["text"].encode(), np.array(hit)).decode())
        assert r["n_chars"] == (len(r["text"]) if hit else old["n_chars"])
    assert all(not hit for _, hit, _ in slow_match([r["text"] for r in got.values()], benchmark))

    mixed = stage(P.mix_sources(spark, clean, data))
    assert mixed.columns == columns
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(got) and max(copies.values()) <= 2
    _, sizes, targets = mixing.mix(clean)
    taken = {}
    for d, n in copies.items():
        taken[got[d]["source"]] = taken.get(got[d]["source"], 0) + n * len(words(got[d]["text"]))
    assert sum(abs(taken.get(s, 0) - t) for s, t in targets.items()) < 0.02 * sum(targets.values())
    assert sum(sizes.values()) == sum(len(words(r["text"])) for r in got.values())

    placed = P.shards(spark, mixed, data).collect()
    assert sorted(r["doc_id"] for r in placed) == sorted(r["doc_id"] for r in mixed.collect())
    homes, slots = {}, {}
    for r in placed:
        homes.setdefault(r["doc_id"], set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_and_empty_tables_run_through(spark, data):
    for docs in (odd(spark), none(spark)):
        columns = docs.columns
        for _, step in P.STAGES[:-1]:
            docs = stage(step(spark, docs, data))
            assert docs.columns == columns
        P.STAGES[-1][1](spark, docs, data).collect()


def test_stages_call_the_dealt_operators():
    assert [f.__name__ for _, f in P.STAGES] == ["quality_rules", "near_dedup", "benchmark_decontamination", "mix_sources", "shards"]
    for name, module in (("filter_documents", quality), ("drop_near_duplicates", simhash), ("decontaminate", decontaminate), ("mixed_rows", mixing), ("shard", sharding)):
        assert callable(getattr(module, name))
