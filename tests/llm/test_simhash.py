from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from lakeloom.llm import simhash
from lakeloom.llm.components import components
from tests.llm.data import LOWER, clashing, frame, none, odd, odd_rows, prose, table, words


def slow_print(text, k=4):
    found = words((text or "").translate(LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, radius):
    """Least id that can be reached, for each (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (name, _) in enumerate(prints):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints_by_definition():
    for _, text, *_ in odd_rows():
        if len(text or "") < 20_000:
            assert simhash.fingerprint((text or "").encode(), 4) == slow_print(text)


def test_groups_by_brute_force(spark):
    rows = odd_rows()
    prints = [(r[0], slow_print(r[1])) for r in rows]
    want = sorted(((d, fp, c) for (d, fp), c in zip(prints, slow_groups(prints, 4), strict=True)), key=str)
    got = simhash.near_duplicates(clashing(odd(spark)), 4, 4)
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got.collect()), key=str) == want


def test_all_links_over_tiles(spark):
    """Random fingerprints and chains of close ones, in tiles so small that bands are cut."""
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(6):
            prints.add(at)
            for _ in range(rng.randint(1, 6)):
                at ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    roots = {r["node"] % 2**64: r["root"] for r in components(simhash.links(df, 4, tile=3)).collect()}
    want = slow_groups(list(enumerate(prints)), 4)
    groups = {}
    for p, c in zip(prints, want, strict=True):
        groups.setdefault(c, set()).add(p)
    for members in groups.values():
        if len(members) == 1:
            assert not members & roots.keys()
        else:
            assert len({roots[m] for m in members}) == 1
    assert len({r for r in roots.values()}) == sum(len(m) > 1 for m in groups.values())


def test_a_large_group_gives_a_forest():
    rng = np.random.default_rng(1)
    base = np.uint64(0x0F0F0F0F0F0F0F0F)
    prints = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)))
    a, b = simhash._forest(prints, None, 4)
    assert len(a) == len(prints) - 1
    a, b = simhash._forest(prints[:30], prints[30:], 4)
    assert len(a) == len(prints) - 1


def test_one_of_each_group_stays(spark):
    docs = clashing(odd(spark))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    prints = [(r[0], slow_print(r[1])) for r in odd_rows()]
    want = {c for c in slow_groups(prints, 4) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1


def test_empty_tables(spark):
    assert simhash.near_duplicates(none(spark)).count() == 0
    assert simhash.drop_near_duplicates(none(spark)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)],
                                   [(5, 9), (9, 5), (7, 9), (100, 101), (None, 3)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(frame(spark, edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert got.pop(node) == min(seen)
    assert not got


def test_repeated_rows_and_prose(spark):
    text = prose(9, 80)
    docs = frame(spark, [(3, text, "en", "a", 1), (3, text, "en", "a", 1), (2, text + " more", "en", "a", 1)])
    assert len(table(simhash.drop_near_duplicates(docs), "doc_id")) in (1, 2)
    assert table(simhash.near_duplicates(docs), "doc_id")[0] == (2,)
