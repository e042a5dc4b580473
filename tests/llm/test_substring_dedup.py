from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lakeloom.llm import bwt
from lakeloom.llm import substring_dedup as S
from tests.llm.data import clashing, frame, none, odd, odd_rows, prose


def slow(rows, length):
    """(id, bytes, removed, spans, digest of the rest) of each (id, text), window by window."""
    last = 2**63 - 1
    first = {}
    for name, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            first[s] = min(first.get(s, last), last if name is None else name)
    found = []
    for name, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i:i + length]] < (last if name is None else name):
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found.append((name, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def fast(df, **options):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.dedup(df, **options).collect()), key=str)


def test_odd_rows_by_brute_force(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert fast(clashing(odd(spark))) == slow(rows, 50)


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"chunk_bytes": 300}), (3, {"chunk_bytes": 300, "hot": 2}),
                                               (4, {"length": 9, "width": 4, "chunk_bytes": 500, "hot": 5}), (5, {"length": 12, "width": 12, "chunk_bytes": 200})])
def test_shared_passages(spark, seed, options):
    """Passages, a line that everyone has, copies and runs of one letter, over many chunks."""
    rng = random.Random(seed)
    passages = [prose(seed * 100 + i, rng.randint(3, 30), 3) for i in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else prose(seed * 1000 + i * 9 + k, rng.randint(0, 12), 3) for k in range(rng.randint(0, 5))]
        parts.insert(rng.randint(0, len(parts)), "the line that every page of this site repeats, always")
        rows.append((rng.randint(0, 80), "\n".join(parts), "en", "a", 1))
    rows += [(i, "z" * rng.randint(40, 70), "en", "a", 1) for i in range(200, 206)]
    rows += [(300 + i, rows[i][1], "en", "a", 1) for i in range(5)]
    assert fast(frame(spark, rows), **options) == slow([(r[0], r[1]) for r in rows], options.get("length", 50))


def test_a_third_without_ids(spark):
    """Rows that have no doc_id, or share one, lie in many chunks and are still no copies of each other."""
    rng = random.Random(11)
    passages = [prose(70 + i, 15, 3) for i in range(4)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"{rng.choice(passages)} {prose(500 + i, rng.randint(0, 9), 3)} {rng.choice(passages)}", "en", "a", 1) for i in range(75)]
    assert fast(frame(spark, rows), chunk_bytes=400) == slow([(r[0], r[1]) for r in rows], 50)


def test_kept_bytes(spark):
    rows = [(1, "é" * 30, "en", "a", 1), (2, "x" + "é" * 29 + "y", "en", "a", 1), (3, "e" + "é" * 30, "en", "a", 1)]
    got = {r["doc_id"]: bytes(r["kept"]) for r in S.dedup(frame(spark, rows), with_kept=True).collect()}
    assert got == {1: ("é" * 30).encode(), 2: b"xy", 3: b"e"}


def test_empty_table(spark):
    assert S.dedup(none(spark)).count() == 0


def test_common_prefixes_by_definition():
    rng = random.Random(7)
    for _ in range(200):
        text = bytes(rng.choice(b"\1\2\3") for _ in range(rng.randint(0, 60))) + b"\0"
        depth = rng.choice([1, 2, 5, 8, 11, 17])
        order, lcp = bwt.bounded_prefixes(np.frombuffer(text, np.uint8), depth)
        assert sorted(order.tolist()) == list(range(len(text)))
        padded = text + bytes(depth)
        for k, at in enumerate(order.tolist()):
            if k == 0:
                assert lcp[0] == 0
                continue
            a, b = padded[order[k - 1]:][:depth], padded[at:][:depth]
            assert a <= b
            if b"\0" not in a and b"\0" not in b:
                common = next((i for i in range(depth) if a[i] != b[i]), depth)
                assert lcp[k] == common


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(9)
    text = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(900)), np.uint8)
    place, hashes = S.anchors(text, 20, 6, block=64)
    for i in range(len(place)):
        own = (hashes[i:i + 15] & ~np.uint64(0xFFFFFF)).tolist()
        assert place[i] - i == own.index(min(own))
