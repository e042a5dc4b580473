from __future__ import annotations

from collections import Counter

import pytest
import tiktoken

from lakeloom.llm import token_rollup as R
from lakeloom.llm.queries import TOKENIZERS, op6
from lakeloom.session import scratch_path
from tests.llm.data import clashing, frame, none, odd, odd_rows

CHANGES = "doc_id long, op string, source string, lang string, version string, tokens long, chars long"


def totals(spark, root):
    return {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"], r["chars"]) for r in R.totals(spark, root).collect()}


def slow(batches):
    """Totals of what stands after all batches, document by document."""
    state = {}
    for batch in batches:
        last = {}
        for doc, op, source, lang, version, tokens, chars in batch:
            key = (op == "delete", tokens or 0, chars or 0, source or "", lang or "")
            if (doc, version) not in last or key > last[doc, version][0]:
                last[doc, version] = (key, op, source, lang, tokens or 0, chars or 0)
        for (doc, version), (_, op, source, lang, tokens, chars) in last.items():
            state.pop((doc, version), None)
            if op != "delete":
                state[doc, version] = (source, lang, tokens, chars)
    sums = {}
    for (_, version), (source, lang, tokens, chars) in state.items():
        old = sums.get((source, lang, version), (0, 0, 0))
        sums[source, lang, version] = (old[0] + 1, old[1] + tokens, old[2] + chars)
    return sums


BATCHES = [
    [(1, "insert", "a", "en", "v1", 10, 50), (2, "insert", "a", "de", "v1", 7, 30), (3, "insert", None, None, "v1", 5, 20),
     (1, "insert", "a", "en", "v2", 12, 50), (1, "insert", "a", "en", "v1", 10, 50), (None, "insert", "b", "en", "v1", 1, 1)],
    [(1, "revise", "a", "en", "v1", 8, 40), (2, "delete", "x", "x", "v1", 0, 0), (9, "delete", "a", "en", "v1", 3, 3), (3, "revise", "b", "fr", "v1", 6, 21)],
    [(2, "insert", "c", "de", "v1", 9, 31), (1, "delete", "a", "en", "v2", None, None), (4, "revise", "a", "en", "v1", 2, 2), (None, "delete", "b", "en", "v1", 1, 1)],
    [],
]


def test_batches_by_brute_force(spark):
    root = scratch_path(spark, "rollup")
    assert totals(spark, root) == {}
    for i, batch in enumerate(BATCHES):
        changes = clashing(frame(spark, batch, CHANGES))
        assert R.commit(spark, root, f"b{i}", changes)
        assert totals(spark, root) == slow(BATCHES[:i + 1])
        assert not R.commit(spark, root, f"b{i}", changes)
        assert totals(spark, root) == slow(BATCHES[:i + 1])
    assert R.committed(spark, root) == ["b0", "b1", "b2", "b3"]
    with pytest.raises(ValueError, match="comes after"):
        R.commit(spark, root, "a9", frame(spark, BATCHES[0], CHANGES))


def test_a_crash_between_the_writes(spark, monkeypatch):
    root = scratch_path(spark, "rollup")
    R.commit(spark, root, "b0", frame(spark, BATCHES[0], CHANGES))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(R, "signed", dies)
        with pytest.raises(RuntimeError):
            R.commit(spark, root, "b1", frame(spark, BATCHES[1], CHANGES))
    assert totals(spark, root) == slow(BATCHES[:1])
    assert R.commit(spark, root, "b1", frame(spark, BATCHES[1], CHANGES))
    assert totals(spark, root) == slow(BATCHES[:2])


def test_unknown_operations_are_refused(spark):
    with pytest.raises(Exception, match="unknown op"):
        R.commit(spark, scratch_path(spark, "rollup"), "b", frame(spark, [(1, "upsert", "a", "en", "v", 1, 1)], CHANGES))
    with pytest.raises(ValueError, match="batch names"):
        R.commit(spark, scratch_path(spark, "rollup"), "../b", frame(spark, [], CHANGES))


def encoder(path):
    with open(path, "rb") as file:
        return R._encoding(file.read())


def test_counts_are_the_tokenizers(spark):
    rows = odd_rows()
    got = Counter((r["doc_id"], r["version"], r["tokens"], r["chars"]) for r in R.count_tokens(clashing(odd(spark).drop("tokens")), TOKENIZERS).collect())
    want = Counter()
    for version, path in TOKENIZERS.items():
        made = encoder(path)
        assert isinstance(made, tiktoken.Encoding)
        for r in rows:
            ids = made.encode_ordinary(r[1] or "")
            assert made.decode(ids) == (r[1] or "")
            want[r[0], version, len(ids), len(r[1] or "")] += 1
    assert got == want
    assert R.count_tokens(none(spark), TOKENIZERS).count() == 0


def test_query_by_brute_force(spark, data):
    docs = [(r["doc_id"], r["source"], r["lang"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    first = {}
    for doc, _, _, text in docs:
        first[text] = min(first.get(text, doc), doc)
    want = {}
    for version, path in TOKENIZERS.items():
        made = encoder(path)
        for doc, source, lang, text in docs:
            if first[text] == doc:
                short = "\n".join(dict.fromkeys(text.split("\n")))
                old = want.get((source, lang, version), (0, 0, 0))
                want[source, lang, version] = (old[0] + 1, old[1] + len(made.encode_ordinary(short)), old[2] + len(short))
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"], r["chars"]) for r in op6(spark, data).collect()}
    assert got == want


def test_a_small_commit_reads_little(spark):
    """Ten batches over the same documents: what a batch of a few documents meets does not grow."""
    root, schema = scratch_path(spark, "rollup"), "doc_id long, op string, source string, lang string, version string, tokens long, chars long"
    rows = [(i, "insert", f"s{i % 3}", "en", "v", i, 2 * i) for i in range(2_000)]
    R.commit(spark, root, "b00", spark.createDataFrame(rows, schema))
    met = []
    for n in range(1, 8):
        few = spark.createDataFrame([(i, "revise", "s0", "en", "v", n, n) for i in (3, 5, 8)], schema)
        R.commit(spark, root, f"b{n:02d}", few)
        stated = R._read_state(spark, R._path(root, "state", f"b{n:02d}"))
        buckets = [r[0] for r in stated.select(R.BUCKET).distinct().collect()]
        met.append(R._states(spark, root, f"b{n:02d}", buckets).count())
        assert R._parts(spark, root, None)[1] == [] or len(R._parts(spark, root, None)[1]) >= 1
    assert max(met) < 2_000 / 64 * 3 * 3 and met[-1] <= met[0] + 3 * 7
    want = {}
    for i, _, source, *_rest, tokens, chars in rows:
        source, tokens, chars = ("s0", 7, 7) if i in (3, 5, 8) else (source, tokens, chars)
        old = want.get(source, (0, 0, 0))
        want[source] = (old[0] + 1, old[1] + tokens, old[2] + chars)
    assert {r["source"]: (r["docs"], r["tokens"], r["chars"]) for r in R.totals(spark, root).collect()} == want
    # a larger batch brings the next merge; the last word stays
    R.commit(spark, root, "c", spark.createDataFrame([(i, "revise", "s1", "en", "v", 1, 1) for i in range(2_000)], schema))
    assert R._parts(spark, root, None) == ("c", [])
    assert [tuple(r) for r in R.totals(spark, root).select("source", "docs", "tokens").collect()] == [("s1", 2_000, 2_000)]
