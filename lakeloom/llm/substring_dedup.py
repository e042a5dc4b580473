"""Removal of byte strings that start in an earlier document too.

Equal strings of ``LENGTH`` bytes hold the same anchor, the least-hashed ``ANCHOR`` bytes in
them, so strings meet by anchor without a suffix array of the whole corpus:

1. Documents are dealt into chunks by id.  Each chunk sends its anchors (6 bytes each) to
   buckets; a bucket says which of them occur in more than one document.
2. Each chunk sends the distinct fragments around shared anchors: all windows that have the
   anchor, as one byte string, with the least doc_id that has it.
3. A bucket finds the least doc_id of every window.  Equal fragments are one; where fragments
   with the same anchor differ, common prefixes come from a Burrows-Wheeler transform.
4. Each chunk removes the windows that an earlier document has.

Anchors of very many documents (a line on a third of all pages) would gather unlike fragments
in one bucket; their windows travel one by one and meet by content instead.  A chunk sends a
string once however often it has it, so what a bucket gets is bounded by chunks, not copies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.bwt import least_owner
from lakeloom.llm.text import text_bytes

LENGTH = 50
ANCHOR = 25
#: Bytes of text in a chunk, at least; the chunk grows with the root of the corpus, so that what
#: a chunk sends to a bucket stays long enough.
CHUNK_BYTES = 4 << 20
#: Fragments of one transform have about so many bytes together.
BLOCK_BYTES = 1 << 18
#: Anchors that occur so often are dealt by window.
HOT = 4_096

_FACTOR = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 48) - 1)
_LAST = np.iinfo(np.int64).max


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(text: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes, built from strings of powers of two."""
    whole, have = None, 0
    part, size = text.astype(np.uint64) + np.uint64(1), 1
    while True:
        if width & size:
            if whole is None:
                whole, have = part, size
            else:
                n = len(text) - have - size + 1
                whole = whole[:n] * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[have:have + n]
                have += size
        if 2 * size > width:
            return _mixed(whole)
        n = len(part) - size
        part = part[:n] * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[size:]
        size *= 2


def anchors(text: np.ndarray, length: int, width: int, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``length`` bytes: where its anchor is, the first of the strings of
    ``width`` bytes in it whose hash is least; and the hash of every string of ``width``."""
    n, span = len(text) - length + 1, length - width + 1
    place = np.empty(n, np.int32)
    hashes = np.empty(n + span - 1, np.uint64)
    for at in range(0, n, block):
        size = min(block, n - at)
        own = rolling(text[at:at + size + length - 1], width)
        hashes[at:at + len(own)] = own
        least = (own & ~np.uint64(0xFFFFFF)) | np.arange(len(own), dtype=np.uint64)
        step = 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < span:
            least = np.minimum(least[:size], least[span - step:span - step + size])
        place[at:at + size] = (least & np.uint64(0xFFFFFF)).astype(np.int32) + at
    return place, hashes


@dataclass
class Chunk:
    """Documents of a chunk in order of id, without those that copy an earlier document, and
    the runs of windows that share an anchor."""
    ids: np.ndarray
    text: np.ndarray
    starts: np.ndarray  # of documents, with the end of the last
    first: np.ndarray  # of runs: the first window,
    count: np.ndarray  # how many windows,
    doc: np.ndarray  # whose document,
    key: np.ndarray  # and the anchor's hash

    @classmethod
    def of(cls, ids: np.ndarray, texts: list[bytes], length: int, width: int) -> Chunk:
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        text = np.frombuffer(b"".join(texts), np.uint8)
        none = np.zeros(0, np.int64)
        if len(text) < length:
            return cls(ids, text, starts, none, none, none, none.astype(np.uint64))
        place, hashes = anchors(text, length, width)
        within = np.ones(len(place) + 1, bool)  # windows that do not cross into the next document
        within[-1] = False
        crossing = np.zeros(len(place) + 1, np.int32)
        np.add.at(crossing, np.clip(starts[1:] - length + 1, starts[:-1], len(place)), 1)
        np.add.at(crossing, np.minimum(starts[1:], len(place)), -1)
        within[:-1] = np.cumsum(crossing, out=crossing)[:-1] == 0
        del crossing
        begins = np.ones(len(place) + 1, bool)
        begins[1:-1] = place[1:] != place[:-1]
        begins[starts[:-1][starts[:-1] < len(place)]] = True
        begins[1:] |= within[1:] != within[:-1]
        edges = np.flatnonzero(begins)
        runs = within[edges[:-1]]
        first = edges[:-1][runs]
        doc = np.searchsorted(starts, first, side="right") - 1
        return cls(ids, text, starts, first, np.diff(edges)[runs], doc, hashes[place[first]])


def _copied(table: pa.Table, notes: pa.Table) -> np.ndarray:
    """Which rows copy an earlier document."""
    known = {(doc, mark) for r in _group_rows(notes, "copies")
             for doc, mark in zip(*(np.frombuffer(r[k], np.int64).tolist() for k in ("a", "b")), strict=True)}
    return np.array([pair in known for pair in zip(table.column("doc_id").to_pylist(), table.column("mark").to_pylist(), strict=True)], bool)


def _chunk(table: pa.Table, copied: np.ndarray, length: int, width: int) -> Chunk:
    ids = table.column("doc_id").to_numpy()
    keep = np.flatnonzero(~copied)
    texts = text_bytes(table.column("text").take(pa.array(keep)))
    order = sorted(range(len(texts)), key=lambda i: (ids[keep[i]], texts[i]))
    return Chunk.of(ids[keep][order], [texts[i] for i in order], length, width)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hashes, so sorted hashes are in order of buckets too."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Anchors:
    """The anchors of a chunk by bucket: those of one run, and those of several, with counts of
    runs and whether several documents have them."""
    bucket: np.ndarray
    keys: np.ndarray
    runs: np.ndarray
    several: np.ndarray
    of_run: np.ndarray  # which of the keys each run has

    @classmethod
    def of(cls, chunk: Chunk, buckets: int) -> Anchors:
        order = np.argsort(chunk.key)
        key = chunk.key[order]
        new = np.ones(len(order), bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        of_run = np.empty(len(order), np.int64)
        of_run[order] = np.cumsum(new) - 1
        docs = chunk.ids[chunk.doc[order]] if len(order) else np.zeros(0, np.int64)
        several = (np.maximum.reduceat(docs, heads) != np.minimum.reduceat(docs, heads)) if len(heads) else np.zeros(0, bool)
        return cls(_bucket(key[heads], buckets), key[heads] & _LOW, np.diff(np.append(heads, len(order))), several, of_run)

    def slices(self) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.diff(self.bucket)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.bucket)], strict=True):
            if b > a:
                yield int(self.bucket[a]), slice(a, b)


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.uint64)


@dataclass
class Fragments:
    """The distinct fragments of a chunk's shared anchors, by bucket, in a fixed order."""
    bucket: np.ndarray
    keys: np.ndarray
    strings: list[bytes]
    owner: np.ndarray  # least doc_id in the chunk
    start: np.ndarray  # of occurrences: the first window,
    doc: np.ndarray  # its document,
    which: np.ndarray  # and which of the fragments it is

    @classmethod
    def of(cls, chunk: Chunk, found: Anchors, shared: np.ndarray, hot: np.ndarray, buckets: int, length: int) -> Fragments:
        runs = np.flatnonzero(shared[found.of_run] & ~hot[found.of_run])
        start, count, doc = chunk.first[runs], chunk.count[runs], chunk.doc[runs]
        bucket, key = found.bucket[found.of_run[runs]], found.keys[found.of_run[runs]]
        dealt = np.flatnonzero(hot[found.of_run])
        if len(dealt):  # window by window, met by the hash of all its bytes
            n = chunk.count[dealt]
            each = np.repeat(chunk.first[dealt], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            windows = np.lib.stride_tricks.sliding_window_view(chunk.text, length)
            own = np.concatenate([rolling(windows[each[i:i + 65_536]].ravel(), length)[::length] for i in range(0, len(each), 65_536)])
            start, count, doc = (np.concatenate(x) for x in ((start, each), (count, np.ones(len(each), np.int64)), (doc, np.repeat(chunk.doc[dealt], n))))
            bucket = np.concatenate((bucket, _bucket(own, buckets)))
            key = np.concatenate((key, own & _LOW))
        order = np.argsort(bucket, kind="stable")
        start, count, doc, bucket, key = (x[order] for x in (start, count, doc, bucket, key))
        data = chunk.text.tobytes()
        numbers: dict[tuple[int, bytes], int] = {}
        ends = start + count + length - 1
        which = np.array([numbers.setdefault((b, data[s:e]), len(numbers)) for b, s, e in zip(bucket.tolist(), start.tolist(), ends.tolist(), strict=True)], np.int64)
        owner = np.full(len(numbers), _LAST)
        np.minimum.at(owner, which, chunk.ids[doc] if len(doc) else np.zeros(0, np.int64))
        _, head = np.unique(which, return_index=True)
        return cls(bucket[head], key[head], [s for _, s in numbers], owner, start, doc, which)


def _group_rows(table: pa.Table, kind: str) -> list[dict]:
    return [r for r in table.to_pylist() if r["kind"] == kind]


def _masks(notes: pa.Table, found: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """Which of the chunk's anchors are shared, and which are hot, from the buckets' answers."""
    shared, hot = found.several.copy(), np.zeros(len(found.keys), bool)
    answers = {r["bucket"]: r for r in _group_rows(notes, "shared")}
    for bucket, part in found.slices():
        if bucket in answers:
            n = part.stop - part.start
            shared[part] = np.unpackbits(np.frombuffer(answers[bucket]["a"], np.uint8), count=n).astype(bool)
            hot[part] = np.unpackbits(np.frombuffer(answers[bucket]["b"], np.uint8), count=n).astype(bool)
    return shared, hot & shared


NOTES = "chunk int, kind string, bucket int, a binary, b binary, c binary"
SENT = "chunk int, bucket int, a binary, b binary, c binary, d binary"


def _sent(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("chunk", "bucket", "a", "b", "c", "d"), columns, kinds, strict=True)})


def _noted(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 3]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("chunk", "kind", "bucket", "a", "b", "c"), columns, kinds, strict=True)})


def _answer_anchors(table: pa.Table, often: int) -> pa.Table:
    """A bucket's answer to every chunk: which of its anchors several documents have, and which
    occur so often that their windows are dealt one by one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = [_from_six(r["a"]) for r in rows]
    runs = [np.frombuffer(r["b"], np.uint32) for r in rows]
    several = [np.unpackbits(np.frombuffer(r["c"], np.uint8), count=len(k)) for r, k in zip(rows, keys, strict=True)]
    known, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    chunks = np.bincount(inverse, minlength=len(known))
    total = np.bincount(inverse, weights=np.concatenate([np.where(r, r, 1) for r in runs]) if runs else None, minlength=len(known))
    shared = (chunks > 1) | (np.bincount(inverse, weights=np.concatenate(several), minlength=len(known)) > 0)
    hot = shared & (total >= often)
    out, at = [], 0
    for row, own in zip(rows, keys, strict=True):
        place = inverse[at:at + len(own)]
        at += len(own)
        out.append((row["chunk"], "shared", row["bucket"], np.packbits(shared[place]).tobytes(), np.packbits(hot[place]).tobytes(), None))
    return _noted(out)


def _blocks(sizes: np.ndarray, heads: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups (which begin at ``heads``) with about ``BLOCK_BYTES`` bytes."""
    ends = np.append(heads[1:], len(sizes))
    filled = start = 0
    for head, end in zip(heads.tolist(), ends.tolist(), strict=True):
        filled += int(sizes[head:end].sum())
        if filled >= BLOCK_BYTES or end == len(sizes):
            yield start, end
            start, filled = end, 0


def _answer_fragments(table: pa.Table, length: int) -> pa.Table:
    """A bucket's answer to every chunk: for each of its fragments, runs of windows with the
    least doc_id that has them (run ends and doc_ids)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    numbers: dict[bytes, int] = {}
    places, owners, keys = [], [], []
    for r in rows:
        sizes = np.frombuffer(r["b"], np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        data = r["d"]
        places.append(np.array([numbers.setdefault(data[e - s:e], len(numbers)) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)], np.int64))
        owners.append(np.frombuffer(r["c"], np.int64))
        keys.append(_from_six(r["a"]))
    place = np.concatenate(places)
    strings = list(numbers)
    owner = np.full(len(strings), _LAST)
    np.minimum.at(owner, place, np.concatenate(owners))
    key = np.zeros(len(strings), np.uint64)
    key[place] = np.concatenate(keys)

    run_of = np.arange(len(strings))  # to begin with, a run for each fragment
    run_end = np.array([len(s) - length + 1 for s in strings], np.int64)
    run_owner = owner.copy()
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    group = np.cumsum(new) - 1
    unlike = order[np.bincount(group)[group] > 1]  # fragments that share an anchor with another
    if len(unlike):
        heads = np.flatnonzero(np.concatenate(([True], key[unlike[1:]] != key[unlike[:-1]])))
        single = np.ones(len(strings), bool)
        single[unlike] = False
        parts = [(run_of[single], run_end[single], run_owner[single])]
        for a, b in _blocks(run_end[unlike] + length - 1, heads):
            own = unlike[a:b]
            least, firsts = least_owner([strings[i] for i in own.tolist()], owner[own], length)
            which = np.repeat(np.arange(len(own)), run_end[own])
            last = np.ones(len(least), bool)
            last[:-1] = (least[1:] != least[:-1]) | (which[1:] != which[:-1])
            ends = np.flatnonzero(last)
            parts.append((own[which[ends]], ends - firsts[which[ends]] + 1, least[ends]))
        run_of, run_end, run_owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((run_end, run_of))
        run_of, run_end, run_owner = run_of[order], run_end[order], run_owner[order]
    count = np.bincount(run_of, minlength=len(strings))
    begin = np.cumsum(count) - count
    out = []
    for row, own in zip(rows, places, strict=True):
        n = count[own]
        pick = np.repeat(begin[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out.append((row["chunk"], "runs", row["bucket"], n.astype(np.uint32).tobytes(), run_end[pick].astype(np.uint32).tobytes(), run_owner[pick].tobytes()))
    return _noted(out)


def _removed(chunk: Chunk, sent: Fragments, notes: pa.Table, length: int) -> np.ndarray:
    """Which bytes of the chunk are covered by a window that an earlier document has."""
    answers = {r["bucket"]: r for r in _group_rows(notes, "runs")}
    buckets = np.unique(sent.bucket).tolist()
    none = np.zeros(0, np.int64)
    counts, ends, owners = ([none] for _ in range(3))
    for bucket in buckets:  # fragments are in order of their buckets
        answer = answers[bucket]
        counts.append(np.frombuffer(answer["a"], np.uint32).astype(np.int64))
        ends.append(np.frombuffer(answer["b"], np.uint32).astype(np.int64))
        owners.append(np.frombuffer(answer["c"], np.int64))
    count, end, owner = (np.concatenate(x) for x in (counts, ends, owners))
    begin = np.cumsum(count) - count
    opens = np.zeros(len(end), np.int64)
    opens[1:] = end[:-1]
    opens[begin[count > 0]] = 0
    n = count[sent.which]
    run = np.repeat(begin[sent.which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start, doc = np.repeat(sent.start, n), np.repeat(sent.doc, n)
    hit = owner[run] < chunk.ids[doc] if len(run) else np.zeros(0, bool)
    change = np.zeros(len(chunk.text) + 1, np.int32)
    np.add.at(change, start[hit] + opens[run[hit]], 1)
    np.add.at(change, start[hit] + end[run[hit]] + length - 1, -1)
    return np.cumsum(change, out=change)[:-1] > 0


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def dedup(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR, id_column: str = "doc_id",
          text_column: str = "text", chunk_bytes: int = CHUNK_BYTES, hot: int = HOT, with_kept: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, if asked for, kept (the bytes that stay, which need not be UTF-8).

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
    smaller doc_id, judged on the input.  Null texts are empty; rows with the same doc_id are
    no copies of each other; a null doc_id comes after all others; matches never cross
    documents; no rows give no rows; other columns are ignored."""
    narrow = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("doc_id"),
                         F.coalesce(F.encode(F.col(text_column).cast("string"), "UTF-8"), F.lit(b"")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, int(total // max(chunk_bytes, int((1_000 * total) ** 0.5))))
    buckets = chunks
    mark = F.xxhash64("text").alias("mark")  # tells rows with one doc_id apart

    def chunk_of(mark: Column) -> Column:
        """Rows are dealt by doc_id and text, so that rows without a doc_id, or with the same, spread."""
        return F.pmod(F.xxhash64(F.col("doc_id"), mark), F.lit(chunks)).cast("int").alias("chunk")

    texts = narrow.select(chunk_of(F.xxhash64("text")), "doc_id", mark, "text")

    def number(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    # whole copies of an earlier document need no search: all their windows go
    named = narrow.select("doc_id", mark, F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n"))
    least = named.groupBy("sha").agg(F.min("doc_id").alias("least"))

    def list_copies(table: pa.Table) -> pa.Table:
        ids, marks = (table.column(c).to_numpy().tobytes() for c in ("doc_id", "mark"))
        return _noted([(number(table), "copies", 0, ids, marks, None)])

    copies = (named.filter(F.col("n") >= length).join(least, "sha").filter("doc_id > least")
              .select(chunk_of(F.col("mark")), "doc_id", "mark").groupBy("chunk").applyInArrow(list_copies, NOTES))

    def send_anchors(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent([])
        found = Anchors.of(_chunk(table, _copied(table, notes), length, width), buckets)
        rows = []
        for bucket, part in found.slices():
            runs = np.where(found.runs[part] > 1, found.runs[part], 0).astype(np.uint32)
            rows.append((number(table), bucket, _six(found.keys[part]), runs.tobytes(), np.packbits(found.several[part]).tobytes(), None))
        return _sent(rows)

    def send_fragments(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent([])
        chunk = _chunk(table, _copied(table, notes), length, width)
        found = Anchors.of(chunk, buckets)
        sent = Fragments.of(chunk, found, *_masks(notes, found), buckets, length)
        cuts = np.append(np.flatnonzero(np.concatenate(([True], np.diff(sent.bucket) != 0))), len(sent.bucket)) if len(sent.bucket) else np.zeros(1, np.int64)
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = sent.strings[a:b]
            rows.append((number(table), int(sent.bucket[a]), _six(sent.keys[a:b]), np.array([len(s) for s in own], np.uint32).tobytes(),
                         sent.owner[a:b].tobytes(), b"".join(own)))
        return _sent(rows)

    def finish(table: pa.Table, notes: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            copied = _copied(table, notes)
            chunk = _chunk(table, copied, length, width)
            found = Anchors.of(chunk, buckets)
            sent = Fragments.of(chunk, found, *_masks(notes, found), buckets, length)
            gone = _removed(chunk, sent, notes, length)
            for i, doc in enumerate(chunk.ids.tolist()):
                data, out = (x[chunk.starts[i]:chunk.starts[i + 1]] for x in (chunk.text, gone))
                n = int(np.count_nonzero(out))
                kept = data[~out].tobytes() if n else data.tobytes()
                spans = int(out[0]) + int(np.count_nonzero(out[1:] & ~out[:-1])) if n else 0
                rows.append((doc, len(data), n, spans, _digest(kept), kept if with_kept else None))
            whole = table.filter(pa.array(copied))
            for doc, text in zip(whole.column("doc_id").to_pylist(), whole.column("text").to_pylist(), strict=True):
                rows.append((doc, len(text), len(text), 1, _digest(b""), b"" if with_kept else None))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"), columns, kinds, strict=True)})

    dealt = texts.groupBy("chunk")
    anchors_sent = dealt.cogroup(copies.groupBy("chunk")).applyInArrow(send_anchors, SENT)
    shared = anchors_sent.groupBy("bucket").applyInArrow(lambda t: _answer_anchors(t, hot), NOTES)
    told = copies.unionByName(shared)
    fragments_sent = dealt.cogroup(told.groupBy("chunk")).applyInArrow(send_fragments, SENT)
    runs = fragments_sent.groupBy("bucket").applyInArrow(lambda t: _answer_fragments(t, length), NOTES)
    done = dealt.cogroup(told.unionByName(runs).groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    done = done.withColumn("doc_id", F.nullif("doc_id", F.lit(_LAST)))
    return done if with_kept else done.drop("kept")
