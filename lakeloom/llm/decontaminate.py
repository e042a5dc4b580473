"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.text import ALNUM, blocks, text_bytes

WINDOW = 10
#: Words all items may have together: the automaton is broadcast and has two states a word at most.
MAX_ITEM_WORDS = 4_000_000
_BREAK = b"|"  # stands between documents; no word, since words have no ASCII punctuation
_FIND = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII bytes."""
    return text.translate(ALNUM).split()


@dataclass
class Automaton:
    """Suffix automaton over word numbers, with what to report where.

    ``next``, ``link`` and ``length`` are the automaton.  ``windows[v]`` are the items that hold
    the ``window``-word strings of state v; ``short[v]`` are (words, item) of whole items below
    ``window`` words that end where a match reaches state v.  ``top[v]`` is the state above v that
    holds its last ``window`` words, found once, so that a match costs one look however long it is."""
    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    windows: dict[int, frozenset] = field(default_factory=dict)
    short: dict[int, list[tuple[int, str | None]]] = field(default_factory=dict)
    top: list[int] = field(default_factory=list)
    pairs: np.ndarray | None = None
    least: int = 0

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, word, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return cur

    def _split(self, p: int, word: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p != -1 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        link[q] = clone
        return clone

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matching length) of every word of a stream."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for at, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(word)
            if to is not None:
                state = to
                size += 1
            yield at, state, size

    def scan(self, words: list[int]) -> tuple[np.ndarray, set]:
        """Which words of a stream are hit, and the items whose windows occur in it."""
        hit = np.zeros(len(words) + 1, np.int32)
        items: set = set()
        for at, state, size in self.matches(words):
            if size >= self.window:
                items |= self.windows[self.top[state]]
                hit[at - self.window + 1] += 1
                hit[at + 1] -= 1
            for n, item in self.short.get(state, ()):
                if n <= size:
                    items.add(item)
                    hit[at - n + 1] += 1
                    hit[at + 1] -= 1
        return np.cumsum(hit[:-1]) > 0, items


def build(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> Automaton:
    """The automaton of (item id, text) pairs; items without words take no part."""
    made = Automaton(window)
    texts = [(name, [made.vocabulary.setdefault(w, len(made.vocabulary)) for w in words_of(text)]) for name, text in items]
    texts = [(name, words) for name, words in texts if words]
    for _, words in texts:
        last = 0
        for word in words:
            last = made._extend(last, word)
    by_length = sorted(range(len(made.next)), key=made.length.__getitem__)
    made.top = list(range(len(made.next)))
    for state in by_length:
        if made.link[state] >= 0 and made.length[made.link[state]] >= window:
            made.top[state] = made.top[made.link[state]]
    own: dict[int, set] = {}
    ends: dict[int, list] = {}
    for name, words in texts:
        state = -1
        for at, state, size in made.matches(words):
            if size >= window and at + 1 >= window:
                own.setdefault(made.top[state], set()).add(name)
        if len(words) < window:
            while made.length[made.link[state]] >= len(words):
                state = made.link[state]
            ends.setdefault(state, []).append((len(words), name))
    made.windows = {state: frozenset(names) for state, names in own.items()}
    if ends:  # a match ends wherever a suffix of what it has read is a whole item
        for state in by_length:
            found = ends.get(state, []) + made.short.get(made.link[state], [])
            if found:
                made.short[state] = found
    size = len(made.vocabulary)
    made.pairs = np.unique(np.array([a * size + b for _, words in texts for a, b in zip(words, words[1:])], np.int64))
    made.least = min((min(len(words), window) for _, words in texts), default=0)
    return made


def _runs(automaton: Automaton, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that can hold a window: known words, every two
    neighbours of which are neighbours in some item, as long as the shortest window."""
    if not automaton.least or not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = ids >= 0
    both = np.flatnonzero(known[:-1] & known[1:])
    joined = np.zeros(len(ids) + 1, bool)  # joined[i]: words i-1 and i belong together
    if len(automaton.pairs):
        keys = ids[both].astype(np.int64) * len(automaton.vocabulary) + ids[both + 1]
        place = np.minimum(np.searchsorted(automaton.pairs, keys), len(automaton.pairs) - 1)
        joined[both[automaton.pairs[place] == keys] + 1] = True
    starts = np.flatnonzero(known & ~joined[:-1])
    ends = np.flatnonzero(known & ~joined[1:]) + 1
    long = ends - starts >= automaton.least
    return starts[long], ends[long]


def scan_texts(automaton: Automaton, texts: list[bytes]) -> list[tuple[int, np.ndarray, set]]:
    """(words, numbers of the hit words, items) of each text."""
    words = (b" " + _BREAK + b" ").join([t.translate(ALNUM) for t in texts] + [b""]).split()
    ids = np.fromiter(map(automaton.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
    breaks = np.array([i for i, w in enumerate(words) if w == _BREAK], np.int64)
    firsts = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    hits: dict[int, list[np.ndarray]] = {}
    items: dict[int, set] = {}
    for start, end in zip(*(x.tolist() for x in _runs(automaton, ids)), strict=True):
        hit, found = automaton.scan(ids[start:end].tolist())
        if hit.any():
            doc = int(np.searchsorted(breaks, start))
            hits.setdefault(doc, []).append(np.flatnonzero(hit) + start - firsts[doc])
            items.setdefault(doc, set()).update(found)
    none = np.zeros(0, np.int64)
    return [(int(breaks[i] - firsts[i]), np.concatenate(hits[i]) if i in hits else none, items.get(i, set()))
            for i in range(len(texts))]


def automaton_of(benchmark: DataFrame, window: int = WINDOW, id_column: str = "item_id",
                 text_column: str = "text", max_words: int = MAX_ITEM_WORDS) -> Automaton:
    """Builds the automaton of a benchmark table, whose size is checked before it is fetched."""
    narrow = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > 2 * max_words:  # a word has a letter and a separator at least
        raise ValueError(f"test items of {size} bytes may have over {max_words} words; pass them in parts")
    return build(sorted(((r["item"], (r["text"] or "").encode()) for r in narrow.collect()), key=str), window)


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive word numbers as (first, last)."""
    if not len(hit):
        return []
    cut = np.flatnonzero(np.diff(hit) > 1)
    return list(zip(hit[np.concatenate(([0], cut + 1))].tolist(), hit[np.concatenate((cut, [len(hit) - 1]))].tolist(), strict=True))


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (ids as text, sorted), spans (runs of
    hit words as [first, last]).

    A window is ``window`` consecutive words of an item; an item of fewer, but not none, is one
    window.  Every document word inside an occurrence of a window is hit.  The whole text is
    streamed through the automaton; null texts have no words; rows may repeat; items that occur
    twice count once, items with a null id hit but are not listed; no rows give no rows, no
    items give no hits; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton_of(benchmark, window))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                found = scan_texts(shared.value, text_bytes(part.column("_text")))
                yield pa.record_batch([
                    part.column("doc_id"),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([len(hit) for _, hit, _ in found], pa.int64()),
                    pa.array([sorted(i for i in items if i is not None) for _, _, items in found], pa.list_(pa.string())),
                    pa.array([_spans(hit) for _, hit, _ in found], pa.list_(pa.list_(pa.int64()))),
                ], ["doc_id", "n_words", "n_hit", "items", "spans"])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("_text"))
    return narrow.mapInArrow(scan, "doc_id long, n_words long, n_hit long, items array<string>, spans array<array<long>>")


def cut_words(text: bytes, hit: np.ndarray) -> bytes:
    """The text without the hit words and what stands between two of them."""
    places = [m.span() for m in _FIND.finditer(text.translate(ALNUM))]
    for first, last in reversed(_spans(hit)):
        text = text[:places[first][0]] + text[places[last][1]:]
    return text


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5,
                  text_column: str = "text", count_column: str | None = "n_chars") -> DataFrame:
    """``docs`` with every run of hit words cut out of the text; a row of which more than
    ``max_coverage`` of the words is hit is removed.  All columns are kept; ``count_column``
    (if present) gets the new number of characters.  Rows without hits stay as they are, null
    and empty texts too."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton_of(benchmark, window))
    counted = count_column if dict(docs.dtypes).get(count_column) in ("bigint", "int") else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text_column):
                place = part.schema.get_field_index(text_column)
                texts = text_bytes(part.column(place))
                found = scan_texts(shared.value, texts)
                changed = {i: cut_words(texts[i], hit) for i, (_, hit, _) in enumerate(found) if len(hit)}
                if changed:
                    values = part.column(place).to_pylist()
                    for i, text in changed.items():
                        values[i] = text.decode()
                    part = part.set_column(place, part.schema.field(place), pa.array(values, part.schema.field(place).type))
                    if counted:
                        at = part.schema.get_field_index(counted)
                        counts = part.column(at).to_pylist()
                        for i in changed:
                            counts[i] = len(values[i])
                        part = part.set_column(at, part.schema.field(at), pa.array(counts, part.schema.field(at).type))
                keep = [len(hit) <= max_coverage * n for n, hit, _ in found]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
