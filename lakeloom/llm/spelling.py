"""Spelling variants: words one edit apart, found through a trie over letter-group counts.

A word is a vector: how many of its letters fall into each of ``GROUPS`` letter groups.  Words
are arranged in a trie by the first count, the second, and so on.  One edit adds one letter
(surplus one), takes one away (deficit one) or does both, so a depth-first search may spend a
surplus and a deficit of one each; words at the leaves it reaches are verified letter by letter.

The trie is dealt out: a node of more words than a task should hold is cut into its children,
and each word is sent to the nodes it can reach.  Nothing is capped: a single vector shared by too
many words is cut by a hash of the word, and queries go to every part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.text import lower_ascii
from lakeloom.session import stage

GROUPS = 24
#: Words of one node that a task searches; above NODES times as many words in all, their share.
NODE_WORDS = 4096
NODES = 10_000
#: Letters that are dealt to groups by their frequency; rarer ones by code point.
LETTERS = 256
#: Trie nodes of so few words are compared with all remaining counts at once.
LEAF = 16
#: Pairs that are verified side by side, and the longest words for which that is done.
BLOCK = 1 << 16
WIDE = 64


# ---- vectors ----------------------------------------------------------------------------------

def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and the length of each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def group_table(counts: dict[int, int]) -> dict[int, int]:
    """{code point: group}: letters by falling frequency, dealt to and fro over the groups."""
    ranked = sorted(counts, key=lambda c: (-counts[c], c))[:LETTERS]
    there_and_back = [*range(GROUPS), *reversed(range(GROUPS))]
    return {c: there_and_back[i % len(there_and_back)] for i, c in enumerate(ranked)}


def vectors(words: list[str], table: dict[int, int]) -> np.ndarray:
    """A row of ``GROUPS`` counts for each word."""
    flat, lengths = code_points(words)
    kinds, place = np.unique(flat, return_inverse=True)
    group = np.array([table.get(int(c), int(c) % GROUPS) for c in kinds], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    cells = np.bincount(owner * GROUPS + (group[place] if len(kinds) else 0), minlength=len(words) * GROUPS)
    return cells.reshape(len(words), GROUPS).astype(">i4")


# ---- one node ---------------------------------------------------------------------------------

def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


class Letters:
    """Words as two letter matrices, read from the front and from the end, to verify many pairs."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = min(WIDE, int(self.length.max(initial=0)))
        self.front = np.zeros((len(words), width), dtype="<u4")
        self.back = np.zeros((len(words), width), dtype="<u4")
        short = np.flatnonzero(self.length <= width)
        flat, lengths = code_points([words[i] for i in short])
        row = np.repeat(short, lengths)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.front[row, column] = flat
        self.back[row, np.repeat(lengths, lengths) - 1 - column] = flat

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of places are one edit apart."""
        out = np.zeros(len(a), dtype=bool)
        longest = np.maximum(self.length[a], self.length[b])
        wide = longest > self.front.shape[1]
        for k in np.flatnonzero(wide):
            out[k] = one_edit(self.words[a[k]], self.words[b[k]])
        rest = np.flatnonzero(~wide & (a != b))
        for start in range(0, len(rest), BLOCK):
            k = rest[start:start + BLOCK]
            width = self.front.shape[1]
            least = np.minimum(self.length[a[k]], self.length[b[k]])
            differ = self.front[a[k]] != self.front[b[k]]
            head = np.minimum(np.where(differ.any(1), differ.argmax(1), width), least)
            differ = self.back[a[k]] != self.back[b[k]]
            tail = np.minimum(np.where(differ.any(1), differ.argmax(1), width), least)
            out[k] = (head < longest[k]) & (head + tail >= longest[k] - 1) & (longest[k] - least <= 1)
        return out


def search(counts: np.ndarray, members: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query place, member place) whose vectors differ by a surplus and a deficit of one at
    most: depth first over the trie of the members, all queries that are still within their budget
    side by side."""
    members = members[np.lexsort(counts[members].T[::-1])]
    kind = np.int16 if counts.max(initial=0) < 30_000 // GROUPS else np.int32  # a sum of gaps must fit
    sorted_counts, wanted = counts[members].astype(kind), counts[queries].astype(kind)
    none = np.zeros(len(queries), dtype=kind)
    pending = [(0, len(members), 0, np.arange(len(queries)), none, none)]
    while pending:
        low, high, level, alive, surplus, deficit = pending.pop()
        if high - low <= LEAF or level == GROUPS:
            step = max(1, BLOCK // (high - low))
            for start in range(0, len(alive), step):
                some = slice(start, start + step)
                gap = wanted[alive[some], None, level:] - sorted_counts[None, low:high, level:]
                more = surplus[some, None] + np.maximum(gap, 0).sum(2, dtype=kind)
                less = deficit[some, None] + np.maximum(-gap, 0).sum(2, dtype=kind)
                q, m = np.nonzero((more <= 1) & (less <= 1))
                yield queries[alive[some][q]], members[low + m]
            continue
        values, starts = np.unique(sorted_counts[low:high, level], return_index=True)
        for value, first, last in zip(values, starts, [*starts[1:], high - low], strict=True):
            gap = wanted[alive, level] - value
            more, less = surplus + np.maximum(gap, 0), deficit + np.maximum(-gap, 0)
            keep = (more <= 1) & (less <= 1)
            if keep.any():
                pending.append((low + first, low + last, level + 1, alive[keep], more[keep], less[keep]))


def near_words(words: list[str], n: np.ndarray, is_member: np.ndarray, table: dict[int, int]) -> pd.DataFrame:
    """For every query word of a node: how many of the node's words are one edit away, and the one
    with most occurrences (ties: the first by code points)."""
    members, queries = np.flatnonzero(is_member), np.flatnonzero(~is_member)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(members) and len(queries):
        letters = Letters(words)
        for q, m in search(vectors(words, table), members, queries):
            real = letters.near(q, m)
            found.append((q[real], m[real]))
    q = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.int64)
    m = np.concatenate([f[1] for f in found]) if found else np.zeros(0, dtype=np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[m], -n[m], q))
    q, m = q[order], m[order]
    own, first, near = np.unique(q, return_index=True, return_counts=True)
    best = m[first]
    return pd.DataFrame({"word": pd.Series([words[i] for i in own], dtype=object), "n_near": near.astype(np.int64),
                         "best_n": n[best].astype(np.int64), "best": pd.Series([words[i] for i in best], dtype=object)})


# ---- the trie over tasks ----------------------------------------------------------------------

def reach(vector: np.ndarray, heavy: dict[bytes, int], light: set[bytes]) -> list[tuple[bytes, int]]:
    """The nodes that words within a surplus and a deficit of one lie in, each with its number of
    parts: depth first through the cut nodes."""
    out, pending = [], [(b"", 0, 0)]
    while pending:
        node, surplus, deficit = pending.pop()
        level = len(node) // 4
        if node and node not in heavy:
            if node in light:
                out.append((node, 1))
            continue
        if level == GROUPS:
            out.append((node, heavy[node]))
            continue
        own = int(vector[level])
        for value in range(own - (1 - surplus), own + (1 - deficit) + 1):
            if value >= 0:
                pending.append((node + value.to_bytes(4, "big"), surplus + max(own - value, 0), deficit + max(value - own, 0)))
    # without any cut node the whole trie is one node
    return out


def home(vector: np.ndarray, heavy: dict[bytes, int]) -> bytes:
    """The node a word lies in: its shortest prefix that is not cut."""
    whole = vector.tobytes()
    for level in range(1, GROUPS + 1):
        if whole[:4 * level] not in heavy:
            return whole[:4 * level]
    return whole


def near_by_word(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """``words`` (word: distinct and not null, n) to rows (word, n_near, best_n, best) for words that
    have a near one.  ``words`` should be stored.

    At most ``NODES`` times the trie's depth cut nodes go through the driver."""
    def letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds, n = np.unique(code_points(batch["word"].tolist())[0], return_counts=True)
            yield pd.DataFrame({"letter": kinds.astype(np.int64), "n": n})

    seen = words.select("word").mapInPandas(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    table = group_table({r["letter"]: r["n"] for r in seen.orderBy(F.desc("n"), "letter").limit(LETTERS).collect()})
    limit = max(node_words, words.count() // NODES)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = vectors(batch["word"].tolist(), table)
            for level in range(1, GROUPS + 1):
                nodes, n = np.unique(np.ascontiguousarray(found[:, :level]).view(f"V{4 * level}"), return_counts=True)
                yield pd.DataFrame({"node": [x.tobytes() for x in nodes], "parent": [x.tobytes()[:-4] for x in nodes], "n": n})

    nodes = stage(words.select("word").mapInPandas(prefixes, "node binary, parent binary, n long")
                  .groupBy("node", "parent").agg(F.sum("n").alias("n")), "trie")
    cut = F.col("n") > limit
    heavy = {bytes(r["node"]): -(-r["n"] // limit) for r in nodes.filter(cut).select("node", "n").collect()}
    cut_nodes = nodes.filter(cut).select(F.col("node").alias("parent"))
    light_rows = nodes.filter(~cut).join(cut_nodes, "parent", "left_semi").unionByName(nodes.filter(~cut & (F.octet_length("parent") == 0)))
    light = {bytes(r["node"]) for r in light_rows.select("node").collect()}
    seeds = words.sparkSession.sparkContext.broadcast((table, heavy, light))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, heavy, light = seeds.value
        deepest = max((len(x) // 4 for x in (*heavy, *light)), default=1)
        known: dict[bytes, list[tuple[bytes, int]]] = {}
        for batch in batches:
            found = vectors(batch["word"].tolist(), table)
            out: dict[str, list] = {"node": [], "part": [], "word": [], "n": [], "member": []}
            for word, n, vector in zip(batch["word"], batch["n"], found, strict=True):
                start = vector[:deepest].tobytes()
                if start not in known:
                    known[start] = reach(vector, heavy, light)
                for node, parts in known[start]:
                    for part in range(parts):
                        for column, value in zip(out, (node, part, word, n, False), strict=True):
                            out[column].append(value)
                own = home(vector, heavy)
                for column, value in zip(out, (own, hash_part(word, heavy.get(own, 1)), word, n, True), strict=True):
                    out[column].append(value)
            yield pd.DataFrame(out)

    def one_node(group: pd.DataFrame) -> pd.DataFrame:
        return near_words(group["word"].tolist(), group["n"].to_numpy(dtype=np.int64), group["member"].to_numpy(dtype=bool), seeds.value[0])

    sent = words.select("word", "n").mapInPandas(route, "node binary, part int, word string, n long, member boolean")
    found = sent.groupBy("node", "part").applyInPandas(one_node, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def hash_part(word: str, parts: int) -> int:
    """The part of a cut leaf that a word lies in; the same in every process."""
    return sum(c * 31 ** (i % 64) for i, c in enumerate(word.encode("utf-8", "surrogatepass"))) % parts


# ---- variants ---------------------------------------------------------------------------------

def variants(words: DataFrame, ratio: int = 5, node_words: int = NODE_WORDS) -> DataFrame:
    """``words`` (word, n) to word, form, root, n, n_near, form_n.

    ``form`` is the near word with most occurrences (ties: the first by code points) if it has
    ``ratio`` times those of the word; ``root`` follows forms to the last one.  Rows without a word
    are left out, repeated words are summed (a null n counts as none), other columns are dropped;
    no rows give no rows.  Forms have ever more occurrences, so there are no circles, and doubling
    the step needs few rounds."""
    known = stage(words.filter(F.col("word").isNotNull()).groupBy("word").agg(
        F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("n")), "words")
    near = near_by_word(known, node_words)
    enough = (F.col("best_n") >= ratio * F.col("n")) & (F.col("best_n") > F.col("n"))
    judged = stage(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "forms")
    steps = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stage(steps.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not steps.filter("moved").head(1):
            break
    return judged.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def slipped(run: Column, row_id: Column, every: int) -> Column:
    """``run`` without one letter where ``every`` divides the crc32 of ``<row id>:<run>``: the typing
    slips that the query plants."""
    h = F.crc32(F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = F.pmod(h, F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def count_words(docs: DataFrame, letters: str, shortest: int, least: int, slip_every: int | None = None) -> DataFrame:
    """Words of all texts (maximal runs of ``letters``, A-Z lower-cased) of ``shortest`` code points
    or more and ``least`` occurrences or more: word, n.  Null texts have none."""
    run = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{letters}]{{{shortest},}}"), F.lit(0)))
    runs = docs.select(F.col("doc_id").alias("id"), run.alias("run")).select("id", lower_ascii(F.col("run")).alias("run"))
    word = F.col("run") if slip_every is None else slipped(F.col("run"), F.col("id"), slip_every)
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
