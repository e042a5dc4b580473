"""Chat formatting of reply trees: root-to-leaf paths by self-joins, the best paths of each tree,
and each of them as one conversation with a loss mask.

Paths are never spelt out for all leaves: doubling joins (the ancestors 1, 2, 4, ... above) first sum
the scores of every path, the paths of a tree are ranked by them, and only chosen paths are
then enumerated, again by one self-join for each power of two.  Joins carry ids and scores only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import join_null_safe
from lakeloom.operators.windows import row_number, running, with_windows
from lakeloom.session import stage

# ---- template ---------------------------------------------------------------------------------
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Characters of formatted text in one piece of a conversation, unless a single turn is longer.
PIECE_CHARS = 1 << 22


def escaped(text: Column) -> Column:
    r"""Text without control strings: ``<|``, ``<\|``, ``<\\|`` ... get one more backslash."""
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<$1\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<\\(\\*)\|"), F.lit(r"<$1|"))


def role_line(role: Column) -> Column:
    """A role on one line: backslash and line break are written out, then control strings escaped."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def role_of(line: Column) -> Column:
    plain = F.replace(unescaped(line), F.lit("\\\\"), F.lit("\\\0"))
    return F.replace(F.replace(plain, F.lit("\\n"), F.lit("\n")), F.lit("\\\0"), F.lit("\\"))


# ---- trees and paths --------------------------------------------------------------------------

def lifted(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``nodes`` (tree, node, parent, score; unique by tree and node) to (tree, node, leaf, depth,
    total: over the whole path from the root) and, for each power of two, the pairs (tree, node, up)
    of a node and its ancestor so many steps above.  Nodes that no root leads to (below a circle)
    are left out."""
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    placed = join_null_safe(nodes.select("tree", "node", "parent", "score"), known, ["tree", "parent"], "left")
    parent = F.when(F.col("known") & F.col("parent").isNotNull(), F.col("parent"))
    start = stage(placed.select("tree", "node", parent.alias("up"), F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total")), "lift")
    inner = start.filter("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct().withColumn("inner", F.lit(True))
    start = stage(join_null_safe(start, inner, ["tree", "node"], "left").withColumn("leaf", F.col("inner").isNull()).drop("inner"), "lift")
    # nodes whose path is summed up leave the rounds, so a round costs the nodes deeper than its power
    active, settled, jumps = start.filter("up IS NOT NULL"), start.filter("up IS NULL"), []
    rows = start.count()
    while active.head(1) and (1 << len(jumps)) <= rows:
        jumps.append(active.select("tree", "node", "up"))
        above = active.unionByName(settled).select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("above"))
        moved = stage(join_null_safe(active, above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("above")).alias("total"), "leaf"), "lift")
        active, settled = moved.filter("up IS NOT NULL"), settled.unionByName(moved.filter("up IS NULL"))
    return settled.drop("up"), jumps


def best_leaves(summed: DataFrame, paths: int = 1) -> DataFrame:
    """The leaves of the best ``paths`` paths of each tree with their rank from 1: by mean score of
    the path, then the longer path, then the smaller leaf."""
    ranked = F.expr("row_number() OVER (PARTITION BY tree ORDER BY total / depth DESC, depth DESC, node)")
    return summed.filter("leaf").withColumn("rank", ranked).filter(F.col("rank") <= paths).select("tree", "rank", "node", "depth")


def path_nodes(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """All nodes of the paths that end in ``leaves``: tree, rank, node, position (from 0 at the root).
    A step of a power of two is taken or not, so every ancestor is reached once."""
    found = leaves.select("tree", "rank", "node", (F.col("depth") - 1).alias("position"))
    for power in reversed(range(len(jumps))):
        up = join_null_safe(found, jumps[power], ["tree", "node"]).select(
            "tree", "rank", F.col("up").alias("node"), (F.col("position") - (1 << power)).alias("position"))
        found = stage(found.unionByName(up), "paths")
    return found


def chosen_turns(nodes: DataFrame, paths: int = 1) -> DataFrame:
    """``nodes`` (tree, node, parent, role, text, score) to the turns of the chosen paths: tree, rank,
    position, role, text.

    Of rows that share tree and node the one with the greatest score counts (ties: role, then text).
    A parent that is not there or null makes a root; nodes on a circle or below one have no root and
    are left out; null scores count zero, null roles and texts are empty; a null tree is a tree."""
    rest = F.struct("score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent")
    unique = stage(nodes.groupBy("tree", "node").agg(F.max(rest).alias("r")).select("tree", "node", "r.*"), "nodes")
    summed, jumps = lifted(unique)
    found = path_nodes(stage(best_leaves(summed, paths), "leaves"), jumps)
    return join_null_safe(found, unique.select("tree", "node", "role", "text"), ["tree", "node"]).drop("node")


# ---- conversations ----------------------------------------------------------------------------

def format_paths(turns: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``turns`` (tree, rank, position, role, text) to one conversation for each path: tree, rank, piece,
    start, formatted, loss.

    A conversation of more than ``piece_chars`` characters comes in several rows, in order of
    ``piece``, cut between turns; ``start`` is the place of the row's first character in the whole.
    ``loss`` lists the spans (start, end in code points of the whole) of the assistant's texts, which
    the loss is taken of.  No group is gathered beyond a piece."""
    text = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role_line(F.coalesce("role", F.lit(""))), F.lit("\n"))
    made = turns.select("tree", "rank", "position", (F.col("role") == "assistant").alias("learn"), head.alias("head"), text.alias("body"))
    segments = stage(made.select("tree", "rank", "position", "learn", F.char_length("head").alias("lead"), F.char_length("body").alias("chars"),
                                 F.concat("head", "body", F.lit(f"{CLOSE}\n")).alias("segment")).withColumn("size", F.char_length("segment").cast("long")), "segments")
    # sizes alone are summed up, then joined back to their segments
    keys = ["tree", "rank", "position"]
    placed = with_windows(segments.select(*keys, "size"), ["tree", "rank"], ["position"], {"upto": running("sum", "size")})
    start = placed.withColumn("start", F.col("upto") - F.col("size")).select(*keys, "start", F.floor(F.col("start") / piece_chars).alias("piece"))
    rows = join_null_safe(segments, start, keys)
    begin = F.col("start") + F.col("lead")
    one = F.struct("position", "start", "segment", F.when(F.col("learn"), F.struct(begin.alias("start"), (begin + F.col("chars")).alias("end"))).alias("span"))
    pieces = rows.groupBy("tree", "rank", "piece").agg(F.array_sort(F.collect_list(one)).alias("t"))
    return pieces.select("tree", "rank", "piece", F.col("t")[0]["start"].alias("start"), F.array_join("t.segment", "").alias("formatted"),
                         F.filter("t.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of formatted conversations: tree, rank, piece, place, role, text, learnt (the text that
    the loss mask covers, null where it covers none)."""
    parts = F.split("formatted", F.lit(r"<\|im_start\|>"))
    turn = formatted.select("tree", "rank", "piece", "start", "loss", F.posexplode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("place", "raw"))
    breaks = F.locate("\n", F.col("raw"))
    body = F.substring("raw", breaks + 1, F.char_length("raw") - breaks - len(CLOSE) - 1)
    spans = formatted.select("tree", "rank", "piece", F.posexplode("loss").alias("nth", "span"), "start", "formatted").select(
        "tree", "rank", "piece", "nth", unescaped(F.substring("formatted", (F.col("span.start") - F.col("start") + 1).cast("int"), (F.col("span.end") - F.col("span.start")).cast("int"))).alias("learnt"))
    turns = turn.select("tree", "rank", "piece", "place", F.lit(None).cast("string").alias("learnt"), role_of(F.substring("raw", F.lit(1), breaks - 1)).alias("role"), unescaped(body).alias("text"))
    return turns.unionByName(spans.select("tree", "rank", "piece", F.col("nth").alias("place"), "learnt", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its pieces: tree, rank, n_turns, turns_sha256 (role, line break,
    text, line break for each turn), loss_chars, loss_sha256 (what the mask covers, unescaped),
    formatted_chars.  Rows are streamed in order, so no conversation is held."""
    columns = ["key", "rank", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for batch in batches:
            done = []
            for key, rank, role, text, learnt in zip(*[batch[c].tolist() for c in ("key", "rank", "role", "text", "learnt")], strict=True):
                if (key, rank) != current:
                    if state:
                        done.append((*current, *state.row()))
                    current, state = (key, rank), _Digest()
                state.add(role, text, learnt)
            yield pd.DataFrame(done, columns=columns)
        if state:
            yield pd.DataFrame([(*current, *state.row())], columns=columns)

    kind = formatted.schema["tree"].dataType
    rows = read_back(formatted).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")))
    ordered = rows.repartition("key", "rank").sortWithinPartitions("key", "rank", "piece", "place").select("key", "rank", "role", "text", "learnt")
    found = ordered.mapInPandas(stream, "key string, rank int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    tree = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(kind)
    sizes = formatted.groupBy("tree", "rank").agg(F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"))
    return join_null_safe(found.withColumn("tree", tree).drop("key"), sizes, ["tree", "rank"])


class _Digest:
    """What is read of one conversation."""

    def __init__(self):
        self.turns, self.learnt, self.count, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0

    def add(self, role: str | None, text: str | None, learnt: str | None) -> None:
        if role is not None:
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.count += 1
        else:
            self.learnt.update(learnt.encode("utf-8", "surrogatepass"))
            self.chars += len(learnt)

    def row(self) -> tuple:
        return self.count, self.turns.hexdigest(), self.chars, self.learnt.hexdigest()


def chains(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as trees in which every turn answers the one before (null turns first,
    ties by role and text)."""
    plain = rows.select(F.col("conv_id").alias("tree"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    numbered = stage(with_windows(plain, ["tree"], ["turn", "role", "text"], {"node": row_number()}), "chains")
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
