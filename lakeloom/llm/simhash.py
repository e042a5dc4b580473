"""SimHash near-duplicate groups by tiled exact comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.text import LOWER, blocks, free, text_bytes
from lakeloom.session import stage

SEED = 42
#: Fingerprints a tile may hold; two tiles are compared in one task.
TILE = 65_536
#: Width of the population-count bands that tiles are made of.
BAND = 2


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values.

    No words give 0; fewer words than ``shingle`` make one shingle."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    spans = list(zip(starts[:n].tolist(), ends[k - 1:].tolist(), strict=True))
    for at in range(0, n, 16_384):
        packed = b"".join([digest(joined[a:b], SEED) for a, b in spans[at:at + 16_384]])
        ones += np.unpackbits(np.frombuffer(packed, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def signatures(docs: DataFrame, shingle: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number; null text is empty."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                prints = np.array([fingerprint(t, shingle) for t in text_bytes(part.column("_text"))], np.uint64)
                yield pa.record_batch([part.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("_text"))
    return narrow.mapInArrow(sign, "doc_id long, fp long")


def _half_counts() -> tuple[Column, Column]:
    return (F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int"),
            F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int"))


def _apart(a: int, b: int) -> int:
    """Least difference of two population counts that lie in bands a and b."""
    return max(0, (abs(a - b) - 1) * BAND + 1) if a != b else 0


def tile_pairs(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(pair, side, fp): every fingerprint once for each pair of tiles in which it is compared.

    A tile is a band of the population counts of both halves, cut by hash into parts of about
    ``tile`` fingerprints.  Two bit strings differ in at least as many bits as their population
    counts differ, half by half, so pairs of tiles further apart than ``radius`` are skipped.
    The bands (289 at most) and their sizes are the only thing the driver sees."""
    high, low = _half_counts()
    banded = prints.select("fp", F.floor(high / BAND).cast("int").alias("h"), F.floor(low / BAND).cast("int").alias("l"))
    sizes = {(r["h"], r["l"]): r["n"] for r in banded.groupBy("h", "l").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = {cell: -(-n // tile) for cell, n in sizes.items()}
    name = {cell: i for i, cell in enumerate(sorted(parts))}
    near = {a: [b for b in name if _apart(a[0], b[0]) + _apart(a[1], b[1]) <= radius] for a in name}
    table = [(a[0], a[1], name[a], parts[a], [(name[b], parts[b]) for b in near[a]]) for a in name]
    cells = prints.sparkSession.createDataFrame(
        table, "h int, l int, cell int, parts int, near array<struct<cell: int, parts: int>>")
    own = banded.join(F.broadcast(cells), ["h", "l"]).select(
        "fp", "cell", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.explode("near").alias("to"))
    met = own.select("fp", "cell", "part", F.col("to.cell").alias("to_cell"),
                     F.explode(F.sequence(F.lit(0), F.col("to.parts") - 1)).alias("to_part"))
    mine, other = F.struct("cell", "part"), F.struct(F.col("to_cell").alias("cell"), F.col("to_part").alias("part"))
    return met.select(
        F.struct(F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b")).alias("pair"),
        F.when(mine == other, 0).when(mine < other, 1).otherwise(2).alias("side"), "fp")


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles (within one tile if ``right`` is None) as a spanning forest.

    Blocks of the tiles are compared by exclusive or and bit counts, first on the upper 32
    bits, then on both halves of what is left.  Links are folded into labels block by block,
    so a group of near copies gives one link a member and never all its pairs."""
    every = left if right is None else np.concatenate([left, right])
    label = np.arange(len(every))
    other, offset = (left, 0) if right is None else (right, len(left))
    upper = (other >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(left), 128):
        rows = left[at:at + 128]
        top = (rows >> np.uint64(32)).astype(np.uint32)
        for to in range(at if right is None else 0, len(other), 4_096):
            close = np.bitwise_count(top[:, None] ^ upper[None, to:to + 4_096]) <= radius
            i, j = np.nonzero(close)
            hit = np.bitwise_count(rows[i] ^ other[to + j]) <= radius
            a, b = i[hit] + at, j[hit] + to + offset
            while len(a):
                la, lb = label[a], label[b]
                if (la == lb).all():
                    break
                least = np.minimum(la, lb)
                np.minimum.at(label, la, least)
                np.minimum.at(label, lb, least)
                while (label != label[label]).any():
                    label = label[label]
    child = np.flatnonzero(label != np.arange(len(label)))
    return every[child], every[label[child]]


def links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints of ``prints`` (fp, distinct) which
    links of at most ``radius`` differing bits connect.  No rows give no rows."""
    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        if (side == 0).any():
            a, b = _forest(fp, None, radius)
        else:
            a, b = _forest(fp[side == 1], fp[side == 2], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return tile_pairs(prints, radius, tile).groupBy("pair").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the least doc_id
    that can be reached over links.  Copies share a fingerprint, which is compared once.
    Null or empty texts have fingerprint zero and link like any other; rows may repeat; a null
    doc_id is kept and never a component_id unless its component has no other; no rows give no
    rows; other columns are ignored."""
    signed = stage(signatures(docs, shingle, id_column, text_column), "simhash")
    prints = signed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(stage(links(prints.select("fp"), radius, tile), "links")).withColumnsRenamed({"node": "fp"})
    rooted = prints.join(roots, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    group = rooted.filter("linked").groupBy("root").agg(F.min("least").alias("top"))
    named = (rooted.join(group, "root", "left")
             .select("fp", F.when(F.col("linked"), F.col("top")).otherwise(F.col("least")).alias("component_id")))
    return signed.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE,
                         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: its least doc_id.

    Rows with the same doc_id are one document, of which one row (by text) stays; a row without
    doc_id is named by its text.  All columns are kept."""
    name, nth = free(docs.columns, "name"), free(docs.columns, "nth")
    named = docs.withColumn(name, F.coalesce(docs[id_column].cast("long"), F.xxhash64(F.lit("no id"), docs[text_column])))
    found = stage(near_duplicates(named, shingle, radius, tile, name, text_column), "near")
    kept = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = named.join(kept.select(F.col("doc_id").alias(name)), name, "left_semi")
    if kept.filter("n > 1").limit(1).count():
        order = Window.partitionBy(name).orderBy(F.col(text_column).asc_nulls_last())
        first = first.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1)
    return first.select(*[f"`{c}`" for c in docs.columns])
