"""Mixing overlapping sources to target weights by min-cost flow.

Documents that belong to the same sources form a pattern.  Only patterns, sources and their
sizes reach the flow network; documents are then picked where they are, in seeded order."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.text import free, word_count
from lakeloom.session import stage

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all sizes that the mix is to have, and how often a document may be taken.
TOTAL = 1.5
EPOCHS = 2
SEED = 7
#: Patterns and sources the network may have; they are fetched to the driver.
MAX_PATTERNS = 200_000
#: Documents a bucket of the seeded order has on average.
BUCKET_ROWS = 5_000


def water_fill(sizes: dict, weights: dict, total: float, cap: float) -> dict:
    """Targets by weight that stop at ``cap`` times the source's size; what is above goes to the
    other sources by weight, until none is above."""
    targets: dict = {}
    left, open_ = total, set(sizes)
    while open_:
        whole = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / whole > cap * sizes[s]}
        if not full:
            return targets | {s: left * weights[s] / whole for s in open_}
        targets |= {s: float(cap * sizes[s]) for s in full}
        open_ -= full
        left = total - sum(targets.values())
    return targets


def _order(source: str | None) -> tuple:
    return (source is None, source or "")


def source_targets(sizes: dict, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, cap: float = EPOCHS) -> dict:
    """Target of every source; weights are dealt to the sources in code point order, null last."""
    dealt = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=_order))}
    return water_fill(sizes, dealt, total * sum(sizes.values()), cap)


def min_cost_flow(patterns: list[tuple[tuple, int]], targets: dict, epochs: int = EPOCHS) -> dict:
    """{(pattern number, epoch, source): words} that meet the targets as far as can be, at the
    least cost.  Every further use of a pattern's documents costs more than the one before
    (convex), so first copies are used wherever they reach a target.

    Successive shortest paths with potentials over source node, one arc for each use of a
    pattern, arcs to its sources, and quota arcs to the sink."""
    sources = sorted({s for names, _ in patterns for s in names}, key=_order)
    first = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    size = 2 + len(patterns) + len(sources)
    graph: list[list[int]] = [[] for _ in range(size)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, capacity: float, price: int) -> int:
        for start, end, left, paid in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[start].append(len(to))
            to.append(end)
            room.append(left)
            cost.append(paid)
        return len(to) - 2

    uses = {(i, e): arc(0, 2 + i, n, e * e) for i, (_, n) in enumerate(patterns) for e in range(epochs)}
    routes = {(i, s): arc(2 + i, first[s], epochs * n, 0) for i, (names, n) in enumerate(patterns) for s in names}
    for s in sources:
        arc(first[s], 1, int(targets.get(s, 0)), 0)
    level = [0] * size
    while True:
        distance = [float("inf")] * size
        distance[0], came, heap = 0, [-1] * size, [(0, 0)]
        while heap:
            d, at = heapq.heappop(heap)
            if d > distance[at]:
                continue
            for e in graph[at]:
                if room[e] > 0 and (new := d + cost[e] + level[at] - level[to[e]]) < distance[to[e]]:
                    distance[to[e]], came[to[e]] = new, e
                    heapq.heappush(heap, (new, to[e]))
        if came[1] < 0:
            break
        level = [p + d if d < float("inf") else p for p, d in zip(level, distance, strict=True)]
        _blocking_flow(graph, to, room, cost, level)
    flow: dict = {}
    for i, (names, _) in enumerate(patterns):
        wanted = [(s, room[routes[i, s] + 1]) for s in sorted(names, key=_order)]
        for e in range(epochs):
            left = room[uses[i, e] + 1]
            for k, (s, n) in enumerate(wanted):
                used = min(left, n)
                if used:
                    flow[i, e, s] = used
                wanted[k], left = (s, n - used), left - used
    return flow


def _blocking_flow(graph: list, to: list, room: list, cost: list, level: list) -> None:
    """Sends flow from node 0 to node 1 along arcs of no reduced cost until none is left."""
    place = [0] * len(graph)
    path: list[int] = []
    on_path = {0}
    at = 0
    while True:
        if at == 1:
            sent = min(room[e] for e in path)
            for e in path:
                room[e] -= sent
                room[e ^ 1] += sent
            cut = next(k for k, e in enumerate(path) if not room[e])
            for e in path[cut:]:
                on_path.discard(to[e])
            at = to[path[cut] ^ 1]
            del path[cut:]
            continue
        while place[at] < len(graph[at]):
            e = graph[at][place[at]]
            if room[e] > 0 and to[e] not in on_path and cost[e] + level[at] - level[to[e]] == 0:
                break
            place[at] += 1
        if place[at] < len(graph[at]):
            path.append(graph[at][place[at]])
            at = to[path[-1]]
            on_path.add(at)
        elif path:
            on_path.discard(at)
            at = to[path.pop() ^ 1]
            place[at] += 1
        else:
            return


def _seeded(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``docs`` with ``at``: the words that stand before it in its pattern's seeded order.

    The order is cut into buckets by hash, so no task sorts a whole pattern."""
    spread = docs.join(F.broadcast(patterns.select("pattern", "buckets")), "pattern").withColumn(
        "bucket", F.floor(F.col("draw") * F.col("buckets")).cast("long"))
    before = (spread.groupBy("pattern", "bucket").agg(F.sum("size").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("n"))
              .drop("n"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size", "row")
    running = spread.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return running.join(before, ["pattern", "bucket"]).withColumn("at", F.col("before") + F.col("run")).drop("buckets", "before", "run")


def _fill(chosen: DataFrame, cuts: dict[int, list]) -> DataFrame:
    """(row, more [(epoch, source), ...]) of the documents that meet what the cuts left open.

    The seeded order goes on past a document that does not fit: it is cut again and again over
    the unused documents of at most the open size, until none of a use is that small.  Then the
    one document that brings a use nearer, if any, is added."""
    spark = chosen.sparkSession
    done = {(r["pattern"], r["epoch"]): r["n"] for r in chosen.select("pattern", "size", F.explode("uses.epoch").alias("epoch"))
            .groupBy("pattern", "epoch").agg(F.sum("size").alias("n")).collect()}
    ends = {(i, e): max(c[3] for c in own if c[0] == e) for i, own in cuts.items() for e in {c[0] for c in own}}
    rest = {key: end - done.get(key, 0) for key, end in ends.items()}
    last = {(i, c[0]): c[1] for i, own in cuts.items() for c in own}
    schema = "row long, epoch int, source string"
    found = spark.createDataFrame([], schema)

    def wanted() -> DataFrame:
        return F.broadcast(spark.createDataFrame(
            [(i, e, n, ends[i, e], [(c[1], c[3]) for c in cuts[i] if c[0] == e]) for (i, e), n in rest.items() if n > 0],
            "pattern int, epoch int, rest long, end long, own array<struct<source: string, high: long>>"))

    unused = chosen.select("pattern", "bucket", "draw", "doc_id", "size", "row", F.explode("open.epoch").alias("epoch"))
    buckets = Window.partitionBy("pattern", "epoch").orderBy("bucket")
    inside = Window.partitionBy("pattern", "epoch", "bucket").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size", "row")
    while any(n > 0 for n in rest.values()):
        fits = stage(unused.join(wanted(), ["pattern", "epoch"]).filter(F.col("size") <= F.col("rest")), "fits")
        before = (fits.groupBy("pattern", "epoch", "bucket").agg(F.sum("size").alias("n"))
                  .withColumn("before", F.sum("n").over(buckets) - F.col("n")).drop("n"))
        at = F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
        middle = 2 * (F.col("end") - F.col("rest") + F.col("at")) + F.col("size")
        placed = stage(fits.join(before, ["pattern", "epoch", "bucket"]).withColumn("at", at)
                       .withColumn("taken", F.col("at") + F.col("size") <= F.col("rest"))
                       .withColumn("source", F.get(F.filter("own", lambda c: middle < 2 * c["high"]), F.lit(0))["source"])
                       .drop("before", "at", "rest", "end", "own"), "fits")
        met = placed.filter("taken").groupBy("pattern", "epoch").agg(F.sum("size").alias("n")).collect()
        if not met:
            break
        for r in met:
            rest[r["pattern"], r["epoch"]] -= r["n"]
        found = found.unionByName(placed.filter("taken").select("row", "epoch", "source"))
        unused = placed.filter("NOT taken").drop("taken", "source")

    near = F.abs(F.col("rest") - F.col("size"))
    best = (chosen.select("pattern", "doc_id", "size", "row", F.explode("open.epoch").alias("epoch"))
            .join(wanted(), ["pattern", "epoch"]).filter(near < F.col("rest"))
            .join(found.select("row", "epoch"), ["row", "epoch"], "left_anti")
            .groupBy("pattern", "epoch").agg(F.min(F.struct(near.alias("off"), "doc_id", "size", "row")).alias("best")).collect())
    nearest = spark.createDataFrame([(r["best"]["row"], r["epoch"], last[r["pattern"], r["epoch"]]) for r in best], schema)
    return found.unionByName(nearest).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("epoch", "source"))).alias("more"))


def mix(docs: DataFrame, member_of: Column | None = None, size: Column | None = None, weights: tuple[float, ...] = WEIGHTS,
        total: float = TOTAL, epochs: int = EPOCHS, seed: int = SEED, id_column: str = "doc_id",
        keep: tuple[str, ...] = ()) -> tuple[DataFrame, dict, dict]:
    """(decisions, source sizes, targets).  Decisions have one row per row of ``docs``: doc_id,
    sources, size, taken (words the mix takes, repeats counted), copies ([source, ...], one for
    each time the document is taken) and the columns named in ``keep``.

    ``member_of`` is an array of the sources a document belongs to (default: its ``source``;
    null is a source of its own).  A document is taken whole, ``epochs`` times at most.  In each
    use of a pattern the seeded order is cut where the flow says; what the cut leaves open is
    met by the unused documents that fit, in the same order, until none is as small.  Empty or null texts have
    size 0 and are not taken; rows may repeat and are judged one by one; no rows give no rows."""
    member_of = F.array(F.col("source").cast("string")) if member_of is None else F.array_sort(F.array_distinct(F.coalesce(member_of, F.array(F.lit(None).cast("string")))))
    size = word_count(F.col("text").cast("string")) if size is None else size
    # rows without a doc_id are told apart by their text, so that they do not share one place
    text = F.xxhash64(F.col("text").cast("string")) if "text" in docs.columns else F.lit(0).cast("long")
    name = F.coalesce(F.col(id_column).cast("long"), text)
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), member_of.alias("sources"), size.cast("long").alias("size"),
                         F.shiftrightunsigned(F.xxhash64(F.lit(seed), name), 12).alias("draw"), *keep)
    draw = F.col("draw").cast("double") / F.lit(float(1 << 52))
    narrow = stage(narrow.withColumn("draw", draw).withColumn("row", F.monotonically_increasing_id()), "mix")

    groups = narrow.groupBy("sources").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(MAX_PATTERNS + 1).collect()
    if len(groups) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} patterns of sources; group sources before mixing")
    groups = sorted(groups, key=lambda r: [_order(s) for s in r["sources"]])
    patterns = [(tuple(r["sources"]), r["size"]) for r in groups]
    sizes: dict = {}
    for names, n in patterns:
        for s in names:
            sizes[s] = sizes.get(s, 0) + n
    targets = source_targets(sizes, weights, total * sum(n for _, n in patterns) / max(1, sum(sizes.values())), epochs)
    flow = min_cost_flow(patterns, targets, epochs)

    cuts: dict[int, list] = {i: [] for i in range(len(patterns))}
    for (i, e, s), n in sorted(flow.items(), key=lambda x: (x[0][0], x[0][1], _order(x[0][2]))):
        start = cuts[i][-1][3] if cuts[i] and cuts[i][-1][0] == e else 0
        cuts[i].append((e, s, start, start + n))
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(list(names), i, max(1, -(-groups[i]["rows"] // BUCKET_ROWS)), cuts[i]) for i, (names, _) in enumerate(patterns)],
        "sources array<string>, pattern int, buckets long, cuts array<struct<epoch: int, source: string, low: long, high: long>>")
    numbered = narrow.join(F.broadcast(table.select(F.col("sources").alias("_s"), "pattern")),
                           F.to_json(F.struct("sources")) == F.to_json(F.struct(F.col("_s").alias("sources")))).drop("_s")
    placed = _seeded(numbered, table).join(F.broadcast(table.select("pattern", "cuts")), "pattern")
    # one entry for each use that reaches the document: where the use ends, and the source at the
    # document's middle
    end = F.col("at") + F.col("size")
    last = F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: F.struct(
        e.alias("epoch"), F.array_max(F.transform(F.filter("cuts", lambda c: c["epoch"] == e), lambda c: c["high"])).alias("high")))
    uses = F.transform(F.filter(last, lambda u: (end <= u["high"]) & (F.col("size") > 0)), lambda u: F.struct(
        u["epoch"].alias("epoch"),
        F.element_at(F.filter("cuts", lambda c: (c["epoch"] == u["epoch"]) & (2 * F.col("at") + F.col("size") < 2 * c["high"])), 1)["source"].alias("source")))
    open_uses = F.filter(last, lambda u: (end > u["high"]) & (F.col("size") > 0))
    chosen = stage(placed.withColumn("uses", uses).withColumn("open", open_uses).drop("cuts", "at"), "mixed")

    copies = F.concat(F.transform("uses", lambda u: u["source"]),
                      F.coalesce(F.transform("more", lambda u: u["source"]), F.array().cast("array<string>")))
    decided = (chosen.join(_fill(chosen, cuts), "row", "left").withColumn("copies", copies)
               .withColumn("taken", F.size("copies") * F.col("size"))
               .select("doc_id", "sources", "size", F.col("taken").cast("long").alias("taken"), "copies", *keep))
    return decided, sizes, targets


def source_table(docs: DataFrame, sizes: dict, targets: dict) -> DataFrame:
    """(source, source_size, target), one row for each source that the network knew."""
    return docs.sparkSession.createDataFrame([(s, sizes[s], float(targets[s])) for s in sizes],
                                             "source string, source_size long, target double")


def mixed_rows(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns.

    Rows are stored once with a number of their own, by which each gets its own copies, so null or
    repeated doc_ids, also over several sources, take what ``mix`` decides for them."""
    name, n = free(docs.columns, "name"), free(docs.columns, "n")
    numbered = stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    decided, _, _ = mix(numbered, id_column=id_column, keep=(name,), **options)
    copies = decided.filter(F.size("copies") > 0).select(F.col(name), F.sequence(F.lit(1), F.size("copies")).alias(n))
    met = numbered.join(copies, name)
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(n).alias(n)).drop(n)
