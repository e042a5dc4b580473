"""Window functions that stay distributed when one key holds much of the table.

A plain ``Window.partitionBy(key)`` puts a whole key into one task.  Here a summary of the key
columns in bounded memory (``joins.frequent_keys``) finds the *hot* keys first.  Rows of
ordinary keys use the plain window.  Rows of a hot key are dealt out by ranges of the order
columns and cut into slices there; the window runs per (key, slice) and each slice receives
the running state of the slices before it.  Ranges only balance the work, so the result
is exact whatever they are.  Without partition keys the whole table is one key,
which gives a distributed global ``row_number`` or ``rank``.

Order columns are written ``"col"`` or ``"col desc"``; nulls sort first / last as Spark does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.joins import frequent_keys, join_null_safe
from lakeloom.session import setting, stage

HOT_ROWS = 2_000_000   # rows one task may hold of a single key


@dataclass(frozen=True)
class Spec:
    """One window column: ``running``, ``shift`` or ``frame``."""
    kind: str
    fn: str
    col: str | None = None
    offset: int = 0


def row_number() -> Spec:
    return Spec("running", "row_number")


def running(fn: str, col: str) -> Spec:
    """``fn`` in sum, count, avg, min, max, last over all rows up to the current one."""
    return Spec("running", fn, col)


def lag(col: str, offset: int = 1) -> Spec:
    return Spec("shift", "lag", col, offset)


def lead(col: str, offset: int = 1) -> Spec:
    return Spec("shift", "lead", col, offset)


def frame(fn: str, col: str, preceding: int) -> Spec:
    """``fn`` over the current row and ``preceding`` rows before it."""
    return Spec("frame", fn, col, preceding)


def _split(order: str) -> tuple[str, bool]:
    name, _, direction = order.strip().partition(" ")
    return name, direction.strip().lower() == "desc"


def sort_columns(order: list[str]) -> list[Column]:
    return [F.desc(n) if d else F.asc(n) for n, d in map(_split, order)]


def _window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*sort_columns(order))


_AGG = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}


def _plain(spec: Spec, window) -> Column:
    if spec.kind == "shift":
        return (F.lag if spec.fn == "lag" else F.lead)(spec.col, spec.offset).over(window)
    if spec.fn == "row_number":
        return F.row_number().over(window).cast("bigint")
    start = Window.unboundedPreceding if spec.kind == "running" else -spec.offset
    framed = window.rowsBetween(start, Window.currentRow)
    if spec.fn == "last":
        return F.last(spec.col, ignorenulls=True).over(framed)
    return _AGG[spec.fn](spec.col).over(framed)


@dataclass(frozen=True)
class Hot:
    """Keys too large for one task as rows ``(key..., _n)``, and the rows a slice may hold."""
    rows: list
    limit: int


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> Hot:
    """Finds the hot keys by ``frequent_keys``: keys are hashed to a fixed number of counters, and only
    those of full counters are counted.

    The limit does not move with the table, so there are at most as many as the table has
    rows over the limit.  The counts only steer the split, so they may come from an input that
    is filtered later."""
    limit = hot_rows or setting(df.sparkSession, "hotRows", HOT_ROWS)
    if not keys:
        return Hot(df.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).collect(), limit)
    return Hot(frequent_keys(df, keys, limit).withColumnRenamed("rows", "_n").collect(), limit)


def split_hot(df: DataFrame, keys: list[str], hot: Hot) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, hot rows).  The hot rows are staged once: the sample and both passes
    of a split window read them from storage instead of recomputing the plan."""
    if not keys:
        return df.filter(F.lit(False)), stage(df, "hot")
    schema = df.select(*keys).schema
    wanted = F.broadcast(df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot.rows], schema))
    return join_null_safe(df, wanted, keys, "left_anti"), stage(join_null_safe(df, wanted, keys, "left_semi"), "hot")


def _with_slices(hot_df: DataFrame, keys: list[str], order: list[str], hot: Hot) -> DataFrame:
    """Adds ``_slice``: ordered pieces of ``hot.limit`` rows at most inside each hot key.

    Rows are dealt out by ranges of keys and order and sorted in their task (on disk, if need be); a row's
    place there gives its slice, so it meets no list of bounds, whatever the number of slices.
    Stored, because a second run of the plan would draw other ranges."""
    placed = (hot_df.repartitionByRange(*[F.asc(k) for k in keys], *sort_columns(order))
              .sortWithinPartitions(*[F.asc(k) for k in keys], *sort_columns(order))
              .withColumn("_slice", F.monotonically_increasing_id()))
    return stage(placed.withColumn("_slice", F.col("_slice") - F.col("_slice") % hot.limit), "slices")


def _merge(fn: str, local: Column, carry: Column) -> Column:
    if fn in ("row_number", "count"):
        return local + F.coalesce(carry, F.lit(0).cast("bigint"))
    if fn == "sum":
        return F.coalesce(local + carry, local, carry)
    if fn == "last":
        return F.coalesce(local, carry)
    return (F.least if fn == "min" else F.greatest)(local, carry)


def _running_hot(df: DataFrame, keys: list[str], order: list[str], specs: dict[str, Spec]) -> DataFrame:
    """Running columns over a frame that carries ``_slice``."""
    parts: dict[str, Spec] = {"_rn": row_number()}
    for name, spec in specs.items():
        if spec.fn == "avg":
            parts[f"{name}__sum"] = running("sum", spec.col)
            parts[f"{name}__count"] = running("count", spec.col)
        else:
            parts[name] = spec
    window = _window([*keys, "_slice"], order)
    local = df.select("*", *[_plain(s, window).alias(n) for n, s in parts.items()])
    ends = local.groupBy(*keys, "_slice").agg(
        F.max_by(F.struct(*parts), F.col("_rn")).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    fold = {"row_number": F.sum, "count": F.sum, "sum": F.sum, "min": F.min, "max": F.max,
            "last": lambda c: F.last(c, ignorenulls=True)}
    carry = ends.select(
        *keys, "_slice",
        F.struct(*[fold[s.fn](F.col(f"_end.{n}")).over(before).alias(n) for n, s in parts.items()]).alias("_carry"))
    # one row per (hot key, slice)
    joined = join_null_safe(local, carry, [*keys, "_slice"])
    out = joined.select(
        *df.columns, *[_merge(s.fn, F.col(n), F.col(f"_carry.{n}")).alias(n) for n, s in parts.items()])
    for name, spec in specs.items():
        if spec.fn == "avg":
            out = out.withColumn(name, F.try_divide(F.col(f"{name}__sum"), F.col(f"{name}__count")))
            out = out.drop(f"{name}__sum", f"{name}__count")
    return out


def _shifted_hot(df: DataFrame, keys: list[str], specs: dict[str, Spec], limit: int) -> DataFrame:
    """Offset and bounded-frame columns over a frame that carries the position ``_rn``.

    Rows are cut into chunks of exactly ``size`` positions; the few rows near a border are
    also sent to the neighbouring chunk, computed there and dropped."""
    reach_back = max([s.offset for s in specs.values() if s.fn != "lead"], default=0)
    reach_on = max([s.offset for s in specs.values() if s.fn == "lead"], default=0)
    size = max(limit, reach_back, reach_on, 1)
    place = F.col("_rn") - 1
    homes = F.array_distinct(F.array(
        F.floor(place / size), F.floor((place + reach_back) / size), F.floor((place - reach_on) / size)))
    spread = (df.withColumn("_home", F.floor(place / size))
              .withColumn("_chunk", F.explode(homes)))
    window = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    return (spread.select("*", *[_plain(s, window).alias(n) for n, s in specs.items()])
            .filter(F.col("_home") == F.col("_chunk")).drop("_home", "_chunk"))


def with_windows(df: DataFrame, keys: list[str], order: list[str], specs: dict[str, Spec],
                 hot_rows: int | None = None, hot: Hot | None = None) -> DataFrame:
    """``df`` plus one column per spec, windowed by ``keys`` in ``order``.

    ``order`` must be a total order inside a key for ``row_number``, shifts and row frames.
    Pass ``hot`` when the hot keys are known, to save the counting pass."""
    hot = hot or hot_keys(df, keys, hot_rows)
    window = _window(keys, order)
    if not hot.rows:
        return df.select("*", *[_plain(s, window).alias(n) for n, s in specs.items()])
    usual, large = split_hot(df, keys, hot) if keys else (df.limit(0), df)
    done = usual.select("*", *[_plain(s, window).alias(n) for n, s in specs.items()])
    out = _hot_windows(large, keys, order, specs, hot)
    return out if not keys else done.select(*out.columns).unionByName(out)


def _hot_windows(large: DataFrame, keys: list[str], order: list[str], specs: dict[str, Spec], hot: Hot) -> DataFrame:
    """``with_windows`` over rows of hot keys alone."""
    near = {n: s for n, s in specs.items() if s.kind != "running"}
    out = _running_hot(_with_slices(large, keys, order, hot), keys, order,
                       {n: s for n, s in specs.items() if s.kind == "running" and s.fn != "row_number"})
    if near:
        out = _shifted_hot(out, keys, near, hot.limit)
    for name, spec in specs.items():
        if spec.fn == "row_number":
            out = out.withColumn(name, F.col("_rn"))
    return out.select(*large.columns, *specs)


def with_ranks(df: DataFrame, keys: list[str], order: list[str], rank: str = "rank",
               dense_rank: str = "dense_rank", hot_rows: int | None = None, hot: Hot | None = None) -> DataFrame:
    """``rank`` and ``dense_rank``; ties get equal ranks.

    For hot keys ranks are computed over the distinct order values with their row counts,
    then joined back, so a value shared by very many rows is no single group either."""
    hot = hot or hot_keys(df, keys, hot_rows)
    window = _window(keys, order)
    plain = [F.rank().over(window).cast("bigint").alias(rank),
             F.dense_rank().over(window).cast("bigint").alias(dense_rank)]
    if not hot.rows:
        return df.select("*", *plain)
    usual, large = split_hot(df, keys, hot)
    names = [n for n, _ in map(_split, order)]
    values = large.groupBy(*dict.fromkeys([*keys, *names])).agg(F.count(F.lit(1)).alias("_same"))
    ranked = with_windows(values, keys, order,
                          {"_upto": running("sum", "_same"), "_place": row_number()}, hot_rows)
    places = ranked.select(*dict.fromkeys([*keys, *names]),
                           (F.col("_upto") - F.col("_same") + 1).alias(rank),
                           F.col("_place").alias(dense_rank))
    joined = join_null_safe(large, places, list(dict.fromkeys([*keys, *names])), "left")
    out = joined.select(*df.columns, rank, dense_rank)
    return out if not keys else usual.select("*", *plain).unionByName(out)


def with_range_frame(df: DataFrame, keys: list[str], by: str, width: float,
                     aggregates: dict[str, tuple[str, str]], hot_rows: int | None = None) -> DataFrame:
    """Aggregates over the rows whose numeric ``by`` lies in ``[current - width, current]``.

    Rows of equal ``by`` share a frame, so they are first aggregated (with partial combine)
    to one step per key and value; the frame slides over steps, not rows, and is joined back.
    A key with very many steps is cut into blocks of ``width``: a frame touches its own block
    and the one before, so each step is sent to two blocks and none needs the whole key.  Where
    even such a block is too much for a task, ``_wide_frames`` cuts the frames themselves.  Null
    values share a frame of their own."""
    parts: dict[str, Column] = {}
    frames: dict[str, tuple] = {}
    for name, (fn, col) in aggregates.items():
        if fn in ("avg", "count", "sum"):
            parts[f"_n_{name}"] = F.count(col)
            frames[f"_n_{name}"] = (F.sum, f"_n_{name}")
        if fn in ("avg", "sum", "min", "max"):
            base = {"min": F.min, "max": F.max}.get(fn, F.sum)
            parts[f"_v_{name}"] = base(col)
            frames[f"_v_{name}"] = (base, f"_v_{name}")
    steps = stage(df.groupBy(*keys, by).agg(*[c.alias(n) for n, c in parts.items()]), "steps")
    hot = hot_keys(steps, keys, hot_rows)

    def columns(window):
        framed = window.rangeBetween(-width, Window.currentRow)
        return [fn(col).over(framed).alias(f"_f{name}") for name, (fn, col) in frames.items()]

    done = steps.select("*", *columns(Window.partitionBy(*keys).orderBy(by)))
    if hot.rows:
        usual, large = split_hot(steps, keys, hot)
        block = F.floor(F.col(by) / width)
        fullest = large.groupBy(*keys, block.alias("_block")).count().agg(F.max("count")).first()[0]
        if fullest > hot.limit:
            out = _wide_frames(large, keys, by, width, frames, hot)
        else:
            spread = (large.withColumn("_home", block)
                      .withColumn("_block", F.explode(F.when(block.isNull(), F.array(block)).otherwise(F.array(block, block + 1)))))
            out = (spread.select("*", *columns(Window.partitionBy(*keys, "_block").orderBy(by)))
                   .filter(F.col("_home").eqNullSafe(F.col("_block"))).drop("_home", "_block"))
        done = out if not keys else usual.select("*", *columns(Window.partitionBy(*keys).orderBy(by))).unionByName(out)

    def value(name: str, fn: str) -> Column:
        if fn == "count":
            return F.col(f"_f_n_{name}")
        if fn == "avg":
            return F.try_divide(F.col(f"_f_v_{name}"), F.col(f"_f_n_{name}"))
        return F.col(f"_f_v_{name}")

    framed = done.select(*keys, by, *[value(n, fn).alias(n) for n, (fn, _) in aggregates.items()])
    return join_null_safe(df, framed, [*keys, by], "left").select(*df.columns, *aggregates)


def _wide_frames(steps: DataFrame, keys: list[str], by: str, width: float, frames: dict[str, tuple], hot: Hot) -> DataFrame:
    """Range frames that are themselves too wide for one task; ``steps`` are unique by key and ``by``.

    Sums and counts are the difference of two running totals: the one at the step and the one at the
    last step before its frame, which an as-of lookup in one time line finds.  Smallest and
    largest values have no difference.  Steps are numbered and cut into blocks of ``hot.limit``; a
    frame over several blocks is the rest of its first block (a running extreme from the block's
    end), its last block up to the step (one from the block's start), and whole blocks between them,
    which two overlapping runs of a power of two of blocks cover.  So no task holds more than a
    block, or one row for each block of a key.  Totals of floating point columns are differences of
    sums: give whole numbers (cents) where they must be exact."""
    sums = [n for n, (fn, _) in frames.items() if fn is F.sum]
    ends = {n: fn for n, (fn, _) in frames.items() if fn is not F.sum}
    null_step = steps.filter(F.col(by).isNull()).select("*", *[F.col(n).alias(f"_f{n}") for n in frames])
    known = steps.filter(F.col(by).isNotNull())
    placed = stage(_hot_windows(known, keys, [by], {**{f"_t{n}": running("sum", n) for n in sums}, "_place": row_number()}, hot), "totals")

    # inside a block: from its start, to its end, and the frame as far as it lies inside
    block = F.floor((F.col("_place") - 1) / hot.limit)
    inside = Window.partitionBy(*keys, "_block").orderBy("_place")
    near = Window.partitionBy(*keys, "_block").orderBy(by).rangeBetween(-width, Window.currentRow)
    blocked = placed.withColumn("_block", block)
    blocked = stage(blocked.select(
        "*", *[fn(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_a{n}") for n, fn in ends.items()],
        *[fn(n).over(inside.rowsBetween(0, Window.unboundedFollowing)).alias(f"_z{n}") for n, fn in ends.items()],
        *[fn(n).over(near).alias(f"_c{n}") for n, fn in ends.items()]), "blocks")

    # the last step before the frame, and what the step behind that one knows of its block
    nexts = _shifted_hot(blocked.withColumn("_rn", F.col("_place")), keys, {f"_y{n}": lead(f"_z{n}") for n in ends}, hot.limit).drop("_rn") if ends else blocked
    state = F.struct("_place", *[f"_t{n}" for n in sums], *[f"_y{n}" for n in ends]).alias("_state")
    own = F.struct(by, *frames, "_place", "_block", *[f"_t{n}" for n in sums], *[f"_{p}{n}" for n in ends for p in "ac"])
    marks = nexts.select(*keys, F.col(by).alias("_t"), F.lit(1).alias("_side"), state, F.lit(None).cast(nexts.select(own.alias("o")).schema["o"].dataType).alias("_own"))
    asks = nexts.select(*keys, (F.col(by) - F.lit(width)).alias("_t"), F.lit(0).alias("_side"),
                        F.lit(None).cast(marks.schema["_state"].dataType).alias("_state"), own.alias("_own"))
    line = _hot_windows(marks.unionByName(asks), keys, ["_t", "_side"], {"_before": running("last", "_state")}, hot)
    found = line.filter("_side = 0").select(*keys, "_own.*", "_before").withColumn(
        "_first", F.floor(F.coalesce("_before._place", F.lit(0).cast("bigint")) / hot.limit))
    totals = {}
    for n in sums:
        before = F.coalesce(F.col(f"_before._t{n}"), F.lit(0))
        totals[f"_f{n}"] = F.col(f"_t{n}") - before
    for n in sums:  # a frame without a value has no sum
        if n.startswith("_v_") and f"_n_{n[3:]}" in sums:
            totals[f"_f{n}"] = F.when(totals[f"_f_n_{n[3:]}"] > 0, totals[f"_f{n}"])
    if not ends:
        out = found.select(*keys, by, *frames, *[totals[f"_f{n}"].alias(f"_f{n}") for n in sums])
        return out.unionByName(null_step)

    found = stage(found, "frames")
    between = found.select(*keys, (F.col("_first") + F.when(F.col("_before").isNull(), 0).otherwise(1)).alias("_low"), F.col("_block").alias("_high"))
    spans = between.filter("_low < _high").distinct()
    whole = blocked.groupBy(*keys, "_block").agg(*[fn(n).alias(f"_w{n}") for n, fn in ends.items()])
    # runs of 2 ** p blocks, each two of the power before; no longer ones than a frame spans
    most = spans.agg(F.max(F.col("_high") - F.col("_low"))).first()[0] or 1
    along = Window.partitionBy(*keys).orderBy("_block")
    powers = range(most.bit_length())
    merged = {n: (F.least if fn is F.min else F.greatest) for n, fn in ends.items()}
    extended = whole.withColumnsRenamed({f"_w{n}": f"_w{n}_0" for n in ends})
    for p in powers[1:]:
        extended = extended.withColumns({f"_w{n}_{p}": merged[n](f"_w{n}_{p - 1}", F.lead(f"_w{n}_{p - 1}", 1 << p - 1).over(along)) for n in ends})
    extended = extended.select(*keys, F.col("_block").alias("_start"), *[
        F.struct(F.lit(p).alias("_power"), *[F.col(f"_w{n}_{p}").alias(f"_w{n}") for n in ends]).alias(f"_p{p}") for p in powers])
    runs = extended.select(*keys, "_start", F.explode(F.array(*[f"_p{p}" for p in powers])).alias("_r")).select(*keys, "_start", "_r.*")
    runs = stage(runs, "runs")
    power = F.floor(F.log2(F.col("_high") - F.col("_low"))).cast("int")
    covered = spans.withColumn("_power", power)
    left = join_null_safe(covered.withColumn("_start", F.col("_low")), runs, [*keys, "_power", "_start"])
    right = runs.select(*keys, "_power", "_start", *[F.col(f"_w{n}").alias(f"_x{n}") for n in ends])
    both = join_null_safe(left.withColumn("_start", F.col("_high") - F.expr("shiftleft(1L, _power)")), right, [*keys, "_power", "_start"])
    middle = both.select(*keys, "_low", "_high", *[merged[n](f"_w{n}", f"_x{n}").alias(f"_m{n}") for n in ends])
    joined = join_null_safe(
        found.withColumns({"_low": F.col("_first") + F.when(F.col("_before").isNull(), 0).otherwise(1), "_high": F.col("_block")}),
        middle, [*keys, "_low", "_high"], "left")
    for n in ends:
        # the block the frame begins in is whole when nothing lies before it
        totals[f"_f{n}"] = F.when(F.col("_first") == F.col("_block"), F.col(f"_c{n}")).otherwise(
            merged[n](F.col(f"_a{n}"), F.col(f"_before._y{n}"), F.col(f"_m{n}")))
    out = joined.select(*keys, by, *frames, *[totals[f"_f{n}"].alias(f"_f{n}") for n in frames])
    return out.unionByName(null_step)


def with_totals(df: DataFrame, keys: list[str], aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Whole-partition frame: per-key aggregates next to every row.

    Partial aggregation plus a join, so no key is gathered in one task (the adaptive
    skew join splits a large key on the row side)."""
    totals = df.groupBy(*keys).agg(*[_AGG[fn](col).alias(name) for name, (fn, col) in aggregates.items()])
    if not keys:
        one = totals.select(F.struct(*aggregates).alias("_t")).scalar()
        return df.withColumn("_t", one).select(*df.columns, *[F.col("_t")[n].alias(n) for n in aggregates])
    return join_null_safe(df, totals, keys, "left").select(*df.columns, *aggregates)


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``by`` (give a unique tiebreak last).

    An aggregate with partial combine, not a window: a hot key costs one row per map task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return best.select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])


def first_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``by``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return best.select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])


def top_per_group(df: DataFrame, keys: list[str], order: list[str], k: int, rank: str = "rn") -> DataFrame:
    """Best ``k`` rows per key.  Spark limits each group before the shuffle, so at most
    ``k`` rows per key and map task travel."""
    place = F.row_number().over(_window(keys, order))
    return df.withColumn(rank, place).filter(F.col(rank) <= k)


def surrogate_key(df: DataFrame, name: str, natural: list[str], hot_rows: int | None = None) -> DataFrame:
    """Dense integer key in natural-key order, numbered slice by slice above ``hot_rows``."""
    numbered = with_windows(df, [], natural, {name: row_number()}, hot_rows)
    return numbered.select(name, *df.columns)
