"""File layout: compaction, partitioned writes, clustering, file statistics, skew reports."""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.joins import frequent_keys
from lakeloom.session import delete_files, delete_path, plan_bytes, stage

TARGET_BYTES = 1 << 30      # about 1 GB a file
MAX_CLUSTER_COLUMNS = 4


def folder_bytes(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def compact(spark: SparkSession, path: str, target: str, bytes_per_file: int = TARGET_BYTES) -> DataFrame:
    """Rewrites small files toward the target size.  Scan splits already pack small files,
    so merging them needs no shuffle."""
    files = max(1, math.ceil(folder_bytes(spark, path) / bytes_per_file))
    spark.read.parquet(path).coalesce(files).write.parquet(target)
    return spark.read.parquet(target)


def _paths(spark: SparkSession, path: str):
    """Hadoop's path of a name and the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, fs = _paths(spark, path)
    return fs.exists(where)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    where, fs = _paths(spark, old)
    fs.mkdirs(_paths(spark, new)[0].getParent())
    if not fs.rename(where, _paths(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def _hold(path: str) -> str:
    """Where folders wait to be switched: beside the table, under a name that scans skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_compact-{name}"


def recover_compaction(spark: SparkSession, path: str) -> None:
    """Ends what a stopped ``compact_folder`` left: a folder that was taken away comes back, as its
    compacted copy where that is complete, and unused copies go."""
    hold = _hold(path)
    if not _exists(spark, hold):
        return
    where, fs = _paths(spark, hold)
    for entry in fs.listStatus(where):
        held = f"{hold}/{entry.getPath().getName()}"
        leaf = f"{path}/{unquote(entry.getPath().getName()).strip()}".rstrip("/")
        if not _exists(spark, leaf):
            complete = _exists(spark, f"{held}/new/_SUCCESS")
            _rename(spark, f"{held}/new" if complete else f"{held}/old", leaf)
    delete_path(spark, hold)


def compact_folder(spark: SparkSession, path: str, bytes_per_file: int = TARGET_BYTES, at_once: int = 8) -> tuple[int, int]:
    """Merges the files of every leaf folder (partition) that holds two files or more below half the
    target, and leaves the other folders as they are; returns how many files were read and written.

    A leaf is written anew beside the table and put in place by two renames, so whatever the point it
    stops at, a reader finds the old files, the new ones or, between the renames, no folder; the next
    run (``recover_compaction``) ends the switch.  Never does a row count twice or get lost.  One
    writer at a time."""
    path = path.rstrip("/")
    recover_compaction(spark, path)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
             .select(F.regexp_replace("path", "/[^/]*$", "").alias("leaf"), "length"))
    leaves = files.groupBy("leaf").agg(F.count_if(F.col("length") * 2 < bytes_per_file).alias("small"), F.count(F.lit(1)).alias("files"),
                                       F.sum("length").alias("bytes")).filter("small >= 2").collect()  # a row for each partition
    root = _paths(spark, path)[0].toUri().getPath()

    def one(leaf) -> tuple[int, int]:
        inner = leaf["leaf"][leaf["leaf"].index(root) + len(root):].strip("/")
        where, held = f"{path}/{inner}".rstrip("/"), f"{_hold(path)}/{quote(inner, safe='') or '%20'}"
        files = max(1, math.ceil(leaf["bytes"] / bytes_per_file))
        spark.read.parquet(where).coalesce(files).write.mode("overwrite").parquet(f"{held}/new")
        _rename(spark, where, f"{held}/old")
        _rename(spark, f"{held}/new", where)
        delete_path(spark, held)
        return leaf["files"], files

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        counts = list(pool.map(one, leaves))
    delete_path(spark, _hold(path))
    return sum(n for n, _ in counts), sum(n for _, n in counts)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Hive-style folders.  The rebalance hint gives each folder few files and splits the
    folder of a hot value over several tasks."""
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def _bounds(df: DataFrame, columns: list[str], pieces: int) -> dict[str, list]:
    """``pieces - 1`` cut points per column from a sample of about 20,000 rows, or 20 a piece."""
    rows = df.count()
    fraction = min(1.0, max(20_000, 20 * pieces) / max(rows, 1))
    sample = df.select(*columns).sample(fraction, seed=11).collect()
    bounds = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = {values[len(values) * i // pieces] for i in range(1, pieces)} if values else set()
        bounds[c] = sorted(cuts)
    return bounds


def _rank_of(value: Column, bounds: list, low: int = 0) -> Column:
    """Number of bounds not greater than ``value``, by a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(value >= F.lit(bounds[middle]), _rank_of(value, bounds[middle + 1:], low + middle + 1)
                  ).otherwise(_rank_of(value, bounds[:middle], low))


def _rank_in(value: Column, bounds: list, kind: T.DataType) -> Column:
    """``_rank_of`` for many bounds: looked up in two steps, first among groups of them, then inside one, so
    that the expression stays small and a row meets about 2 * sqrt(n) of them."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    groups = F.lit([str(v) for v in bounds]).cast(T.ArrayType(kind))
    firsts = F.lit([str(v) for v in bounds[::width]]).cast(T.ArrayType(kind))
    group = F.size(F.filter(firsts, lambda b: b <= value))
    inside = F.size(F.filter(F.slice(groups, F.greatest((group - 1) * width + 1, F.lit(1)), F.lit(width)), lambda b: b <= value))
    return F.when(group > 0, (group - 1) * width + inside).otherwise(0)


def rank_bits(files: int, columns: int) -> int:
    """Bits a column so that there are 16 ranks or more for each file, over all columns."""
    return max(6, math.ceil(math.log2(16 * max(1, files)) / columns))


def z_value(df: DataFrame, columns: list[str], bits: int = 6) -> Column:
    """Interleaved bits of each column's rank among its sampled quantiles."""
    if not 1 <= len(columns) <= MAX_CLUSTER_COLUMNS:
        raise ValueError(f"cluster by one to {MAX_CLUSTER_COLUMNS} columns")
    bounds = _bounds(df, columns, 1 << bits)
    ranks = [_rank_of(F.col(c), bounds[c]).cast("bigint") for c in columns]
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            place = bit * len(ranks) + i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), place))
    return out


def files_for_size(df: DataFrame, at_least: int = 1, bytes_per_file: int = TARGET_BYTES) -> int:
    """Number of output files for the planned size of ``df``."""
    return max(at_least, math.ceil(plan_bytes(df) / bytes_per_file))


def cluster(df: DataFrame, columns: list[str], at_least: int = 1) -> DataFrame:
    """Rows range-partitioned by the interleaved value, so a file covers a small box of the
    columns.  A hash breaks ties, so equal values (a hot key) may span several files."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    files = files_for_size(df, at_least)
    if len(columns) == 1:  # the column is its own order, at any size
        ordered = df.withColumn("_tie", spread).repartitionByRange(files, columns[0], "_tie")
        return ordered.sortWithinPartitions(columns[0]).drop("_tie")
    ranked = df.withColumn("_z", z_value(df, columns, rank_bits(files, len(columns)))).withColumn("_tie", spread)
    return ranked.repartitionByRange(files, "_z", "_tie").sortWithinPartitions("_z").drop("_z", "_tie")


def write_clustered(df: DataFrame, columns: list[str], path: str, at_least: int = 1) -> None:
    """Clustered files plus their statistics in ``_stats`` (a folder that scans skip)."""
    cluster(df, columns, at_least).write.parquet(path)
    file_statistics(df.sparkSession.read.parquet(path), columns).write.parquet(f"{path}/_stats")


def file_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, smallest and largest value per file of a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))])


def meets(column: str, low, high=None) -> Column:
    """Whether a file's range of ``column`` meets [low, high]."""
    return (F.col(f"min_{column}") <= F.lit(low if high is None else high)) & (F.col(f"max_{column}") >= F.lit(low))


def files_for(stats: DataFrame, column: str, low, high=None) -> DataFrame:
    """Files whose range of ``column`` meets [low, high]: the ones a predicate must read."""
    return stats.filter(meets(column, low, high))


def read_skipping(spark: SparkSession, path: str, column: str, low, high=None) -> DataFrame:
    """Reads only the files the stored statistics leave, then applies the predicate."""
    high = low if high is None else high
    files = files_for(spark.read.parquet(f"{path}/_stats"), column, low, high).select("file_path")
    names = [r["file_path"] for r in files.collect()]  # file names, not data
    source = spark.read.parquet(*names) if names else spark.read.parquet(path).limit(0)
    return source.filter(F.col(column).between(F.lit(low), F.lit(high)))


def compare_layouts(spark: SparkSession, paths: dict[str, str], column: str, value, amount: str) -> DataFrame:
    """The same point query on copies with different layouts."""
    out = None
    for name, path in paths.items():
        stats = file_statistics(spark.read.parquet(path), [column])
        part = files_for(stats, column, value).agg(F.count(F.lit(1)).alias("files_read"))
        whole = stats.agg(F.count(F.lit(1)).alias("files"))
        hits = spark.read.parquet(path).filter(F.col(column) == F.lit(value)).agg(
            F.count(F.lit(1)).alias("rows"), F.round(F.sum(amount), 2).alias("total"))
        row = hits.withColumn("layout", F.lit(name)).withColumn(
            "files_read", part.scalar()).withColumn("files", whole.scalar()).select("layout", "rows", "total", "files_read", "files")
        out = row if out is None else out.unionByName(row)
    return out


# ---- clustering that grows ----------------------------------------------------------------------


def with_hilbert(df: DataFrame, ranks: list[Column], name: str, bits: int) -> DataFrame:
    """Adds the place of a row along a Hilbert curve through the grid of ``ranks`` (each from 0 to
    2**bits - 1).  Neighbours on the curve are neighbours in the grid, so a range of it is a box
    without the jumps that interleaved bits have.  Column expressions only, one projection a step."""
    axes = [f"_h{i}" for i in range(len(ranks))]
    out = df.withColumns({a: r.cast("bigint") for a, r in zip(axes, ranks, strict=True)})
    first = F.col(axes[0])
    for bit in range(bits - 1, 0, -1):  # undo the turns of the larger squares
        low = (1 << bit) - 1
        for axis in axes:
            here = F.col(axis)
            turned = here.bitwiseAND(F.lit(1 << bit)) != 0
            if axis == axes[0]:
                out = out.withColumn(axis, F.when(turned, first.bitwiseXOR(F.lit(low))).otherwise(first))
                continue
            swap = first.bitwiseXOR(here).bitwiseAND(F.lit(low))
            out = out.withColumns({axes[0]: F.when(turned, first.bitwiseXOR(F.lit(low))).otherwise(first.bitwiseXOR(swap)),
                                   axis: F.when(turned, here).otherwise(here.bitwiseXOR(swap))})
    for before, axis in zip(axes, axes[1:], strict=False):  # Gray code
        out = out.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    flip = F.lit(0).cast("bigint")
    for bit in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(axes[-1]).bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(0))
    out = out.withColumn("_flip", flip)
    place = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(F.col(axis).bitwiseXOR(F.col("_flip")), bit).bitwiseAND(F.lit(1)))
    return out.withColumn(name, place).drop(*axes, "_flip")


#: Bits a column of a curve unless asked for more; a table of many files wants 16 cells for each.
CURVE_BITS = 5
#: Bits a column that a stored curve is refined to at most: 4,096 cut points and 82,000 sampled rows.
MOST_BITS = 12
#: Bits of a place: a cell's on top, whatever their number, and below them those of a hash, by which the files
#: of a single cell lie one behind the other.
PLACE_BITS = 62
STEP = "_stats/step="


def _steps(spark: SparkSession, root: str) -> list[int]:
    """The finished file lists of a clustered folder, oldest first."""
    where, fs = _paths(spark, f"{root}/{STEP}*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(where) or [])


def cluster_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of a growing clustered folder by its newest list: file_path, curve, low and high (their
    range of the curve), rows, and the smallest and largest value of each column."""
    return spark.read.parquet(f"{root}/{STEP}{_steps(spark, root)[-1]}")


def read_growing(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """The rows of all files, or of those in ``files`` (a part of ``cluster_files``)."""
    names = [r["file_path"] for r in (cluster_files(spark, root) if files is None else files).select("file_path").collect()]  # names, not data
    newest = cluster_files(spark, root).limit(1).select("file_path").first()["file_path"]
    return spark.read.parquet(*names) if names else spark.read.parquet(newest).limit(0)


def _refined(df: DataFrame, cuts: dict[str, list], bits: int, finer: int) -> dict[str, list]:
    """Cut points and their ranks with ``finer`` bits: what lies between two cut points is cut again by what
    ``df`` holds of it, so a cell of the curve becomes a range of cells and files on it stay where they are."""
    pieces = 1 << finer - bits
    fraction = min(1.0, max(20_000, 20 << finer) / max(df.count(), 1))
    between = [_rank_in(F.col(c), [v for v, _ in found], df.schema[c].dataType).alias(f"_in_{c}") for c, found in cuts.items()]
    sample = df.select(*cuts).sample(fraction, seed=11).select(*cuts, *between).collect()
    out = {}
    for c, found in cuts.items():
        inside: dict[int, list] = {}
        for r in sample:
            if r[c] is not None:
                inside.setdefault(r[f"_in_{c}"], []).append(r[c])
        out[c] = []
        for i in range(len(found) + 1):
            rank = found[i - 1][1] * pieces if i else 0
            values = sorted(inside.get(i, ()))
            new = sorted({values[len(values) * k // pieces] for k in range(1, pieces)} - {values[0]}) if values else []
            out[c] += [[found[i - 1][0], rank]] * (i > 0) + [[v, rank + k] for k, v in enumerate(new, 1)]
    return out


def _curve(spark: SparkSession, root: str, df: DataFrame, columns: list[str], files: int) -> tuple[str, int, dict[str, list]]:
    """The name, bits and cut points (each with the rank that begins there) of the curve of ``columns``: the
    stored one, so that all files are on one curve, else one drawn from ``df``, fine enough for a hundred
    times its files.  A stored one with fewer than 16 cells for each of ``files`` is refined."""
    name, folder = f"{'-'.join(columns)}@{PLACE_BITS}", f"{root}/_curves"
    schema = "name string, bits int, cuts string"
    wanted = max(CURVE_BITS, math.ceil(math.log2(100 * files) / len(columns)))
    found = spark.read.json(folder, schema=schema).filter(F.col("name") == name).orderBy(F.desc("bits")).first() if _exists(spark, folder) else None
    if found:
        bits, cuts = found["bits"], json.loads(found["cuts"])
        finer = min(wanted, MOST_BITS)
        if 16 * files <= 1 << bits * len(columns) or finer <= bits:
            return name, bits, cuts
        bits, cuts = finer, _refined(df, cuts, bits, finer)
    else:
        bits = min(wanted, PLACE_BITS // len(columns))
        cuts = {c: [[v, rank] for rank, v in enumerate(found, 1)] for c, found in _bounds(df, columns, 1 << bits).items()}
    text = json.dumps(cuts, default=str)
    spark.createDataFrame([(name, bits, text)], schema).coalesce(1).write.mode("append").json(folder)
    return name, bits, json.loads(text)


def _write_step(df: DataFrame, root: str, columns: list[str], files: int, kept: DataFrame | None) -> None:
    """Rows as clustered files of a new step, then the list of all files: the step counts from then on.  No
    place lies in two of the files: rows of one cell, as of a hot key, are parted by their hash."""
    spark = df.sparkSession
    done = _steps(spark, root)
    step = done[-1] + 1 if done else 0
    name, bits, cuts = _curve(spark, root, df, columns, files + (kept.count() if kept is not None else 0))
    ranks = [F.get(F.lit([0, *[rank for _, rank in cuts[c]]]), _rank_in(F.col(c), [v for v, _ in cuts[c]], df.schema[c].dataType)) for c in columns]
    spare = PLACE_BITS - bits * len(columns)
    place = F.shiftleft("_place", spare).bitwiseOR(F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), 64 - spare))
    placed = with_hilbert(df, ranks, "_place", bits).withColumn("_at", place)
    sorted_rows = placed.repartitionByRange(files, "_at").sortWithinPartitions("_at")
    sorted_rows.drop("_at").write.mode("overwrite").parquet(f"{root}/step={step}")
    written = spark.read.parquet(f"{root}/step={step}")
    extremes = [f(c).alias(f"{n}_{c}") for c in df.columns if c not in ("_place",) for n, f in (("min", F.min), ("max", F.max))]
    stats = written.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.lit(name).alias("curve"), F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("rows"), *extremes)
    listed = stats if kept is None else kept.unionByName(stats, allowMissingColumns=True)
    stage(listed, "files").coalesce(1).write.mode("overwrite").parquet(f"{root}/{STEP}{step}")


def arrive(df: DataFrame, root: str, columns: list[str], files: int = 1) -> None:
    """Adds rows as files clustered by ``columns``; files that are there stay as they are.  The columns
    may differ from those of earlier arrivals."""
    known = cluster_files(df.sparkSession, root) if _steps(df.sparkSession, root) else None
    _write_step(df, root, columns, files, known)


def overlap_depth(files: DataFrame, most: int) -> DataFrame:
    """``files`` with ``deep``: whether some point of a file's range lies in more than ``most`` files of its
    curve.  A sweep over the ends of the ranges: the depth at the begin of a range is the number begun
    less the number ended before, a file is deep if a begin in its range is.  No pairs are formed."""
    begins = files.select("curve", F.col("low").alias("at"), F.lit(0).alias("order"), F.lit(1).alias("change"))
    ends = files.select("curve", F.col("high").alias("at"), F.lit(1).alias("order"), F.lit(-1).alias("change"))
    # a row for each end of a file
    points = begins.unionByName(ends).groupBy("curve", "at", "order").agg(F.sum("change").alias("change"))
    rows_along = Window.partitionBy("curve").orderBy("at", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = points.withColumn("depth", F.sum("change").over(rows_along))
    deep = depth.filter((F.col("order") == 0) & (F.col("depth") > most)).select("curve", "at", F.lit(1).alias("order"), F.lit(1).alias("hit"), F.lit(None).cast("string").alias("file_path"), F.lit(0).alias("sign"))
    asks = files.select("curve", F.explode(F.array(
        F.struct((F.col("low") - 1).alias("at"), F.lit(-1).alias("sign")), F.struct(F.col("high").alias("at"), F.lit(1).alias("sign")))).alias("e"), "file_path").select(
        "curve", "e.at", F.lit(2).alias("order"), F.lit(0).alias("hit"), "file_path", "e.sign")
    counted = deep.unionByName(asks).withColumn("seen", F.sum("hit").over(rows_along))
    hits = counted.filter("sign <> 0").groupBy("file_path").agg((F.sum(F.col("seen") * F.col("sign")) > 0).alias("deep"))
    return files.join(hits, "file_path")


def recluster(spark: SparkSession, root: str, columns: list[str], most: int = 4, rows_per_file: int = 1 << 22) -> tuple[int, int]:
    """Rewrites the files that lie more than ``most`` deep on their curve, and no others; returns how many
    were read and written.  They go to the curve of ``columns``.

    The new files and the new list are written first, the old ones removed last; a list counts once
    it is complete, so a stop leaves the table as it was or as it will be, and files that no list names
    are never read."""
    judged = stage(overlap_depth(cluster_files(spark, root), most), "depth")
    chosen, kept = judged.filter("deep"), judged.filter("NOT deep").drop("deep")
    count, rows = chosen.agg(F.count(F.lit(1)), F.sum("rows")).first()
    if not count:
        return 0, 0
    names = [r["file_path"] for r in chosen.select("file_path").collect()]  # names, not data
    files = max(1, math.ceil(rows / rows_per_file))
    _write_step(spark.read.parquet(*names).drop("_place"), root, columns, files, kept)
    delete_files(spark, names)
    return count, files


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the key's share of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("t")).scalar()
    return counts.withColumn("share", F.round(F.col("rows") / total, 6))


def dominant_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, with their rows and share: two passes over the
    key column and no count of the others."""
    total = df.count()
    found = frequent_keys(df, [key], math.floor(total * share))
    return found.withColumn("share", F.round(F.col("rows") / F.lit(max(total, 1)), 6))


def partition_skew(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
