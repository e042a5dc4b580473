"""Batch loads from folders whose names go up with time, which list the tail alone.

Files arrive as ``source/<name>/...`` with names like days or hours.  The ledger is partitioned by that
name, so its newest name, the high-water mark, is known from its folders.  A load lists names from
some way before the mark on (files that come late), the file system leaves out the older ones by a
pattern, files below them are listed by Spark, and new ones are loaded in pieces of bounded size."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import stage
from lakeloom.sources.incremental import path_exists
from lakeloom.sources.readers import provenance

LEDGER = "path string, size bigint, load_id bigint, name string"
PIECE_FILES = 10_000
SPECIAL = set("*?[]{}\\^-,")


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if c in SPECIAL else c for c in text)


def names_from(mark: str) -> str:
    """A file pattern for the names that are ``mark`` or come after it in code point order: those that begin
    with it, or part from it with a later character."""
    parts = [_literal(mark) + "*"]
    for i, c in enumerate(mark):
        if ord(c) < ord("~"):
            after = chr(ord(c) + 1)
            parts.append(f"{_literal(mark[:i])}[{after if after.isalnum() else chr(92) + after}-~]*")
    return "{" + ",".join(parts) + "}"


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that a pattern meets."""
    top = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top) or []
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def newest_names(spark: SparkSession, target: str, look_back: int) -> list[str]:
    """The last ``look_back`` + 1 names of the ledger, oldest first."""
    if not path_exists(spark, f"{target}/_ordered"):
        return []
    names = _folders(spark, f"{target}/_ordered/name=*")
    return sorted(unquote(n.split("=", 1)[1]) for n in names)[-(look_back + 1):]


def tail_files(spark: SparkSession, target: str, source: str, look_back: int = 1) -> tuple[DataFrame, list[str]]:
    """The files of the names from the mark on, less ``look_back`` names (path, size, name), and those names;
    file contents and older folders are not read."""
    known = newest_names(spark, target, look_back)
    names = _folders(spark, f"{source}/{names_from(known[0]) if known else '*'}")
    if not names:
        return spark.createDataFrame([], "path string, size bigint, name string"), []
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load([f"{source}/{_literal(n)}" for n in names]).select("path", F.col("length").alias("size"))
    base = spark._jvm.org.apache.hadoop.fs.Path(source).toUri().getPath().rstrip("/")
    inner = F.substring_index(F.substring("path", F.instr("path", F.lit(base)) + len(base) + 1, F.lit(1 << 20)), "/", 1)
    return files.withColumn("name", inner), names


def load_ordered(spark: SparkSession, target: str, source: str, fmt: str, schema, look_back: int = 1,
                 piece_files: int = PIECE_FILES, **options) -> list[int]:
    """Loads the files of the tail that the ledger does not know, ``piece_files`` at most at a time; returns
    the load ids.

    A piece writes its ``load_id`` folder, then its ledger rows; the folder of a load that died before the
    ledger is never read, its files come with the next load.  Files that come later than
    ``look_back`` names behind the newest are not seen: choose it by how late files may be."""
    files, names = tail_files(spark, target, source, look_back)
    ledger = read_ledger(spark, target).filter(F.col("name") >= names[0]) if names else None
    if not names:
        return []
    left = stage(files.join(ledger.select("path"), "path", "left_anti"), "tail")
    count = left.count()
    done: list[int] = []
    newest = last_load(spark, target)
    pieces = left.withColumn("_n", F.pmod(F.xxhash64("path"), F.lit(max(1, -(-2 * count // piece_files)))) if count > piece_files else F.lit(0))
    for n in sorted(r[0] for r in pieces.select("_n").distinct().collect()):
        piece = pieces.filter(F.col("_n") == n).drop("_n")
        paths = [r["path"] for r in piece.select("path").collect()]  # some piece_files names, not data
        newest += 1
        reader = spark.read.format(fmt).schema(schema).options(**({"header": True} if fmt == "csv" else {}), **options)
        reader.load(paths).select("*", *provenance()).write.mode("overwrite").parquet(f"{target}/rows/load_id={newest}")
        entry = piece.withColumn("load_id", F.lit(newest).cast("bigint")).select("path", "size", "load_id", "name")
        entry.repartition("name").write.mode("append").partitionBy("name").parquet(f"{target}/_ordered")
        done.append(newest)
    return done


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """Loaded files: path, size, load_id, name."""
    where = f"{target}/_ordered"
    if path_exists(spark, where):
        return spark.read.schema(LEDGER).parquet(where)
    return spark.createDataFrame([], LEDGER)


def last_load(spark: SparkSession, target: str) -> int:
    """The newest load of the newest names; 0 before the first."""
    names = newest_names(spark, target, 0)
    if not names:
        return 0
    folders = _folders(spark, f"{target}/rows/load_id=*")
    return max(int(f.split("=")[1]) for f in folders)


def read_ordered(spark: SparkSession, target: str, schema) -> DataFrame:
    """Rows of the loads that the ledger names, with their ``load_id``."""
    rows = spark.read.schema(schema).parquet(f"{target}/rows")
    loads = read_ledger(spark, target).select("load_id").distinct()
    return rows.join(F.broadcast(loads), "load_id", "left_semi")
