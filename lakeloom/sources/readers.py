"""Batch scans: CSV, JSON, Parquet, path queries, provenance and partitioned JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, by_name: bool = True,
             **options) -> DataFrame:
    """CSV scan.  Without ``schema`` types are inferred with a second pass over the file.

    With ``schema`` one pass is enough.  Spark binds CSV columns by position; ``by_name``
    binds them by header instead, so the schema may list columns in any order or leave
    some out, and text that does not fit its type becomes null (an error in mode FAILFAST).
    Files whose headers differ are each read by their own."""
    reader = spark.read.option("header", True).options(**options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if not by_name:
        return reader.schema(schema).csv(path)
    wanted = as_schema(schema)
    strict = str(options.get("mode", "")).upper() == "FAILFAST"
    parts = []
    for paths in files_by_header(spark, path, **{k: v for k, v in options.items() if k in ("encoding", "lineSep", "pathGlobFilter")}):
        text = reader.option("inferSchema", False).csv(paths)  # reads the header line only
        parts.append(text.select(*[
            ((F.col(f"`{f.name}`").cast(f.dataType) if strict else F.col(f"`{f.name}`").try_cast(f.dataType))
             if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]))
    return reduce(DataFrame.unionByName, parts)


#: Up to so many plain files, first lines are read by the driver, a line each; beyond, by a job.
FEW_FILES = 64


def _first_lines(spark: SparkSession, files: list[str]) -> dict[str, str | None]:
    """The first line of each file; nothing else of it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(name: str) -> str | None:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = where.getFileSystem(conf).open(where)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    return {name: first(name) for name in files}


def files_by_header(spark: SparkSession, path, **options) -> list[list[str]]:
    """Paths grouped by their first line.  Where all files have the same header the given path is the
    one group.  Empty files have none and are left out."""
    lines = spark.read.options(**options).text(path)
    files = lines.inputFiles()
    plain = not set(options) & {"encoding", "lineSep"} and not any(f.rsplit(".", 1)[-1] in ("gz", "bz2", "zst", "lz4", "snappy", "deflate", "xz") for f in files)
    if len(files) <= FEW_FILES and plain:
        headers: dict[str, list[str]] = {}
        for name, header in _first_lines(spark, files).items():
            if header is not None:
                headers.setdefault(header, []).append(name)
        groups = list(headers.values())
    else:
        first = (lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
                 .filter("start = 0").withColumn("n", F.monotonically_increasing_id())
                 .groupBy("file").agg(F.min_by("value", "n").alias("header")))
        groups = [r["files"] for r in first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()]  # file names, not data
    if len(groups) <= 1:
        return [path]
    return [sorted(g) for g in sorted(groups, key=min)]


def as_schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """JSON Lines scan; a partial ``schema`` reads only the named fields."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def query_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``SELECT * FROM fmt.`path```: files queried without a table."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def provenance() -> list[Column]:
    """File path, name, size and modification time of the row's source file."""
    meta = F.col("_metadata")
    return [meta["file_path"].alias("source_file_path"), meta["file_name"].alias("source_file_name"),
            meta["file_size"].alias("source_file_size"), meta["file_modification_time"].alias("ingestion_ts")]


def with_provenance(df: DataFrame, load_ts: bool = True) -> DataFrame:
    """Adds the provenance columns, and the load time unless ``load_ts`` is off.  Works on
    a batch or streaming file scan, before other transformations hide ``_metadata``."""
    stamp = [F.current_timestamp().alias("load_ts")] if load_ts else []
    return df.select("*", *provenance(), *stamp)


def read_files(spark: SparkSession, path, fmt: str, schema=None, metadata: bool = True, **options) -> DataFrame:
    """One reader for globs of any file format, with provenance columns."""
    if fmt == "csv":
        options = {"header": True, **options}
        if schema is None:
            options.setdefault("inferSchema", True)
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return with_provenance(df) if metadata else df


def jdbc_options(url: str, dbtable: str, partition_column: str, lower: int, upper: int, partitions: int,
                 fetchsize: int = 10_000, push_down: bool = True) -> dict[str, str]:
    """Options of a range-partitioned read: ``partitions`` tasks each fetch one key range."""
    return {"url": url, "dbtable": dbtable, "partitionColumn": partition_column,
            "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
            "fetchsize": str(fetchsize), "pushDownPredicate": str(push_down).lower()}


def read_jdbc(spark: SparkSession, url: str, dbtable: str, partition_column: str, lower: int, upper: int,
              partitions: int, **extra) -> DataFrame:
    options = jdbc_options(url, dbtable, partition_column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options, **extra).load()
