"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A rollup is a folder: ``state/<batch>`` holds what a batch says about each document it touches,
``deltas/<batch>`` its signed sums.  A batch counts once both are complete (their success
marker is there), so a batch that is sent again, or again after a crash, changes nothing.

States lie in folders by bucket of the doc_id: a batch reads the buckets its documents fall into and of
those the documents it names.  Once the states since the last merge have as many rows as the merge,
``merged/<batch>`` takes the last word on every document, so that what a document's bucket holds is
at most twice its documents, however many batches there were."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.text import blocks, free

# Fixed value: the pattern that splits texts before the merges of rank files.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEY = ["source", "lang", "version"]
MEASURES = ["docs", "tokens", "chars"]
STATE = "doc_id long, source string, lang string, version string, tokens long, chars long, present boolean"
BUCKETS = 64
BUCKET = "bucket"


@lru_cache(maxsize=4)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], text_column: str = "text") -> DataFrame:
    """``docs`` with one row for each tokenizer version: its columns but the text, and version,
    tokens, chars.  ``tokenizers`` maps versions to rank files, which are read here and sent to
    the tasks (about 1 MB each).  Whole texts are counted; null or empty ones have 0 tokens."""
    ranks = {}
    for version, path in tokenizers.items():
        with open(path, "rb") as file:
            ranks[version] = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rest = [c for c in docs.columns if c not in (text_column, "version", "tokens", "chars")]
    text = free(rest, "text")
    narrow = docs.select(*[docs[c] for c in rest], docs[text_column].cast("string").alias(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                chars = pa.array([len(t) for t in texts], pa.int64())
                own = [part.column(c) for c in rest]
                for version, file in shared.value.items():
                    encode = _encoding(file).encode_ordinary
                    counts = pa.array([len(encode(t)) for t in texts], pa.int64())
                    yield pa.record_batch([*own, pa.array([version] * len(texts)), counts, chars], [*rest, "version", "tokens", "chars"])

    fields = [f"`{name}` {kind}" for name, kind in narrow.drop(text).dtypes]
    return narrow.mapInArrow(count, ", ".join([*fields, "version string", "tokens long", "chars long"]))


def _path(root: str, kind: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"batch names have letters, digits, '_', '.' and '-': {batch!r}")
    return f"{root}/{kind}/{batch}"


def _complete(spark: SparkSession, root: str, kind: str) -> list[str]:
    """Batches whose output of that kind is complete, in name order."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    found = [s.getPath() for s in files.listStatus(top)]
    return sorted(p.getName() for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def committed(spark: SparkSession, root: str) -> list[str]:
    """Batches that count, in name order."""
    return _complete(spark, root, "deltas")


def bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))


def _write_state(rows: DataFrame, path: str) -> None:
    """Rows by bucket; the rebalance hint gives a bucket few files and splits a large one."""
    bucketed(rows).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{STATE}, {BUCKET} int").parquet(path)


def _parts(spark: SparkSession, root: str, before: str | None) -> tuple[str | None, list[str]]:
    """The newest merge of committed batches before ``before``, and the committed batches after it."""
    batches = [b for b in committed(spark, root) if before is None or b < before]
    merges = [m for m in _complete(spark, root, "merged") if m in batches]
    return (merges[-1], [b for b in batches if b > merges[-1]]) if merges else (None, batches)


def _states(spark: SparkSession, root: str, before: str | None, buckets: list[int] | None = None) -> DataFrame:
    """Everything that is said about documents, with the batch that says it."""
    merge, batches = _parts(spark, root, before)
    paths = [(b, _path(root, "state", b)) for b in batches]
    if merge is not None:
        paths.insert(0, (merge, _path(root, "merged", merge)))
    out = spark.createDataFrame([], f"{STATE}, {BUCKET} int, batch string")
    for batch, path in paths:
        rows = _read_state(spark, path)
        rows = rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))
        out = out.unionByName(rows.withColumn("batch", F.lit(batch)))
    return out


def _last_word(states: DataFrame) -> DataFrame:
    fields = ["source", "lang", "tokens", "chars", "present"]
    last = states.groupBy("doc_id", "version").agg(F.max(F.struct("batch", *fields)).alias("s"))
    return last.select("doc_id", "version", *[F.col(f"s.{f}").alias(f) for f in fields]).filter("present")


def current(spark: SparkSession, root: str, before: str | None = None, touched: DataFrame | None = None) -> DataFrame:
    """The state of every (doc_id, version) by the last batch (before batch ``before``), or of the
    documents that the stored state ``touched`` names: then other buckets are not read, and other
    documents leave before anything is grouped."""
    if touched is None:
        return _last_word(_states(spark, root, before))
    buckets = sorted(r[0] for r in touched.select(BUCKET).distinct().collect())  # BUCKETS numbers at most
    states = _states(spark, root, before, buckets)
    ids = touched.select(F.col("doc_id").alias("_id")).distinct()
    return _last_word(states.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"))


def merge_states(spark: SparkSession, root: str) -> str | None:
    """Merges the states of committed batches if those since the last merge have as many rows as it; the
    batch it goes up to, or None.  A merge counts once it is complete; what it replaces may stay."""
    merge, batches = _parts(spark, root, None)
    if len(batches) < (1 if merge else 2):
        return None
    old = _read_state(spark, _path(root, "merged", merge)).count() if merge else 0
    if sum(_read_state(spark, _path(root, "state", b)).count() for b in batches) < old:
        return None
    _write_state(_last_word(_states(spark, root, None)).select(*[c.split()[0] for c in STATE.split(", ")]), _path(root, "merged", batches[-1]))
    return batches[-1]


def signed(now: DataFrame, changes: DataFrame) -> DataFrame:
    """The signed rows (source, lang, version, docs, tokens, chars) that turn ``now`` into what
    ``changes`` say: an insert adds, a delete takes off what stood there, a revised count does
    both.  An insert of what is there already is a revision, a delete of what is not there
    nothing."""
    old = now.select("doc_id", "version", F.struct("source", "lang", "tokens", "chars").alias("old"))
    new = changes.select(F.col("doc_id").alias("_id"), F.col("version").alias("_v"), "present",
                         F.struct("source", "lang", "tokens", "chars").alias("new"))
    met = new.join(old, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("version").eqNullSafe(F.col("_v")), "left")
    side = lambda row, sign: F.struct(
        F.col(f"{row}.source").alias("source"), F.col(f"{row}.lang").alias("lang"), F.col("_v").alias("version"),
        F.lit(sign).cast("long").alias("docs"), (sign * F.col(f"{row}.tokens")).alias("tokens"), (sign * F.col(f"{row}.chars")).alias("chars"))
    rows = F.array_compact(F.array(F.when(F.col("old").isNotNull(), side("old", -1)), F.when(F.col("present"), side("new", 1))))
    return met.select(F.explode(rows).alias("r")).select("r.*")


def commit(spark: SparkSession, root: str, batch: str, changes: DataFrame) -> bool:
    """Takes in one batch of changes (doc_id, op, source, lang, version, tokens, chars) with op
    ``insert``, ``delete`` or ``revise``; False if it had been taken in before.

    Batches apply in name order; one that is sent late is refused.  Of several changes of one
    document in a batch a delete wins, then the larger count (ties by source and language), so
    repeated rows count once.  Null keys are keys; rows with other ops are refused."""
    done = committed(spark, root)
    if batch in done:
        return False
    if done and batch < done[-1]:
        raise ValueError(f"batch {batch} comes after {done[-1]}")
    if batch not in _complete(spark, root, "state"):
        known = F.when(F.col("op").isin("insert", "delete", "revise"), F.col("op")).otherwise(
            F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
        rows = changes.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("version"),
            F.struct((known == "delete").alias("gone"), F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"),
                     F.coalesce(F.col("chars").cast("long"), F.lit(0)).alias("chars"), "source", "lang").alias("s"))
        kept = rows.groupBy("doc_id", "version").agg(F.max("s").alias("s")).select(
            "doc_id", "s.source", "s.lang", "version", "s.tokens", "s.chars", (~F.col("s.gone")).alias("present"))
        _write_state(kept, _path(root, "state", batch))
    stated = _read_state(spark, _path(root, "state", batch))
    delta = signed(current(spark, root, batch, stated), stated).groupBy(*KEY).agg(*[F.sum(m).alias(m) for m in MEASURES])
    delta.write.mode("overwrite").parquet(_path(root, "deltas", batch))
    merge_states(spark, root)
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """(source, lang, version, docs, tokens, chars): the sum of all committed deltas; keys
    without documents left are not listed."""
    batches = committed(spark, root)
    schema = "source string, lang string, version string, docs long, tokens long, chars long"
    if not batches:
        return spark.createDataFrame([], schema)
    deltas = spark.read.schema(schema).parquet(*[_path(root, "deltas", b) for b in batches])
    return deltas.groupBy(*KEY).agg(*[F.sum(m).alias(m) for m in MEASURES]).filter("docs <> 0")
