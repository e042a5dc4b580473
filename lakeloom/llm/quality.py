"""Quality rules: plain limits on words, and bands of n-gram perplexity by language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.ngram_model import UNIT, Model, found_languages, language_numbers, train_each
from lakeloom.llm.text import blocks, free, text_bytes
from lakeloom.session import stage

MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
REPEAT_WINDOW = 8
#: A limit lies so many times its side's median distance from the median at most.
WIDTH = 13.0
#: From the first of these distances on a limit may lie nearer, where a tail that has its mode
#: beyond the second one parts from the rest.
NEAR, TAIL = 4.0, 6.0
VIEWS = ("log_ppl", "log_ppl_letters")
#: Log perplexity is binned by thousandths when bands are drawn.
BINS = 1_000

_SPACE = b" \t\n\x0b\x0c\r"
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_WEIGHTS = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1 for k in range(REPEAT_WINDOW)], np.uint64)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of consecutive words that are found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = sum(hashes[k:k + n] * _WEIGHTS[k] for k in range(window))
    order = np.argsort(rolled, kind="stable")
    same = np.flatnonzero(rolled[order[1:]] == rolled[order[:-1]])
    if not len(same):
        return 0
    groups: dict[bytes, list[int]] = {}
    for at in np.unique(np.concatenate((order[same], order[same + 1]))).tolist():
        groups.setdefault(b" ".join(words[at:at + window]), []).append(at)
    hit = np.zeros(len(words) + 1, np.int64)
    starts = np.array([at for places in groups.values() if len(places) > 1 for at in places], np.int64)
    np.add.at(hit, starts, 1)
    np.add.at(hit, starts + window, -1)
    return int((np.cumsum(hit[:-1]) > 0).sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(text.translate(None, _NOT_COUNTED)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED * n_words


@dataclass
class Models:
    """Each language's model, fetched where a text of the language is scored."""
    languages: tuple[str, ...]
    own: dict[int, Broadcast]

    def log_ppl(self, texts: list[bytes], language: np.ndarray) -> list[list[int]]:
        """Log perplexity per byte by each view, in bins; 0 for an empty text."""
        found = np.zeros((len(VIEWS), len(texts)), np.int64)
        for code in np.unique(language).tolist():
            rows = np.flatnonzero(language == code) if code in self.own else ()
            if not len(rows):
                continue
            model: Model = self.own[code].value
            part = [texts[i] for i in rows.tolist()]
            sizes = np.maximum(1, np.array([len(t) for t in part], np.int64))
            for view in range(len(VIEWS)):
                found[view, rows] = model.log_loss(part, language[rows], view) * BINS // (sizes * UNIT)
        return found.tolist()


def models_of(docs: DataFrame, languages: tuple[str, ...] | None, text_column: str, lang_column: str) -> Models:
    languages = found_languages(docs, lang_column) if languages is None else languages
    context = docs.sparkSession.sparkContext
    return Models(languages, {code: context.broadcast(model) for code, model in train_each(docs, languages, text_column, lang_column)})


Bands = dict[tuple[str, int], tuple[float, float]]


def limit_rows(spark: SparkSession, limits: Bands) -> DataFrame:
    """The bands as a table: language, and a low and a high limit for each view; a row for each model."""
    codes = sorted({code for _, code in limits})
    rows = [(code, *(x for view in VIEWS for x in limits[view, code])) for code in codes]
    return spark.createDataFrame(rows, "language int, " + ", ".join(f"{view}_low double, {view}_high double" for view in VIEWS))


def within(scored: DataFrame, limits: Bands) -> DataFrame:
    """``scored`` with ``kept``: the plain rules hold and both log perplexities are inside their bands."""
    fits = reduce(Column.__and__, [F.col(view).between(F.col(f"{view}_low"), F.col(f"{view}_high")) for view in VIEWS])
    met = scored.join(F.broadcast(limit_rows(scored.sparkSession, limits)), "language", "left")
    drawn = [f"{view}_{end}" for view in VIEWS for end in ("low", "high")]
    return met.withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(True))).drop(*drawn)


def score(docs: DataFrame, models: Models, id_column: str = "doc_id", text_column: str = "text",
          lang_column: str = "lang") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    language (number of the model), log_ppl (log perplexity a byte, in thousandths) and
    log_ppl_letters (the same by the view that keeps letters apart)."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text", 2 << 20):
                texts = text_bytes(part.column("_text"))
                language = language_numbers(part.column("_lang"), models.languages)
                found = [measures(t) for t in texts]
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.record_batch(
                    [part.column("doc_id"), *columns, pa.array([base_fails(m[0], m[4]) for m in found]),
                     pa.array(language, pa.int32()), *[pa.array(v, pa.int64()) for v in models.log_ppl(texts, language)]],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "language", *VIEWS])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("_text"),
                         F.col(lang_column).cast("string").alias("_lang"))
    return narrow.mapInArrow(measure, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                      "n_repeat_words long, base_failed boolean, language int, log_ppl long, log_ppl_letters long")


def _middle(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values)
    return float(values[order][np.searchsorted(np.cumsum(counts[order]), (counts.sum() + 1) // 2)])


def _limit(distance: np.ndarray, counts: np.ndarray, width: float) -> float:
    """How far from the median a side of the band reaches.

    The tail's mode is where most rows lie about a distance beyond ``TAIL``.  If the rows thin
    out to a third on the way there, the limit is where they are fewest; ``width`` at most."""
    step = max(1.0, _middle(distance, counts))
    order = np.argsort(distance)
    distance, total = distance[order], np.concatenate(([0], np.cumsum(counts[order])))
    at = np.arange(int(NEAR * step), int(3 * width * step) + 1)
    near = total[np.searchsorted(distance, at + step, "right")] - total[np.searchsorted(distance, at - step)]
    beyond = np.flatnonzero(at >= TAIL * step)
    mode = int(beyond[np.argmax(near[beyond])])
    least = near[:mode + 1].min()
    if near[mode] < 3 * (least + 1):
        return width * step
    sparse = np.flatnonzero(near[:mode + 1] == least)
    run = max(np.split(sparse, np.flatnonzero(np.diff(sparse) > 1) + 1), key=len)
    return min(width * step, float(at[run[0]] + at[run[-1]]) / 2)


def bands(scored: DataFrame, width: float = WIDTH) -> Bands:
    """Each view's and language's lower and upper limit, drawn apart from all rows that pass the
    plain rules.  Bins are counted, so the limits are exact at their resolution and the driver
    sees a bounded number of rows."""
    found = {}
    for view in VIEWS:
        binned = (scored.filter("NOT base_failed").groupBy("language", view)
                  .agg(F.count(F.lit(1)).alias("n")).toArrow())
        language, value, n = (binned.column(c).to_numpy() for c in ("language", view, "n"))
        for code in np.unique(language).tolist():
            own, counts = value[language == code], n[language == code]
            middle = _middle(own, counts)
            low, high = own <= middle, own >= middle
            found[view, code] = (middle - _limit(middle - own[low], counts[low], width),
                                 middle + _limit(own[high] - middle, counts[high], width))
    return found


def judge(docs: DataFrame, languages: tuple[str, ...] | None = None, width: float = WIDTH,
          id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``score`` with kept: the plain rules hold and both log perplexities are inside their bands.

    The models are counted over all rows.  Without ``languages`` each code that ``OWN_DOCS``
    rows have gets its own; a null, rare or unlisted one shares the model for the rest.  Null
    texts have no words and fail; rows may repeat; no rows give no rows; other columns are
    ignored."""
    models = models_of(docs, languages, text_column, lang_column)
    scored = stage(score(docs, models, id_column, text_column, lang_column), "quality")
    return within(scored, bands(scored, width)).select(*scored.columns, "kept")


def filter_documents(docs: DataFrame, languages: tuple[str, ...] | None = None, width: float = WIDTH,
                     text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.  Texts are scored once and stored
    with their scores, so that the bands, which need all scores, are a filter over stored rows; no
    text is shuffled."""
    models = models_of(docs, languages, text_column, lang_column)
    added = {name: free(docs.columns, name) for name in ("base_failed", "language", *VIEWS)}
    lang = free(docs.columns, "_lang")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text_column, 2 << 20):
                texts = text_bytes(part.column(text_column))
                language = language_numbers(part.column(lang), models.languages)
                split = [t.split() for t in texts]
                failed = [base_fails(len(words), repeated_words(words)) for words in split]
                scores = models.log_ppl(texts, language)
                rest = part.drop_columns([lang])
                yield pa.record_batch([*rest.columns, pa.array(failed, pa.bool_()), pa.array(language, pa.int32()), *[pa.array(v, pa.int64()) for v in scores]],
                                      [*rest.schema.names, *added.values()])

    kinds = [T.BooleanType(), T.IntegerType(), *[T.LongType() for _ in VIEWS]]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(added.values(), kinds, strict=True)]])
    scored = stage(docs.withColumn(lang, F.col(lang_column).cast("string")).mapInArrow(measure, schema), "quality")
    named = scored.select(*[F.col(new).alias(name) for name, new in added.items()], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    return within(named, bands(named, width)).filter("kept").select(*[F.col(f"_doc.`{c}`") for c in docs.columns])
