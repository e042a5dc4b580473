"""Modified Kneser-Ney model over folded bytes: counted by Spark, kept in sorted hash arrays.

Texts are read as UTF-8 bytes folded into 32 symbols, so a language has 2**20 four-grams at
most, however large the corpus is: that bounds what is fetched and broadcast."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.text import blocks, text_bytes
from lakeloom.session import stage

ORDER = 4
BITS = 5
SYMBOLS = 1 << BITS
GRAMS = 1 << BITS * ORDER
#: Languages with a model of their own unless others are given or found in the data
#: (``found_languages``); every other code, and null, shares one more model.
LANGUAGES = ("de", "en", "es", "fr")
#: Documents a language needs for a model and a band of its own.
OWN_DOCS = 20
#: Tables of counts that a task holds at a time.
TABLES = 16
#: Log probabilities are kept and summed as whole micro-nats, so sums don't depend on order.
UNIT = 1_000_000


#: Marks with a symbol of their own, 8 and up; other ASCII marks share the last one.
MARKS = ".,!?'\":;-()#*$%&|<>@_/=+"


def _symbol(byte: int) -> int:
    """0 white space and controls, 1 first and 2 following bytes of a non-ASCII character,
    3 vowels, 4 consonants, 5 capitals, 6 digits, 7 line ends, then marks.

    Letters are folded hard and marks kept apart: what tells running text from debris is how
    words, marks, capitals and lines follow each other."""
    if byte >= 0x80:
        return 1 if byte >= 0xC0 else 2
    char = chr(byte)
    if char.isalpha():
        return 5 if char.isupper() else 3 if char in "aeiou" else 4
    if char.isdigit():
        return 6
    if char == "\n":
        return 7
    if byte <= 32 or byte == 127:
        return 0
    return 8 + (MARKS.index(char) if char in MARKS else len(MARKS) - 1)


def _letter_symbol(byte: int) -> int:
    """0 white space and controls, 1 first and 2 following bytes of a non-ASCII character,
    3 digits, 4 line ends, 5 marks, then the letters, whatever their case.

    The following bytes of other scripts' letters share the letters' symbols, by their low bits (see
    ``_folded``).  They stand behind a first byte, so what they mean is told apart; a four-gram
    then holds two letters of Cyrillic, Greek, Arabic or Hebrew, or a character of longer scripts
    and more."""
    if byte >= 0xC0:
        return 1
    if byte >= 0x80:
        return 2 if byte == 0x80 else 6 + (byte & 0x3F) % 26
    char = chr(byte)
    if char.isalpha():
        return 6 + ord(char.lower()) - ord("a")
    return 3 if char.isdigit() else 4 if char == "\n" else 0 if byte <= 32 or byte == 127 else 5


FOLD = bytes(_symbol(b) for b in range(256))
#: The other view of a text: letters apart, marks folded.
LETTERS = bytes(_letter_symbol(b) for b in range(256))
_PAD = bytes(ORDER - 1)
#: Accented Latin letters, punctuation and pictures: their following bytes are all read as 0x80.
_ALIKE = re.compile(rb"[\xc2-\xcb][\x80-\xbf]|\xe2[\x80-\xbf]{2}|\xf0[\x80-\xbf]{3}")


def _folded(text: bytes, fold: bytes) -> bytes:
    """A text's symbols, one for each byte."""
    if not text.isascii():
        text = _ALIKE.sub(lambda m: m[0][:1] + b"\x80" * (len(m[0]) - 1), text)
    return text.translate(fold)


def grams(texts: list[bytes], fold: bytes = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """The four-gram that ends at each byte of each text (white space before its start), and
    where each text's four-grams begin."""
    joined = np.frombuffer(b"".join(_PAD + _folded(t, fold) for t in texts) + _PAD, np.uint8).astype(np.uint32)
    ids = joined[:-ORDER]
    for k in range(1, ORDER):
        ids = (ids << np.uint32(BITS)) | joined[k:len(joined) - ORDER + k]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER - 1) - sizes - ORDER + 1
    inside = np.ones(len(ids), bool)
    for k in range(ORDER - 1):  # a pad has ORDER - 1 bytes: as many four-grams end in the next one
        ends = starts + sizes + k
        inside[ends[ends < len(ids)]] = False
    return ids[inside], np.cumsum(sizes) - sizes


def language_numbers(column: pa.Array, languages: tuple[str, ...]) -> np.ndarray:
    number = {code: i for i, code in enumerate(languages)}
    return np.array([number.get(code, len(languages)) for code in column.to_pylist()], np.int64)


def found_languages(docs: DataFrame, lang_column: str = "lang", least: int = OWN_DOCS) -> tuple[str, ...]:
    """The language codes that ``least`` documents or more have, in order."""
    counted = docs.groupBy(F.col(lang_column).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    return tuple(sorted(r["lang"] for r in counted.filter((F.col("n") >= least) & F.col("lang").isNotNull()).collect()))


def count_grams(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES,
                text_column: str = "text", lang_column: str = "lang", folds: tuple[bytes, ...] = (FOLD,)) -> DataFrame:
    """(language, gram, n) over every byte of every text; tasks sum before they hand over.  A
    further fold's languages are numbered on from those of the one before."""
    def handed(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for code, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.record_batch([pa.array(np.full(len(seen), code), pa.int32()), pa.array(seen, pa.int32()),
                                   pa.array(total[seen], pa.int64())], ["language", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in blocks(batch, "_text", 2 << 20):
                codes = language_numbers(part.column("_lang"), languages)
                texts = text_bytes(part.column("_text"))
                for code in np.unique(codes).tolist():
                    own = [t for t, c in zip(texts, codes.tolist(), strict=True) if c == code]
                    for view, fold in enumerate(folds):
                        number = code + view * (len(languages) + 1)
                        if number not in totals and len(totals) == TABLES:
                            yield from handed(totals)
                            totals = {}
                        total = totals.setdefault(number, np.zeros(GRAMS, np.int64))
                        total += np.bincount(grams(own, fold)[0], minlength=GRAMS)
        yield from handed(totals)

    narrow = docs.select(F.col(lang_column).cast("string").alias("_lang"), F.col(text_column).cast("string").alias("_text"))
    return (narrow.mapInArrow(count, "language int, gram int, n long")
            .groupBy("language", "gram").agg(F.sum("n").alias("n")))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and 3 or more (Chen and Goodman)."""
    n1, n2, n3, n4 = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):  # too few low counts to estimate from
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))])


def estimate(counts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Interpolated log probabilities of seen n-grams and log weights of seen contexts, by
    order from 1; dense, with NaN for what was not seen.  ``counts``: of all four-grams."""
    adjusted = [counts]
    for _ in range(ORDER - 1):  # in how many different contexts each shorter n-gram was seen
        adjusted.insert(0, (adjusted[0].reshape(SYMBOLS, -1) > 0).sum(axis=0))
    logs, weights = [], []
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for table in adjusted:
        by_context = table.reshape(-1, SYMBOLS)
        taken = _discounts(table)[np.minimum(by_context, 3)]
        total = by_context.sum(axis=1, keepdims=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            weight = np.where(total > 0, taken.sum(axis=1, keepdims=True) / total, 1.0)
            full = np.where(total > 0, (by_context - taken) / total, 0.0) + weight * np.resize(lower, (len(by_context) // max(1, len(lower) // SYMBOLS), len(lower))).reshape(by_context.shape)
            logs.append(np.where(table > 0, np.log(full.ravel()), np.nan))
            weights.append(np.where(total.ravel() > 0, np.log(weight.ravel()), np.nan))
        lower = full.ravel()
    return logs, weights


def _hashed(kind: int, language: np.ndarray | int, gram: np.ndarray) -> np.ndarray:
    """One-to-one mixing of (kind, language, n-gram) to 64 bits."""
    x = np.asarray(gram, np.uint64) | np.asarray(language, np.uint64) << np.uint64(24) | np.uint64(kind << 56)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


@dataclass
class Model:
    """Sorted hashes of n-grams (one array for each order) and contexts, with their values."""
    languages: tuple[str, ...]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    folds: tuple[bytes, ...] = (FOLD,)

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = table
        if not len(hashes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
        return values[place], hashes[place] == keys

    def score(self, language: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log probability of each four-gram's last symbol, in micro-nats."""
        out = np.zeros(len(ids), np.int64)
        left = np.arange(len(ids))
        for order in range(ORDER, 0, -1):
            gram = ids[left] & np.uint32((1 << BITS * order) - 1)
            value, seen = self._find(self.grams[order - 1], _hashed(order, language[left], gram))
            out[left[seen]] += value[seen]
            left = left[~seen]
            if not len(left):
                return out
            weight, known = self._find(self.contexts[order - 1], _hashed(8 + order, language[left], gram[~seen] >> np.uint32(BITS)))
            out[left] += np.where(known, weight, 0)
        out[left] -= round(np.log(SYMBOLS) * UNIT)
        return out

    def log_loss(self, texts: list[bytes], language: np.ndarray, view: int = 0) -> np.ndarray:
        """Whole micro-nats lost over each text; 0 for an empty one.  ``view``: number of the fold."""
        ids, starts = grams(texts, self.folds[view])
        language = language + view * (len(self.languages) + 1)
        sizes = np.diff(np.append(starts, len(ids)))
        total = np.concatenate(([0], np.cumsum(self.score(np.repeat(language, sizes), ids))))
        return total[starts] - total[starts + sizes]


def _model(counted: pa.Table, languages: tuple[str, ...], folds: tuple[bytes, ...]) -> Model:
    language, gram, n = (counted.column(c).to_numpy() for c in ("language", "gram", "n"))
    grams_found: list[list] = [[] for _ in range(ORDER)]
    contexts_found: list[list] = [[] for _ in range(ORDER)]
    for code in np.unique(language).tolist():
        counts = np.zeros(GRAMS, np.int64)
        counts[gram[language == code]] = n[language == code]
        for order, (logs, weights) in enumerate(zip(*estimate(counts), strict=True), 1):
            for kind, values, found in ((order, logs, grams_found), (8 + order, weights, contexts_found)):
                seen = np.flatnonzero(~np.isnan(values))
                found[order - 1].append((_hashed(kind, code, seen), np.rint(values[seen] * UNIT).astype(np.int64)))

    def table(parts: list) -> tuple[np.ndarray, np.ndarray]:
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        return keys[order], values[order]

    return Model(languages, [table(p) for p in grams_found], [table(p) for p in contexts_found], folds)


def train(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES,
          text_column: str = "text", lang_column: str = "lang") -> Model:
    """The model of a corpus.  What comes to the driver is counts of folded four-grams: at most
    2**20 for each of ``languages`` and one for the rest."""
    return _model(count_grams(docs, languages, text_column, lang_column).toArrow(), languages, (FOLD,))


def train_each(docs: DataFrame, languages: tuple[str, ...], text_column: str = "text", lang_column: str = "lang",
               folds: tuple[bytes, ...] = (FOLD, LETTERS)) -> Iterator[tuple[int, Model]]:
    """(number, model) of each language, one after the other; the driver holds the counts of one."""
    counted = stage(count_grams(docs, languages, text_column, lang_column, folds), "grams")
    code = F.col("language") % F.lit(len(languages) + 1)
    for number in sorted(r["code"] for r in counted.select(code.alias("code")).distinct().collect()):
        yield number, _model(counted.filter(code == number).toArrow(), languages, folds)
