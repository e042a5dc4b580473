"""Byte-level text helpers shared by the operators that run Arrow batches.

Texts are handled as UTF-8 bytes.  Both word definitions of this subpackage cut at ASCII bytes
only, so ``bytes.translate`` and ``bytes.split`` give the same words as the patterns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java pattern of a word cut at ASCII white space; the same as ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def blocks(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of ``column`` (a single row may be longer)."""
    start = size = 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def free(columns: list[str], name: str) -> str:
    """A name like ``name`` that none of the columns has (letter case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Words cut at ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
