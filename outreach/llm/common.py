"""Helpers that several operators share: words, hashes, folds, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_VOCAB_LIMIT = 300_000  # entries a task remembers before it starts afresh


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def words(raw: bytes | None) -> list[bytes]:
    """Lower-case A-Z and split at space and control white space, nothing else: what
    `bytes` does by definition. Null has no words."""
    return raw.lower().split() if raw else []


class Hashes(dict):
    """64-bit hash of each word, remembered within a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCAB_LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def chain(state: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Extend the hashes of n-grams by one word each; order matters."""
    out = state * _MIX
    out ^= out >> _SHIFT
    out += nxt
    out *= _MIX
    return out ^ (out >> _SHIFT)


def shingles(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows; a shorter text is one window, no words none."""
    if not len(hashed):
        return hashed
    n = min(n, len(hashed))
    size = len(hashed) - n + 1
    out = hashed[:size].copy()
    for i in range(1, n):
        out = chain(out, hashed[i : i + size])
    return out


def raw_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most `most` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: what bucket counts are derived from."""
    found = docs.agg(F.sum(F.octet_length(column))).first()[0]
    return int(found or 0)


def kept_rows(docs: DataFrame, decide: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text `decide` accepts, with all their columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1000):
            yield batch.filter(pa.array(decide(batch.column("text").to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
