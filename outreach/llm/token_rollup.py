"""Token totals by source, language and tokenizer version, maintained by deltas.

Changes come in batches of signed rows: an insert adds a document's tokens, a delete takes
them away, a revision replaces an old count by a new one. A batch is summed up to one row
per (source, lang, tokenizer_version), and that delta is written to a folder named after
the batch. Sums are additive, so totals are the sum of all deltas, in any order. Spark
writes a folder's marker last: a batch whose marker is there has been committed and is not
applied again, one without it never counts and is written anew. Compaction sums committed
deltas into a snapshot that lists the batches it holds.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.llm.common import rows_of

KEYS = ["source", "lang", "tokenizer_version"]
_DELTA = "source string, lang string, tokenizer_version string, documents long, tokens long"
_CACHE = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a byte-level BPE: lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, name: str, keep: list[str]) -> DataFrame:
    """The kept columns and column `name`: BPE tokens of the whole text, 0 if null.

    The vocabulary is read where the driver runs and sent to the tasks. Pieces between
    the pattern's cuts never merge, so a piece's count is remembered within a task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        cuts = regex.compile(pattern)
        known: dict[str, int] = {}

        class Counts(dict):
            def __missing__(self, piece: str) -> int:
                if len(self) >= _CACHE:
                    self.clear()
                value = len(encoding.encode_ordinary(piece))
                self[piece] = value
                return value

        known = Counts()
        for batch in rows_of(batches, 1000):
            counts = [sum(map(known.__getitem__, cuts.findall(t))) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(counts, pa.int64())], names=[*keep, name])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*kinds, f"`{name}` long"]))


def inserts(counts: DataFrame) -> DataFrame:
    """Signed changes that add documents (source, lang, tokenizer_version, n_tokens)."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), F.col("n_tokens").cast("long").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Signed changes that take documents away."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("n_tokens")).cast("long").alias("tokens"))


def one_of_each(counts: DataFrame, same: str, first: list[str]) -> DataFrame:
    """One whole row per value of `same`, nulls among them: the smallest by the columns `first`, nulls
    last, then by the others, nulls first. Rows need no id, and an id may name several of
    them. Copies combine before the shuffle, so any number of them may share a value."""
    rest = [c for c in counts.columns if c != same and c not in first]
    order = [x for c in first for x in (F.col(c).isNull().alias(f"{c} is null"), F.col(c))]
    kept = counts.groupBy(same).agg(F.min(F.struct(*order, *rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c == same else F.col("_kept").getField(c).alias(c) for c in counts.columns])


def revisions(counts: DataFrame) -> DataFrame:
    """Signed changes of documents whose count goes from old_tokens to n_tokens."""
    change = (F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))).cast("long")
    return counts.select(*KEYS, F.lit(0).cast("long").alias("documents"), change.alias("tokens"))


class Rollup:
    """Totals kept below one shared folder.

    Batch names are any non-empty strings. Null sources, languages and versions are groups
    of their own; a null count adds a document without tokens; repeated rows in a batch
    count as often as they occur. An empty batch is committed like any other. Totals of
    no batch are an empty table; groups whose documents and tokens come to zero are left
    out of the totals.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self.fs.exists(self.hadoop(path))

    def _folders(self, kind: str) -> list[str]:
        top = f"{self.path}/{kind}"
        if not self._exists(top):
            return []
        found = [f"{top}/{s.getPath().getName()}" for s in self.fs.listStatus(self.hadoop(top))]
        return sorted(f for f in found if self._exists(f"{f}/_SUCCESS"))

    @staticmethod
    def _folder(batch: str) -> str:
        return "batch-" + hashlib.sha256(batch.encode()).hexdigest()

    def _snapshot(self) -> str | None:
        found = [f for f in self._folders("snapshots") if not f.endswith("-batches")]
        return found[-1] if found else None

    def _merged(self, snapshot: str | None) -> set[str]:
        if snapshot is None:
            return set()
        return {r[0] for r in self.spark.read.schema("folder string").parquet(f"{snapshot}-batches").collect()}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was committed before, whatever it holds now."""
        if not batch:
            raise ValueError("a batch needs a name")
        folder = f"{self.path}/deltas/{self._folder(batch)}"
        if self._exists(f"{folder}/_SUCCESS") or self._folder(batch) in self._merged(self._snapshot()):
            return False
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("documents", "tokens")]
        delta = changes.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS]).agg(*sums)
        delta.write.mode("overwrite").parquet(folder)
        return True

    def _sum(self) -> tuple[DataFrame, list[str], str | None]:
        snapshot = self._snapshot()
        merged = self._merged(snapshot)
        deltas = [f for f in self._folders("deltas") if f.rsplit("/", 1)[1] not in merged]
        paths = deltas + ([snapshot] if snapshot else [])
        read = self.spark.read.schema(_DELTA)
        rows = read.parquet(*paths) if paths else self.spark.createDataFrame([], _DELTA)
        names = sorted(merged | {f.rsplit("/", 1)[1] for f in deltas})
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")), names, snapshot

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, documents, tokens of all committed batches."""
        return self._sum()[0].where("documents <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Sum committed deltas into a new snapshot. Its list of batches is written before
        it, so an interrupted compaction changes nothing."""
        total, names, last = self._sum()
        number = int(last.rsplit("-", 1)[1]) + 1 if last else 1
        path = f"{self.path}/snapshots/part-{number:09d}"
        listed = self.spark.createDataFrame([(n,) for n in names], "folder string")
        listed.write.mode("overwrite").parquet(f"{path}-batches")
        total.write.mode("overwrite").parquet(path)
