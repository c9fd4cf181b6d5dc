"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of the uniform distribution and the maximum-
likelihood estimates of the n-grams of length 1 to ORDER that end with it. The mixture's
weights depend on a bucket: which is the longest context seen in training, and the power
of two below how often it was seen. They are learned by expectation-maximisation: a part
of the training texts is held out, the estimates come from the rest, the weights are those
that make the held-out counts likeliest. The final estimates use all training texts.

How it runs: texts are packed into batches of about BATCH_TOKENS tokens (a longer text is
a batch of its own), each with its own word list, and named by the task that makes it and
its number there, so no two share a name whatever they hold. A batch sends its distinct
n-grams, with their counts, to buckets of the hash space; a bucket adds the counts up and
answers each batch with the totals of the n-grams it asked for. So a word that makes up a
third of all tokens is one entry per batch, and nothing is sent per token. Batches and
answers are written to the staging folder; every step is a plain Spark stage over them.
N-grams of one length are asked for at a time, and the files of that exchange are given up
once its answers are written, so the disk holds one length's n-grams and not all.

N-grams are told apart by 64-bit hashes: among a billion different ones about one pair in
37 such corpora would be taken for the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import Hashes, chain, raw_column, rows_of, words
from outreach.sources.staging import stage_path

ORDER = 3
BATCH_TOKENS = 1 << 18
BUCKET_KEYS = 1 << 20  # n-grams that a bucket is sent, about
ITERATIONS = 12
ADD = 0.1

_BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b" begin"))  # words hold no space
_END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))
_SEEN = 40  # powers of two told apart per context length
TEST, HELD, MAIN = 0, 1, 2


# Ends the life of a write's shuffle files with the write, instead of with the driver's next garbage collection.
_GIVE_UP_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stage(df: DataFrame) -> DataFrame:
    spark, path = df.sparkSession, stage_path(df.sparkSession)
    before = spark.conf.get(_GIVE_UP_FILES, "false")
    spark.conf.set(_GIVE_UP_FILES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_GIVE_UP_FILES, before)
    return spark.read.schema(df.schema).parquet(path)


def pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which general compression likes."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


_BATCHES = "batch_id string, held boolean, doc_ids array<long>, roles binary, lengths binary, vocabulary binary, codes binary"


def _to_batches(size: int) -> Callable:
    """Batches of documents; held-out texts have batches of their own."""
    schema = pa.schema([("batch_id", pa.string()), ("held", pa.bool_()), ("doc_ids", pa.list_(pa.int64())), ("roles", pa.binary()),
                        ("lengths", pa.binary()), ("vocabulary", pa.binary()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        waiting: dict[bool, list] = {False: [], True: []}
        tokens = {False: 0, True: 0}
        task, made = TaskContext.get().partitionId(), 0

        def close(held: bool) -> Iterator[pa.RecordBatch]:
            rows = waiting[held]
            if not rows:
                return
            ids, roles, hashed = zip(*rows)
            lengths = np.array([len(h) for h in hashed], dtype=np.uint32)
            vocabulary, codes = np.unique(np.concatenate(hashed), return_inverse=True)
            codes = codes.astype(np.uint32)
            nonlocal made
            made += 1  # a retried task makes the same batches in the same order
            values = [f"{task}-{made}", held, list(ids), pack(np.array(roles, dtype=np.uint8)), pack(lengths), pack_sorted(vocabulary), pack(codes)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)
            waiting[held], tokens[held] = [], 0

        for batch in rows_of(batches, 1000):
            for doc_id, role, text in zip(batch.column("doc_id").to_pylist(), batch.column("role").to_pylist(), raw_column(batch, "text")):
                held = role == HELD
                own = hashes.of(words(text))
                waiting[held].append((doc_id, role, own))
                tokens[held] += len(own) + 1
                if tokens[held] >= size:
                    yield from close(held)
        yield from close(False)
        yield from close(True)

    return run


@dataclass
class Stream:
    """A batch as one run of tokens, each text with marks for its begin and end."""

    roles: np.ndarray  # per text
    lengths: np.ndarray  # words per text
    tokens: np.ndarray
    predicted: np.ndarray  # which positions are words or ends
    counted: np.ndarray  # those and the last begin mark, a context only
    starts: np.ndarray  # of each text among the predicted positions

    @classmethod
    def of(cls, row: dict, order: int) -> Stream:
        roles, lengths = unpack(row["roles"], np.uint8), unpack(row["lengths"], np.uint32).astype(np.int64)
        own = unpack_sorted(row["vocabulary"])[unpack(row["codes"], np.uint32)] if len(row["codes"]) else np.zeros(0, np.uint64)
        pad = order - 1
        spans = lengths + pad + 1
        ends = np.cumsum(spans)
        begins = ends - spans
        tokens = np.full(int(ends[-1]), _BEGIN, dtype=np.uint64)
        inside = np.ones(len(tokens), dtype=bool)
        for i in range(pad):
            inside[begins + i] = False
        predicted = inside.copy()
        inside[ends - 1] = False
        tokens[inside] = own
        tokens[ends - 1] = _END
        counted = predicted.copy()
        if pad:
            counted[begins + pad - 1] = True
        return cls(roles, lengths, tokens, predicted, counted, np.cumsum(lengths + 1) - (lengths + 1))

    def grams(self, order: int) -> list[np.ndarray]:
        """Per length the hashes of the n-grams that end at each position."""
        out = [self.tokens]
        for _ in range(1, order):
            before = np.concatenate([[_BEGIN], out[-1][:-1]])
            out.append(chain(before, self.tokens))
        return out

    def role_at(self, order: int) -> np.ndarray:
        return np.repeat(self.roles, self.lengths + order)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


_ASKED = "bucket int, batch_id string, held boolean, keys binary, seen binary"


def _ask(level: int, order: int, bits: int) -> Callable:
    """Distinct n-grams of a length of each batch by bucket, with their counts in its
    training texts."""
    schema = pa.schema([("bucket", pa.int32()), ("batch_id", pa.string()), ("held", pa.bool_()), ("keys", pa.binary()), ("seen", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                stream = Stream.of(row, order)
                learned = stream.role_at(order)[stream.counted] != TEST
                keys, at = np.unique(stream.grams(level)[-1][stream.counted], return_inverse=True)
                seen = np.bincount(at[learned], minlength=len(keys)).astype(np.uint32)
                buckets = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                edges = np.flatnonzero(np.diff(buckets, prepend=-1))
                parts = [(int(buckets[a]), slice(a, b)) for a, b in zip(edges, [*edges[1:], len(keys)])]
                columns = [[k for k, _ in parts], [row["batch_id"]] * len(parts), [row["held"]] * len(parts),
                           [pack_sorted(keys[s]) for _, s in parts], [pack(seen[s]) for _, s in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_ANSWERS = "level int, bucket int, batch_id string, held boolean, main binary, whole binary, sums array<long>"


def _answer(level: int) -> Callable:
    """Totals for each batch's n-grams, over all training texts (`whole`) and, for held-out
    batches, over the main part. With batch_id null a bucket's own sums: tokens in the main
    part, tokens held out, distinct tokens."""
    schema = pa.schema([("level", pa.int32()), ("bucket", pa.int32()), ("batch_id", pa.string()), ("held", pa.bool_()), ("main", pa.binary()),
                        ("whole", pa.binary()), ("sums", pa.list_(pa.int64()))])

    def one(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            keys = [unpack_sorted(r[2]) for r in rows]
            found, at = np.unique(np.concatenate(keys), return_inverse=True)
            seen = np.concatenate([unpack(r[3], np.uint32) for r in rows]).astype(np.float64)
            of_held = np.repeat([r[1] for r in rows], [len(k) for k in keys])
            whole = np.bincount(at, weights=seen, minlength=len(found)).astype(np.uint64)
            held = np.bincount(at, weights=seen * of_held, minlength=len(found)).astype(np.uint64)
            main = whole - held
            cuts = np.cumsum([0] + [len(k) for k in keys])
            for (batch_id, is_held, *_), a, b in zip(rows, cuts, cuts[1:]):
                yield one(level, bucket, batch_id, is_held, pack(main[at[a:b]]) if is_held else None, pack(whole[at[a:b]]), None)
            if level == 1:
                word = found != _BEGIN
                yield one(level, bucket, None, None, None, None, [int(main[word].sum()), int(held[word].sum()), int((whole[word] > 0).sum())])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "batch_id", "held", "keys", "seen")]
            for own, *row in zip(*columns):
                if own != bucket:
                    yield from done()
                    bucket, rows = own, []
                rows.append(row)
        yield from done()

    return run


def _counts(answers: list[dict], order: int, stream: Stream, name: str) -> list[np.ndarray]:
    """Counts, by length, of the n-gram that ends at each position."""
    out = []
    for level, grams in enumerate(stream.grams(order), start=1):
        own = sorted((a for a in answers if a["level"] == level), key=lambda a: a["bucket"])
        _, at = np.unique(grams[stream.counted], return_inverse=True)
        values = np.zeros(len(grams))
        values[stream.counted] = np.concatenate([unpack(a[name], np.uint64) for a in own]).astype(np.float64)[at]
        out.append(values)
    return out


def estimates(counts: list[np.ndarray], total: float, kinds: float, predicted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each predicted position, and the estimates that are mixed there: uniform,
    then by n-gram length. A length whose context was not seen has estimate 0."""
    order = len(counts)
    parts = [np.full(int(predicted.sum()), 1 / (kinds + 1)), counts[0][predicted] / max(total, 1)]
    bucket = np.zeros(len(parts[0]), dtype=np.int64)
    for level in range(2, order + 1):
        context = np.concatenate([[0.0], counts[level - 2][:-1]])[predicted]
        parts.append(np.divide(counts[level - 1][predicted], context, out=np.zeros(len(context)), where=context > 0))
        seen = context > 0
        power = np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), _SEEN - 1)
        bucket[seen] = (level - 2) * _SEEN + 1 + power[seen]
    return bucket, np.stack(parts)


def _buckets(order: int) -> int:
    return (order - 1) * _SEEN + 1


_EVENTS = pa.schema([("buckets", pa.binary()), ("parts", pa.binary())])


def _held_events(order: int, kinds: float, total: float) -> Callable:
    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        buckets, estimated = [], []
        for row in batch.to_pylist():
            stream = Stream.of(row, order)
            main = _counts(answers.to_pylist(), order, stream, "main")
            bucket, parts = estimates(main, total, kinds, stream.predicted)
            buckets.append(bucket.astype(np.uint16).tobytes())
            estimated.append(parts.astype(np.float32).tobytes())
        return pa.Table.from_arrays([pa.array(buckets, pa.binary()), pa.array(estimated, pa.binary())], schema=_EVENTS)

    return run


def _expect(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(weights.shape)
        for batch in batches:
            for buckets, parts in zip(batch.column("buckets").to_pylist(), batch.column("parts").to_pylist()):
                at = np.frombuffer(buckets, dtype=np.uint16)
                mixed = np.frombuffer(parts, dtype=np.float32).reshape(weights.shape[1], -1) * weights[at].T
                mixed /= mixed.sum(axis=0)
                for i, row in enumerate(mixed):
                    sums[:, i] += np.bincount(at, weights=row, minlength=len(weights))
        kept = np.flatnonzero(sums.sum(axis=1))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(kept, pa.int32()), "shares": pa.array(list(sums[kept]), pa.list_(pa.float64()))})

    return run


def learn_weights(events: DataFrame, order: int, iterations: int) -> np.ndarray:
    """Mixture weights by bucket. Buckets without held-out tokens, or all without any, get
    those of the nearest bucket with fewer occurrences, or equal weights."""
    weights = np.full((_buckets(order), order + 1), 1 / (order + 1))
    known = np.zeros(len(weights), dtype=bool)
    for _ in range(iterations):
        part = events.mapInArrow(_expect(weights), "bucket int, shares array<double>")
        sums = part.groupBy("bucket").agg(*[F.sum(F.col("shares")[i]) for i in range(order + 1)]).collect()
        for bucket, *shares in sums:  # one row per bucket
            # One imagined token spread evenly keeps every weight above zero.
            smoothed = np.array(shares) + 1 / (order + 1)
            weights[bucket], known[bucket] = smoothed / smoothed.sum(), True
    for bucket in range(1, len(weights)):
        if not known[bucket] and known[:bucket].any():
            weights[bucket] = weights[np.flatnonzero(known[:bucket])[-1]]
    return weights


_SCORES = pa.schema([("doc_id", pa.int64()), ("role", pa.int32()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def _score(order: int, kinds: float, total: float, weights: np.ndarray) -> Callable:
    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in batch.to_pylist():
            stream = Stream.of(row, order)
            counts = _counts(answers.to_pylist(), order, stream, "whole")
            bucket, parts = estimates(counts, total, kinds, stream.predicted)
            single = counts[0][stream.predicted]
            base = np.log10((single + ADD) / (total + ADD * (kinds + 1)))
            score = np.log10((parts * weights[bucket].T).sum(axis=0))
            add = lambda x: np.add.reduceat(x, stream.starts)
            columns = [row["doc_ids"], stream.roles, stream.lengths + 1, add((single > 0).astype(np.int64)), add(base), add(score)]
            out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES)], schema=_SCORES))
        return pa.concat_tables(out) if out else _SCORES.empty_table()

    return run


def score_texts(docs: DataFrame, role: Column, *, order: int = ORDER, iterations: int = ITERATIONS) -> DataFrame:
    """Per row of `docs`: doc_id, role, n_tokens, n_known, train_tokens, base_score, score.

    `role` says what a row is for: MAIN and HELD are learned from (HELD also fits the
    mixture's weights), TEST is not; every row is scored. A text is its words and one
    end; a null text is empty, so its one token is the end. Without training texts all
    tokens are unknown and equally likely. Rows without an id and repeated rows are
    learned from and scored like others; columns but doc_id and text are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), role.cast("int").alias("role"), "text")
    batches = _stage(rows.mapInArrow(_to_batches(BATCH_TOKENS), _BATCHES))
    size = batches.agg(F.sum(F.octet_length("codes") / 4)).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, size / BUCKET_KEYS)))))
    answers = None
    for level in range(1, order + 1):
        by_bucket = batches.mapInArrow(_ask(level, order, bits), _ASKED).repartition("bucket").sortWithinPartitions("bucket", "batch_id")
        told = _stage(by_bucket.mapInArrow(_answer(level), _ANSWERS))
        answers = told if answers is None else answers.unionAll(told)
    sums = answers.where("level = 1").agg(*[F.sum(F.col("sums")[i]) for i in range(3)]).first()
    main, held, kinds = (int(x or 0) for x in sums)

    def with_answers(which: Column, of: str, run: Callable, schema: str) -> DataFrame:
        """A task holds one batch and its answers, as much as the batch itself, at a time."""
        own = batches.where(which).groupBy("batch_id")
        told = answers.where(which & F.col("batch_id").isNotNull()).select("batch_id", "level", "bucket", of).groupBy("batch_id")
        return own.cogroup(told).applyInArrow(run, schema)

    events = _stage(with_answers(F.col("held"), "main", _held_events(order, kinds, main), "buckets binary, parts binary"))
    weights = learn_weights(events, order, iterations)
    scores = "doc_id long, role int, n_tokens long, n_known long, base_score double, score double"
    out = with_answers(F.lit(True), "whole", _score(order, kinds, main + held, weights), scores)
    return out.withColumn("train_tokens", F.lit(main + held).cast("long"))
