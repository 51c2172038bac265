"""Draw the documents that are most like a target text collection, by importance resampling.

Features are runs of words of a text (A-Z lower-cased; a word is a run of letters,
digits and anything beyond ASCII), each hashed by the CRC-32 of its bytes into one
of ``BUCKETS``. A bucket gains the log ratio of its smoothed shares in the target
and in the documents; a document weighs the mean gain of its features. Gumbel
noise of its id makes the highest scores a sample without replacement.

Counting is head and tail: the frequent words and pairs of words are found by
bounded summaries of all texts, and their checksums are broadcast; a pair whose
first word is frequent goes on from that word's state, and whatever the tables do
not hold is hashed directly. The tables change the speed only: bucket totals are
exact sums over all features of all documents, reduced to at most one row a bucket
in each task. Broadcasts have at most ``HEAD`` words and pairs of ``LONGEST_HEAD``
bytes, ``BUCKETS`` gains and one row a score, of which there are under 200,000.

Ranks come from the counts of each score, so nothing is sorted as a whole: only
documents of one score are ordered against each other. Rows with equal id, score
and weight are one row with a count until the end, where a long count is spread
over many tasks.

A null or empty text has no features and weight 0; a null id counts as an empty
one for the noise and comes last among ties. Repeated rows each take part, with
ranks of their own. Without documents nothing is drawn, without a target text all
gains come from the documents alone. Extra columns do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.tokens import small
from tideline.session import materialise

BUCKETS, RUN, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
HEAD, LONGEST_HEAD = 20_000, 64
#: Distinct words or pairs that a task counts at once before it lets the rare ones go.
HELD = 200_000
#: Equal rows that one task numbers.
CHUNK = 10_000

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLDED = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).split()


# --- head and tail ---------------------------------------------------------------


class _States(dict):
    """Checksums of words; those not held are computed and not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class _Pairs(dict):
    """Buckets of pairs; those not held go on from the first word's state."""

    states: _States
    buckets: int

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.states[pair[0]]) % self.buckets


class Vocabulary:
    """The frequent words and pairs, and the buckets of the features of any text."""

    def __init__(self, words: Iterable[bytes], pairs: Iterable[tuple[bytes, bytes]], run: int, buckets: int):
        self.run, self.buckets = run, buckets
        self.states = _States((w, zlib.crc32(w)) for w in words)
        self.pairs = _Pairs()
        self.pairs.states, self.pairs.buckets = self.states, buckets
        self.pairs.update([(p, self.pairs[p]) for p in pairs])

    def features(self, words: list[bytes]) -> np.ndarray:
        """Buckets of all runs of up to ``run`` words."""
        parts = [np.fromiter(map(self.states.__getitem__, words), np.int64, len(words)) % self.buckets]
        if self.run > 1 and len(words) > 1:
            both = map(self.pairs.__getitem__, zip(words, islice(words, 1, None)))
            parts.append(np.fromiter(both, np.int64, len(words) - 1))
        for size in range(3, self.run + 1):
            longer = (zlib.crc32(b" ".join(words[i : i + size])) % self.buckets for i in range(len(words) - size + 1))
            parts.append(np.fromiter(longer, np.int64))
        return np.concatenate(parts)

    def __reduce__(self):
        return Vocabulary, (list(self.states), list(self.pairs), self.run, self.buckets)


def _summary(size: int) -> Callable:
    """Counts of the frequent runs of ``size`` words in a task; a full table lets those below its middle go."""

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in small(batches):
            for text in batch.column(0):
                words = words_of(text.as_py())
                held.update(words if size == 1 else zip(words, islice(words, 1, None)))
                if len(held) > HELD:
                    middle = sorted(held.values())[len(held) // 2]
                    held = Counter({k: n for k, n in held.items() if n > middle})
        short = ((k, n) for k, n in held.most_common() if sum(map(len, k if size == 2 else (k,))) <= LONGEST_HEAD)
        top = list(islice(short, HEAD))
        keys = pa.array([k if size == 1 else b" ".join(k) for k, _ in top], pa.binary())
        yield pa.RecordBatch.from_arrays([keys, pa.array([n for _, n in top], pa.int64())], names=["run", "n"])

    return counts


def vocabulary(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> Vocabulary:
    """Of ``texts`` (one text column)."""

    def top(size: int) -> list[bytes]:
        counted = texts.mapInArrow(_summary(size), "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))
        return [bytes(r.run) for r in counted.orderBy(F.desc("n"), "run").limit(HEAD).collect()]

    return Vocabulary(top(1), [tuple(p.split(b" ")) for p in top(2)] if run > 1 else [], run, buckets)


# --- totals and gains ------------------------------------------------------------


def bucket_totals(texts: DataFrame, known) -> DataFrame:
    """``bucket, n`` over all features; ``known`` is a broadcast vocabulary."""

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = known.value
        sums = np.zeros(vocab.buckets, np.int64)
        for batch in small(batches):
            for text in batch.column(0):
                sums += np.bincount(vocab.features(words_of(text.as_py())), minlength=vocab.buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "n"])

    return texts.mapInArrow(totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Whole thousandths of the log ratio of each bucket's shares, one added to every count."""
    s_all, t_all = float(sum(own.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((target.get(b, 0) + 1) * s_all / ((own.get(b, 0) + 1) * t_all)))
            for b in range(buckets)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, known, gain, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document; the text stays in the task."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"

    def weights(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, value = known.value, gain.value
        for batch in small(batches):
            out = np.zeros((batch.num_rows, 3), np.int64)
            for i, one in enumerate(batch.column(1)):
                words = words_of(one.as_py())
                found = vocab.features(words)
                out[i] = len(words), len(found), value[found].sum() // max(1, len(found))
            columns = [pa.array(out[:, c].copy()) for c in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weights, schema)


# --- drawing ---------------------------------------------------------------------


def noise(doc_id, seed: int = SEED):
    """Whole thousandths of a Gumbel variable, from a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rank`` for the highest scores: 1, 2, 3... down to ``percent`` of the documents long enough.

    ``scored``: doc_id, n_words, n_features, weight, score, at rest.
    """
    long_enough = scored.where(F.col("n_words") >= least_words)
    falling = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = long_enough.groupBy("score").agg(F.count("*").alias("here"))
    # one row a score: the window sees under 200,000 rows whatever the number of documents
    upto = F.sum("here").over(falling.rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.floor(percent * F.sum("here").over(falling) / 100)
    tops = counts.select("score", (upto - F.col("here")).alias("before"), wanted.alias("wanted"))
    tops = F.broadcast(materialise(tops.where(F.col("before") < F.col("wanted"))))

    same = ["doc_id", "n_words", "n_features", "weight", "score"]
    groups = long_enough.join(tops, "score").groupBy(*same, "before", "wanted").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "n_words")
    first = F.col("before") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    groups = groups.withColumn("first", first)

    def numbered(rows: DataFrame, start, count) -> DataFrame:
        rank = F.explode(F.sequence(start + 1, start + count)).alias("rank")
        rows = rows.select(*same, "wanted", rank)
        return rows.select(*same, F.when(F.col("rank") <= F.col("wanted"), F.col("rank")).alias("rank"))

    few = groups.where(F.col("copies") <= CHUNK)
    many = groups.where(F.col("copies") > CHUNK)
    many = many.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK))))
    many = many.repartition("score", "doc_id", "chunk")
    at = F.col("first") + F.col("chunk") * CHUNK
    part = F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK)
    drawn = numbered(few, F.col("first"), F.col("copies")).unionByName(numbered(many, at, part))
    short = scored.where(F.col("n_words") < least_words)
    below = long_enough.join(tops.select("score"), "score", "left_anti")
    rest = short.unionByName(below).select(*same, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; rank is null where it is not drawn."""
    context = docs.sparkSession.sparkContext
    own, wanted = docs.select(F.col(text).alias("text")), target.select(F.col(target_text).alias("text"))
    known = context.broadcast(vocabulary(own, run, buckets))
    sums = [{r.bucket: r.n for r in bucket_totals(part, known).collect()} for part in (own, wanted)]
    gain = context.broadcast(gains(*sums, buckets))
    weighed = weigh(docs, known, gain, doc_id=doc_id, text=text)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(materialise(scored), least_words, percent)
