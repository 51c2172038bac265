"""Language by the nearest of several centroids, with rejection by distance.

A text is a vector of its letter n-grams of one to three letters (word borders
count as a letter), hashed to ``BINS`` bins, weighted by TF-IDF and scaled to unit
length. Each language has up to ``CENTROIDS`` centroids from spherical k-means on
labelled texts. The nearest centroid by cosine names the language; a text farther
from it than ``RADIUS_SLACK`` times the 99.5 % distance of the centroid's own
training texts is rejected.

The fit reads about ``ROWS`` rows in all and ``PER_LANGUAGE`` of a language, taken
by a hash of the id among rows with a letter, one row an id and at least one of every
language; only their vectors reach the driver. The model has one to ``CENTROIDS``
vectors a language, so it grows with the number of languages and with nothing else.
Prediction is one pass over whole texts, no shuffle.

A null text or one without a letter is ``und`` with score 0 and not rejected; so
is every text if there is nothing to learn from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.llm import tokens
from tideline.llm.samples import held_out

BINS_LOG2 = 13
BINS = 1 << BINS_LOG2
CENTROIDS, PER_LANGUAGE, ROWS = 3, 400, 8000
RADIUS_SLACK = 1.25
#: Texts of one slice; with BINS it bounds the dense counts of a slice.
SLICE_TEXTS = 256
SHARPNESS = 40.0
UNKNOWN = "und"


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """(texts, BINS) counts of hashed n-grams; a row of zeros for a text without a letter."""
    lowered = ["\n" + (t or "").lower() + "\n" for t in texts]
    points = tokens.code_points("".join(lowered))
    lengths = np.array([len(t) for t in lowered])
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = tokens.letter_table()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(lengths) - lengths] = True
    symbol = np.where(letter, points, 0)[keep].astype(np.uint64)
    owner = owner[keep]
    out = np.zeros(len(texts) * BINS)
    h = np.zeros(len(symbol), np.uint64)
    for n in range(3):
        m = len(symbol) - n
        h = h[:m] * np.uint64(0x100000001B3) + symbol[n:] + np.uint64(n + 1)
        # not a border alone, and not across texts
        own = (owner[:m] == owner[n:]) & ((symbol[:m] > 0) | (symbol[n:] > 0) | (n == 2))
        bins = (h[own] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BINS_LOG2)
        out += np.bincount(owner[:m][own] * BINS + bins.astype(np.int64), minlength=len(out))
    out = out.reshape(-1, BINS)
    has_letter = np.bincount(owner, symbol > 0, minlength=len(texts)) > 0
    out[~has_letter] = 0
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def cluster(rows: np.ndarray, k: int, steps: int = 15) -> np.ndarray:
    """Unit centroids of unit rows; starts from the row nearest the mean, then the farthest ones."""
    chosen = [int(np.argmax(rows @ rows.mean(0)))]
    while len(chosen) < min(k, len(rows)):
        near = (rows @ rows[chosen].T).max(1)
        if near.min() > 1 - 1e-9:
            break
        chosen.append(int(np.argmin(near)))
    centroids = rows[chosen]
    for _ in range(steps):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[nearest == c].sum(0) for c in range(len(centroids))])
        centroids = np.where((np.abs(sums).sum(1) > 0)[:, None], _unit(sums), centroids)
    return centroids


class LanguageModel:
    def __init__(self, languages: list[str], counts: list[np.ndarray], k: int = CENTROIDS):
        """``counts``: for each language, its texts' n-gram counts."""
        seen = sum((c > 0).sum(0) for c in counts) if counts else np.zeros(BINS)
        total = sum(len(c) for c in counts)
        self.idf = np.log((1 + total) / (1 + seen)) + 1.0
        self.languages, parts, radii, owners = languages, [], [], []
        for i, c in enumerate(counts):
            rows = self._vectors(c)
            own = cluster(rows, k)
            near = rows @ own.T
            nearest = near.argmax(1)
            for j in range(len(own)):
                distance = 1 - near[nearest == j, j]
                radii.append(RADIUS_SLACK * np.quantile(distance, 0.995) if len(distance) else 0.0)
            parts.append(own)
            owners += [i] * len(own)
        self.centroids = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, BINS), np.float32)
        self.radii, self.owners = np.array(radii), np.array(owners, int)

    def _vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, texts: list[str | None]):
        """Language, score, distance to the nearest centroid and rejection, a tuple for each text."""
        counts = ngram_counts(texts)
        known = counts.any(1)
        if not len(self.centroids):
            return [(UNKNOWN, 0.0, None, False)] * len(texts)
        near = np.clip(self._vectors(counts).astype(np.float32) @ self.centroids.T, 0, 1)
        best = np.stack([near[:, self.owners == i].max(1) for i in range(len(self.languages))], axis=1)
        choice = best.argmax(1)
        odds = np.exp(SHARPNESS * (best - best.max(1, keepdims=True)))
        score = 1 / odds.sum(1)
        nearest = near.argmax(1)
        distance = 1 - near.max(1)
        rejected = distance > self.radii[nearest]
        return [
            (self.languages[c], float(s), float(d), bool(r)) if ok else (UNKNOWN, 0.0, None, False)
            for c, s, d, r, ok in zip(choice, score, distance, rejected, known, strict=True)
        ]


def _parts(texts: list):
    for lo, hi in tokens.slices(texts):
        for start in range(lo, hi, SLICE_TEXTS):
            yield start, min(start + SLICE_TEXTS, hi)


def fit(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    rows: int = ROWS,
) -> LanguageModel:
    known = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where("lang is not null and key is not null").where(~held_out("key"))
    known = known.where(F.regexp_like("text", F.lit(r"\p{L}")))
    chance = F.pmod(F.xxhash64(F.lit("language"), "key"), F.lit(1 << 30)) / (1 << 30)
    known = known.withColumn("chance", chance)
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"), F.min("chance").alias("least")).collect()
    if not sizes:
        return LanguageModel([], [])
    each = min(per_language, max(1, rows // len(sizes)))
    # a language's share of the hash range, so that about `each` of its ids are taken, and one at least
    limits = [(r["lang"], max(r["least"], each / max(r["n"], 1))) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, upto double")
    taken = known.join(F.broadcast(limits), "lang").where("chance <= upto")

    def vectors(batches):
        for batch in tokens.small(batches):
            texts = batch["text"].to_pylist()
            for lo, hi in _parts(texts):
                counts = ngram_counts(texts[lo:hi])
                rows = [np.flatnonzero(r) for r in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["key"].slice(lo, hi - lo),
                        batch["lang"].slice(lo, hi - lo),
                        pa.array([b.astype(np.int32).tobytes() for b in rows]),
                        pa.array([c[b].astype(np.int32).tobytes() for c, b in zip(counts, rows, strict=True)]),
                    ],
                    names=["key", "lang", "bins", "counts"],
                )

    kind = known.schema["key"].dataType.simpleString()
    found = taken.select("key", "lang", "text").mapInArrow(
        vectors, f"key {kind}, lang string, bins binary, counts binary"
    )
    # copies of an id, or texts under one id, count once
    one = F.min(F.struct("lang", "bins", "counts")).alias("row")
    found = [r["row"] for r in found.groupBy("key").agg(one).collect()]
    by_language: dict[str, list] = {}
    for row in sorted(found):
        if row.bins:
            by_language.setdefault(row.lang, []).append(row)
    counts = []
    for own in by_language.values():
        dense = np.zeros((len(own), BINS), np.float32)
        for i, row in enumerate(own):
            dense[i, np.frombuffer(row.bins, np.int32)] = np.frombuffer(row["counts"], np.int32)
        counts.append(dense)
    return LanguageModel(list(by_language), counts)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, distance, rejected`` (in place of columns so named)."""
    added = T._parse_datatype_string("lang_pred string, score double, distance double, rejected boolean")
    docs = docs.drop(*added.names)
    schema = T.StructType([*docs.schema.fields, *added.fields])
    arrow = to_arrow_schema(added)

    def run(batches):
        for batch in tokens.small(batches):
            texts = batch[text].to_pylist()
            found = [r for lo, hi in _parts(texts) for r in model.predict(texts[lo:hi])]
            columns = zip(*found, strict=True) if found else ((),) * 4
            for field, values in zip(arrow, columns, strict=True):
                batch = batch.append_column(field, pa.array(values, field.type))
            yield batch

    return docs.mapInArrow(run, schema)
