"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A
text is compressed with each, in chunks of ``CHUNK`` bytes, so that the dictionary
and not the text's own history decides whatever the length. The difference of the
two sizes divided by the text's size, together with how well it compresses at all
and, for texts shorter than a chunk, its length, becomes a probability by logistic
calibration on labelled rows that gave nothing to the dictionaries.

The fit reads at most ``SAMPLE_ROWS`` rows of each label and at most
``SAMPLE_CHUNKS`` chunks of each for a dictionary; scoring is one pass over all
whole texts without a shuffle. Null and empty texts score 0. With one label or
none to learn from, every text scores that label's share (0.5 for none).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import tokens
from tideline.llm.samples import Logistic, labelled_rows
from tideline.session import materialise

CHUNK = 2000
LEVEL = 3
SAMPLE_ROWS, SAMPLE_CHUNKS = 3000, 3000
DICTIONARY_BYTES = 112_640
THRESHOLD = 0.3


def chunks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


class CompressionModel:
    """Dictionaries of bad (0) and good (1) text and the calibration of their difference."""

    def __init__(self, bad: bytes, good: bytes, calibration: Logistic | None = None):
        self.dictionaries, self.calibration = (bad, good), calibration
        self._ready = None

    def __getstate__(self):
        return self.dictionaries, self.calibration

    def __setstate__(self, state):
        self.dictionaries, self.calibration = state
        self._ready = None

    def _compressors(self):
        if self._ready is None:
            self._ready = []
            for raw in self.dictionaries:
                held = zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None
                if held is not None:
                    held.precompute_compress(level=LEVEL)
                self._ready.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL,
                        dict_data=held,
                        write_content_size=False,
                        write_checksum=False,
                        write_dict_id=False,
                    )
                )
        return self._ready

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Normalised difference of the compressed sizes, log of their sum over the size, log of the size."""
        parts = chunks(text)
        if not parts:
            return 0.0, 0.0, 0.0
        bad, good = (sum(len(c.compress(p)) for p in parts) for c in self._compressors())
        size = sum(map(len, parts))
        return (bad - good) / size, float(np.log((bad + good) / size)), float(np.log(min(size, CHUNK)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        out = self.calibration.predict(np.array([self.features(t) for t in texts]))
        out[[not t for t in texts]] = 0.0
        return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_chunks: int = SAMPLE_CHUNKS,
) -> CompressionModel:
    """Half of the sampled rows give chunks to the dictionaries, the other half calibrate."""
    rows = materialise(labelled_rows(docs, labels, label, sample_rows, doc_id=doc_id, text=text))
    half = F.pmod(F.xxhash64(F.lit("half"), "key"), F.lit(2))

    def cut(batches):
        for batch in tokens.small(batches):
            pairs = zip(batch["text"].to_pylist(), batch["y"].to_pylist(), strict=True)
            cuts = [(y, zlib.crc32(c), c) for t, y in pairs for c in chunks(t)]
            columns = zip(*cuts, strict=True) if cuts else ((), (), ())
            types = (pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["y", "h", "chunk"]
            )

    pieces = rows.where(half == 0).mapInArrow(cut, "y int, h bigint, chunk binary")
    built = []
    for value in (0, 1):
        own = pieces.where(F.col("y") == value).orderBy("h", "chunk").limit(sample_chunks).collect()
        built.append(build_dictionary([bytes(r.chunk) for r in own]))
    model = CompressionModel(*built)

    def measure(batches):
        for batch in tokens.small(batches):
            found = np.array([model.features(t) for t in batch["text"].to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(found[:, i]) for i in range(3)), batch["y"]], names=["d", "r", "n", "y"]
            )

    other = rows.where(half == 1).select("text", "y")
    seen = sorted(other.mapInArrow(measure, "d double, r double, n double, y int").collect())
    x = np.array([(r.d, r.r, r.n) for r in seen]).reshape(-1, 3)
    model.calibration = Logistic(x, np.array([r.y for r in seen], float))
    return model


def score(docs: DataFrame, model: CompressionModel, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality in column ``name`` (in place of one so named)."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in tokens.small(batches):
            yield batch.append_column(name, pa.array(model.scores(batch[text].to_pylist())))

    return docs.mapInArrow(run, schema)


def keep_good(
    docs: DataFrame, model: CompressionModel, *, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that score at least ``threshold``, with their columns; only the verdict comes from Python."""

    @F.arrow_udf("boolean")
    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tokens.each(texts, lambda some: pa.array(model.scores(some) >= threshold))

    return docs.where(good(F.col(text)))
