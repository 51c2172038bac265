"""Group spelling variants: words one edit apart, each with its more frequent form.

Words come from whole texts (``count_words``) and are counted over all documents.
Two words are near if one inserted, deleted or replaced code point makes one of
the other. A word's form is its most frequent near word, if that is at least twice
as frequent; its root is where the forms of forms end. Frequencies at least double
along the way, so a chain has at most log2 of the largest count steps.

Near words are found by Bloom-guided neighbourhoods. The vocabulary has one blocked
Bloom filter for each word length. Every word's edits are generated as 64-bit
rolling hashes and probed against the filter of their length; only positives are
shuffled, to a join with the vocabulary by hash, and the edit is then carried out
and compared as text, so neither a false positive nor a collision is left.
Nearness is symmetric: deletions find all insertions, and of two words that differ
in one letter, the one with the lesser letter generates the other.

Bounds: a join key has at most (length + 1) * letters rows whatever the data. A
broadcast has at most ``FILTER_BYTES``; lengths beyond it go to further passes, and
a length that is larger on its own is split by hash. Letters are those that the
vocabulary has.

Null and empty texts have no words, a null id counts as an empty one, and repeated
rows count again. An empty table gives no rows. Words of any length are followed;
candidates are fixed-width rows, never texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tokens import code_points, mix, small
from tideline.session import materialise

RUN = r"[a-zÀ-ÿ]+"
SLIP = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 100_000
#: Bits of filter for each word; one word of 64 bits is read per probe, another one for each hit.
BITS_PER_WORD = 16
BLOCK = 8
FILTER_BYTES = 32 << 20
#: Words of a filter that one task sets bits for.
SEGMENT_WORDS = 1 << 14
PROBES_AT_ONCE = 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SECOND = np.uint64(0xD6E8FEB86659FD93)


# --- vocabulary ------------------------------------------------------------------


def slipped(key: str, words: Iterable[str], slip: int) -> Iterator[str]:
    """The words of one document; where ``slip`` divides the checksum, one letter is left out."""
    prefix, seen = zlib.crc32(key.encode() + b":"), {}
    for word in words:
        if word not in seen:
            h = zlib.crc32(word.encode(), prefix)
            at = h % len(word)
            seen[word] = word[:at] + word[at + 1 :] if h % slip == 0 else word
        yield seen[word]


def _counter(slip: int) -> Callable:
    find = re.compile(RUN).findall

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return out

        for batch in small(batches):
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                lowered = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
                for word in slipped(key.as_py() or "", find(lowered), slip):
                    held[word] = held.get(word, 0) + 1
                if len(held) > HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    return count


def count_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", slip: int = SLIP) -> DataFrame:
    """``word, n`` over all documents: runs of letters, only A-Z lower-cased, with the planted slips."""
    rows = docs.select(F.col(doc_id).cast("string").alias("key"), F.col(text).alias("text")).where("text is not null")
    counted = rows.mapInArrow(_counter(slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- hashes of words and of their edits ------------------------------------------


def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their code points as a matrix."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        points = code_points("".join(words[i] for i in at.tolist()))
        yield at, points.reshape(len(at), length)


def _sums(points: np.ndarray) -> np.ndarray:
    """Raw rolling hash of every prefix of every word."""
    m, length = points.shape
    out = np.zeros((m, length + 1), np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(length), axis=1, out=out[:, 1:])
    return out


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for at, points in _by_length(words):
        out[at] = mix(_sums(points)[:, -1])
    return out


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 4096):
        words = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([len(w) for w in words], pa.int32()),
                pa.array(word_hashes(words).view(np.int64)),
            ],
            names=["word", "n", "length", "h"],
        )


# --- blocked Bloom filters, one a length -----------------------------------------


class Filter:
    """One slice of the filter of one length: blocks of eight 64-bit words, three bits in each half."""

    def __init__(self, blocks: int, part: int, parts: int):
        self.blocks, self.part, self.parts = blocks, part, parts
        self.bits = np.zeros(blocks * BLOCK, np.uint64)

    @staticmethod
    def _mask(h: np.ndarray, shift: int) -> np.ndarray:
        one, low = np.uint64(1), np.uint64(63)
        mask = one << ((h >> np.uint64(shift)) & low)
        mask |= one << ((h >> np.uint64(shift + 6)) & low)
        return mask | (one << ((h >> np.uint64(shift + 12)) & low))

    def _words(self, h: np.ndarray) -> np.ndarray:
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks)) >> np.uint64(32)
        return (block * np.uint64(BLOCK)).astype(np.int64)

    @staticmethod
    def _lanes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (h & np.uint64(3)).astype(np.int64), ((h >> np.uint64(2)) & np.uint64(3)).astype(np.int64) + 4

    def bits_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of 64-bit words, and the bits to set there."""
        at, (first, second) = self._words(h), self._lanes(h)
        return np.concatenate([at + first, at + second]), np.concatenate([self._mask(h, 4), self._mask(h * _SECOND, 40)])

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` that may be words."""
        at, (first, second) = self._words(h), self._lanes(h)
        mask = self._mask(h, 4)
        found = np.flatnonzero((self.bits[at + first] & mask) == mask)
        mask = self._mask(h[found] * _SECOND, 40)
        found = found[(self.bits[at[found] + second[found]] & mask) == mask]
        if self.parts > 1:
            found = found[part_of(h[found], self.parts) == self.part]
        return found


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h * _SECOND) >> np.uint64(33)).astype(np.int64) % parts


def blocks_for(words: int) -> int:
    return max(1, -(-words * BITS_PER_WORD // (64 * BLOCK)))


def passes(counts: dict[int, int], budget: int) -> list[list[tuple[int, int, int]]]:
    """Lists of (length, part, parts) whose filters fit ``budget`` bytes together."""
    out, held = [[]], 0
    for length in sorted(counts):
        size = blocks_for(counts[length]) * BLOCK * 8
        parts = -(-size // budget)
        for part in range(parts):
            share = size // parts
            if out[-1] and held + share > budget:
                out.append([])
                held = 0
            out[-1].append((length, part, parts))
            held += share
    return [p for p in out if p]


def build_filters(words: DataFrame, chosen: list[tuple[int, int, int]], counts: dict[int, int]) -> dict:
    """Filters of the chosen lengths and parts; each task makes some stretches, the driver puts them together."""
    made = {(length, part): Filter(blocks_for(-(-counts[length] // parts)), part, parts) for length, part, parts in chosen}
    sizes = {length: (f.blocks, f.parts) for (length, _), f in made.items()}
    wanted = set(made)

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            lengths = batch.column(0).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                blocks, parts = sizes[length]
                own = h[lengths == length]
                part = part_of(own, parts)
                for p in np.unique(part).tolist():
                    if (length, p) not in wanted:
                        continue
                    at, mask = Filter.bits_of(made_like(blocks), own[part == p])
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, length, np.int32)),
                            pa.array(np.full(n, p, np.int32)),
                            pa.array((at // SEGMENT_WORDS).astype(np.int32)),
                            pa.array((at % SEGMENT_WORDS).astype(np.int32)),
                            pa.array(mask.view(np.int64)),
                        ],
                        names=["length", "part", "segment", "at", "mask"],
                    )

    def stretch(table: pa.Table) -> pa.Table:
        held = np.zeros(SEGMENT_WORDS, np.uint64)
        np.bitwise_or.at(held, table.column("at").to_numpy(), table.column("mask").to_numpy().view(np.uint64))
        first = {k: table.column(k)[:1] for k in ("length", "part", "segment")}
        used = int(table.column("at").to_numpy().max()) + 1
        return pa.table(first | {"bits": pa.array([held[:used].tobytes()], pa.binary())})

    narrow = words.where(F.col("length").isin([length for length, _ in made])).select("length", "h")
    set_bits = narrow.mapInArrow(bits, "length int, part int, segment int, at int, mask long")
    stretches = set_bits.groupBy("length", "part", "segment").applyInArrow(
        stretch, "length int, part int, segment int, bits binary"
    )
    for r in stretches.toLocalIterator():
        got = np.frombuffer(bytes(r.bits), np.uint64)
        made[r.length, r.part].bits[r.segment * SEGMENT_WORDS :][: len(got)] = got
    return made


def made_like(blocks: int) -> Filter:
    out = Filter.__new__(Filter)
    out.blocks = blocks
    return out


# --- probing ---------------------------------------------------------------------


def edits(points: np.ndarray, letters: np.ndarray, replace: bool, delete: bool) -> Iterator[tuple]:
    """``hashes, row, place, letter`` of edits of words of one length, some at a time.

    ``letter`` is a place in ``letters`` (ascending, greater than the one it stands
    for), or -1 for a deletion; of a run of equal letters only the last is deleted.
    """
    m, length = points.shape
    sums, powers = _sums(points), _powers(length)
    step = max(1, PROBES_AT_ONCE // (len(letters) + 1))
    for lo in range(0, m * length, step):
        row, place = np.divmod(np.arange(lo, min(lo + step, m * length)), length)
        own = points[row, place]
        if delete:
            last = np.ones(len(row), bool)
            inner = place < length - 1
            last[inner] = points[row[inner], place[inner] + 1] != own[inner]
            r, p = row[last], place[last]
            raw = sums[r, p] + (sums[r, -1] - sums[r, p + 1]) * _INVERSE
            yield mix(raw), r, p, np.full(len(r), -1)
        if replace:
            base = sums[row, -1] - (own.astype(np.uint64) + np.uint64(1)) * powers[place]
            pick, letter = np.nonzero(letters[None, :] > own[:, None])
            raw = base[pick] + (letters[letter].astype(np.uint64) + np.uint64(1)) * powers[place[pick]]
            yield mix(raw), row[pick], place[pick], letter


_CANDIDATE = "h long, near_h long, place int, letter string"


def _prober(filters, letters: np.ndarray) -> Callable:
    named = [chr(c) for c in letters.tolist()] + [""]

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Filter]] = {}
        for (length, _), f in filters.value.items():
            held.setdefault(length, []).append(f)
        names = pa.array(named, pa.string())
        for batch in small(batches, 4096):
            own = batch.column(1).to_numpy(zero_copy_only=False)
            for at, points in _by_length(batch.column(0).to_pylist()):
                length = points.shape[1]
                for hashes, row, place, letter in edits(points, letters, length in held, length - 1 in held):
                    shorter = len(letter) > 0 and letter[0] < 0
                    for f in held[length - 1 if shorter else length]:
                        hit = f.hits(hashes)
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(own[at[row[hit]]]),
                                    pa.array(hashes[hit].view(np.int64)),
                                    pa.array(place[hit].astype(np.int32)),
                                    names.take(pa.array(letter[hit] % len(named))),
                                ],
                                names=["h", "near_h", "place", "letter"],
                            )

    return probe


def near_pairs(words: DataFrame, budget: int = FILTER_BYTES) -> DataFrame:
    """``word, n, near, near_n``: every two near words once. ``words``: word, n, length, h, at rest."""
    spark = words.sparkSession
    counts = {r.length: r["count"] for r in words.groupBy("length").count().collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()
    points = np.array(sorted(ord(r.c) for r in letters), np.uint32)
    found = []
    for chosen in passes(counts, budget):
        filters = spark.sparkContext.broadcast(build_filters(words, chosen, counts))
        lengths = {length for length, _, _ in chosen}
        own = words.where(F.col("length").isin(sorted(lengths | {n + 1 for n in lengths})))
        found.append(own.select("word", "h").mapInArrow(_prober(filters, points), _CANDIDATE))
    if not found:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).where(F.lit(False))
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    near = words.select(F.col("h").alias("near_h"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    known = candidates.join(near, "near_h").join(words.select("h", "word", "n"), "h")
    # the edit carried out: a letter replaced, or none in its place
    before = F.substring("word", F.lit(1), F.col("place"))
    after = F.substring("word", F.col("place") + 2, F.length("word"))
    return known.where(F.concat(before, "letter", after) == F.col("near")).select("word", "n", "near", "near_n")


# --- forms and roots -------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word that has a form; ``forms``: word, form, both not null, without cycles.

    Each round doubles the stretch that is followed. Words whose chain has ended
    take no further part, so no join key collects the words of a popular root.
    """
    chains = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not chains.where("open").isEmpty():
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("open").alias("more"))
        moved = chains.where("open").join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.coalesce("more", F.lit(False)).alias("open"))
        chains = materialise(moved.unionByName(chains.where(~F.col("open"))))
    return chains.select("word", "root")


def group_variants(
    counted: DataFrame,
    *,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word long and frequent enough. ``counted``: word, n."""
    kept = counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))
    words = materialise(kept.select("word", "n").mapInArrow(_hashed, "word string, n long, length int, h long"))
    pairs = near_pairs(words, filter_bytes)
    both = F.array(
        F.struct(F.col("word"), F.col("near").alias("other"), F.col("near_n").alias("m")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("m")),
    )
    sides = pairs.select(F.inline(both))
    best = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other"))).alias("best")
    )
    joined = words.select("word", "n").join(best, "word", "left")
    enough = -F.col("best.m") >= ratio * F.col("n")
    formed = materialise(
        joined.select(
            "word",
            F.when(enough, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.m")).alias("form_n"),
        )
    )
    ends = roots(formed.where("form is not null").select("word", "form"))
    out = formed.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
