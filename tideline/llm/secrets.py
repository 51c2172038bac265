"""Secret scans: known forms, and a battery of randomness tests for the rest.

Known forms (``assign``, ``access``, ``hex``) are patterns, leftmost and not
overlapping within a kind. Other runs of ``LEAST`` or more characters of the usual
encodings are candidates. The narrowest encoding that has all characters of a run
is inferred, and three tests ask whether its characters are a random sample of
that alphabet: chi-squared for uniformity over cells of the alphabet, runs above
and below its middle, and serial correlation; Fisher's method combines them. Letters
of one case have an alphabet of 26, in an order in which language shows: vowels and
rare consonants in one half, frequent consonants in the other.

How often language passes is counted over all texts: the words of each text, one
after another, are cut into stretches as long as the least run of each length class,
and every stretch takes the same tests, as letters of one case and as words with
separators between them. A candidate's p-value is the share of stretches of its class and kind that look
at least as random. To the counts of every table those of a fixed text are added, made of
stop words (``PRIOR_TEXTS``), which speak where a table has hardly any language of its own.
Within each kind and length class Benjamini-Hochberg keeps the share of natural
runs among the reported ones at ``RATE`` at most. Both counts are sums over a fixed
grid (kind by length class by degree of randomness), so only that grid reaches the
driver, and one rule holds for tables of all sizes.

Offsets are code points, ends exclusive. Null and empty texts have no span. A run
that overlaps known forms is cut at them, and each piece of ``LEAST`` or more
characters is a candidate, without the separators at the cut.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.llm import tokens
from tideline.llm.html_text import STOP_WORDS

KINDS = ("assign", "access", "hex", "random")
#: The known forms, and the least length of what must match.
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

LEAST, RATE = 20, 0.01
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_LETTERS = re.compile(r"[A-Za-z]+")
SEPARATORS = "+/_=-"
#: Least lengths of the classes; natural stretches of a class have just this length.
LENGTH_CLASSES = (20, 24, 32, 48)
DEGREES = 64
#: Texts of stop words, and words of each, whose counts are added to those of any table.
PRIOR_TEXTS, PRIOR_WORDS = 400, 250
#: Stretches that are tested at once.
STRETCHES = 20_000
#: Kinds of candidates: letters of one case, anything else.
ONE_CASE, MIXED = 0, 1

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Vowels and rare consonants, then the frequent ones.
LETTER_ORDER = "aeiouyjqxzwvk" "tnshrdlcmfgpb"
#: Narrowest first.
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + _LOWER[:6],
    "HEX": _DIGITS + _UPPER[:6],
    "letters": LETTER_ORDER,
    "LETTERS": LETTER_ORDER.upper(),
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_=",
}
_SETS = {name: frozenset(a) for name, a in ENCODINGS.items()}


def infer_encoding(token: str) -> str:
    """The narrowest encoding with all characters of the token (padding at the end left out)."""
    seen = set(token.rstrip("=")) or {"="}
    return next(name for name, alphabet in _SETS.items() if seen <= alphabet)


def _erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function to seven digits of its value, also far out (Chebyshev fit)."""
    z = np.abs(x)
    t = 1 / (1 + 0.5 * z)
    fit = np.full_like(z, _ERFC[-1])
    for c in _ERFC[-2::-1]:
        fit = fit * t + c
    tail = t * np.exp(-z * z + fit)
    return np.where(x >= 0, tail, 2 - tail)


#: Coefficients of the fit.
_ERFC = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def _upper_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2))


@cache
def _cells(k: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the cells of an alphabet of k, of whole characters, and the cell of each character."""
    edges = np.arange(cells + 1) * k // cells
    return np.diff(edges), np.repeat(np.arange(cells, dtype=np.int8), np.diff(edges))


@cache
def _rank_table(name: str) -> np.ndarray:
    """Place in the alphabet of each ASCII character; -1 for those not in it."""
    table = np.full(128, -1, np.int8)
    for i, c in enumerate(ENCODINGS[name]):
        table[ord(c)] = i
    return table


def randomness_of(ranks: np.ndarray, k: int) -> np.ndarray:
    """Fisher's combination of the three tests for each row of places in an alphabet of ``k``.

    Small for structured rows, uniform for random ones; 0 for rows of less than 8 places.
    """
    m, n = ranks.shape
    if n < 8:
        return np.zeros(m)
    cells = max(2, min(k, n // 5))
    sizes, cell_of = _cells(k, cells)
    place = cell_of[ranks]
    expected = n * sizes / k
    at = place + np.arange(m, dtype=np.int32)[:, None] * np.int32(cells)
    seen = np.bincount(at.ravel(), minlength=m * cells).reshape(m, cells)
    chi = ((seen - expected) ** 2 / expected).sum(1)
    free = cells - 1
    spread = 2 / (9 * free)
    uniform = _upper_tail((np.cbrt(chi / free) - 1 + spread) / math.sqrt(spread))

    high = ranks >= k / 2
    a = high.sum(1)
    b = n - a
    mean = 1 + 2 * a * b / n
    variance = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    count = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    runs = 2 * _upper_tail(np.maximum(np.abs(count - mean) - 0.5, 0) / np.sqrt(variance))
    runs = np.where((a == 0) | (b == 0), 2.0 ** (1 - min(n, 1000)), runs)

    x = ranks - ranks.mean(1, keepdims=True)
    total = np.einsum("ij,ij->i", x, x)
    r1 = np.einsum("ij,ij->i", x[:, 1:], x[:, :-1]) / np.where(total > 0, total, 1)
    serial = np.where(total > 0, 2 * _upper_tail(np.abs(r1 + 1 / n) * math.sqrt(n)), 0.0)

    half = -sum(np.log(np.clip(p, 1e-30, 1.0)) for p in (uniform, runs, serial))
    return np.exp(-half) * (1 + half + half * half / 2)


def randomness(token: str) -> float:
    """As ``randomness_of``, of the token in its inferred encoding."""
    name = infer_encoding(token)
    ranks = _rank_table(name)[np.frombuffer(token.rstrip("=").encode(), np.uint8)]
    return float(randomness_of(ranks[ranks >= 0][None, :], len(ENCODINGS[name]))[0])


def _degrees(p: np.ndarray) -> np.ndarray:
    """0 for the most random; a quarter of a decade each."""
    return np.minimum(DEGREES - 1, (-4 * np.log10(np.clip(p, 1e-30, 1.0))).astype(np.int64))


def _length_class(n: int) -> int:
    return sum(n >= b for b in LENGTH_CLASSES) - 1


def natural_degrees(texts: list[str | None]) -> np.ndarray:
    """Counts by kind, class and degree of the stretches of language of each text.

    Candidates are left out. Of one case are its letters, one word after another; mixed
    are its words with a separator between them, as paths and names have it.
    """
    grid = np.zeros((2, len(LENGTH_CLASSES), DEGREES), np.int64)
    words = [_LETTERS.findall(_CANDIDATE.sub(" ", t)) if t else [] for t in texts]
    for kind, name in ((ONE_CASE, "letters"), (MIXED, "any")):
        if kind == ONE_CASE:
            streams = ["".join(own).lower() for own in words]
        else:
            between = ("/", "_", "-")
            streams = ["".join(w + between[i % 3] for i, w in enumerate(own)) for own in words]
        sizes = np.array([len(s) for s in streams], np.int64)
        ranks = _rank_table(name)[np.frombuffer("".join(streams).encode(), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        for c, n in enumerate(LENGTH_CLASSES):
            count = sizes // n
            number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            first = np.repeat(starts, count) + n * number
            for lo in range(0, len(first), STRETCHES):
                rows = ranks[first[lo : lo + STRETCHES, None] + np.arange(n)]
                degrees = _degrees(randomness_of(rows, len(ENCODINGS[name])))
                grid[kind, c] += np.bincount(degrees, minlength=DEGREES)
    return grid


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, in order."""
    out = []
    if ":" in text or "=" in text:
        found = ASSIGN.finditer(text)
        out += [(m.start(), 0, m.end()) for m in found if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _pieces(text: str, start: int, end: int, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a run between the known forms, without separators next to them if enough stays."""
    at, cut = start, False
    for s, e, after in [*((s, e, True) for s, _, e in known if s < end and start < e), (end, end, False)]:
        if s - at >= LEAST:
            lo, hi = at, s
            while cut and lo < hi and text[lo] in SEPARATORS:
                lo += 1
            while after and lo < hi and text[hi - 1] in SEPARATORS:
                hi -= 1
            yield (lo, hi) if hi - lo >= LEAST else (at, s)
        at, cut = max(at, e), cut or after


def candidates(text: str, known: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int, int, int]]:
    """(start, end, kind, length class, degree) of the runs to test."""
    out = []
    for m in _CANDIDATE.finditer(text):
        known = known_spans(text) if known is None else known
        for start, end in _pieces(text, *m.span(), known):
            token = text[start:end]
            if token[:1].isupper() and token[1:].islower() and token.isalpha():
                token = token.lower()  # a capital at the beginning is no other case
            kind = ONE_CASE if token.isalpha() and (token.islower() or token.isupper()) else MIXED
            degree = int(_degrees(np.array([randomness(token)]))[0])
            out.append((start, end, kind, _length_class(end - start), degree))
    return out


@cache
def prior() -> np.ndarray:
    """The counts of the fixed text."""
    words = sorted(w for w in STOP_WORDS if w.isascii())
    drawn = ((zlib.crc32(f"{i} {j}".encode()) for j in range(PRIOR_WORDS)) for i in range(PRIOR_TEXTS))
    return natural_degrees([" ".join(words[h % len(words)] for h in text) for text in drawn])


def thresholds(natural: np.ndarray, found: np.ndarray, rate: float = RATE) -> list[list[int]]:
    """Largest degree reported for each kind and length class; -1 for none. Both are counts by kind, class and degree."""
    natural, out = natural + prior(), []
    for kind in range(2):
        out.append([])
        for c in range(len(LENGTH_CLASSES)):
            p = (1 + np.cumsum(natural[kind, c])) / (1 + natural[kind, c].sum())
            passed = np.cumsum(found[kind, c])
            good = np.flatnonzero((found[kind, c] > 0) & (p * passed[-1] <= rate * passed)) if passed[-1] else []
            out[kind].append(int(good[-1]) if len(good) else -1)
    return out


def fit(docs: DataFrame, *, text: str = "text", rate: float = RATE) -> list[list[int]]:
    """Thresholds from the counts of natural stretches and candidates over all texts."""
    shape = (2, 2, len(LENGTH_CLASSES), DEGREES)

    def count(batches):
        grid = np.zeros(shape, np.int64)
        for batch in tokens.small(batches):
            texts = batch["text"].to_pylist()
            for lo, hi in tokens.slices(texts):
                grid[0] += natural_degrees(texts[lo:hi])
            for t in texts:
                for _, _, kind, c, d in candidates(t) if t else ():
                    grid[1, kind, c, d] += 1
        at = np.nonzero(grid)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(i.astype(np.int32)) for i in at), pa.array(grid[at])],
            names=["what", "kind", "class", "degree", "n"],
        )

    grid = np.zeros(shape, np.int64)
    parts = docs.select(F.col(text).alias("text")).mapInArrow(
        count, "what int, kind int, class int, degree int, n bigint"
    )
    for row in parts.groupBy("what", "kind", "class", "degree").agg(F.sum("n").alias("n")).collect():
        grid[row["what"], row["kind"], row["class"], row["degree"]] = row["n"]
    return thresholds(grid[0], grid[1], rate)


def spans(text: str | None, limits: list[list[int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in order."""
    if not text:
        return []
    known = known_spans(text)
    added = [(s, 3, e) for s, e, kind, c, d in candidates(text, known) if d <= limits[kind][c]]
    return sorted(known + added) if added else known


def find(docs: DataFrame, limits: list[list[int]], *, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``, an array of (kind, start, end) by start, then kind as in ``KINDS``."""
    docs = docs.drop("secrets")
    added = T._parse_datatype_string("secrets array<struct<kind: string, start: bigint, end: bigint>>")
    schema = T.StructType([*docs.schema.fields, *added.fields])
    field = to_arrow_schema(added).field(0)

    def run(batches):
        for batch in tokens.small(batches):
            found = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t, limits)]
                for t in batch[text].to_pylist()
            ]
            yield batch.append_column(field, pa.array(found, field.type))

    return docs.mapInArrow(run, schema)


def redact(
    docs: DataFrame, limits: list[list[int]], *, text: str = "text", n_chars: str | None = "n_chars", mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with each stretch of spans replaced by ``mark``; ``n_chars`` follows the new text.

    Only the value of an assignment is replaced, not its name. Without a column
    ``n_chars`` none is set.
    """

    def clean(t: str | None) -> str | None:
        """The new text, or None if the old one stays."""
        found = spans(t, limits)
        if not found:
            return None
        cuts: list[list[int]] = []
        for start, kind, end in found:
            if kind == 0:
                start = ASSIGN.match(t, start).start(2)
            cuts.append([start, end])
        cuts.sort()
        merged = cuts[:1]
        for start, end in cuts[1:]:
            if start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        out, at = [], 0
        for start, end in merged:
            out += [t[at:start], mark]
            at = end
        return "".join([*out, t[at:]])

    @F.arrow_udf("string")
    def cleaned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tokens.each(texts, lambda some: pa.array([clean(t) for t in some], pa.string()))

    new = tokens.unused("new", docs.columns)
    changed = docs.withColumn(new, cleaned(F.col(text)))
    columns = {text: F.coalesce(new, text)}
    if n_chars in docs.columns:
        size = F.length(new).cast(docs.schema[n_chars].dataType)
        columns[n_chars] = F.when(F.col(new).isNotNull(), size).otherwise(F.col(n_chars))
    return changed.withColumns(columns).drop(new)
