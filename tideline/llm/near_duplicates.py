"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is the multiset of its five-word shingles: a weighted set with counts
as weights. Darts are thrown by hash into the plane weight x rank of every
element, region by region in rising rank; a dart below the element's weight
belongs to the document and falls on one of ``k`` coordinates, where the earliest
stays. Two documents agree on a coordinate with the probability of their weighted
Jaccard similarity, and a signature takes about k ln k darts whatever its length.

Classes are the connected components of the links of weighted Jaccard similarity
``SIMILARITY`` or more:

1. Texts with equal multisets are one vertex (a 128-bit key), so copies cost one
   row after a partial aggregation.
2. Signatures are cut into bands; vertices that share a band share a bucket.
3. Every member of a bucket is compared with one vertex of it, the one that meets
   most others over all buckets: for a group of near copies, however large, that
   is one comparison a member, mostly with the text they were made from.
4. Where the others in a bucket are then in several components, the vertices
   outside its largest one (strays) look for similar vertices of other components
   by their rarest members (``_stray_pairs``), which finds every one.

No link that would join two classes is left out between vertices that share a
bucket. All comparisons are exact, on the shingles themselves. At similarity 0.8
a pair shares none of the 36 bands of 6 rows with probability 2e-5.

Whole texts are shuffled only where they are candidates, or to be dropped: a
filter of at most ``FILTER_BITS`` bits lets the others stay where they are.

Null and blank texts are in no class with others: their class is their own id.
Documents of fewer than five words have one shingle of all words. In a text without
a letter or digit (emoji, rules), what stands between white space is a word.
A class has the least id of its members (null only if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.llm import tokens
from tideline.session import materialise

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 36, 6
FILTER_BITS, BITS_PER_ID = 1 << 25, 10
#: Shares into which the pairs of one vertex are dealt for verification.
SALTS = 64
#: Ratio of sizes within a class of sizes.
STEP = 1.04
#: Rank of the first region's end; each later region doubles it.
FIRST_RANK = 0.25


@cache
def _poisson(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... darts in a region."""
    n = np.arange(int(area + 12 * np.sqrt(area) + 40))
    steps = np.concatenate(([0.0], np.log(area) - np.log(n[1:])))
    return np.cumsum(np.exp(np.cumsum(steps) - area))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


@cache
def _seed(*parts: int) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = tokens.mix(h + np.uint64(p + 0x9E37))
    return h[0]


def signatures(
    elements: np.ndarray, weights: np.ndarray, bounds: np.ndarray, k: int = BANDS * ROWS
) -> np.ndarray:
    """(texts, k) earliest darts of weighted sets; zeros for an empty set."""
    n = len(bounds) - 1
    out = np.zeros(n * k, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    left = np.diff(bounds) > 0
    filled = np.zeros(n * k, bool)
    level = 0
    while left.any():
        low, high = (FIRST_RANK * 2.0 ** (level - 1), FIRST_RANK * 2.0**level) if level else (0.0, FIRST_RANK)
        active = np.flatnonzero(left[owner])
        tier = 0
        keys, ranks, darts = [], [], []
        while len(active):
            light, heavy = (2.0 ** (tier - 1), 2.0**tier) if tier else (0.0, 1.0)
            region = tokens.mix(elements[active] ^ _seed(level, tier))
            count = np.searchsorted(_poisson((heavy - light) * (high - low)), _unit(region), side="right")
            who = np.repeat(active, count)
            number = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            dart = tokens.mix(np.repeat(region, count) + (number + 1).astype(np.uint64))
            place = tokens.mix(dart)
            inside = np.flatnonzero(light + (heavy - light) * _unit(place) < weights[who])
            dart, who = dart[inside], who[inside]
            keys.append(owner[who] * k + ((dart >> np.uint64(32)) % np.uint64(k)).astype(np.int64))
            ranks.append(low + (high - low) * _unit(tokens.mix(place[inside])))
            darts.append(dart)
            active = active[weights[active] > heavy]
            tier += 1
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(darts)
        new = np.flatnonzero(~filled[key])
        order = new[np.argsort(-rank[new])]
        out[key[order]] = dart[order]  # the last, so the earliest dart, stays
        filled[key[order]] = True
        left &= ~filled.reshape(n, k).all(axis=1)
        level += 1
    return out.reshape(n, k)


def counted(shingled: np.ndarray, bounds: np.ndarray):
    """Distinct shingles of each text with their counts, and bounds by text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((shingled, owner))
    h, o = shingled[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])))[: len(h)])
    weights = np.diff(np.append(first, len(h)))
    return h[first], weights, np.searchsorted(o[first], np.arange(len(bounds)))


def vertex_keys(shingled: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit key of each text's multiset of shingles; None for an empty one."""
    sums = []
    for seed in (1, 2):
        total = np.zeros(len(shingled) + 1, np.uint64)
        np.cumsum(tokens.mix(shingled ^ _seed(seed)), out=total[1:])
        sums.append(tokens.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    both = np.stack(sums, axis=1)
    return [both[i].tobytes() if n else None for i, n in enumerate(np.diff(bounds).tolist())]


def bands(signs: np.ndarray) -> np.ndarray:
    """(texts, BANDS) bucket keys."""
    out = np.empty((len(signs), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(signs), _seed(b, 99), np.uint64)
        for r in range(ROWS):
            h = tokens.mix(h ^ signs[:, b * ROWS + r]) + np.uint64(r)
        out[:, b] = h
    return out.view(np.int64)


def occurrences(elements: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Each text's multiset as a set: the n-th occurrence of a shingle is a member of its own."""
    number = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    members = tokens.mix(np.repeat(elements, weights) + number.astype(np.uint64)).view(np.int64)
    ends = np.concatenate(([0], np.cumsum(weights)))[bounds]
    return [members[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """As ``tokens.words``; a text without a word has its runs between white space as words."""
    hashes, bounds = tokens.words(texts)
    count = np.diff(bounds)
    at, own = [], []
    for i in np.flatnonzero(count == 0).tolist():
        for run in (texts[i] or "").lower().split():
            at.append(bounds[i])
            own.append(int.from_bytes(blake2b(run.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
            count[i] += 1
    if not own:
        return hashes, bounds
    return np.insert(hashes, at, np.array(own, np.uint64)), np.concatenate(([0], np.cumsum(count)))


def _each_slice(texts: list[str | None]):
    for lo, hi in tokens.slices(texts):
        yield lo, hi, *tokens.text_shingles(*_words(texts[lo:hi]), SHINGLE)


def _sketch(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, vertex and bucket keys of every document."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("v", T.BinaryType()),
            T.StructField("buckets", T.ArrayType(T.LongType(), False)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def sketch(batches):
        for batch in tokens.small(batches):
            texts = batch["text"].to_pylist()
            for lo, hi, shingled, bounds in _each_slice(texts):
                own = bands(signatures(*counted(shingled, bounds)))
                offsets = np.arange(0, own.size + 1, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo),
                        pa.array(vertex_keys(shingled, bounds), pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(own.ravel()), type=arrow.field(2).type),
                    ],
                    schema=arrow,
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(sketch, schema)


class _Ids:
    """A Bloom filter of ids: most rows without a wanted id need not be shuffled to find that out.

    It is a table of 64-bit words, at most ``FILTER_BITS`` bits in all whatever the
    number of ids, so it can be broadcast; each id has one word and three bits in it.
    More ids than fit let more rows pass, and the join after it tells those apart.
    """

    def __init__(self, ids: DataFrame):
        wanted = (ids.count() * BITS_PER_ID // 64).bit_length()
        self.size = 1 << min((FILTER_BITS >> 6).bit_length() - 1, wanted)
        own = F.col(ids.columns[0])
        words = ids.select(self._word(own).alias("at"), self._mask(own).alias("mask"))
        self.words = words.groupBy("at").agg(F.bit_or("mask").alias("bits"))

    def _word(self, doc_id):
        return F.pmod(F.xxhash64(F.lit(3), doc_id), F.lit(self.size))

    def _mask(self, doc_id):
        one = F.lit(1).cast("long")
        bits = [F.pmod(F.xxhash64(F.lit(i), doc_id), F.lit(64)).cast("int") for i in range(3)]
        first, second, third = (F.call_function("shiftleft", one, b) for b in bits)
        return first.bitwiseOR(second).bitwiseOR(third)

    def mark(self, rows: DataFrame, doc_id: str, name: str) -> DataFrame:
        """``rows`` with a column ``name``: whether the id may be held."""
        at, bits = (tokens.unused(c, (*rows.columns, name)) for c in ("at", "bits"))
        table = F.broadcast(self.words.select(F.col("at").alias(at), F.col("bits").alias(bits)))
        mask = self._mask(F.col(doc_id))
        found = rows.join(table, self._word(F.col(doc_id)) == F.col(at), "left")
        held = F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False))
        return found.withColumn(name, held).drop(at, bits)


def _members(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """v and its members (``occurrences``), for the vertices in ``wanted`` (v, doc_id)."""
    schema = "v binary, members array<bigint>"
    arrow = pa.schema([("v", pa.binary()), ("members", pa.list_(pa.int64()))])

    def expand(batches):
        for batch in tokens.small(batches):
            keys = batch["v"].to_pylist()
            for lo, _, shingled, bounds in _each_slice(batch["text"].to_pylist()):
                own = occurrences(*counted(shingled, bounds))
                same = vertex_keys(shingled, bounds)
                kept = [i for i, v in enumerate(same) if v == keys[lo + i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([same[i] for i in kept], pa.binary()),
                        pa.array([own[i] for i in kept], pa.list_(pa.int64())),
                    ],
                    schema=arrow,
                )

    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    source = _Ids(wanted.select("doc_id")).mark(source, "id", "held").where("held")
    joined = source.join(wanted, F.col("id").eqNullSafe(F.col("doc_id"))).select("v", "text")
    # repeated rows give the same members
    return joined.mapInArrow(expand, schema).dropDuplicates(["v"])


def _verified(pairs: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least this similarity.

    A vertex can be ``a`` of very many pairs. They are dealt into ``SALTS`` shares by
    their other vertex, and the members of ``a`` go once to each share that it has.
    """
    ma = members.select(F.col("v").alias("a"), F.col("members").alias("ma"))
    mb = members.select(F.col("v").alias("b"), F.col("members").alias("mb"))
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    shares = dealt.select("a", "salt").distinct().join(ma, "a")
    small, large = F.least(F.size("ma"), F.size("mb")), F.greatest(F.size("ma"), F.size("mb"))
    both = F.size(F.array_intersect("ma", "mb"))
    return (
        dealt.join(mb, "b")
        .join(shares, ["a", "salt"])
        .where(small >= similarity * large)
        .where(both >= similarity * (F.size("ma") + F.size("mb") - both))
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """v and c, the least vertex connected with it, for the vertices of ``edges`` (a, b).

    Alternating large-star and small-star steps; each step is one aggregation and
    one join, written to the shared folder.
    """
    edges = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    )
    digest = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = materialise(moved.unionByName(least.withColumnRenamed("m", "b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == digest:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("c")).unionByName(
                edges.select(F.col("b").alias("v"), F.col("b").alias("c")).distinct()
            )
        digest = now


def _links(docs, doc_id, text, vertices, similarity):
    """Verified links between vertices that connect all classes."""
    entries = vertices.select("v", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = materialise(entries.join(shared, "bucket"))
    # the vertex that meets most others stands in the middle of its group
    middle = entries.groupBy("v").agg(F.sum("n").alias("met"))
    entries = materialise(entries.join(middle, "v"))
    first = entries.groupBy("bucket").agg(F.max_by("v", F.struct("met", "v")).alias("first"))
    entries = materialise(entries.select("bucket", "v").join(first, "bucket"))
    pairs = entries.where("v != first").select(F.col("first").alias("a"), F.col("v").alias("b")).distinct()
    wanted = materialise(middle.join(vertices.select("v", "doc_id"), "v").select("v", "doc_id"))
    members = materialise(_members(docs, doc_id, text, wanted))
    edges = materialise(_verified(pairs, members, similarity))

    rest = entries.where("v != first").join(components(edges), "v", "left")
    rest = rest.select("bucket", "v", F.coalesce("c", "v").alias("c"))
    sizes = rest.groupBy("bucket", "c").agg(F.count("*").alias("size"))
    main = sizes.groupBy("bucket").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("n"))
    rest = rest.join(main.where("n > 1").drop("n"), "bucket")
    rest = materialise(rest.groupBy("v", "c").agg(F.max(F.col("c") != F.col("main")).alias("stray")))
    pairs = _stray_pairs(rest.join(members, "v"), similarity)
    return edges.unionByName(materialise(_verified(pairs, members, similarity)))


def _stray_pairs(rest: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a stray and a vertex of another component that can be similar enough.

    ``rest`` has v, its component c, whether it is a stray, and its members. If x
    and y are similar, they share ``need`` members or more, so in any one order of
    all members they share one among the first ``size - need + 1`` of each. With
    the rarest first, what only one text has fills the beginning of the list of a
    text that was changed much, and it meets no other. ``need`` follows from both
    sizes, so each stray looks into classes of sizes that differ by ``STEP``.
    """
    of = F.col("v"), F.col("c"), F.col("stray"), F.size("members").alias("size")
    held = rest.select(*of, F.explode("members").alias("member"))
    often = held.groupBy("member").agg(F.count("*").alias("often")).where("often > 1")
    alone = F.col("size") - F.count("*").over(Window.partitionBy("v"))
    order = F.row_number().over(Window.partitionBy("v").orderBy("often", "member"))
    least = 1 - similarity
    # members that no other vertex has come first, and are not listed
    listed = held.join(often, "member").withColumn("place", order + alone)
    listed = materialise(listed.where(F.col("place") <= F.floor(F.col("size") * least + 1e-9) + 1).drop("often"))

    def need(x, y):
        return F.ceil((x + y) * (similarity / (1 + similarity)) - 1e-9)

    def step(size):
        return F.floor(F.log(size) / F.log(F.lit(STEP)))

    x = listed.where("stray").select(
        F.col("v").alias("x"), F.col("c").alias("cx"), F.col("size").alias("nx"), F.col("place").alias("px"), "member"
    )
    reach = F.sequence(step(F.col("nx") * similarity) - 1, step(F.col("nx") / similarity) + 1)
    x = x.withColumn("step", F.explode(reach))
    smallest = F.greatest(F.pow(F.lit(STEP), F.col("step")) - 1, F.col("nx") * similarity)
    x = x.where(F.col("px") <= F.col("nx") - need(F.col("nx"), smallest) + 1)
    y = listed.select(
        F.col("v").alias("y"),
        F.col("c").alias("cy"),
        F.col("size").alias("ny"),
        F.col("place").alias("py"),
        "member",
        step(F.col("size")).alias("step"),
    )
    shared = need(F.col("nx"), F.col("ny"))
    return (
        x.join(y, ["member", "step"])
        .where("cx != cy")
        .where((F.col("px") <= F.col("nx") - shared + 1) & (F.col("py") <= F.col("ny") - shared + 1))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``doc_id, class_id`` and the vertex ``v``, a row for each document."""
    sketch = materialise(_sketch(docs, doc_id, text))
    vertices = materialise(
        sketch.where("v is not null").groupBy("v").agg(F.min("doc_id").alias("doc_id"), F.first("buckets").alias("buckets"))
    )
    edges = _links(docs, doc_id, text, vertices, similarity)
    labels = materialise(components(edges))
    named = vertices.select("v", "doc_id").join(labels, "v", "left").withColumn("c", F.coalesce("c", "v"))
    named = materialise(named.select("v", "c", "doc_id"))
    ids = named.groupBy("c").agg(F.min("doc_id").alias("class_id"))
    by_vertex = named.join(ids, "c").select("v", "class_id")
    own = sketch.select("doc_id", "v")
    return own.where("v is not null").join(by_vertex, "v", "left").select("doc_id", "class_id", "v").unionByName(
        own.where("v is null").select("doc_id", F.col("doc_id").alias("class_id"), "v")
    )


def drop_near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One document of each class, with all its columns; null and blank texts all stay.

    The one with the least id stays; of repeated rows with one id and one text, any.
    """
    every = materialise(classes(docs, doc_id=doc_id, text=text, similarity=similarity))
    held, go, stay, v, vertex = (tokens.unused(c, docs.columns) for c in ("held", "go", "stay", "v", "vertex"))
    if every.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        gone = every.where("v is not null and doc_id <> class_id").select(F.col("doc_id").alias(go))
        marked = _Ids(gone).mark(docs, doc_id, held)
        rest = marked.where(held).join(gone, F.col(doc_id) == F.col(go), "left_anti")
        return marked.where(~F.col(held)).unionByName(rest).drop(held)
    # ids do not tell rows apart, so rows are matched by id and text, and one of equals is taken
    first = every.where("v is not null").groupBy("class_id").agg(F.min(F.struct("doc_id", "v")).alias("s"))
    kept = first.select(F.col("s.doc_id").alias(stay), F.col("s.v").alias(v))
    keyed = docs.withColumn(vertex, _vertex(F.col(text)))
    one = (
        keyed.join(kept, F.col(doc_id).eqNullSafe(F.col(stay)) & (F.col(vertex) == F.col(v)), "left_semi")
        .dropDuplicates([doc_id, vertex])
    )
    return one.unionByName(keyed.where(F.col(vertex).isNull())).drop(vertex)


@F.arrow_udf(T.BinaryType())
def _vertex(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The key of each text's vertex."""

    def keys(some: list[str | None]) -> pa.Array:
        found: list[bytes | None] = []
        for *_, shingled, bounds in _each_slice(some):
            found += vertex_keys(shingled, bounds)
        return pa.array(found, pa.binary())

    return tokens.each(texts, keys)
