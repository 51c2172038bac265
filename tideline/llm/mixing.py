"""Mix sources to target weights, in DataFrame operations only.

The size of a document is its number of words. Sources get shares of the total
size by weight, at most ``LIMIT`` times their own size, and what a source cannot
take is shared out again by weight. A source is taken whole as many times as fits
its target (complete epochs); the rest of the target is filled by weighted
sampling without replacement after Efraimidis and Spirakis: each document has an
exponential key of its quality weight's rate, made from a hash of its id, and
documents are taken in the order of their keys until the budget is used up. The
last one is taken in part, so a source's words miss its target by less than one.

Prefix sums go over slices of the key order, not whole sources: a source's key
distribution is known from its counts of quality levels, so it is cut into even
slices of about ``SLICE_ROWS`` documents whatever the weights, and a hot source is
spread over as many tasks as it has slices. Rows of one id, size and quality have one
key; they are counted before they are put in order, and written out again last, the
copies of a row with very many by many tasks.

A null text has size 0; a null source is a source of its own, the last in order.
Rows are told apart by id, size and quality only: among equal ones it does not
matter which is taken. Reruns give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, LIMIT = (5, 2, 1), 3
#: Characters that prose has few of; quality falls by four times their share.
SYMBOLS = "#*$%&|<>!{}[]^~=@_"
LEVELS = 10
SLICE_ROWS = 5_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_level(text: Column) -> Column:
    """1 to ``LEVELS``; the sampling weight is the level divided by ``LEVELS``."""
    length = F.coalesce(F.length(text), F.lit(0))
    symbols = length - F.length(F.translate(F.coalesce(text, F.lit("")), SYMBOLS, ""))
    share = F.when(length > 0, symbols / length).otherwise(1.0)
    level = F.ceil(LEVELS * (1 - 4 * share))
    return F.greatest(F.lit(1), F.least(F.lit(LEVELS), level)).cast("int")


def sampling_key(doc_id: Column, level: Column) -> Column:
    """Exponential with the rate of the quality weight; the least keys are taken first."""
    drawn = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return -F.ln((drawn.cast("double") + 0.5) / 2.0**52) / (level / LEVELS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Add ``target`` to ``sizes`` (source, source_size, ...), a row for each source.

    Sources in the order of limit by weight are tried as the first that stays
    below its limit: those before it take their limits, and the rest is shared by
    weight. This is where sharing out again and again ends.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    place = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    cap = (F.lit(limit) * F.col("source_size")).cast("double")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    weighed = weighed.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(whole) - (F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    share = rest / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    tried = weighed.withColumn("share", share)
    common = F.max(F.when(F.col("share") <= F.col("ratio"), F.col("share"))).over(whole)
    return tried.withColumn("target", F.least("cap", common * F.col("weight"))).drop("weight", "cap", "ratio", "share")


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` of every document."""
    level = quality_level(F.col(text))
    rows = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            level.alias("level"),
        )
    )
    counts = [F.count_if(F.col("level") == i).alias(f"n{i}") for i in range(1, LEVELS + 1)]
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), *counts)
    plan = targets(sizes, weights, limit)
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    plan = plan.withColumn("epochs", epochs)
    plan = plan.withColumn("budget", F.floor("target") - F.col("epochs") * size)
    plan = plan.withColumn("place", F.row_number().over(Window.orderBy("source")))
    plan = materialise(plan).withColumnRenamed("source", "of")

    keyed = rows.withColumn("key", sampling_key(F.col("doc_id"), F.col("level")))
    keyed = keyed.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # the share of the source's documents with a lesser key
    below = sum(F.col(f"n{i}") * (1 - F.exp(-F.col("key") * (i / LEVELS))) for i in range(1, LEVELS + 1))
    slices = F.ceil(F.col("n") / SLICE_ROWS)
    keyed = keyed.withColumn("slice", F.least(F.floor(below / F.col("n") * slices), slices - 1))
    keyed = keyed.drop("n", *(f"n{i}" for i in range(1, LEVELS + 1)))

    sums = keyed.groupBy("place", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    before = (F.sum("slice_size").over(earlier) - F.col("slice_size")).alias("before")
    placed = keyed.join(sums.select("place", "slice", before), ["place", "slice"])
    # rows that nothing tells apart are one row with a count, so an id with very many is one of its slice
    own = [c for c in placed.columns if c != "level"]
    groups = placed.groupBy(*own).agg(F.count("*").alias("copies"))
    words = F.col("size") * F.col("copies")
    within = Window.partitionBy("place", "slice").orderBy("key", "doc_id", "size")
    running = F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, 0)) - words
    groups = groups.withColumn("left", F.col("budget") - F.col("before") - running)

    def each(rows: DataFrame, first: Column, count: Column) -> DataFrame:
        """A row for each copy; the copies before one have taken their sizes."""
        numbered = rows.withColumn("copy", F.explode(F.sequence(first, first + count - 1)))
        left = F.col("left") - F.col("copy") * F.col("size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), left))
        return numbered.select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        )

    few = each(groups.where(F.col("copies") <= SLICE_ROWS), F.lit(0).cast("long"), F.col("copies"))
    many = groups.where(F.col("copies") > SLICE_ROWS)
    many = many.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / SLICE_ROWS))))
    many = many.repartition("place", "key", "doc_id", "chunk")
    first = F.col("chunk") * SLICE_ROWS
    return few.unionByName(each(many, first, F.least(F.lit(SLICE_ROWS), F.col("copies") - first)))
