"""Mixing sources to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.llm.tables import join_by, written
from vertexmill.llm.text import WORD

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)

#: A source gives at most this many times its size.
MOST_COPIES = 3

#: Hashes have 60 bits; every level of the histogram settles 12 of them.
LEVELS, BITS = 5, 12


def size_and_hash():
    """Words of the whole text, and a 60-bit hash of the id (of the text where there is none)."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    h = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")
    return [size.alias("size"), h.alias("h")]


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, h)``. Rows of equal hash (repeated rows) share one decision."""
    return docs.select("doc_id", "source", *size_and_hash())


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``(source, source_size, target, copies, budget)``, one row a source.

    The weights share the total. A source stops at ``most`` times its size and
    its excess goes to the others by weight: sources are taken in the order of
    size per weight, and stop while their limit is below their share of what is
    left. ``copies`` are whole passes over the source, ``budget`` the rest.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array([F.lit(w) for w in weights]), (rank - 1) % len(weights) + 1)
    weighed = per_source.withColumn("weight", weight.cast("bigint"))
    order = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")
    )
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * most
    shared = weighed.select(
        "source",
        "source_size",
        "weight",
        (
            F.sum("source_size").over(everywhere)
            - F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, 0))
            + limit
        ).alias("left"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("weights"),
    )
    exact = "decimal(38,0)"
    capped = limit.cast(exact) * F.col("weights") <= F.col("left").cast(exact) * F.col("weight")
    marked = shared.withColumn("capped", capped)
    first = F.min(
        F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), -F.col("left"), "weights"))
    ).over(everywhere)
    rest = marked.withColumn("first", first)
    share = (
        (-F.col("first")["col2"]).cast("double") * F.col("weight") / F.col("first")["weights"]
    )
    target = F.when(F.col("capped"), limit.cast("double")).otherwise(share)
    copies = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    return (
        rest.withColumn("target", target)
        .withColumn("copies", copies.cast("bigint"))
        .select(
            "source",
            "source_size",
            "target",
            "copies",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        )
    )


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, last, whole)``: documents of hash below ``last`` fit the source's budget.

    Level by level: a histogram of words by source and the next 12 bits of the
    hash, the bucket in which the budget runs out, and a finer histogram of that
    bucket alone. After the last level the bucket is one hash value; it is taken
    as well (``whole``) where that comes nearer to the budget. Histograms have
    at most 4096 rows a source and are summed before the shuffle.
    """
    state = written(
        targets.filter("source_size > 0").select(
            "source", "budget", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before")
        ),
        "mix-level",
    )
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * BITS
        inside = join_by(sizes, state, ["source"], "inner", spread="h").filter(
            F.shiftright("h", shift + BITS) == F.col("prefix")
        )
        histogram = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.first("budget").alias("budget"), F.first("before").alias("before")
        )
        up_to = Window.partitionBy("source").orderBy("bucket")
        running = histogram.withColumn("upto", F.col("before") + F.sum("size").over(up_to))
        state = written(
            running.filter("upto > budget")
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "size", "budget")).alias("b"))
            .select(
                "source",
                F.col("b.budget").alias("budget"),
                F.col("b.bucket").alias("prefix"),
                (F.col("b.upto") - F.col("b.size")).alias("before"),
                F.col("b.size").alias("within"),
            )
            .drop(*([] if level == LEVELS - 1 else ["within"])),
            "mix-level",
        )
    nearer = F.col("before") + F.col("within") - F.col("budget") < F.col("budget") - F.col("before")
    return state.select("source", F.col("prefix").alias("last"), nearer.alias("whole"))


def source_marks(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """What decides for the documents of a source: whole copies, and the threshold of one more."""
    targets = written(source_targets(sizes, weights, most), "mix-targets")
    marks = written(thresholds(sizes, targets), "mix-marks")
    return written(join_by(targets, marks, ["source"]), "mix-sources")


def copies_of():
    """Nested thresholds: whole copies, and one more where the hash is below the threshold."""
    more = (F.col("h") < F.col("last")) | ((F.col("h") == F.col("last")) & F.col("whole"))
    return F.col("copies") + F.coalesce(more, F.lit(False)).cast("bigint")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` for every row of ``docs``.

    Every document of a source is taken as often as the target holds the whole
    source, and once more where its hash is below the source's threshold. Null
    sources are one source, the last; a null text has size 0; an empty table gives
    no rows. Reruns agree, as hashes depend on ids alone. Only the columns named
    are read, whatever others there are.
    """
    sizes = written(sized(docs), "mix-sizes")
    found = join_by(sizes, source_marks(sizes, weights, most), ["source"], spread="h")
    return found.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies_of().alias("copies"),
        (copies_of() * F.col("size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all their columns, with ``copies`` and ``taken``.

    Documents are decided on where they lie and never shuffled. Columns of
    ``docs`` that have the names of the two new ones give way to them.
    """
    marks = source_marks(written(sized(docs), "mix-sizes"), weights, most)
    kept = [c for c in docs.columns if c not in ("copies", "taken")]
    rows = docs.select(F.struct(*kept).alias("row"), "source", *size_and_hash())
    return (
        join_by(rows, marks, ["source"], spread="h")
        .select(*[F.col(f"row.`{c}`") for c in kept], copies_of().alias("copies"), (copies_of() * F.col("size")).alias("taken"))
        .filter("copies > 0")
    )
