"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns ``node`` and ``root`` (the smallest node reachable) for every node of ``edges`` (long columns a, b).

    Alternates large-star and small-star steps until the edges are stars around
    the smallest node of each component.  A step is a minimum by node (combined
    before the shuffle) and a join back, so no neighbourhood is gathered and a
    hub's rows can be split; the number of steps grows with the logarithm of the
    component size.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = scratch.keep(pairs, "edges")

    def digest(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = digest(pairs)
    while before[0]:
        # large star: every larger neighbour moves to the smallest of the neighbourhood
        both = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionAll(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        after_pairs = scratch.keep(small, "edges")
        after = digest(after_pairs)
        scratch.drop(pairs)
        pairs = after_pairs
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
