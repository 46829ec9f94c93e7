"""Mixing sources to target weights by Poisson replication.

A source with weight w is to make up the share w of the mixture, so its documents repeat at the mean rate
`epochs * total size * w / size of the source`. The number of copies of a document is a Poisson variable of
that mean, read off the inverse of the distribution at a number that a seeded hash of the document's id (of
its whole text where it has none) gives. The copies are then shuffled globally: each has a place of its own, hashed from id and copy.

Only sizes per source are gathered; one row per source meets the documents. Everything is column
expressions. A source of any size stays spread over all tasks, since documents are dealt by copy.

Defined results: a null source is a source; a source without a weight, or with weight null or not above
zero, does not enter the mixture. A null text has size 1, as every document counts its characters plus one.
Rows of a source that share an id get the same number of copies each, and so do rows without id that share a
text, or are empty. Texts of any length are hashed whole. An empty table gives no rows.
Input columns named like an added column (`copy`, `mix_key`, `rate`) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import col, stored

#: Means above this are cut into equal parts, whose independent counts add up to the same distribution.
PART_MEAN = 16.0
#: Rows of (source, rate, inverse), each under 2 KB, that may be broadcast; more are joined by a shuffle.
MOST_BROADCAST = 5_000
#: Pieces into which each source is cut in that shuffle.
SALTS = 64
SEED = 2024


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Rows (`source`, `size`): characters plus one, summed over the documents of each source."""
    size = F.coalesce(F.length(col(text)), F.lit(0)).cast("long") + 1
    return docs.groupBy(col(source).alias("source")).agg(F.sum(size).alias("size"))


def tempered_weights(sizes: DataFrame, exponent: float = 0.5) -> DataFrame:
    """Weights that flatten the sizes: size to the power `exponent`. 1 keeps the shares, 0 makes them equal."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(exponent)).alias("weight"))


def replication_rates(sizes: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """Rows (`source`, `rate`): the mean number of copies of a document of the source."""
    asked = weights.filter("weight > 0").groupBy("source").agg(F.sum("weight").alias("weight"))
    both = sizes.alias("s").join(asked.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")))
    shares = both.select("s.source", "size", "weight")
    all_size = sizes.agg(F.sum("size")).first()[0]
    all_weight = shares.agg(F.sum("weight")).first()[0]
    scale = epochs * (all_size or 0) / (all_weight or 1.0)
    return shares.select("source", (F.lit(float(scale)) * F.col("weight") / F.col("size")).alias("rate"))


def _with_inverse(rates: DataFrame) -> DataFrame:
    """Add `parts` and `inverse`: P(count <= k) for k = 0, 1, … of one part, until it is 1 in effect."""
    cut = rates.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int"))
    cut = cut.withColumn("mean", F.col("rate") / F.col("parts"))
    return cut.withColumn("inverse", F.expr("""
        aggregate(sequence(1, cast(ceil(mean + 10 * sqrt(mean) + 20) as int)),
                  named_struct('p', exp(-mean), 'upto', exp(-mean), 'all', array(exp(-mean))),
                  (s, k) -> named_struct('p', s.p * mean / k, 'upto', s.upto + s.p * mean / k,
                                         'all', concat(s.all, array(s.upto + s.p * mean / k))),
                  s -> s.all)"""))


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the parts joined by '|'."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, weights: DataFrame | None = None, id: str = "doc_id", source: str = "source", text: str = "text",
    epochs: float = 1.0, exponent: float = 0.5, seed: int = SEED,
) -> DataFrame:
    """The mixture: the columns of `docs`, then `copy` (from 1), `rate` and `mix_key`.

    `weights` has the rows (source, weight); without it sizes are flattened by `exponent`. Rows come in
    shuffled order: dealt at random, and by `mix_key` within each partition.
    """
    spark = docs.sparkSession
    sizes = stored(source_sizes(docs, source, text), "sizes")
    rates = replication_rates(sizes, tempered_weights(sizes, exponent) if weights is None else weights, epochs)
    rates = stored(_with_inverse(rates).select(_source_key(F.col("source")).alias("__source"), "rate", "parts", "inverse"), "rates")

    ident = F.coalesce(col(id).cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(col(text).cast("string"), F.lit("")))))
    added = ("copy", "mix_key", "rate")
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(
        *[col(c) for c in kept], ident.alias("__id"), _source_key(col(source)).alias("__source"),
        F.monotonically_increasing_id().alias("__row"),
    )
    if rates.count() <= MOST_BROADCAST:
        met = rows.join(F.broadcast(rates), "__source")
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int")).join(salted, ["__source", "__salt"])
    # Invert each part at its own hash: the count is the number of steps at or below it.
    met = met.withColumn("__u", F.transform(
        F.sequence(F.lit(1), F.col("parts")),
        lambda i: hashed_unit(F.lit(f"{seed}"), F.lit("count"), i.cast("string"), F.col("__id")),
    ))
    met = met.withColumn("__n", F.expr("aggregate(__u, 0, (n, u) -> n + size(filter(inverse, c -> c <= u)))"))
    copies = met.filter("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}"), F.lit("place"), F.col("copy").cast("string"), F.col("__id"))), 1, 15), 16, 10)
    out = copies.withColumn("mix_key", place.cast("long"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The row number only keeps rows with the same id from landing in one partition.
    out = out.select(*[col(c) for c in kept], "copy", "rate", "mix_key", "__row")
    return out.repartition(n, "mix_key", "__row").sortWithinPartitions("mix_key").drop("__row")
