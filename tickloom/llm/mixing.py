"""Mixing sources to target weights by hash-seeded Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import written

#: A Poisson variable of a larger mean is the sum of independent ones of at most this mean, so exp() never underflows.
PIECE_MEAN = 16.0


def _hex_bits(digits: int, *parts: Column) -> Column:
    """The first hex digits of the md5 of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits), 16, 10).cast("long")


def source_rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.0,
    source_col: str = "source",
    size_factor: float = 1.0,
) -> DataFrame:
    """For each source: its documents and the mean repetition rate that gives its target share.

    weights: share of each source, scaled to sum to 1 over the sources that have documents; a source without one gets
    nothing. None: shares in proportion to n_docs ** power (0: equal shares, 1: as they are). size_factor: output
    documents for each input document. A null source is a source.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        share = F.pow(F.col("n_docs"), F.lit(float(power)))
    else:
        pairs = [x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))]
        share = F.coalesce(F.element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)) if pairs else F.lit(0.0)
    counts = written(counts.withColumn("weight", share), "mix-counts")
    whole = counts.agg(F.sum("n_docs").alias("docs"), F.sum("weight").alias("weight")).first()
    scale = float(size_factor) * whole["docs"] / whole["weight"] if whole["weight"] else 0.0
    return counts.select("source", "n_docs", (F.lit(scale) * F.col("weight") / F.col("n_docs")).alias("rate"))


def _with_cdf(rates: DataFrame) -> DataFrame:
    """The pieces of a source's Poisson mean and the cumulative probabilities of one piece."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE_MEAN)).cast("int")
    rates = rates.withColumn("pieces", pieces).withColumn("piece", F.col("rate") / F.col("pieces"))
    steps = F.sequence(F.lit(1), (F.ceil(F.col("piece") + 12 * F.sqrt("piece")) + 16).cast("int"))
    start = F.struct(F.exp(-F.col("piece")).alias("term"), F.array(F.exp(-F.col("piece"))).alias("cdf"))

    def step(acc, k):
        term = acc["term"] * F.col("piece") / k
        return F.struct(term.alias("term"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + term)).alias("cdf"))

    return rates.withColumn("cdf", F.aggregate(steps, start, step, lambda a: a["cdf"]))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.0,
    seed: int = 17,
    size_factor: float = 1.0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Repeat each document by a Poisson count whose mean is its source's target rate, and shuffle globally.

    The count inverts the Poisson distribution at a uniform number taken from md5(seed, id, piece), so it depends on
    the document alone: any executor gives the same answer at any time. Each copy gets a key from md5(seed, id, copy);
    rows are dealt by that key and sorted by it inside each partition. A hot source is no hot key: documents meet
    the rates by a broadcast if the written rates are below Spark's broadcast limit, else by a join that Spark splits.

    Returns the columns of docs, copy_no (from 1) and mix_key. Columns of docs of those two names are replaced. Null
    sources are one source; null ids share one count. Repeated rows are repeated alike. Rates 0 give no rows.
    """
    rates = written(_with_cdf(source_rates(docs, weights, power, source_col, size_factor)), "mix-rates")
    rates = rates.select(*[F.col(c).alias(f"__mix_{c}") for c in ("source", "pieces", "cdf")])
    docs = docs.drop("copy_no", "mix_key")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))

    def drawn(i):
        u = _hex_bits(13, F.lit(f"{seed}:n"), name, i.cast("string")) / F.lit(float(1 << 52))
        return F.size(F.filter(F.col("__mix_cdf"), lambda c: c <= u))

    count = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.col("__mix_pieces") - 1), drawn), F.lit(0), lambda a, x: a + x
    )
    joined = docs.join(rates, F.col(source_col).eqNullSafe(F.col("__mix_source")), "inner").withColumn("__mix_n", count)
    copies = joined.filter("__mix_n > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))))
    key = _hex_bits(15, F.lit(f"{seed}:k"), name, F.col("copy_no").cast("string"))
    out = copies.withColumn("mix_key", key).select(*docs.columns, "copy_no", "mix_key")
    return out.repartition("mix_key").sortWithinPartitions("mix_key", "copy_no")
