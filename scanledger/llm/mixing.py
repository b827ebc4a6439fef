"""Mix sources to target weights by Poisson replication.

A source whose target share is r times its present share has each document
repeated r times on average: the number is drawn from the Poisson distribution
with mean r, by inverting it at a uniform number hashed from the document's id
and a seed. A retried task so draws the same numbers. The copies are then
dealt out and sorted by a hash of their own, which shuffles them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 20
#: Target share of a source: its share of characters to this power, over the sum. 1 changes nothing.
EVENNESS = 0.7
#: Largest mean that is inverted at once; a larger one is a sum of equal independent parts.
PART_MEAN = 500
#: Copies of the table of rates, so that a join by source deals one large source to many tasks.
SALTS = 32
_HASH_DIGITS = 13


def uniform(*key: Column | int) -> Column:
    """A number of [0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws("|", *(F.coalesce(F.lit(k).cast("string"), F.lit("null")) for k in key))
    digits = F.substring(F.md5(text.cast("binary")), 1, _HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 4 * _HASH_DIGITS))


def source_rates(
    docs: DataFrame, weights: dict[str | None, float] | None = None, size: float = 1.0
) -> DataFrame:
    """``source, rate``: how often a document of each source is repeated on average.

    ``size`` is the size of the mixture over that of the corpus, in characters.
    ``weights`` are the target shares (scaled to sum 1; a source not named gets
    none, and if none of those named is present there is no mixture); without
    them the share of characters to the power ``EVENNESS``. A
    null source is a source of its own; one without characters has rate 1.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    if weights is None:
        aimed = sizes.withColumn("weight", F.pow(F.col("chars").cast("double"), F.lit(EVENNESS)))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), "named string, weight double")
        named = sizes.join(given, sizes["source"].eqNullSafe(given["named"]), "left").drop("named")
        aimed = named.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    total = aimed.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    share = F.coalesce(F.try_divide("weight", F.lit(total.weight)), F.lit(0.0))
    rate = share * F.lit(total.chars) * F.lit(size) / F.col("chars")
    return aimed.select("source", F.when(F.col("chars") == 0, 1.0).otherwise(rate).alias("rate"))


def cumulative(mean: Column) -> Column:
    """Poisson's cumulative probabilities from 0 on, until what is left is below any drawn number."""
    last = F.ceil(mean + 10 * F.sqrt(mean) + 25).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("sums"))

    def following(so_far: Column, k: Column) -> Column:
        p = so_far["p"] * mean / k
        total = so_far["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.array_append(so_far["sums"], total).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), start, following, lambda x: x["sums"])


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    size: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """The mixture: all columns of each drawn copy, and its number ``copy`` from 1.

    Documents with drawn number 0 are left out. Rows that repeat an id are
    drawn alike; a row without an id is drawn by its text, so that such rows have
    numbers of their own. Rows are dealt out by id and text, whatever ids repeat.
    An empty table gives no rows. An earlier column ``copy`` is replaced.
    """
    docs = docs.drop("copy")
    body = F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null|"), body))
    rates = source_rates(docs.select("source", "text"), weights, size)
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    rates = rates.withColumn("parts", parts).select(
        F.col("source").alias("__source"), F.col("parts").alias("__parts"),
        cumulative(F.col("rate") / F.col("parts")).alias("__sums"),
    )
    rates = rates.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = docs.withColumns({"__salt": F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"), "__name": name})
    on = salted["source"].eqNullSafe(rates["__source"]) & (salted["__salt"] == rates["__salt_of"])

    def drawn(part: Column) -> Column:
        number = uniform(seed, part, F.col("__name"))
        return F.size(F.filter("__sums", lambda bound: number >= bound))

    counts = F.transform(F.sequence(F.lit(1), F.col("__parts")), drawn)
    times = F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    copies = (
        salted.join(rates, on)
        .withColumn("__times", times)
        .filter("__times > 0")
        .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("copy"))
    )
    place = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), "doc_id", "copy", F.xxhash64("text")).cast("binary"))
    dealt = copies.withColumn("__place", place).repartition("__place").sortWithinPartitions("__place")
    return dealt.drop("__place")
