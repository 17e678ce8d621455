"""Mixing sources to target weights, with DataFrame functions alone.

Tokens are summed per source, targets are levelled under a cap, and the repetition rate of a
source is its target over its tokens. Each document is emitted floor(rate) times, and once more
with the fraction of the rate as its probability.

The draws of a source depend on one another, so that few or very unequal documents do not carry it
away from its target. Its documents stand in bands of about one size; from the bands in order, each
takes as many copies as the running number of documents times the fraction, from a seeded offset on,
passes whole numbers. Within a band those with the smallest hash of seed and id are taken. What a source
takes is then off its target by its largest document at most, and by what sizes differ within a band (1/32
of a size, above 63 words).

Defined results. A null text has no words and is never taken. A null source is a source of its
own, last in order. Rows without an id draw by their text. Rows that share an id (or, without one, a text) draw alike
within a band: all of them are taken or none. An empty
table gives no rows. Columns of the input pass through unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import WORD, fresh, quoted, written
from tradeflow.plans.running import in_ranges, running

SEED = 20_240_501
WEIGHTS = (1, 2, 3)
MAX_RATE = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: int) -> Column:
    """Number in [0, 1) that depends on the seed and the row alone: 52 bits of an MD5 digest."""
    name = F.coalesce(key.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """source, source_size, target of each row (source, size).

    All sources together take as many tokens as there are. A source gets its share by weight, at
    most max_rate times its size; what is cut goes to the others by weight. In the end every
    source stands at min(max_rate * size, level * weight). With sources ordered by max_rate * size
    / weight the level is found in one pass over running sums. The windows see one row a source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = per_source.select(
        "source",
        "source_size",
        F.element_at(cycle, (F.row_number().over(in_order) - 1) % len(weights) + 1).alias("weight"),
        (F.col("source_size") * max_rate).alias("cap"),
    ).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left / F.sum("weight").over(rest)).withColumn(
        "level",
        F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level")))
        .over(everything)
        .getField("level"),
    )
    return levelled.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def band(size: Column) -> Column:
    """Number of the size's band, rising with it: sizes of up to 63 stand alone, then 32 bands to a doubling."""
    shift = F.greatest(F.length(F.bin(size)) - 6, F.lit(0))
    return shift * 64 + F.call_function("shiftright", size, shift)


def measured(docs: DataFrame, key: str, text: str, source: str, seed: int = SEED) -> DataFrame:
    """key, source, size and draw of every row."""
    return docs.select(
        quoted(key).alias("key"),
        quoted(source).alias("source"),
        n_words(quoted(text)).alias("size"),
        draw(quoted(key), quoted(text), seed).alias("u"),
    )


def cuts(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: int = SEED,
) -> DataFrame:
    """source, band, source_size, target, times, cut of each band of measured().

    A document of the band is emitted `times` times, and once more if its draw is at most `cut`. Equal draws
    are merged before they are sorted, and ranks are running sums over ranges, so a hot source, band or id is
    not one task. A source has at most 32 bands to a doubling of sizes. The table is written: Spark then
    knows its size, and joins it where the documents lie if it is small and by a shuffle if it is not.
    """
    level = written(targets(sizes, weights, max_rate), "mix-targets")
    rate = F.least(
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
        F.lit(float(max_rate)),
    )
    offset = draw(F.concat(F.lit("source "), F.coalesce(F.concat(F.lit(":"), "source"), F.lit(""))), F.lit(""), seed)
    rates = level.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.floor(rate).alias("times"),
        (rate - F.floor(rate)).alias("fraction"),
        offset.alias("offset"),
    )
    draws = sizes.groupBy("source", band(F.col("size")).alias("band"), "u").agg(
        F.sum((F.col("size") > 0).cast("long")).alias("n")
    )
    ranges = in_ranges(draws, ["source", "band", "u"], "mix-draws")
    so_far = Window.partitionBy("source").orderBy("band")
    ends = lambda n: F.floor(n * F.col("fraction") + F.col("offset"))
    bands = (
        ranges.groupBy("source", "band")
        .agg(F.sum("n").alias("of_band"))
        .withColumn("upto", F.sum("of_band").over(so_far))
        .join(rates, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("extra", ends(F.col("upto")) - ends(F.col("upto") - F.col("of_band")))
        .select("source", "band", "source_size", "target", "times", "extra")
    )
    bands = written(bands, "mix-bands")
    ranked = running(ranges, ["source", "band"], ["u"], {"rank": ("sum", F.col("n"))})
    few = bands.select(F.col("source").alias("of"), F.col("band").alias("in"), "extra")
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("band") == F.col("in"))
    last = (
        ranked.join(few, same)
        .filter(F.col("rank") - F.col("n") / 2 <= F.col("extra"))
        .groupBy("of", "in")
        .agg(F.max("u").alias("cut"))
    )
    return written(bands.join(last, same, "left").drop("of", "in", "extra"), "mix-cuts")


def copies(size: Column, times: Column, u: Column, cut: Column) -> Column:
    more = F.coalesce(u <= cut, F.lit(False)).cast("int")
    return F.when(size > 0, times.cast("int") + more).otherwise(0)


def plan(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: int = SEED,
) -> DataFrame:
    """key, size, source_size, target, copies of each row of measured(), which is read three times: pass a table."""
    found = cuts(sizes, weights, max_rate, seed).withColumnsRenamed({"source": "of", "band": "in"})
    same = F.col("source").eqNullSafe(F.col("of")) & (band(F.col("size")) == F.col("in"))
    return sizes.join(found, same).select(
        "key",
        "size",
        "source_size",
        "target",
        copies(F.col("size"), F.col("times"), F.col("u"), F.col("cut")).alias("copies"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs."""
    sizes = written(measured(docs, key, text, source, seed), "mix-sizes")
    found = cuts(sizes, weights, max_rate, seed).select("source", "band", "times", "cut")
    of, within, times, cut, size, n, one = fresh(
        docs.columns, "mix_of", "mix_band", "mix_times", "mix_cut", "mix_size", "mix_n", "mix_one"
    )
    same = quoted(source).eqNullSafe(F.col(of)) & (band(F.col(size)) == F.col(within))
    joined = docs.withColumn(size, n_words(quoted(text))).join(found.toDF(of, within, times, cut), same)
    u = draw(quoted(key), quoted(text), seed)
    columns = [quoted(c) for c in docs.columns]
    return (
        joined.select(*columns, copies(F.col(size), F.col(times), u, F.col(cut)).alias(n))
        .filter(F.col(n) > 0)
        .select(*columns, F.explode(F.array_repeat(F.lit(1), F.col(n))).alias(one))
        .select(*columns)
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Digest of the mix, one row per document."""
    sizes = written(measured(docs, "doc_id", "text", "source"), "mix-sizes")
    return plan(sizes).select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
