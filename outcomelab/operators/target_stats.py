"""Target statistics for categories: a level becomes the mean outcome of rows seen before.

In training a row must not see its own outcome, so the statistic runs through a seeded
permutation (the order of the rows' salted id hashes).  The permutation is cut into
buckets by the hash's first digits; sums of a level before a bucket come from a small
table, sums inside it from a window over (level, bucket).  A level with a third of all
rows is therefore spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .split import row_hash

#: Hexadecimal digits that choose a bucket: 256 of them.
BUCKET_DIGITS = 2


def _level(column: str) -> Column:
    """The level as text; a missing one is a level of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _mean(total: Column, n: Column, prior: Column, prior_weight: float) -> Column:
    return F.coalesce(F.try_divide(total + prior * prior_weight, n + F.lit(float(prior_weight))), prior)


def ordered_target_statistics(df: DataFrame, columns: Sequence[str], label: str, id_column: str,
                              prior_weight: float = 1.0, seed: int = 42,
                              suffix: str = "_stat") -> DataFrame:
    """Append ``<column>_stat``: the smoothed mean outcome of the level's earlier rows.

    Earlier: a smaller salted hash of the id; rows with one id do not see each other, and
    a missing id is a value of its own.  The mean is drawn towards that of the whole table
    with ``prior_weight`` rows.  Rows without an outcome add nothing but get a statistic.
    """
    y = F.col(label).cast("double")
    prior = df.agg(F.coalesce(F.avg(y), F.lit(0.0)).alias("p")).scalar()
    h, bucket, key = "__h", "__bucket", "__level"
    out = base = df.withColumn(h, row_hash(id_column, seed)).withColumn(bucket, F.substring(h, 1, BUCKET_DIGITS))
    for c in columns:
        rows = out.withColumn(key, _level(c))
        earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        # At most 256 rows a level; taken from the given table, not through the columns done before.
        offsets = base.withColumn(key, _level(c)).groupBy(key, bucket).agg(F.sum(y).alias("s"), F.count(y).alias("n")).select(
            key, bucket, F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("__s"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__n"))
        upto = Window.partitionBy(key, bucket).orderBy(h).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        same = Window.partitionBy(key, bucket, h)

        def before(value: Column, offset: str) -> Column:
            inside = F.coalesce(F.sum(value).over(upto), F.lit(0.0))
            return F.col(offset) + inside - F.coalesce(F.sum(value).over(same), F.lit(0.0))

        seen = F.when(y.isNotNull(), F.lit(1.0)).otherwise(0.0)
        out = (rows.join(offsets, [key, bucket])
               .withColumn(c + suffix, _mean(before(F.coalesce(y, F.lit(0.0)), "__s"), before(seen, "__n"),
                                             prior, prior_weight))
               .drop(key, "__s", "__n"))
    return out.drop(h, bucket)


def fit_target_statistics(train: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``column, level, total, n`` over the whole table, to encode other tables with."""
    y = F.col(label).cast("double")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _level(c).alias("level")) for c in columns])
    return (train.select(y.alias("y"), F.explode(pairs).alias("x"))
            .groupBy(F.col("x.column").alias("column"), F.col("x.level").alias("level"))
            .agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("total"), F.count("y").alias("n")))


def apply_target_statistics(df: DataFrame, fitted: DataFrame, columns: Sequence[str],
                            prior_weight: float = 1.0, suffix: str = "_stat") -> DataFrame:
    """Append the smoothed mean of the fitted level; an unseen level gets the overall mean."""
    for c in columns:
        own = fitted.where(F.col("column") == c)
        prior = own.agg(F.coalesce(F.try_divide(F.sum("total"), F.sum("n")), F.lit(0.0)).alias("p")).scalar()
        key = f"__{c}_level"
        table = own.select(F.col("level").alias(key), F.col("total").alias("__total"), F.col("n").alias("__n"))
        zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
        df = (df.withColumn(key, _level(c)).join(table, key, "left")
              .withColumn(c + suffix, _mean(zero("__total"), zero("__n"), prior, prior_weight))
              .drop(key, "__total", "__n"))
    return df
