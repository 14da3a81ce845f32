"""Tables with the shape of the target domain, derived from an order schema.

``order_cohort``   one row per order with a 0/1 label, statistics and scores.
``season_table``   the same rows under the column names of the player recipe.
``height_table``   one row per part with height text in every damaged form.

All line-item sums are whole numbers (cents, percents), so results do not depend
on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_totals(lines: DataFrame) -> DataFrame:
    """Per order: whole-number totals; combined before the shuffle."""
    def whole(c: str, scale: int) -> Column:
        return F.rint(F.col(c) * scale).cast("bigint")
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.max(F.col("l_quantity").cast("bigint")).alias("max_qty"),
        F.sum(whole("l_extendedprice", 100)).alias("cents"),
        F.sum(whole("l_discount", 100)).alias("disc"),
        F.sum(whole("l_tax", 100)).alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"))


def _four_places(c: Column) -> Column:
    return F.floor(c * 10000 + 0.5) / 10000.0


def order_cohort(spark: SparkSession, folder: str) -> DataFrame:
    """orders joined with customer and nation, left join of line totals.

    No join is hinted: the small dimension is broadcast by its measured size, and
    hot customers are left to skew-join splitting.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey",
        F.coalesce((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
                   F.lit(False)).cast("int").alias("label"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.year("o_orderdate").alias("order_year"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey",
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("grp"))
    joined = (orders.join(customers, "o_custkey").join(nations, "c_nationkey")
              .join(line_totals(table(spark, folder, "lineitem")), "id", "left"))
    k = F.col("k").cast("double")
    rows = joined.select(
        "id", "label", "segment", "grp", "priority", "order_year", "balance",
        k.alias("n_lines"), F.col("qty").cast("double").alias("qty"),
        F.col("max_qty").cast("double").alias("max_qty"),
        (F.col("cents") / 100.0).alias("price"),
        (F.col("disc") / (k * 100.0)).alias("avg_disc"),
        (F.col("tax") / (k * 100.0)).alias("avg_tax"),
        F.col("returned").cast("double").alias("returned"))
    base = F.col("avg_disc") / 0.1 * 0.5 + F.col("avg_tax") / 0.08 * 0.25
    lift = F.col("label") * 0.2
    none = F.lit(0.0)
    return rows.withColumns({
        "score": F.coalesce(_four_places(base + lift), none),
        "score_b": F.coalesce(_four_places(F.col("avg_tax") / 0.08 * 0.8 + lift), none),
        "score_c": F.coalesce(_four_places(F.col("avg_disc") / 0.1 * 0.7 + lift * 0.5), none),
    })


def season_table(spark: SparkSession, folder: str) -> DataFrame:
    """The cohort under the recipe's column names; statistics keep their NULLs."""
    c = order_cohort(spark, folder)
    types = {"AUTOMOBILE": "Combo G", "BUILDING": "PG", "FURNITURE": "Stretch 4",
             "HOUSEHOLD": "C", "MACHINERY": "Wing G"}
    years = {"1": "Fr", "2": "So", "3": "Jr", "4": "Sr"}
    confs = {"NATION_1": "B10", "NATION_2": "B12", "NATION_3": "ACC", "NATION_4": "SEC",
             "NATION_5": "P12", "NATION_6": "BE"}

    def renamed(column: str, names: dict[str, str]) -> Column:
        out = F.col(column)
        for old, new in names.items():
            out = F.when(F.col(column) == old, new).otherwise(out)
        return out

    n, q, p = F.col("n_lines"), F.col("qty"), F.col("price")
    d, t, r = F.col("avg_disc"), F.col("avg_tax"), F.col("returned")
    stats: dict[str, Column] = {
        "GP": n * 4, "mp": q / 10, "Min_per": q / 4, "usg": n * 3 + 5, "eFG": d * 600,
        "TS_per": d * 500 + 20, "TP_per": F.when(r > 0, t * 1000), "ast_tov": F.when(r > 0, n / r),
        "AST_per": r * 8, "TO_per": n * 2, "stl_per": t * 40, "blk_per": d * 60,
        "ORB_per": t * 150, "DRB_per": d * 200, "bpm": p / 49999 - 4, "pts": q / 8,
        "treb": F.col("max_qty") / 5, "ast": r * 1.5, "stl": t * 20, "blk": d * 25,
        "height_numeric": F.col("max_qty") / 2 + 60,
        "Rec_Rank": F.when(r > 1, F.col("balance") / 10 + 100),
    }
    return c.select(
        F.col("id").cast("string").alias("player_id"), F.col("label").alias("drafted"),
        renamed("segment", types).alias("type"), renamed("grp", confs).alias("conf"),
        renamed("priority", years).alias("yr"),
        F.when(F.col("id") % 10 == 0, F.lit("n/a"))
        .otherwise(F.col("order_year").cast("string")).alias("year"),
        *[e.alias(name) for name, e in stats.items()])


def height_table(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, ht)`` with one damaged form per residue of the part key."""
    inches, key = F.col("p_size") % 12, F.col("p_partkey")
    feet = key % 3 + 5
    month = F.when(feet == 5, "May").when(feet == 6, "Jun").otherwise("Jul")
    two = F.lpad(inches.cast("string"), 2, "0")
    text, dash = inches.cast("string"), F.lit("-")
    forms = [
        F.concat(text, dash, month), F.concat(month, dash, two),
        F.concat(text, F.lit("/"), month), F.concat(text, dash, F.lower(month), F.lit("e")),
        F.concat(feet.cast("string"), dash, text), F.concat(feet.cast("string"), F.lit("-00")),
        feet.cast("string"), (feet * 12 + inches).cast("string"), F.lit("9"), F.lit("-"),
        F.lit(""), F.concat(F.lit("  "), text, dash, month, F.lit(" ")),
    ]
    ht = F.lit(None).cast("string")
    for i, form in reversed(list(enumerate(forms))):
        ht = F.when(key % 13 == i, form).otherwise(ht)
    return table(spark, folder, "part").select(key.alias("id"), ht.alias("ht"),
                                               F.col("p_brand").alias("brand"))
