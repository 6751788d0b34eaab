"""Figures of the fact by every reporting dimension.

Numbers are added up on the map side per store and state, department and category, and weekday, which
leaves few rows, and per item after its rows were brought together. Only these sums are dealt to the
levels, and only they meet the smallest and largest names of parents: those need sorted rows, which whole
facts, repeated for every level, would spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import exact_parts, monday_zero, round_half_up, to_number, total_of
from shelfline.session import cut_lineage

LEVELS = {"store_id": "store", "cat_id": "category", "dept_id": "department", "item_id": "item", "state_id": "state", "weekday": "weekday", "weekend": "weekend"}
# Columns that are grouped together: an entity beside the parents it is checked against.
GROUPS = {"place": ["store_id", "state_id"], "kind": ["dept_id", "cat_id"], "day": ["weekday"]}
PARENTS = ["dept_id", "cat_id", "state_id"]
# What is added up, and what keeps its smallest or largest.
SUMMED = ["n", "units", "sales_n", "negative", "no_price", "bad_price", "no_date", "price_n", "price_short", "price_long", "price_rest"]
LOWEST, HIGHEST = ["lo", "first_day", "price_lo"], ["hi", "last_day", "price_hi"]
OFFENDERS_SHOWN = 5


def sales_cube(fact: DataFrame) -> DataFrame:
    """(level, key, figures) for every store, category, department, item, state, weekday, part of the
    week, and for all rows; names of parents only where a level is grouped with them. Stored in the shared folder, because the report reads it section by section."""
    sales, price = F.col("sales"), to_number("sell_price")
    parts = {f"price_{name}": part for name, part in exact_parts(price).items()}
    figures = [
        F.count(F.lit(1)).alias("n"),
        F.sum(sales).alias("units"),
        F.count(sales).alias("sales_n"),
        F.count_if(sales < 0).alias("negative"),
        F.count_if(price.isNull()).alias("no_price"),
        F.count_if(price <= 0).alias("bad_price"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
        F.count(price).alias("price_n"),
        *[part.alias(name) for name, part in parts.items()],
        F.min(sales).alias("lo"),
        F.max(sales).alias("hi"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.min(price).alias("price_lo"),
        F.max(price).alias("price_hi"),
    ]
    keyed = fact.withColumn("weekday", monday_zero("date"))
    few = keyed.groupingSets(list(GROUPS.values()), *[c for columns in GROUPS.values() for c in columns]).agg(
        F.coalesce(*[F.when(F.grouping(columns[0]) == 0, F.lit(name)) for name, columns in GROUPS.items()]).alias("part"), *figures
    )
    # A rebalanced item that holds most rows is split over tasks, and its parts are added up afterwards.
    items = fact.hint("rebalance", "item_id").groupBy("item_id", "dept_id", "cat_id").agg(F.lit("item").alias("part"), *figures)
    sums = few.unionByName(items, allowMissingColumns=True).withColumn("weekend", F.col("weekday") >= 5)
    key = lambda c: F.struct(F.lit(LEVELS.get(c, "all")).alias("level"), (F.col(c) if c else F.lit(None)).cast("string").alias("key"))
    dealt = {"place": ["store_id", "state_id"], "kind": ["dept_id", "cat_id"], "item": ["item_id"], "day": ["weekday", "weekend", ""]}
    levels = F.coalesce(*[F.when(F.col("part") == name, F.array(*map(key, columns))) for name, columns in dealt.items()])
    rows = sums.select("*", F.inline(levels)).groupBy("level", "key").agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        *[F.min(c).alias(c) for c in LOWEST],
        *[F.max(c).alias(c) for c in HIGHEST],
        *[F.min(c).alias(f"{c}_lo") for c in PARENTS],
        *[F.max(c).alias(f"{c}_hi") for c in PARENTS],
    )
    return cut_lineage(rows)


def mean_sales() -> Column:
    return round_half_up(F.try_divide(F.col("units").cast("double"), F.col("sales_n")), 4)


def mean_price(digits: int) -> Column:
    total = total_of(F.col("price_short"), F.col("price_long"), F.col("price_rest"))
    return round_half_up(F.try_divide(total, F.col("price_n").cast("double")), digits)


def broken(child: str, parent: str) -> Column:
    """True for an entity of the level `child` that has more than one parent."""
    apart = F.coalesce(F.col(f"{parent}_lo") != F.col(f"{parent}_hi"), F.lit(False))
    return (F.col("level") == LEVELS[child]) & F.col("key").isNotNull() & apart


def offenders(cube: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, children): the first entities that break each rule, comma-joined."""
    marks = F.array(*[F.when(broken(child, parent), F.lit(f"{child}->{parent}")) for child, parent in rules])
    rows = cube.select("key", F.explode(F.array_compact(marks)).alias("rule"))
    place = F.row_number().over(Window.partitionBy("rule").orderBy("key"))
    shown = rows.withColumn("place", place).where(F.col("place") <= OFFENDERS_SHOWN)
    return shown.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("key")), ", ").alias("children"))


def overall_row(cube: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """One row: figures of all rows, distinct entities per level, offenders per rule."""
    whole = F.col("level") == "all"
    figures = [F.max(F.when(whole, F.col(c))).alias(c) for c in [*SUMMED, *LOWEST, *HIGHEST]]
    distinct = [F.count_if((F.col("level") == name) & F.col("key").isNotNull()).alias(f"unique_{name}") for name in LEVELS.values()]
    return cube.agg(*figures, *distinct, *[F.count_if(broken(*rule)).alias(f"{rule[0]}->{rule[1]}") for rule in rules])
