"""Joins. All are equality joins, so Catalyst and adaptive execution pick broadcast or sort-merge by measured size.

No side is broadcast by hint: the optimizer broadcasts a side only when its size is below the session threshold, and
adaptive execution splits the partitions of a key that holds a large share of the rows. Where a join would multiply
rows of one order, the many side is first reduced to one row per order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import scalars as S


def join_order_totals(lines: DataFrame, totals: DataFrame) -> DataFrame:
    """Order-level totals next to each line; ``totals`` has one row per order."""
    return lines.join(totals, "order_id", "left")


def join_lookup_coalesce(
    df: DataFrame, lookup: DataFrame, key: str, value: str, name: str, fallback: Column | None = None
) -> DataFrame:
    """Looked-up value, or a cleaned form of the key itself when the lookup has none."""
    table = lookup.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    own = S.underscores_to_spaces(key) if fallback is None else fallback
    joined = df.join(table, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_value", own)).drop("_key", "_value")


def left_pick(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join that adds the named columns of ``other`` and nothing else."""
    return df.join(other.select(key, *columns), key, "left")


def join_customer_orders(customers: DataFrame, orders: DataFrame, values: DataFrame) -> DataFrame:
    """Orders with their value and buyer. Orders meet values on the order key, then customers."""
    return orders.join(values, "order_id").join(customers, "customer_id")


def join_items_orders(items: DataFrame, orders: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    if statuses is not None:
        orders = orders.where(F.col("order_status").isin(list(statuses)))
    return items.join(orders, "order_id")


def review_totals(reviews: DataFrame) -> DataFrame:
    """Per order: sum of scores, scored reviews, all reviews, reviews with score 2 or less."""
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.sum(score).alias("_score_sum"),
        F.count(score).alias("_scored"),
        F.count("review_id").alias("_reviews"),
        S.count_where(score <= 2).alias("_negative"),
    )


def join_items_reviews(items: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Review figures per ``key``, where a review counts once for each item line of its order.

    Lines are counted per (order, key) and reviews are summed per order before the join, so the pairs are never
    produced: a figure of the pair table is lines times the figure of the order.
    """
    lines = items.groupBy("order_id", key).agg(F.count(F.lit(1)).alias("_lines"))
    weighted = lines.join(review_totals(reviews), "order_id")
    total = {n: F.sum(F.col("_lines") * F.col(n)) for n in ("_score_sum", "_scored", "_reviews", "_negative")}
    return weighted.groupBy(key).agg(
        total["_score_sum"].alias("score_sum"),
        total["_scored"].alias("scored_reviews"),
        total["_reviews"].alias("total_reviews"),
        total["_negative"].alias("negative_reviews"),
    )


def left_then_require(left: DataFrame, required: DataFrame, optional: DataFrame, key: str, test: Column) -> DataFrame:
    """Left joins followed by a test on one side, written as the inner join it is; the other side stays optional."""
    return left.join(required.where(test), key).join(optional, key, "left")


def join_features(orders: DataFrame, item_features: DataFrame) -> DataFrame:
    return orders.join(item_features, "order_id")


def stream_static_lookup(stream: DataFrame, static: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return join_lookup_coalesce(stream, static, key, value, name)


def effective_dated_join(
    usage: DataFrame, prices: DataFrame, key: str, day: str, start: str, end: str, slice_days: int = 32
) -> DataFrame:
    """Price valid on the day of use; a price without an end holds for ever. Usage that meets several prices has a row for each.

    Prices that end before the next one of their key begins are found as of the day: the distinct (key, day) of the usage and
    the starts of prices are put in order, and the last price seen is carried forward. That costs their sum, not their product.
    A key's days are cut into slices, so that no key is one task's; what a slice begins with comes from the last price of each
    slice before it. A price that outlives its successor is compared with the days of its key as a residual test. Rows
    without a key or a day have no price, prices without a key or a start are never valid.
    """
    others = [c for c in prices.columns if c != key]
    dated = prices.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_at"), F.col(end).alias("_end"), F.struct(*others).alias("_price")
    )
    dated = dated.withColumn("_next", F.lead("_at").over(Window.partitionBy("_key").orderBy("_at")))
    in_turn = F.coalesce(F.col("_end") < F.col("_next"), F.col("_next").isNull())
    asked = usage.select(F.col(key).alias("_key"), F.col(day).alias("_day")).dropna().distinct()

    found = _as_of(asked, dated.where(in_turn), slice_days).where("_end IS NULL OR _day <= _end")
    outliving = dated.where(~in_turn).withColumnRenamed("_key", "_k")
    on = (F.col("_key") == F.col("_k")) & (F.col("_day") >= F.col("_at")) & (F.col("_end").isNull() | (F.col("_day") <= F.col("_end")))
    met = found.select("_key", "_day", "_price").unionByName(asked.join(outliving, on).select("_key", "_day", "_price"))
    same = (F.col(f"u.{key}") == F.col("m._key")) & (F.col(f"u.{day}") == F.col("m._day"))
    return usage.alias("u").join(met.alias("m"), same, "left").select("u.*", *[F.col(f"m._price.{c}").alias(c) for c in others])


def _as_of(asked: DataFrame, versions: DataFrame, slice_days: int) -> DataFrame:
    """``asked`` (_key, _day) with _price and _end of the version (_key, _at, _end, _price) that began last by then, if any did."""
    begun = versions.select("_key", "_at", F.lit(0).alias("_turn"), F.struct("_price", "_end").alias("_version"))
    rows = begun.unionByName(asked.select("_key", F.col("_day").alias("_at"), F.lit(1).alias("_turn"), "_day"), allowMissingColumns=True)
    rows = rows.withColumn("_slice", F.floor(F.unix_date(F.col("_at").cast("date")) / slice_days))
    so_far = Window.partitionBy("_key", "_slice").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far)).where("_turn = 1")
    # One row per key and slice, as many as the calendar has.
    slices = rows.groupBy("_key", "_slice").agg(F.max_by("_version", F.when(F.col("_turn") == 0, F.col("_at"))).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    brought = slices.withColumn("_brought", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")
    version = F.coalesce("_seen", "_brought")
    known = seen.join(brought, ["_key", "_slice"]).withColumn("_version", version).where("_version IS NOT NULL")
    return known.select("_key", "_day", "_version._price", "_version._end")


def join_reviews_delivery(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    return reviews.join(orders.select("order_id", "status_entrega", "delta_entrega_dias"), "order_id")


def join_review_context(reviews: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Each review with its order and the first item line of that order, then one row per review id.

    The item side is cut to one line per order before the join, so an order with many lines does not multiply its
    reviews. ``order_item_id`` and ``product_id`` settle the choice.
    """
    first_line = items.groupBy("order_id").agg(
        F.min_by(
            F.struct("product_category", "seller_state"),
            F.struct("order_item_id", "product_id", "seller_id"),
        ).alias("_line")
    )
    joined = (
        reviews.join(orders.select("order_id", "customer_state", "status_entrega", "delta_entrega_dias"), "order_id")
        .join(first_line, "order_id")
        .withColumns({"product_category": F.col("_line.product_category"), "seller_state": F.col("_line.seller_state")})
        .drop("_line")
    )
    first = Window.partitionBy("review_id").orderBy("order_id")
    return joined.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def join_risk_segment(predictions: DataFrame, orders: DataFrame, segments: DataFrame) -> DataFrame:
    """Predictions with the buyer's segment, through the order's person id.

    A person listed under several addresses takes the segment of the latest purchase.
    """
    person = segments.groupBy("customer_unique_id").agg(
        F.max_by("rfm_segment", F.struct("last_purchase", "customer_state", "customer_city")).alias("rfm_segment")
    )
    owners = orders.select("order_id", "customer_unique_id")
    return predictions.join(owners, "order_id", "left").join(person, "customer_unique_id", "left")


def zip_points(geo: DataFrame) -> DataFrame:
    """One point per postal prefix, weighted by the rows behind each place."""
    weight = F.col("num_registros")
    return geo.groupBy("geolocation_zip_code_prefix").agg(
        F.round(F.sum(F.col("geolocation_lat") * weight) / F.sum(weight), 6).alias("lat"),
        F.round(F.sum(F.col("geolocation_lng") * weight) / F.sum(weight), 6).alias("lng"),
    )


def join_geo(customers: DataFrame, geo: DataFrame) -> DataFrame:
    points = zip_points(geo).withColumnRenamed("geolocation_zip_code_prefix", "customer_zip_code")
    return customers.join(points, "customer_zip_code", "left")


def semi_join_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


SALE_STATUSES = tuple(fixed.SALE_STATUSES)
