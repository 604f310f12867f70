"""Threshold and membership ladders: one expression per business scale."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _chain(branches: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    out = None
    for condition, label in branches:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    tail = F.lit(otherwise)
    return tail if out is None else out.otherwise(tail)


def up_to(value: Column, steps: Sequence[tuple], above: str) -> Column:
    """Label of the first step whose upper bound is not exceeded. NULL falls through to ``above``."""
    return _chain([(value <= F.lit(bound), label) for bound, label in steps], above)


def at_least(value: Column, steps: Sequence[tuple], below: str) -> Column:
    """Label of the first step whose lower bound is reached. NULL falls through to ``below``."""
    return _chain([(value >= F.lit(bound), label) for bound, label in steps], below)


def member_of(value: Column, groups: Mapping[str, Sequence], other: str) -> Column:
    """Name of the first group that lists the value."""
    return _chain([(value.isin(list(members)), name) for name, members in groups.items()], other)


def label_at(index: Column, labels: Sequence[str]) -> Column:
    """``labels[index]`` for a zero-based index; NULL outside the list."""
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def delay_scale(days: Column) -> Column:
    """Five-level delivery scale of the raw layer."""
    return F.when(days.isNull(), F.lit(fixed.DELAY_UNKNOWN)).otherwise(
        up_to(days, fixed.DELAY_STEPS, fixed.DELAY_ABOVE)
    )


def delivery_status(delivered: Column, promised: Column) -> Column:
    """Three-level delivery status of the clean layer; a missing date means the order is still open."""
    late = delivered > promised
    return F.when(late.isNull(), "pendente").otherwise(F.when(late, "atrasado").otherwise("no_prazo"))


def size_class(grams: Column) -> Column:
    """Parcel size by weight. A missing weight counts as large."""
    return up_to(grams, fixed.SIZE_STEPS, fixed.SIZE_ABOVE)


def score_sentiment(score: Column) -> Column:
    """Sentiment implied by a 1 to 5 score. A missing score counts as negative."""
    return at_least(score, [(4, "positivo"), (3, "neutro")], "negativo")


def payment_group(kind: Column) -> Column:
    return member_of(kind, fixed.PAYMENT_GROUPS, fixed.PAYMENT_OTHER)


def staleness(days: Column) -> Column:
    return up_to(days, fixed.STALE_STEPS, fixed.STALE_ABOVE)


def seller_tier(score: Column) -> Column:
    return at_least(score, fixed.SELLER_TIERS, fixed.SELLER_BELOW)


def season(month: Column) -> Column:
    return member_of(month, fixed.SEASON_MONTHS, fixed.SEASON_OTHER)


def region(state: Column) -> Column:
    return member_of(state, fixed.REGION_STATES, fixed.REGION_OTHER)


def market_tier(state: Column) -> Column:
    return member_of(state, fixed.TIER_STATES, fixed.TIER_OTHER)


def risk_band(probability: Column) -> Column:
    """Right-closed bands: a probability equal to a bound belongs to the lower band. NULL stays NULL."""
    return F.when(probability.isNotNull(), up_to(probability, fixed.RISK_STEPS, fixed.RISK_ABOVE))


def like_any(value: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for pattern in patterns:
        out = out | value.like(pattern)
    return out


def usage_category(sku: Column) -> Column:
    name = F.lower(sku)
    return _chain([(like_any(name, p), label) for label, p in fixed.USAGE_CATEGORIES], fixed.USAGE_OTHER)


def review_cause(text: Column) -> Column:
    low = F.lower(text)
    return _chain([(low.rlike(p), label) for label, p in fixed.REVIEW_CAUSES], fixed.REVIEW_CAUSE_OTHER)


def rfm_segment(frequency: Column, recency: Column) -> Column:
    """Customer segment. Buyers seen more than once and recently win over the single-purchase rules."""
    repeat = F.when((frequency >= 3) & (recency <= 90), "Champions").when(recency <= 180, "Loyal")
    repeat = repeat.when(recency > 180, "At Risk")
    single = F.when(recency <= 90, "New").when(recency > 365, "Lost")
    chosen = F.when(frequency >= 2, repeat).when(frequency == 1, single)
    return F.coalesce(chosen, F.lit("Hibernating"))
