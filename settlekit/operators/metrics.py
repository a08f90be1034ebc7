"""Chart queries over the mart: one generic operator plus the dashboard's KPIs.

``chart_query`` is filter -> group by (time-grain bucket, dimensions) ->
aggregate -> order -> limit. Aggregations are partial on the map side, so the
shuffle carries one row per group per task regardless of skew in the groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.functions.columns import truncate_ntz

# Time grains (ISO-8601 duration codes) -> date_trunc unit.
TIME_GRAINS = {"PT1H": "hour", "P1D": "day", "P1W": "week", "P1M": "month", "P3M": "quarter", "P1Y": "year"}

# Simple adhoc-filter operators of the chart builder.
_FILTER_OPS = {
    "IS NOT NULL": lambda c, v: c.isNotNull(),
    "IS NULL": lambda c, v: c.isNull(),
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "IN": lambda c, v: c.isin(*v),
    "NOT IN": lambda c, v: ~c.isin(*v),
}


def filter_column(spec: Mapping) -> Column:
    """``{"col": name, "op": op, "val": value}`` -> boolean Column."""
    return _FILTER_OPS[spec["op"].upper()](F.col(spec["col"]), spec.get("val"))


def chart_query(df: DataFrame, metrics: Mapping[str, Column], x_axis: str | None = None,
                time_grain: str | None = None, groupby: Sequence[str] = (),
                filters: Sequence[Mapping] = (), row_limit: int | None = None,
                order_desc: bool = True) -> DataFrame:
    """Big number (no x_axis), time series (x_axis + time_grain, newest first) or
    categorical bar (x_axis + groupby, largest first). Every group is returned
    unless the caller passes a ``row_limit``."""
    for spec in filters:
        df = df.filter(filter_column(spec))
    if x_axis is None:
        out = df.agg(*[m.alias(n) for n, m in metrics.items()])
        return out.limit(1) if row_limit else out
    x = F.col(x_axis)
    if time_grain:
        x = truncate_ntz(x, TIME_GRAINS[time_grain])
    out = df.groupBy(x.alias(x_axis), *groupby).agg(*[m.alias(n) for n, m in metrics.items()])
    if time_grain:
        first = F.col(x_axis).desc_nulls_last() if order_desc else F.col(x_axis).asc_nulls_first()
        order = [first, *[F.col(g) for g in groupby]]
    else:
        m0 = next(iter(metrics))
        order = [F.col(m0).desc() if order_desc else F.col(m0).asc(), F.col(x_axis), *[F.col(g) for g in groupby]]
    out = out.orderBy(*order)
    return out.limit(row_limit) if row_limit else out


# Metric expressions ---------------------------------------------------------------

def settled() -> Column:
    return F.col("settled_at").isNotNull() & F.col("refunded_at").isNull()


def count_rows() -> Column:
    return F.count(F.lit(1))


def usd(cents: Column) -> Column:
    return F.sum(cents) / F.lit(100.0)


def usd_if(cents: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, cents)) / F.lit(100.0)


def rate_pct(num: Column, den: Column) -> Column:
    """count_if(num) / count_if(den) * 100, NULL when the denominator is 0."""
    return F.round(F.try_divide(F.count_if(num), F.count_if(den)) * 100, 6)


def metric_gross_volume() -> Column:
    return usd(F.col("amount_cents"))


def metric_net_volume() -> Column:
    return usd_if(F.col("amount_cents"), settled())


def metric_gross_revenue() -> Column:
    return usd(F.col("fee_amount_cents"))


def metric_net_revenue() -> Column:
    return usd_if(F.col("fee_amount_cents"), settled())


def metric_auth_rate() -> Column:
    return rate_pct(F.col("authorized_at").isNotNull(), F.col("initiated_at").isNotNull())


def metric_settlement_rate() -> Column:
    return rate_pct(F.col("settled_at").isNotNull(), F.col("authorized_at").isNotNull())



NOT_NULL_REASON = ({"col": "effective_decline_reason", "op": "IS NOT NULL"},)


def volume_by_day(m: DataFrame) -> DataFrame:
    return chart_query(m, {"count": count_rows()}, x_axis="initiated_at", time_grain="P1D")


def gross_volume(m: DataFrame) -> DataFrame:
    return chart_query(m, {"gross_volume_usd": metric_gross_volume()})


def net_volume(m: DataFrame) -> DataFrame:
    return chart_query(m, {"net_volume_usd": metric_net_volume()})


def weekly_gross_net(m: DataFrame) -> DataFrame:
    out = chart_query(m, {"gross_volume_usd": metric_gross_volume(), "net_volume_usd": metric_net_volume()},
                      x_axis="week_start")
    return out.orderBy(F.col("week_start").desc_nulls_last())


def auth_rate(m: DataFrame) -> DataFrame:
    return chart_query(m, {"auth_rate_pct": metric_auth_rate()})


def settlement_rate(m: DataFrame) -> DataFrame:
    return chart_query(m, {"settlement_rate_pct": metric_settlement_rate()})


def gross_revenue(m: DataFrame) -> DataFrame:
    return chart_query(m, {"gross_revenue_usd": metric_gross_revenue()})


def net_revenue(m: DataFrame) -> DataFrame:
    return chart_query(m, {"net_revenue_usd": metric_net_revenue()})


def volume_by(m: DataFrame, dim: str) -> DataFrame:
    return chart_query(m, {"count": count_rows()}, x_axis=dim)


def declines_by(m: DataFrame, dim: str) -> DataFrame:
    return chart_query(m, {"count": count_rows()}, x_axis=dim,
                       groupby=["effective_decline_reason"], filters=NOT_NULL_REASON)


def headline(m: DataFrame) -> DataFrame:
    """All single-number KPIs in one scan of the mart."""
    return m.agg(metric_gross_volume().alias("gross_volume_usd"), metric_net_volume().alias("net_volume_usd"),
                 metric_auth_rate().alias("auth_rate_pct"), metric_settlement_rate().alias("settlement_rate_pct"),
                 metric_gross_revenue().alias("gross_revenue_usd"), metric_net_revenue().alias("net_revenue_usd"),
                 count_rows().alias("transactions"))


def revenue_by_partner(m: DataFrame) -> DataFrame:
    """Volume and revenue (gross and net) per partner: the flagship report."""
    return (m.groupBy("partner_id")
             .agg(count_rows().alias("transactions"), metric_gross_volume().alias("gross_volume_usd"),
                  metric_net_volume().alias("net_volume_usd"), metric_gross_revenue().alias("gross_revenue_usd"),
                  metric_net_revenue().alias("net_revenue_usd"))
             .orderBy(F.col("gross_revenue_usd").desc_nulls_last(), "partner_id"))
