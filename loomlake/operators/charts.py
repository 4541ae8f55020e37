"""Metrics and charts derived from a view's columns: what a column is good for, which charts follow, and their data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import tolerant_timestamp
from loomlake.functions.names import humanize, quote, slugify

MOST_CHARTS, MOST_DAYS, MOST_SLICES, MOST_SAMPLE = 4, 1000, 25, 25
# What the names of columns tell.
ENUM_MARKERS = (
    "status", "state", "type", "category", "country", "region", "source", "domain", "provider", "portal", "gender", "theme", "role", "tier",
    "screen", "platform", "mode", "level",
)
NOT_ENUM = ("password", "secret", "token", "url", "document", "message", "description", "object_key")
MEASURE_MARKERS = (
    "amount", "total", "count", "revenue", "commission", "score", "duration", "quantity", "price", "value", "percentage", "applications", "users",
)
NOT_MEASURE = {"v", "index", "sortorder"}
TIME_MARKERS = ("createdat", "updatedat", "timestamp", "datetime", "processed_at", "ingested_at")
COUNT_ORDER = ("silver_row_id", "id", "uuid")
TIME_ORDER = ("createdat", "created_at", "createddate", "created_date", "timestamp", "updatedat", "updated_at")
ENUM_ORDER = ("status", "type", "domain", "category", "country", "countrycode", "role", "tier", "gender")
MEASURE_ORDER = ("amount", "total_amount", "revenue", "revenuegenerated", "totalapplicationscount", "count")


@dataclass(frozen=True)
class Chart:
    name: str
    title: str
    kind: str  # total, trend, breakdown or sample
    column: str | None
    count: str


def _hidden(name: str) -> bool:
    return name.endswith(("_raw_json", "_hash"))


def roles(f: T.StructField) -> set[str]:
    """temporal, enum, measure: what a column may serve as."""
    name, kind, out = f.name.lower(), f.dataType, set()
    times = isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType)
    if times or not _hidden(name) and (name.endswith(("date", "time", "_at")) or any(m in name for m in TIME_MARKERS)):
        out.add("temporal")
    identifier = name.endswith("id")
    if not _hidden(name) and not identifier and isinstance(kind, T.StringType | T.BooleanType) and not any(m in name for m in NOT_ENUM) and any(m in name for m in ENUM_MARKERS):
        out.add("enum")
    if isinstance(kind, T.NumericType) and name not in NOT_MEASURE and not identifier and any(m in name for m in MEASURE_MARKERS):
        out.add("measure")
    return out


def preferred(schema: T.StructType, role: str, order: tuple[str, ...]) -> str | None:
    """The column of a role that comes first in ``order``, else the first of the table."""
    names = [f.name for f in schema.fields if role in roles(f)]
    return min(names, key=lambda n: order.index(n.lower()) if n.lower() in order else len(order), default=None)


def count_column(schema: T.StructType) -> str | None:
    names = schema.names
    return next((p for p in COUNT_ORDER if p in names), None) or next((n for n in names if not _hidden(n.lower())), names[0] if names else None)


def plan_charts(view: str, schema: T.StructType) -> list[Chart]:
    """Record count, trend by day, breakdown by an enum, total of a measure; a sample where only the count is left."""
    counted = count_column(schema)
    if counted is None:
        return []
    base, title = slugify(view.removesuffix("_analytics")), humanize(view.removesuffix("_analytics").split("__")[-1])
    out = [Chart(f"{base}-record-count", f"{title} Records", "count", counted, counted)]
    for kind, role, order, name in (("trend", "temporal", TIME_ORDER, "{} Over Time"), ("breakdown", "enum", ENUM_ORDER, "{} by {}"), ("total", "measure", MEASURE_ORDER, "Total {1}")):
        column = preferred(schema, role, order)
        if column:
            out.append(Chart(f"{base}-{slugify(column)}-{kind}", name.format(title, humanize(column)), kind, column, counted))
    if len(out) == 1:
        out.append(Chart(f"{base}-sample", f"{title} Sample Records", "sample", None, counted))
    return out[:MOST_CHARTS]


def chart_data(df: DataFrame, chart: Chart) -> DataFrame:
    """The rows that a chart shows. Ties in a breakdown are cut in the order of the value."""
    if chart.kind == "count":
        return df.agg(F.count(F.col(quote(chart.count))).alias("records"))
    if chart.kind == "trend":
        return daily_trend(df, chart.column, F.count(F.col(quote(chart.count))).alias("records"))
    if chart.kind == "breakdown":
        return breakdown(df, chart.column, F.count(F.col(quote(chart.count))).alias("records"))
    if chart.kind == "total":
        return df.agg(F.sum(F.col(quote(chart.column))).alias("total_value"))
    return df.select(*[F.col(quote(c)) for c in df.columns[:8]]).limit(MOST_SAMPLE)


def daily_trend(df: DataFrame, column: str, *metrics: Column, most: int = MOST_DAYS) -> DataFrame:
    """Metrics by day in order; rows without a time are left out."""
    kind = df.schema[column].dataType
    at = F.col(quote(column))
    at = at.cast("timestamp") if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType) else tolerant_timestamp(at)
    days = df.withColumn("period", F.date_trunc("day", at).cast("timestamp_ntz")).filter("period IS NOT NULL")
    return days.groupBy("period").agg(*metrics).orderBy("period").limit(most)


def breakdown(df: DataFrame, column: str, metric: Column, most: int = MOST_SLICES) -> DataFrame:
    """A metric by value, the largest first."""
    grouped = df.groupBy(F.col(quote(column))).agg(metric)
    return grouped.orderBy(F.desc(grouped.columns[-1]), F.col(quote(column)).asc_nulls_last()).limit(most)


def metric(label: str, aggregate: str | None = None, column: str | None = None, expression: str | None = None) -> Column:
    """A metric from an aggregate and a column, or from a SQL expression."""
    if expression:
        return F.expr(expression).alias(label)
    known = {"COUNT": F.count, "SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "COUNT_DISTINCT": F.count_distinct}
    return known[aggregate.upper()](F.col(quote(column))).alias(label)


def chart_payload(chart: Chart, view: str) -> dict:
    """The chart as the form data of a dashboard tool."""
    kinds = {"count": "big_number_total", "trend": "echarts_timeseries_line", "breakdown": "echarts_pie", "total": "big_number_total", "sample": "table"}
    total = chart.kind == "total"
    one = {"expressionType": "SIMPLE", "aggregate": "SUM" if total else "COUNT", "column": {"column_name": chart.column if total else chart.count}, "label": f"Total {humanize(chart.column)}" if total else "Records"}
    payload = {"slice_name": chart.name, "title": chart.title, "datasource": view, "viz_type": kinds[chart.kind], "metrics": [] if chart.kind == "sample" else [one]}
    if chart.kind == "trend":
        payload |= {"x_axis": chart.column, "time_grain_sqla": "P1D", "row_limit": MOST_DAYS}
    if chart.kind == "breakdown":
        payload |= {"groupby": [chart.column], "row_limit": MOST_SLICES}
    return payload
