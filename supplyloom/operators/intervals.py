"""Validity windows as calendar rows: a day meets its window by an equi join, however many windows a key has.

A window is cut into the months it covers whole and the single days of the months it covers in part. For every key and month, and
every key and day, only the window that would win there is kept, so a key holds at most one row per month and day of the
calendar, and a fact meets at most one of each: nothing is multiplied, ranked or gathered per key. Only months and days on which
a key has facts are cut out.

Days and bounds are compared as text (``yyyyMMdd``), as the reports do: a bound ``yyyyMM00`` opens with its month, the end of
a window is the end of its month (``month_end``), a NULL bound is open.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.text import text_key

DAYS = tuple(f"{d:02d}" for d in range(1, 32))


def month_end(valid_to: Column) -> Column:
    return F.concat(F.left(valid_to, F.lit(6)), F.lit(DAYS[-1]))


def months_of(days: DataFrame, day: str) -> list[str]:
    """Months that occur, ``yyyyMM``; their number is bounded by the calendar."""
    months = days.select(F.date_format(day, "yyyyMM").alias("m")).filter(F.col("m").isNotNull()).distinct()
    return sorted(r["m"] for r in months.collect())


def asked_days(facts: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Months in which a key has facts (``_month``), with the bits of their days (``_days``); one row per key and month."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(day))
    dated = facts.select(*keys, F.date_format(day, "yyyyMM").alias("_month"), bit.alias("_bit")).dropna()
    return dated.groupBy(*keys, "_month").agg(F.bit_or("_bit").alias("_days"))


def calendar_rows(
    windows: DataFrame,
    keys: Sequence[str],
    rank: Sequence[str],
    months: Sequence[str] | DataFrame,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> tuple[DataFrame, DataFrame]:
    """The winning window per key and month it covers whole (``_month``), and per key and other day of its months (``_day``).

    ``_best`` holds the ``rank`` columns of the window; the highest wins, NULL below all others. ``valid_to`` is taken as it is.
    ``months`` lists the months of all keys, or is a frame of ``asked_days``: then a window becomes rows only for the months and
    days its own key is asked for.
    """
    low, high = F.col(valid_from), F.col(valid_to)
    month = F.col("_month")
    opens, closes = F.concat(month, F.lit(DAYS[0])), F.concat(month, F.lit(DAYS[-1]))
    touched = (low.isNull() | (closes >= low)) & (high.isNull() | (opens <= high))
    whole = (low.isNull() | (opens >= low)) & (high.isNull() | (closes <= high))
    # windows that agree in all that matters are one
    cut = windows.select(*keys, valid_from, valid_to, F.struct(*rank).alias("_best")).distinct()
    if isinstance(months, DataFrame):
        dated = cut.join(months, list(keys))
    else:
        listed = F.array(*[F.lit(m) for m in months]) if months else F.array().cast("array<string>")
        dated = cut.withColumn("_month", F.explode(listed)).withColumn("_days", F.lit(-1).cast("long"))
    by_month = dated.filter(touched).withColumn("_whole", whole)
    best = F.max("_best").alias("_best")
    full = by_month.filter("_whole").groupBy(*keys, "_month").agg(best)
    asked = F.filter(F.array(*[F.lit(d) for d in DAYS]), lambda d: F.getbit("_days", d.cast("int")) == 1)
    days = F.filter(
        F.transform(asked, lambda d: F.concat(month, d)),
        lambda d: (low.isNull() | (d >= low)) & (high.isNull() | (d <= high)),
    )
    edges = by_month.filter(~F.col("_whole")).select(*keys, "_best", F.explode(days).alias("_day")).groupBy(*keys, "_day").agg(best)
    return full, edges


def attach_valid(
    facts: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    day: str,
    rank: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    out: str = "_best",
) -> DataFrame:
    """Add ``out``: the ``rank`` columns of the highest window of equal ``keys`` that contains ``day``, as one struct, or NULL.

    Never adds or drops a row. A NULL day or key has no window. The two equi joins carry no size assumption; a hot key is
    spread over its months and days, and over more tasks by AQE.
    """
    full, edges = calendar_rows(windows, keys, rank, asked_days(facts, keys, day), valid_from, valid_to)
    for rows, kind, format_ in ((full, "_month", "yyyyMM"), (edges, "_day", "yyyyMMdd")):
        named = rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(kind).alias("_at"), F.col("_best").alias(f"_hit{kind}"))
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{k}") for k in keys], F.date_format(day, format_) == F.col("_at"))
        facts = facts.join(named, same, "left").drop("_at", *[f"_key_{k}" for k in keys])
    return facts.withColumn(out, F.greatest("_hit_month", "_hit_day")).drop("_hit_month", "_hit_day")


def price_by_calendar(
    facts: DataFrame, prices: DataFrame, keys: Sequence[str], day: str, as_of: date | datetime, out: str = "price"
) -> DataFrame:
    """``joins.price_at`` for keys with any number of windows: the same price, without an array of windows per key."""
    texts = [f"_text_{k}" for k in keys]
    windows = (
        prices.filter(F.col("price").isNotNull())
        .groupBy(*[text_key(F.col(k).cast("string")).alias(f"_text_{k}") for k in keys], "valid_from", "valid_to")
        .agg(F.min("price").alias("_price"))
        .withColumn("_until", month_end(F.col("valid_to")))
    )
    named = {f"_text_{k}": text_key(F.col(k).cast("string")) for k in keys}
    when = F.coalesce(F.col(day).cast("date"), F.lit(as_of).cast("date"))
    dated = facts.withColumns({**named, "_when": when})
    found = attach_valid(dated, windows, texts, "_when", ["valid_from", "valid_to", "_price"], "valid_from", "_until")
    return found.withColumn(out, F.col("_best")["_price"]).drop("_best", "_when", *texts)


def hidden_periods(visibility: DataFrame, keys: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """Each of ``keys`` with every listed period it is hidden in, once. An entry without start never hides."""
    listed = F.array(*[F.lit(p) for p in periods]) if periods else F.array().cast("array<string>")
    inside = F.filter(listed, lambda p: (p >= F.col("valid_from")) & (F.col("valid_to").isNull() | (p <= F.col("valid_to"))))
    entries = visibility.filter(F.col("valid_from").isNotNull()).select(*keys, "valid_from", "valid_to").distinct()
    return entries.select(*keys, F.explode(inside).alias("period")).distinct()


def hide_by_period(template: DataFrame, visibility: DataFrame, periods: Sequence[str]) -> DataFrame:
    """``joins.hide_invisible`` as a plain equi join on key and period, for entries with any number of windows per key.

    ``periods`` lists the periods of the template.
    """
    keys = ["team_id", "service_name_id", "customer_unit_id"]
    return template.join(hidden_periods(visibility, keys, periods), [*keys, "period"], "left_anti")
