"""Updates of a report table from other tables, written as joins that return a new frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.text import same_text, text_key
from supplyloom.operators.joins import cross_periods
from supplyloom.operators.windows import first_per_key


def update_from(
    df: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    on_missing: str = "null",
    order: Sequence[Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Set ``columns`` from the row of ``right`` with the same ``keys``; never adds or drops rows.

    Several matches are reduced to the first in ``order`` (default: the smallest values). Without a match
    the columns become NULL (``on_missing="null"``) or keep their value (``"keep"``). Rows where ``where``
    does not hold keep their values.
    """
    if on_missing not in ("null", "keep"):
        raise ValueError("on_missing must be 'null' or 'keep'")
    source = right.select(*keys, *columns)
    for k in keys:
        source = source.filter(F.col(k).isNotNull())
    if order is None:
        source = source.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_new"))
    else:
        source = first_per_key(right.dropna(subset=list(keys)), keys, order).select(*keys, F.struct(*columns).alias("_new"))
    joined = df.join(source, list(keys), "left")
    touched = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if on_missing == "keep":
        touched = touched & F.col("_new").isNotNull()
    new = {c: F.when(touched, F.col(f"_new.{c}")).otherwise(F.col(c)) if c in df.columns else F.when(touched, F.col(f"_new.{c}")) for c in columns}
    return joined.withColumns(new).select(*df.columns, *[c for c in columns if c not in df.columns])


def fill_measures(
    template: DataFrame, counts: DataFrame, keys: Sequence[str], kpis: Sequence[str], listed: tuple[str, str] | None = None
) -> DataFrame:
    """Set ``value`` on the rows of ``kpis`` to the measured count, 0 when there is none; other rows keep it.

    ``counts`` holds one row per text ``keys``. ``listed=("periods", "period")``: the template lists the values of a
    key ``period`` in an array ``periods`` and becomes one row for each of them, behind the join. If ``period`` is among
    ``keys``, the counts of the other keys meet a row together; the calendar bounds how many they are.
    """
    joined = [k for k in keys if not listed or k != listed[1]]
    split = len(joined) < len(keys)
    source = counts.select(*[text_key(F.col(k)).alias(f"_{k}") for k in keys], F.col("n_records").cast("double").alias("_n"))
    if split:
        entry = F.struct(F.col(f"_{listed[1]}").alias("at"), F.col("_n").alias("n"))
        found = F.col(f"_{listed[1]}").isNotNull()
        source = source.filter(found).groupBy(*[f"_{k}" for k in joined]).agg(F.collect_list(entry).alias("_counts"))
    on = [text_key(F.col(k)) == F.col(f"_{k}") for k in joined]
    rows = template.join(source, on, "left")
    columns = list(template.columns)
    if listed:
        rows = cross_periods(rows, F.col(listed[0]), listed[1])
        columns = [listed[1] if c == listed[0] else c for c in columns]
    if split:
        at = text_key(F.col(listed[1]))
        rows = rows.withColumn("_n", F.get(F.filter("_counts", lambda c: c["at"] == at), F.lit(0))["n"])
    filled = F.when(same_text(F.col("kpi"), *kpis), F.coalesce(F.col("_n"), F.lit(0.0))).otherwise(F.col("value"))
    return rows.withColumn("value", filled).select(*columns)


def transition(df: DataFrame, condition: Column, assignments: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """Assign values where ``condition`` holds; also returns the one-row count of changed rows."""
    hit = F.coalesce(condition, F.lit(False))
    changed = {
        name: F.when(hit, value if isinstance(value, Column) else F.lit(value)).otherwise(F.col(name))
        for name, value in assignments.items()
    }
    return df.withColumns(changed), df.filter(hit).agg(F.count(F.lit(1)).alias("n_changed"))
