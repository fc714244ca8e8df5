"""Joins of the reports. No join carries a broadcast hint on data of unknown size: Spark broadcasts a side
only below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, with skewed partitions split by AQE.
``measured`` is the exception: it adds up the bytes of a lookup first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.dates import valid_at
from supplyloom.functions.text import text_key
from supplyloom.session import staged

HOT_KEY_ROWS = 1_000_000
MEASURED_BYTES = 64 << 20
ROW_BYTES = 48  # of a broadcast row besides its texts: header, fixed columns, its place in the hash table
SALT = "_salt"


@dataclass(frozen=True)
class Lookup:
    """One dimension of a star: ``fk`` of the fact, ``pk`` of the dimension, ``columns`` new name -> source."""

    dim: DataFrame
    fk: str
    columns: Mapping[str, str | Column] = field(default_factory=dict)
    pk: str = "id"
    on: Column | None = None  # further condition on the dimension


def denormalize(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join every lookup in turn; one table may serve in several roles under different names."""
    keys = [f"_pk{i}" for i in range(len(lookups))]
    for key, look in zip(keys, lookups):
        dim = look.dim if look.on is None else look.dim.filter(look.on)
        picked = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in look.columns.items()]
        dim = dim.select(F.col(look.pk).alias(key), *picked)
        fact = fact.join(dim, F.col(look.fk) == F.col(key), "left")
    return fact.drop(*keys)


def measured(dim: DataFrame, most_bytes: int = MEASURED_BYTES) -> DataFrame:
    """``dim`` with a broadcast hint if its rows, added up in a job of their own, stay below ``most_bytes``; else as it is.

    For lookups whose join would deal out a far larger fact by another key, once more and only for that.
    """
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in dim.dtypes if kind == "string"]
    size = reduce(Column.__add__, texts, F.lit(ROW_BYTES + 8 * len(dim.columns)).cast("long"))
    found = dim.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(dim) if found < most_bytes else dim


def pivot_children(
    fact: DataFrame,
    child: DataFrame,
    key: str,
    disc: str,
    values: Mapping[object, str],
    columns: Sequence[str],
    unique: bool = False,
) -> DataFrame:
    """Attach child rows as column sets ``<prefix>_<column>``, one set per value of ``disc``.

    ``unique=True`` (at most one child per key and value) reads the child once and pivots it; otherwise
    every value is joined on its own and several children of one key multiply the row, as SQL does.
    """
    if unique:
        wide = child.filter(F.col(disc).isin(*values)).groupBy(F.col(key).alias("_key")).agg(
            *[
                F.max(F.when(F.col(disc) == value, F.col(c))).alias(f"{prefix}_{c}")
                for value, prefix in values.items()
                for c in columns
            ]
        )
        return fact.join(wide, F.col(key) == F.col("_key"), "left").drop("_key")
    return denormalize(
        fact,
        [
            Lookup(child, key, {f"{prefix}_{c}": c for c in columns}, pk=key, on=F.col(disc) == value)
            for value, prefix in values.items()
        ],
    )


def fan_out(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_id: str,
    rows_per_task: int = HOT_KEY_ROWS,
    keep_salt: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One-to-many left join that stays whole and spread when one key owns a large share of ``right``.

    Keys with more than ``rows_per_task`` rows get as many salts as needed on both sides. There are at most
    ``count(right) / rows_per_task`` such keys; Spark broadcasts them only below its threshold. Where ``right`` comes
    out of lookups, ``counted`` is the table before them, so that counting its keys does not compute them all again.
    They are counted once, before the plan is made: without such keys there is no salt.
    """
    hot = (
        (right if counted is None else counted).filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_hot"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select("_hot", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    hot = staged(hot)
    if hot.isEmpty():
        # nothing to spread: the join needs the key alone, and rows that already lie by it stay where they are
        joined = left.join(right, key, "left")
        return joined.withColumn(SALT, F.lit(0)) if keep_salt else joined
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = (
        left.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumns({"_hot": F.col("_hot").isNotNull(), SALT: F.explode(F.sequence(F.lit(0), salts - 1))})
        .drop("_salts")
    )
    salted = (
        right.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumns({SALT: F.pmod(F.xxhash64(right_id), salts).cast("int"), "_match": F.lit(True)})
        .drop("_hot", "_salts")
    )
    # a salt without a match is no missing child: its key has children under other salts
    joined = spread.join(salted, [key, SALT], "left").filter(~F.col("_hot") | F.col("_match").isNotNull()).drop("_hot", "_match")
    return joined if keep_salt else joined.drop(SALT)


def cross_periods(df: DataFrame, periods: Sequence[str] | Column, name: str = "period") -> DataFrame:
    """Every row once per period. The list holds a literal for each month, or is an array column with the periods of each
    row, so this is a generator, not a join."""
    if isinstance(periods, Column):
        return df.withColumn(name, F.explode(periods))
    if not periods:
        return df.withColumn(name, F.lit("")).limit(0)
    return df.withColumn(name, F.explode(F.array(*[F.lit(p) for p in periods])))


def hide_invisible(template: DataFrame, visibility: DataFrame) -> DataFrame:
    """Drop combinations with a visibility entry valid at their period. An entry without start never hides."""
    t, v = template.alias("t"), visibility.filter(F.col("valid_from").isNotNull()).alias("v")
    on = (
        (F.col("t.team_id") == F.col("v.team_id"))
        & (F.col("t.service_name_id") == F.col("v.service_name_id"))
        & (F.col("t.customer_unit_id") == F.col("v.customer_unit_id"))
        & valid_at(F.col("t.period"), F.col("v.valid_from"), F.col("v.valid_to"))
    )
    return t.join(v, on, "left_anti")


def hiding_windows(visibility: DataFrame, name: str = "hidden") -> DataFrame:
    """Distinct windows in which each (team_id, service_name_id, customer_unit_id) is hidden, as one array.

    The calendar bounds how many distinct windows there are, so the array stays small. Rows that have not
    been multiplied by periods yet can carry it and be tested once they are (``is_hidden``).
    """
    keys = ["team_id", "service_name_id", "customer_unit_id"]
    windows = visibility.filter(F.col("valid_from").isNotNull()).select(*keys, "valid_from", "valid_to").distinct()
    return windows.groupBy(*keys).agg(F.collect_list(F.struct("valid_from", "valid_to")).alias(name))


def is_hidden(period: Column, name: str = "hidden") -> Column:
    found = F.exists(name, lambda w: valid_at(period, w["valid_from"], w["valid_to"]))
    return F.coalesce(found, F.lit(False))


def unmatched(measures: DataFrame, template: DataFrame, keys: Sequence[str], listed: tuple[str, str] | None = None) -> DataFrame:
    """Measured combinations the template does not know; texts compare without case, NULL matches nothing.

    ``listed=("periods", "period")``: the template lists the values of one more key, ``period``, in an array ``periods``.
    """
    arrays, values = ([listed[0]], [listed[1]]) if listed else ([], [])
    m, t = measures.alias("m"), template.select(*keys, *arrays).distinct().alias("t")
    on = reduce(lambda a, b: a & b, [text_key(F.col(f"m.{k}")) == text_key(F.col(f"t.{k}")) for k in keys])
    for array, value in zip(arrays, values):
        on = on & F.exists(F.col(f"t.{array}"), lambda v: text_key(v) == text_key(F.col(f"m.{value}")))
    return m.join(t, on, "left_anti")


def not_in(df: DataFrame, other: DataFrame, key: str, null_aware: bool = False) -> DataFrame:
    """Rows whose key is not in ``other``.

    By default NULL keys of ``other`` are ignored and rows with a NULL key are kept. ``null_aware=True``
    follows SQL ``NOT IN``: one NULL in ``other`` empties the result and a NULL key is never kept (unless
    ``other`` is empty). Two existence probes decide that, so the join itself stays a plain equi join.
    """
    others = other.select(key)
    if null_aware:
        if not others.filter(F.col(key).isNull()).isEmpty():
            return df.limit(0)
        if not others.isEmpty():
            df = df.filter(F.col(key).isNotNull())
    return df.join(others.filter(F.col(key).isNotNull()), key, "left_anti")


def exists_flag(df: DataFrame, other: DataFrame, key: str, name: str, yes: object = 1, no: object = 0) -> DataFrame:
    """Add ``name``: ``yes`` where the key occurs in ``other``, else ``no``."""
    return join_distinct(df, other, key, "_found").withColumn(
        name, F.when(F.col("_found"), F.lit(yes)).otherwise(F.lit(no))
    ).drop("_found")


def join_distinct(df: DataFrame, other: DataFrame, key: str, flag: str, other_key: str | None = None) -> DataFrame:
    """Left join to the distinct keys of ``other``: adds ``flag`` (true or NULL) and never adds rows."""
    ids = other.select(F.col(other_key or key).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    return df.join(ids.withColumn(flag, F.lit(True)), F.col(key) == F.col("_id"), "left").drop("_id")


def join_by_name(df: DataFrame, other: DataFrame, left: str, right: str, how: str = "left") -> DataFrame:
    """Join on a natural text key, ignoring case and trailing blanks."""
    return df.join(other, text_key(F.col(left)) == text_key(F.col(right)), how)


def join_top_level(df: DataFrame, hierarchy: DataFrame, key: str) -> DataFrame:
    """Rows of a top-level node paired with every node below it (``id``, ``root_id``), itself included.

    Further columns of ``hierarchy`` come along with the node.
    """
    further = [c for c in hierarchy.columns if c not in ("id", "root_id")]
    nodes = hierarchy.select(F.col("id").alias("node_id"), F.col("root_id").alias("_root"), *further)
    return df.join(nodes, F.col(key) == F.col("_root"), "inner").drop("_root")


def attach_default(df: DataFrame, contacts: DataFrame, defaults: DataFrame, key: str = "request_id") -> DataFrame:
    """Attach to each row its contacts that are listed as default (``key``, ``contact_id``); others drop out."""
    current = defaults.select(F.col(key), F.col("contact_id").alias("id")).distinct()
    return df.join(contacts.join(current, [key, "id"], "left_semi"), key, "inner")


def price_at(
    facts: DataFrame,
    prices: DataFrame,
    keys: Sequence[str],
    day: str,
    as_of: date | datetime,
    out: str = "price",
) -> DataFrame:
    """Attach the price valid on ``day`` (``as_of`` when NULL) for equal text ``keys``; at most one per row.

    Prices are first reduced to one per key and validity window (the lowest). The windows of a key, whose
    number the calendar bounds, are kept in one array, so each fact meets at most one row and is neither
    multiplied nor shuffled again. Of several valid windows the latest start wins, an open start last.
    """
    windows = (
        prices.filter(F.col("price").isNotNull())
        .groupBy(*[text_key(F.col(k).cast("string")).alias(f"_{k}") for k in keys], "valid_from", "valid_to")
        .agg(F.min("price").alias("price"))
        .groupBy(*[f"_{k}" for k in keys])
        .agg(F.sort_array(F.collect_list(F.struct("valid_from", "valid_to", "price")), asc=False).alias("_windows"))
    )
    on = reduce(lambda a, b: a & b, [text_key(F.col(k).cast("string")) == F.col(f"_{k}") for k in keys])
    when = F.date_format(F.coalesce(F.col(day).cast("date"), F.lit(as_of).cast("date")), "yyyyMMdd")
    valid = F.filter(
        "_windows", lambda w: valid_at(when, w["valid_from"], F.concat(F.left(w["valid_to"], F.lit(6)), F.lit("31")))
    )
    return (
        facts.join(windows, on, "left")
        .withColumn(out, F.get(valid, F.lit(0))["price"])
        .drop("_windows", *[f"_{k}" for k in keys])
    )
