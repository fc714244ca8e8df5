"""Grouped results: conditional counts, ordered text, volumes and inactivity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.text import escape_markup

LINES_PER_CHUNK = 1024


def count_distinct_if(condition: Column, col: Column) -> Column:
    """Distinct values of ``col`` among rows where ``condition`` holds."""
    return F.count_distinct(F.when(condition, col))


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    order: Sequence[str],
    separator: str,
    chunk: Column,
    descending: bool = False,
    name: str = "text",
) -> DataFrame:
    """Join the texts of each key in ``order``.

    ``chunk`` must rise with the first order column. Texts are sorted and joined per (key, chunk) first and
    the ready chunks are joined per key, so the sorting of a hot key is spread over its chunks and only its
    final text, which is the result, meets in one place.
    """
    way = "DESC" if descending else "ASC"

    def joined(column: str, by: Sequence[str]) -> Column:
        ranks = ", ".join(f"`{c}` {way}" for c in by)
        return F.expr(f"listagg(`{column}`, '{separator}') WITHIN GROUP (ORDER BY {ranks})")

    chunks = (
        df.filter(F.col(text).isNotNull())
        .withColumn("_chunk", chunk)
        .groupBy(*keys, "_chunk")
        .agg(joined(text, [*order, text]).alias("_part"))
    )
    return chunks.groupBy(*keys).agg(joined("_part", ["_chunk"]).alias(name))


def line_items_text(record: DataFrame, xml_escape: bool = False) -> DataFrame:
    """Line item numbers of each order, ascending, every record row listed: ``1\\n;2\\n;...``.

    Equal lines are counted before anything is collected, so copies of a row cost one counter.
    """
    return counted_lines_text(record.groupBy("po_number", "number_of_line_item").agg(F.count(F.lit(1)).alias("_n")), xml_escape)


def counted_lines_text(counted: DataFrame, xml_escape: bool = False) -> DataFrame:
    """The same from distinct lines ``po_number, number_of_line_item`` and how often they occur (``_n``)."""
    line = F.col("number_of_line_item").cast("string")
    if xml_escape:
        line = escape_markup(line)
    entry = F.concat(line, F.lit("\n"))
    # n copies of an entry, separated: n - 1 with the separator behind, one without
    repeated = F.concat(F.repeat(F.concat(entry, F.lit(";")), (F.col("_n") - 1).cast("int")), entry)
    # numbers of any kind are put into chunks by value, texts by their first characters: both rise with the order
    is_text = dict(counted.dtypes)["number_of_line_item"] == "string"
    chunk = F.left("number_of_line_item", F.lit(2)) if is_text else F.floor(F.col("number_of_line_item") / LINES_PER_CHUNK)
    lines = counted.withColumn("_entry", repeated)
    return ordered_text(lines, ["po_number"], "_entry", ["number_of_line_item"], ";", chunk, name="line_items_text")


def comment_history(comments: DataFrame, steps: DataFrame, xml_escape: bool = False) -> DataFrame:
    """Comments of each request, newest first: ``yyyy-MM-dd HH:mm - step - text``, separated by `` ;; ``.

    A comment without step keeps its date and text (see README, deviations).
    """
    body = F.concat(
        F.coalesce(F.date_format("created_at", "yyyy-MM-dd HH:mm"), F.lit("")),
        F.lit(" - "),
        F.coalesce(F.col("_step"), F.lit("")),
        F.lit(" - "),
        F.coalesce(F.concat("text", F.lit("\n")), F.lit("")),
    )
    if xml_escape:
        body = escape_markup(body)
    named = comments.join(
        steps.select(F.col("id").alias("step_id"), F.col("name").alias("_step")), "step_id", "left"
    ).withColumn("_body", body)
    return ordered_text(
        named, ["request_id"], "_body", ["created_at"], " ;; ", F.date_trunc("HOUR", "created_at"), descending=True, name="comment_history"
    )


def teams_by_volume(record: DataFrame, period: str, min_rows: int = 500) -> DataFrame:
    """Rows per team in the period, and whether that makes a large team."""
    return (
        record.filter((F.col("period") == period) & F.col("team_id").isNotNull())
        .groupBy("team_id")
        .agg(F.count("po_number").alias("n_rows"))
        .withColumn("is_large", F.col("n_rows") >= min_rows)
    )


def inactive_users(log: DataFrame, as_of: date | datetime, years: int = 1) -> DataFrame:
    """Users whose latest activity is not newer than ``years`` before ``as_of``.

    The cutoff is a literal, with the clock time of ``as_of`` kept and 29 February moved to the 28th.
    """
    try:
        cutoff = as_of.replace(year=as_of.year - years)
    except ValueError:
        cutoff = as_of.replace(year=as_of.year - years, day=28)
    limit = F.lit(cutoff.isoformat(sep=" ") if isinstance(cutoff, datetime) else cutoff.isoformat()).cast("timestamp_ntz")
    return (
        log.groupBy("created_by")
        .agg(F.max("created_at").alias("last_activity"))
        .filter(F.col("last_activity") <= limit)
    )
