"""Text columns with the comparison rules of the reports: case and trailing blanks do not matter, NULL concatenates as ''."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(col: Column) -> Column:
    """The value by which two texts count as equal."""
    return F.lower(F.rtrim(col))


def same_text(col: Column, *values: str) -> Column:
    """``col`` equals one of ``values``; NULL stays NULL."""
    return text_key(col).isin(*[v.rstrip(" ").lower() for v in values])


def text_length(col: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col))


def glue(*cols: Column) -> Column:
    """Concatenation in which NULL counts as ''."""
    return F.concat_ws("", *cols)


def text_or(col: Column, default: Column | str | None) -> Column:
    """``col`` when it holds more than one character, else ``default``."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(text_length(col) > 1, col).otherwise(fallback)


def first_present(*cols: Column) -> Column:
    return F.coalesce(*cols)


def stuff(col: Column, start: int, length: int, new: str) -> Column:
    """Replace ``length`` characters from position ``start`` (1-based)."""
    return F.overlay(col, F.lit(new), F.lit(start), F.lit(length))


def as_int(col: Column) -> Column:
    """Whole number, or NULL for any other text."""
    return col.try_cast("int")


def is_numeric(col: Column) -> Column:
    """True for text of sign, digits, point and exponent that reads as a number; false for NULL, NaN, 5f and the like."""
    return F.coalesce(col.cast("string").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), F.lit(False))


def presence_label(col: Column, present: str, absent: str) -> Column:
    """Whether an optional match was found."""
    return F.when(col.isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def escape_markup(col: Column) -> Column:
    """The entities that XML serialisation writes for ``&``, ``<`` and ``>``."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(raw), F.lit(entity))
    return col


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace each ``{TOKEN}`` in turn; a missing value becomes ''."""
    for token, value in values.items():
        template = F.replace(
            template, F.lit("{" + token + "}"), F.coalesce(value.cast("string"), F.lit(""))
        )
    return template


def render_template(
    df: DataFrame, templates: Mapping[str, str | Column], values: Mapping[str, Column]
) -> DataFrame:
    """Add one rendered column per template (for example ``title`` and ``body``)."""
    rendered = {
        name: fill_template(t if isinstance(t, Column) else F.lit(t), values)
        for name, t in templates.items()
    }
    return df.withColumns(rendered)


def select_as(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Projection with new names: ``{new name: column or expression}``."""
    picked: Sequence[Column] = [
        (F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in mapping.items()
    ]
    return df.select(*picked)
