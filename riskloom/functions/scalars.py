"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell contents that count as missing when a text file is read.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Patterns applied in order when review text is cleaned.
TEXT_NOISE = [r"https?://\S+|www\.\S+", r"<[^>]+>", r"[^a-z0-9\s!?']", r"\s+"]
# Date layouts tried after ISO.
DATE_LAYOUTS = ["M/d/yyyy", "yyyy/M/d", "d-MMM-yyyy", "MMM d, yyyy", "d MMM yyyy"]


def clean_text(text: Column) -> Column:
    """Lower-case text without URLs, tags and rare symbols; missing text is ''."""
    out = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    for pattern in TEXT_NOISE:
        out = F.regexp_replace(out, pattern, " ")
    return F.trim(out)


def normalize_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name.cast("string")), "[^a-z0-9]", "")


def slugify(name: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(name)), r"\s+", "_")


def humanize_feature(name: Column) -> Column:
    """`numeric__usage_frequency` reads as `usage frequency`."""
    return F.trim(F.replace(F.regexp_replace(name, r"^.*?__", ""), F.lit("_"), F.lit(" ")))


def join_readable(items: Column) -> Column:
    """An array of names as `a, b and c`."""
    n = F.size(items)
    return (
        F.when(n <= 0, F.lit("several factors"))
        .when(n == 1, F.try_element_at(items, F.lit(1)))
        .otherwise(
            F.concat(
                F.concat_ws(", ", F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(0)))),
                F.lit(" and "),
                F.try_element_at(items, F.lit(-1)),
            )
        )
    )


def normalize_na(value: Column) -> Column:
    """Placeholder cells become NULL; a cell with blanks around the placeholder is kept."""
    return F.when(value.isin(NA_TOKENS), None).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def parse_number(value: Column) -> Column:
    """Text as a double, NULL if it is not one; Java's `5d` / `5f` suffixes are not numbers."""
    text = value.cast("string")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def parse_date(value: Column) -> Column:
    """Text as a timestamp: ISO first, then the common export layouts."""
    text = F.trim(value.cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in DATE_LAYOUTS]
    return F.coalesce(*tries)


def finite_or(value: Column, default: float) -> Column:
    """A number, or `default` where it is missing, text, NaN or infinite."""
    number = parse_number(value)
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(usable, number).otherwise(F.lit(float(default)))


def clip01(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def safe_signal(value: Column, default: float) -> Column:
    return clip01(finite_or(value, default))


def half_even(value: Column, digits: int) -> Column:
    """Rounded as a binary fraction is: scaled, to the nearest whole number, ties to even."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def half_even_int(value: Column) -> Column:
    return F.bround(value, 0).cast("bigint")


def percent_text(value: Column) -> Column:
    """0.425 as `42%`; ties go to the even number."""
    return F.concat(half_even_int(value * 100).cast("string"), F.lit("%"))


def one_decimal_percent_text(value: Column) -> Column:
    return F.concat(F.bround(value * 100, 1).cast("decimal(20,1)").cast("string"), F.lit("%"))


def mask_id(value: Column) -> Column:
    return F.concat(F.substring(value.cast("string"), 1, 10), F.lit("…"))


def anonymize_id(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def seeded_key(seed: int, *parts: Column) -> Column:
    """Hex digest giving every row a stable pseudo-random position for a seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
