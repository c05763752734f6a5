"""Column expressions that clean and parse raw values. No UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def entity_id(c: Column | str) -> Column:
    """Lower-case and keep only ``[0-9a-z]``."""
    return F.regexp_replace(F.lower(_col(c)), "[^0-9a-z]", "")


def strip_quotes(c: Column | str) -> Column:
    """Remove one leading and one trailing double quote."""
    return F.regexp_replace(_col(c), '^"|"$', "")


def not_nullish(c: Column | str) -> Column:
    """True unless NULL, empty, or the text ``null``."""
    return _col(c).isNotNull() & ~_col(c).isin("null", "")


def part(c: Column | str, index: int, sep: str = "\t") -> Column:
    """The ``index``-th field of a delimited text, NULL when absent."""
    return F.get(F.split(_col(c), "\\Q" + sep + "\\E"), F.lit(index))


def safe_split(df: DataFrame, column: str, fields: Mapping[str, tuple[int, str]], sep: str = "\t",
               keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of a delimited text; a row with any unreadable field is dropped.

    ``fields`` maps the output name to ``(position, type)``.
    """
    parsed = df.select(
        *keep,
        *[part(column, pos, sep).try_cast(kind).alias(name) for name, (pos, kind) in fields.items()],
    )
    return parsed.dropna(subset=list(fields))


def with_defaults(df: DataFrame, column: str, fields: Mapping[str, tuple[int, str]], sep: str = "\t",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Text fields of a delimited text with a default for each absent one.

    ``fields`` maps the output name to ``(position, default)``.
    """
    return df.select(
        *keep,
        *[F.coalesce(part(column, pos, sep), F.lit(default)).alias(name) for name, (pos, default) in fields.items()],
    )


_JSON_DEFAULTS = {"string": None, "int": 0, "bigint": 0, "double": 0.0, "boolean": False}


def json_fields(c: Column | str, fields: Mapping[str, str]) -> list[Column]:
    """Typed top-level JSON getters; an absent or unreadable value gives the type's default.

    Strings default to NULL, numbers to zero, booleans to false, arrays to an empty array.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    parsed = F.from_json(_col(c), schema, {"mode": "PERMISSIVE"})
    out = []
    for name, kind in fields.items():
        value = parsed.getField(name)
        if kind.startswith("array"):
            value = F.coalesce(value, F.array().cast(kind))
        elif _JSON_DEFAULTS.get(kind) is not None:
            value = F.coalesce(value, F.lit(_JSON_DEFAULTS[kind]).cast(kind))
        out.append(value.alias(name))
    return out


def extract_fields(c: Column | str, key: str, value_pattern: str = '([^,"]*)') -> Column:
    """Distinct values of every ``"key":"value"`` in a raw text, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(f'"{key}":"{value_pattern}'), F.lit(1)))


def key_value(c: Column | str) -> Column:
    """Value of a ``key:value`` text, NULL when there is no colon."""
    return part(c, 1, ":")


def bracket_list(c: Column | str) -> Column:
    """Items of a ``[a,b,c]`` text without empty ones."""
    items = F.split(F.regexp_replace(_col(c), r"[\[\]]", ""), ",")
    return F.filter(items, lambda x: x != "")


def translate(c: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """Replace a value by its code from a fixed table; anything else gives ``default``."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(default))


def distinct_values(c: Column | str) -> Column:
    """Distinct non-NULL values of an array of arrays, kept as an array."""
    return F.array_distinct(F.array_compact(F.flatten(_col(c))))


def has_any(c: Column | str, values: Sequence[str]) -> Column:
    """True if the array holds at least one of ``values``."""
    return F.coalesce(F.arrays_overlap(_col(c), F.array(*[F.lit(v) for v in values])), F.lit(False))


def size_between(c: Column | str, at_least: int | None = None, below: int | None = None) -> Column:
    """True if ``at_least <= size(array) < below``; NULL arrays have size 0."""
    size = F.coalesce(F.size(_col(c)), F.lit(0))
    test = F.lit(True)
    if at_least is not None:
        test = test & (size >= at_least)
    if below is not None:
        test = test & (size < below)
    return test


def fill_location(df: DataFrame, lng: str = "rlng", lat: str = "rlat", spare_lng: str = "lng",
                  spare_lat: str = "lat", flag: str = "from_pool") -> DataFrame:
    """Replace a NaN coordinate by the spare one and record that this happened."""
    return df.withColumns({
        flag: F.isnan(lng) | F.isnan(lat),
        lng: F.nanvl(F.col(lng), F.col(spare_lng)),
        lat: F.nanvl(F.col(lat), F.col(spare_lat)),
    })
