"""Column expressions and schema-driven column operations (P*, F*, E8-E11, C6-C8).

All of these are Catalyst expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "flag", "innings_key", "over_number", "ball_in_over", "ball_facts", "first_of", "last_of",
    "parse_date", "first_map_entry", "nested_json_value", "opponent", "declared_flag",
    "rename_columns", "normalise_name", "drop_prefixed", "columns_of_type", "string_columns",
    "cast_timestamps_to_date", "cast_to_schema", "replace_values", "blank_to_null",
    "match_type_fix",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- scalar functions -----------------------------------------------------------------

def flag(cond: Column) -> Column:
    """Boolean condition -> 1/0 int; a null condition gives 0 (like when/otherwise)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def innings_key(match_col="match_id", innings_col="innings") -> Column:
    """`<match>_<first char of innings name>`; null if either part is null."""
    return F.concat(_c(match_col), F.lit("_"), F.substring(_c(innings_col), 1, 1))


def over_number(delivery="delivery") -> Column:
    """truncating double -> bigint, plus one."""
    return _c(delivery).cast("bigint") + F.lit(1)


def ball_in_over(delivery="delivery") -> Column:
    """ball number from the decimal part, rounded half-up."""
    d = _c(delivery)
    return F.round((d - d.cast("bigint")) * F.lit(10)).cast("bigint")


def ball_facts(df: DataFrame, delivery="delivery", runs="batter_runs",
               wicket="wicket_type", six_at: int = 6) -> DataFrame:
    """Over, ball and per-ball flags in one projection.

    A wicket is a non-null, non-blank wicket type (decision D1).
    """
    w = _c(wicket)
    return df.withColumns({
        "over": over_number(delivery),
        "ball": ball_in_over(delivery),
        "wickets": flag(w.isNotNull() & (w != F.lit(""))),
        "six": flag(_c(runs) >= F.lit(six_at)),
        "four": flag(_c(runs).between(4, 5)),
    })


def first_of(arr) -> Column:
    """First element or null (never raises under ANSI)."""
    return F.try_element_at(_c(arr), F.lit(1))


def last_of(arr) -> Column:
    """Last element or null."""
    return F.try_element_at(_c(arr), F.lit(-1))


def parse_date(x) -> Column:
    """`YYYY-MM-DD` text, or the whole of an ISO timestamp text, -> date; anything else is null."""
    v = _c(x)
    stamp = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.try_to_timestamp(v).cast("date"))
    return F.coalesce(F.try_to_date(v, "yyyy-MM-dd"), stamp)


def first_map_entry(m) -> Column:
    """First (key, value) entry of a map in document order, or null."""
    return F.get(F.map_entries(_c(m)), F.lit(0))


def nested_json_value(text, keys: Iterable[str], default=None) -> Column:
    """Value at a key path inside JSON text; null (or default) when any step is absent."""
    path = "$" + "".join(f"['{k}']" for k in keys)
    v = F.get_json_object(_c(text), path)
    return v if default is None else F.coalesce(v, F.lit(default))


def opponent(teams, team, unknown: str = "Unknown") -> Column:
    """First team that is not `team` (null-safe inequality), else `unknown`."""
    t = _c(team)
    others = F.filter(_c(teams), lambda x: ~x.eqNullSafe(t))
    return F.coalesce(F.get(others, F.lit(0)), F.lit(unknown))


def declared_flag(x) -> Column:
    """E5: case-insensitive `yes` -> 1 else 0. A bare YAML yes arrives as `true`."""
    v = F.lower(_c(x))
    return F.when(v.isin("yes", "true"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


# -- schema-driven column operations ----------------------------------------------------

def normalise_name(name: str) -> str:
    """P4 rule: lower case, spaces -> underscores."""
    return name.lower().replace(" ", "_")


def rename_columns(df: DataFrame, fn: Callable[[str], str] = normalise_name) -> DataFrame:
    """Rename every column by a function."""
    return df.toDF(*[fn(c) for c in df.columns])


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Drop every column whose name starts with `prefix`."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    """Names of the columns whose type is one of `types`."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def string_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


def cast_timestamps_to_date(df: DataFrame) -> DataFrame:
    """Every timestamp / timestamp_ntz column -> date."""
    cols = columns_of_type(df, T.TimestampType, T.TimestampNTZType)
    return df.withColumns({c: F.col(c).cast("date") for c in cols}) if cols else df


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, each cast to its type."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_values(df: DataFrame, mapping: dict[str, str], subset: list[str] | None = None) -> DataFrame:
    """whole-value replacement over string columns (not substring)."""
    cols = subset if subset is not None else string_columns(df)
    if not cols or not mapping:
        return df
    out = {}
    for c in cols:
        e = F.col(c)
        expr = None
        for old, new in mapping.items():
            expr = (F.when(e == F.lit(old), F.lit(new)) if expr is None
                    else expr.when(e == F.lit(old), F.lit(new)))
        out[c] = expr.otherwise(e)
    return df.withColumns(out)


def blank_to_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """'' -> null over all string columns."""
    cols = subset if subset is not None else string_columns(df)
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols}) if cols else df


def match_type_fix(match_type="match_type", league="league",
                   from_type: str = "ODM", to_type: str = "ODI",
                   league_word: str = "international") -> Column:
    """`ODM` played in an international league becomes `ODI`; null league keeps it."""
    cond = (_c(match_type) == F.lit(from_type)) & F.lower(_c(league)).contains(league_word)
    return F.when(cond, F.lit(to_type)).otherwise(_c(match_type))
