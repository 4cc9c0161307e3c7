"""Projections, cleaning rules and look-ups on survey tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subset(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The columns that are keys of ``columns``, under their new names."""
    return df.select(*(F.col(old).alias(new) for old, new in columns.items()))


def tidy_names(df: DataFrame, suffixes: tuple[str, ...] = ("_mean", "_majority"), renamed: dict[str, str] | None = None) -> DataFrame:
    """Column names without statistic suffixes; then whole names replaced by ``renamed``."""
    end = re.compile("(" + "|".join(map(re.escape, suffixes)) + ")$")
    names = [end.sub("", c) for c in df.columns]
    return df.toDF(*((renamed or {}).get(n, n) for n in names))


def keep_left(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """A join in which columns present on both sides come from the left only."""
    return left.join(right.drop(*(c for c in right.columns if c in left.columns and c not in on)), on, how)


def keep_fields(df: DataFrame, keep: list[str]) -> DataFrame:
    """Only the listed columns, in the frame's order."""
    return df.select(*(c for c in df.columns if c in set(keep)))


def drop_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """All but the listed columns; names that are not there are passed over."""
    return df.drop(*fields)


def clean_number(text: Column) -> Column:
    """The number in a text; null where it holds a slash or star or does not parse."""
    return F.when(~text.rlike("[/*]"), text.try_cast("double"))


def clean_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each listed column cleaned on its own."""
    return df.withColumns({c: clean_number(F.col(c)) for c in columns})


def filled(text: Column, kind: str, sentinel) -> Column:
    """The value as ``kind``, or the sentinel where it is missing or does not parse."""
    return F.coalesce(text.try_cast(kind), F.lit(sentinel).cast(kind))


def filter_rows(df: DataFrame, column: str, values: list | None = None, null: bool | None = None) -> DataFrame:
    """Rows whose value is listed; or is null (``null`` True), or is not (False)."""
    test = F.lit(True)
    if values is not None:
        test &= F.col(column).isin(values)
    if null is not None:
        test &= F.col(column).isNull() if null else F.col(column).isNotNull()
    return df.filter(test)


def ids_ending(df: DataFrame, column: str, ends: list[str]) -> DataFrame:
    """Rows whose id, as text, ends in one of ``ends``."""
    test = F.lit(False)
    for e in ends:
        test |= F.col(column).cast("string").endswith(e)
    return df.filter(test)


def normal_rows(df: DataFrame, status: str, label: str, normal: str = "Normal", sentinel: float = 0.0001) -> DataFrame:
    """Training rows: normal status and a label that is not the sentinel."""
    return df.filter((F.col(status) == normal) & (F.col(label) != sentinel))


def finite_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every listed column is a finite number."""
    test = F.lit(True)
    for c in columns:
        v = F.col(c).cast("double")
        test &= v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return df.filter(test)


def impute(df: DataFrame, columns: list[str], method: str = "mean") -> DataFrame:
    """Nulls replaced by the column's mean or exact median; one aggregate row is broadcast."""
    stat = {"mean": F.avg, "median": F.median}[method]
    stats = df.agg(*(stat(c).alias(f"_{c}") for c in columns))
    return df.crossJoin(F.broadcast(stats)).withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}).drop(*(f"_{c}" for c in columns))


def forward_fill(df: DataFrame, columns: list[str], order: list, within: list[str]) -> DataFrame:
    """Nulls replaced by the last value before them in ``order`` inside each ``within`` group."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def look_up(df: DataFrame, key: Column, table: DataFrame, code: str, name: str, into: str, default: str | None = None) -> DataFrame:
    """``into``: the name that ``table`` has for the key, or the default; the table's codes are unique."""
    names = table.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    joined = df.withColumn("_key", key).join(names, F.col("_key") == F.col("_code"), "left")
    return joined.withColumn(into, F.coalesce("_name", F.lit(default)) if default is not None else F.col("_name")).drop("_key", "_code", "_name")


def names_of_codes(codes: Column, names: dict[str, str], sep: str = ",") -> Column:
    """A list of codes in a text as the list of their names; unknown codes give empty names."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.array_join(F.transform(F.split(codes, sep), lambda c: F.coalesce(table[c], F.lit(""))), sep)


def match_tuples(df: DataFrame, table: DataFrame, on: list[str], value: str, default: str) -> DataFrame:
    """``value`` from the row of ``table`` that agrees in all ``on`` columns, nulls counting as equal, else the default."""
    t = table.select(*(F.col(c).alias(f"_{c}") for c in on), F.col(value).alias("_value"))
    test = F.lit(True)
    for c in on:
        test &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(t, test, "left").withColumn(value, F.coalesce("_value", F.lit(default))).drop("_value", *(f"_{c}" for c in on))


def first_nonzero(*texts: Column) -> Column:
    """The first value that parses and is not zero, else 0."""
    return F.coalesce(*(F.nullif(t.try_cast("double"), F.lit(0.0)) for t in texts), F.lit(0.0))


# The first two digits of a land-use code and what they mean for soil typing.
LAND_KINDS = {"非自然土": ["01", "02", "12"], "自然土": ["03", "04"], "建设用地": ["05", "06", "07", "08", "09", "10", "11"]}
PADDY_CODE, PADDY, UNCLASSED = "0101", "水稻土", "未分类"


def land_kind(code: Column) -> Column:
    """The soil-typing class of a land-use code; empty for an empty code."""
    head = F.substring(F.trim(code), 1, 2)
    kind = F.when(code.isNull() | (code == ""), "").when(F.trim(code) == PADDY_CODE, PADDY)
    for name, heads in LAND_KINDS.items():
        kind = kind.when(head.isin(heads), name)
    return kind.otherwise(UNCLASSED)


def normal_text(text: Column) -> Column:
    """Full-width brackets made half-width, white space runs made one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, "（）", "()"), r"\s+", " "))


def bracket_variants(df: DataFrame, name: str, into: str = "variant") -> DataFrame:
    """Distinct look-up rows: the name as it is, without brackets, and without what brackets hold."""
    n = F.col(name)
    forms = F.array(n, F.regexp_replace(n, r"[()]", ""), F.regexp_replace(n, r"\([^)]*\)", ""))
    return df.withColumn(into, F.explode(forms)).distinct()


def scale_by(df: DataFrame, area: str, totals: DataFrame, on: str, total: str) -> DataFrame:
    """``adjusted``: areas scaled so that they add up to the group's given total."""
    own = df.groupBy(on).agg(F.sum(area).alias("_own"))
    ratio = totals.join(own, on).select(on, (F.col(total) / F.col("_own")).alias("_ratio"))
    return df.join(ratio, on).withColumn("adjusted", F.col(area) * F.col("_ratio")).drop("_ratio")


# The eight directions of a slope and flat ground.
DIRECTIONS = ["北", "东北", "东", "东南", "南", "西南", "西", "西北"]


def aspect_class(degrees: Column) -> Column:
    """The direction of an aspect; flat for -1; an aspect of exactly 0 or beyond 360 is ``其它``."""
    out = F.when(degrees == -1, "平面")
    for i, name in enumerate(DIRECTIONS[1:], 1):
        out = out.when((degrees > 45 * i - 22.5) & (degrees <= 45 * i + 22.5), name)
    north = ((degrees > 0) & (degrees <= 22.5)) | ((degrees > 337.5) & (degrees <= 360))
    return out.when(north, DIRECTIONS[0]).otherwise("其它")


def describe_row(template: str, *columns: Column) -> Column:
    """A sentence from several columns; null columns read as empty."""
    return F.format_string(template, *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))


def short_hash(text: Column, size: int = 10) -> Column:
    """The first hex digits of the MD5 of a text."""
    return F.substring(F.md5(text.cast("binary")), 1, size)


def route(df: DataFrame, column: str, prefixes: list[str], into: str = "route") -> DataFrame:
    """``into``: the first prefix that the value starts with, else ``other``; every row has one route."""
    out = None
    for p in prefixes:
        test = F.coalesce(F.col(column).startswith(p), F.lit(False))
        out = F.when(test, p) if out is None else out.when(test, p)
    return df.withColumn(into, out.otherwise("other"))


# Land-use codes of the consistency rules and the bounds of the depth class.
NOT_FARMED = [13, 14, 17, 19, 21, 23, 24, 25, 26, 27, 28, 38, 40, 41]
PADDY_FIELDS = [1, 2, 30, 31, 32, 39]
NATURAL = [6, 7, 8, 9, 10, 11, 12, 20, 33, 35, 36]
THIN, MEDIUM = 0.5, 1.0


def consistency_flags(land: Column, order: Column, index: Column) -> dict[str, Column]:
    """Flags of a sample: not farmed; paddy soil on a paddy field; natural land; depth class 0 to 2 of a terrain index."""
    return {
        "not_farmed": F.coalesce(land.isin(NOT_FARMED), F.lit(False)).cast("int"),
        "paddy_ok": F.coalesce((order == PADDY) & land.isin(PADDY_FIELDS), F.lit(False)).cast("int"),
        "natural": F.coalesce(land.isin(NATURAL), F.lit(False)).cast("int"),
        "depth": F.when(index <= THIN, 0).when(index <= MEDIUM, 1).otherwise(2),
    }


def duplicate_class(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows, and the rows again under another class."""
    return df.unionByName(df.withColumn(column, F.lit(name)))
