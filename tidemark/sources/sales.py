"""Reading sales files and bringing their columns onto the canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.coerce import is_text
from tidemark.schema import (DEFAULT_PRICE, DEFAULT_PROMO, DEFAULT_SKU, DEFAULT_UNITS, NA_TOKENS,
                             NARROW_ALIASES, WIDE_ALIASES)


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def read_sales(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header (every column text, no inference pass) or a Parquet folder.

    Quoted cells may hold line ends; a file is then read by one task, and files side by side. ``multi_line=False`` splits
    large files that are known to hold none.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return blank_missing(raw)


def blank_missing(df: DataFrame) -> DataFrame:
    """Turn the usual missing-value spellings of text columns into NULL."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    cells = [
        (F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) if is_text(plain, c) else F.col(c)).alias(name)
        for c, name in zip(plain.columns, df.columns)]
    return plain.select(*cells)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trimmed lower-case headers; a repeated header gets a numeric suffix."""
    seen: dict[str, int] = {}
    names = []
    for header in df.columns:
        name = header.strip().lower()
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def apply_aliases(df: DataFrame, aliases: dict[str, list[str]] = WIDE_ALIASES) -> DataFrame:
    """Rename known header spellings. When several spellings of one target are present, the
    first in the list is used and the others keep their names."""
    chosen = {}
    for target, spellings in aliases.items():
        source = next((s for s in spellings if s in df.columns), None)
        if source is not None:
            chosen[source] = target
    return df.select(*[_quoted(c).alias(chosen.get(c, c)) for c in df.columns])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def fill_default_columns(df: DataFrame) -> DataFrame:
    """Add the optional columns a file does not have."""
    defaults = {
        "sku_id": F.lit(DEFAULT_SKU),
        "units_sold": F.lit(DEFAULT_UNITS).cast("bigint"),
        "price": F.lit(DEFAULT_PRICE),
        "promotion_flag": F.lit(DEFAULT_PROMO),
    }
    return df.withColumns({n: v for n, v in defaults.items() if n not in df.columns})


def canonical_columns(df: DataFrame, aliases: dict[str, list[str]] = WIDE_ALIASES,
                      required: tuple[str, ...] = ("date",)) -> DataFrame:
    """Headers, aliases, the required-column gate and defaults; only useful columns are kept."""
    named = require_columns(apply_aliases(normalize_headers(df), aliases), list(required))
    filled = fill_default_columns(named)
    keep = ["date", "sku_id", "units_sold", "price", "promotion_flag"]
    if "status" in filled.columns:
        keep.append("status")
    return filled.select(*keep)


def history_columns(df: DataFrame) -> DataFrame:
    """The forecast entry point: narrow spellings, quantity mandatory."""
    return canonical_columns(df, NARROW_ALIASES, ("date", "units_sold"))
