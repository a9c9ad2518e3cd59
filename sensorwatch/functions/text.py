"""Text clean-up, number formatting, and control-message parsing."""

from pyspark.sql import Column, DataFrame, functions as F, types as T


# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_strings(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: strip(F.col(f"`{n}`")) for n in names}) if names else df


def lower_names(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    clashes = sorted({c for c in lowered if lowered.count(c) > 1})
    if clashes:
        raise ValueError(f"columns collide in lower case: {clashes}")
    return df.toDF(*lowered)


def require_columns(df: DataFrame, needed) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def name_positionally(df: DataFrame, names) -> DataFrame:
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def fixed_text(value: Column, digits: int = 3) -> Column:
    """Fixed number of decimals; exact halves go to the even digit, as in printf."""
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * digits))


def percent_text(ratio: Column, digits: int = 3) -> Column:
    return F.concat(fixed_text(ratio.cast("double") * 100, digits), F.lit("%"))


def announced_rows(message: Column) -> Column:
    """Row count of a `file_size:N` control message; NULL for any other message."""
    return F.nullif(F.regexp_extract(message, r"^file_size:(\d+)$", 1), F.lit("")).cast("long")
