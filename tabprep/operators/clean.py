"""Row and column cleansing. Every function is ``DataFrame -> DataFrame`` and lazy."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions import text
from tabprep.functions.columns import missing, numeric_columns, present

# Default bounds of the listings clean-up.
PRICE_LOW, PRICE_HIGH = 0.0, 250.0
MAX_NIGHTS = 365
HIGH_PRICE_FROM = 150.0


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep ``names`` only; the scan below reads nothing else."""
    return df.select(*names)


def clean_currency(df: DataFrame, column: str, symbols: str = "$,") -> DataFrame:
    """Replace currency text by its number; text that is no number becomes null."""
    return df.withColumn(column, text.currency_to_double(F.col(column), symbols))


def filter_open_range(df: DataFrame, column: str, low: float = PRICE_LOW, high: float = PRICE_HIGH) -> DataFrame:
    """Keep values strictly between the bounds; null is not between anything.

    No separate null test: Spark would parse a derived column once more for it.
    """
    c = F.col(column)
    return df.filter((c > low) & (c < high))


def filter_upper_bound(df: DataFrame, column: str, high: float = MAX_NIGHTS) -> DataFrame:
    """Drop outliers above ``high``, and nulls with them."""
    return df.filter(F.col(column) <= high)


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    """Keep rows for which an SQL predicate is true."""
    return df.filter(predicate)


def cast_numbers_to_double(
    df: DataFrame, columns: Iterable[str] | None = None, spare: Iterable[str] = ()
) -> DataFrame:
    """All numeric columns (or the given ones) to double, in one projection.

    Name keys in ``spare``: a double holds whole numbers exactly only up to 2 to the 53.
    """
    names = list(columns) if columns is not None else numeric_columns(df, spare)
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def add_missing_flags(df: DataFrame, columns: Sequence[str], suffix: str = "_na") -> DataFrame:
    """A 1.0/0.0 column per input column telling whether its value was missing (null or NaN)."""
    return df.withColumns({n + suffix: F.when(missing(df, n), 1.0).otherwise(0.0) for n in columns})


def binary_label(
    df: DataFrame, source: str, label: str, threshold: float = HIGH_PRICE_FROM, drop_source: bool = True
) -> DataFrame:
    """1.0 from ``threshold`` up, 0.0 below, null for null and NaN; the source column goes."""
    out = df.withColumn(label, (present(df, source) >= threshold).cast("double"))
    return out.drop(source) if drop_source else out


def split_by_substring(df: DataFrame, column: str, part: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text contains ``part`` and rows whose text does not; null is in neither."""
    has = F.col(column).contains(part)
    return df.filter(has), df.filter(~has)


def mark_by_substring(df: DataFrame, column: str, part: str, flag: str, yes: str, no: str) -> DataFrame:
    """The same two groups as a column of one frame, so the input is read once."""
    has = F.col(column).contains(part)
    return df.filter(has.isNotNull()).withColumn(flag, F.when(has, yes).otherwise(no))


def repair_ssn(df: DataFrame, column: str = "ssn", keep_null: bool = False) -> DataFrame:
    """Bring plain and hyphenated numbers to one format in a single pass.

    Rows without a number are dropped unless ``keep_null`` is set.
    """
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return rows.withColumn(column, text.canonical_ssn(F.col(column)))


def title_case_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({n: text.title_case(F.col(n)) for n in columns})


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows. Copies collapse before the shuffle, so a heavily copied row stays cheap."""
    return df.dropDuplicates()


def anonymize_columns(
    df: DataFrame, texts: Sequence[str] = (), amounts: Sequence[str] = (), digits: int = 2, salt: str | None = None
) -> DataFrame:
    """SHA-256 of text columns and of amounts, the latter in a fixed number format first."""
    out = {n: text.anonymize(F.col(n).cast("string"), salt) for n in texts}
    out |= {n: text.anonymize(text.fixed_decimal_text(F.col(n), digits), salt) for n in amounts}
    return df.withColumns(out)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null (or NaN) in the given columns, or in any."""
    return df.na.drop(subset=list(columns) if columns else None)


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, copies kept."""
    for other in others:
        first = first.unionByName(other)
    return first


def fill_constants(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    """Replace missing values by a constant per column, such as 0.0 or ``absent``."""
    return df.withColumns({n: F.when(missing(df, n), F.lit(v)).otherwise(F.col(n)) for n, v in values.items()})
