"""Entity clean-up of an employee table: repair, match, deduplicate, anonymize."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabprep.operators.clean import anonymize_columns, dedup_rows, repair_ssn, title_case_columns


def clean_employees(df: DataFrame, keep_null: bool = False, salt: str | None = None) -> DataFrame:
    """One format for numbers and names makes copies equal; then they go, and private values are hashed.

    Hashing comes after the deduplication, so it is done once per person.
    """
    repaired = title_case_columns(repair_ssn(df, "ssn", keep_null), ["first_name"])
    return anonymize_columns(dedup_rows(repaired), texts=["ssn"], amounts=["salary"], salt=salt)
