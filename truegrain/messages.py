"""Message texts of the status report."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording readers of the report rely on, one pair per test,
# first for a passed check, then for a failed one.
TEXTS: dict[str, tuple[str, str]] = {
    "check_nulls": (
        "Column '{field}' does not contain any null values.",
        "Column '{field}' contains {violations} null value(s).",
    ),
    "check_malformed": (
        "All lines of the file fit its columns.",
        "{violations} line(s) of the file do not fit its columns.",
    ),
    "count_records": (
        "Num of records in the file: {actual}. Success: the DataFrame has the expected number of records: {expected}",
        "Num of records in the file: {actual}. Mismatch: the DataFrame has {actual} records, but {expected} were expected.",
    ),
    "check_duplicates": (
        "No duplicates found in the specified key columns.",
        "Duplicate records found based on keys {field}: {violations} duplicates. Surplus rows: {surplus}.",
    ),
    "duplicated_files_by_name_and_size": (
        "No duplicate files found.",
        "Duplicated files found: {violations}. First: {first}",
    ),
    "duplicated_files_current_path": (
        "No duplicate files found.",
        "Duplicated files found: {violations}. First: {first}",
    ),
    "find_duplicate_columns": (
        "No duplicate columns found.",
        "Duplicate columns found: {groups}",
    ),
    "check_consistency": (
        "Consistency check passed for column: {field}.",
        "Number of mismatched rows: {pairs}",
    ),
    "check_foreign_key": (
        "The foreign key values are valid.",
        "Invalid foreign key values in {field} : {violations} rows",
    ),
    "dtype_consistency": (
        "All values in column '{field}' are consistent with the expected data type {expected}.",
        "Column '{field}' contains {violations} inconsistent values that don't match {expected}.",
    ),
    "validate_numeric_range": (
        "All values in '{field}' are within the range [{min}, {max}].",
        "{violations} values in '{field}' are out of range. "
        "Values below minimum ({min}): {below}, values above maximum ({max}): {above}.",
    ),
    "validate_values_length": (
        "All values lengths in column '{field}' are within the expected length.",
        "Column '{field}' contains {violations} invalid values.",
    ),
    "validate_allowed_values": (
        "All values in column '{field}' are valid according to the allowed values: {allowed}.",
        "Column '{field}' contains {violations} invalid values.",
    ),
    "validate_date_format": (
        "All {kind} values in column '{field}' are in the expected format '{format}'.",
        "There are {violations} invalid {kind} values in column '{field}'.",
    ),
    "file_timeliness": (
        "{files} file(s) up to date. Last modified {newest}",
        "{violations} of {files} file(s) stale. Last modified {oldest} (older than {hours} hours)",
    ),
    "validate_date_range": (
        "No late records: The column '{field}' has no records older than {duration} {unit}. "
        "No future records: The column '{field}' has no records beyond the current timestamp.",
        "{late} late records found in column '{field}' older than {duration} {unit}. "
        "{future} future records found in column '{field}' beyond the current timestamp.",
    ),
    "validate_sum": (
        "Actual sum of '{field}': {actual}. Result: The actual sum matches the expected sum: {expected}",
        "Actual sum of '{field}': {actual}. Result: Expected sum {expected}, but got {actual}",
    ),
    "moving_average": (
        "No significant deviation found.",
        "Significant deviation found in {field}. Maximum deviation: {deviation}%",
    ),
    "detect_outliers": (
        "No outliers found in '{field}'.",
        "{violations} outliers found in '{field}' outside [{lower}, {upper}].",
    ),
}
MISSING_FILE = "File {path} does not exist."


def fill(text: str, values: Mapping[str, object]) -> Column:
    """The text as a column, its placeholders filled with columns or plain values."""
    pattern, arguments = "", []
    for literal, name, _, _ in Formatter().parse(text):
        pattern += literal.replace("%", "%%")
        if name is None:
            continue
        if isinstance(values[name], Column):
            pattern += "%s"
            arguments.append(values[name].cast("string"))
        else:
            pattern += str(values[name]).replace("%", "%%")
    return F.format_string(pattern, *arguments) if arguments else F.lit(pattern.replace("%%", "%"))


def message_for(test: str, passed: Column, values: Mapping[str, object]) -> Column:
    good, bad = TEXTS[test]
    return F.when(passed, fill(good, values)).otherwise(fill(bad, values))
