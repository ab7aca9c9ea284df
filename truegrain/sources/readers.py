"""Tables, dictionaries, file listings and schemas as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.columns import free_name, ref


# No cell holds this text, so the reader takes nothing but missing cells for NULL.
_NO_TEXT = "\x01\x02"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    infer_types: bool = False,
    multiline: bool = False,
    keep_empty: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """A CSV table with a header; every column is text unless told otherwise.

    A declared schema saves the extra pass that ``infer_types`` costs. ``multiline``
    allows line breaks inside quotes, but then a file is read by a single task:
    store large tables of that kind as many files, or as Parquet. ``keep_empty`` tells
    a quoted empty text from nothing at all, as :func:`write_csv` writes them; without
    it both are NULL. A line with too few or too many cells is cut or filled with NULL, and
    so is a value that a declared type cannot hold; with ``keep_malformed`` such a line also
    stands whole in one more column, ``malformed_line``, which is NULL elsewhere: the test
    ``check_malformed`` counts these lines, and rejected rows keep them.
    """
    if keep_malformed and infer_types:
        raise RuleError("types cannot be inferred while malformed lines are kept; declare a schema")
    reader = spark.read.option("header", True).option("escape", '"')
    if keep_empty:
        reader = reader.option("nullValue", _NO_TEXT)
    if multiline:
        reader = reader.option("multiLine", True)
    if keep_malformed:
        if schema is None:
            schema = reader.option("inferSchema", False).csv(path).schema  # reads a header
        return _with_malformed(spark, reader, schema, path)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer_types).csv(path)


_MALFORMED = "truegrain.malformed_line"


def _with_malformed(spark: SparkSession, reader: DataFrameReader, schema: str | T.StructType, path: str) -> DataFrame:
    """The table with a marked column for the text of malformed lines."""
    known = spark.createDataFrame([], schema if isinstance(schema, str) else T.StructType(schema.fields))
    name = free_name(known, "malformed_line")
    # Without pruning every line is parsed whole, whichever columns a query needs.
    read = (
        reader.schema(T.StructType([*known.schema.fields, T.StructField(name, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", name)
        .option("columnPruning", False)
        .csv(path)
    )
    # The reader wants another column beside the line in every query, so one is part of it.
    there = F.concat_ws("", ref(name), ref(known.columns[0]).cast("string")) != ""
    line = F.when(ref(name).isNotNull() & there, ref(name))
    return read.select(*[ref(c) for c in known.columns], line.alias(name, metadata={_MALFORMED: True}))


def malformed_column(df: DataFrame) -> str:
    """The column in which :func:`read_csv` keeps malformed lines."""
    found = [f.name for f in df.schema.fields if f.metadata.get(_MALFORMED)]
    if len(found) != 1:
        raise RuleError("the table was not read with keep_malformed")
    return found[0]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, **csv_options) -> DataFrame:
    """A table by its file name: .csv as text columns, anything else as Parquet.

    ``csv_options`` are those of :func:`read_csv`.
    """
    if path.lower().endswith(".csv"):
        return read_csv(spark, path, **csv_options)
    return read_parquet(spark, path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A data dictionary sheet: text columns, descriptions may span lines."""
    return read_csv(spark, path, multiline=True)



def _matched_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that a path or glob names, or that hold the files it names, in full."""
    context = spark.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path(path)
    matched = named.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(named)
    found = {(m.getPath() if m.isDirectory() else m.getPath().getParent()).toString() for m in matched or []}
    return sorted(found)


def file_listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, file_name, length, modificationTime) of the files under ``path``.

    Only metadata is read, never file contents. Without ``recursive`` the files
    directly in the folder are listed.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true" if recursive else "false")
        .load(path)
        .select("path", "length", "modificationTime")
    )
    if not recursive:
        folders = _matched_folders(spark, path)
        listed = listed.where(F.regexp_replace("path", "/[^/]*$", "").isin(folders))
    return listed.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def schema_table(df: DataFrame) -> DataFrame:
    """(column_name, column_type, position) of the table, as data to join with."""
    rows = [(name, kind, i) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, column_type string, position int"
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """An operational table from CSV or Parquet, in the rule layout of the suite."""
    raw = read_csv(spark, path, multiline=True) if path.lower().endswith(".csv") else read_parquet(spark, path)
    return as_rules(raw)


# The columns of an operational table, and the older name of one.
RULE_COLUMNS = ("file_name", "tcid", "is_active", "critical", "test", "tested_field", "expected_value")
RULE_ALIASES = {"enabled": "is_active"}


def as_rules(raw: DataFrame) -> DataFrame:
    """Normalise column names and flags (1/0 or True/False) of an operational table."""
    found = {}
    for name in raw.columns:
        plain = name.strip().lower()
        found[RULE_ALIASES.get(plain, plain)] = name
    if missing := [c for c in ("tcid", "file_name", "test") if c not in found]:
        raise RuleError(f"the rule table lacks {', '.join(missing)}")

    def text(column: str):
        if column not in found:
            return F.lit(None).cast("string")
        return F.col(f"`{found[column]}`").cast("string")

    def flag(column: str, default: bool):
        return F.coalesce(text(column).try_cast("boolean"), F.lit(default))

    return raw.select(
        text("tcid").alias("tcid"),
        text("file_name").alias("file_name"),
        flag("is_active", True).alias("is_active"),
        flag("critical", False).alias("critical"),
        text("test").alias("test"),
        text("tested_field").alias("tested_field"),
        text("expected_value").alias("expected_value"),
    )
