"""File sources: raw CSV exports (all columns read as strings, required
columns checked, canonical names, rejected records beside the rows) and the
written panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.config import LICENSE_HEADER_MAP, LICENSE_METADATA_HEADER_MAP, REQUEST_HEADER_MAP

#: A field of a CSV record, quoted or plain.
_FIELD = r'(?:^|,)(?:"[^"]*+(?:""[^"]*+)*+"|[^,]*+)'
_RECORD = "_record"


@dataclass(frozen=True)
class SourceRead:
    """``rows`` under canonical names; ``rejects`` (file, first_field, record, n_fields)."""

    rows: DataFrame
    rejects: DataFrame


def has_multiline_fields(spark: SparkSession, path: str) -> bool:
    """Whether a line holds an odd number of quotes, as the first line of a
    field with a line break does."""
    lines = spark.read.text(path)
    return not lines.where((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).isEmpty()


def _fields(record: Column) -> Column:
    return F.regexp_count(record, F.lit(_FIELD))


LICENSE_REQUIRED = tuple(LICENSE_HEADER_MAP)
REQUEST_REQUIRED = tuple(REQUEST_HEADER_MAP)
METADATA_REQUIRED = ("Business Unique ID", "Latitude", "Longitude", "Borough")
#: Panel columns that hold degrees.
_DEGREES = ("business_latitude", "business_longitude", "location_cluster_lat", "location_cluster_lng", "latitude", "longitude")


def read_source(spark: SparkSession, path: str, header_map: dict, required, multi_line: bool | None = None) -> SourceRead:
    """Header CSV, every column a string (ids such as ``007`` stay text);
    only the mapped columns are kept, renamed to canonical names.  Quoted
    fields may hold commas and doubled quotes.

    Fields with line breaks need ``multi_line``, which reads a file in one task.  Files are
    split otherwise, however large.  None looks for such fields first and
    asks for it only where there are any.  Records with more fields than the header
    are rejected; the missing fields of shorter ones are null.
    """
    if multi_line is None:
        multi_line = has_multiline_fields(spark, path)
    reader = lambda: spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names = reader().csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} is missing required columns: {missing}")
    kind = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, _RECORD])
    # the parser must see whole records, else it can't tell their length
    raw = reader().schema(kind).option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False).csv(path)
    # a null-safe condition: one on the record itself would be handed to the parser, which sees no record yet
    # Spark refuses to read the record alone, so the condition names a field, too (no text sorts before "")
    field = F.coalesce(F.col(f"`{names[0]}`"), F.lit("")) >= F.lit("")
    long = field & (F.coalesce(_fields(F.col(_RECORD)), F.lit(0)) > len(names))
    rows = raw.where(~long).select(*[F.col(f"`{src}`").alias(dst) for src, dst in header_map.items() if src in names])
    rejects = raw.where(long).select(
        F.col("_metadata.file_path").alias("file"), F.col(f"`{names[0]}`").alias("first_field"), F.col(_RECORD).alias("record"),
        _fields(F.col(_RECORD)).alias("n_fields"),
    )
    return SourceRead(rows, rejects)


def read_source_csv(spark: SparkSession, path: str, header_map: dict, required, multi_line: bool | None = None) -> DataFrame:
    """The rows of ``read_source``."""
    return read_source(spark, path, header_map, required, multi_line).rows


def load_license_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The map's licence records: all mapped columns as text, with the
    record's position in file order."""
    rows = read_source_csv(spark, path, LICENSE_METADATA_HEADER_MAP, METADATA_REQUIRED)
    return rows.select(F.monotonically_increasing_id().alias("record_ordinal"), "*")


def load_source_data(spark: SparkSession, licenses_path: str, requests_path: str) -> tuple[DataFrame, DataFrame]:
    lic = read_source_csv(spark, licenses_path, LICENSE_HEADER_MAP, [c for c in LICENSE_REQUIRED if c not in ("License Type",)])
    req = read_source_csv(spark, requests_path, REQUEST_HEADER_MAP, REQUEST_REQUIRED)
    return lic, req


def _typed(column: str):
    """A CSV panel's column with its type: text keys, double coordinates, whole counts."""
    c = F.col(f"`{column}`")
    if column in ("business_id", "month"):
        return c
    number = c.try_cast("double")
    if column in _DEGREES:
        return number.alias(column)
    return number.try_cast("bigint").alias(column)


def scan_panel(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Written panel; ``month`` parsed (bad -> NULL), ids as strings."""
    if fmt == "csv":
        df = spark.read.option("header", True).option("escape", '"').csv(path)
        df = df.select(*[_typed(c) for c in df.columns])
        df = df.withColumn("month", F.to_date(F.try_to_timestamp(F.col("month"), F.lit("yyyy-MM-dd"))))
    else:
        df = spark.read.parquet(path)
    if "year" in df.columns:
        df = df.drop("year")
    return df.withColumn("business_id", F.col("business_id").cast("string"))


def write_source_csv(df: DataFrame, path: str, header_map: dict, date_cols: dict) -> str:
    """Write canonical rows back in the raw export layout (raw header names,
    dates formatted as in the export) — used to exercise the CSV path."""
    inv = {v: k for k, v in header_map.items()}
    cols = []
    for c in df.columns:
        if c not in inv:
            continue
        v = F.date_format(F.col(c), date_cols[c]) if c in date_cols else F.col(c).cast("string")
        cols.append(v.alias(inv[c]))
    writer = df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path
