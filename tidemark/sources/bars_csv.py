"""Price bars kept as CSV, one file (or one dataset folder) per ticker, in mixed layouts.

Files in one folder differ in their header: a plain ``Date,Open,High,Low,Close,Volume``, or a
three-row header whose first column is called ``Price`` and whose next two rows repeat the
ticker and hold a lone ``Date``. Column order differs too, and Spark maps CSV columns by
position when one read covers several headers. So the cells are read by position, without
header and without inference, each file's own header line, looked for at the beginning of the file, says where
its fields are, and the fields are then taken by name. There are as many cells as the widest header
has names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.cleaning import to_day, to_number
from tidemark.plans.staging import stored

# Names a date column goes by, and the fields of a bar.
DATE_NAMES = ("date", "price", "timestamp", "datetime")
FIELDS = ("open", "high", "low", "close", "volume")

# ``.../SNDK.csv``, ``.../SNDK.csv/part-0.csv`` and ``.../file=SNDK.csv/part-0.csv`` all give SNDK.
# Other files in a folder named ``x.csv`` go by their own names.
TICKER_IN_PATH = r"([^/=]+)\.csv(?:/part-[^/]*)?$"


def ticker_from_path(path: Column | None = None) -> Column:
    """Ticker named by the source file; paths are URL-encoded, so ``B%20B.csv`` gives ``B B``."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.url_decode(F.regexp_extract(path, TICKER_IN_PATH, 1))


def read_bars_csv(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All CSV files under ``folder`` as canonical bars; rows without a date or close are dropped.

    Reading the header lines costs a scan of the lines as text. ``columns``, the names in file order,
    saves it where all files are known to agree. A file with rows but without a header that names a
    date and a close fails the job.
    """
    if columns is None:
        places = stored(_field_places(spark, folder), "headers")
        width = places.agg(F.max("width")).first()[0] or 1
    else:
        width = len(columns)
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    raw = (
        spark.read.schema(schema).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").csv(folder)
    )
    lines = raw.select(F.array(*(f"c{i}" for i in range(width))).alias("cells"),
                       F.col("_metadata.file_path").alias("path"))
    if columns is None:
        # One short row per file, from a table whose size Catalyst knows.
        rows = lines.join(places, "path", "left")
        unknown = F.raise_error(F.concat(F.lit("no header with a date and a close in "), F.col("path"))).cast("boolean")
        rows = rows.where(F.when(F.col("width").isNull(), unknown).otherwise(True))
    else:
        names = F.array(*(F.lit(name.strip().lower()) for name in columns))
        rows = lines.withColumns(_places(names))

    def field(name: str) -> Column:
        return F.get("cells", F.col(name) - 1)

    return rows.select(
        ticker_from_path(F.col("path")).alias("company"),
        to_day(field("date")).alias("dt"),
        *(to_number(field(name)).alias(name) for name in FIELDS),
    ).dropna(subset=["dt", "close"])


def _places(names: Column) -> dict[str, Column]:
    """1-based place of each field among lower-case names (0 or NULL where it is missing)."""
    places = {name: F.array_position(names, name) for name in FIELDS}
    places["date"] = F.coalesce(*(
        F.nullif(F.array_position(names, name), F.lit(0).cast("long")) for name in DATE_NAMES))
    return places


def _field_places(spark: SparkSession, folder: str) -> DataFrame:
    """The places of the fields in each file's header line, and its number of names."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(folder)
    cells = F.transform(F.split("value", ","), lambda cell: F.lower(F.trim(F.trim(cell), F.lit('"'))))
    known_dates = F.array(*map(F.lit, DATE_NAMES))
    headers = (
        text.where((F.col("_metadata.file_block_start") == 0) & F.lower("value").contains("close"))
        .select(F.col("_metadata.file_path").alias("path"), cells.alias("names"))
        .where(F.array_contains("names", "close") & F.arrays_overlap("names", known_dates))
    )
    places = _places(F.col("names"))
    return headers.groupBy("path").agg(
        F.max(F.size("names")).alias("width"), *(F.max(place).alias(name) for name, place in places.items()))


def write_bars_csv(bars: DataFrame, folder: str, date_name: str = "Date",
                   fields: tuple[str, ...] = FIELDS, mode: str = "overwrite") -> None:
    """Write one CSV dataset folder per ticker, with the given column order, replacing ``folder``.

    A ticker's rows are dealt by year, so it has a file per year at most and no ticker is one task.
    """
    names = {name: name.capitalize() for name in fields}
    (
        bars.repartition("company", F.year("dt"))
        .select(F.concat(F.col("company"), F.lit(".csv")).alias("file"),
                F.col("dt").alias(date_name), *(F.col(n).alias(title) for n, title in names.items()))
        .write.mode(mode).partitionBy("file").option("header", True).csv(folder)
    )
