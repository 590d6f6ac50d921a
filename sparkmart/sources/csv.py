"""CSV sources and sinks in the reference's file layout.

Every column is read as text (explicit schema, no inference) and typed later
with ``try_cast`` so a bad cell quarantines one row instead of failing the job.
Each reader adds ``src_pos``, the row's position in the input (file path,
split offset, row order inside the split); "first row wins" and "last row
wins" rules order by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schema

POS = "src_pos"


def with_source_position(df: DataFrame, fmt: str = "csv", streaming: bool = False) -> DataFrame:
    """Add ``src_pos``: sorting by it gives file order.

    Parquet exposes each row's index in its file.  Batch CSV uses the split
    start and an id that increases within the split (the id alone does not
    order rows across files).  A streaming CSV source knows the file and split
    only; ``batch_position`` adds the line order inside each micro-batch.
    """
    fields = [F.col("_metadata.file_path").alias("file")]
    if fmt == "parquet":
        fields.append(F.col("_metadata.row_index").alias("row"))
    else:
        fields.append(F.col("_metadata.file_block_start").alias("block"))
        if not streaming:
            fields.append(F.monotonically_increasing_id().alias("row"))
    return df.withColumn(POS, F.struct(*fields))


def batch_position(batch: DataFrame) -> DataFrame:
    """Complete ``src_pos`` of a micro-batch that comes straight from file
    sources: ids increase along each split, so file, split and id give the
    order of the file's lines.  (Parquet rows carry their index already.)"""
    has = batch.schema[POS].dataType.names
    row = F.col(f"{POS}.row") if "row" in has else F.lit(None).cast("long")
    block = F.col(f"{POS}.block") if "block" in has else F.lit(0).cast("long")
    return batch.withColumn(POS, F.struct(F.col(f"{POS}.file").alias("file"), block.alias("block"),
                                          F.coalesce(row, F.monotonically_increasing_id()).alias("row")))


def _read(spark: SparkSession, path: str, sch) -> DataFrame:
    """Headed CSV read as text; columns are taken by header name, so their
    order in the file and any extra columns do not matter.  A missing
    column fails the read."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    df = with_source_position(df)
    missing = [f.name for f in sch.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in sch.fields], POS)


def read_customer_master(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schema.CUSTOMER_CSV)


def read_product_master(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schema.PRODUCT_CSV)


def read_transactions_batch(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schema.TRANSACTION_CSV)


def _stream(spark: SparkSession, path: str, sch, fmt: str,
            max_files_per_trigger: int | None, arrival: str | None, max_bytes_per_trigger: str | None) -> DataFrame:
    if max_bytes_per_trigger and max_files_per_trigger:
        raise ValueError("a trigger is bounded by files or by bytes, not by both")
    if arrival:
        sch = T.StructType([*sch.fields, T.StructField(arrival, T.StringType())])
    reader = spark.readStream.schema(sch)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    df = with_source_position(df, fmt, streaming=True)
    if not arrival:
        return df.withColumn("arrival_ts", F.current_timestamp())
    return df.withColumn("arrival_ts", F.coalesce(F.col(arrival).try_cast("timestamp"), F.current_timestamp())).drop(arrival)


def read_transactions_stream(spark: SparkSession, path: str,
                             max_files_per_trigger: int | None = None,
                             fmt: str = "csv", arrival: str | None = None,
                             max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Transactions arriving as files in ``path`` (CSV, or Parquet with the
    same text columns).

    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` (such as "256m") bounds
    each micro-batch, the bounded intake buffer of a stream reader.  A file is
    never divided: one that is larger than the bound comes alone, and is read in
    splits by many tasks.  ``arrival_ts`` stamps processing time, or is read from
    the feed's column ``arrival``, so that a stored feed replays as it arrived.
    """
    return _stream(spark, path, schema.TRANSACTION_CSV, fmt, max_files_per_trigger, arrival, max_bytes_per_trigger)


def read_customer_stream(spark: SparkSession, path: str,
                         max_files_per_trigger: int | None = None,
                         fmt: str = "csv", arrival: str | None = None,
                         max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Customer master rows arriving as files (late master data)."""
    return _stream(spark, path, schema.CUSTOMER_CSV, fmt, max_files_per_trigger, arrival, max_bytes_per_trigger)


def read_product_stream(spark: SparkSession, path: str,
                        max_files_per_trigger: int | None = None,
                        fmt: str = "csv", arrival: str | None = None,
                        max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Product master rows arriving as files (new products, price changes)."""
    return _stream(spark, path, schema.PRODUCT_CSV, fmt, max_files_per_trigger, arrival, max_bytes_per_trigger)


def write_text_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write text columns as Parquet (same layout as the CSV files, with a
    per-file row index available to readers)."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write text columns as headed CSV files (the reference's input layout)."""
    df.write.mode(mode).option("header", True).csv(path)
