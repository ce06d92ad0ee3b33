"""Reading, writing and previewing tables.

Delimited text has a fixed schema and no header, the default storage is Parquet.
A field that does not fit its declared type becomes null, the row is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import schema as parse


def read_delimited(spark: SparkSession, path: str | list[str], ddl: str, sep: str = ",") -> DataFrame:
    """Scan comma or tab separated text with a declared schema."""
    return (
        spark.read.schema(parse(ddl))
        .option("sep", sep)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """Scan a Parquet table; with a declared schema no file is opened for planning."""
    reader = spark.read if ddl is None else spark.read.schema(parse(ddl))
    return reader.parquet(path)


def rows_table(spark: SparkSession, rows: Sequence[Sequence[object]], ddl: str) -> DataFrame:
    """Literal rows as a table: every value is cast to its declared type on insert."""
    target = parse(ddl)
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    loaded = spark.createDataFrame(text, ", ".join(f"`{f.name}` STRING" for f in target))
    return loaded.select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name, metadata=f.metadata) for f in target)
    )


def save(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a table as Parquet; ``append`` adds rows, ``overwrite`` replaces them."""
    df.write.mode(mode).parquet(path)


def save_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Store a table as delimited text that `read_delimited` reads back."""
    (
        df.write.mode(mode)
        .option("sep", sep)
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def load_files(
    spark: SparkSession, files: str | list[str], ddl: str, table_path: str, sep: str = ",", append: bool = False
) -> None:
    """Load delimited files into a stored table.

    Replacing is the default, so that a repeated load does not double the rows.
    """
    save(read_delimited(spark, files, ddl, sep), table_path, "append" if append else "overwrite")


#: What a refused line is kept as, and which rows of a checked table are such lines.
LINE, REFUSED = "_line", "refused"


def load_checked(spark: SparkSession, files: str | list[str], ddl: str, table_path: str, sep: str = ",") -> None:
    """Load delimited files into a stored table; lines that do not fit the schema are set aside.

    A line with too few or too many fields, or a value that is not of its declared type, goes to the
    partition ``refused=true`` as it stands, all others to ``refused=false``. One pass over the
    text writes both, so no line is lost or counted twice.
    """
    checked = (
        spark.read.schema(parse(f"{ddl}, {LINE} STRING"))
        .option("sep", sep)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(files)
    )
    checked.withColumn(REFUSED, F.col(LINE).isNotNull()).write.mode("overwrite").partitionBy(REFUSED).parquet(table_path)


def loaded(spark: SparkSession, table_path: str, ddl: str) -> DataFrame:
    """The rows of a checked table that fit."""
    return _checked(spark, table_path, ddl).filter(~F.col(REFUSED)).drop(LINE, REFUSED)


def refused(spark: SparkSession, table_path: str, ddl: str) -> DataFrame:
    """The lines of a checked table that did not fit, as they were."""
    return _checked(spark, table_path, ddl).filter(F.col(REFUSED)).select(F.col(LINE).alias("line"))


def load_counts(spark: SparkSession, table_path: str, ddl: str) -> DataFrame:
    """Lines loaded and refused; one row."""
    sums = {"loaded": F.count_if(~F.col(REFUSED)), "refused": F.count_if(F.col(REFUSED))}
    return _checked(spark, table_path, ddl).agg(*(total.alias(name) for name, total in sums.items()))


def _checked(spark: SparkSession, table_path: str, ddl: str) -> DataFrame:
    return spark.read.schema(parse(f"{ddl}, {LINE} STRING, {REFUSED} BOOLEAN")).parquet(table_path)


def load_batch(df: DataFrame, table_path: str, batch: str) -> None:
    """Add rows to a stored table by batches: each value of column ``batch`` is a partition.

    The partitions of the batches in ``df`` are replaced and others stay, so a batch that is
    loaded again, after a failure or by mistake, does not double its rows.
    """
    writer = df.repartition(batch, F.spark_partition_id()).write.mode("overwrite").partitionBy(batch)
    writer.option("partitionOverwriteMode", "dynamic").parquet(table_path)


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in hash buckets of its keys, sorted by them, and read it back.

    Tables with the same buckets of their join keys join without a shuffle, every time. The
    rows are dealt to the buckets first, so that each is one file.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, by: Sequence[str] = (), n: int = 5) -> DataFrame:
    """The first n rows; with ``by`` the same ones on every run."""
    return (df.orderBy(*by) if by else df).limit(n)
