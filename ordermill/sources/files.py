"""CSV and Parquet readers and writers of the four tables."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.quality import key_violations
from ordermill.schemas import (
    CLEAN_TYPES, CUSTOMERS, INPUT_PLACE, ORDER_ITEMS, ORDERS, PRIMARY_KEYS, Tables, text_schema,
)

# Whole fields that a CSV scan takes for "no value".
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

VERSION = re.compile(r"[0-9]{12}\.load")

# Both directions keep padding, and quote as CSV tools do: a quote within a field is doubled.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def read_text_csv(
    spark: SparkSession, path: str, schema: str, with_place: bool = False
) -> DataFrame:
    """All fields as text, NA-like fields as null. The header must name the columns in order.

    ``with_place`` adds :data:`INPUT_PLACE`, by which rows are in the order of the files: the file, the
    block of it that a task read, and the row's number in that task.
    """
    rows = spark.read.options(**CSV_OPTIONS, enforceSchema=False).schema(schema).csv(path)
    fields = [F.when(~F.col(c).isin(NULL_TEXTS), F.col(c)).alias(c) for c in rows.columns]
    if with_place:
        fields.append(F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(INPUT_PLACE))
    return rows.select(fields)


def read_raw(
    spark: SparkSession, folder: str, table: str, with_place: bool = False
) -> DataFrame:
    """One raw table, ``<folder>/<table>.csv`` (a file or a folder of part files)."""
    return read_text_csv(spark, f"{folder}/{table}.csv", text_schema(table), with_place)


def malformed_lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``table_name, line`` of raw lines with too few or too many fields.

    The scan keeps such rows: missing fields are null, further ones are left out.
    """
    line = "__line"
    rows = (
        spark.read.options(**CSV_OPTIONS, enforceSchema=False, columnPruning=False,
                           mode="PERMISSIVE", columnNameOfCorruptRecord=line)
        .schema(f"{text_schema(table)}, {line} string").csv(f"{folder}/{table}.csv")
    )
    # The scan tells malformed lines only if it parses fields as well.
    parsed = F.coalesce(F.col(rows.columns[0]), F.lit("")) >= F.lit("")
    return rows.filter(F.col(line).isNotNull() & parsed).select(
        F.lit(table).alias("table_name"), F.col(line).alias("line"))


def all_malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed lines of the four raw tables."""
    found = [malformed_lines(spark, folder, name) for name in Tables._fields]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def typed(rows: DataFrame, table: str) -> DataFrame:
    """The columns of the clean table in order, each in its type."""
    return rows.select([F.col(c).try_cast(t).alias(c) for c, t in CLEAN_TYPES[table].items()])


def read_clean_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One cleaned table back from CSV in its types."""
    schema = ", ".join(f"{name} string" for name in CLEAN_TYPES[table])
    return typed(read_text_csv(spark, f"{folder}/{table}.csv", schema), table)


def write_csv(rows: DataFrame, path: str) -> None:
    """A folder of CSV part files, each with a header."""
    rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_clean_csv(tables: Tables, folder: str) -> None:
    for name, rows in tables._asdict().items():
        write_csv(rows, f"{folder}/{name}.csv")


def row_counts(tables: Tables) -> DataFrame:
    """``table_name, row_count`` of each table."""
    counts = [
        rows.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables._asdict().items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def check_keys(tables: Tables) -> None:
    """Fail on a primary key that occurs twice."""
    for name, rows in tables._asdict().items():
        if not key_violations(rows, PRIMARY_KEYS[name]).isEmpty():
            raise ValueError(f"{name}: {PRIMARY_KEYS[name]} is not unique")


class LoadConflict(Exception):
    """Another load was published since this one began."""


def load_tables(tables: Tables, folder: str, unique_keys: bool = True) -> DataFrame:
    """Write typed Parquet tables and give their row counts as read back.

    Orders are written in date order, so that a period reads few files. A primary key that is not
    unique makes the load fail, unless ``unique_keys`` is off; the check reads back the keys only.
    A load is written beside the ones before and published as the version after the one it began
    with, so readers see a whole load or the one before; of two loads at once, one is published and
    the other fails with :class:`LoadConflict`. Old loads stay until somebody deletes them.
    """
    spark = tables.orders.sparkSession
    version = len(_versions(spark, folder)) + 1
    path = f"{folder}/loads/{uuid.uuid4().hex}"
    by_date = ["order_date", "order_id"]
    ready = {name: typed(rows, name) for name, rows in tables._asdict().items()}
    ready[ORDERS] = ready[ORDERS].repartitionByRange(*by_date).sortWithinPartitions(*by_date)
    for name, rows in ready.items():
        rows.write.parquet(f"{path}/{name}")
    loaded = _tables_at(spark, path)
    if unique_keys:
        check_keys(loaded)
    _publish(spark, folder, version, path.rsplit("/", 1)[1])
    return row_counts(loaded)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the claimed versions in order."""
    files, jvm = _file_system(spark, folder), spark._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{folder}/published")
    if not files.exists(log):
        return []
    paths = [s.getPath() for s in files.listStatus(log)]
    return sorted(p.toString() for p in paths if VERSION.fullmatch(p.getName()))


def _publish(spark: SparkSession, folder: str, version: int, load: str) -> None:
    """Creates the version's file, which only one of several writers can, with the load's name.

    A reader that finds it still empty takes the version before.
    """
    jvm = spark._jvm
    files = _file_system(spark, folder)
    path = files.makeQualified(jvm.org.apache.hadoop.fs.Path(
        f"{folder}/published/{version:012d}.load"))
    files.mkdirs(path.getParent())
    taken = LoadConflict(f"{folder}: version {version} is published already")
    if files.getScheme() == "file":
        # Local file systems look first and create then, unless asked for a new file.
        if not jvm.java.io.File(path.toUri().getPath()).createNewFile():
            raise taken
        out = files.create(path, True)
    else:
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if "Exist" in error.java_exception.getClass().getSimpleName():
                raise taken from error
            raise
    out.write(bytearray(load.encode()))
    out.close()


def published_loads(spark: SparkSession, folder: str) -> DataFrame:
    """``version, load`` of each published load."""
    paths = _versions(spark, folder)
    if not paths:
        return spark.createDataFrame([], "version bigint, load string")
    version = F.regexp_extract(F.col("_metadata.file_name"), r"^[0-9]+", 0).cast("bigint")
    return spark.read.text(paths).select(version.alias("version"), F.col("value").alias("load"))


def _tables_at(spark: SparkSession, path: str) -> Tables:
    return Tables(*[
        spark.read.schema(", ".join(f"{c} {t}" for c, t in CLEAN_TYPES[name].items()))
        .parquet(f"{path}/{name}")
        for name in Tables._fields
    ])


def read_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of the latest load that ``load_tables`` published."""
    latest = published_loads(spark, folder).orderBy(F.desc("version")).first()
    if latest is None:
        raise FileNotFoundError(f"{folder}: no load is published")
    return _tables_at(spark, f"{folder}/loads/{latest.load}")


def save_bucketed(tables: Tables, database: str, buckets: int) -> Tables:
    """Save catalog tables with orders and order items bucketed by ``order_id``.

    Queries that sum order items per order and join the orders then need no shuffle for either
    step. Choose ``buckets`` so that one bucket of order items fits a task.
    """
    spark = tables.orders.sparkSession
    for name, rows in tables._asdict().items():
        bucketed = name in (ORDERS, ORDER_ITEMS)
        ready = typed(rows, name)
        if bucketed:  # one file per bucket, however many tasks there were
            ready = ready.repartition(buckets, "order_id")
        writer = ready.write.mode("overwrite").format("parquet")
        if bucketed:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.saveAsTable(f"{database}.{name}")
    return Tables(*[spark.table(f"{database}.{name}") for name in Tables._fields])


def read_raw_tables(spark: SparkSession, folder: str) -> Tables:
    """The raw tables; customers with their place, for samples in the order of the input."""
    return Tables(*[read_raw(spark, folder, name, with_place=name == CUSTOMERS)
                    for name in Tables._fields])


def stage_raw(raw: Tables, folder: str) -> Tables:
    """Raw text as Parquet: the CSV is parsed once, and each later pass reads few columns."""
    for name, rows in raw._asdict().items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = raw.orders.sparkSession
    return Tables(*[
        spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
        for name, rows in raw._asdict().items()
    ])
