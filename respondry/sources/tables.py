"""Table scans and sinks."""

from __future__ import annotations

import csv
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respondry.functions import fixed_values as fv
from respondry.spec import contact_schema

#: How a content key writes a null and separates fields.
NULL_TEXT = "\x00"
FIELD_END = "\x1f"

#: Files whose headers are read at a time.
HEADER_READERS = 16

CSV_OPTIONS = {"header": "true", "sep": ";", "quote": '"'}


def normalize_names(df: DataFrame) -> DataFrame:
    """Replace every dot in the column names by an underscore, in one projection."""
    return df.toDF(*[name.replace(".", "_") for name in df.columns])


def dotted_names(df: DataFrame) -> DataFrame:
    """Raw spelling of the contact columns (the inverse of :func:`normalize_names`)."""
    raw = {name.replace(".", "_"): name for name in fv.DOTTED_NAMES}
    return df.toDF(*[raw.get(name, name) for name in df.columns])


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """The first line of every file, null where it is empty. Files are opened, not read."""
    jvm = spark.sparkContext._jvm
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings)

    def first(path: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(path)
        stream = file.getFileSystem(settings).open(file)
        codec = codecs.getCodec(file)
        if codec is not None:
            stream = codec.createInputStream(stream)
        text = jvm.java.io.InputStreamReader(stream, jvm.java.nio.charset.StandardCharsets.UTF_8)
        reader = jvm.java.io.BufferedReader(text)
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPool(HEADER_READERS) as pool:
        return dict(zip(paths, pool.map(first, paths)))


def header_names(line: str) -> list[str]:
    cells = next(csv.reader([line.removeprefix("\ufeff")], delimiter=CSV_OPTIONS["sep"], quotechar=CSV_OPTIONS["quote"]))
    return [name.replace(".", "_") for name in cells]


def read_contacts_csv(
    spark: SparkSession,
    path: str,
    key: str | None = None,
    schema: T.StructType | None = None,
    infer: bool = False,
    unreadable: str | None = None,
) -> DataFrame:
    """Semicolon-separated contact files, names normalised.

    Every file's columns are bound by the names in its own header, whatever their order, and come out
    in the order of the schema; a file with a missing or unknown column is an error that names it, an
    empty file has no rows. Files with equal headers are one scan. Types are those of the schema, so
    the rows are read once; ``infer=True`` costs a second pass. ``unreadable`` names a column that gets
    the line as it stands where a value does not fit its type (that value is null) or cells are missing.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    files = sorted(spark.read.schema("line string").text(path).inputFiles())
    types = {f.name.replace(".", "_"): f.dataType for f in schema or contact_schema(key)}
    headers: dict[tuple[str, ...], list[str]] = {}
    for file, line in first_lines(spark, files).items():
        if line is None:
            continue
        names = header_names(line)
        if not infer and sorted(names) != sorted(types):
            raise ValueError(
                f"{file}: missing {sorted(set(types) - set(names))}, unknown or repeated "
                f"{sorted(name for name in set(names) if name not in types or names.count(name) > 1)}"
            )
        headers.setdefault(tuple(names), []).append(file)

    def scan(names: tuple[str, ...], paths: list[str]) -> DataFrame:
        if infer:
            return reader.option("inferSchema", "true").csv(paths).toDF(*names)
        bound = [T.StructField(name, types[name]) for name in names]
        columns = list(types)
        options = {"enforceSchema": "true"}
        if unreadable:
            bound.append(T.StructField(unreadable, T.StringType()))
            columns.append(unreadable)
            options["columnNameOfCorruptRecord"] = unreadable
        return spark.read.options(**CSV_OPTIONS, **options).schema(T.StructType(bound)).csv(paths).select(*columns)

    scans = [scan(names, paths) for names, paths in headers.items()]
    if not scans:
        fields = [T.StructField(name, kind) for name, kind in types.items()]
        fields += [T.StructField(unreadable, T.StringType())] if unreadable else []
        return spark.createDataFrame([], T.StructType(fields))
    return reduce(DataFrame.unionByName, scans)


def write_contacts_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def with_row_key(df: DataFrame, key: str) -> DataFrame:
    """Give the rows of a table without a business key one that follows from their content.

    The key is a digest of all columns and a number among identical rows, so it does not depend on
    files, partitions or order. Identical rows are counted before they are numbered, so a row that
    repeats very often is no hot group.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in df.columns]
    digest = F.sha2(F.concat_ws(FIELD_END, *values), 256)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    numbered = counted.withColumn("__number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return numbered.select(F.concat(digest, F.lit("-"), F.col("__number").cast("string")).alias(key), *df.columns)


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Parquet scan; ``partitions`` forces a shuffle and is best left to the scan and AQE."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
