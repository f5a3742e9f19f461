"""Stored tables: works by year folder, preprints by set folder, raw landing files."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.records import records_from_lines
from trendloom.schemas import PREPRINTS, RAW_LANDED, RAW_PREPRINT, RAW_WORK, WORKS


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at the path, on whatever file system it names."""
    fs, target = _locate(spark, path)
    return fs.exists(target)


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder holds at least one parquet file; stops at the first one found."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def set_file_times(spark: SparkSession, path: str, when: datetime) -> None:
    """Give every file under a folder a modification time, as files copied from an archive have."""
    fs, target = _locate(spark, path)
    files = fs.listFiles(target, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), int(when.timestamp() * 1000), -1)


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """Works from one file or a folder of year folders, with the declared schema.

    In year folders ``publication_year`` is read from the folder name, which repeats it, so a filter
    on it skips folders.
    """
    if not has_parquet(spark, path):
        raise FileNotFoundError(f"no parquet files under {path}: collect the corpus first")
    if not _in_year_folders(spark, path):
        return spark.read.schema(WORKS).parquet(path).select(*WORKS.names)
    stored = [f for f in WORKS.fields if f.name != "publication_year"]
    folder = T.StructField("year", WORKS["publication_year"].dataType)
    return spark.read.schema(T.StructType([*stored, folder])).parquet(path) \
        .withColumnRenamed("year", "publication_year").select(*WORKS.names)


def _in_year_folders(spark: SparkSession, path: str) -> bool:
    """Whether the works under a path lie in folders ``year=...``, or ``ingest=...`` of these."""
    fs, target = _locate(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return any(n.startswith(("year=", "ingest=")) for n in names) and not any(n.endswith(".parquet") for n in names)


def read_works_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Works with the ``year`` folder column kept, for reports about the stored files."""
    schema = T.StructType(WORKS.fields + [T.StructField("year", T.IntegerType())])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_works_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year of the slice: only that folder is read. An unknown year is an error."""
    one = read_works_partitioned(spark, path).where(F.col("year") == year).drop("year")
    if one.isEmpty():
        raise ValueError(f"the slice has no year {year}")
    return one


def first_copies(stored: DataFrame) -> DataFrame:
    """One row per preprint id: the first set by name, then the earliest dates, then any content.

    The bound of one row lets each map task drop its own repeats before the shuffle.
    """
    w = Window.partitionBy("id").orderBy("set", "updated", "created", F.xxhash64("title", "abstract"))
    return stored.withColumn("__copy", F.row_number().over(w)) \
        .where(F.col("__copy") == 1).drop("__copy", "set")


def read_preprint_keys(spark: SparkSession, path: str) -> DataFrame:
    """``id, created`` of the rows of ``read_preprints``, from narrow columns alone: enough for counting
    and linking, and repeats meet pre-aggregated."""
    if not has_parquet(spark, path):
        raise FileNotFoundError(f"no preprints under {path}")
    schema = T.StructType([*(PREPRINTS[c] for c in ("id", "created", "updated")), T.StructField("set", T.StringType())])
    first = F.min(F.struct("set", "updated", "created"))
    return spark.read.schema(schema).parquet(path).groupBy("id").agg(first.alias("first")) \
        .select("id", F.col("first.created").alias("created"))


def read_preprints(spark: SparkSession, path: str) -> DataFrame:
    """All sets as one corpus without repeats."""
    if not has_parquet(spark, path):
        raise FileNotFoundError(f"no preprints under {path}")
    schema = T.StructType(PREPRINTS.fields + [T.StructField("set", T.StringType())])
    return first_copies(spark.read.schema(schema).parquet(path))


def resolve_works(spark: SparkSession, full: str, sample: str,
                  year: int | None = None) -> tuple[DataFrame, str]:
    """The full slice (or one year of it), else the sample, with a label of what was read."""
    if has_parquet(spark, full):
        if year is not None:
            return read_works_year(spark, full, year), f"year {year}"
        return read_works(spark, full), "full slice"
    if year is not None:
        raise ValueError(f"the slice has no year {year}")
    if has_parquet(spark, sample):
        return read_works(spark, sample), "sample"
    raise FileNotFoundError("neither the slice nor the sample is there")


def read_raw_works(spark: SparkSession, landing: str) -> DataFrame:
    """Landed JSON records with exactly the requested fields."""
    return spark.read.schema(RAW_WORK).json(landing)


def land_raw_works(spark: SparkSession, landing: str, out: str, rows_per_file: int = 200_000) -> None:
    """Landed JSON records once as Parquet, with the inverted index as text in a column of its own.

    All other fields are parsed for good; the index, which is most of a record, is copied unparsed. A
    reader that asks for no abstract then neither reads nor parses it.
    """
    records_from_lines(spark.read.text(landing), RAW_LANDED, "FAILFAST").write \
        .option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(out)


def read_landed_works(spark: SparkSession, path: str) -> DataFrame:
    """Raw records written by ``land_raw_works``, for ``works_from_raw``."""
    return spark.read.schema(RAW_LANDED).parquet(path)


def read_raw_preprints(spark: SparkSession, landing: str) -> DataFrame:
    """Landed XML pages, one row per ``record`` element."""
    return spark.read.format("xml").option("rowTag", "record").schema(RAW_PREPRINT).load(landing)


def parse_records(xml: DataFrame, column: str = "record") -> DataFrame:
    """XML records held in a text column, parsed with the same schema.

    The generator keeps later filters above the parser: pushed below, they would parse again.
    """
    return xml.select(F.inline(F.array(F.from_xml(column, RAW_PREPRINT))))


def probe(df: DataFrame, limit: int) -> DataFrame:
    """A trial read that stops after ``limit`` rows."""
    return df.limit(limit)


def list_files(spark: SparkSession, *roots: str, pattern: str = "*.parquet") -> DataFrame:
    """All files under the folders with length and content; only read columns are loaded. Spark's readers leave out
    empty files, which a stored table has none of."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", pattern).load(list(roots))

