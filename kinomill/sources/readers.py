"""Readers with declared schemas; nothing is inferred by a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import ENTITY_INDEX, TRIPLES


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "::") -> DataFrame:
    """Headerless text with a separator of any length. Quotes are ordinary characters."""
    return spark.read.schema(schema).option("sep", sep).option("quote", "").csv(path)


def read_tsv_gz(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """Gzip TSV with a header; a malformed number becomes NULL.

    One gzip file is one task, so rows are spread right after the scan if
    ``partitions`` is given.
    """
    df = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.repartition(partitions) if partitions else df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_map(spark: SparkSession, path: str, value_type: str, layout: str = "lines") -> DataFrame:
    """JSON objects keyed by id to rows (key, value); null values stay NULL.

    ``layout="lines"`` takes one object per line, ``"file"`` one per file. Only
    the first can be split, so large inputs should come in lines.
    """
    if layout not in ("file", "lines"):
        raise ValueError("layout is 'file' or 'lines'")
    text = spark.read.text(path, wholetext=layout == "file")
    parsed = text.select(F.from_json("value", f"map<string,{value_type}>").alias("m"))
    return parsed.select(F.explode("m").alias("key", "value"))


def spread(df: DataFrame) -> DataFrame:
    """Give more cores a share of a scan that has fewer splits than there are cores.

    Such an input may be a single split in effect (gzip, one row group), and then
    all work up to the next shuffle runs in one task. Larger inputs stay as they are.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(cores, 8 * max(splits, 1))) if splits < cores else df


def read_zone(spark: SparkSession, root: str, zone: str, dataset: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{zone}/{dataset}")


def tsv_unescaped(text: Column) -> Column:
    """Undo ``sinks.tsv_escaped``: pairs of backslashes are set apart first, so no escape is read across them."""

    def plain(part: Column) -> Column:
        for escaped, sign in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
            part = F.replace(part, F.lit(escaped), F.lit(sign))
        return part

    parts = F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")
    return F.when(text == "\\N", None).when(F.contains(text, F.lit("\\")), parts).otherwise(text)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Statements as written by ``sinks.write_triples_tsv``; other TSV without escapes reads alike."""
    lines = spark.read.option("lineSep", "\n").text(path)
    fields = F.split("value", "\t", 3)
    columns = [f.strip().split()[0] for f in TRIPLES.split(",")]
    return lines.select(*[tsv_unescaped(F.get(fields, F.lit(i))).alias(c) for i, c in enumerate(columns)])


def read_entity_index(spark: SparkSession, path: str) -> DataFrame:
    """Id and entity; rows whose id is not a number (such as a header) are left out."""
    raw = spark.read.schema(ENTITY_INDEX).option("sep", "\t").option("quote", "").csv(path)
    return numeric_ids(raw)


def numeric_ids(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").rlike(r"^\d+$")).select(F.col("id").cast("bigint").alias("id"), "entity")


def entities_of_kind(df: DataFrame, kind: str, column: str = "entity") -> DataFrame:
    return df.where(F.col(column).contains(f"/{kind}/"))
