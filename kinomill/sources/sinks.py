"""Writers. All overwrite, so a repeated run leaves the same result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def write_zone(df: DataFrame, root: str, zone: str, dataset: str) -> str:
    path = f"{root.rstrip('/')}/{zone}/{dataset}"
    df.write.mode("overwrite").parquet(path)
    return path


def _writable(df: DataFrame, sep: str) -> DataFrame:
    """The same rows; a value that the format cannot hold stops the job instead of breaking lines."""
    pattern = r"[\r\n]|\Q" + sep + r"\E"

    def checked(name: str, kind) -> Column:
        c = F.col(f"`{name}`")
        if not isinstance(kind, StringType):
            return c
        message = F.concat(F.lit(f"column {name} holds a separator or line break: "), F.substring(c, 1, 100))
        return F.when(c.rlike(pattern), F.raise_error(message).cast("string")).otherwise(c).alias(name)

    return df.select(*[checked(f.name, f.dataType) for f in df.schema.fields])


def write_delimited(df: DataFrame, path: str, sep: str = "::") -> None:
    df = _writable(df, sep)
    df.write.mode("overwrite").option("sep", sep).option("quote", "").option("escapeQuotes", False).csv(path)


def write_tsv_gz(df: DataFrame, path: str) -> None:
    (
        _writable(df, "\t")
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("compression", "gzip")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_triples_tsv(triples: DataFrame, path: str) -> None:
    """One statement per line; backslash, tab and line breaks inside a value are written as escapes, NULL as ``\\N``."""
    values = [F.coalesce(tsv_escaped(F.col(c)), F.lit("\\N")) for c in ("s", "p", "o")]
    triples.select(F.concat_ws("\t", *values).alias("value")).write.mode("overwrite").text(path)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Size of all files below a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def footprint(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Bytes before and after a conversion and the share saved."""
    before = stored_bytes(spark, source).select(F.col("bytes")).scalar()
    after = stored_bytes(spark, target).select(F.col("bytes")).scalar()
    row = spark.range(1).select(before.alias("source_bytes"), after.alias("target_bytes"))
    saved = (1 - F.col("target_bytes") / F.when(F.col("source_bytes") > 0, F.col("source_bytes"))) * 100
    return row.select("source_bytes", "target_bytes", F.round(saved, 1).alias("saved_percent"))


def tsv_escaped(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _escaped(text: Column) -> Column:
    """String escapes of the N-Triples grammar."""
    steps = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))
    for plain, escaped in steps:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def ntriples_line(s: Column, p: Column, o: Column, o_kind: Column, o_type: Column) -> Column:
    iri = F.concat(F.lit("<"), o, F.lit(">"))
    literal = F.concat(F.lit('"'), _escaped(o), F.lit('"^^<'), o_type, F.lit(">"))
    value = F.when(o_kind == "iri", iri).otherwise(literal)
    return F.concat(F.lit("<"), s, F.lit("> <"), p, F.lit("> "), value, F.lit(" ."))


def write_ntriples(triples: DataFrame, path: str) -> None:
    """One statement per line; a store can load the part files side by side."""
    line = ntriples_line(*[F.col(c) for c in ("s", "p", "o", "o_kind", "o_type")])
    triples.select(line.alias("value")).write.mode("overwrite").text(path)


def write_triples(triples: DataFrame, path: str) -> None:
    """Parquet, one folder per predicate, so that pattern queries read only theirs.

    Rows are rebalanced by predicate: small predicates get one file, large ones
    are split over many tasks, so there are not tasks times predicates files.
    """
    triples.hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(path)


def write_observed(df: DataFrame, path: str, **metrics: Column) -> dict:
    """Write Parquet and return metrics counted on the way, without a second job."""
    seen = Observation()
    df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.mode("overwrite").parquet(path)
    return seen.get
