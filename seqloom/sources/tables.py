"""Tab- and comma-separated tables with explicit schemas, and catalog or JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layouts of the tables that steps exchange.
SCHEMAS = {
    "gast": "read_id string, ref_id string, distance double, cigar string, frequency int",
    "gast_concat": "read_id string, distance double, refs string",
    "names": "rep_id string, id_list string",
    "name_blocks": "rep_id string, block long, id_list string",
    "deleted": "read_id string, reason string",
    "ref_tax": "ref_id string, taxonomy string, n int",
    "tagtax_long": "read_id string, taxonomy string, distance double, rank string, refssu_count int, vote int, minrank string, taxa_counts string, max_pcts string, na_pcts string, refhvr_ids string",
    "tagtax_terse": "read_id string, taxonomy string, rank string, refssu_count int, refhvr_ids string, distance double, frequency int",
}


def read_tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool = False) -> DataFrame:
    """Every row must have the schema's fields and kinds; a bad one fails the query."""
    return spark.read.csv(path, sep="\t", schema=schema, header=header, mode="FAILFAST", quote="")


def read_step_table(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """One of SCHEMAS. Id lists become arrays, gast rows of four fields get frequency 0, ref_tax's header row is skipped."""
    if kind == "gast":
        df = spark.read.csv(path, sep="\t", schema=SCHEMAS[kind], mode="PERMISSIVE", quote="")
        return df.withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    if kind == "ref_tax":
        df = spark.read.csv(path, sep="\t", schema="ref_id string, taxonomy string, n string", mode="PERMISSIVE", quote="")
        return df.filter("ref_id != 'refhvr_id'").withColumn("n", F.coalesce(F.col("n").try_cast("int"), F.lit(1)))
    df = read_tsv(spark, path, SCHEMAS[kind])
    if kind == "names":
        return df.select("rep_id", F.split("id_list", ",").alias("ids"))
    if kind == "name_blocks":
        return df.select("rep_id", "block", F.split("id_list", ",").alias("ids"))
    if kind == "gast_concat":
        return df.select("read_id", "distance", F.split("refs", " ").alias("ref_ids"))
    return df


def append_columns(left: DataFrame, right: DataFrame, on: str, strict: bool = False) -> DataFrame:
    """left with right's columns; missing rows are null, or an error if ``strict``."""
    if strict and not left.join(right, on, "left_anti").isEmpty():
        raise ValueError(f"rows of the left table have no {on} in the right one")
    return left.join(right, on, "left")


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """A metadata CSV with a header, all strings; columns without a name at the end are dropped."""
    df = spark.read.csv(path, header=True, mode="FAILFAST")
    named = [c for c in df.columns if c and not c.startswith("_c")]
    return df.select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c.strip()) for c in named])


def select_table(spark: SparkSession, table: str, columns: list[str], where: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """Columns of a catalog table, or of a JDBC one if ``jdbc`` gives its options; the filter is pushed down."""
    df = spark.read.format("jdbc").options(dbtable=table, **jdbc).load() if jdbc else spark.table(table)
    return (df.filter(where) if where else df).select(*columns)
