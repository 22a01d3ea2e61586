"""Metadata checks: one row for each violation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S

# The columns a platform's metadata must have.
ILLUMINA_COLUMNS = (
    "run", "data_owner", "run_key", "lane", "dataset", "project", "tubelabel", "barcode", "adaptor", "dna_region",
    "amp_operator", "seq_operator", "barcode_index", "overlap", "insert_size", "read_length", "platform", "primer_suite",
    "first_name", "last_name", "email", "institution", "project_title", "project_description", "funding",
    "env_sample_source_id", "dataset_description",
)
TAGGED_COLUMNS = (
    "run", "data_owner", "run_key", "lane", "project", "dataset", "tubelabel", "barcode", "adaptor", "dna_region",
    "amp_operator", "seq_operator", "empcr_operator", "direction", "enzyme", "concentration", "quant_method", "domain",
    "primer_suite", "pool", "first_name", "last_name", "email", "institution", "project_title", "project_description",
    "funding", "env_sample_source_id", "dataset_description",
)
HEADERS = {
    "illumina": ILLUMINA_COLUMNS,
    "miseq": ILLUMINA_COLUMNS,
    "hiseq": ILLUMINA_COLUMNS,
    "nextseq": ILLUMINA_COLUMNS,
    "454": TAGGED_COLUMNS,
    "ion_torrent": TAGGED_COLUMNS,
}


def header_differences(columns: list[str], platform: str) -> tuple[set[str], set[str]]:
    """(missing, extra) columns."""
    want = set(HEADERS[platform])
    return want - set(columns), set(columns) - want


def violations(samples: DataFrame, suites: list[str], regions: list[str], required: list[str] | None = None) -> DataFrame:
    """row_key, check, value of everything that is wrong with the samples' metadata.

    Missing values; datasets other than letters, digits and _; projects that aren't three parts joined by _ whose last names a
    region (after its first letter, or whole); suites that aren't known or don't name the region.
    """
    required = required or [c for c in ("run", "run_key", "lane", "dataset", "project", "dna_region", "primer_suite") if c in samples.columns]
    suite, region = S.normalize_suite(F.col("primer_suite")), S.normalize_suite(F.col("dna_region"))
    parts = F.split("project", "_")
    last = F.element_at(parts, -1)
    known = [r.lower() for r in regions]
    checks = [(f"missing {c}", F.coalesce(F.trim(c), F.lit("")) == "", F.coalesce(F.col(c), F.lit(""))) for c in required]
    checks += [
        ("dataset", ~F.coalesce(F.col("dataset"), F.lit("")).rlike("^[A-Za-z0-9_]*$"), F.col("dataset")),
        ("project parts", F.size(parts) != 3, F.col("project")),
        ("project region", ~(F.lower(last).isin(known) | F.lower(F.substring(last, F.lit(2), F.length(last))).isin(known)), F.col("project")),
        ("suite unknown", ~suite.isin([s.lower().replace(" ", "").replace("_", "").replace("-", "") for s in suites]), F.col("primer_suite")),
        ("suite region", ~F.contains(suite, region), F.col("primer_suite")),
    ]
    key = F.concat_ws("_", *[F.col(c) for c in ("barcode_index", "run_key", "lane") if c in samples.columns])
    found = F.filter(F.array(*[F.when(bad, F.struct(F.lit(n).alias("check"), v.alias("value"))) for n, bad, v in checks]), lambda x: x.isNotNull())
    return samples.select(key.alias("row_key"), F.explode(found).alias("x")).select("row_key", "x.check", "x.value")


def absent(samples: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Values of a column that the warehouse doesn't know yet."""
    return samples.select(column).distinct().join(known.select(column), column, "left_anti")


def env_source_ids(samples: DataFrame, sources: DataFrame) -> DataFrame:
    """env_sample_source replaced by its id. sources: env_sample_source_id, env_source_name; names meet without regard to case."""
    clean = lambda c: F.lower(F.trim(S.normalize_env_source(F.col(c))))
    s = sources.select(clean("env_source_name").alias("k_"), "env_sample_source_id")
    return samples.withColumn("k_", clean("env_sample_source")).join(s, "k_", "left").drop("k_", "env_sample_source")


