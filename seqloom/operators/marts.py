"""The marts of a project's reads, and a store that adds to all of them in one commit."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..sources.shared import Workspace, folders, move
from . import rollup
from .derep import counts

_OWN = ["project", "dataset"]
#: What identifies a row of each mart: a row whose key is stored already is not stored again.
KEYS = {
    "data_cube": [*_OWN, "taxonomy"],
    "summed_cube": [*_OWN, "taxonomy", "rank"],
    "taxonomy": ["taxon_string", "rank"],
    "sequences": [*_OWN, "read_id"],
    "exports": [*_OWN, "read_id"],
    "projects_datasets": _OWN,
    "project_info": ["project"],
    "users": ["project", "user"],
}
#: Marts that say whether a project has a taxonomy.
_TOLD = ("projects_datasets", "project_info")


def build(reads: DataFrame, assigned: DataFrame, info: DataFrame, date_trimmed: str, classifier: str = "GAST", only: tuple[str, ...] = tuple(KEYS)) -> dict[str, DataFrame]:
    """The marts named by ``only``.

    reads: project, dataset, read_id, seq. assigned: read_id, taxonomy, refhvr_ids, rank, distance, at most a row for each read.
    info: project, title, description, contact, email, institution, user, env_source_id. Projects are capitalized. The cube is made
    once, and what is summed from it reads the written one. Empty tables give empty marts; other columns are ignored.
    """
    own = reads.select(S.capitalize(F.col("project")).alias("project"), "dataset", "read_id", "seq")
    both = F.concat("project", F.lit("--"), "dataset").alias("project_dataset")
    named = info.select(S.capitalize(F.col("project")).alias("project"), "title", "description", "contact", "email", "institution", "user", "env_source_id")
    made: dict[str, DataFrame] = {}
    if {"data_cube", "summed_cube", "taxonomy"} & set(only):
        placed = own.select(*_OWN, "read_id").join(assigned.select("read_id", "taxonomy"), "read_id")
        made["data_cube"] = Workspace(reads.sparkSession, "marts").save(rollup.taxon_cube(placed, _OWN, classifier), "cube")
        summed = rollup.prefix_rollup(made["data_cube"], _OWN)
        made["summed_cube"] = summed.select("taxonomy", "sum_tax_counts", "frequency", "dataset_count", "rank", *_OWN, both, F.lit(classifier).alias("classifier"))
        made["taxonomy"] = rollup.distinct_taxa(summed)
    if "sequences" in only:
        mart = rollup.sequence_mart(counts(own, _OWN), assigned, _OWN)
        made["sequences"] = mart.withColumnsRenamed({"seq": "sequence", "rep_id": "read_id"}).withColumn("project_dataset", both)
    if "exports" in only:
        told = assigned.select("read_id", "taxonomy", "refhvr_ids", "rank", "distance")
        made["exports"] = own.join(told, "read_id").select("read_id", *_OWN, "refhvr_ids", "distance", "taxonomy", F.col("seq").alias("sequence"), "rank", F.lit(date_trimmed).alias("date_trimmed"))
    if "projects_datasets" in only:
        made["projects_datasets"] = rollup.projects_datasets(own, assigned, date_trimmed).withColumn("dataset_info", F.col("dataset"))
    if "project_info" in only:
        made["project_info"] = named
    if "users" in only:
        made["users"] = named.select("project", "user").distinct()
    return {name: df for name, df in made.items() if name in only}


class MartStore:
    """Marts in a folder of loads. A load holds only what was new to each mart, and all its tables become visible together.

    A load is written aside and renamed when all its tables are complete; one that broke off is never read, and where another load
    has taken the number meanwhile the load is made again on top of it. Stored rows don't change. Whether a project has a taxonomy is
    told when a mart is read, from the projects whose cubes have been committed: so a later load turns it on for all their rows.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _loads(self) -> list[int]:
        return sorted(int(name.removeprefix("load=")) for name in folders(self.spark, self.folder) if name.startswith("load="))

    def _stored(self, name: str, loads: list[int]) -> DataFrame | None:
        found = [f"{self.folder}/load={n}/{name}" for n in loads if name in folders(self.spark, f"{self.folder}/load={n}")]
        return self.spark.read.parquet(*found) if found else None

    def read(self, name: str) -> DataFrame | None:
        """All rows of a mart; None before the first load that has it."""
        loads = self._loads()
        rows, taxed = self._stored(name, loads), self._stored("taxed", loads)
        if rows is None or name not in _TOLD:
            return rows
        rows = rows.drop("has_tax")
        if taxed is None:
            return rows.withColumn("has_tax", F.lit(0))
        told = taxed.distinct().withColumn("told_", F.lit(1))
        return rows.join(told, "project", "left").withColumn("has_tax", F.coalesce("told_", F.lit(0))).drop("told_").select(*rows.columns, "has_tax")

    def load(self, tables: dict[str, DataFrame]) -> int:
        """Stores rows whose key isn't stored yet, and returns the load's number. Of rows of one load with one key the least by its
        other columns is stored; a null is a value like any other."""
        while True:
            loads = self._loads()
            number = loads[-1] + 1 if loads else 1
            aside = f"{self.folder}/aside-{uuid4().hex}"
            for name, df in tables.items():
                key = KEYS[name]
                others = [c for c in df.columns if c not in key]
                new = df.groupBy(*key).agg(F.min(F.struct(*others)).alias("o_")).select(*key, "o_.*") if others else df.distinct()
                old = self._stored(name, loads)
                if old is not None:
                    known = old.select(*[F.col(k).alias(f"{k}__") for k in key])
                    new = new.join(known, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}__")) for k in key]), "left_anti")
                new.select(df.columns).write.option("compression", "zstd").parquet(f"{aside}/{name}")
            if "data_cube" in tables:
                self.spark.read.parquet(f"{aside}/data_cube").select("project").distinct().write.parquet(f"{aside}/taxed")
            if move(self.spark, aside, f"{self.folder}/load={number}", again=True):
                return number
