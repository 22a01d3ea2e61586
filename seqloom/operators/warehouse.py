"""Warehouse writes as DataFrame transformations: keys, upserts, conditional inserts, deletes, and the dimension and fact tables."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..sources.shared import Workspace, folders, move


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source``, and those of ``target`` whose key it lacks. Repeated keys of the source must be equal rows."""
    return target.join(source.select(*keys), keys, "left_anti").select(source.columns).unionByName(source.dropDuplicates(keys))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and the rows of ``source`` whose key it lacks."""
    return target.unionByName(source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(target.columns))


def update_where_changed(target: DataFrame, source: DataFrame, keys: list[str], value: str, stamp: Column, stamp_column: str = "updated") -> DataFrame:
    """Upsert that sets ``stamp_column`` to ``stamp`` only where ``value`` changes."""
    old = target.select(*keys, F.col(value).alias("old_"), F.col(stamp_column).alias("stamp_"))
    new = source.join(old, keys, "left").withColumn(stamp_column, F.when(F.col("old_").eqNullSafe(F.col(value)), F.col("stamp_")).otherwise(stamp))
    return upsert(target, new.select(target.columns), keys)


def numbered(df: DataFrame, order: list[str], column: str) -> DataFrame:
    """Rows with numbers 1.. in the given order; ties may stand in any order, but every row gets one number.

    No task sees all rows: range partitions in that order are written once, then counted, and each numbers its own. They are
    written because range bounds come from a sample, which a second evaluation would draw anew.
    """
    ws = Workspace(df.sparkSession, "numbered")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ws.save(ordered.withColumn("row_", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("row_", 33)
    sizes = placed.groupBy(part.alias("part_")).agg(F.count("*").alias("n_"))  # a row for each partition
    before = sizes.withColumn("before_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n_")
    placed = placed.withColumn("part_", part)
    return placed.join(F.broadcast(before), "part_").select(*df.columns, (F.col("before_") + F.col("row_").bitwiseAND((1 << 33) - 1) + 1).alias(column))


def with_ids(natural: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Distinct natural keys with ids 1.. in their order."""
    return numbered(natural.select(*keys).distinct(), keys, id_column)


class StoredIds:
    """Natural keys with ids that never change, in a folder of versions.

    Each load adds one version with the keys that were new to it, numbered after the greatest id so far in their order. A version is
    written aside and renamed when it is complete; the rename fails where another load has taken the number, so that load is made
    again on top of the other. What is read are whole versions, never a load that broke off.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], id_column: str):
        self.spark, self.folder, self.keys, self.id = spark, folder, keys, id_column

    def _versions(self) -> list[int]:
        return sorted(int(name.removeprefix("version=")) for name in folders(self.spark, self.folder) if name.startswith("version="))

    def current(self, versions: list[int] | None = None) -> DataFrame | None:
        """All keys with their ids, of the versions there are (or of those given); None before the first load."""
        versions = self._versions() if versions is None else versions
        if not versions:
            return None
        return self.spark.read.parquet(*[f"{self.folder}/version={v}" for v in versions]).select(self.id, *self.keys)

    def load(self, natural: DataFrame) -> DataFrame:
        """Gives the keys of ``natural`` that have no id one, and returns all keys with their ids. A null is a key like any other."""
        while True:
            versions = self._versions()
            old, new, last = self.current(versions), natural.select(*self.keys).distinct(), 0
            if old is not None:
                known = old.select(*[F.col(k).alias(f"{k}__") for k in self.keys])
                new = new.join(known, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}__")) for k in self.keys]), "left_anti")
                last = old.agg(F.max(self.id)).first()[0] or 0
            ids = numbered(new, self.keys, self.id).withColumn(self.id, F.col(self.id) + last)
            aside = f"{self.folder}/aside-{uuid4().hex}"
            ids.write.parquet(aside)
            if move(self.spark, aside, f"{self.folder}/version={versions[-1] + 1 if versions else 1}", again=True):
                return self.current()


def ids_of_kinds(natural: DataFrame, kind: str, keys: list[str], id_column: str) -> DataFrame:
    """Distinct (kind, keys) with ids that begin at 1 for each kind: many dimensions are numbered at once."""
    all_ = numbered(natural.select(kind, *keys).distinct(), [kind, *keys], "n_")
    first = all_.groupBy(kind).agg(F.min("n_").alias("first_"))
    return all_.join(F.broadcast(first), kind).select(kind, *keys, (F.col("n_") - F.col("first_") + 1).alias(id_column))


def delete_matching(fact: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return fact.join(doomed.select(*keys).distinct(), keys, "left_anti")


def keep_referenced(dim: DataFrame, fact: DataFrame, keys: list[str]) -> DataFrame:
    """Without rows that no fact refers to."""
    return dim.join(fact.select(*keys), keys, "left_semi")


def star_delete(
    fact: DataFrame, run_info: DataFrame, runs: DataFrame, suites: DataFrame, projects: DataFrame, *, run: str, suite: str, named: list[str] | None = None, datasets: list[str] | None = None
) -> DataFrame:
    """Facts (run_info_id, ...) without those of a run and primer suite, of the projects ``named`` and of ``datasets`` (None: of all).

    A run_info row whose run, suite or project isn't known is nobody's, so its facts stay.
    """
    projects = projects if named is None else projects.filter(F.col("project").isin(named))
    doomed = run_info.join(runs.filter(F.col("run") == run), "run_id").join(suites.filter(F.col("suite") == suite), "suite_id").join(projects.select("project_id"), "project_id")
    if datasets is not None:
        doomed = doomed.filter(F.col("dataset").isin(datasets))
    return delete_matching(fact, doomed, ["run_info_id"])


def star_count(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Number of facts that every dimension (with its key) knows."""
    joined = reduce(lambda df, d: df.join(d[0].select(d[1]).distinct(), d[1], "left_semi"), dims, fact)
    return joined.agg(F.count("*").alias("facts"))


def sequence_dim(uniques: DataFrame) -> DataFrame:
    """sequence_id and sequence of the distinct upper-case sequences."""
    upper = F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return with_ids(uniques.select(upper.alias("sequence")), ["sequence"], "sequence_id")


def pdr_fact(uniques: DataFrame, sequences: DataFrame, run_info: DataFrame) -> DataFrame:
    """run_info_id, sequence_id, seq_count. uniques: dataset, seq, seq_count; run_info: dataset, run_info_id."""
    upper = F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    own = uniques.select("dataset", upper.alias("sequence"), "seq_count").join(sequences, "sequence").join(run_info.select("dataset", "run_info_id"), "dataset")
    return own.groupBy("run_info_id", "sequence_id").agg(F.sum("seq_count").alias("seq_count"))


def taxonomy_dim(assigned: DataFrame) -> DataFrame:
    return with_ids(assigned.select("taxonomy"), ["taxonomy"], "taxonomy_id")


def _named_ranks(assigned: DataFrame) -> DataFrame:
    """taxonomy, level and name: eight rows for each distinct taxonomy."""
    padded = S.pad_lineage(S.lineage(F.col("taxonomy")), marts=False)
    return assigned.select("taxonomy").distinct().select("taxonomy", F.posexplode(padded).alias("level", "name"))


def all_rank_dims(assigned: DataFrame) -> DataFrame:
    """level, key, name and id of the distinct names of every rank; names that differ in case alone are one, the first of them."""
    names = _named_ranks(assigned).groupBy("level", F.lower("name").alias("key")).agg(F.min("name").alias("name"))
    return ids_of_kinds(names, "level", ["key", "name"], "id")


def rank_dims(assigned: DataFrame) -> dict[str, DataFrame]:
    """``all_rank_dims`` by rank: key, name and <rank>_id."""
    every = all_rank_dims(assigned)
    return {rank: every.filter(F.col("level") == i).select("key", "name", F.col("id").alias(f"{rank}_id")) for i, rank in enumerate(S.RANKS)}


def snowflake(assigned: DataFrame, dims: DataFrame | None = None) -> DataFrame:
    """taxonomy with its eight rank ids and their silva_taxonomy_id. Names are looked up without regard to case, all at once.

    dims: as of ``all_rank_dims``. A taxonomy with a name that they lack is left out.
    """
    dims = all_rank_dims(assigned) if dims is None else dims
    met = _named_ranks(assigned).withColumn("key", F.lower("name")).join(dims.select("level", "key", "id"), ["level", "key"])
    ids = [f"{rank}_id" for rank in S.RANKS]
    wide = met.groupBy("taxonomy").agg(*[F.max(F.when(F.col("level") == i, F.col("id"))).alias(c) for i, c in enumerate(ids)], F.count("*").alias("met_"))
    wide = wide.filter(F.col("met_") == len(ids)).drop("met_")
    return wide.join(with_ids(wide, ids, "silva_taxonomy_id"), ids)


def per_sequence_taxonomy(assigned: DataFrame, uniques: DataFrame, sequences: DataFrame, taxonomies: DataFrame, ranks: DataFrame) -> DataFrame:
    """sequence_id, taxonomy_id, gast_distance, refssu_count, rank_id: an inner chain, a miss leaves the row out."""
    upper = F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    a = assigned.join(uniques.select(F.col("rep_id").alias("read_id"), upper.alias("sequence")), "read_id")
    return a.join(sequences, "sequence").join(taxonomies, "taxonomy").join(ranks, "rank").select("sequence_id", "taxonomy_id", F.col("distance").alias("gast_distance"), "refssu_count", "rank_id").distinct()


def uniq_info(per_sequence: DataFrame, refs: DataFrame) -> DataFrame:
    """Bridge of sequences to their taxonomy fact. refs: sequence_id, refhvr_ids."""
    return per_sequence.join(refs, "sequence_id", "left").withColumn("refhvr_ids", F.coalesce("refhvr_ids", F.lit("")))


#: A run's dimensions: table, id column and natural key. A dataset is one of its project.
DIMENSIONS = (
    ("runs", "run_id", ("run", "run_prefix")),
    ("run_keys", "run_key_id", ("run_key",)),
    ("dna_regions", "dna_region_id", ("dna_region",)),
    ("primer_suites", "primer_suite_id", ("primer_suite",)),
    ("illumina_indices", "illumina_index_id", ("barcode_index",)),
    ("projects", "project_id", ("project", "project_title", "project_description", "funding")),
    ("datasets", "dataset_id", ("dataset", "dataset_description", "project")),
    ("domains", "domain_id", ("domain",)),
    ("adapter_sequences", "adapter_sequence_id", ("adaptor",)),
    ("sequencing_platforms", "sequencing_platform_id", ("platform",)),
    ("target_genes", "target_gene_id", ("target_gene",)),
    ("env_biomes", "env_biome_id", ("env_biome",)),
    ("env_features", "env_feature_id", ("env_feature",)),
    ("env_materials", "env_material_id", ("env_material",)),
    ("env_packages", "env_package_id", ("env_package",)),
    ("geo_loc_names", "geo_loc_name_id", ("geo_loc_name",)),
)
# The fields of a run's samples, and of what submissions need.
RUN_INFO = ("adaptor", "amp_operator", "barcode", "dataset_id", "dna_region_id", "file_prefix", "illumina_index_id", "insert_size", "lane", "overlap", "platform", "primer_suite_id", "read_length", "run_id", "run_key_id", "seq_operator", "tubelabel", "project_id")
REQUIRED = ("adapter_sequence_id", "dataset_id", "dna_region_id", "domain_id", "env_biome_id", "env_feature_id", "env_material_id", "env_package_id", "geo_loc_name_id", "illumina_index_id", "primer_suite_id", "run_id", "sequencing_platform_id", "target_gene_id")


def _key(samples: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in names if c in samples.columns]


def run_tables(samples: DataFrame) -> dict[str, DataFrame]:
    """The dimensions that samples have columns for; ids go from 1 in the order of the natural keys."""
    tables = {name: with_ids(samples, key, id_) for name, id_, own in DIMENSIONS if own[0] in samples.columns and (key := _key(samples, own))}
    if "projects" in tables:
        tables["projects"] = tables["projects"].withColumn("rev_project_name", F.reverse("project"))
    return tables


def _with_dimensions(samples: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    for name, id_, own in DIMENSIONS:
        if name in tables and id_ not in samples.columns:
            key = _key(samples, own)
            samples = samples.join(tables[name].select(*key, id_), key)
    return samples


def run_info(samples: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per sample: run_info_id and those of RUN_INFO that samples have, names as the ids of their dimensions."""
    df = _with_dimensions(samples, tables)
    fields = [c for c in RUN_INFO if c in df.columns]
    return with_ids(df, fields, "run_info_id").select("run_info_id", *fields)


def required_metadata(samples: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """What submissions need of each dataset, once: those of REQUIRED that samples have."""
    df = _with_dimensions(samples, tables)
    return df.select(*[c for c in REQUIRED if c in df.columns]).distinct()


def reconcile(files: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Counts in files and in the warehouse side by side, with whether they agree. A missing side counts 0."""
    joined = files.select(*keys, F.col("n").alias("file_count")).join(stored.select(*keys, F.col("n").alias("db_count")), keys, "full")
    out = joined.select(*keys, F.coalesce("file_count", F.lit(0)).alias("file_count"), F.coalesce("db_count", F.lit(0)).alias("db_count"))
    return out.withColumn("agrees", F.col("file_count") == F.col("db_count"))


def status_log(log: DataFrame, event: DataFrame, keys: list[str]) -> DataFrame:
    """The run log with the latest status of each key. event: keys, status, at."""
    both = log.unionByName(event)
    return both.groupBy(*keys).agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))
