"""Queries of the marts: every other read is loaded first, then all reads, so the second load stores what the first one lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts
from ..sources import sinks
from ..sources.shared import Workspace
from . import views as V
from .registration import query

_FIRST = "read_id % 2 = 0"


def _inputs(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reads, assignments of some of them, and a project's information for each of their sources."""
    own = V.reads(spark, sf).select("read_id", F.col("sample").alias("project"), F.col("lane").alias("dataset"), "seq")
    told = V.assigned(spark, sf).filter("read_id % 3 > 0").select("read_id", "taxonomy", F.col("read_id").cast("string").alias("refhvr_ids"), F.lit("class").alias("rank"), F.lit(0.5).alias("distance"))
    p = F.col("project")
    info = own.select("project").distinct().select(
        "project", F.concat(F.lit("title of "), p).alias("title"), F.lit("reads").alias("description"), F.lit("First Last").alias("contact"), F.concat(p, F.lit("@site")).alias("email"),
        F.lit("an institution").alias("institution"), F.concat(F.lit("user"), F.length(p).cast("string")).alias("user"), F.lit(100).alias("env_source_id"),
    )
    return own, told, info


def _loaded(spark, sf, *names: str) -> DataFrame:
    """The first of the named marts after both loads."""
    own, told, info = _inputs(spark, sf)
    store = marts.MartStore(spark, Workspace(spark, "marts").path("store"))
    for reads in (own.filter(_FIRST), own):
        projects = info.join(reads.select("project").distinct(), "project", "left_semi")
        store.load(marts.build(reads, told, projects, "2024-01-31", only=names))
    return store.read(names[0])


_PAD = "array_to_string([coalesce(string_split({t}, ';')[i], ['superkingdom','phylum','class','order','family','genus','species','strain'][i] || '_NA') for i in range(1, 9)], ';')"


def _ctes(k: int, condition: str) -> str:
    """Reads of a load, their assignments, the cube and its sums."""
    return f"""own{k} as (select read_id, upper(substr(sample, 1, 1)) || substr(sample, 2) as project, lane as dataset, seq from reads where {condition}),
  told{k} as (select o.*, a.taxonomy as whole, regexp_replace(a.taxonomy, ';NA$', '') as taxonomy from own{k} o join assigned a on a.read_id = o.read_id and a.read_id % 3 > 0),
  tot{k} as (select project, dataset, count(*) as dataset_count from told{k} group by all),
  cube{k} as (select project, dataset, taxonomy, count(*) as knt, count(*) / dataset_count as frequency, dataset_count from told{k} join tot{k} using (project, dataset) group by project, dataset, taxonomy, dataset_count),
  base{k} as (select project, dataset, dataset_count, knt, {_PAD.format(t="taxonomy")} as t from cube{k}),
  levels{k} as (select project, dataset, dataset_count, knt, lv as rank, array_to_string(string_split(t, ';')[1:lv + 1], ';') as taxonomy from base{k}, (select unnest(range(0, 8)) as lv)),
  roll{k} as (select project, dataset, rank, taxonomy, cast(sum(knt) as bigint) as sum_tax_counts, sum(knt) / dataset_count as frequency, dataset_count from levels{k} group by project, dataset, rank, taxonomy, dataset_count)"""


def _both(rows: str, key: str) -> str:
    """Rows of the first load (@ is its number), then those of the second whose key it lacks."""
    names = key.split(", ")
    return f"""with one as ({rows.replace('@', '1')}), two as ({rows.replace('@', '2')})
  select * from one union all select * from two where not exists (select 1 from one where {' and '.join(f'one.{n} is not distinct from two.{n}' for n in names)})"""


_SQL = (V.READS, V.ASSIGNED, _ctes(1, _FIRST), _ctes(2, "true"))


def _sql(rows: str, key: str, final: str = "*") -> str:
    return f"select {final} from ({_both(rows, key)})"


@query(_sql("""select project, dataset, taxonomy, string_split(t, ';')[1] as superkingdom, string_split(t, ';')[2] as phylum, string_split(t, ';')[3] as class, string_split(t, ';')[4] as orderx, string_split(t, ';')[5] as family, string_split(t, ';')[6] as genus,
  string_split(t, ';')[7] as species, string_split(t, ';')[8] as strain, ['domain', 'phylum', 'class', 'orderx', 'family', 'genus', 'species', 'strain'][len(string_split(taxonomy, ';'))] as rank, knt, frequency, dataset_count, 'GAST' as classifier
  from (select *, """ + _PAD.format(t="taxonomy") + " as t from cube@)", "project, dataset, taxonomy"), *_SQL)
def mart_data_cube(spark, sf):
    return _loaded(spark, sf, "data_cube")


@query(_sql("select taxonomy, sum_tax_counts, frequency, dataset_count, rank, project, dataset, project || '--' || dataset as project_dataset, 'GAST' as classifier from roll@", "project, dataset, taxonomy, rank"), *_SQL)
def mart_summed_cube(spark, sf):
    return _loaded(spark, sf, "summed_cube")


@query(_sql("select distinct taxonomy as taxon_string, rank, case when rank = 7 or taxonomy like '%\\_NA' escape '\\' then 0 else 1 end as num_kids from roll@", "taxon_string, rank"), *_SQL)
def mart_taxonomy(spark, sf):
    return _loaded(spark, sf, "taxonomy")


@query(_sql("""select md5(u.seq) as sequence, u.project, u.dataset, coalesce(a.taxonomy, '') as taxonomy, coalesce(cast(a.read_id as varchar), '0') as refhvr_ids, case when a.read_id is null then 'NA' else 'class' end as rank,
  u.n as seq_count, u.n / t.dataset_count as frequency, case when a.read_id is null then 1.0 else 0.5 end::double as distance, u.read_id, u.project || '--' || u.dataset as project_dataset
  from (select project, dataset, seq, min(read_id) as read_id, count(*) as n from own@ group by all) u left join (select read_id, taxonomy from assigned) a on a.read_id = u.read_id and a.read_id % 3 > 0
  join (select project, dataset, count(*) as dataset_count from own@ group by all) t using (project, dataset)""", "project, dataset, read_id"), *_SQL)
def mart_sequences(spark, sf):
    return _loaded(spark, sf, "sequences").withColumn("sequence", F.md5("sequence"))


@query(_sql("select read_id, project, dataset, cast(read_id as varchar) as refhvr_ids, 0.5::double as distance, whole as taxonomy, md5(seq) as sequence, 'class' as rank, '2024-01-31' as date_trimmed from told@", "project, dataset, read_id"), *_SQL)
def mart_exports(spark, sf):
    return _loaded(spark, sf, "exports").withColumn("sequence", F.md5("sequence"))


@query(_sql("select project, dataset, count(*) as dataset_count, '2024-01-31' as date_trimmed, dataset as dataset_info from own@ group by all", "project, dataset", "*, case when project in (select project from told2) then 1 else 0 end::bigint as has_tax"), *_SQL)
def mart_projects_datasets(spark, sf):
    return _loaded(spark, sf, "projects_datasets", "data_cube")


@query("""select project, 'title of ' || sample as title, 'reads' as description, 'First Last' as contact, sample || '@site' as email, 'an institution' as institution, 'user' || cast(length(sample) as varchar) as user, 100::bigint as env_source_id,
  case when project in (select project from told2) then 1 else 0 end::bigint as has_tax from (select distinct sample, upper(substr(sample, 1, 1)) || substr(sample, 2) as project from reads)""", *_SQL)
def mart_project_info(spark, sf):
    return _loaded(spark, sf, "project_info", "data_cube")


@query("select distinct upper(substr(sample, 1, 1)) || substr(sample, 2) as project, 'user' || cast(length(sample) as varchar) as user from reads", V.READS)
def mart_users(spark, sf):
    return _loaded(spark, sf, "users")


@query("select project, dataset, taxonomy, cast(knt as varchar) as knt, cast(dataset_count as varchar) as dataset_count, 'GAST' as classifier, string_split(t, ';')[8] as strain from (select *, " + _PAD.format(t="taxonomy") + " as t from cube2)", *_SQL)
def mart_cube_file(spark, sf):
    """A mart as the file that is loaded elsewhere, with all its columns, read again."""
    own, told, info = _inputs(spark, sf)
    path = Workspace(spark, "marts").path("cube")
    sinks.write_mart_tsv(marts.build(own, told, info, "2024-01-31", only=("data_cube",))["data_cube"], path)
    back = spark.read.csv(path, sep="\t", header=True)
    return back.filter("HEADER is null").select("project", "dataset", "taxonomy", "knt", "dataset_count", "classifier", "strain")
