"""Queries of the thirteen operators, over whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrowfile, brown, chat, decontam, exact, langid, minhash, packing, quality, resample, sequenced, suffix, toxicity
from ._shared import Workspace, crc_mod


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(crc_mod("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return langid.predict(docs, model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"), length=100, keep=False)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), "byte", end_id=2, capacity=1024)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op7_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Workspace(spark, "tokens").path("files")
    parts = arrowfile.write_parts(_table(spark, sf_dir, "documents"), folder, _tokenizer("word_bpe_49k.json"), "word", end_id=1)
    return arrowfile.read_documents(parts, folder)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(_table(spark, sf_dir, "conversations"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.filter(crc_mod("doc_id", 5) != 0))
    return toxicity.score(docs, model, spans=False).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = brown.score_corpus(docs, docs.filter(crc_mod("doc_id", 7) != 2))
    return scored.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_sequenced_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches are cut by a day that a hash of change_id delays; rows of one in eleven hashes are lost, so numbers are missing."""
    raw = _table(spark, sf_dir, "client_changes").distinct()
    h = F.crc32(F.coalesce(F.col("change_id").cast("string"), F.lit("null")))
    day = F.unix_date(F.to_date("valid_at")) + (2 * (h % 4)).cast("int")
    lost = F.col("valid_at").isNull() | (h % 11 == 0)
    batch = F.greatest(F.lit(1), F.least(F.lit(8), 1 + F.floor((day - 19723) * 8 / 160))).cast("int")
    changes = raw.withColumns({"day": F.when(~lost, day), "batch": F.when(~lost, batch)})
    done = sequenced.apply_changes(changes, batches=8, wait=5)
    cents = F.floor(100 * F.col("balance") + 0.5).cast("long").alias("cents")
    return done.select("change_id", "client_id", "status", "batch", "missed", "city", cents, "current")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.filter(crc_mod("doc_id", 5) != 0))
    return quality.score(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=1)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_id,
        op3_suffix_array,
        op4_minhash,
        op5_packing,
        op6_exact_dedup,
        op7_arrow_tokens,
        op8_chat,
        op9_toxicity,
        op10_brown,
        op11_sequenced_changes,
        op12_quality,
        op13_importance_resampling,
    )
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STRIPPED = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"

#: crc32 of a word's bytes, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::bigint),
  lambda c, b: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(3988292384, x >> 1) else x >> 1 end, xor(c, b)), 4294967295::bigint))"""

ORACLE: dict[str, str] = {
    "op13_importance_resampling": f"""
        with d as (select doc_id, 0 as aim, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') as text from documents
                   union all select null, 1, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') from benchmark),
        o as (select row_number() over () as row, * from d),
        f as (select row, aim, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from o),
        c as (select w, {_CRC} % 10000 as bucket from (select distinct w from f)),
        n as (select bucket, count(*) filter (aim = 0) as s, count(*) filter (aim = 1) as t from f join c using (w) group by bucket),
        g as (select bucket, floor(1000 * ln(((t + 1)::double * (sum(s) over () + 10000)::double) / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain from n),
        v as (select row, count(*) as n_features, sum(gain)::bigint as weight from f join c using (w) join g using (bucket) where aim = 0 group by row),
        x as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                     coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
              from o left join v using (row) where aim = 0),
        r as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
                     count(*) filter (n_features >= 20) over () as runs from x)
        select doc_id, n_features, weight, score, case when n_features >= 20 and place <= runs * 10 // 100 then place end as rank from r""",
    "op6_exact_dedup": f"""
        with d as (select doc_id, length(coalesce(text, '')) as size, sha256({_STRIPPED}) as sha from documents),
        w as (select *, first_value(doc_id) over (partition by sha order by size desc, doc_id) as keep_id,
                     count(*) over (partition by sha) as group_size from d)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha as text_sha256 from w""",
    "op4_minhash": f"""
        with recursive d as (
          select doc_id, [w for w in string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\\x20\\x09-\\x0D]+') if w <> ''] as w from documents),
        s as (select distinct doc_id, g from (select doc_id, unnest(
          case when len(w) > 1 then [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] else w end) as g from d)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by all),
        l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
        both_ways as (select x, y from l union all select y, x from l),
        r as (select doc_id as x, doc_id as y from documents union select r.x, b.y from r join both_ways b on r.y = b.x),
        m as (select x as doc_id, min(y) as component_id from r group by x)
        select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from m left join n using (doc_id)""",
    "op8_chat": """
        with r as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
                   from conversations where conv_id is not null),
        p as (select conv_id,
                     row_number() over w as k,
                     count(*) over (partition by conv_id) as n,
                     string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') over w as prefix
              from r window w as (partition by conv_id order by turn, role, text)),
        f as (select prefix, n, min(conv_id) as conv_id, count(*) as snapshots from p where k = n group by prefix, n)
        select conv_id, n as n_turns, snapshots, prefix as text from f
        where prefix not in (select prefix from p where k < n)""",
}
