"""The trimming chain: run key, sample, near primer, anchor, far primer, lengths, Ns, quality. Every read stays, with its reason."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import sequence as S
from .derep import counts
from .names import name_blocks
from .prefixes import prefix_join
from .primers import Anchor, PrimerSuite, find_anchor, trim_anchor, trim_distal, trim_proximal


@dataclass(frozen=True)
class TrimParams:
    """anchor holds for all samples, and its windows count from what follows the near primer, whichever way it is read elsewhere;
    what stands up to its end is kept. ``forced_key`` is taken as every read's run key, whatever it begins with.
    ``offset``: reads without ``scores`` are judged by their ascii ``qual`` from that character code on.
    run_keys: in the order in which they are tried, or a table (run_key, place) of any number of them."""

    min_length: int = 50
    max_length: int | None = None
    max_n: int = 0
    min_quality: float = 30
    require_distal: bool = True
    anchor: Anchor | None = None
    fuzzy_anchor: bool = True
    run_keys: tuple[str, ...] | DataFrame = field(default_factory=tuple)
    forced_key: str | None = None
    offset: int | None = None


def _by_suite(suites: dict[str | None, PrimerSuite], f) -> Column:
    """f of each row's own suite. Branches of other suites aren't worked out."""
    (_, first), *rest = suites.items()
    if not rest and None in suites:
        return f(first)
    out = None
    for name, suite in suites.items():
        out = F.when(F.col("suite") == name, f(suite)) if out is None else out.when(F.col("suite") == name, f(suite))
    return out


def trim_reads(reads: DataFrame, samples: DataFrame, suite: PrimerSuite | dict[str, PrimerSuite], direction: str | None, params: TrimParams) -> DataFrame:
    """Adds run_key, sample, idx_key, trimmed, exact_left, exact_right, primer_name, orientation, deleted, delete_reason.

    reads: read_id, lane, seq and, optionally, scores. samples: run_key, lane, sample. A run of several kinds of samples is
    trimmed in one pass: ``suite`` then has the suites by name, and samples a column suite with a sample's; without ``direction``
    samples have that too ('F', 'R' or 'B'). A run's samples are broadcast, so that reads stay where they are. Reasons, each overruling those before: Proximal, Minimum Length, Distal, No Insert /
    Minimum Length / Maximum Length; then, only without a reason, N (counted on the raw read) and Quality. A read without a known
    run key is 'Runkey', one whose key has no sample 'Lanekey'; they aren't trimmed. A near primer at the read's second base is
    named 'offset '.
    """
    p = params
    suites = suite if isinstance(suite, dict) else {None: suite}
    own = [c for c in ("suite", "direction") if c in samples.columns and (c == "suite") <= isinstance(suite, dict) and (c == "direction") <= (direction is None)]
    if p.forced_key is None and isinstance(p.run_keys, DataFrame):
        df = prefix_join(reads, "seq", p.run_keys.select("run_key", "place"), "run_key", "place").drop("place")
    else:
        df = reads.withColumn("run_key", F.lit(p.forced_key) if p.forced_key is not None else S.first_prefix(F.col("seq"), list(p.run_keys)))
    df = df.join(F.broadcast(samples.select("run_key", "lane", "sample", *own)), ["run_key", "lane"], "left")
    df = df.withColumn("body_", S.without_prefix(F.col("seq"), F.col("run_key")))
    df = df.withColumn("near_", _by_suite(suites, lambda x: trim_proximal(F.col("body_"), x.proximal))).withColumn("one_", F.col("near_.seq"))
    found = F.lit(None).cast("struct<sequence: string, start: int, end: int, ratio: double>")
    if p.anchor:
        found = find_anchor(F.col("one_"), replace(p.anchor, reversed=False), p.fuzzy_anchor)
    short = F.length("one_") < p.min_length
    df = df.withColumn("anchor_", found).withColumn("anchor_", F.when(~short, F.col("anchor_")))
    df = df.withColumn("two_", trim_anchor(F.col("one_"), F.col("anchor_"), False))
    plain = ~short & F.col("anchor_").isNull()
    df = df.withColumn("far_", F.when(plain, _by_suite(suites, lambda x: trim_distal(F.col("two_"), x.distal))))
    df = df.withColumn("trimmed", F.coalesce("far_.seq", "two_"))
    n = F.length("trimmed")
    lengths = F.when(n == 0, "No Insert").when(n < p.min_length, "Minimum Length")
    if p.max_length:
        lengths = lengths.when(n > p.max_length, "Maximum Length")
    distal = F.when(plain & (F.col("far_.at") < 0) & F.lit(p.require_distal), "Distal")
    early = F.when(short | (F.col("anchor_").isNotNull() & (F.length("two_") < p.min_length)), "Minimum Length")
    proximal = F.when((F.col("near_.primer") == "") & _by_suite(suites, lambda x: F.lit(bool(x.proximal))), "Proximal")
    reason = F.coalesce(lengths, distal, early, proximal, F.when(S.count_of(F.col("seq")) > p.max_n, "N"))
    if "scores" in reads.columns:
        df = df.withColumn("mean_", S.window_mean(F.col("seq"), F.col("trimmed"), F.col("scores")))
        reason = F.coalesce(reason, F.when(F.col("mean_") < p.min_quality, "Quality"))
    elif p.offset is not None:
        df = df.withColumn("early_", reason)
        judged = F.when(F.col("early_").isNull() & F.col("sample").isNotNull(), F.col("trimmed"))
        df = df.withColumn("mean_", S.window_mean_of(F.col("seq"), judged, F.col("qual"), p.offset))
        reason = F.coalesce("early_", F.when(F.col("mean_") < p.min_quality, "Quality"))
    reason = F.when(F.col("run_key").isNull(), "Runkey").when(F.col("sample").isNull(), "Lanekey").otherwise(reason)
    known = F.col("sample").isNotNull()
    turned = F.lit(direction == "R") if direction is not None else F.col("direction") == "R"
    left = F.col("near_.primer")
    told = {
        "run_key": F.col("run_key"),
        "sample": F.col("sample"),
        "idx_key": F.when(known, F.concat_ws("_", "lane", "run_key")),
        "trimmed": F.when(known, F.when(turned, S.revcomp(F.col("trimmed"))).otherwise(F.col("trimmed"))).otherwise(F.col("seq")),
        "exact_left": F.when(known, left),
        "exact_right": F.when(known, F.coalesce("far_.primer", "anchor_.sequence", F.lit(""))),
        "primer_name": F.when(known, F.when((left != "") & (F.col("near_.at") > 0), "offset ").otherwise(F.col("near_.name"))),
        "orientation": F.when(known, F.when(left != "", "+").otherwise("")),
        "deleted": F.col("reason_").isNotNull(),
        "delete_reason": F.col("reason_"),
    }
    # as a row of one: a filter on a reason would else be pushed into the chain, which it would spell out again and again
    row = F.inline(F.array(F.struct(*[c.alias(name) for name, c in told.items()])))
    return df.withColumn("reason_", reason).select(*reads.columns, row)


def trim_outputs(trimmed: DataFrame, keys: list[str], position: str = "read_id", only: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """What a trimming run leaves: trimmed, unique, abundance, names (in blocks), deleted, no_key, stats (reason counts) and
    unique_counts (each key's number of uniques). ``only`` makes no more than it names: names are numbered when they are made."""
    passed = trimmed.filter("not deleted").select(*dict.fromkeys([*keys, "read_id", position]), F.col("trimmed").alias("seq"))
    unique = counts(passed, keys, position)
    deleted = trimmed.filter("deleted")
    tables = {
        "trimmed": lambda: passed,
        "unique": lambda: unique.select(*keys, F.concat("rep_id", F.lit("|frequency:"), "seq_count").alias("id"), "seq"),
        "abundance": lambda: unique.select(*keys, F.concat("rep_id", F.lit(";size="), "seq_count").alias("id"), "seq", "seq_count"),
        "names": lambda: name_blocks(passed, keys, position),
        "deleted": lambda: deleted.filter("delete_reason not in ('Runkey', 'Lanekey')").select(*keys, "read_id", "delete_reason"),
        "no_key": lambda: deleted.filter("delete_reason = 'Runkey'").select("read_id", "delete_reason"),
        "stats": lambda: reason_counts(trimmed, keys),
        "unique_counts": lambda: unique.groupBy(*keys).agg(F.count("*").alias("uniques")),
    }
    return {name: make() for name, make in tables.items() if only is None or name in only}


def reason_counts(trimmed: DataFrame, keys: list[str]) -> DataFrame:
    return trimmed.groupBy(*keys, F.coalesce("delete_reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("reads"))


#: The reasons for which a read is deleted.
REASONS = ("Runkey", "Lanekey", "Proximal", "Distal", "N", "Quality", "No Insert", "Minimum Length", "Maximum Length")


def write_counted(trimmed: DataFrame, path: str, codec: str = "zstd") -> dict[str, int]:
    """Writes trimmed reads as Parquet and returns what was counted on the way: raw, passed, deleted, bases kept, and each of REASONS.

    The chain runs once: the counters are observed where rows are written, whose tasks count once however often they are tried, and
    a few numbers come back, whatever the size. An empty table has zeros.
    """
    kept = ~F.col("deleted")
    counters = {
        "raw": F.count("*"),
        "passed": F.count_if(kept),
        "deleted": F.count_if("deleted"),
        "bases": F.coalesce(F.sum(F.when(kept, F.length("trimmed")).cast("long")), F.lit(0).cast("long")),
        **{r: F.count_if(F.col("delete_reason") == r) for r in REASONS},
    }
    seen = Observation("trimmed")
    trimmed.observe(seen, *[c.alias(name) for name, c in counters.items()]).write.option("compression", codec).parquet(path)
    return {name: int(seen.get.get(name) or 0) for name in counters}


def with_scores(reads: DataFrame, offset: int = 33) -> DataFrame:
    """reads with ``scores`` of their ascii ``qual``."""
    return reads.withColumn("scores", Q.scores(F.col("qual"), offset))
