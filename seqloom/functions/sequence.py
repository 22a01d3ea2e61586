"""Sequence and string functions on columns. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality as Q

# Complements of bases.
BASES, COMPLEMENTS = "ACGTRYMK", "TGCAYRKM"
DNA_FROM, DNA_TO = "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb"
RNA_FROM, RNA_TO = "ACGURYKMBDHVacgurykmbdhv", "UGCAYRMKVHDBugcayrmkvhdb"
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species", "strain")
PADDING = ("superkingdom", "phylum", "class", "order", "family", "genus", "species", "strain")
NO_NAME = ("NA", "", "Unassigned")

#: Color-space digits: the digit of two neighbouring bases is the exclusive or of their numbers.
COLOR_BASES = "ACGT"
# The digits where one or both bases are unknown, and what stands for any other character.
TO_UNKNOWN, FROM_UNKNOWN, BOTH_UNKNOWN, NO_COLOR = "4", "5", "6", "."
#: The one environment whose name is shortened.
MISCELLANEOUS = "miscellaneous_natural_or_artificial_environment"


def revcomp(seq: Column) -> Column:
    """Reverse complement of A C G T R Y M K; every other character stays as it is."""
    return F.translate(F.reverse(seq), BASES, COMPLEMENTS)


def revcomp_strict(seq: Column) -> Column:
    """Reverse complement of A C G T N, '.' becoming N; null where another character stands."""
    return F.when(seq.rlike("^[ACGTN.]*$"), F.translate(F.reverse(seq), "ATCGN.", "TAGCNN"))


def complement(seq: Column, rna: bool = False) -> Column:
    return F.translate(seq, RNA_FROM, RNA_TO) if rna else F.translate(seq, DNA_FROM, DNA_TO)


def iupac_revcomp(seq: Column, rna: bool = False) -> Column:
    return F.reverse(complement(seq, rna))


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "Tt", "Uu")


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "Uu", "Tt")


def is_dna(seq: Column) -> Column:
    return ~F.lower(seq).contains("u")


def color_encode(seq: Column, adapter: str = "G") -> Column:
    """Base space to color space, the adapter's base first. Bases are capital letters; another character counts as unknown after
    itself, and its own digit is ``.``. An adapter other than A, C, G, T or N is an error."""
    if len(adapter) != 1 or adapter not in f"{COLOR_BASES}N":
        raise ValueError(f"{adapter!r} is no adapter base")
    whole = F.concat(F.lit(adapter), seq)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(seq), F.lit(1))), lambda i: F.substring(whole, i, F.lit(2)))

    def digit(pair: Column) -> Column:
        last, base = F.substring(pair, 1, 1), F.substring(pair, 2, 1)
        a, b = (F.instr(F.lit(COLOR_BASES), x) for x in (last, base))
        unknown = F.when(base == "N", F.when(a > 0, TO_UNKNOWN).otherwise(BOTH_UNKNOWN)).when(b > 0, FROM_UNKNOWN).otherwise(NO_COLOR)
        return F.when((a > 0) & (b > 0), (a - 1).bitwiseXOR(b - 1).cast("string")).otherwise(unknown)

    body = F.array_join(F.transform(pairs, digit), "")
    return F.when(F.length(seq) > 0, F.concat(F.lit(adapter), body)).otherwise(F.lit(adapter))


def color_decode(colors: Column, unknown: str = "N") -> Column:
    """Color space, adapter base first, to base space. After an unknown color no base is known until the end. A first character
    that is no adapter base is an error."""
    adapter = F.substring(colors, 1, 1)
    steps = F.split(F.substring(colors, F.lit(2), F.length(colors)), "")
    start = F.struct(F.when(adapter.isin(*COLOR_BASES, "N"), adapter).otherwise(F.raise_error(F.concat(F.lit("no adapter base: "), colors))).alias("last"), F.lit("").alias("out"))

    def step(state: Column, c: Column) -> Column:
        at = F.instr(F.lit(COLOR_BASES), state["last"])
        number = F.when(c.rlike("^[0-3]$"), c.cast("int"))
        base = F.when((at > 0) & number.isNotNull(), F.substring(F.lit(COLOR_BASES), (at - 1).bitwiseXOR(number) + 1, F.lit(1))).otherwise(unknown)
        return F.when(c == "", state).otherwise(F.struct(base.alias("last"), F.concat(state["out"], base).alias("out")))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def reverse_read(df: DataFrame) -> DataFrame:
    """Reads (seq, qual, ...) read from their other end, qualities with their bases."""
    return df.withColumns({"seq": F.reverse("seq"), "qual": F.reverse("qual")})


def complement_read(df: DataFrame) -> DataFrame:
    """Reads with complementary bases; a read with a u is RNA. Qualities stay in place."""
    return df.withColumn("seq", F.when(is_dna(F.col("seq")), complement(F.col("seq"))).otherwise(complement(F.col("seq"), rna=True)))


def revcomp_read(df: DataFrame) -> DataFrame:
    return complement_read(reverse_read(df))


def count_of(seq: Column, base: str = "N") -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def first_prefix(seq: Column, keys: list[str]) -> Column:
    """The first of ``keys``, in list order, that ``seq`` begins with; null if none does."""
    return F.coalesce(*[F.when(seq.startswith(k), F.lit(k)) for k in keys]) if keys else F.lit(None).cast("string")


def without_prefix(seq: Column, key: Column) -> Column:
    return F.when(key.isNotNull(), F.substring(seq, F.length(key) + 1, F.length(seq))).otherwise(seq)


def direction(forward: Column, reverse: Column) -> Column:
    """'F', 'R' or '0' by which kind of primer was found; forward wins."""
    return F.when(forward, "F").when(reverse, "R").otherwise("0")


def window_mean(raw: Column, trimmed: Column, scores: Column) -> Column:
    """Mean of the scores of the first place where the trimmed sequence stands in the raw one."""
    n = F.length(trimmed)
    part = F.slice(scores, F.greatest(F.position(trimmed, raw), F.lit(1)), n)
    return Q.summary(part)["total"] / F.when(n > 0, n)


def window_mean_of(raw: Column, trimmed: Column, qual: Column, offset: int = 33) -> Column:
    """``window_mean`` by ascii qualities. A null ``trimmed`` gives null and costs nothing."""
    n = F.length(trimmed)
    return Q.total(F.substring(qual, F.greatest(F.position(trimmed, raw), F.lit(1)), n), offset) / F.when(n > 0, n)


def cut(seq: Column, start: int = 0, end: int | None = None) -> Column:
    """``seq[start:end]`` with Python's rules for negative and large numbers."""
    n = F.length(seq)

    def at(k: int) -> Column:
        return F.least(F.lit(k), n) if k >= 0 else F.greatest(n + k, F.lit(0))

    first, last = at(start), n if end is None else at(end)
    return F.substring(seq, first + 1, F.greatest(last - first, F.lit(0)))


def cut_array(values: Column, start: int = 0, end: int | None = None) -> Column:
    n = F.size(values)

    def at(k: int) -> Column:
        return F.least(F.lit(k), n) if k >= 0 else F.greatest(n + k, F.lit(0))

    first, last = at(start), n if end is None else at(end)
    return F.slice(values, first + 1, F.greatest(last - first, F.lit(0)))


def strip_trailing_n(seq: Column) -> Column:
    return F.regexp_replace(seq, "N+$", "")


def size_defline(defline: Column) -> Column:
    """'frequency:' written as ';size='."""
    return F.replace(defline, F.lit("|frequency:"), F.lit(";size="))


def frequency_defline(defline: Column) -> Column:
    return F.replace(defline, F.lit(";size="), F.lit("|frequency:"))


def frequency(defline: Column) -> Column:
    """The number after the last ':' of the part after the last '|'; null where that is none."""
    return F.element_at(F.split(F.element_at(F.split(defline, "[|]"), -1), ":"), -1).try_cast("int")


def illumina_header(header: Column) -> dict[str, Column]:
    """The ten fields of a CASAVA 1.8 header. filter_flag is the raw letter; 'Y' means failed chastity."""
    parts = F.split(F.ltrim(header, F.lit("@")), ":")
    names = ("machine", "run_id", "flowcell", "lane", "tile", "x", "y_pair", "filter_flag", "control_bits", "index_seq")
    out = {n: F.get(parts, i) for i, n in enumerate(names)}
    pair = F.split(out.pop("y_pair"), " ")
    return out | {"y": F.get(pair, 0), "pair_no": F.get(pair, 1).try_cast("int")}


def mate_header(header: Column) -> Column:
    """The second read's header for the first read's: '<id> 1:rest' becomes '<id> 2:rest'."""
    parts = F.split(header, " ")
    return F.concat(F.get(parts, 0), F.lit(" 2:"), F.regexp_replace(F.get(parts, 1), "^[^:]*:", ""))


def mate_id(name: Column) -> Column:
    return F.when(name.endswith("/1"), F.regexp_replace(name, "/1$", "/2")).when(name.endswith("/2"), F.regexp_replace(name, "/2$", "/1")).otherwise(name)


def is_first_mate(name: Column) -> Column:
    return ~name.endswith("/2")


def demux_key(index: Column, seq: Column, lane: Column, inline_n: bool = False, nextseq: bool = False) -> Column:
    """index, run key and lane joined by '_'. The run key is the first five bases, or NNNN and bases 5 to 9."""
    run_key = F.concat(F.lit("NNNN"), F.substring(seq, 5, 5)) if inline_n else F.substring(seq, 1, 5)
    return F.concat_ws("_", index, run_key, F.lit("1") if nextseq else lane)


def normalize_suite(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[_ -]", "")


def capitalize(name: Column) -> Column:
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name)))


def normalize_env_source(name: Column) -> Column:
    """The long name of miscellaneous environments is shortened; in any other '_' becomes a space."""
    return F.when(name == MISCELLANEOUS, "miscellaneous").otherwise(F.translate(name, "_", " "))


def file_base(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+?)(?:[.][^./]*)?$", 1)


def file_prefix(index: Column, run_key: Column, lane: Column) -> Column:
    return F.concat_ws("_", index, run_key, lane)


def subtract_first(seq: Column, part: Column) -> Column:
    """Without the first occurrence of ``part``."""
    at = F.position(part, seq)
    return F.when((at > 0) & (F.length(part) > 0), F.concat(F.substring(seq, F.lit(1), at - 1), F.substring(seq, at + F.length(part), F.length(seq)))).otherwise(seq)


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def big_number(n: Column) -> Column:
    return F.format_number(n, 0)


def last_position(seq: Column, part: Column) -> Column:
    """Zero-based place of the last occurrence, -1 if there is none."""
    at = F.position(F.reverse(part), F.reverse(seq))
    return F.when(at > 0, F.length(seq) - F.length(part) - at + 1).otherwise(-1)


def ratio(a: str, b: str) -> float:
    """2 * LCS / (length of both): 1 for equal strings; a substitution costs as much as an insertion and a deletion.

    The longest common subsequence comes from one whole number whose bits are the places of ``a`` not matched so far.
    """
    if not a and not b:
        return 1.0
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    whole = free = (1 << len(a)) - 1
    for c in b:
        hit = free & place.get(c, 0)
        free = (free + hit | free - hit) & whole
    return 2.0 * (len(a) - free.bit_count()) / (len(a) + len(b))


def indel_ratio(a: Column, b: Column) -> Column:
    """``ratio`` of two columns; null where one is null."""

    @F.arrow_udf("double")
    def ratios(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if s is None or t is None else ratio(s, t) for s, t in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.float64())

    return ratios(a, b)


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def lineage(taxonomy: Column) -> Column:
    """The names of a ';' lineage, trimmed."""
    return F.transform(F.split(taxonomy, ";"), lambda t: F.trim(t))


def depth(names: Column) -> Column:
    """The last index with a name, or -1."""
    named = F.filter(F.sequence(F.lit(0), F.size(names) - 1), lambda i: ~F.get(names, i).isin(*NO_NAME))
    return F.coalesce(F.array_max(named), F.lit(-1))


def rank_of(names: Column, rank: str) -> Column:
    return F.get(names, RANKS.index(rank))


def depth_name(names: Column) -> Column:
    """The rank of the deepest name."""
    return F.get(F.array(*map(F.lit, RANKS)), depth(names))


def pad_lineage(names: Column, marts: bool = True) -> Column:
    """Eight names: missing ones are '<rank>_NA' in marts, empty in the warehouse."""
    blanks = F.array(*[F.lit(f"{r}_NA" if marts else "") for r in PADDING])
    return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.coalesce(F.get(names, i), F.get(blanks, i)))


def strip_na(taxonomy: Column) -> Column:
    return F.regexp_replace(taxonomy, ";NA$", "")
