r"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

Each rule compares one share of a text with a cutoff. All cutoffs move along one path of ``LEVELS``
levels from loose to strict, written down beforehand. For each stratum (a language of a given list,
or ``other``), labelled good documents that pass the base rules are a holdout: of n of them a level
rejects k. A level is allowed if the exact binomial probability of k or fewer rejections, were the
true rate of false rejections ``ALPHA``, is at most ``DELTA`` divided by the number of strata times
levels (Bonferroni). So with probability 1 - DELTA no stratum's chosen level rejects more than ALPHA of good documents.
Of the allowed levels, the one with the greatest difference between rejected shares of bad and good
labelled documents is chosen, ties going to the loosest; a stratum without an allowed level rejects nothing.

Texts aren't shuffled: one pass makes a narrow table of counts, and only counts by stratum and level
(at most strata times levels plus one rows) and the chosen levels (one row a stratum, broadcast) are gathered.
Repeated 8-word windows are found by hashing pairs, fours and eights of words, and where a text has
equal hashes, by sorting its (hash, position) pairs, so a text of n words takes n log n steps.

Defined results: null text counts as empty and fails the base rules. Null language is ``other``. A
document with several labels is good if any says so; null ids are never labelled. Repeated rows are
judged alike. Empty tables give no rows, and without labels nothing but the base rules rejects. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table

STRATA = ("de", "en", "es", "fr")
ALPHA, DELTA, LEVELS = 0.05, 0.05, 16
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Rule: share, loosest cutoff, strictest cutoff. A document is rejected where its share is above the cutoff.
RULES = {"symbols": (0.40, 0.02), "dup_lines": (0.95, 0.25), "repeats": (0.30, 0.10), "capitals": (0.90, 0.25), "bangs": (1.50, 0.30)}
_BLANK, _CAPITALS, _SYMBOLS = " \t\n\x0b\f\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#*$%&|<>"


def _occurrences(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _BLANK[1:], " " * (len(_BLANK) - 1)), " "), "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of 8 found at least twice in the text."""

    def paired(hashes: Column, apart: int) -> Column:
        n = F.greatest(F.size(hashes) - apart, F.lit(0))
        return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(apart + 1), n), lambda a, b: F.xxhash64(a, b))

    def covered(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(F.transform(s, lambda e, k: F.when((e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"]), e["i"])), lambda i: i.isNotNull())
        steps = lambda p: F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.get(p, k + 1) - i)), F.lit(0), lambda a, b: a + b)
        return let(by_hash, lambda s: let(F.sort_array(again(s)), steps))

    eights = let(paired(words, 1), lambda a: let(paired(a, 2), lambda b: paired(b, 4)))
    return let(eights, lambda h: F.when(F.size(h) > F.size(F.array_distinct(h)), covered(h)).otherwise(F.lit(0))).cast("long")


def measure(docs: DataFrame, strata: tuple[str, ...] = STRATA, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The counts of every document, whether the base rules fail it, and the first level that rejects it (LEVELS + 1: none)."""
    text, lang = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(lang_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(lang.isin(*strata), lang).otherwise(F.lit("other")).alias("stratum"), text.alias("_text"))
    both = let(words_of(F.col("_text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, _BLANK, "")) > 0)
    lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    rows = rows.select(
        "doc_id", "stratum", both.alias("w"), lines.alias("l"),
        F.length(F.translate("_text", _BLANK, "")).cast("long").alias("word_chars"),
        _occurrences(F.col("_text"), _SYMBOLS).alias("n_symbols"), _occurrences(F.col("_text"), _CAPITALS).alias("n_capitals"), _occurrences(F.col("_text"), "!").alias("n_bangs"),
    )
    rows = rows.select("doc_id", "stratum", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.d").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"), F.col("l.n").alias("n_lines"), "n_capitals", "n_bangs")
    over = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    shares = {"symbols": over("n_symbols", "word_chars"), "dup_lines": over("n_dup_lines", "n_lines"), "repeats": over("n_repeat_words", "n_words"), "capitals": over("n_capitals", "word_chars"), "bangs": over("n_bangs", "n_words")}
    first = [F.greatest(F.floor((F.lit(loose) - shares[rule]) / F.lit((loose - strict) / (LEVELS - 1))).cast("int") + 2, F.lit(1)) for rule, (loose, strict) in RULES.items()]
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select("*", base.alias("base_failed"), F.least(*first, F.lit(LEVELS + 1)).alias("first_level"))


def binomial_cdf(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate), summed term by term in logarithms; 1 where k is at or over its mean.

    For a k far from zero the sum starts 40 standard deviations below it: what it leaves out is under 1e-300.
    """
    k, n, one = k.cast("double"), n.cast("double"), F.lit(1.0)
    low = F.floor(k - 40 * F.sqrt(n * rate) - 40).cast("double")
    low = F.when(low < 64, F.lit(0.0)).otherwise(low)
    stirling = lambda x: x * F.log(x) - x + 0.5 * F.log(F.lit(6.283185307179586) * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    log_odds = F.log(F.lit(rate)) - F.log(one - rate)
    log_choose = F.when(low == 0, F.lit(0.0)).otherwise(stirling(n) - stirling(low) - stirling(n - low))
    start = log_choose + low * F.log(F.lit(rate)) + (n - low) * F.log(one - rate)
    steps = F.sequence(F.lit(0), F.greatest((k - low).cast("int"), F.lit(0)))

    def body(z: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            at = z["low"] + i.cast("double")
            term = F.when(i == 0, z["start"]).otherwise(acc["t"] + F.log((z["n"] - at + 1) / at) + log_odds)
            return F.struct(term.alias("t"), (acc["s"] + F.exp(term)).alias("s"))

        return F.aggregate(z["steps"], F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("s")), add, lambda acc: acc["s"])

    parts = F.struct(low.alias("low"), start.alias("start"), n.alias("n"), steps.alias("steps"))
    return F.when(k >= n * rate, one).otherwise(let(parts, body))


def choose_levels(measured: DataFrame, labels: DataFrame, strata: tuple[str, ...] = STRATA, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """(stratum, level) for each stratum of which some level is allowed."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(quality_col).cast("int")).alias("good"))
    seen = measured.where(~F.col("base_failed")).join(one, F.col("doc_id") == F.col("_id"))
    counts = seen.groupBy("stratum", "first_level").agg(F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") != 1).alias("bad"))
    levels = F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("level")
    each = counts.select("*", levels).groupBy("stratum", "level").agg(
        F.sum("good").alias("n"), F.sum(F.when(F.col("first_level") <= F.col("level"), F.col("good")).otherwise(0)).alias("k"),
        F.sum("bad").alias("bad_n"), F.sum(F.when(F.col("first_level") <= F.col("level"), F.col("bad")).otherwise(0)).alias("bad_k"),
    )
    allowed = each.where(binomial_cdf(F.col("k"), F.col("n"), alpha) <= delta / ((len(strata) + 1) * LEVELS))
    ratio = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    gain = ratio("bad_k", "bad_n") - ratio("k", "n")
    return allowed.groupBy("stratum").agg(F.max_by(F.col("level"), F.struct(gain, -F.col("level"))).alias("level"))


def judge(measured: DataFrame, levels: DataFrame) -> DataFrame:
    """``measured`` with ``level`` (null: none allowed) and ``kept``."""
    chosen = F.broadcast(levels.select(F.col("stratum").alias("_s"), "level"))  # one row a stratum of the given list
    rows = measured.join(chosen, F.col("stratum") == F.col("_s"), "left").drop("_s")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("level").isNull() | (F.col("first_level") > F.col("level"))))


def op1_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(measure(table(spark, sf_dir, "documents")), "quality")
    rows = judge(measured, choose_levels(measured, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "first_level", "level")


def _oracle() -> str:
    shares = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars"), "bangs": ("n_bangs", "n_words")}
    first = ", ".join(f"greatest(floor((cast({loose} as double) - {a}::double / greatest({b}, 1)::double) / cast({(loose - strict) / (LEVELS - 1)!r} as double))::int + 2, 1)" for rule, (loose, strict) in RULES.items() for a, b in [shares[rule]])
    blank, count = r"[\x20\x09-\x0D]", lambda kind: f"length(regexp_replace(t, '[^{kind}]', '', 'g'))"
    return rf"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t, case when lang in ({", ".join(f"'{s}'" for s in STRATA)}) then lang else 'other' end stratum from documents),
w as (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w from d),
g as (select r, i, array_to_string(w[i : i + 7], ' ') g from (select r, w, unnest(range(1, len(w) - 6)) i from w)),
rep as (select r, unnest(range(i, i + 8)) p from (select r, i, count(*) over (partition by r, g) n from g) where n > 1),
nr as (select r, count(distinct p) n_repeat_words from rep group by r),
l as (select r, unnest(string_split(t, chr(10))) l from d),
nl as (select r, count(*) n_lines, count(*) - count(distinct l) n_dup_lines from l where regexp_matches(l, '[^\x20\x09-\x0D]') group by r),
c as (select d.doc_id, d.stratum, len(w.w) n_words, length(regexp_replace(t, '{blank}', '', 'g')) word_chars, {count("#*$%&|<>")} n_symbols, {count("A-Z")} n_capitals, {count("!")} n_bangs,
 coalesce(n_repeat_words, 0) n_repeat_words, coalesce(n_lines, 0) n_lines, coalesce(n_dup_lines, 0) n_dup_lines from d join w using (r) left join nr using (r) left join nl using (r)),
m as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words base_failed, least({first}, {LEVELS + 1}) first_level from c),
q as (select doc_id, max(quality) good from labels where doc_id is not null and quality is not null group by doc_id),
e as (select stratum, level, count(*) filter (good = 1) n, count(*) filter (good = 1 and first_level <= level) k, count(*) filter (good <> 1) bad_n, count(*) filter (good <> 1 and first_level <= level) bad_k
 from m join q using (doc_id), (select unnest(range(1, {LEVELS + 1})) level) where not base_failed group by all),
p as (select *, case when k >= n * {ALPHA} then 1 else (select sum(exp(case when i = 0 then 0 else lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) end + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA}))) from (select unnest(range(0, k + 1)) i)) end cdf from e),
chosen as (select stratum, arg_max(level, (bad_k::double / greatest(bad_n, 1) - k::double / greatest(n, 1)) * 1e6 - level * 1e-6) level from p where cdf <= {DELTA} / {(len(STRATA) + 1) * LEVELS} group by stratum)
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols, n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
 not base_failed and (level is null or first_level > level) kept, stratum, first_level::int first_level, level::int as level
from m left join chosen using (stratum)"""


QUERIES = {"op1_risk_controlled_quality": op1_risk_controlled_quality}
ORACLES = {"op1_risk_controlled_quality": _oracle()}
