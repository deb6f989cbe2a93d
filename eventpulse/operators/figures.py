"""Published figures. They count by name and login, and over undeduplicated lake rows: marts do neither."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.functions.events import BUSY_FLOOR, json_text, short_name_matches



def _repo() -> Column:
    return json_text("repo", "name")


def _login() -> Column:
    return json_text("actor", "login")


def overview(lake: DataFrame) -> DataFrame:
    return lake.agg(
        F.count("*").alias("events"), F.countDistinct("dt").alias("days"), F.countDistinct(F.struct("dt", "hr")).alias("hours"),
        F.countDistinct(_repo()).alias("repos"), F.countDistinct(_login()).alias("actors"), F.countDistinct("type").alias("types"),
    )


def days(lake: DataFrame) -> DataFrame:
    return lake.select(F.col("dt").alias("day")).distinct()


def day_gaps(lake: DataFrame) -> DataFrame:
    """Present days, each with the days since the one before. The window runs over distinct days only."""
    ordered = Window.orderBy("day")
    return days(lake).select("day", F.datediff("day", F.lag("day").over(ordered)).cast("bigint").alias("gap"))


def day_span(lake: DataFrame) -> DataFrame:
    """Calendar days from the first day to the last, both counted; none where there is no day."""
    return days(lake).agg((F.datediff(F.max("day"), F.min("day")) + 1).cast("bigint").alias("span"))


def type_histogram(lake: DataFrame) -> DataFrame:
    return lake.groupBy("type").agg(F.count("*").alias("n"))


def top_types(lake: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` most frequent types, ties by name; the others pooled."""
    ranked = type_histogram(lake).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "type")))
    rest = F.sum(F.when(F.col("rank") > top, 1)).over(Window.partitionBy())
    label = F.when(F.col("rank") <= top, F.col("type")).otherwise(F.concat(rest.cast("string"), F.lit(" other types")))
    return ranked.select(label.alias("label"), "n").groupBy("label").agg(F.sum("n").alias("n"))


def per_repo_single_actor(lake: DataFrame) -> DataFrame:
    repos = lake.groupBy(_repo().alias("repo")).agg(F.count("*").alias("events"), F.countDistinct(_login()).alias("actors")).where("repo is not null")
    one = F.col("actors") == 1
    return repos.agg(F.count("*").alias("repos"), F.count_if(one).alias("single_actor_repos"), F.sum("events").alias("events"), F.sum(F.when(one, F.col("events"))).alias("single_actor_events"))


def repo_days(lake: DataFrame, day: str | None = None) -> DataFrame:
    rows = lake if day is None else lake.where(F.col("dt") == F.lit(day).cast("date"))
    return rows.where(_repo().isNotNull()).groupBy(F.col("dt").alias("day"), _repo().alias("repo")).agg(F.count("*").alias("events"), F.countDistinct(_login()).alias("actors"))


def automated(busy: int = BUSY_FLOOR) -> Column:
    return (F.col("events") >= busy) & (F.col("actors") == 1)


def per_day_automated(lake: DataFrame, busy: int = BUSY_FLOOR) -> DataFrame:
    hit = short_name_matches(F.col("repo"))
    return repo_days(lake).groupBy("day").agg(
        F.count("*").alias("repo_days"), F.sum("events").alias("events"), F.count_if(automated(busy)).alias("automated_repo_days"), F.sum(F.when(automated(busy), F.col("events"))).alias("automated_events"),
        F.count_if(hit).alias("pattern_repo_days"), F.sum(F.when(hit, F.col("events"))).alias("pattern_events"),
    )


def pooled_share(per_day: DataFrame) -> DataFrame:
    """Over all days together: the pattern's and the automated share of events, in percent, and the points from the least to the greatest daily automated share."""
    share = lambda part: 100.0 * F.coalesce(F.sum(part), F.lit(0)) / F.sum("events")
    daily = 100.0 * F.coalesce("automated_events", F.lit(0)) / F.col("events")
    return per_day.agg(share("pattern_events").alias("pattern_percent"), share("automated_events").alias("automated_percent"), (F.max(daily) - F.min(daily)).alias("automated_points"))


def agreement(per_day: DataFrame, scores: DataFrame, day: str) -> DataFrame:
    """What two derivations of the held-out day's figures say, one row each figure; ``agrees`` is false where they differ or the day isn't there."""
    one = per_day.where(F.col("day") == F.lit(day).cast("date")).agg(*(F.max(c).alias(f"d_{c}") for c in ("events", "repo_days", "pattern_events", "pattern_repo_days")))
    both = scores.join(one)  # two rows of one
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("figure"), F.col(f"d_{c}").alias("by_day"), F.col(c).alias("held_out")) for c in ("events", "repo_days", "pattern_events", "pattern_repo_days"))))
    return both.select(pairs.alias("p")).select("p.*").withColumn("agrees", F.col("by_day").eqNullSafe(F.col("held_out")) & (F.col("by_day").isNotNull() | F.col("figure").startswith("pattern")))


def held_out_scores(lake: DataFrame, day: str, busy: int = BUSY_FLOOR) -> DataFrame:
    """One row of counts for a day that no rule was fitted on."""
    marked = repo_days(lake, day).withColumn("name_hit", short_name_matches(F.col("repo")))
    is_busy, one, hit = F.col("events") >= busy, F.col("actors") == 1, F.col("name_hit")
    return marked.agg(
        F.count("*").alias("repo_days"), F.sum("events").alias("events"), F.count_if(is_busy).alias("busy_repo_days"), F.count_if(is_busy & one).alias("busy_single_actor"),
        F.count_if(hit).alias("pattern_repo_days"), F.sum(F.when(hit, F.col("events"))).alias("pattern_events"), F.count_if(is_busy & hit).alias("rule_positives"), F.count_if(is_busy & hit & one).alias("rule_tp"),
    )


def rates(scores: DataFrame) -> DataFrame:
    """Rates of a score row. A rate without a denominator is an error: no plausible zero is made up."""
    ratio = lambda a, b: F.when(F.col(b) == 0, F.raise_error(F.lit(f"no {b} to divide by")).cast("double")).otherwise(F.col(a).cast("double") / F.col(b))
    r = scores.select(ratio("busy_single_actor", "busy_repo_days").alias("base_rate"), ratio("rule_tp", "rule_positives").alias("precision"), ratio("rule_tp", "busy_single_actor").alias("recall"))
    f1 = lambda p, q: 2 * p * q / (p + q)
    return r.select("*", f1(F.col("precision"), F.col("recall")).alias("f1"), f1(F.col("base_rate"), F.lit(1.0)).alias("baseline_f1"), (F.col("precision") / F.col("base_rate")).alias("lift"))


def watches_outside_automated(lake: DataFrame, busy: int = BUSY_FLOOR) -> DataFrame:
    """Stars, and those whose repository-day isn't automated; stars without a repository are outside. One pass over the stars."""
    bots = repo_days(lake).where(automated(busy)).select(F.col("day").alias("_day"), F.col("repo").alias("_repo"))
    stars = lake.where("type = 'WatchEvent'").select("dt", _repo().alias("repo"))
    met = stars.join(bots, (F.col("dt") == F.col("_day")) & (F.col("repo") == F.col("_repo")), "left")
    return met.agg(F.count("*").alias("watches"), F.count_if(F.col("_repo").isNull()).alias("watches_outside"))
