"""The published figures as one static page. Nothing is published unless two derivations of the held-out day agree.

Every cell is text when it leaves the query: ``FIGURES`` says which columns of the one row of all figures a cell is made of, and as what kind.
"""

from __future__ import annotations

import html
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.functions.events import BUSY_FLOOR
from eventpulse.functions.show import cell
from eventpulse.operators import figures


class FiguresDisagree(RuntimeError):
    """Two derivations of one figure differ."""


@dataclass(frozen=True)
class Table:
    title: str
    head: tuple[str, ...]
    rows: tuple[tuple[str, ...], ...]


#: The figures of one row each: table, its columns, and for each line its label and the (kind, columns, places) of its cells.
FIGURES = (
    ("Events", ("Figure", "Value"), (
        ("Events", ("count", "events", 0)), ("Days", ("count", "days", 0)), ("Calendar days", ("count", "span", 0)), ("Hours", ("count", "hours", 0)), ("Repositories", ("count", "repos", 0)),
        ("Accounts", ("count", "actors", 0)), ("Event types", ("count", "types", 0)), ("Files", ("count", "files", 0)), ("Size", ("bytes", "size", 2)),
    )),
    ("Of a single account", ("Of", "All", "Single account", "Share"), (
        ("Repositories", ("count", "r_repos", 0), ("count", "r_single_actor_repos", 0), ("share", "r_single_actor_repos", "r_repos", 2)),
        ("Events", ("count", "r_events", 0), ("count", "r_single_actor_events", 0), ("share", "r_single_actor_events", "r_events", 2)),
    )),
    ("Name pattern on the held-out day", ("Rule", "Precision", "Recall", "F1", "Lift"), (
        ("All", ("number", "base_rate", 4), ("number", "one", 4), ("number", "baseline_f1", 4), ("times", "one", 2)),
        ("Name pattern", ("number", "precision", 4), ("number", "recall", 4), ("number", "f1", 4), ("times", "lift", 2)),
    )),
    ("All days", ("Figure", "Value"), (
        ("Automated", ("percent", "automated_percent", 2)), ("By pattern", ("percent", "pattern_percent", 2)), ("Points from the least day to the greatest", ("number", "automated_points", 2)),
        ("Stars", ("count", "watches", 0)), ("Stars outside automated repository-days", ("share", "watches_outside", "watches", 2)),
    )),
)


def _lines(row: DataFrame, lines: tuple) -> tuple[tuple[str, ...], ...]:
    texts = [F.array(*(cell(kind, *columns[:-1], places=columns[-1]) for kind, *columns in cells)).alias(f"line{k}") for k, (_, *cells) in enumerate(lines)]
    told = row.select(*texts).first()
    return tuple((label, *told[k]) for k, (label, *_) in enumerate(lines))


def gather(lake: DataFrame, held_out: str, size: int, files: int, busy: int = BUSY_FLOOR) -> list[Table]:
    """The page's tables, all of them text. Raises where the cross-check fails, or a share has no whole."""
    per_day, scores = figures.per_day_automated(lake, busy).cache(), figures.held_out_scores(lake, held_out, busy).cache()
    try:
        if wrong := figures.agreement(per_day, scores, held_out).where("not agrees").orderBy("figure").collect():
            raise FiguresDisagree("; ".join(f"{r.figure} of {held_out}: {r.by_day} by day, {r.held_out} held out" for r in wrong))
        repos = figures.per_repo_single_actor(lake)
        row = figures.overview(lake).select("*", F.lit(size).cast("bigint").alias("size"), F.lit(files).alias("files"), F.lit(1.0).alias("one"))
        for more in (figures.day_span(lake), repos.select(*(F.col(c).alias(f"r_{c}") for c in repos.columns)), figures.rates(scores), figures.pooled_share(per_day), figures.watches_outside_automated(lake, busy)):
            row = row.join(more)  # one row each
        row = row.cache()
        try:
            told = [Table(title, head, _lines(row, lines)) for title, head, lines in FIGURES]
            types = figures.top_types(lake).join(row.select("events")).select("n", "label", cell("count", "n").alias("a"), cell("share", "n", "events", places=3).alias("b"))
            told.append(Table("Types", ("Type", "Events", "Share"), tuple((r.label, r.a, r.b) for r in types.orderBy(F.desc("n"), "label").collect())))
            days = per_day.select("day", cell("count", "events").alias("a"), cell("share", "automated_events", "events").alias("b"), cell("share", "automated_repo_days", "repo_days").alias("c"))
            told.append(Table("Automated share by day", ("Day", "Events", "Automated", "Repository-days"), tuple((str(r.day), r.a, r.b, r.c) for r in days.orderBy("day").collect())))
            return told
        finally:
            row.unpersist()
    finally:
        per_day.unpersist()
        scores.unpersist()


def render(tables: list[Table]) -> str:
    """The page's text; the same tables give the same bytes."""
    line = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{html.escape(x)}</{tag}>" for x in cells) + "</tr>"
    parts = [f"<h2>{html.escape(t.title)}</h2>\n<table>\n" + "\n".join([line("th", t.head), *(line("td", r) for r in t.rows)]) + "\n</table>" for t in tables]
    return '<!doctype html>\n<html lang="en">\n<meta charset="utf-8">\n<title>Events</title>\n' + "\n".join(parts) + "\n</html>\n"
