"""X-1: items go through an ordered chain of stages with a channel for rejects.

A stage is a function of the items' DataFrame, placed by its order number and not by where it
is listed (equal numbers keep their listing).  It returns the items that go on or, if it can turn items
away, a pair (items that go on, rejected rows with a ``reason``).  Rejected rows never reach a later
stage; they are collected with the name of the stage that turned them away, whatever columns they have
there.  A ``sink`` stage is called for its effect, once its input is stored, and passes the items on.

Stages compose one lazy plan.  ``store`` writes a stage's input as a reliable checkpoint first: ask for it
where the input is dear and the stage turns items away, because both outputs read it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators import quality as V
from inkwell.session import checkpoint_root


@dataclass(frozen=True)
class Stage:
    name: str
    order: int
    fn: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame] | None]
    sink: bool = False
    store: bool = False


@dataclass
class Chained:
    items: DataFrame
    rejects: DataFrame | None  # None if no stage turns items away

    def reject_counts(self, *by: str) -> DataFrame:
        """Rejects by stage, reason and ``by``; reasons that name the item make a row each, so give columns that bound them."""
        return self.rejects.groupBy("stage", *(by or ["reason"])).agg(F.count(F.lit(1)).alias("n"))


def run_chain(items: DataFrame, stages: Sequence[Stage]) -> Chained:
    names = [s.name for s in stages]
    if len(set(names)) < len(names):
        raise ValueError(f"stages of one name: {names}")
    rejects = None
    for stage in sorted(stages, key=lambda s: s.order):
        if stage.store or stage.sink:
            checkpoint_root(items.sparkSession)
            items = items.checkpoint(eager=True)
        out = stage.fn(items)
        if stage.sink:
            continue
        items, turned_away = out if isinstance(out, tuple) else (out, None)
        if turned_away is not None:
            turned_away = turned_away.withColumn("stage", F.lit(stage.name))
            rejects = turned_away if rejects is None else rejects.unionByName(turned_away, allowMissingColumns=True)
    return Chained(items, rejects)


def validation(run_ts, order: int = 200, strict: bool = False, spider_col: Column | None = None, store: bool = False) -> Stage:
    """F-3, P-14, P-15 and V-1: required fields, stripping, run stamp."""
    return Stage("validation", order, lambda df: V.validate(df, run_ts, strict, spider_col), store=store)


def reject_where(name: str, order: int, reasons: Sequence[tuple[Column, str]], store: bool = False) -> Stage:
    """Turns away rows for the first condition that holds; a NULL condition does not."""
    def fn(df: DataFrame):
        reason = F.lit(None).cast("string")
        for condition, text in reversed(reasons):
            reason = F.when(condition, F.lit(text)).otherwise(reason)
        tagged = df.withColumn("reason", reason)
        return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())

    return Stage(name, order, fn, store=store)


def export(out_dir: str, run_date: str, order: int = 400, columns: Sequence[str] | None = None, **kw) -> Stage:
    """SNK-1 / SNK-2 as a sink stage; ``kw`` as ``export_articles``."""
    from inkwell.sinks.files import export_articles

    return Stage("export", order, lambda df: export_articles(df.select(*columns) if columns else df, out_dir, run_date, **kw), sink=True)
