"""End-to-end flows (X-1, U-2; SURVEY §3 entries A, B, C).

Entry A — one crawl run for every source at once: feeds -> entries ->
link checks -> seen filter -> per-run request de-duplication -> fetched-page
join -> extraction -> validation; outputs accepted / rejected items, the
advanced seen state and per-source counters.

Entry B — landing files -> latest per url -> upsert into the table snapshot
-> archive exactly the files that were read.

Entry C — landing files -> append to the table (``sinks.files.append_table``).

All are lazy DataFrame plans; the caller decides what to write.  Frames that
feed several outputs are persisted by the caller (or checkpointed) once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import urls as U
from inkwell.operators import extract as X
from inkwell.operators import merge as M
from inkwell.operators import quality as V
from inkwell.operators import seen as S
from inkwell.plans.chain import Stage, run_chain, validation
from inkwell.registry import DEFAULT_SOURCES, Source, base_url_for, domains_for
from inkwell.sources.rss import feed_entries, feed_problems, rss_items

COUNTERS = ["entries", "found", "requests", "scraped", "errors", "accepted", "rejected"]


@dataclass
class RunOutputs:
    entries: DataFrame
    requests: DataFrame
    articles: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    seen: DataFrame
    counts: DataFrame
    marks: DataFrame
    dropped: DataFrame
    problems: DataFrame


def crawl_run(feeds: DataFrame, pages: DataFrame, run_ts: str, seen: DataFrame | None = None,
              sources=DEFAULT_SOURCES, default: Source | None = None, ttl_seconds: int = 86400,
              materialize: bool = True, stages: Sequence[Stage] = ()) -> RunOutputs:
    """Entry A for all sources in one plan (U-2: both sources are one DataFrame).

    ``stages`` join the validation (order 200) in the item chain (X-1); what they turn away is rejected too.

    With ``materialize`` the parsed entries, the found links, the requests and the
    extracted articles, each read by several outputs, are written once as reliable checkpoints (in the
    session's shared checkpoint folder) instead of being re-derived per output.
    """
    now = F.lit(run_ts).cast("timestamp")
    entries = feed_entries(rss_items(feeds))
    entries = entries.withColumn("_has_link", U.has_link(F.col("link")))
    if materialize:
        from inkwell.session import checkpoint_root

        checkpoint_root(feeds.sparkSession)
        entries = entries.checkpoint(eager=True)
    # F-1 then P-13.
    linked = entries.filter("_has_link").withColumn(
        "link", U.absolutise(F.col("link"), base_url_for(F.col("source"), sources, default))
    ).withColumn("_run_ts", now)
    # F-2: seen within the TTL for this source -> no request (and not counted).
    if seen is not None:
        st = seen.select("source", F.col("url").alias("_seen_url"), "last_accept_at")
        found = S.drop_recently_seen(linked.withColumn("_seen_url", F.col("link")), st,
                                     ["source", "_seen_url"], "_run_ts", ttl_seconds).drop("_seen_url")
    else:
        found = linked
    if materialize and seen is not None:  # else it is a projection of the stored entries
        found = found.checkpoint(eager=True)
    # F-4 (offsite; a link without a host is) and F-6 (one request per canonical url, earliest entry wins).
    allowed = F.coalesce(U.in_domain(U.host(F.col("link")), domains_for(F.col("source"), sources, default)), F.lit(False))
    onsite = found.filter(allowed)
    keyed = onsite.withColumn("_canon", F.coalesce(U.canonical_url(F.col("link")), F.col("link"))).withColumn(
        "_order", F.struct("feed_no", "item_pos"))
    requests = S.dedupe_requests(keyed, ["source", "_canon"], "_order").drop("_canon", "_order")
    requests = X.with_feed_text(requests)
    if materialize:
        requests = requests.checkpoint(eager=True)
    # J-1 + extraction; status filter F-5 inside.
    extracted = X.extract_articles(requests, pages, sources, keep=["feed_no", "item_pos"], default=default)
    if materialize:
        extracted = extracted.checkpoint(eager=True)
    # V-2: error rows are counted, not yielded and not marked seen; the run goes on.
    articles = extracted.filter(~F.col("error")).drop("error")
    chain = run_chain(articles, [validation(now.cast("timestamp_ntz"), spider_col=F.col("source")), *stages])
    accepted, rejected = chain.items, chain.rejects
    # SNK-6: mark the final url and the requested link (D-6), rejected ones too (D-5).
    marks = articles.select("source", "url").unionByName(articles.select("source", F.col("link").alias("url")))
    marks = marks.filter(F.col("url").isNotNull()).withColumn("ts", now)
    new_seen = S.advance_seen(seen, marks, ["source", "url"], "ts", expired=now - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    counts = run_counts(entries, found, requests, extracted, accepted, rejected) if stages else run_counts(entries, found, requests, extracted)
    dropped = run_dropped(entries, linked, found, found.filter(~allowed), requests, extracted)
    # V-2: what could not be read, per source: whole feeds, and fields of articles.
    feeds_bad = feed_problems(feeds, keep=["source"]).select("source", F.lit("feed").alias("field"), "reason")
    fields_bad = extracted.select("source", F.explode("problems").alias("p")).select("source", "p.field", "p.reason")
    problems = feeds_bad.unionByName(fields_bad).groupBy("source", "field", "reason").agg(F.count(F.lit(1)).alias("n"))
    return RunOutputs(entries, requests.drop("_feed_text"), articles, accepted, rejected, new_seen, counts, marks, dropped, problems)


def run_dropped(entries, linked, found, offsite, requests, extracted) -> DataFrame:
    """Every entry that yields neither an article nor an error row, with the reason (F-1, F-2, F-4, F-6, F-5 / J-1).

    Only entry keys and links are compared; nothing is computed unless the frame is read.
    """
    key = ["source", "feed_no", "item_pos"]

    def why(df, reason):
        return df.select(*key, "link", F.lit(reason).alias("reason"))

    def missing(df, later):
        ids = later.select(*[F.col(k).alias(f"_k_{k}") for k in key])
        return df.join(ids, S._same(df, ids, key), "left_anti")

    onsite = missing(found, offsite)
    parts = [why(entries.filter(~F.col("_has_link")), "no link"), why(missing(linked, found), "seen"), why(offsite, "offsite"),
             why(missing(onsite, requests), "repeated request"), why(missing(requests, extracted), "no usable page")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl_with_state(spark, feeds: DataFrame, pages: DataFrame, run_ts: str, state_dir: str, ttl_seconds: int = 86400, **kw) -> RunOutputs:
    """Entry A against the stored seen state: reads the marks that are alive, appends the
    run's own and deletes the hours that have expired.  A repeated run (same ``run_ts``) gives the same result."""
    from inkwell.operators import seen_state as SS

    at = SS.as_time(run_ts)
    like = spark.createDataFrame([], "source string, url string")
    seen = SS.live_marks(spark, state_dir, like, ["source", "url"], at - _dt.timedelta(seconds=ttl_seconds), but_run=run_ts)
    out = crawl_run(feeds, pages, run_ts, seen=seen, ttl_seconds=ttl_seconds, **kw)
    SS.add_marks(out.marks, state_dir, ["source", "url"], "ts", run_ts)
    SS.expire_marks(spark, state_dir, at, ttl_seconds)
    return out


def run_counts(entries, found, requests, extracted, accepted=None, rejected=None) -> DataFrame:
    """A-1 style counters per source: each table is read and aggregated once, and only the sums are added up.

    As in the reference, found >= scraped + errors, and scraped counts items
    that validation later rejects.  ``accepted`` and ``rejected`` are read only where stages beside the
    validation decide; else the validation's verdict is counted with the articles.
    """
    ok, valid = ~F.col("error"), V.missing_field(extracted).isNull()
    sums = {"scraped": F.count_if(ok), "errors": F.count_if(F.col("error"))}
    if accepted is None:
        sums |= {"accepted": F.count_if(ok & valid), "rejected": F.count_if(ok & ~valid)}
    rows = F.count(F.lit(1))
    parts = [(entries, {"entries": rows}), (found, {"found": rows}), (requests, {"requests": rows}), (extracted, sums)]
    if accepted is not None:
        parts += [(accepted, {"accepted": rows}), (rejected, {"rejected": rows})]
    u = None
    for df, agg in parts:
        part = df.groupBy("source").agg(*[agg.get(c, F.lit(0)).cast("long").alias(c) for c in COUNTERS])
        u = part if u is None else u.unionByName(part)
    return u.groupBy("source").agg(*[F.sum(c).alias(c) for c in COUNTERS])


def etl_flow(spark, landing_dir: str, table_dir: str, archive_dir: str, run_ts: str,
             layout: str = "array", reject_dir: str | None = None) -> int:
    """Entry B end to end: landing files -> constraints -> upsert -> archive what was read.

    Returns the number of landing rows, as the reference's flow does; an
    empty landing returns 0 and neither writes nor archives (D-9).  The read
    is pinned by a checkpoint so the upsert and the archive manifest see the
    same files, and only those files are moved (a file that lands meanwhile
    waits for the next run).  Rows that break a constraint (V-4) are appended as
    JSON to ``reject_dir`` (by default ``<table_dir>_rejects``) with the run and a reason and the
    rest is loaded (D-10).  A failed upsert raises before anything is
    archived, so the next run reloads the same files (at-least-once, and the
    upsert is idempotent).  Files whose rows were in when an earlier run broke are archived
    first and not loaded again.
    """
    from inkwell.session import checkpoint_root
    from inkwell.sinks.archive import archive, resume
    from inkwell.sources.landing import landing_manifest, read_landing

    checkpoint_root(spark)
    resume(spark, landing_dir, archive_dir)
    try:
        landing = read_landing(spark, landing_dir, layout).checkpoint(eager=True)
    except Exception as e:  # no readable file at all: nothing to load
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return 0
        raise
    n = landing.count()
    if n == 0:
        return 0
    rows, rejects = V.load_constraints(M.to_load_rows(landing.withColumn("raw_date", F.col("date"))))
    run = rejects.withColumn("run_ts", F.lit(run_ts))
    run.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts") \
        .json(reject_dir or table_dir.rstrip("/") + "_rejects")
    M.upsert_into(spark, table_dir, rows, run_ts)
    archive(spark, landing_manifest(landing), landing_dir, archive_dir)
    return n
