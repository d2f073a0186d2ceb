"""PII by weak supervision, in DataFrame operations only.

Base spans (email, ip, card, phone) come from fixed patterns and checks and always
stay.  Looser candidates (a spelled-out email, a national phone number, a personal
number) are decided by weak supervision.  Four labelers vote on every span or abstain: the format
check (base kinds only; candidates have none), gazetteers of top domains, issuer and
area codes, cues around the span, and the variety of its digits.  Expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability and each kind's share without
labels; an abstention says nothing.  The resulting soft labels train a logistic span
classifier that sees no vote but features of its own: the kind with the cues around it, what stands
directly before and after, the digits, and the check.  A candidate joins the
result if it does not touch a base span and the classifier is at least ``MIN_P`` sure.

The corpus is read once into a narrow, checkpointed table of spans.  The driver gets
only counts per vote pattern (at most kinds x 3**4 rows, whatever the data) and per feature
combination (at most kinds x 900), over all spans.  Positions are running sums of gap and match lengths in a window per
document and kind, so a document with very many spans stays linear.  Patterns use
possessive quantifiers and start only where a run starts, so runs of any length
take linear time and no stack.

Defined cases: null and empty texts have no span; rows that repeat id and text get
the same spans; positions count code points, ends are exclusive; an empty table
gives an empty result and trains nothing; other columns of the input are not read, so no name can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm.common import checkpoint, hash128, text_or_empty

MIN_P = 0.9
CONTEXT = 40
BASE = ("email", "ip", "card", "phone")
# Equal to the plain patterns of the contract: a run is tried from its start (or from
# the last match) only, as every later start in the run fails in the same way.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_spelled": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}"
                     r"(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,63}){1,4}",
    "phone_national": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
    "personal_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = tuple(PATTERNS)
_NEEDS = {"email": "@", "phone": r"\+[0-9]", "email_spelled": r"(?i)[\[(]at[\])]"}
# Gazetteers and context cues: fixed word lists.
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "us"]
CUES = (r"(?i)\b(?:e-?mail|mail|contact|reach|write|call|phone|tel|fax|mobile|cell|ssn|social security|personal number|"
        r"card|visa|mastercard|ip|address|kontakt|telefon|courriel|correo|tarjeta|carte)\b")
COUNTER_CUES = r"(?i)\b(?:isbn|issn|doi|version|invoice|order|serial|part|page|section|fig)\b"
LABELERS = ("format", "gazetteer", "context", "shape")
FEATURES = ("cue", "cue_after", "check", "left", "right", "variety")  # the first three count per kind


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(acc, x, i):
        d = x.cast("int") * (i % 2 + 1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    marked = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.pmod(F.aggregate(marked, F.lit(0), lambda acc, s: add(acc, s["x"], s["i"])), F.lit(10)) == 0


def passes(kind: Column, m: Column) -> Column:
    """The check of a base match (candidates of other kinds have none)."""
    digits = _digits(m)
    n = F.length(digits)
    part = F.transform(F.split(m, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return (
        F.when(kind == "ip", F.forall(part, lambda p: (F.length(p) <= 2) | ((F.length(p) == 3) & (p <= "255"))))
        .when(kind == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(True)
    )


def _matches(kind: str, text: Column) -> tuple[Column, Column]:
    """(matches, gaps): gap i comes before match i; their lengths give the positions."""
    pattern = F.lit(PATTERNS[kind])
    needs = text.rlike(_NEEDS.get(kind, "[0-9]"))
    return (F.when(needs, F.regexp_extract_all(text, pattern, F.lit(0))), F.when(needs, F.split(text, PATTERNS[kind], -1)))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow table of all base matches and candidates with positions and votes."""
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    text = docs.select(k1.alias("_k1"), k2.alias("_k2"), text_or_empty(text_col).alias("_t")) \
        .filter(F.col("_t").rlike(r"[0-9@]|(?i)[\[(]at[\])]"))
    found = text.select("_k1", "_k2", *[c for k in KINDS for m, g in [_matches(k, F.col("_t"))]
                                        for c in (m.alias(f"m_{k}"), g.alias(f"g_{k}"))])
    empty = F.array().cast("array<struct<kind:string,i:int,m:string,gap:int,ctx:string,aft:string>>")

    def placed(k: str) -> Column:
        gap = F.col(f"g_{k}")
        return F.transform(f"m_{k}", lambda m, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), m.alias("m"), F.length(F.get(gap, i)).alias("gap"),
            F.right(F.get(gap, i), F.lit(CONTEXT)).alias("ctx"), F.left(F.get(gap, i + 1), F.lit(CONTEXT)).alias("aft")))

    listed = [F.coalesce(placed(k), empty) for k in KINDS]
    rows = found.select("_k1", "_k2", F.explode(F.concat(*listed)).alias("s")).select("_k1", "_k2", "s.*").distinct()
    upto = Window.partitionBy("_k1", "_k2", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("m")).over(upto)) \
        .withColumn("start", F.col("end") - F.length("m"))
    rows = rows.withColumn("base", F.col("kind").isin(*BASE)).withColumn("ok", passes(F.col("kind"), F.col("m")))
    # A candidate must not touch a base span of the document.
    order = Window.partitionBy("_k1", "_k2").orderBy("start", F.col("base").desc(), "kind")
    strong = F.col("base") & F.col("ok")
    before = F.max(F.when(strong, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # The same order from its end: a frame that ends unbounded is computed anew for every row.
    turned = Window.partitionBy("_k1", "_k2").orderBy(F.col("start").desc(), "base", F.col("kind").desc())
    after = F.min(F.when(strong, F.col("start"))).over(turned.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).withColumn("after", after)
    free = (F.coalesce(F.col("before"), F.lit(-1)) <= F.col("start")) & (F.coalesce(F.col("after"), F.col("end")) >= F.col("end"))
    m, ctx, digits = F.col("m"), F.col("ctx"), _digits(F.col("m"))
    top = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    email = F.col("kind").isin("email", "email_spelled")
    gazetteer = (
        F.when(email, vote(top.isin(TOP_DOMAINS), F.lit(True)))
        .when(F.col("kind") == "ip", vote(F.lit(False), m.rlike(r"^(?:0|127|255)\.")))
        .when(F.col("kind") == "card", vote(digits.rlike("^(?:3[47]|4|5[1-5]|2[2-7]|6)"), F.lit(True)))
        .when(F.col("kind") == "personal_number", vote(F.lit(False), digits.rlike("^(?:000|666|9)|^...00|0000$")))
        .otherwise(vote(F.lit(False), digits.rlike("^[01]"))))
    distinct = F.size(F.array_distinct(F.split(digits, "")))
    shape = F.when(email, 0).otherwise(vote(distinct >= 4, F.lit(True)))
    aft = F.col("aft")
    told = ctx.rlike(CUES) | aft.rlike(CUES)
    # A loose candidate without any cue is taken for a number or an address in passing.
    context = F.when(ctx.rlike(COUNTER_CUES), -1).when(told, 1).when(F.col("base"), 0).otherwise(-1)

    def neighbour(c: Column) -> Column:
        return (F.when(c == "", "edge").when(c.rlike(r"\s"), "space").when(c.rlike(r"[\p{L}\p{N}]"), "word")
                .when(c.rlike("[\\[\\](){}<>'\"]"), "bracket").otherwise("punct"))

    return rows.select(
        "_k1", "_k2", "kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "base", "ok",
        (~F.col("base") & free).alias("open"), F.when(F.col("base"), vote(F.col("ok"), ~F.col("ok"))).otherwise(0).alias("format"), gazetteer.alias("gazetteer"),
        context.alias("context"), shape.alias("shape"),
        F.when(ctx.rlike(COUNTER_CUES), "counter").when(ctx.rlike(CUES), "cue").otherwise("none").alias("cue"),
        F.when(aft.rlike(CUES), "cue").otherwise("none").alias("cue_after"), F.when(~F.col("base"), "none").when(F.col("ok"), "passed").otherwise("failed").alias("check"),
        neighbour(F.right(ctx, F.lit(1))).alias("left"), neighbour(F.left(aft, F.lit(1))).alias("right"),
        F.when(distinct >= 4, "many").when(distinct >= 2, "few").otherwise("none").alias("variety"))


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], float]], kinds: list[str] | None = None, rounds: int = 50) -> list[float]:
    """Posterior of each vote pattern being PII: two classes, a share per kind, and a reliability
    table per labeler, one for the base kinds and one for the loose kinds (the same digits often match a
    base pattern and fail its check, which says nothing of the cues around them).  Abstentions (0) are left out.

    It starts from the belief that the labelers are mostly right, which also names the classes.
    """
    if not patterns:
        return []
    n = len(patterns[0][0])
    kinds = kinds or [""] * len(patterns)
    post = [1 / (1 + math.exp(-2 * sum(p))) for p, _ in patterns]
    for _ in range(rounds):
        share = {}
        for k in set(kinds):
            own = [(q, c) for q, (_, c), x in zip(post, patterns, kinds) if x == k]
            share[k] = (sum(q * c for q, c in own) + 1) / (sum(c for _, c in own) + 2)
        table = {}
        for group in (True, False):
            own = [(q, c, p) for q, (p, c), k in zip(post, patterns, kinds) if (k in BASE) is group]
            for j in range(n):
                row = {}
                for v in (-1, 1):
                    # Smoothed towards a labeler that is right more often than wrong.
                    pos = sum(q * c for q, c, p in own if p[j] == v) + (2 if v == 1 else 1)
                    neg = sum((1 - q) * c for q, c, p in own if p[j] == v) + (2 if v == -1 else 1)
                    row[v] = (pos, neg)
                sums = [row[-1][k] + row[1][k] for k in (0, 1)]
                for v in (-1, 1):
                    table[group, j, v] = math.log(row[v][0] / sums[0]) - math.log(row[v][1] / sums[1])
        post = []
        for (p, _), k in zip(patterns, kinds):
            odds = math.log(share[k] / (1 - share[k])) + sum(table[k in BASE, j, v] for j, v in enumerate(p) if v)
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return post


def feature_names(kind: str, values: tuple[str, ...]) -> list[str]:
    """The classifier's features of a span: some by kind, and the neighbourhood for all kinds alike."""
    return [kind, *[f"{kind}.{x}={v}" for x, v in zip(FEATURES[:3], values)], *[f"{x}={v}" for x, v in zip(FEATURES[3:], values[3:])]]


def train_classifier(rows: list[tuple[str, tuple[str, ...], float, float]], rounds: int = 400) -> dict:
    """Logistic regression on (kind, feature values) with soft labels, weighted by count.

    Every kind weighs the same, so that frequent kinds do not drown the rare ones.
    """
    features = [feature_names(k, v) for k, v, _, _ in rows]
    w = dict.fromkeys(sorted({x for f in features for x in f}), 0.0)
    total: dict[str, float] = {}
    for k, _, count, _ in rows:
        total[k] = total.get(k, 0.0) + count
    for _ in range(rounds):
        grad = {k: -1e-4 * v for k, v in w.items()}
        for f, (k, _, count, soft) in zip(features, rows):
            err = count / total[k] * (soft - 1 / (1 + math.exp(-sum(w[x] for x in f))))
            for x in f:
                grad[x] += err
        w = {k: v + 0.5 * grad[k] for k, v in w.items()}
    return {k: round(v, 9) for k, v in w.items()}


def soft_labels(spark: SparkSession, patterns: list[tuple[str, tuple[int, ...]]], soft: list[float]) -> DataFrame:
    """The posterior per kind and vote pattern.  Handed over as Arrow it is a local relation; a list of rows
    would start a Python daemon and workers in every executor."""
    import pyarrow as pa

    votes = {x: pa.array([p[j] for _, p in patterns], pa.int32()) for j, x in enumerate(LABELERS)}
    return spark.createDataFrame(pa.table({"kind": pa.array([k for k, _ in patterns], pa.string()), **votes,
                                           "soft": pa.array(soft, pa.float64())}))


def fit(found: DataFrame) -> dict:
    """Weights of the span classifier: EM over the vote pattern counts of all spans, then its soft labels by feature."""
    counted = found.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()  # <= kinds * 81 rows
    rows = sorted((r["kind"], tuple(r[x] for x in LABELERS), float(r["n"])) for r in counted)
    if not rows:
        return {}
    soft = expectation_maximisation([(p, n) for _, p, n in rows], [k for k, _, _ in rows])
    known = soft_labels(found.sparkSession, [(k, p) for k, p, _ in rows], soft)
    seen = found.join(F.broadcast(known), ["kind", *LABELERS]).groupBy("kind", *FEATURES) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("soft", 9).cast("decimal(20,9)")).cast("double").alias("soft")).collect()  # <= kinds * 900 rows
    return train_classifier(sorted((r["kind"], tuple(r[x] for x in FEATURES), float(r["n"]), r["soft"] / r["n"]) for r in seen))


def probability(weights: dict) -> Column:
    """The classifier as a column over ``kind`` and the features."""
    if not weights:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    names = [F.col("kind"), *[F.concat(F.col("kind"), F.lit(f".{x}="), F.col(x)) for x in FEATURES[:3]],
             *[F.concat(F.lit(f"{x}="), F.col(x)) for x in FEATURES[3:]]]
    z = F.lit(0.0)
    for name in names:
        z = z + F.coalesce(F.try_element_at(table, name), F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_p: float = MIN_P) -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, ``base`` and ``spans``
    (arrays of start, rank, kind, end, in that order)."""
    found = checkpoint(spans(docs, id_col, text_col))
    weights = fit(found)
    chosen = found.withColumn("added", F.col("open") & (probability(weights) >= min_p)) \
        .withColumn("base", F.col("base") & F.col("ok")).filter("base or added")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    per = chosen.groupBy("_k1", "_k2").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(span)).alias("spans"))
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"))
    return rows.join(per, ["_k1", "_k2"], "left").select(
        F.col("_id").alias(id_col), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE], "base", "spans")


def written(spans_col: str) -> Column:
    """``kind:start:end`` of each span, comma-joined ('' for none)."""
    return F.coalesce(F.array_join(F.transform(spans_col, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))
