"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is reduced to the ``FEATURES`` below.  The model is a sum of lookup tables:
one per feature over its bins, and one per chosen pair of features over coarser bins.
Cyclic boosting learns them: round after round, each table in turn gets one small step of a
shallow tree (two levels) fitted to the gradient of the log-loss, so that no feature
takes what another explains.  When the single features are done, the pairs are ranked
by what a two-level tree on both still gains, and the best of them are boosted likewise.  A
score is the logistic function of the intercept plus one gathered table value per feature and pair.

The fit sees at most ``FIT_DOCS`` labelled documents (the smallest in order of a hash of their
id, one row each), as feature vectors: a few megabytes on the driver.  Labels of held-out ids
(crc32 of the id's text modulo 4 is 2) are never read.  Language, source, id and labels are no features.
Scoring is one pass inside the scan's tasks over whole texts.

Defined cases: null and empty texts are scored with all features zero; without labelled documents of both
classes every score is the share of class 1 among the labels, or 0.5 without any; of repeated ids the
row whose text has the smallest hash is fitted, all rows are scored; a null id takes no part in the
fit and its held-out test reads the text ``null``; texts of any length are read whole; an empty
table gives an empty result; the input's columns come back inside ``row``, so that no name can clash.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import every
from inkwell.llm.quality import repeated_window_words

FIT_DOCS = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, L2 = 120, 60, 0.12, 2.0
THRESHOLD = 0.7
FEATURES = ["log_words", "word_points", "symbols", "bangs", "pipes", "upper", "digits", "non_ascii", "line_words", "distinct_words",
            "top_word", "same_neighbour", "repeated_windows", "repeated_lines", "unstopped_lines", "short_words", "stops", "capitals",
            "urls", "long_words"]
_CONT = bytes(range(0x80, 0xC0))
_HIGH = bytes(range(0xC0, 0x100))
_UPPER = bytes(range(65, 91))
_LETTER = _UPPER + bytes(range(97, 123))


def text_features(text: bytes) -> list[float]:
    """The values of ``FEATURES`` for one whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    import math

    size = len(text)

    def count(chars):
        return size - len(text.translate(None, chars))

    points = size - count(_CONT)
    letters, spaces = count(_LETTER), count(b" \t\n\x0b\x0c\r")
    times = Counter(words)
    lines, seen, again, open_words, rows = text.split(b"\n"), set(), 0, 0, 0
    for line in lines:
        k = len(line.split())
        if not k:
            continue
        rows += 1
        again += k * (line in seen)
        seen.add(line)
        if line.rstrip()[-1:] not in b".!?:;\"')":
            open_words += k
    lengths = [len(w) for w in words]
    return [math.log1p(n), (points - spaces) / n, count(b"#*$%&<>~^=_{}\\@") / n, count(b"!?") / n, count(b"|") / n,
            count(_UPPER) / letters if letters else 0.0, count(b"0123456789") / points, count(_HIGH) / points, math.log1p(n / rows),
            len(times) / n, max(times.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            repeated_window_words(words) / n, again / n, open_words / n, sum(k <= 3 for k in lengths) / n, count(b".") / n,
            sum(65 <= w[0] <= 90 for w in words) / n, text.count(b"://") / n, sum(k > 14 for k in lengths) / n]


def bin_edges(x, bins: int):
    """Distinct inner quantiles of every feature, ascending."""
    import numpy as np

    cuts = np.arange(1, bins) / bins
    return [np.unique(np.quantile(col, cuts, method="lower")) for col in x.T] if len(x) else []


def binned(x, edges):
    import numpy as np

    return np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)], axis=1) if len(edges) else None


def _gain(g, h):
    return g * g / (h + L2)


def _best_cut(g, h):
    """(gain, bin after which to cut) of cumulated bin sums; gain 0 without a cut."""
    import numpy as np

    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h) - _gain(total_g, total_h)
    i = int(gains.argmax())
    return float(gains[i]), i + 1


def tree_step(g, h):
    """Leaf values per bin of the two-level tree that fits the bins' gradients best."""
    import numpy as np

    leaf = np.empty(len(g))
    _, cut = _best_cut(g, h)
    for lo, hi in ((0, cut), (cut, len(g))):
        if hi > lo:
            _, inner = _best_cut(g[lo:hi], h[lo:hi])
            for a, b in ((lo, lo + inner), (lo + inner, hi)):
                if b > a:
                    leaf[a:b] = g[a:b].sum() / (h[a:b].sum() + L2)
    return leaf


def pair_step(g, h):
    """(gain, leaf values per cell) of the best tree that cuts one axis, then either side on the other axis."""
    import numpy as np

    best, best_leaf = 0.0, np.zeros(g.shape)
    whole = _gain(g.sum(), h.sum())
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        top_g, top_h = np.cumsum(np.cumsum(a, axis=0), axis=1), np.cumsum(np.cumsum(b, axis=0), axis=1)
        total_g, total_h = top_g[-1], top_h[-1]

        def sides(lo_g, lo_h):  # (first cut, second cut) -> gain of the second cut's two leaves
            all_g, all_h = lo_g[:, -1:], lo_h[:, -1:]
            return _gain(lo_g, lo_h) + _gain(all_g - lo_g, all_h - lo_h)

        upper, lower = sides(top_g[:-1], top_h[:-1]), sides(total_g - top_g[:-1], total_h - top_h[:-1])
        gains = upper.max(axis=1) + lower.max(axis=1) - whole
        if not len(gains) or gains.max() <= best:
            continue
        i = int(gains.argmax())
        best, leaf = float(gains[i]), np.empty(a.shape)
        for rows, cut in ((slice(0, i + 1), int(upper[i].argmax()) + 1), (slice(i + 1, None), int(lower[i].argmax()) + 1)):
            for cols in (slice(0, cut), slice(cut, None)):
                leaf[rows, cols] = a[rows, cols].sum() / (b[rows, cols].sum() + L2)
        best_leaf = leaf if axis == 0 else leaf.T
    return best, best_leaf


def boost(x, y) -> dict:
    """Fit the tables on feature rows ``x`` (n, features) and labels ``y`` (0 or 1, both present)."""
    import numpy as np

    prior = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    intercept = float(np.log(prior / (1 - prior)))
    f = np.full(len(y), intercept)

    def slopes():
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    edges = bin_edges(x, BINS)
    at = binned(x, edges)
    tables = [np.zeros(len(e) + 1) for e in edges]
    for _ in range(ROUNDS):
        for j, table in enumerate(tables):
            g, h = slopes()
            step = RATE * tree_step(np.bincount(at[:, j], g, len(table)), np.bincount(at[:, j], h, len(table)))
            table += step
            f += step[at[:, j]]

    coarse = bin_edges(x, PAIR_BINS)
    cell = binned(x, coarse)
    sizes = [len(e) + 1 for e in coarse]

    def cells(i, j):
        g, h = slopes()
        where, n = cell[:, i] * sizes[j] + cell[:, j], sizes[i] * sizes[j]
        return where, np.bincount(where, g, n).reshape(sizes[i], sizes[j]), np.bincount(where, h, n).reshape(sizes[i], sizes[j])

    ranked = sorted((-pair_step(*cells(i, j)[1:])[0], i, j) for i in range(len(sizes)) for j in range(i + 1, len(sizes)))
    pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain < 0]
    pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables):
            where, g, h = cells(i, j)
            step = RATE * pair_step(g, h)[1]
            table += step
            f += step.reshape(-1)[where]
    return {"intercept": intercept, "edges": [e.tolist() for e in edges], "tables": [t.tolist() for t in tables],
            "coarse": [e.tolist() for e in coarse], "pairs": pairs, "pair_tables": [t.reshape(-1).tolist() for t in pair_tables]}


def score_rows(x, model: dict):
    """Scores of feature rows: bins by binary search, then one gathered table value added per feature and pair."""
    import numpy as np

    total = np.full(len(x), model["intercept"])
    for col, e, t in zip(x.T, model["edges"], model["tables"]):
        total += np.asarray(t)[np.searchsorted(e, col, side="left")]
    bins = {k: np.searchsorted(model["coarse"][k], x[:, k], side="left") for pair in model["pairs"] for k in pair}
    for (i, j), t in zip(model["pairs"], model["pair_tables"]):
        total += np.asarray(t)[bins[i] * (len(model["coarse"][j]) + 1) + bins[j]]
    return 1 / (1 + np.exp(-total))


def held_out(ident: Column) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("null")).cast("binary")) % 4 == 2


def _feature_rows(texts):
    import numpy as np

    return np.array([text_features(t.as_py() or b"") for t in texts], float).reshape(len(texts), len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_docs: int = FIT_DOCS) -> dict:
    """The fitted model as plain lists; see the module docstring for the sample and the labels it may read."""
    import numpy as np

    own, mark = every(labels, [id_col])[0], every(labels, [label_col])[0]
    known = labels.select(own.alias("_id"), mark.alias("_y")).filter("_id is not null and _y is not null").filter(~held_out(F.col("_id")))
    picked = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
    ident, text = every(docs, [id_col, text_col])
    rows = docs.select(ident.alias("_id"), text.cast("binary").alias("_text")).join(F.broadcast(picked), "_id")  # at most max_docs ids

    @F.arrow_udf("array<double>")
    def features(texts):
        import pyarrow as pa

        x = _feature_rows(texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))

    # One row per id, so that repeated rows of a labelled document neither reach the driver nor weigh the fit.
    rows = rows.select("_id", "_y", F.xxhash64("_text").alias("_h"), features("_text").alias("_x")) \
        .groupBy("_id").agg(F.min_by("_x", F.struct("_h", "_x")).alias("_x"), F.max("_y").alias("_y"))
    got = sorted((r["_id"], int(r["_y"] > 0), r["_x"]) for r in rows.collect())
    y = np.array([v for _, v, _ in got], float)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        return {"intercept": float(np.log(share / (1 - share))), "edges": [], "tables": [], "coarse": [], "pairs": [], "pair_tables": []}
    return boost(np.array([x for _, _, x in got], float), y)


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the input's columns) with held_out, score and predicted of every document."""

    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        return pa.array(score_rows(_feature_rows(texts), model))

    return docs.select(F.struct(*every(docs)).alias("row"), held_out(every(docs, [id_col])[0]).alias("held_out"),
                       score(every(docs, [text_col])[0].cast("binary")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
