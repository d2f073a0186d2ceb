"""Quality rules: a linear-chain CRF marks every line as content or boilerplate.

Each line with a word gets a set of shape features (length, symbols, case, digits,
final punctuation, repetition).  The labels of lines are hidden: a labelled document only tells whether
all its lines are content (quality 1) or some line is boilerplate (quality 0).  The field is fitted
to that by gradient ascent: forward-backward gives the probability that a whole
document is content, which the fit raises for good documents and lowers for bad ones, so
that the lines that good documents have too stay content.  Viterbi decoding then
marks the lines of every document, and a document stays if content lines hold at least the
model's share of its words.  That share is the one that sorts the fitted documents best (the lowest
of equals).  Base rules (too few words, too many repeated three-word windows) come first.

The fit sees at most ``TRAIN_DOCS`` documents of at most ``TRAIN_LINES`` lines, the
smallest in order of a hash of their id, one row per id; everything else covers all rows.  Scoring
is one pass inside the scan's tasks, a document at a time.

Defined cases: null and empty texts have no words and fail the base rules; without
labelled documents of both classes every line counts as content, so only the
base rules decide; repeated and null ids are rows of their own (a null id takes
no part in the fit, and of repeated ids the row whose text has the smallest hash does); texts of any length
are read whole; an empty table gives an empty result; carried columns are
renamed by position, so that no name can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from inkwell.llm.common import every

TRAIN_DOCS = 2000
TRAIN_LINES = 200
MIN_SHARE = 0.5
MIN_WORDS = 50
MAX_PULL = 20.0
N_FEATURES = 22
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_CONT_OR_SPACE = bytes(range(0x80, 0xC0)) + _SPACE
_UPPER = bytes(range(65, 91))
_LETTER = _UPPER + bytes(range(97, 123))
_DIGIT = b"0123456789"
_LONG = 1 << 18
METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, content_share double, kept boolean")


def line_features(line: bytes, repeated: bool) -> int:
    """Bit set of the shape features of one line that has a word."""
    n, size = len(line.split()), len(line)

    def count(chars):
        return size - len(line.translate(None, chars))

    last = line.rstrip()[-1:]
    symbols, bangs, pipes = count(b"#*$%&<>~^=_{}\\@") / n, count(b"!?") / n, count(b"|") / n
    letters = count(_LETTER)
    upper = count(_UPPER) / letters if letters else 0.0
    width = size / n
    on = [0, 1 if n < 4 else 2 if n < 10 else 3 if n < 25 else 4,
          5 if symbols == 0 else 6 if symbols < 0.1 else 7 if symbols < 0.4 else 8,
          11 if upper < 0.15 else 12 if upper < 0.5 else 13,
          15 if width < 3 else 16 if width < 11 else 17]
    on += [9] if bangs >= 0.3 else [10] if bangs >= 0.1 else []
    on += [14] * (count(_DIGIT) >= 0.2 * size) + [18] * (last in b".!?:;\"')" and last != b"") + [19] * (last == b".")
    on += [20] * repeated + [21] * (pipes >= 0.3)
    return sum(1 << i for i in on)


def document_lines(text: bytes) -> tuple[list[int], list[int], int]:
    """Feature sets and word counts of the lines with a word, and the number of repeated ones."""
    seen, feats, words, dups = set(), [], [], 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if not n:
            continue
        again = line in seen
        dups += again
        seen.add(line)
        feats.append(line_features(line, again))
        words.append(n)
    return feats, words, dups


def repeated_window_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    import numpy as np

    if len(words) < 3:
        return 0
    if len(words) <= _LONG:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        first, often = {}, set()
        for w in windows:
            if first.setdefault(w, w) is not w:
                often.add(w)
        hit = np.fromiter((w in often for w in windows), bool, len(windows))
    else:  # the same count over word numbers, which needs far less memory
        number: dict[bytes, int] = {}
        a = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        _, pair = np.unique(a[:-1] * len(number) + a[1:], return_inverse=True)
        _, code, times = np.unique(pair[:-1] * len(number) + a[2:], return_inverse=True, return_counts=True)
        hit = times[code] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= hit
    return int(covered.sum())


def viterbi(feats: list[int], model) -> list[int]:
    """Most probable line labels (1 content, 0 boilerplate); ties go to content."""
    if model is None:
        return [1] * len(feats)
    start, trans, scores = model["start"], model["trans"], model.setdefault("memo", {})
    back, s0, s1 = [], 0.0, 0.0
    for k, f in enumerate(feats):
        e = scores.get(f)
        if e is None:
            e = scores[f] = tuple(sum(model["emit"][i][y] for i in range(N_FEATURES) if f >> i & 1) for y in (0, 1))
        if k == 0:
            s0, s1 = start[0] + e[0], start[1] + e[1]
            continue
        a0, b0, a1, b1 = s0 + trans[0][0], s1 + trans[1][0], s0 + trans[0][1], s1 + trans[1][1]
        back.append((b0 >= a0, b1 >= a1))
        s0, s1 = max(a0, b0) + e[0], max(a1, b1) + e[1]
    if not feats:
        return []
    labels = [int(s1 >= s0)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def train(sequences: list[list[int]], labels: list[int], rounds: int = 150, l2: float = 1e-3) -> dict:
    """Fit the CRF by gradient ascent (forward-backward, Adam) on what the labels tell about whole sequences:
    the sum of log P(all content) over label 1 and of log(1 - P(all content)) over label 0.

    The gradient of the second term is the first one's times -P / (1 - P), at most ``MAX_PULL`` here, so that a
    wrongly labelled document of good lines cannot outweigh all others.
    """
    import numpy as np

    order = sorted(range(len(sequences)), key=lambda i: (-len(sequences[i]), sequences[i], labels[i]))
    seqs, gold = [sequences[i] for i in order], np.array([labels[i] for i in order])
    length = np.array([len(s) for s in seqs])
    steps, n = int(length.max()), len(seqs)
    active = [int((length > t).sum()) for t in range(steps)]  # sequences still open at step t: a prefix
    x = np.zeros((steps, n, N_FEATURES))
    for i, s in enumerate(seqs):
        for t, f in enumerate(s):
            x[t, i] = [f >> j & 1 for j in range(N_FEATURES)]
    params = {"emit": np.zeros((N_FEATURES, 2)), "trans": np.zeros((2, 2)), "start": np.zeros(2)}
    m1 = {k: np.zeros_like(v) for k, v in params.items()}
    m2 = {k: np.zeros_like(v) for k, v in params.items()}
    for r in range(1, rounds + 1):
        emit = x @ params["emit"]
        trans = params["trans"]
        alpha = np.zeros((steps, n, 2))
        alpha[0] = params["start"] + emit[0]
        for t in range(1, steps):
            k = active[t]
            alpha[t, :k] = np.logaddexp(alpha[t - 1, :k, :1] + trans[0], alpha[t - 1, :k, 1:] + trans[1]) + emit[t, :k]
        beta = np.zeros((steps, n, 2))
        for t in range(steps - 2, -1, -1):
            k = active[t + 1]
            nxt = emit[t + 1, :k] + beta[t + 1, :k]
            beta[t, :k] = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
        z = np.logaddexp(alpha[0, :, 0] + beta[0, :, 0], alpha[0, :, 1] + beta[0, :, 1])
        # log P(all content) of every sequence, and how strongly the fit pulls it up or down.
        path = params["start"][1] + trans[1, 1] * (length - 1) - z
        for t in range(steps):
            path[:active[t]] += emit[t, :active[t], 1]
        pull = np.where(gold, 1.0, -np.minimum(np.exp(path) / np.maximum(-np.expm1(path), 1e-12), MAX_PULL))
        grad = {k: np.zeros_like(v) for k, v in params.items()}  # pulled: what an all-content path has less what is expected
        for t in range(steps):
            k = active[t]
            p = np.exp(alpha[t, :k] + beta[t, :k] - z[:k, None])
            p[:, 1] -= 1
            grad["emit"] -= x[t, :k].T @ (p * pull[:k, None])
            if t == 0:
                grad["start"] -= (p * pull[:, None]).sum(axis=0)
            else:
                pair = np.exp(alpha[t - 1, :k, :, None] + trans + (emit[t, :k] + beta[t, :k])[:, None, :] - z[:k, None, None])
                pair[:, 1, 1] -= 1
                grad["trans"] -= (pair * pull[:k, None, None]).sum(axis=0)
        for k in params:
            g = grad[k] / n - l2 * params[k]
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            params[k] = params[k] + 0.1 * (m1[k] / (1 - 0.9**r)) / (np.sqrt(m2[k] / (1 - 0.99**r)) + 1e-9)
    return {k: v.round(6).tolist() for k, v in params.items()}


def content_share(feats: list[int], sizes: list[int], n: int, model) -> float:
    """Share of the text's ``n`` words in lines that the model marks as content."""
    return sum(w for w, y in zip(sizes, viterbi(feats, model)) if y) / n if n else 0.0


def best_share(shares: list[float], labels: list[int]) -> float:
    """The least share that sorts the labelled documents best when those at or above it stay; at least
    half of the words if that is as good."""
    tried = sorted({*shares, MIN_SHARE})
    right = {t: sum((s >= t) == bool(y) for s, y in zip(shares, labels)) for t in tried}
    top = max(right.values())
    return MIN_SHARE if right[MIN_SHARE] == top else min(t for t in tried if right[t] == top)


def fit_line_crf(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES):
    """The fitted model (plain lists), or None without labelled documents of both classes."""
    picked = labels.filter("quality is not null").filter(F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_quality")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")) \
        .join(F.broadcast(picked), "_id")  # at most max_docs ids

    def run(batches):
        import pyarrow as pa

        for b in batches:
            lines = [document_lines(t.as_py() or b"")[:2] for t in b.column(1)]
            lines = [x if len(x[0]) <= max_lines else ([], []) for x in lines]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array([x[0] for x in lines], pa.list_(pa.int32())),
                                              pa.array([x[1] for x in lines], pa.list_(pa.int32())), b.column(2).cast(pa.int64()), b.column(3)],
                                             names=["id", "f", "w", "quality", "h"])

    # One row per id, so that repeated rows of a labelled document neither reach the driver nor weigh the fit.
    listed = chosen.select("_id", "_text", "_quality", F.xxhash64("_text").alias("_h")) \
        .mapInArrow(run, "id string, f array<int>, w array<int>, quality long, h long")
    rows = listed.groupBy("id").agg(F.min_by(F.struct("f", "w"), F.struct("h", "f", "w")).alias("l"), F.max("quality").alias("quality")).collect()
    rows = sorted(((len(r["id"]), r["id"], list(r["l"]["f"]), list(r["l"]["w"]), int(r["quality"] > 0)) for r in rows if r["l"]["f"]))
    labels = [r[4] for r in rows]
    if len(set(labels)) < 2:
        return None
    model = train([r[2] for r in rows], labels)
    own = dict(model)
    model["min_share"] = best_share([content_share(f, w, sum(w), own) for _, _, f, w, _ in rows], labels)
    return model


def measure(docs: DataFrame, model, carry: list[str], text_col: str = "text") -> DataFrame:
    """The ``carry`` columns (renamed _c0, _c1, ...) with the metrics and the verdict of every row."""
    src = docs.select(*[c.alias(f"_c{i}") for i, c in enumerate(every(docs, carry))], F.col(text_col).cast("binary").alias("_text"))
    schema = StructType([*[StructField(f"_c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)],
                         *StructType.fromDDL(METRICS).fields])

    def run(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in METRICS.split(", ")]
        own = dict(model) if model else None
        least = (own or {}).get("min_share", MIN_SHARE)
        for b in batches:
            cols = [[] for _ in names]
            for t in b.column(len(carry)):
                text = t.as_py() or b""
                words = text.split()
                n = len(words)
                feats, sizes, dups = document_lines(text)
                repeat = repeated_window_words(words)
                failed = n < MIN_WORDS or 100 * repeat > 50 * n
                share = content_share(feats, sizes, n, own)
                row = (n, len(text.translate(None, _CONT_OR_SPACE)), len(text) - len(text.translate(None, _SYMBOLS)),
                       dups, repeat, failed, share, not failed and share >= least)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carry)], *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             names=[*[f"_c{i}" for i in range(len(carry))], *names])

    return src.mapInArrow(run, schema)


def keep_content(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    out = measure(docs, fit_line_crf(docs, labels, id_col, text_col), docs.columns, text_col)
    return out.filter("kept").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
