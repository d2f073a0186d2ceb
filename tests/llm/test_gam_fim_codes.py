"""Additive quality model, fill-in-the-middle and vector codes against brute force, with the awkward inputs."""

import collections
import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_llm_operators import awkward  # noqa: E402

from inkwell.llm import fim, gam, vector_codes  # noqa: E402
from inkwell.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# ---- fill in the middle ------------------------------------------------------------------------

def brute_fim(ident, text):
    t = text or ""
    sha = hashlib.sha256(f"42:{'null' if ident is None else ident}".encode()).hexdigest()
    h = [int(sha[8 * i:8 * i + 8], 16) for i in range(4)]
    tokens = TOKEN.findall(t)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fim_against_tokens(spark):
    df = awkward(spark)
    more = [(100 + i, t) for i, t in enumerate(["<P> a b", "x <M>", "<S", "a<P", " lead and trail \n", "\n", "é ü\tß  ", "word", "日本 語",
                                                "<" * 40 + " S>" * 30, "a b c 　", "x" * 9000 + " " + "é" * 9000])]
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = fim.fill_in_middle(df)
    assert got.columns == ["row", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = got.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == (r.row.text or "") for r in rows)
    want = collections.Counter((r.doc_id, *brute_fim(r.doc_id, r.text)) for r in df.select("doc_id", "text").collect())
    assert collections.Counter((r.row.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == want
    assert got.select("row.*").columns == df.columns


def test_fim_forms_and_rates(spark):
    df = spark.createDataFrame([(i, f"w{i} a b c d e") for i in range(600)], "doc_id long, text string")
    forms = collections.Counter(r.form for r in fim.fill_in_middle(df).collect())
    assert set(forms) == {"plain", "spm", "psm"} and 230 < forms["plain"] < 370 and forms["spm"] > 2 * forms["psm"]


@pytest.mark.parametrize("block", [64, fim.BLOCK])
def test_chunks_follow_the_content(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdéfg日hij") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    shared = " ".join(rng.choice(vocab) for _ in range(3000)).encode()
    texts = [b"", b" ", b"a", shared, b"other start " + shared, shared[:5000] + b" changed " + shared[5000:], b"\x80" * 9000, b"q" * 9000]
    for t in texts:
        ends = fim.chunk_ends(t)
        starts = [0, *ends[:-1]] if ends else []
        assert b"".join(t[a:b] for a, b in zip(starts, ends)) == t
        assert all(0 < b - a <= fim.MAX_CHUNK for a, b in zip(starts, ends))
        if t != texts[6]:  # code points stay whole
            assert all((t[b] & 0xC0) != 0x80 for b in ends[:-1])
    chunks = [{t[a:b] for a, b in zip([0, *fim.chunk_ends(t)], fim.chunk_ends(t))} for t in texts]
    assert len(chunks[3] & chunks[4]) >= len(chunks[3]) - 2 and len(chunks[3] & chunks[5]) >= len(chunks[3]) - 4
    assert len(chunks[3]) > 20


def test_chunk_counts_locate_every_cut():
    rng = random.Random(5)
    for trial in range(60):
        alphabet = "ab é\t\n" if trial % 2 else "abcdefgh  日"
        t = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 70, 900, 6000])))
        if trial % 3 == 0:
            t = t.replace(" ", "x") + " " * rng.randint(0, 200)
        tokens = TOKEN.findall(t)
        doc = fim.ChunkedText(t.encode(), fim.ChunkCache())
        assert doc.n == len(tokens)
        for k in {0, len(tokens), *(rng.randint(0, len(tokens)) for _ in range(40))}:
            head = "".join(tokens[:k])
            assert doc.cut(k) == (len(head.encode()), len(head))


def test_chunk_cache_is_bounded_and_never_decides():
    rng = random.Random(6)
    t = " ".join(str(rng.random()) for _ in range(4000)).encode()
    small, large = fim.ChunkCache(2000), fim.ChunkCache()
    a, b, again = fim.ChunkedText(t, small), fim.ChunkedText(t, large), fim.ChunkedText(t, large)
    assert (a.points, a.words) == (b.points, b.words) == (again.points, again.words)
    assert small.held <= 2000 + fim.MAX_CHUNK + 200 and large.hits >= large.misses > 0


# ---- additive quality model --------------------------------------------------------------------

def test_gam_held_out(spark):
    got = Q.QUERIES["op11_quality_gam"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    seen = [(r.predicted == labels[r.doc_id], labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(seen) > 60 and sum(ok for ok, _ in seen) / len(seen) > 0.93
    assert sum(ok for ok, y in seen if y == 0) / max(1, sum(y == 0 for _, y in seen)) > 0.7


def test_gam_reads_no_held_out_label_and_no_other_column(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    spoiled = labels.withColumn("quality", F.when(gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    model = gam.fit(docs, labels)
    assert model["pairs"] and model == gam.fit(other.repartition(7), spoiled)


def test_gam_scores_are_sums_of_table_values():
    rng = np.random.default_rng(1)
    x = np.stack([rng.random(3000), rng.random(3000), rng.integers(0, 3, 3000), np.zeros(3000)], axis=1)
    logit = np.where(x[:, 0] > 0.6, 0.5, -0.5) + 5 * ((x[:, 0] > 0.25) != (x[:, 1] > 0.5)) - 2.5  # a step, and an interaction
    y = (rng.random(3000) < 1 / (1 + np.exp(-logit))).astype(float)
    model = gam.boost(x, y)
    assert model["pairs"][0] == (0, 1)
    got = gam.score_rows(x, model)
    assert ((got > 0.5) == (logit > 0)).mean() > 0.95
    plain = gam.score_rows(x, {**model, "pairs": [], "pair_tables": []})
    assert ((plain > 0.5) == (logit > 0)).mean() < 0.9  # without the pairs it cannot
    for row, s in list(zip(x, got))[:200]:
        total = model["intercept"]
        for v, edges, table in zip(row, model["edges"], model["tables"]):
            total += table[sum(e < v for e in edges)]
        for (i, j), table in zip(model["pairs"], model["pair_tables"]):
            a, b = (sum(e < row[k] for e in model["coarse"][k]) for k in (i, j))
            total += table[a * (len(model["coarse"][j]) + 1) + b]
        assert math.isclose(s, 1 / (1 + math.exp(-total)), rel_tol=1e-12)


def test_gam_trees_are_the_best_two_level_trees():
    rng = np.random.default_rng(2)
    gain = lambda g, h: g.sum() ** 2 / (h.sum() + gam.L2)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.random(9)
        first = max(range(1, 9), key=lambda c: gain(g[:c], h[:c]) + gain(g[c:], h[c:]))
        leaf = gam.tree_step(g, h)
        for lo, hi in ((0, first), (first, 9)):
            if hi - lo > 1:
                c = max(range(lo + 1, hi), key=lambda c: gain(g[lo:c], h[lo:c]) + gain(g[c:hi], h[c:hi]))
                for a, b in ((lo, c), (c, hi)):
                    assert np.allclose(leaf[a:b], g[a:b].sum() / (h[a:b].sum() + gam.L2))
        g, h = rng.normal(size=(4, 5)), rng.random((4, 5))
        best = 0.0
        for a, b in ((g, h), (g.T, h.T)):
            for c in range(1, a.shape[0]):
                best = max(best, sum(max(gain(a[r, :d], b[r, :d]) + gain(a[r, d:], b[r, d:]) for d in range(1, a.shape[1] + 1))
                                     for r in (slice(0, c), slice(c, None))) - gain(g, h))
        got, leaf = gam.pair_step(g, h)
        assert math.isclose(got, best, rel_tol=1e-9) and leaf.shape == g.shape


def test_gam_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (10, 0, 0), (11, 0, None), (None, 1, 0), (6, None, 0), (9, 1, 0), (8, 1, 0), (14, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = gam.score_documents(df, gam.fit(df, labels))
    rows = out.collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows) and out.select("row.*").columns == df.columns
    one = gam.fit(df, labels.filter("quality = 1"))
    assert one["tables"] == [] and gam.score_documents(df, one).filter("score < 0.99").isEmpty()
    none = gam.fit(df, labels.limit(0))
    assert {r.score for r in gam.score_documents(df, none).collect()} == {0.5}
    assert gam.score_documents(df.limit(0), one).isEmpty()


# ---- vector codes ------------------------------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (id, label, vector) -> [(id, label, code, error)], books; plain integers."""
    ok = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = next((len(v) for _, _, v in ok if v and len(v) % parts == 0), None)
    ok = [r for r in ok if dim and len(r[2]) == dim]
    w = (dim or 0) // parts
    books = [[v[p * w:(p + 1) * w] for _, _, v in ok[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for _, _, v in ok:
                groups[near(v[p * w:(p + 1) * w], books[p])[1]].append(v[p * w:(p + 1) * w])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for i, lab, v in ok:
        found = [near(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def awkward_vectors():
    rng = random.Random(8)
    nan, inf = float("nan"), float("inf")
    base = [[rng.choice([-1, 1]) * rng.random() for _ in range(8)] for _ in range(40)]
    rows = [(i, i % 3 if i % 4 else None, v) for i, v in enumerate(base)]
    rows += [(100, 1, None), (101, 1, [None] * 8), (102, 1, [nan] + [0.0] * 7), (103, None, [inf] * 8), (104, 2, []), (105, 2, [1.0] * 4),
             (3, 1, base[3]), (3, 1, base[3]), (None, None, base[5]), (106, 0, [1e4] * 8), (107, 0, [-0.0005] * 8), (-5, 2, [0.1, 0.2, 0.3])]
    return rows


@pytest.mark.parametrize("entries", [256, 7])
def test_codes_against_plain_integers(spark, monkeypatch, entries):
    rows = awkward_vectors()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "vec_id long, label int, embedding array<float>, `a.b` string, _id int, row string")
    df = df.repartition(5)
    codes, books = vector_codes.compress_vectors(df, entries=entries)
    want, want_books = brute_codes([(i, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows],
                                   entries=entries)
    assert books == want_books
    got = codes.collect()
    assert collections.Counter((r.row.vec_id, r.row.label, r.code, r.error) for r in got) == collections.Counter(want)
    assert codes.select("row.*").columns == ["vec_id", "label", "a.b", "_id", "row"]
    sums = collections.Counter()
    for _, lab, _, e in want:
        sums[lab] += e
    assert all(r.label_error == sums[r.row.label] for r in vector_codes.with_label_error(codes, F.col("row.label")).collect())


def test_codes_do_not_depend_on_blocks(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    whole, books = vector_codes.compress_vectors(df, carry=["vec_id"], entries=16)
    want = sorted((r.row.vec_id, r.code, r.error) for r in whole.collect())
    vectors = np.array([r.embedding for r in df.orderBy("vec_id").collect()])
    v = np.floor(vectors.astype(float) * 1024).astype(int)
    for p in range(4):  # every row has its nearest entry
        d = ((v[:, None, p * 16:(p + 1) * 16] - np.array(books[p])[None]) ** 2).sum(axis=2)
        assert [int(c[2 * p:2 * p + 2], 16) for _, c, _ in want] == d.argmin(axis=1).tolist()
    again, other = vector_codes.compress_vectors(df.repartition(9), carry=["vec_id"], entries=16)
    assert other == books and sorted((r.row.vec_id, r.code, r.error) for r in again.collect()) == want


def test_codes_of_nothing_and_out_of_range(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    codes, books = vector_codes.compress_vectors(empty)
    assert books == [] and codes.isEmpty() and codes.columns == ["row", "code", "error"]
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()
    assert vector_codes.with_label_error(codes, F.col("row.label")).isEmpty()
    far = spark.createDataFrame([(1, 1, [1e9] * 4)], "vec_id long, label int, embedding array<float>")
    with pytest.raises(Exception, match="lies beyond"):
        vector_codes.compress_vectors(far)


@pytest.mark.parametrize("values", [3, 900])
def test_tabulated_distances(values):
    rng = np.random.default_rng(3)
    v = rng.integers(-values, values, (50, 6))
    book = rng.integers(-values, values, (9, 6)).tolist()
    book[4] = book[1]
    dictionaries, codes = zip(*(np.unique(v[:, j], return_inverse=True) for j in range(6)))
    best, d = vector_codes.nearest(list(dictionaries), np.array(codes), book)
    full = ((v[:, None] - np.array(book)) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
