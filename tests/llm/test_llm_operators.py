"""Training-data operators against brute force, exact round trips and SQL, with the awkward inputs."""

import base64
import collections
import hashlib
import os
import random
import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from inkwell.llm import (byte_bpe, exact_dedup, induced_sort, line_dedup, mixing, pii, quality, simhash, suffix_dedup,  # noqa: E402
                         url_filters, warc)
from inkwell.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id string, _k1 long, kept string, words string, "
          "`a.text` string, row string, _c0 string, ids string, _text string, _row string, taken long")
EXTRA = ("x", "r", "c0", "i", "t", "w", 1)
LONG = "lorem ipsum dolor sit amet " * 6000


def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(120)) for _ in range(6)]
    texts = [None, "", " \n\t ", "one", "two words", base[0], base[0], base[0].upper(), base[1] + " tail", base[1],
             "x" * 1500, "ab" * 700, LONG, LONG + " end", base[2][:300] + base[3][100:500], base[3], "é" * 400 + base[4],
             base[4] + "\n" + base[5] + "\nshort\n" + base[2], base[5] + "\n" + base[2], "\n".join(["l1 a", "l2 b", "l3 c"] * 3),
             "head\nl1 a\nl2 b\nl3 c\nl4 d", "mail a.b@x.com_y@z.org ip 1.2.3.4.5.6.7.8 999.1.1.1 +1 (743) 555-3824 4111 1111 1111 1111",
             "call me: 743-555-3824 or write to john [at] corp [dot] com, ssn 123-45-6789", "a@b.c" * 3, "9" * 3000, "1.1.1.1" * 50]
    rows = [(i if i != 3 else None, t, None if i % 5 == 0 else "en", [None, "s1", "s2", "é"][i % 4], None, "c", i, "k", "w", *EXTRA)
            for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (6, "other text under a used id", "en", "s1", 1, "c", 1, "k", "w", *EXTRA), (None,) * 16]
    return spark.createDataFrame(rows, SCHEMA)


def pairs(df):
    return df.select("doc_id", "text").collect()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---- exact dedup -------------------------------------------------------------------------------

def test_exact_dedup(spark):
    df = awkward(spark)
    rows = pairs(df)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lower(r.text)].append(r.doc_id)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = collections.Counter()
    for t, ids in groups.items():
        left = 1
        for i in ids:
            k = i == top[t] and left > 0
            left -= k
            want[(i, top[t], len(ids), k, hashlib.sha256(t.encode()).hexdigest())] += 1
    got = collections.Counter(tuple(r) for r in exact_dedup.dedup_decisions(df, keep="largest")
                              .select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == want
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns and kept.count() == len(groups)
    low = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert {(lower(r.text), r.doc_id) for r in kept.collect()} == set(low.items())


def test_exact_dedup_hash_collision(spark, monkeypatch):
    """Texts that share a hash are told apart by their bytes."""
    monkeypatch.setattr(exact_dedup, "hash128", lambda *c: (F.lit(1), F.lit(2)))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_decisions(df).collect()}
    assert got == {(1, 1, 2, True), (3, 1, 2, False), (2, 2, 1, True)}


# ---- line dedup --------------------------------------------------------------------------------

def brute_lines(rows):
    """(doc_id, text) -> kept text, first occurrence by (id nulls first, row key)."""
    docs = {}
    for r in rows:
        docs[(r.doc_id is not None, r.doc_id or 0, r.k1, r.k2)] = (r.text or "").split("\n")
    seen, gone = set(), collections.defaultdict(set)
    for key in sorted(docs):
        lines = docs[key]
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if not re.search(r"[^\x20\x09-\x0D]", "".join(w)):
                continue
            if w in seen:
                gone[key] |= {i, i + 1, i + 2}
            seen.add(w)
    return {k: "\n".join(x for i, x in enumerate(v) if i not in gone[k]) for k, v in docs.items()}


def test_line_dedup(spark):
    df = awkward(spark)
    k1, k2 = line_dedup.hash128(F.col("doc_id"), F.col("text"))
    rows = df.select("doc_id", "text", k1.alias("k1"), k2.alias("k2")).collect()
    want = brute_lines(rows)
    out = line_dedup.dedup_lines(df)
    got = collections.Counter((r.row.doc_id, r.row.words, r.text) for r in out.collect())
    exp = collections.Counter((r.doc_id, "w" if r.doc_id is not None or r.text else None,
                               None if r.text is None else want[(r.doc_id is not None, r.doc_id or 0, r.k1, r.k2)]) for r in rows)
    assert sum(got.values()) == len(rows)
    assert collections.Counter((a, t) for (a, _, t), n in got.items() for _ in range(n)) == \
        collections.Counter((a, t) for (a, _, t), n in exp.items() for _ in range(n))


# ---- suffix dedup ------------------------------------------------------------------------------

def brute_repeats(texts, length):
    count = collections.Counter()
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i:i + length]] += 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("length,gram,memory", [(200, 64, 1 << 26), (20, 8, 1 << 12)])
def test_suffix_dedup(spark, length, gram, memory):
    df = awkward(spark).filter("text is null or length(text) < 20000")
    rows = pairs(df)
    want = collections.Counter((r.doc_id, *x) for r, x in zip(rows, brute_repeats([(r.text or "").encode() for r in rows], length)))
    got = collections.Counter((r.doc_id, r.n_bytes, sum(s.hi - s.lo for s in r.removed), len(r.removed), bytes(r.kept))
                              for r in suffix_dedup.remove_repeats(df, length=length, gram=gram, memory=memory).collect())
    assert got == want


def test_suffix_dedup_pieces_of_long_texts(spark, monkeypatch):
    """Texts longer than a hashing segment are cut without losing a window."""
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 700)
    rows = [r for r in pairs(spark.read.parquet(f"{SF}/documents.parquet"))]
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    want = {(r.doc_id, *x) for r, x in zip(rows, brute_repeats([(r.text or "").encode() for r in rows], 50))}
    got = {(r.doc_id, r.n_bytes, sum(s.hi - s.lo for s in r.removed), len(r.removed), bytes(r.kept))
           for r in suffix_dedup.remove_repeats(df, length=50, gram=16).collect()}
    assert got == want


def test_induced_sort_against_plain_sort(monkeypatch):
    """Order and common prefixes, with queues on disk, small blocks and deep recursion."""
    import numpy as np

    rng = random.Random(3)
    for _ in range(300):
        alpha, codes = rng.choice([1, 2, 3, 40]), []
        base = [rng.randint(1, alpha) for _ in range(30)]
        for _ in range(rng.randint(1, 8)):
            a = rng.randint(0, 20)
            codes += base[a:a + rng.randint(0, 10)] + [rng.randint(1, alpha) for _ in range(rng.randint(1, 25))] + [0]
        codes = np.array(codes, np.uint16)
        monkeypatch.setattr(induced_sort, "BLOCK", rng.choice([4, 16, 1 << 18]))
        space = induced_sort.Space(rng.choice([64, 256, 1 << 20]))
        parts = list(induced_sort.sort_suffixes(codes, space))
        space.close()
        keyed = [(0, i) if c == 0 else (1, c) for i, c in enumerate(codes.tolist())]
        order = sorted(range(len(codes)), key=lambda i: keyed[i:])
        lcp = [0] * len(order)
        for j in range(1, len(order)):
            a, b = keyed[order[j - 1]:], keyed[order[j]:]
            while lcp[j] < min(len(a), len(b)) and a[lcp[j]] == b[lcp[j]]:
                lcp[j] += 1
        assert np.concatenate([p for p, _ in parts]).tolist() == order
        assert np.concatenate([x for _, x in parts]).tolist() == lcp


def test_induced_sort_is_bounded(monkeypatch):
    """Many different names: little memory beyond the files, and few files open at once."""
    import tracemalloc

    import numpy as np

    rng, fan, merge = np.random.default_rng(5), [], induced_sort.heapq.merge
    codes = rng.integers(1, 60, 20000).astype(np.uint16)
    codes[199::200] = 0
    monkeypatch.setattr(induced_sort, "BLOCK", 64)
    monkeypatch.setattr(induced_sort.heapq, "merge", lambda *runs: fan.append(len(runs)) or merge(*runs))
    space = induced_sort.Space(4096)
    tracemalloc.start()
    try:
        assert sum(len(p) for p, _ in induced_sort.sort_suffixes(codes, space)) == len(codes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        space.close()
    assert max(fan) <= 64 and peak < 1_000_000


# ---- byte-level BPE ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return Q._vocabulary()


@pytest.fixture(scope="module")
def tiktoken_encoding(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=vocabulary[0], special_tokens={})


UNICODE = "naïve ’quoted’ 中文字符    emoji 👩‍👩‍👧 ½ ² Ⅷ I'll we've 'S <|endoftext|> \r\n\r\n  tail   "


def test_bpe_matches_library(spark, vocabulary, tiktoken_encoding):
    ranks, pattern = vocabulary
    rng = random.Random(2)
    extra = ["".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(0x80, 0xD7FF), rng.randint(0xE000, 0x10FFFF), 32, 10]))
                     for _ in range(60)) for _ in range(40)] + [UNICODE, "q" * 5000, "zxqj" * 900, " " * 3000]
    df = awkward(spark).select("doc_id", "text", "kept").union(
        spark.createDataFrame([(1000 + i, t, "k") for i, t in enumerate(extra)], "doc_id long, text string, kept string"))
    rows = df.select("doc_id", "text").collect()
    out = byte_bpe.encode(df, ranks, pattern).withColumn("back", byte_bpe.decode(F.col("ids"), ranks)).collect()
    want = collections.Counter((r.doc_id, tuple(tiktoken_encoding.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in rows)
    assert collections.Counter((r.doc_id, tuple(r.ids), bytes(r.back)) for r in out) == want


def test_bpe_native_fold_matches(spark, vocabulary):
    ranks, _ = vocabulary
    words = sorted({w for r in pairs(spark.read.parquet(f"{SF}/documents.parquet")) for w in (r.text or "").split()})[:400] + [
        "中文", "👩", "x" * 100, "y" * 300, " the", None, ""]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: list(r.ids) for r in byte_bpe.encode_words(df, ranks).collect()}
    assert got == {w: byte_bpe.merge_word(w.encode(), ranks) for w in words if w}


# ---- quality -----------------------------------------------------------------------------------

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    wins = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if wins[tuple(words[i:i + 3])] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_quality_base_rules_and_carry(spark, monkeypatch):
    df = awkward(spark)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = collections.Counter((r.doc_id, *brute_base(r.text or "")) for r in pairs(df))
    for long in (1 << 18, 10):
        monkeypatch.setattr(quality, "_LONG", long)
        out = quality.measure(df, None, ["doc_id", "kept"])
        assert collections.Counter((r[0], *[r[c] for c in cols]) for r in out.collect()) == want
        assert all(r.kept == (not r.base_failed) for r in out.select("base_failed", "kept").collect())


def test_viterbi_is_the_best_path():
    rng = random.Random(5)
    for _ in range(200):
        model = {"start": [rng.random(), rng.random()], "trans": [[rng.random() * 2 for _ in "ab"] for _ in "ab"],
                 "emit": [[rng.random() for _ in "ab"] for _ in range(quality.N_FEATURES)]}
        feats = [rng.getrandbits(quality.N_FEATURES) for _ in range(rng.randint(1, 7))]

        def score(path):
            s = model["start"][path[0]] + sum(model["trans"][a][b] for a, b in zip(path, path[1:]))
            return s + sum(model["emit"][i][y] for f, y in zip(feats, path) for i in range(quality.N_FEATURES) if f >> i & 1)

        paths = [[m >> i & 1 for i in range(len(feats))] for m in range(1 << len(feats))]
        assert abs(score(quality.viterbi(feats, model)) - max(map(score, paths))) < 1e-9


def test_quality_held_out(spark):
    """Fitted on half of the labelled documents, the field sorts the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_line_crf(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.measure(docs, model, ["doc_id"]).join(labels.filter("doc_id % 2 = 1"), F.col("_c0") == F.col("doc_id")) \
        .filter("not base_failed").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(good) > 100 and sum(good) >= 0.99 * len(good)
    assert len(bad) > 15 and sum(bad) <= 0.15 * len(bad)


def test_quality_lines_of_mixed_documents(spark):
    """Labels are hidden per line: a menu in a good text is marked, and the share lies between none and all."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit_line_crf(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    menu = "Home | News | Sport | Weather | Shop | Contact | About"
    good = [r.text for r in docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1"), "doc_id").collect()
            if len(r.text.split()) > 80 and r.text.count("\n") >= 4]
    assert len(good) > 50
    mixed = []
    for k, t in enumerate(good):
        lines = t.split("\n")
        lines[k % len(lines):k % len(lines)] = [menu, menu + " | Help"]
        mixed.append((k, "\n".join(lines)))
    out = quality.measure(spark.createDataFrame(mixed, "doc_id long, text string"), model, ["doc_id"]).collect()
    assert sum(0 < r.content_share < 1 for r in out) >= 0.95 * len(out)
    own, marked = dict(model), []
    for k, t in mixed:
        labels = iter(quality.viterbi(quality.document_lines(t.encode())[0], own))
        marked += [(menu in line, y) for line, y in ((x, next(labels)) for x in t.split("\n") if x.split())]
    assert sum(y == 0 for m, y in marked if m) > 0.95 * sum(m for m, _ in marked)
    assert sum(y for m, y in marked if not m) > 0.95 * sum(not m for m, _ in marked)
    shares = [r.content_share for r in quality.measure(docs, model, ["doc_id"]).collect()]
    assert sum(0 < s < 1 for s in shares) > 20  # in the corpus as it is


def test_quality_training_raises_the_likelihood(monkeypatch):
    """The fitted field against plain enumeration of all line labels."""
    import itertools
    import math

    rng = random.Random(2)
    seqs = [[1 << rng.choice([0, 1, 2]) for _ in range(rng.randint(1, 5))] for _ in range(40)]
    labels = [int(not any(f == 4 for f in s)) for s in seqs]  # feature 2 never occurs in a good document

    def objective(m):
        total = 0.0
        for s, y in zip(seqs, labels):
            score = {p: m["start"][p[0]] + sum(m["trans"][a][b] for a, b in zip(p, p[1:]))
                     + sum(m["emit"][f.bit_length() - 1][v] for f, v in zip(s, p)) for p in itertools.product((0, 1), repeat=len(s))}
            z = math.log(sum(map(math.exp, score.values())))
            p1 = math.exp(score[(1,) * len(s)] - z)
            total += math.log(p1) if y else math.log(max(1 - p1, 1e-12))
        return total

    few, many = quality.train(seqs, labels, rounds=2), quality.train(seqs, labels, rounds=150)
    assert objective(many) > objective(few) + 5
    for s, y in zip(seqs, labels):
        assert quality.viterbi(s, dict(many)) == [int(f != 4) for f in s]
    assert quality.best_share([1.0, 0.9, 0.4, 0.2], [1, 1, 0, 0]) == 0.5 and quality.best_share([1.0, 0.9, 0.8], [1, 0, 0]) == 1.0


# ---- WARC --------------------------------------------------------------------------------------

def pages(spark):
    big = "<p>" + "word " * 400
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "http://a/3", None), (4, "u\r\nx", ""), (5, "u", "short"),
            (6, "u", "short"), (7, "u", "WARC/1.1\r\n\r\n" * 100), (8, "u", "é\r\n\r\n" * 300), (None, "n", big), (9, None, big)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record string")


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(spark, tmp_dir, compress):
    df = pages(spark)
    got = collections.Counter(tuple(r) for r in Q.archive_records(spark, df, f"{tmp_dir}/w", compress).collect())
    want = collections.Counter()
    rows = df.collect()
    top = collections.defaultdict(lambda: None)
    for r in rows:
        b = (r.html or "").encode()
        if len(b) >= 1000 and r.page_id is not None:
            top[b] = max(r.page_id, top[b] or 0)
    for r in rows:
        b = (r.html or "").encode()
        to = top[b] if len(b) >= 1000 and top[b] != r.page_id else None
        want[(r.page_id, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to is not None else "response", to)] += 1
    assert got == want
    assert warc.read_archives(spark, f"{tmp_dir}/w").filter("kind = 'gap'").count() == 0


def test_warc_archives_of_short_payloads_only(spark, tmp_dir):
    """No payload is long enough to be revisited: the plan that looks for shared ones ends early."""
    df = pages(spark).filter("html is null or length(html) < 900")
    got = sorted((r.page_id, r.payload_bytes, r.record_type) for r in Q.archive_records(spark, df, f"{tmp_dir}/short").collect())
    assert got == [(3, 0, "response"), (4, 0, "response"), (5, 5, "response"), (6, 5, "response")]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    """Damage costs the damaged record only; the gap covers exactly its bytes."""
    rng = random.Random(1)
    bodies = [f"<p>{i} ".encode() + bytes(rng.randrange(256) for _ in range(300)) for i in range(30)]
    recs = [warc.build_record(i, "u", b, hashlib.sha1(b).hexdigest(), compress=compress) + (b"" if compress else b"\r\n\r\n")
            for i, b in enumerate(bodies)]
    gap_between = b"\x00" if compress else b""
    starts, data = [], b""
    for r in recs:
        starts.append(len(data))
        data += r + gap_between
    whole = list(warc.salvage(data))
    assert [x[2]["record_id"] for x in whole] == [f"<urn:page:{i}>" for i in range(30)]
    for _ in range(40):
        hit = rng.randrange(30)
        broken = bytearray(data)
        at = starts[hit] + rng.randrange(len(recs[hit]) * 3 // 4, len(recs[hit]) - 8)
        broken[at] ^= 0xFF
        found = list(warc.salvage(bytes(broken)))
        ids = [x[2]["record_id"] for x in found if x[2]]
        gaps = [x for x in found if not x[2]]
        assert ids == [f"<urn:page:{i}>" for i in range(30) if i != hit]
        assert len(gaps) == 1 and gaps[0][0] == starts[hit] and gaps[0][1] >= len(recs[hit]) and gaps[0][3]
    cut = list(warc.salvage(data[:starts[20] + 40]))
    assert len([x for x in cut if x[2]]) == 20 and cut[-1][2] is None
    assert list(warc.salvage(b"")) == []


def warc_records(n, compress):
    bodies = [f"<p>{i} ".encode() + b"word " * (50 + i) for i in range(n)]
    return [warc.build_record(i, "u", b, hashlib.sha1(b).hexdigest(), compress=compress) + (b"" if compress else b"\r\n\r\n")
            for i, b in enumerate(bodies)]


def warc_numbers(found):
    return [int(x[2]["record_id"][10:-1]) for x in found if x[2]]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage_after_removed_bytes(compress):
    """A record that lost bytes, up to its blank lines or the whole end, costs no other record."""
    recs = warc_records(12, compress)
    rng = random.Random(2)
    for _ in range(60):
        hit = rng.randrange(12)
        a = rng.randrange(20 if compress else recs[hit].index(b"<p>"), len(recs[hit]) - 4)
        b = rng.choice([len(recs[hit]), rng.randrange(a + 1, len(recs[hit]) + 1)])
        if not compress and rng.random() < 0.3:
            a, b = len(recs[hit]) - 4, len(recs[hit])  # the closing blank lines
        parts = [*recs[:hit], recs[hit][:a] + recs[hit][b:], *recs[hit + 1:]]
        found = list(warc.salvage(b"".join(parts)))
        assert warc_numbers(found) == [i for i in range(12) if i != hit]
        gaps = [x for x in found if not x[2]]
        assert len(gaps) == 1 and gaps[0][0] == sum(map(len, parts[:hit])) and gaps[0][1] == len(parts[hit])


def test_warc_salvage_is_linear_in_false_starts():
    import time

    took = []
    for n in (20_000, 80_000):
        data = b"WARC/1.1\r\n" * n + b"".join(warc_records(2, False))
        t = time.perf_counter()
        found = list(warc.salvage(data))
        took.append(time.perf_counter() - t)
        assert [f[2] is None for f in found] == [True, False, False] and found[0][1] == 10 * n
    assert took[1] < 10 * took[0] + 0.5


def test_warc_member_of_several_records():
    import gzip

    recs, single = warc_records(12, False), warc_records(12, True)
    whole = gzip.compress(b"".join(recs[:9]))
    data = single[9] + whole + single[10]
    found = list(warc.salvage(data))
    assert warc_numbers(found) == [9, *range(9), 10] and all(x[2] for x in found)
    assert {x[:2] for x in found[1:10]} == {(len(single[9]), len(whole))}
    # Damage from before the compression, and damage before such a member.
    inner = gzip.compress(b"".join([*recs[:3], recs[3][:-40], *recs[4:9]]))
    found = list(warc.salvage(single[9][:-30] + inner + single[10]))
    assert warc_numbers(found) == [0, 1, 2, 4, 5, 6, 7, 8, 10]
    start = sum(map(len, recs[:3]))
    assert [x[3] for x in found if not x[2]] == ["member check", f"content length: inflated bytes {start} to {start + len(recs[3]) - 40} of the member"]
    # A member without a record, and a damaged one.
    for bad in (gzip.compress(b"no record"), whole[:200] + b"\xff" * 9 + whole[209:]):
        found = list(warc.salvage(single[9] + bad + single[10]))
        assert warc_numbers(found) == [9, 10] and [x[:2] for x in found if not x[2]] == [(len(single[9]), len(bad))]


# ---- mixing ------------------------------------------------------------------------------------

def test_mixing_targets_and_bounds(spark):
    for df in (awkward(spark), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = mixing.mix_report(df).join(df.select("doc_id", "source").distinct(), "doc_id", "left").collect() \
            if df.count() > 100 else mixing.mix_report(df).collect()
        assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
        assert len(rows) == df.count()
    by = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
        by[r.source][2] += r["size"]
    total = sum(v[2] for v in by.values())
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(by))}
    left, targets, free = float(total), {}, dict(weights)
    while True:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 3 * by[s][2]]
        if not over:
            targets.update(share)
            break
        for s in over:
            targets[s] = 3.0 * by[s][2]
            left -= targets[s]
            del free[s]
    for s, (taken, target, _) in by.items():
        assert target == pytest.approx(targets[s])
        assert abs(taken - target) <= max(4 * mixing.BLOCK_WORDS, 0.03 * target)


def test_mixed_documents(spark):
    df = awkward(spark)
    out = mixing.mix_documents(df, block_words=8)
    assert out.columns == df.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in out.collect())
    report = mixing.mix_report(df, block_words=8).collect()
    assert words == sum(r.taken for r in report)
    assert sorted(map(tuple, mixing.mix_report(df, block_words=8).collect()), key=str) == sorted(map(tuple, report), key=str)
    texts = {r.text for r in df.collect()}
    assert all(any(t and t.startswith(r.text) for t in texts) for r in out.collect())


# ---- PII ---------------------------------------------------------------------------------------

BRUTE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute_pii(text):
    out = []
    for rank, (kind, pattern) in enumerate(BRUTE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_pii_base_spans(spark):
    rng = random.Random(8)
    parts = ["a.b@c.d", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "000.00001.2.3", " ", "4111 1111 1111 1111", "+1 (743) 555-3824", "-", "_", "é",
             "5500-0000-0000-0004", "+", "7", "é@é.com", "a%b+c@d-e.f.g"]
    texts = ["".join(rng.choice(parts) for _ in range(12)) for _ in range(400)]
    df = awkward(spark).select("doc_id", "text").union(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    want = collections.Counter((r.doc_id, tuple(brute_pii(r.text or ""))) for r in pairs(df))
    out = pii.detect(df).collect()
    assert collections.Counter((r.doc_id, tuple((s.start, s["rank"] - 1, s.kind, s.end) for s in r.base or ())) for r in out) == want
    for r in out:
        base = {(s.start, s.end) for s in r.base or ()}
        assert base <= {(s.start, s.end) for s in r.spans or ()}
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s.kind == k for s in r.base or ()) for k in pii.BASE]


def test_pii_weak_supervision():
    """EM finds the reliable labelers without labels; the classifier follows the votes."""
    rng = random.Random(3)
    counts = collections.Counter()
    for _ in range(4000):
        y = rng.random() < 0.6
        p = tuple((1 if (rng.random() < acc) == y else -1) if rng.random() < 0.9 else 0 for acc in (0.95, 0.9, 0.85, 0.6))
        counts[(p, y)] += 1
    pats = sorted({p for p, _ in counts})
    post = pii.expectation_maximisation([(p, counts[(p, True)] + counts[(p, False)]) for p in pats])
    right = sum(counts[(p, q > 0.5)] for p, q in zip(pats, post))
    assert right > 0.93 * 4000
    w = pii.train_classifier([("phone", ("cue", "none", "passed", "space", "space", "many"), 50.0, 0.99),
                              ("phone", ("none", "none", "failed", "space", "space", "many"), 50.0, 0.01)])
    assert w["phone.check=passed"] > 0 > w["phone.check=failed"] and w["phone.cue=cue"] > 0 > w["phone.cue=none"]


PLANTED = {
    "phone_national": (["call {a}-555-{b} today", "my mobile is ({a}) 555-{b}.", "Telefon {a} 555 {b}", "{a}.555.{b} (phone)"],
                       ["the value {a}-555-{b} in a list", "order {a}-555-{b} was late", "sum {a} 555 {b} and so on"]),
    "email_spelled": (["write to joe{b} [at] corp{a} [dot] com", "contact: ann{b} (at) mail.org"],
                      ["x{b} [at] y{a}.zz9 of the table", "see part{b} (at) section.q{a}"]),
    "personal_number": (["SSN 1{a}-45-{b}".replace("1{a}", "{a}"), "social security number: {a}-12-{b}"],
                        ["serial {a}-45-{b}", "the range {a}-12-{b} holds", "invoice {a}-99-{b}"]),
}


def planted_corpus(n):
    """Documents of plain words with one private or one harmless candidate each, and base spans of both outcomes."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8)))
    rows, truth = [], {}
    for i in range(n):
        kind = rng.choice(list(PLANTED))
        good = rng.random() < 0.5
        text = rng.choice(PLANTED[kind][not good]).format(a=rng.randint(212, 665), b=rng.randint(1234, 9876))
        extra = rng.choice(["", f" a{i}@mail.org", " 10.2.3.4", " 300.2.3.4", " 4111 1111 1111 1111", " 4111 1111 1111 1112"])
        rows.append((i, " ".join([*[word() for _ in range(12)], text, *[word() for _ in range(12)]]) + extra))
        truth[i] = (kind, good)
    return rows, truth


def test_pii_accepts_and_rejects_candidates_of_every_kind(spark):
    rows, truth = planted_corpus(900)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: {s.kind for s in r.spans or ()} for r in pii.detect(df).collect()}
    for kind in PLANTED:
        hit = {good: [kind in got[i] for i, t in truth.items() if t == (kind, good)] for good in (True, False)}
        recall = sum(hit[True]) / len(hit[True])
        precision = sum(hit[True]) / max(1, sum(hit[True]) + sum(hit[False]))
        print(kind, round(recall, 3), round(precision, 3))
        assert len(hit[True]) > 100 and recall >= 0.9 and precision >= 0.9
    found = pii.spans(df)
    assert {(r["format"] != 0) for r in found.filter("not base").collect()} == {False}  # no check, no vote
    assert {r["format"] for r in found.filter("base").collect()} == {-1, 1}


def test_pii_added_spans_leave_clean_text_alone(spark):
    clean = [(i, "plain words only, nothing to see in version 1.2 of page 33") for i in range(50)]
    private = [(100 + i, f"please call {200 + i}-555-{1234 + i} or contact joe{i} [at] corp [dot] com") for i in range(50)]
    df = spark.createDataFrame(clean + private, "doc_id long, text string")
    out = {r.doc_id: [s.kind for s in r.spans or ()] for r in pii.detect(df).collect()}
    assert all(not out[i] for i in range(50))
    assert all(out[100 + i] == ["phone_national", "email_spelled"] for i in range(50))


def test_pii_many_spans_stay_linear(spark, capsys):
    """No window frame ends unbounded, and candidates among very many base spans are judged as by a plain scan."""
    text = " ".join(["1.2.3.4 743-555-3824", "a@b.co1.2.3.4", "+1 743-555-3824 x"] * 300)
    df = spark.createDataFrame([(1, text), (2, text[:500])], "doc_id long, text string")
    found = pii.spans(df)
    found.explain(True)
    assert "unboundedfollowing" not in capsys.readouterr().out.lower()
    rows = collections.defaultdict(list)
    for r in found.collect():
        rows[r["_k1"], r["_k2"]].append(r)
    assert len(rows) == 2
    for spans in rows.values():
        base = [(r.start, r.end) for r in spans if r.base and r.ok]
        assert len(base) > 10 and {r.open for r in spans if not r.base} == {True, False}
        for r in spans:
            assert r.open == (not r.base and not any(a < r.end and r.start < b for a, b in base))


def test_pii_soft_labels_start_no_python_worker(spark, monkeypatch):
    """The table of soft labels is a local relation, not rows that Python workers of the executors hand over."""
    df = spark.createDataFrame([(1, "mail joe@corp.com or 10.2.3.4, call 743-555-3824"), (2, "300.1.2.3")], "doc_id long, text string")
    sent, broadcast = [], pii.F.broadcast
    monkeypatch.setattr(pii.F, "broadcast", lambda x: broadcast(sent.append(x) or x))
    assert pii.fit(pii.spans(df))
    assert len(sent) == 1 and sent[0]._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation")
    assert sent[0].dtypes == [("kind", "string"), *[(x, "int") for x in pii.LABELERS], ("soft", "double")]
    assert {r.kind for r in sent[0].collect()} == {"email", "ip", "card", "phone_national"}


# ---- SimHash -----------------------------------------------------------------------------------

def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps):
    """fp -> set of fps reachable over links of at most three bits."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash_classes(spark):
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    df = awkward(spark).select("doc_id", "text").union(small)
    rows = [(r.doc_id, brute_fingerprint(r.text or "")) for r in pairs(df)]
    root = brute_classes({f for _, f in rows})
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    got = collections.Counter((r._id, r._fp % (1 << 64), r.component_id) for r in simhash.near_duplicate_classes(df).collect())
    assert got == collections.Counter((i, f, least.get(root[f])) for i, f in rows)
    one = simhash.near_dedup(awkward(spark))
    assert one.columns == awkward(spark).columns
    assert one.count() == len({root[brute_fingerprint(r.text or "")] for r in pairs(awkward(spark))})


def test_simhash_links_random_flips(spark):
    """Chains and clusters at one to four bits: the stars reach exactly what all links reach."""
    rng = random.Random(6)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "_fp long"))
    assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= 3 for r in edges.collect())
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(edges).collect()}
    want = brute_classes(fps)
    groups = lambda m: {frozenset(x for x in fps if m.get(x, x) == v) for v in {m.get(x, x) for x in fps}}
    assert groups(roots) == groups(want)


# ---- URL filters -------------------------------------------------------------------------------

def test_url_filters_intervals(spark):
    ev = spark.createDataFrame([
        ("spam", "block", "domain", "x.com", "add", "2024-01-01"), ("spam", "block", "domain", "x.com", "remove", "2024-03-01"),
        ("spam", "block", "domain", "x.com", "add", "2024-06-01"), ("ok", "allow", "prefix", "a.x.com/en", "add", "2024-06-10"),
        ("bad", "block", "host", "y.org", "remove", "2024-01-01"), ("bad", "block", "host", "z.org", "add", "2024-02-02"),
        ("bad", "block", "host", "z.org", "remove", "2024-02-02"), ("n", "block", "host", None, "add", "2024-01-01"),
        ("n", "block", "host", "q", "add", None)], "list_name string, list_type string, kind string, pattern string, action string, effective_at string") \
        .withColumn("effective_at", F.col("effective_at").cast("timestamp"))
    cap = spark.createDataFrame([
        (1, "http://u:p@A.X.com.:80/en/1?q", "2024-01-01"), (1, "http://u:p@A.X.com.:80/en/1?q", "2024-01-01"), (2, "http://a.x.com/en/1", "2024-03-01"),
        (3, "http://a.x.com/fr", "2024-06-01"), (4, "http://a.x.com/en", "2024-06-11"), (5, "http://y.org", "2024-05-01"),
        (6, "http://z.org", "2024-05-01"), (7, None, "2024-05-01"), (8, "http://x.com", None), (9, "not a url", "2024-05-01"), (None, "http://x.com/", "2023-12-31")],
        "page_id long, url string, fetch_time string").withColumn("blocked", F.lit("clash")) \
        .withColumn("fetch_time", F.col("fetch_time").cast("timestamp"))
    got = sorted(((r.page_id or 0, r.blocked, r.lists, r.n_matches) for r in url_filters.filter_captures(cap, ev, "page_id").collect()))
    assert got == [(0, False, "", 0), (1, True, "spam", 1), (1, True, "spam", 1), (2, False, "", 0), (3, True, "spam", 1),
                   (4, False, "ok,spam", 2), (5, False, "", 0), (6, False, "", 0), (7, False, "", 0), (8, False, "", 0), (9, False, "", 0)]
    assert url_filters.filter_captures(cap, ev.limit(0), "page_id").filter("blocked").count() == 0


def test_url_filters_prefixes_of_any_depth(spark):
    deep = "h.org/" + "/".join(f"s{i}" for i in range(1, 13))
    labels = ".".join(f"l{i}" for i in range(14)) + ".com"
    ev = spark.createDataFrame([
        ("bad", "block", "prefix", "h.org/a/b/c/d"), ("fine", "allow", "prefix", "h.org/a/b/c/d/e/f"), ("one", "block", "prefix", "k.org/a"),
        ("far", "block", "prefix", deep), ("old", "block", "domain", "l1." + labels.split("l1.", 1)[1])],
        "list_name string, list_type string, kind string, pattern string") \
        .withColumn("action", F.lit("add")).withColumn("effective_at", F.lit("2024-01-01").cast("timestamp"))
    cap = spark.createDataFrame([
        (1, "http://h.org/a/b/c/d"), (2, "http://h.org/a//b/c/d/e/x?q"), (3, "http://h.org/a/b/c/d/e/f/g"), (4, "http://h.org/a/b/c/dd"),
        (5, f"http://{deep}/z"), (6, f"http://{deep}z"), (7, "http://k.org/a/b/c/d"), (8, f"http://{labels}/"), (9, "http://h.org/")],
        "page_id long, url string").withColumn("fetch_time", F.lit("2024-02-01").cast("timestamp"))
    got = {r.page_id: (r.blocked, r.lists) for r in url_filters.filter_captures(cap, ev, "page_id").collect()}
    assert got == {1: (True, "bad"), 2: (True, "bad"), 3: (False, "bad,fine"), 4: (False, ""), 5: (True, "far"), 6: (False, ""),
                   7: (True, "one"), 8: (True, "old"), 9: (False, "")}
    every = spark.range(1).select(url_filters.lookup_keys(F.lit(f"http://{deep}")).alias("k")).first().k
    assert sum(k.kind == "prefix" for k in every) == 12


def test_pipeline_stages_take_awkward_documents(spark, tmp_dir):
    """Every stage accepts nulls, repeated rows and clashing columns, and returns the columns it got."""
    import corpus_pipeline as P

    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_dir}/labels.parquet")
    for i, (name, stage) in enumerate(P.STAGES):
        for df in (awkward(spark), awkward(spark).limit(0)):
            out = stage(spark, df, tmp_dir)
            out.write.mode("overwrite").parquet(f"{tmp_dir}/out{i}")
            assert name == P.STAGES[-1][0] or out.columns == df.columns


# ---- all of them -------------------------------------------------------------------------------

def test_empty_tables(spark):
    df = awkward(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    ranks, pattern = Q._vocabulary()
    assert exact_dedup.dedup_decisions(df).count() == 0 and exact_dedup.exact_dedup(df).count() == 0
    assert line_dedup.dedup_lines(df).count() == 0
    assert suffix_dedup.remove_repeats(df).count() == 0
    assert byte_bpe.encode(df, ranks, pattern).count() == 0
    assert quality.fit_line_crf(df, labels) is None and quality.keep_content(df, labels).count() == 0
    assert mixing.mix_report(df).count() == 0 and mixing.mix_documents(df).count() == 0
    assert pii.detect(df).count() == 0
    assert simhash.near_duplicate_classes(df).count() == 0 and simhash.near_dedup(df).count() == 0
    assert Q.archive_records(spark, pages(spark).limit(0), Q.scratch_dir(spark, "empty")).count() == 0
    cap, ev = Q.capture_history(pages(spark).limit(0))
    assert url_filters.filter_captures(cap, ev, "page_id").count() == 0


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.execute(Q.ORACLE[name])
    order = [[d[0] for d in rel.description].index(c) for c in cols]
    want = sorted(str([round(v, 6) if isinstance(v, float) else v for v in (r[i] for i in order)]) for r in rel.fetchall())
    got = sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(cols).collect())
    assert got == want


def test_pipeline_against_brute_force(spark):
    """The whole chain on a small table: each stage's twin runs on what its predecessor kept."""
    import corpus_pipeline as P
    import tiktoken

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit_line_crf(docs, labels)
    rows = []
    for r in docs.collect():
        text = (r.text or "").encode()
        feats, sizes, _ = quality.document_lines(text)
        n = len(text.split())
        share = sum(w for w, y in zip(sizes, quality.viterbi(feats, dict(model))) if y) / max(n, 1)
        if not brute_base(r.text or "")[5] and share >= model["min_share"]:
            rows.append(r)
    keys = {i: (0, 0) for i in range(10**6)}

    class Row:
        def __init__(self, i, t):
            self.doc_id, self.text, (self.k1, self.k2) = i, t, keys[i]

    assert len({r.doc_id for r in rows}) == len(rows)
    kept = {k[1]: t for k, t in brute_lines([Row(r.doc_id, r.text) for r in rows]).items()}
    texts = {i: t for i, t in kept.items() if t.strip(" \t\n\x0b\x0c\r") or t == next(r.text for r in rows if r.doc_id == i)}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    root = brute_classes(set(fps.values()))
    best = {}
    for i in sorted(fps):
        best.setdefault(root[fps[i]], i)
    texts = {i: texts[i] for i in best.values()}
    source = {r.doc_id: r.source for r in rows}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, source[i]) for i, t in texts.items()])
    cols = ["doc_id", "size", "taken"]
    rel = con.execute(f"SELECT {', '.join(cols)} FROM ({Q.OP7_SQL})").fetchall()
    ranks, pattern = Q._vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for i, size, taken in rel:
        while taken > 0:
            part, taken = min(size, taken), taken - size
            spans = list(re.finditer(r"[^\x20\x09-\x0D]+", texts[i]))
            text = texts[i] if part == size else texts[i][:spans[part - 1].end()]
            ids = enc.encode_ordinary(text)
            want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = collections.Counter(tuple(r) for r in P.run(spark, SF).collect())
    assert got == want


def test_ranks_file_is_read_from_a_path(tmp_dir):
    path = os.path.join(tmp_dir, "r.tiktoken")
    with open(path, "wb") as f:
        f.write(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 1\n" + base64.b64encode(b"ab") + b" 2\n")
    ranks = byte_bpe.load_ranks(path)
    assert ranks == {b"a": 0, b"b": 1, b"ab": 2} and byte_bpe.merge_word(b"aab", ranks) == [0, 2]


def test_warc_archives_are_bounded_by_bytes(spark, tmp_dir):
    assert warc.size_classes(0) == [(-1, 1 << 18, 2000)]
    assert warc.size_classes(1 << 27) == [(-1, 1 << 18, 2000), (1 << 18, 1 << 22, 125), (1 << 22, 1 << 26, 7), (1 << 26, 1 << 30, 1)]
    rows = [(i, f"u{i}", "x" * n + str(i)) for i, n in enumerate([0, 30] * 40 + [900] * 200 + [20_000] * 9 + [200_000])]
    rows += [(1000, "twin", rows[-1][2]), (1001, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, tmp_dir + "/w", compress=False, class_bytes=64)
    back = {r["record_id"]: r for r in warc.read_archives(spark, tmp_dir + "/w").filter("kind = 'record'").collect()}
    assert len(back) == len(rows) and {r["payload_bytes"] for r in back.values()} == {len(h or "") for _, _, h in rows}
    assert back[warc._id(289)]["record_type"] == "revisit" and back[warc._id(289)]["refers_to"] == warc._id(1000)
    held = {}
    for r in back.values():
        held.setdefault(r["archive"], []).append(r["payload_bytes"])
    assert max(max(v) for v in held.values()) == 200_003
    assert all(len(v) == 1 or sum(v) <= 2000 * 64 for v in held.values())
    assert all(len(v) == 1 for v in held.values() if max(v) > 16_384)
