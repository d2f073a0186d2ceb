"""Registered queries of the training-data operators, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (byte_bpe, exact_dedup, fim, gam, line_dedup, mixing, pii, quality, simhash, suffix_dedup, url_filters,
                         vector_codes, warc)
from inkwell.llm.common import read_table
from inkwell.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


_SQL_HOST = ("lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), "
             "'^.*@', ''), '\\.?(:[0-9]*)?$', ''))")

OP1_SQL = f"""
WITH cap AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes(CAST((page_id * 7919) % 525600 AS INT)) AS fetch_time,
         {_SQL_HOST} AS host,
         [x FOR x IN string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') IF x <> ''] AS segs
  FROM pages),
named AS (
  SELECT 'spam' AS list_name, 'block' AS list_type, 'host' AS kind, host AS pattern FROM cap
  UNION SELECT 'malware', 'block', 'prefix', host || '/' || array_to_string(segs[1:least(len(segs), 1 + page_id % 5)], '/')
    FROM cap WHERE len(segs) >= 1
  UNION SELECT 'trusted', 'allow', 'domain', array_to_string(string_split(host, '.')[-(2 + page_id % 2):], '.') FROM cap
  UNION SELECT 'takedown', 'block', 'url', url FROM cap),
seeded AS (
  SELECT *, CAST('0x' || substr(md5(list_name || pattern), 1, 6) AS INT) AS a,
         CAST('0x' || substr(md5(list_name || pattern), 7, 6) AS INT) AS b FROM named),
events AS (
  SELECT list_name, list_type, kind, pattern, 'add' AS action, DATE '2024-01-01' + CAST(a % 400 AS INT) AS d FROM seeded
  UNION ALL SELECT list_name, list_type, kind, pattern, 'remove', DATE '2024-01-01' + CAST(a % 400 + 1 + b % 90 AS INT) FROM seeded
  UNION ALL SELECT list_name, list_type, kind, pattern, 'add', DATE '2024-01-01' + CAST(a % 400 + 100 + b % 50 AS INT) FROM seeded),
spans AS (
  SELECT * FROM (SELECT *, CAST(d AS TIMESTAMP) AS valid_from,
    coalesce(CAST(lead(d) OVER (PARTITION BY list_name, kind, pattern ORDER BY d) AS TIMESTAMP), TIMESTAMP '9999-12-31') AS valid_to
    FROM events) WHERE action = 'add'),
probe AS (
  SELECT DISTINCT page_id, kind, pattern FROM (
    SELECT page_id, 'url' AS kind, url AS pattern FROM cap
    UNION ALL SELECT page_id, 'host', host FROM cap
    UNION ALL SELECT page_id, 'domain', array_to_string(l[i:], '.')
      FROM (SELECT page_id, string_split(host, '.') AS l, unnest(range(1, len(string_split(host, '.')))) AS i FROM cap)
    UNION ALL SELECT page_id, 'prefix', host || '/' || array_to_string(segs[1:i], '/')
      FROM (SELECT page_id, host, segs, unnest(range(1, len(segs) + 1)) AS i FROM cap))),
hits AS (
  SELECT page_id, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists, count(*) AS n_matches,
         max(valid_from) AS active_since, bool_or(list_type = 'block') AND NOT bool_or(list_type = 'allow') AS blocked
  FROM probe JOIN cap USING (page_id) JOIN spans USING (kind, pattern)
  WHERE fetch_time >= valid_from AND fetch_time < valid_to GROUP BY page_id)
SELECT page_id, url, fetch_time, coalesce(blocked, false) AS blocked, coalesce(lists, '') AS lists,
       coalesce(n_matches, 0) AS n_matches, active_since
FROM cap LEFT JOIN hits USING (page_id)
"""


def capture_history(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures with a fetch time in 2024, and the dated history of four lists,
    both derived from every row of ``pages``: prefixes of one to five segments, domains of two or three labels."""
    url, host = F.col("url"), url_filters.url_host(F.col("url"))
    cap = pages.select("page_id", "url", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(
        mins=F.pmod(F.col("page_id") * 7919, F.lit(525600)).cast("int"))).alias("fetch_time"))
    segs = F.filter(F.split(url_filters.url_path(url), "/"), lambda x: x != "")
    labels = F.split(host, r"\.")

    def named(name, typ, kind, pattern):
        return F.struct(F.lit(name).alias("list_name"), F.lit(typ).alias("list_type"),
                        F.lit(kind).alias("kind"), pattern.alias("pattern"))

    depth, keep = F.least(F.size(segs), (1 + F.col("page_id") % 5).cast("int")), (2 + F.col("page_id") % 2).cast("int")
    first = F.when(F.size(segs) >= 1, F.concat(host, F.lit("/"), F.array_join(F.slice(segs, F.lit(1), depth), "/")))
    top = F.array_join(F.slice(labels, F.greatest(F.size(labels) - keep + 1, F.lit(1)), keep), ".")
    lists = pages.select(F.explode(F.array(
        named("spam", "block", "host", host), named("malware", "block", "prefix", first),
        named("trusted", "allow", "domain", top), named("takedown", "block", "url", url))).alias("l")) \
        .select("l.*").filter(F.col("pattern").isNotNull()).distinct()
    digest = F.md5(F.concat("list_name", "pattern"))
    a = F.conv(F.substring(digest, 1, 6), 16, 10).cast("int")
    b = F.conv(F.substring(digest, 7, 6), 16, 10).cast("int")
    day = F.pmod(a, F.lit(400))
    steps = F.array(F.struct(F.lit("add").alias("action"), day.alias("d")),
                    F.struct(F.lit("remove").alias("action"), (day + 1 + F.pmod(b, F.lit(90))).alias("d")),
                    F.struct(F.lit("add").alias("action"), (day + 100 + F.pmod(b, F.lit(50))).alias("d")))
    events = lists.select("list_name", "list_type", "kind", "pattern", F.explode(steps).alias("s")).select(
        "list_name", "list_type", "kind", "pattern", "s.action",
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("s.d")).cast("timestamp").alias("effective_at"))
    return cap, events


@query("op1_url_filters", OP1_SQL)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, events = capture_history(read_table(spark, sf_dir, "pages"))
    return url_filters.filter_captures(cap, events, "page_id") \
        .withColumns({"fetch_time": F.col("fetch_time").cast("timestamp_ntz"),
                      "active_since": F.col("active_since").cast("timestamp_ntz")})


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
occ AS (
  SELECT doc_id, i AS pos, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS rn
  FROM occ WHERE regexp_matches(w, '[^ \\t-\\r]')),
cov AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM ranked WHERE rn > 1),
agg AS (SELECT doc_id, list(pos) AS gone FROM cov GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], chr(10)) AS text
FROM lines LEFT JOIN agg USING (doc_id)
"""


@query("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


OP7_SQL = """
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS ord FROM documents),
src0 AS (SELECT source, sum(size) AS s FROM sizes GROUP BY source),
src1 AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS k FROM src0),
src2 AS (SELECT *, CAST(k % 3 + 1 AS DOUBLE) AS w, CAST(3 * s AS DOUBLE) AS cap FROM src1),
src3 AS (
  SELECT *, (sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM src2),
src4 AS (SELECT *, least(cap, max(level) OVER () * w) AS target FROM src3),
src5 AS (SELECT *, sum(target) OVER (ORDER BY k) / sum(target) OVER () AS hi FROM src4),
src AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY k), 0) AS lo FROM src5),
slots AS (
  SELECT i AS slot, ((i % 2147483648) * 1327217885 % 2147483648 + 0.5) / 2147483648 AS u
  FROM range(0, (SELECT CAST(ceil(sum(size) / 64.0) AS BIGINT) FROM sizes)) r(i)),
taken AS (
  SELECT k, count(*) * 64 AS words FROM slots JOIN src ON u >= lo AND (u < hi OR hi >= 1 - 1e-9) AND hi > lo GROUP BY k),
streams AS (
  SELECT z.*, src.s, src.target, coalesce(t.words, 0) AS words,
         sum(size) OVER (PARTITION BY z.source ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS off
  FROM sizes z JOIN src ON z.source IS NOT DISTINCT FROM src.source LEFT JOIN taken t USING (k))
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE
         greatest(0, least(size, words - off)) + greatest(0, least(size, words - s - off)) + greatest(0, least(size, words - 2 * s - off))
       END AS BIGINT) AS taken
FROM streams
"""


@query("op7_mixing", OP7_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(read_table(spark, sf_dir, "documents"), keep="largest")


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def _vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return byte_bpe.load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def token_digests(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Encode every text, decode the ids again, and reduce both to digests."""
    ranks, pattern = _vocabulary()
    ids = byte_bpe.encode(docs.select(id_col, "text"), ranks, pattern)
    return ids.select(id_col, F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"))


def archive_records(spark: SparkSession, pages: DataFrame, path: str, compress: bool = True) -> DataFrame:
    """Write ``pages`` as archives, read them back and reduce each record to the contract's columns."""
    warc.write_archives(pages, path, compress)

    def page(c):
        return F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    return warc.read_archives(spark, path).filter("kind = 'record'").select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page(F.col("refers_to")).alias("refers_to"))


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS top FROM p)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest,
       CASE WHEN octet_length(b) >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(b) >= 1000 AND page_id <> top THEN top END AS refers_to
FROM g
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_records(spark, read_table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_line_crf(docs, read_table(spark, sf_dir, "labels"))
    return quality.measure(docs, model, ["doc_id"]).withColumnRenamed("_c0", "doc_id")


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.detect(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in pii.BASE], F.sha2(pii.written("base"), 256).alias("base_sha256"),
                      pii.written("spans").alias("spans"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["hi"] - s["lo"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_quality_gam")
def op11_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.fit(docs, read_table(spark, sf_dir, "labels"))
    return gam.score_documents(docs, model).select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS sha FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[ \\t-\\r]*[^ \\t-\\r]+|[ \\t-\\r]+') AS w,
         CAST('0x' || sha[1:8] AS BIGINT) AS h1, CAST('0x' || sha[9:16] AS BIGINT) AS h2,
         CAST('0x' || sha[17:24] AS BIGINT) AS h3, CAST('0x' || sha[25:32] AS BIGINT) AS h4 FROM d),
f AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    """Every round is an assignment of all parts and a new codebook; distances are exact in doubles."""
    sql = """
WITH kept AS (
  SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS u FROM kept, range(0, 4) r(p)),
book0 AS MATERIALIZED (
  SELECT p, e, u FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 256),"""
    for k in range(rounds + 1):
        sql += f"""
near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(a.u) AS u, min(CAST(list_inner_product(a.u, a.u) - 2 * list_inner_product(a.u, c.u)
         + list_inner_product(c.u, c.u) AS BIGINT) * 256 + e) AS m
  FROM parts a JOIN book{k} c USING (p) GROUP BY vec_id, p),"""
        if k < rounds:
            sql += f"""
mean{k} AS (
  SELECT p, e, list(x ORDER BY i) AS u FROM (
    SELECT p, m % 256 AS e, i, floor(sum(u[i]) / count(*)) AS x FROM near{k}, unnest(range(1, len(u) + 1)) t(i) GROUP BY p, m % 256, i)
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.u, b.u) AS u FROM book{k} b LEFT JOIN mean{k} n USING (p, e)),"""
    return sql + f"""
found AS (
  SELECT vec_id, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
sha AS (
  SELECT sha256(string_agg(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN u], ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM found JOIN kept USING (vec_id), sha
"""


@query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress_vectors(read_table(spark, sf_dir, "embeddings"), carry=["vec_id", "label"])
    return vector_codes.with_label_error(codes, F.col("row.label")) \
        .select(F.col("row.vec_id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"))
