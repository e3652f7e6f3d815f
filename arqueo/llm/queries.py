"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (best_position, bpe, chosen_path, cover_tree, line_windows, log_bilinear, mcd_rules, packing, parsing_fingerprint, permuterm,
               rff_quality, url_filter, warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The URL rules of the query: key (host/path prefix) and verdict.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op1_cover_tree", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id != b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1),
c AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
  SELECT a, least(a, min(b)) AS component FROM r GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op2_arc_to_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON d = payload_digest
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.convert_pages(table(spark, sf_dir, "pages")).drop("url")


@query("op3_log_bilinear")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score_documents(table(spark, sf_dir, "documents"))


@query("op4_mcd_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_rules.judge(table(spark, sf_dir, "documents")).select(
        "key.id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "outlier_distance",
    ).withColumnRenamed("id", "doc_id")


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), digests=True)


@query("op6_rff_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rff_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("id", "held_out", "score", "predicted").withColumnRenamed("id", "doc_id")


@query("op7_line_windows", """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM l),
w AS (
  SELECT doc_id, i, lead(i) OVER d AS i2, lead(i, 2) OVER d AS i3, x || chr(10) || lead(x) OVER d || chr(10) || lead(x, 2) OVER d AS k
  FROM t WHERE x != '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn FROM w WHERE k IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM r WHERE rn > 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(a.text, '') END AS text, coalesce(a.n_lines, 0) AS n_lines, coalesce(a.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text, count(*) AS n_lines, count(g.i) AS n_removed
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1) a ON a.doc_id = d.doc_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op8_chosen_path")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chosen_path.join_documents(table(spark, sf_dir, "documents"))
    return out.select("id", "class_id", "n_links", "kept").withColumnRenamed("id", "doc_id")


@query("op9_url_filter", """
WITH r(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, coalesce(regexp_extract(url, '^(?s:.)*?://((?s:.)*)$', 1), '') AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS verdict
      FROM v JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY 1)
SELECT v.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM v LEFT JOIN m ON m.page_id = v.page_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op11_parsing_fingerprint")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing_fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op12_best_position", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d),
f AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM p GROUP BY 1, 2, 3),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, s GROUP BY term, big_n),
r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN w USING (term), s GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM r WHERE score > 0) WHERE rank <= 20
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query("op13_permuterm", """
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
own AS (SELECT doc_id, x, count(*) AS n FROM runs GROUP BY 1, 2),
code AS (SELECT doc_id, x, n, hex(encode(doc_id::VARCHAR || ':' || x)) AS h FROM own),
crc AS (
  SELECT x, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda p: ('0x' || substr(h, p, 2))::BIGINT)),
                   lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM code, tab),
word AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, (h % length(x))::BIGINT) || substr(x, (h % length(x))::BIGINT + 2) ELSE x END AS word, sum(n)::BIGINT AS n
  FROM crc GROUP BY 1 HAVING sum(n) >= 3),
v AS (SELECT word, n FROM word WHERE length(word) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, range(1, 1000) r(i) WHERE i <= length(word)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1),
form AS (
  SELECT b.word, min(other) AS form, b.m FROM best b JOIN near USING (word) JOIN v USING (word)
  WHERE near.m = b.m AND b.m >= 2 * v.n GROUP BY b.word, b.m),
chain(word, target, k) AS (SELECT word, form, 1 FROM form UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN form f ON f.word = c.target),
root AS (SELECT word, arg_max(target, k) AS root FROM chain GROUP BY 1)
SELECT v.word, form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form.m AS form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN root USING (word)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.group_words(table(spark, sf_dir, "documents"), damage_every=97)
