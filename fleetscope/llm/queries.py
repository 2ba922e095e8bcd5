"""The registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import encode_decode
from .common import ship_package, table
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .linededup import line_report
from .mixing import mix
from .orchard import clusters
from .ranking import rank_documents
from .spm import encode_pieces
from .tokencount import token_counts
from .topk import top_k
from .toxicity import toxicity
from .warc import warc_round_trip



def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie; they are never part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("uri")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL["op10_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), named=True)


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                         outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


# Words in order of rarity; lines that reach 0.8 share one of their first n - ceil(0.8 n) + 1.
SQL["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
sets AS (
  SELECT doc_id, line, list_distinct(list_filter(regexp_split_to_array(lower(t), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS ws FROM lines),
used AS (SELECT doc_id, line, len(ws) AS n, unnest(ws) AS w FROM sets WHERE len(ws) > 0),
freq AS (SELECT w, count(*) AS f FROM used GROUP BY w),
ranked AS (SELECT doc_id, line, n, used.w, row_number() OVER (PARTITION BY doc_id, line ORDER BY f, used.w) AS k FROM used JOIN freq ON used.w = freq.w),
prefix AS (SELECT * FROM ranked WHERE k <= n - ceil(n * 80 / 100.0) + 1),
pairs AS (
  SELECT DISTINCT a.doc_id AS d1, a.line AS l1, b.doc_id AS d2, b.line AS l2 FROM prefix a JOIN prefix b ON a.w = b.w
  WHERE (a.doc_id, a.line) < (b.doc_id, b.line) AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
matched AS (
  SELECT DISTINCT d2 AS doc_id, l2 AS line FROM pairs JOIN sets x ON x.doc_id = d1 AND x.line = l1 JOIN sets y ON y.doc_id = d2 AND y.line = l2
  WHERE 100 * len(list_intersect(x.ws, y.ws)) >= 80 * (len(x.ws) + len(y.ws) - len(list_intersect(x.ws, y.ws)))),
per AS (SELECT doc_id, count(*) AS n_removed, string_agg(line, ',' ORDER BY line) AS removed FROM matched GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id
"""


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL["op9_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN size m ON m.doc_id = a.doc_id JOIN size n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 90 * (m.n + n.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.x, reach.r FROM reach JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.y = reach.doc_id)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id GROUP BY d.doc_id
"""


SQL["op1_warc"] = """
SELECT page_id, strlen(p) AS payload_bytes,
       translate(upper(concat(to_base(('0x' || substr(h, 1, 10))::BIGINT, 32, 8), to_base(('0x' || substr(h, 11, 10))::BIGINT, 32, 8),
                              to_base(('0x' || substr(h, 21, 10))::BIGINT, 32, 8), to_base(('0x' || substr(h, 31, 10))::BIGINT, 32, 8))),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM (SELECT page_id, p, sha1(p) AS h, max(page_id) OVER (PARTITION BY p) AS top
      FROM (SELECT page_id, coalesce(html, '') AS p FROM pages))
"""


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"),
                         outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

SQL["op12_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (SELECT r, doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, t, unnest(t) AS term FROM d) GROUP BY r, doc_id, len(t), term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, r, sum(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
                                 * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN df USING (term) CROSS JOIN total GROUP BY item_id, doc_id, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _clusters_sql(rounds: int = 3) -> str:
    """Whole numbers below 2^53 stay exact in doubles."""
    parts = ["""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, e FROM v QUALIFY c < 16)"""]
    for k in range(rounds + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, vec_id, v.e, c, list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c{k}.e) + list_inner_product(c{k}.e, c{k}.e) AS d
  FROM v CROSS JOIN c{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if k < rounds:
            parts.append(f"""
c{k + 1} AS MATERIALIZED (
  SELECT c{k}.c, coalesce(m.e, c{k}.e) AS e FROM c{k} LEFT JOIN (
    SELECT c, list(x ORDER BY p) AS e FROM (
      SELECT c, p, floor(sum(x) / count(*)) AS x FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{k}) GROUP BY c, p) GROUP BY c) m
  ON m.c = c{k}.c)""")
    return ",".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY a{rounds}.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c{rounds}.e, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
"""


SQL["op13_clusters"] = _clusters_sql()
