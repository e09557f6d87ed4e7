"""Registry of the training-data queries: key -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from capstan.llm import adaptive_scan, arc_convert, bbit_minhash, byte_cnn, cgk, hpy, piece_bpe, prefix_trie, quality_llr, sharding, stratified_search, superkmer, templates
from capstan.llm.common import table
from capstan.session import scratch_path

MODEL = "piece_bpe_32k.model"


def public_model() -> str:
    """Path of the public tokenizer file (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_llr.quality_rules(docs, quality_llr.fit(docs, table(spark, sf_dir, "labels")))


def op2_superkmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.substring_digests(table(spark, sf_dir, "documents"))


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.classify(docs, byte_cnn.fit(docs, table(spark, sf_dir, "labels")))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy.score_documents(table(spark, sf_dir, "documents"))


def op6_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(table(spark, sf_dir, "pages"))


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.token_digests(table(spark, sf_dir, "documents"), public_model())


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    arc_convert.write_warc(arc_convert.with_types(arc_convert.arc_records(arc_convert.arc_archives(pages))), path)
    return arc_convert.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), cgk.Settings(shortest=1))


def op10_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), bbit_minhash.Settings(shingle=2))


def op11_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"))


def op12_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_superkmer": op2_superkmer,
    "op3_sampled_splitters": op3_sampled_splitters,
    "op4_byte_cnn": op4_byte_cnn,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_page_templates": op6_page_templates,
    "op7_piece_bpe": op7_piece_bpe,
    "op8_arc_to_warc": op8_arc_to_warc,
    "op9_cgk_decontamination": op9_cgk_decontamination,
    "op10_bbit_minhash": op10_bbit_minhash,
    "op11_adaptive_scan": op11_adaptive_scan,
    "op12_stratified_search": op12_stratified_search,
    "op13_prefix_trie": op13_prefix_trie,
}

# windows are taken as text and the smallest document of each window by plain grouping
OP2_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)
), least AS (
  SELECT k, min(doc_id) AS d FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT DISTINCT win.doc_id, i + unnest(range(0, 13)) AS p FROM win JOIN least ON win.k = least.k AND win.doc_id > least.d
), pos AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split
), kept AS (
  SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS t, count(*) AS n
  FROM pos LEFT JOIN hit ON pos.doc_id = hit.doc_id AND pos.p = hit.p WHERE hit.p IS NULL GROUP BY pos.doc_id
)
SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept ON split.doc_id = kept.doc_id
"""

# digests spelled out from the hex SHA-1, five bits a letter
OP8_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS h FROM p
), c AS (
  SELECT page_id, payload_bytes, h,
    list_transform(range(0, 8), lambda i: list_sum(list_transform(range(1, 6), lambda j:
      (strpos('0123456789abcdef', substr(h, CAST(5 * i + j AS BIGINT), 1)) - 1) * CAST(power(16, 5 - j) AS BIGINT)))) AS g
  FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(floor(g[k // 4 + 1] / power(32, 3 - k % 4)) AS BIGINT) % 32 + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM c WINDOW w AS (PARTITION BY h, payload_bytes)
"""

# all pairs of documents that share a shingle, then everything reachable over the links
OP10_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), parts AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                      WHEN len(w) = 1 THEN w ELSE [] END AS s FROM split
), shingle AS (
  SELECT DISTINCT doc_id, unnest(s) AS s FROM parts
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""

# every document scored for every item over plain term counts
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS t FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id
), total AS (
  SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0
), tf AS (
  SELECT r, doc_id, size, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS size, unnest(t) AS term FROM d) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n
), score AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n) // l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term), total GROUP BY item_id, r, doc_id
), place AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM place WHERE rank <= 20
"""

# CRC-32 bit by bit; prefixes as running digests; subtrees as pairs of prefixes of one conversation
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, sha256(len(role) || ':' || role || text) AS k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text)) - 1 AS p FROM t
), n AS (
  SELECT conv_id, count(*) AS turns FROM o GROUP BY conv_id
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
  FROM n
), b AS (
  SELECT c.conv_id, base, h, least(h, coalesce(turns, 0)) AS taken FROM c LEFT JOIN n ON n.conv_id = base
), rebuilt AS (
  SELECT b.conv_id, p AS i, k, w FROM b JOIN o ON o.conv_id = base AND p < h
  UNION ALL SELECT b.conv_id, p - h + taken, k, w FROM b JOIN o ON o.conv_id = b.conv_id AND p >= h
), member AS (
  SELECT conv_id, 0 AS d, 'root' AS k, 0 AS w FROM n
  UNION ALL SELECT conv_id, i + 1, sha256(string_agg(k, ',') OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)), w FROM rebuilt
), node AS (
  SELECT k, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w FROM member GROUP BY k
), edge AS (
  SELECT DISTINCT x.k, y.k AS up FROM member x JOIN member y ON x.conv_id = y.conv_id AND x.d = y.d + 1
), kids AS (
  SELECT up AS k, count(*) AS kids FROM edge GROUP BY up
), pair AS (
  SELECT DISTINCT x.k, y.k AS sub FROM member x JOIN member y ON x.conv_id = y.conv_id AND y.d >= x.d
), below AS (
  SELECT pair.k, count(*) FILTER (WHERE kids IS NULL) AS leaves, sum((n - 1) * w) AS saved
  FROM pair JOIN node ON node.k = sub LEFT JOIN kids ON kids.k = sub GROUP BY pair.k
), ending AS (
  SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS s
  FROM (SELECT conv_id, arg_max(k, d) AS k FROM member GROUP BY conv_id) GROUP BY k
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM node JOIN below ON below.k = node.k LEFT JOIN kids ON kids.k = node.k LEFT JOIN ending ON ending.k = node.k
LEFT JOIN edge ON edge.k = node.k LEFT JOIN node parent ON parent.k = edge.up
"""

ORACLE: dict[str, str] = {"op2_superkmer": OP2_SQL, "op8_arc_to_warc": OP8_SQL, "op10_bbit_minhash": OP10_SQL,
                          "op12_stratified_search": OP12_SQL, "op13_prefix_trie": OP13_SQL}
