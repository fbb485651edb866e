"""The registered queries of this subpackage and the SQL they agree with."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm import (byte_bpe, chat_format, jaccard_join, licenses, line_dedup, packing, periodic_runs, quality_classifier, quality_rules,
                        token_align, topk, toxicity, warc)
from strata.llm.store import stored
from strata.llm.workers import importable
from strata.session import checkpoint_dir
from strata.sources.tables import read_table


def op1_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_line_dedup(spark, sf_dir):
    """Lines of every document that repeat another line, equal or one edit apart."""
    report = line_dedup.dedup_report(read_table(spark, sf_dir, "documents"))
    return report.withColumn("dropped_lines", F.array_join("dropped_lines", ","))


def op3_quality_classifier(spark, sf_dir):
    """Quality of every document by subword embeddings."""
    return quality_classifier.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark, sf_dir):
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9 and more."""
    return jaccard_join.join_documents(read_table(spark, sf_dir, "documents"))


def op5_ball_tree_topk(spark, sf_dir):
    """The 5 best inner products of each vector whose id is divisible by 50."""
    checkpoint_dir(spark)
    vectors = topk.whole_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op6_best_fit_packing(spark, sf_dir):
    """The bins that every document's pieces are packed into."""
    checkpoint_dir(spark)
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op7_warc(spark, sf_dir):
    """Pages written as WARC, normalised and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op8_quality_rules(spark, sf_dir):
    """Counts, base rule and verdict of every document."""
    return quality_rules.judge_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark, sf_dir):
    """Token ids of every document and the round trip, as digests."""
    return byte_bpe.digest_documents(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_license_scan(spark, sf_dir):
    """Licence notices in every document."""
    return licenses.scan_documents(read_table(spark, sf_dir, "documents"))


CONTROLS_SAID = "\\### Assistant: </turn> ok"  # a text full of control strings


def op11_chat_format(spark, sf_dir):
    """All conversations and one that says control strings, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROLS_SAID), (-7, 1, "assistant", CONTROLS_SAID)], turns.schema)
    return chat_format.digest(stored(chat_format.format_conversations(turns.unionByName(more)), "formatted"))


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every document."""
    return periodic_runs.report(read_table(spark, sf_dir, "documents"))


def op13_token_align(spark, sf_dir):
    """Two tokenizers' tokens of every document, aligned."""
    return token_align.align_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def _ready(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        importable(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {f.__name__: _ready(f) for f in (op1_toxicity, op2_line_dedup, op3_quality_classifier, op4_jaccard_join, op5_ball_tree_topk,
                                            op6_best_fit_packing, op7_warc, op8_quality_rules, op9_byte_bpe,
                                            op10_license_scan, op11_chat_format, op12_periodic_runs, op13_token_align)}

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": r"""
WITH RECURSIVE
s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
o AS (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM s),
f AS (SELECT * FROM o WHERE trim(l, ' ') <> ''),
d AS (SELECT l, length(l) AS n, row_number() OVER (ORDER BY l) AS id FROM (SELECT DISTINCT l FROM f)),
p AS (SELECT x.id AS a, y.id AS b FROM d x JOIN d y ON x.id <> y.id AND y.n BETWEEN x.n - 1 AND x.n + 1 AND x.n >= 20 AND y.n >= 20
        AND left(x.l, 9) = left(y.l, 9) WHERE levenshtein(x.l, y.l) <= 1
      UNION SELECT x.id, y.id FROM d x JOIN d y ON x.id <> y.id AND y.n BETWEEN x.n - 1 AND x.n + 1 AND x.n >= 20 AND y.n >= 20
        AND right(x.l, 9) = right(y.l, 9) WHERE levenshtein(x.l, y.l) <= 1),
r AS (SELECT id, id AS root FROM d UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
k AS (SELECT f.doc_id, f.pos, c.root, min(f.doc_id) OVER (PARTITION BY c.root) AS first_doc,
             row_number() OVER (PARTITION BY c.root, f.doc_id ORDER BY f.pos) AS nth
      FROM f JOIN d ON d.l = f.l JOIN c ON c.id = d.id),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> first_doc OR nth > 1) AS n_dropped,
             string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE doc_id <> first_doc OR nth > 1) AS dropped_lines
      FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_dropped, 0) AS INTEGER) AS n_dropped,
       coalesce(dropped_lines, '') AS dropped_lines
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id
""", "op4_jaccard_join": r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS root FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) m ON m.id = d.doc_id
""", "op5_ball_tree_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) AS dim FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM e q JOIN e c ON q.i = c.i AND q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""", "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
FROM g
"""}
