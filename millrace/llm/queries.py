"""Registered queries of the operators on whole tables, and their SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    lang_pieces, licences, line_windows, main_text, merkle, mixing, near_vectors, order_minhash, packing, quality,
    spaced_seeds, spellings, toxic_spans,
)
from .common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_pieces.identify(table(spark, sf_dir, "documents"))


def op4_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.without_repeats(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_spans.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("proof")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix, op2_near_vectors, op3_language, op4_near_texts, op5_decontaminate, op6_quality, op7_line_windows,
        op8_main_text, op9_shards, op10_licences, op11_toxic_spans, op12_spellings, op13_manifest)
}

# CTEs for crc32 in SQL: its table by rule, and the checksum of every text of a column.
CRC_TABLE = """crc_bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of a UTF-8 text, beside ``crc_table``."""
    return (
        f"xor(list_reduce(list_transform(range(1, strlen({text}) + 1), "
        f"lambda j: ('0x' || substr(hex(encode({text})), 2 * j - 1, 2))::BIGINT), "
        f"lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)")


def _field(text: str) -> str:
    return f"CASE WHEN {text} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"))) + ")"


ORACLES = {
    "op2_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.b, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
""",
    "op7_line_windows": """
WITH u AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS line FROM u),
n AS (
  SELECT doc_id, pos, line, lead(line) OVER w AS l2, lead(line, 2) OVER w AS l3, lead(pos, 2) OVER w AS e
  FROM t WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
f AS (
  SELECT doc_id, pos, e, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) AS turn
  FROM n WHERE l3 IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, e + 1)) AS pos FROM f WHERE turn > 1),
k AS (
  SELECT u.doc_id, string_agg(raw, chr(10) ORDER BY u.pos) FILTER (WHERE g.pos IS NULL) AS kept,
    count(*) AS n_lines, count(g.pos) AS n_removed
  FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.pos = u.pos GROUP BY u.doc_id)
SELECT d.doc_id, n_lines, n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM documents d LEFT JOIN k USING (doc_id)
""",
    "op12_spellings": f"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS raw FROM documents),
d AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS doc,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM r GROUP BY ALL),
h AS (SELECT run, n, {crc32_sql("(doc || ':' || run)")} AS h FROM d, crc_table WHERE length(run) >= 6),
o AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
q AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM p),
x AS (
  SELECT q.word, z.word AS other FROM q JOIN q z ON q.i = z.i AND q.a = z.a AND q.b = z.b AND q.word <> z.word UNION
  SELECT q.word, v.word FROM q JOIN v ON v.word = q.a || q.b UNION
  SELECT v.word, q.word FROM q JOIN v ON v.word = q.a || q.b),
y AS (
  SELECT x.word, s.n, count(*) AS n_near, first(x.other ORDER BY o.n DESC, x.other) AS best, max(o.n) AS best_n
  FROM x JOIN v s ON s.word = x.word JOIN v o ON o.word = x.other GROUP BY x.word, s.n),
f AS (SELECT word, best AS form, best_n AS form_n FROM y WHERE best_n >= 5 * n),
c AS (SELECT word, form AS root, 1 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN f ON f.word = c.root),
e AS (SELECT word, last(root ORDER BY k) AS root FROM c GROUP BY word)
SELECT v.word, f.form, coalesce(e.root, v.word) AS root, v.n, coalesce(y.n_near, 0) AS n_near, f.form_n
FROM v LEFT JOIN y ON y.word = v.word LEFT JOIN f ON f.word = v.word LEFT JOIN e ON e.word = v.word
""",
    "op13_manifest": f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("n_chars + 1")} END AS tampered
  FROM documents, crc_table),
l AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
g AS (SELECT lang, 0 AS k, i, n, leaf AS h FROM l UNION ALL
  SELECT lang, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM g WHERE n > 1 GROUP BY lang, k, i // 2, n),
u AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM g WHERE n = 1),
m AS (SELECT 0 AS k, i, n, subroot AS h FROM u UNION ALL
  SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM m WHERE n > 1 GROUP BY k, i // 2, n),
w AS (SELECT h AS root FROM m WHERE n = 1),
s AS (
  SELECT l.lang, l.i, string_agg(g.h, '' ORDER BY g.k) AS p
  FROM l JOIN g ON g.lang IS NOT DISTINCT FROM l.lang AND g.n > 1 AND g.i = xor(l.i >> g.k, 1) GROUP BY l.lang, l.i),
t AS (SELECT u.i, string_agg(m.h, '' ORDER BY m.k) AS p FROM u JOIN m ON m.n > 1 AND m.i = xor(u.i >> m.k, 1) GROUP BY u.i),
a AS (SELECT lang, i, 0 AS k, i AS at, n, coalesce(tampered, leaf) AS h FROM l UNION ALL
  SELECT a.lang, a.i, a.k + 1, a.at // 2, (a.n + 1) // 2,
    sha256(CASE WHEN a.at % 2 = 1 THEN g.h || a.h ELSE a.h || coalesce(g.h, '') END)
  FROM a LEFT JOIN g ON g.lang IS NOT DISTINCT FROM a.lang AND g.k = a.k AND g.i = xor(a.at, 1) WHERE a.n > 1),
b AS (SELECT a.lang, a.i, 0 AS k, u.i AS at, u.n, a.h FROM a JOIN u ON u.lang IS NOT DISTINCT FROM a.lang WHERE a.n = 1 UNION ALL
  SELECT b.lang, b.i, b.k + 1, b.at // 2, (b.n + 1) // 2,
    sha256(CASE WHEN b.at % 2 = 1 THEN m.h || b.h ELSE b.h || coalesce(m.h, '') END)
  FROM b LEFT JOIN m ON m.k = b.k AND m.i = xor(b.at, 1) WHERE b.n > 1)
SELECT l.doc_id, l.leaf, u.subroot, w.root, sha256(coalesce(s.p, '') || coalesce(t.p, '')) AS proof_sha256,
  b.h AS folded_root, b.h = w.root AS verified
FROM l JOIN u ON u.lang IS NOT DISTINCT FROM l.lang JOIN b ON b.n = 1 AND b.i = l.i AND b.lang IS NOT DISTINCT FROM l.lang
LEFT JOIN s ON s.i = l.i AND s.lang IS NOT DISTINCT FROM l.lang LEFT JOIN t ON t.i = u.i, w
""",
}
