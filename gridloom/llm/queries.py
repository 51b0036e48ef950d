"""The corpus operators' queries, each over its whole table, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, divergence, embedding_dedup, filter_audit, html_main, knn_join, line_dedup, mixing, ngram_join, packing, quality, token_store, toxicity
from gridloom.llm.common import doc_fold, shared_path, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), doc_fold(3) != 1)
    return _judged(quality.score(docs, model), doc_fold(3) == 1)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op3_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), doc_fold(5) != 0)
    return _judged(toxicity.score(docs, model), doc_fold(5) == 0)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), named, (F.col("n_hit") > 0).alias("contaminated"))


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_key AS key
  FROM (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line,
           translate(trim(unnest(parts), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  )
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_path(spark, "tokens")
    files, held = token_store.stored(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    rows = held.select("file", "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    starts = token_store.file_starts(files)
    return rows.join(starts, F.col("file") == F.col("name")).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    written, places = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return packing.digest(written, places)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "n_text_links", "group_id", F.col("doc_id").eqNullSafe(F.col("group_id")).alias("kept"))


KNN_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
QUALIFY rank <= 20
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.a, r.root FROM reach r JOIN links l ON l.b = r.node
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON a = vec_id LEFT JOIN roots ON node = vec_id
"""

NGRAM_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b, c = x.n AND c = y.n AS same FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), classes AS (
  SELECT d.doc_id, least(d.doc_id, coalesce(min(b), d.doc_id)) AS class_id FROM documents d LEFT JOIN links l ON l.a = d.doc_id AND same GROUP BY d.doc_id
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.a, r.root FROM reach r JOIN links l ON l.b = r.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node), counts AS (
  SELECT a, count(*) AS n_links, count(DISTINCT k.class_id) FILTER (WHERE NOT same) AS n_text_links FROM links JOIN classes k ON k.doc_id = b GROUP BY a
)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links, root AS group_id, doc_id = root AS kept
FROM classes JOIN roots ON node = doc_id LEFT JOIN counts ON a = doc_id
"""


AUDIT_SQL = r"""
WITH RECURSIVE orders AS (
  SELECT '' AS o UNION ALL SELECT o || f FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS t(f) WHERE NOT contains(o, f)
), d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t), said AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id
), w AS (SELECT d.*, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN coalesce(w.doc_id > first, false) THEN 'E' ELSE '' END AS f
  FROM w JOIN firsts USING (t) LEFT JOIN said ON said.doc_id = w.doc_id
), grouped AS (SELECT part, good, bad, f, count(*) AS n FROM fails GROUP BY ALL), steps AS (
  SELECT part, o, s, o[s] AS letter, f, n, good, bad,
         coalesce(list_min(list_filter(range(1, 6), lambda i: contains(f, o[i]))), 6) AS first
  FROM grouped, (SELECT o FROM orders WHERE length(o) = 5), range(1, 6) AS r(s)
), counted AS (
  SELECT part, o AS filter_order, s::INT AS step, letter, coalesce(sum(n) FILTER (WHERE first > s), 0) AS kept, coalesce(sum(n) FILTER (WHERE first = s), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE first < s AND contains(f, letter)), 0) AS redundant, coalesce(sum(n) FILTER (WHERE f = letter), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE first = s AND good), 0) AS good_lost, coalesce(sum(n) FILTER (WHERE first = s AND bad), 0) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), terms AS (
  SELECT n, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT n) >= 30), counts AS (
  SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (SELECT DISTINCT lang, source FROM d), size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang), every AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0)::HUGEINT AS c FROM groups g JOIN kept k USING (lang) LEFT JOIN counts n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), p AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM every JOIN size USING (lang)
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM every GROUP BY ALL) JOIN size USING (lang)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), own AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM (FROM pairs UNION ALL FROM own) QUALIFY part = 'pair' OR rank <= 50
"""

LEAK_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows), runs AS (
  SELECT n, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS r(i) WHERE len(w) >= size
), hits AS (SELECT n, i, r.size, item_id FROM runs r JOIN windows x ON r.size = x.size AND r.s = x.s), words AS (
  SELECT n, count(DISTINCT k) AS n_hit FROM (SELECT n, unnest(range(i, i + size)) AS k FROM hits) GROUP BY n
), items AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT n, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY n
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (n) LEFT JOIN items USING (n)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_mixing, op3_knn_join, op4_embedding_dedup, op5_line_dedup, op6_token_store, op7_packing, op8_ngram_join, op9_toxicity, op10_html_extraction, op11_filter_audit, op12_source_divergence, op13_decontamination)}


def oracle_sql() -> dict[str, str]:
    return {"op3_knn_join": KNN_SQL, "op4_embedding_dedup": EMBEDDING_SQL, "op5_line_dedup": LINE_DEDUP_SQL, "op8_ngram_join": NGRAM_SQL, "op11_filter_audit": AUDIT_SQL, "op12_source_divergence": DIVERGENCE_SQL, "op13_decontamination": LEAK_SQL}
