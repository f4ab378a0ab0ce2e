"""The registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (
    fingerprints,
    infill,
    jaccard,
    licenses,
    lines,
    mixing,
    packing,
    quality,
    repair,
    simhash,
    substrings,
    topk,
    toxicity,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
WITH sizes AS (
  SELECT doc_id, source, md5(text) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (ARRAY[5.0::DOUBLE, 2.0, 1.0])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(2.0::DOUBLE * source_size) OVER filled, 0.0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0.0)) AS level,
         2.0::DOUBLE * source_size / weight AS fills_at
  FROM per_source
  WINDOW filled AS (ORDER BY 2.0::DOUBLE * source_size / weight, turn
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size,
               coalesce((SELECT max(level) FROM levels WHERE level <= fills_at), fills_at) * weight) AS target
  FROM levels),
rates AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '-' || digest, '')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS coin
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rates
"""
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix to target weights takes of each document."""
    return mixing.plan_mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of power-of-two length, each a sequence of its own."""
    return packing.pieces(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )


@query(
    r"""
WITH lines AS (
  SELECT doc_id, site, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, coalesce('=' || source, 'none') AS site, string_split(text, chr(10)) AS parts
        FROM documents)),
trimmed AS (
  SELECT doc_id, site, line, place, trim(line, ' ' || chr(9) || chr(13)) AS body FROM lines),
spread AS (
  SELECT body FROM trimmed WHERE body <> '' GROUP BY body HAVING count(DISTINCT site) >= 10),
marked AS (
  SELECT *, body IN (SELECT body FROM spread) AS hit FROM trimmed),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hit) AS hits,
         bool_or(NOT hit AND body <> '') AS goes,
         string_agg(line, chr(10) ORDER BY place) AS whole,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT hit), '') AS rest
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
       (CASE WHEN goes THEN hits ELSE 0 END)::BIGINT AS n_removed,
       md5(CASE WHEN d.text IS NULL THEN NULL WHEN goes THEN rest ELSE whole END) AS kept_md5
FROM documents d LEFT JOIN kept USING (doc_id)
"""
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are spread over many sites."""
    return lines.remove_boilerplate(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.md5("kept").alias("kept_md5")
    )


@query(
    r"""
WITH tokens AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM tokens),
starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS place, words FROM tokens WHERE len(words) >= 20),
windows AS (
  SELECT doc_id, place, array_to_string(words[place : place + 19], ' ') AS body FROM starts),
later AS (
  SELECT doc_id, place FROM windows
  QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, place) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM later),
kept AS (
  SELECT p.doc_id, count(*) AS n_words, count(g.place) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY p.place) FILTER (WHERE g.place IS NULL), '') AS rest
  FROM placed p LEFT JOIN gone g USING (doc_id, place) GROUP BY p.doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 20-word windows that occurred before."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, body FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 1), lambda k: array_to_string(words[k : k + 2], ' ')) END) AS body
    FROM tokens)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.body = b.body AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their 3-word shingles."""
    return jaccard.link(table(spark, sf_dir, "documents"), shingle=3, percent=90).select(
        "doc_id", "n_shingles", "component_id"
    )


@query(
    """
WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS name, vec_id,
         list_transform(embedding, lambda x: floor(64.0::DOUBLE * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.name AS query, q.vec_id AS query_id, p.vec_id, list_inner_product(q.x, p.x)::BIGINT AS score
  FROM points q JOIN points p ON q.vec_id % 20 = 0 AND p.name <> q.name),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 20
"""
)
def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    both = F.array_union("base_labels", F.col("spans.label"))
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with the likenesses."""
    return fingerprints.with_earlier(table(spark, sf_dir, "documents"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query(
    r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
lots AS (
  SELECT *, len(units) AS n,
         ('0x' || digest[1:8])::BIGINT % (len(units) + 1) AS x, ('0x' || digest[9:16])::BIGINT % (len(units) + 1) AS y,
         ('0x' || digest[25:32])::BIGINT % 100 < 50 AS spm,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(units[1 : least(x, y)], ''), '') AS prefix,
         coalesce(array_to_string(units[least(x, y) + 1 : greatest(x, y)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(x, y) + 1 : n], ''), '') AS suffix
  FROM lots)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN NOT plain THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE WHEN plain THEN text
                   WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
)
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in its middle, and rebuilt from that."""
    changed = infill.transform(table(spark, sf_dir, "documents"))
    return infill.restore(changed).select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )


@query()
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in three bits or fewer."""
    return simhash.link(table(spark, sf_dir, "documents"), shingle=3, radius=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query(
    r"""
WITH RECURSIVE original AS (
  SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') AS name, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
             lambda c: ascii(c)::BIGINT)),
           lambda r, c: list_reduce(list_prepend(xor(r, c), range(8)),
                                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS lot
  FROM conversations),
damaged AS (
  SELECT name, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
  FROM original WHERE lot <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY turn NULLS FIRST, role, text, copy) AS k,
         substr(role, 1, 1) AS initial
  FROM damaged),
faults AS (
  SELECT *, lag(initial) OVER (PARTITION BY name ORDER BY k) AS before,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY name, role, text ORDER BY k) > 1 AS again,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS open
  FROM placed),
gap(a, b, n, made) AS (VALUES
  ('start', 'start', 0, []::VARCHAR[]), ('S', 'S', 0, []), ('U', 'U', 0, []), ('A', 'A', 0, []),
  ('start', 'U', 1, ['user:']), ('S', 'U', 1, ['user:']), ('A', 'U', 1, ['user:']), ('U', 'A', 1, ['assistant:']),
  ('start', 'A', 2, ['user:', 'assistant:']), ('S', 'A', 2, ['user:', 'assistant:'])),
moves(a, letter, initial, b, cost, role) AS (VALUES
  ('start', 'D', NULL, 'start', 2, NULL), ('S', 'D', NULL, 'S', 2, NULL), ('U', 'D', NULL, 'U', 2, NULL),
  ('A', 'D', NULL, 'A', 2, NULL), ('start', 'K', 's', 'S', 0, NULL), ('start', 'K', 'u', 'U', 0, NULL),
  ('S', 'K', 'u', 'U', 0, NULL), ('A', 'K', 'u', 'U', 0, NULL), ('U', 'K', 'a', 'A', 0, NULL),
  ('start', 'R', NULL, 'U', 1, 'user'), ('S', 'R', NULL, 'U', 1, 'user'), ('A', 'R', NULL, 'U', 1, 'user'),
  ('U', 'R', NULL, 'A', 1, 'assistant')),
walk AS (
  SELECT DISTINCT name, 0::BIGINT AS k, 'start' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS made FROM faults
  UNION ALL
  SELECT name, k, state, cost, audit, made FROM (
    SELECT w.name, f.k, m.b AS state, w.audit || repeat('I', g.n) || m.letter AS audit,
           w.cost + 5 * g.n + m.cost + CASE WHEN m.letter <> 'D' AND f.open THEN 5 ELSE 0 END AS cost,
           list_concat(w.made, g.made, CASE WHEN m.letter = 'D' THEN [] ELSE [coalesce(m.role, f.role) || ':' || f.text] END) AS made
    FROM walk w JOIN faults f ON f.name = w.name AND f.k = w.k + 1
    JOIN gap g ON g.a = w.state
    JOIN moves m ON m.a = g.b AND (m.letter = 'D' OR NOT (f.blank OR f.again) AND (m.letter = 'R' OR m.initial = f.initial)))
  QUALIFY row_number() OVER (PARTITION BY name, state ORDER BY cost, audit) = 1),
summed AS (
  SELECT name, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (open AND NOT again AND NOT blank) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY name),
best AS (
  SELECT w.name, w.cost + 5 * g.n AS cost, w.audit || repeat('I', g.n) AS audit, list_concat(w.made, g.made) AS made
  FROM walk w JOIN summed s ON s.name = w.name AND s.size = w.k
  JOIN gap g ON g.a = w.state AND g.b IN ('start', 'A')
  QUALIFY row_number() OVER (PARTITION BY w.name ORDER BY w.cost + 5 * g.n, w.audit || repeat('I', g.n)) = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, name FROM original) o LEFT JOIN summed USING (name) LEFT JOIN best USING (name)
"""
)
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and the cheapest edits that repair them."""
    return repair.audit(table(spark, sf_dir, "conversations"))
