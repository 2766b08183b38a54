"""Registered queries of this subpackage: every operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, embed_dedup, fingerprint, mixing, mixture, packing, pii, quality, repair, shards, simhash, tokenbin, unigram
from .common import table


def tokenizer_file(name: str) -> str:
    """A vocabulary of the public tokenizers package, at its place on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.round_trip_report(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_report(table(spark, sf_dir, "documents"), 40)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score_report(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=3)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenbin.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)
    return tokenbin.read_token_files(spark, manifest)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_report(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = [
        op1_embedding_near_dedup, op2_pii, op3_quality_classifier, op4_sentencepiece, op5_fingerprints, op6_sharding,
        op7_lm_scoring, op8_simhash_near_dedup, op9_best_fit_packing, op10_token_files, op11_collocations, op12_conversation_repair, op13_source_mixing, pipeline,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """SQL counterparts; the other operators have none and are tested against brute force."""
    return {"op1_embedding_near_dedup": OP1_SQL, "op11_collocations": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_source_mixing": OP13_SQL}


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
)
SELECT v.vec_id, (SELECT count(*) FROM pairs p WHERE p.a = v.vec_id) AS n_links,
       (SELECT min(r.b) FROM reach r WHERE r.a = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(r.b) FROM reach r WHERE r.a = v.vec_id) AS kept
FROM v
"""

OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS name, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat_ws(':', '29', doc_id, md5(coalesce(text, '')))) AS h
  FROM documents
), s AS (
  SELECT name, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY name) - 1 AS rank,
         [5, 2, 1][(row_number() OVER (ORDER BY name) - 1) % 3 + 1]::HUGEINT AS weight
  FROM d GROUP BY name
), filled AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS level,
         sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s
), line AS (
  SELECT arg_min(level, (source_size / weight, rank)) AS level, arg_min(free, (source_size / weight, rank)) AS free
  FROM filled WHERE weight * level <= 3 * source_size * free
), t AS (
  SELECT s.name, s.rank, s.source_size, least(s.weight::DOUBLE * line.level::DOUBLE / line.free::DOUBLE, (3 * s.source_size)::DOUBLE) AS target FROM s, line
), q AS (
  SELECT *, least(floor(target + 0.5)::HUGEINT, 3 * source_size) AS quota FROM t
), points AS (
  SELECT *, greatest(1, CAST(2 ** ceil(log2(greatest(2, ceil(sum(quota) OVER () / 1024)))) AS HUGEINT)) AS points,
         coalesce(sum(quota) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(quota) OVER () AS everything
  FROM q
), cut AS (
  SELECT *, least(quota, greatest(1, ((before + quota) * points + everything - 1) // everything - (before * points + everything - 1) // everything)) AS slots FROM points
), placed AS (
  SELECT d.*, source_size, target, quota, quota // slots AS low, quota % slots AS more,
         sum(size) OVER (PARTITION BY d.name ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d JOIN cut USING (name)
), turns AS (
  SELECT *, start + turn * source_size AS begin, least(start + turn * source_size + size, quota) AS stop FROM placed, (VALUES (0), (1), (2)) AS v(turn)
), taken AS (
  SELECT doc_id, sum(stop - begin) AS taken, sum(
    CASE WHEN stop - 1 < more * (low + 1) THEN (stop - 1) // (low + 1) ELSE more + (stop - 1 - more * (low + 1)) // low END
    - CASE WHEN begin < more * (low + 1) THEN begin // (low + 1) ELSE more + (begin - more * (low + 1)) // low END + 1) AS slots
  FROM turns WHERE begin < stop GROUP BY doc_id
)
SELECT p.doc_id, p.size::BIGINT AS size, p.source_size::BIGINT AS source_size, p.target, coalesce(t.taken, 0)::BIGINT AS taken, coalesce(t.slots, 0)::BIGINT AS slots
FROM placed p LEFT JOIN taken t USING (doc_id)
"""

#: Forward over the rows: per state the cheapest (cost, letters, lines); crc32 by its table of 256 entries.
OP12_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(concat_ws(':', coalesce(conv_id::VARCHAR, ' '), coalesce(turn::VARCHAR, ' ')), ''), lambda x: ascii(x)::UBIGINT) AS bytes
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295::UBIGINT], bytes), lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295) % 20 AS h
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM hashed JOIN (VALUES (1), (2)) AS v(copy) ON h <> 0 AND (h = 3 OR copy = 1)
), placed AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS rows, lag(left(role, 1)) OVER w AS initial_before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text), copy)
), marked AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
), steps AS (
  SELECT conv_id, 0 AS pos, {'c': 0, 's': '', 't': ''} AS s0, {'c': 1000000, 's': '', 't': ''} AS s1, {'c': 1000000, 's': '', 't': ''} AS s2, {'c': 1000000, 's': '', 't': ''} AS s3
  FROM (SELECT DISTINCT conv_id FROM marked)
  UNION ALL
  SELECT conv_id, pos, s0, s1, s2, s3 FROM (
    SELECT conv_id, pos, struct_pack(c := i0.c + 3, s := i0.s || 'D', t := i0.t) AS s0,
      list_sort([struct_pack(c := i1.c + 3, s := i1.s || 'D', t := i1.t)]
        || CASE WHEN gone OR left(role, 1) <> 's' THEN [] ELSE [struct_pack(c := i0.c + cut, s := i0.s || 'K', t := i0.t || own)] END)[1] AS s1,
      list_sort([struct_pack(c := i2.c + 3, s := i2.s || 'D', t := i2.t)]
        || CASE WHEN gone THEN [] ELSE list_transform([i0, i1, i3], lambda x: struct_pack(c := x.c + cut + 2, s := x.s || 'R', t := x.t || chr(10) || 'user:' || text)) END
        || CASE WHEN gone OR left(role, 1) <> 'u' THEN [] ELSE list_transform([i0, i1, i3], lambda x: struct_pack(c := x.c + cut, s := x.s || 'K', t := x.t || own)) END)[1] AS s2,
      list_sort([struct_pack(c := i3.c + 3, s := i3.s || 'D', t := i3.t)]
        || CASE WHEN gone THEN [] ELSE [struct_pack(c := i2.c + cut + 2, s := i2.s || 'R', t := i2.t || chr(10) || 'assistant:' || text)] END
        || CASE WHEN gone OR left(role, 1) <> 'a' THEN [] ELSE [struct_pack(c := i2.c + cut, s := i2.s || 'K', t := i2.t || own)] END)[1] AS s3
    FROM (
      SELECT *, list_sort([i2_, struct_pack(c := i3.c + 2, s := i3.s || 'I', t := i3.t || chr(10) || 'user:')])[1] AS i2 FROM (
        SELECT *, list_sort([i3_, struct_pack(c := i2_.c + 2, s := i2_.s || 'I', t := i2_.t || chr(10) || 'assistant:')])[1] AS i3 FROM (
          SELECT m.conv_id, m.pos::INTEGER AS pos, m.role, m.text, chr(10) || m.role || ':' || m.text AS own, m.fault IN ('blank', 'duplicate') AS gone, CASE WHEN m.fault = 'truncated' THEN 1 ELSE 0 END AS cut,
            s0 AS i0, s1 AS i1, s3 AS i3_,
            list_sort([s2] || list_transform([s0, s1, s3], lambda x: struct_pack(c := x.c + 2, s := x.s || 'I', t := x.t || chr(10) || 'user:')))[1] AS i2_
          FROM steps s JOIN marked m ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND m.pos = s.pos + 1
        )
      )
    )
  )
), ends AS (
  SELECT s.conv_id, list_sort([s0, s3, struct_pack(c := s2.c + 2, s := s2.s || 'I', t := s2.t || chr(10) || 'assistant:'),
      struct_pack(c := s1.c + 4, s := s1.s || 'II', t := s1.t || chr(10) || 'user:' || chr(10) || 'assistant:')])[1] AS best
  FROM steps s JOIN (SELECT conv_id, max(rows) AS rows FROM marked GROUP BY conv_id) n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.pos = n.rows
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pos > 1 AND initial_before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.s, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counts c ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON d.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         list_filter(regexp_split_to_array(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[\\x20\\x09]+'), lambda w: w <> '') AS words
  FROM documents
), grams AS (
  SELECT lang, m, list_slice(words, i, i + m - 1) AS phrase FROM (
    SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS v(m)
  )
), f AS (
  SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (
  SELECT lang, m, phrase, f AS a FROM f WHERE m > 1 AND f >= 100
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c g ON s.lang = g.lang AND g.m > s.m AND 100 * g.a >= 100 * s.a
  WHERE len(list_filter(range(1, g.m - s.m + 2), lambda i: list_slice(g.phrase, i, i + s.m - 1) = s.phrase)) > 0
), cuts AS (
  SELECT lang, m, phrase, a, unnest(range(1, m)) AS k FROM c ANTI JOIN inside USING (lang, phrase)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, n, k, l.f AS l, r.f AS r, (1000 * a * n) // (l.f * r.f) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = list_slice(cuts.phrase, 1, k) JOIN f r ON r.lang = cuts.lang AND r.phrase = list_slice(cuts.phrase, k + 1, cuts.m)
  JOIN totals ON totals.lang = cuts.lang
), best AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, n, l, r, score, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE nth = 1
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
