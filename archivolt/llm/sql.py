"""DuckDB statements of the same results, for the problems that SQL can express over whole tables."""

_USABLE = """
usable AS (
  SELECT v.embedding_id, min(v.profile_id) AS profile_id,
         min(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(trim(v.vector_ref), '^[\\[{(]\\s*', ''), '\\s*[\\]})]$', ''), '\\s*[,;]\\s*|\\s+'),
                            lambda x: try_cast(x AS DOUBLE))) AS vec
  FROM vector_rows v JOIN model_profiles m ON v.profile_id = m.profile_id AND m.purpose = 'embedding' AND v.dimensions = m.dimensions
  WHERE v.embedding_id IS NOT NULL AND v.vector_ref IS NOT NULL
    AND len(regexp_split_to_array(regexp_replace(regexp_replace(trim(v.vector_ref), '^[\\[{(]\\s*', ''), '\\s*[\\]})]$', ''), '\\s*[,;]\\s*|\\s+')) = v.dimensions
  GROUP BY v.embedding_id),
fine AS (
  SELECT embedding_id, profile_id, list_transform(vec, lambda x: CAST(round(x * 100) AS BIGINT)) AS vec
  FROM usable WHERE len(list_filter(vec, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)"""

_P4 = """
WITH rec AS (
  SELECT document_id, title, language, media_type, byte_size, text_chars, extractor_profile FROM (
    SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM document_records WHERE document_id IS NOT NULL) WHERE rn = 1),
last AS (SELECT document_id, max(event_time) AS last_event FROM document_path_events WHERE document_id IS NOT NULL GROUP BY document_id),
members AS (SELECT DISTINCT group_id, document_id FROM duplicate_groups WHERE group_id IS NOT NULL AND document_id IS NOT NULL),
wide AS (
  SELECT m.group_id, m.document_id, e.trust_rank, l.last_event, r.text_chars,
    (CASE WHEN coalesce(lower(trim(r.title)), '') NOT IN ('', 'und', 'unk', 'n/a', 'untitled') THEN 1 ELSE 0 END
   + CASE WHEN coalesce(lower(trim(r.language)), '') NOT IN ('', 'und', 'unk', 'n/a', 'untitled') THEN 1 ELSE 0 END
   + CASE WHEN coalesce(lower(trim(r.media_type)), '') NOT IN ('', 'und', 'unk', 'n/a', 'untitled') THEN 1 ELSE 0 END
   + CASE WHEN r.byte_size IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN r.text_chars IS NOT NULL THEN 1 ELSE 0 END) AS filled
  FROM members m LEFT JOIN rec r USING (document_id) LEFT JOIN last l USING (document_id) LEFT JOIN extractor_profiles e USING (extractor_profile))
SELECT group_id, document_id FROM (
  SELECT group_id, document_id, row_number() OVER (PARTITION BY group_id ORDER BY filled DESC, trust_rank ASC NULLS LAST, last_event DESC NULLS LAST, text_chars DESC NULLS LAST, document_id) AS rn FROM wide)
WHERE rn = 1"""

SQL: dict[str, str] = {
    "p2_found": f"""
WITH {_USABLE},
ranked AS (
  SELECT a.embedding_id AS a, b.embedding_id AS b,
         row_number() OVER (PARTITION BY a.embedding_id ORDER BY list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), b.embedding_id) AS rn
  FROM fine a JOIN fine b ON a.profile_id = b.profile_id AND a.embedding_id <> b.embedding_id)
SELECT DISTINCT least(a, b) AS embedding_id_a, greatest(a, b) AS embedding_id_b FROM ranked WHERE rn <= 5""",
    "p4_found": _P4,
    "p5_found": """
SELECT c.chunk_id FROM chunks c
LEFT JOIN chunk_profiles p ON p.chunker_id = c.chunker_id
CROSS JOIN (SELECT max_chars FROM chunk_profiles WHERE is_default ORDER BY chunker_id LIMIT 1) d
WHERE length(c.text) > coalesce(p.max_chars, d.max_chars)""",
}
