"""SQL that another engine runs over the same tables, for the operators that SQL can express."""

from __future__ import annotations

#: Least id that undirected links reach, over a table ``links(a, b)`` and one ``nodes(id)``.
REACH = """reach AS (SELECT id AS node, id AS origin FROM nodes UNION SELECT l.b, r.origin FROM reach r JOIN links l ON l.a = r.node),
 named AS (SELECT node, min(origin) AS component_id FROM reach GROUP BY node)"""

OP4 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
 nodes AS (SELECT vec_id AS id FROM embeddings), {REACH}
 SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN named ON node = vec_id"""

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
OP5 = f"""WITH i AS (SELECT item_id, {_WORDS} AS words FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
 iw AS (SELECT item_id, len(words) AS item_size, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM i),
 dw AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM d),
 met AS (SELECT doc_id, item_id, pos - place AS start, place, item_size, lead(place, 19) OVER (PARTITION BY doc_id, item_id, pos - place ORDER BY place) AS twentieth FROM dw JOIN iw USING (w))
 SELECT doc_id, item_id, start::BIGINT AS start, count(*) AS n_equal, item_size::BIGINT AS item_size, count(*) / item_size AS overlap
 FROM met GROUP BY doc_id, item_id, start, item_size HAVING count(*) >= 0.8 * item_size OR bool_or(coalesce(twentieth - place < 25, false))"""

OP8 = f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(words[k : k + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS k FROM d WHERE len(words) > 0)),
 n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
 pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * met >= 80 * (p.size + q.size - met)),
 nodes AS (SELECT doc_id AS id FROM documents), {REACH}
 SELECT documents.doc_id, coalesce(n.size, 0) AS n_shingles, component_id FROM documents JOIN named ON node = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id"""

ORACLE_SQL = {"op4_embedding_near_dedup": OP4, "op5_benchmark_decontamination": OP5, "op8_ngram_jaccard_join": OP8}
