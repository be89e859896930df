"""DuckDB SQL that the queries of this subpackage equal, over the same tables."""

from __future__ import annotations

LEXICAL_SEARCH = r"""
WITH lowered AS (
    SELECT doc_id, row_number() OVER () AS row, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
terms AS (
    SELECT doc_id, row, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered
),
lengths AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
),
wanted AS (SELECT item_id, term, count(*) AS q FROM item_terms GROUP BY item_id, term),
held AS (
    SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf
    FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY row, term
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, corpus GROUP BY term, docs
),
scores AS (
    SELECT wanted.item_id, held.row, any_value(held.doc_id) AS doc_id,
        CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total))))) AS BIGINT) AS score
    FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN lengths ON lengths.row = held.row, corpus
    GROUP BY wanted.item_id, held.row
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# The shortest runs of 8 words from every line on and up to every line; a later equal run is deleted.
LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx
    FROM documents WHERE text IS NOT NULL
),
counted AS (
    SELECT *, len(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n FROM lines
),
worded AS (
    SELECT doc_id, idx, line, greatest(n, length(line) // 10) AS words,
        row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS i,
        sum(greatest(n, length(line) // 10)) OVER (PARTITION BY doc_id ORDER BY idx) AS upto
    FROM counted WHERE n > 0
),
bounds AS (
    SELECT a.doc_id, a.i AS first, min(b.i) AS last
    FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 7 AND b.upto - a.upto + a.words >= 8
    GROUP BY ALL
    UNION
    SELECT b.doc_id, max(a.i), b.i
    FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND a.i BETWEEN b.i - 7 AND b.i AND b.upto - a.upto + a.words >= 8
    GROUP BY b.doc_id, b.i
),
texts AS (SELECT doc_id, list(line ORDER BY i) AS lines, list(idx ORDER BY i) AS places FROM worded GROUP BY doc_id),
runs AS (
    SELECT doc_id, places[first] AS start, places[last] AS stop, lines[first:last] AS run FROM bounds JOIN texts USING (doc_id)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS r FROM runs),
places AS (SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS idx FROM ranked WHERE r > 1),
marked AS (
    SELECT c.*, CASE WHEN n > 0 THEN p.idx IS NOT NULL END AS hit FROM counted c LEFT JOIN places p USING (doc_id, idx)
),
judged AS (
    SELECT *, coalesce(hit, last_value(hit IGNORE NULLS) OVER before AND first_value(hit IGNORE NULLS) OVER after, false) AS gone
    FROM marked
    WINDOW before AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        after AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (NOT gone), '') AS text
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text
FROM documents d LEFT JOIN kept USING (doc_id)
"""

# The digest of each run is made level by level; proofs gather the other node of the run at each level.
MERKLE_MANIFEST = """
WITH RECURSIVE fields AS (
    SELECT doc_id, lang, list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
            lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
            || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM documents
),
leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
            THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS tampered
    FROM fields
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS total
    FROM leaves
),
nodes AS (
    SELECT 0 AS level, lang, pos, total, leaf AS digest FROM placed
    UNION ALL
    SELECT level + 1, lang, pos // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE total > 1 GROUP BY level, lang, pos // 2, total
),
subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS total
    FROM nodes WHERE total = 1
),
tops AS (
    SELECT 0 AS level, pos, total, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM tops WHERE total > 1 GROUP BY level, pos // 2, total
),
root AS (SELECT digest AS root FROM tops WHERE total = 1),
steps AS (
    SELECT p.doc_id, p.lang, p.leaf, p.pos AS leaf_pos, s.subroot, n.level, p.pos >> n.level AS pos, n.digest AS sibling, false AS top
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
    JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.pos = xor(p.pos >> n.level, 1)
    UNION ALL
    SELECT p.doc_id, p.lang, p.leaf, p.pos, s.subroot, 1000 + n.level, s.pos >> n.level, n.digest, true
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN tops n ON n.pos = xor(s.pos >> n.level, 1)
),
proofs AS (
    SELECT lang, leaf_pos, sha256(string_agg(sibling, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY lang, leaf_pos
),
folded AS (
    SELECT p.lang, p.pos AS leaf_pos, p.pos, p.total, 0 AS level, p.tampered AS digest FROM placed p WHERE tampered IS NOT NULL
    UNION ALL
    SELECT f.lang, leaf_pos, f.pos // 2, (f.total + 1) // 2, f.level + 1,
        sha256(CASE WHEN n.digest IS NULL THEN f.digest WHEN f.pos % 2 = 1 THEN n.digest || f.digest ELSE f.digest || n.digest END)
    FROM folded f LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM f.lang AND n.level = f.level AND n.pos = xor(f.pos, 1)
    WHERE f.total > 1
),
folded_top AS (
    SELECT f.lang, leaf_pos, s.pos, s.total, 0 AS level, f.digest
    FROM folded f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.total = 1
    UNION ALL
    SELECT f.lang, leaf_pos, f.pos // 2, (f.total + 1) // 2, f.level + 1,
        sha256(CASE WHEN n.digest IS NULL THEN f.digest WHEN f.pos % 2 = 1 THEN n.digest || f.digest ELSE f.digest || n.digest END)
    FROM folded_top f LEFT JOIN tops n ON n.level = f.level AND n.pos = xor(f.pos, 1)
    WHERE f.total > 1
)
SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(x.proof_sha256, sha256('')) AS proof_sha256,
    coalesce(t.digest, r.root) AS folded_root, coalesce(t.digest = r.root, true) AS verified, p.lang, p.pos AS position
FROM placed p
JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
CROSS JOIN root r
LEFT JOIN proofs x ON x.lang IS NOT DISTINCT FROM p.lang AND x.leaf_pos = p.pos
LEFT JOIN (SELECT * FROM folded_top WHERE total = 1) t ON t.lang IS NOT DISTINCT FROM p.lang AND t.leaf_pos = p.pos
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
),
each_word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
windows AS (
    SELECT * FROM (
        SELECT doc_id, i, count(*) OVER following AS n, string_agg(word, ' ') OVER following AS words13
        FROM each_word
        WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING))
    WHERE n = 13
),
firsts AS (SELECT words13, min(doc_id) AS first_doc FROM windows GROUP BY words13),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (words13) WHERE first_doc < doc_id
),
kept AS (
    SELECT doc_id, count(gone.i) AS n_removed,
        string_agg(word, ' ' ORDER BY each_word.i) FILTER (gone.i IS NULL) AS text
    FROM each_word LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
),
item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i:i + least(len(w), 10) - 1] AS run
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
),
each_word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
places AS (
    SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS run
    FROM each_word
),
found AS (
    SELECT DISTINCT doc_id, i, size, item_id
    FROM (SELECT doc_id, i, size, run[:size] AS run FROM places JOIN (SELECT DISTINCT size FROM windows) ON len(run) >= size)
    JOIN windows USING (size, run)
),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

TOP_K = """
WITH ready AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM ready q JOIN ready c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
