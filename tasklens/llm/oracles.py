"""DuckDB SQL for the operators that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NEAR_DEDUP = rf"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS words FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (shingle)
                      WHERE x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach(doc_id, low) AS (
    SELECT doc_id, doc_id FROM w
    UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.low < l.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(low) AS component_id, w.doc_id = min(low) AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id, n.n"""

CONTAMINATION = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS words FROM benchmark WHERE item_id IS NOT NULL),
iw AS MATERIALIZED (
    SELECT DISTINCT item_id, least(len(words), 10) AS m, array_to_string(words[k:k + least(len(words), 10) - 1], ' ') AS win
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM i WHERE len(words) > 0)),
dw AS (
    SELECT doc_id, m, k, array_to_string(words[k:k + m - 1], ' ') AS win
    FROM (SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM iw))),
hits AS MATERIALIZED (SELECT doc_id, m, k, item_id FROM dw JOIN iw USING (m, win)),
hit_words AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS word FROM hits) GROUP BY 1),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SUBSTRINGS = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words FROM documents),
win AS MATERIALIZED (
    SELECT doc_id, k, sha256(array_to_string(words[k:k + 34], ' ')) AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS k FROM d)),
again AS (SELECT doc_id, k FROM win WHERE win IN (SELECT win FROM win GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS word FROM again),
word AS (SELECT doc_id, unnest(words) AS text, generate_subscripts(words, 1) AS word FROM d),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(text, ' ' ORDER BY word) AS kept FROM word ANTI JOIN gone USING (doc_id, word)
    GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

EXACT_DUPLICATES = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)"""

COLLOCATIONS = rf"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
totals AS MATERIALIZED (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (
    SELECT lang, words[i:i + m - 1] AS phrase, count(*) AS f FROM (
        SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m))
    GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS k FROM f WHERE len(phrase) > 1),
scored AS (
    SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, n, k,
        CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang JOIN f l ON l.lang = c.lang AND l.phrase = c.phrase[1:k]
    JOIN f r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1:]),
weakest AS MATERIALIZED (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
    SELECT lang, phrase[i:i + m - 1] AS phrase, max(f) AS f FROM (
        SELECT lang, phrase, f, m, unnest(range(1, len(phrase) - m + 2)) AS i
        FROM (SELECT lang, phrase, f, unnest(range(2, len(phrase))) AS m FROM f WHERE len(phrase) > 2)) GROUP BY ALL),
stays AS (
    SELECT s.lang, array_to_string(s.phrase, ' ') AS phrase, a, l, r, n, score FROM weakest s
    LEFT JOIN inner_ i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.f IS NULL OR i.f < a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM stays QUALIFY rank <= 2000"""


def _lloyd(rounds: int) -> str:
    near = """
a{t} AS MATERIALIZED (
    SELECT vec_id, c, distance FROM (
        SELECT vec_id, c, CAST(sum((d.x - m.x) * (d.x - m.x)) AS BIGINT) AS distance FROM d JOIN c{t} m USING (i) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1)"""
    move = """
c{u} AS MATERIALIZED (
    SELECT c, i, coalesce(x, old) AS x FROM (SELECT c, i, x AS old FROM c{t}) LEFT JOIN (
        SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
            SELECT c, i, sum(x) AS s, count(*) AS n FROM d JOIN a{t} USING (vec_id) GROUP BY ALL)) USING (c, i))"""
    steps = [near.format(t=t) + "," + move.format(t=t, u=t + 1) for t in range(rounds)]
    return ",".join([*steps, near.format(t=rounds)])


CLUSTERS = f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
d AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM v QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN d USING (vec_id)),{_lloyd(10)},
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a10 JOIN digest USING (c)"""
