"""The same results in DuckDB SQL, where SQL can express them."""

WORDS = r"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{breaks}'), lambda x: x <> '')"


def _words(text: str, breaks: str) -> str:
    return "coalesce(" + WORDS.format(text=text, breaks=breaks) + ", [])"


SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MINHASH = rf"""
WITH RECURSIVE split AS MATERIALIZED (
    SELECT doc_id, {_words('text', SPACES)} AS w FROM documents
),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        END) AS shingle FROM split
    )
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * pairs.n >= 75 * (x.n + y.n - pairs.n)
),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM sizes
    UNION
    SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen
),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.node = d.doc_id
"""

DECONTAMINATION = rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, {_words('text', NOT_ALNUM)} AS w FROM documents
),
items AS MATERIALIZED (
    SELECT item_id, {_words('text', NOT_ALNUM)} AS w FROM benchmark
),
windows AS MATERIALIZED (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS run FROM (
        SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0
    )
),
sizes AS MATERIALIZED (SELECT DISTINCT k FROM windows),
runs AS MATERIALIZED (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS run FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k
    )
),
hits AS MATERIALIZED (SELECT doc_id, item_id, k, i FROM runs JOIN windows USING (k, run)),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

def _bitplanes(k: int = 40, rounds: int = 5) -> str:
    """Every round as two steps: the nearest centroid of each vector, the floor of each mean."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
distance{r} AS MATERIALIZED (
    SELECT row, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM vectors, centroids{r}
),
nearest{r} AS MATERIALIZED (
    SELECT row, cluster, distance FROM distance{r}
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)""")
        if r < rounds:
            steps.append(f"""
means{r} AS MATERIALIZED (
    SELECT cluster, list(mean ORDER BY place) AS c FROM (
        SELECT cluster, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
        FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM nearest{r} JOIN vectors USING (row))
        GROUP BY cluster, place
    ) GROUP BY cluster
),
centroids{r + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.c, o.c) AS c FROM centroids{r} o LEFT JOIN means{r} m USING (cluster)
)""")
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c
    FROM vectors ORDER BY sha256('2:' || vec_id), v LIMIT {k}
),{",".join(steps)},
inertias AS (SELECT cluster, sum(distance) AS cluster_inertia FROM nearest{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(distance) FROM nearest{rounds}) AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM nearest{rounds} JOIN vectors USING (row) JOIN inertias USING (cluster) JOIN centroids{rounds} USING (cluster)
"""


ORACLE = {"op6_minhash": MINHASH, "op9_decontamination": DECONTAMINATION, "op12_bitplanes": _bitplanes()}
