"""SQL for DuckDB that gives what each registered query should give."""

from __future__ import annotations

from grainfold.registry.queries import CONFIDENCE, MODEL, RANDOM, RANDOM_MANY, ROUNDS

PLACES = """places AS (
  SELECT p_partkey AS place_id, p_size AS place_type_id,
         p_name || ', ' || p_brand || ', ' || p_type AS place_name FROM part)"""
LOCALITIES = """localities AS (
  SELECT place_id, CASE place_type_id WHEN 7 THEN place_name
         ELSE trim(substr(place_name, strpos(place_name, ',') + 1)) END AS locality
  FROM places WHERE place_type_id IN (7, 22))"""
PHOTOS = """photos AS (
  SELECT l_partkey AS place_id, CAST(year(l_shipdate) AS VARCHAR) AS y,
         l_returnflag || ' ' || year(l_shipdate) || ' y' || year(l_shipdate) || ' '
         || l_linestatus || ' q' || CAST(l_quantity AS INT) || ' Supplier' || l_suppkey
         || ' ' || l_linestatus AS tags FROM lineitem)"""
COUNTS = """counts AS (
  SELECT locality, count(*) AS n_photos FROM photos JOIN localities USING (place_id)
  GROUP BY locality)"""
TOP = "top AS (SELECT * FROM counts ORDER BY n_photos DESC, locality LIMIT 50)"
TAGS = """tokens AS (
  SELECT locality, unnest(string_split(replace(tags, y, ''), ' ')) AS tag
  FROM photos JOIN localities USING (place_id)),
tags AS (
  SELECT locality, tag, count(*) AS n FROM tokens
  WHERE NOT contains(lower(locality), lower(tag)) GROUP BY locality, tag)"""
TOP_TAGS = f"""WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS}, {TOP}, {TAGS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY locality ORDER BY n DESC, tag) AS r FROM tags),
packed AS (
  SELECT locality, string_agg(tag || ':' || n, chr(9) ORDER BY r) AS tags
  FROM ranked WHERE r <= 10 GROUP BY locality)
SELECT locality, n_photos, tags FROM top LEFT JOIN packed USING (locality) ORDER BY locality"""

CELLS = """cells AS (
  SELECT l_orderkey AS sample, l_extendedprice AS fsc_a, l_quantity AS ssc_a,
         l_extendedprice / 35000 AS ly6c, l_quantity / 17 AS cd11b, l_discount * 30 AS sca1
  FROM lineitem)"""
POINTS = f"""{CELLS}, points AS (
  SELECT row_number() OVER () AS pid, ly6c, cd11b, sca1 FROM cells
  WHERE fsc_a BETWEEN 1000 AND 90000 AND ssc_a BETWEEN 1 AND 45)"""


def _first(model) -> str:
    values = ", ".join(f"({i}, " + ", ".join(f"{v!r}::DOUBLE" for v in c) + ")" for i, c in model)
    return f"c0 AS (SELECT * FROM (VALUES {values}) t(cluster_id, ly6c, cd11b, sca1))"


FIRST = _first(MODEL)
SEEDED = _first(RANDOM)
SEEDED_MANY = _first(RANDOM_MANY)
VALID = """CASE WHEN l_extendedprice BETWEEN 0 AND 50000 AND l_quantity BETWEEN 0 AND 25
           THEN 1 ELSE 0 END"""
RESEARCHERS = """researchers AS (
  SELECT o_orderkey AS sample, trim(unnest(string_split(o_orderpriority || '; ' || o_orderstatus,
         ';'))) AS researcher FROM orders)"""
PER_RESEARCHER = f"""WITH {RESEARCHERS}, valid AS (
  SELECT l_orderkey AS sample, sum({VALID}) AS n FROM lineitem GROUP BY l_orderkey)
SELECT researcher, CAST(sum(n) AS BIGINT) AS n FROM researchers JOIN valid USING (sample)
GROUP BY researcher"""


def _nearest(points: str, centroids: str) -> str:
    distance = "sqrt((c.ly6c-p.ly6c)*(c.ly6c-p.ly6c) + (c.cd11b-p.cd11b)*(c.cd11b-p.cd11b)" \
               " + (c.sca1-p.sca1)*(c.sca1-p.sca1))"
    return f"""(SELECT p.*, c.cluster_id, {distance} AS dist,
      row_number() OVER (PARTITION BY pid ORDER BY {distance}, c.cluster_id) AS near
      FROM {points} p, {centroids} c)"""


def _rounds(points: str, rounds: int = ROUNDS) -> str:
    steps = [
        f"""c{i} AS MATERIALIZED (SELECT cluster_id, count(*) AS n, avg(ly6c) AS ly6c, avg(cd11b) AS cd11b,
        avg(sca1) AS sca1 FROM {_nearest(points, f"c{i - 1}")} WHERE near = 1
        GROUP BY cluster_id)"""
        for i in range(1, rounds + 1)
    ]
    return ", ".join(steps)


def _model(last: str) -> str:
    means = ", ".join(f"round({m}, 6) AS {m}" for m in ("ly6c", "cd11b", "sca1"))
    return f"SELECT cluster_id, n, {means} FROM {last}"


CLUSTERS = f"WITH {POINTS}, {FIRST}, {_rounds('points')} {_model(f'c{ROUNDS}')}"
TRIMMED = f"""WITH {POINTS}, {FIRST}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY dist, ly6c, cd11b, sca1) AS r,
         count(*) OVER (PARTITION BY cluster_id) AS size
  FROM {_nearest('points', 'c0')} WHERE near = 1),
kept AS MATERIALIZED (SELECT pid, ly6c, cd11b, sca1 FROM ranked WHERE r <= floor(0.9::DOUBLE * size) + 1),
{_rounds('kept')} {_model(f'c{ROUNDS}')}"""

GENRES = """genres AS (
  SELECT p_partkey AS movie_id, unnest([p_type, p_brand]) AS genre FROM part)"""
AVERAGES = f"""WITH {GENRES} SELECT genre, round(avg(l_quantity), 6) AS avg_rating
FROM genres JOIN lineitem ON l_partkey = movie_id GROUP BY genre"""
ILL_USERS = """ill AS (
  SELECT c_custkey AS id, d AS disease
  FROM (SELECT c_custkey, unnest([c_mktsegment, 'NATION_' || c_nationkey]) AS d FROM customer)
  WHERE d IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))"""

GENE = "CAST(round(l_discount * 100) AS INT)"


def _frequent(pairs: str, support: float) -> str:
    """All subsets of all baskets, counted: sets of any size."""
    return f"""pairs AS MATERIALIZED (SELECT DISTINCT {pairs}),
least AS MATERIALIZED (
  SELECT greatest(1, floor({support}::DOUBLE * count(DISTINCT b))) AS t FROM pairs),
own AS MATERIALIZED (SELECT list_sort(list(i)) AS items FROM pairs GROUP BY b),
masks AS (SELECT items, unnest(range(1, CAST(pow(2, len(items)) AS INT))) AS mask FROM own),
sets AS MATERIALIZED (
  SELECT s, count(*) AS n FROM (
    SELECT list_filter(items, lambda x, pos: (mask >> (pos - 1)) & 1 = 1) AS s FROM masks)
  GROUP BY s),
frequent AS MATERIALIZED (SELECT s, n FROM sets, least WHERE n >= t)"""


SETS = _frequent(
    f"""l_orderkey AS b, {GENE} AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity >= 5 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""", 0.01)
PART_SETS = _frequent(
    "l_orderkey AS b, p_type AS i FROM lineitem JOIN part ON l_partkey = p_partkey", 0.001)


def _rules(sets: str, confidence: float, supports: str = "frequent") -> str:
    return f"""WITH {sets}, splits AS MATERIALIZED (
  SELECT s, n, unnest(range(1, CAST(pow(2, len(s)) AS INT) - 1)) AS mask FROM frequent
  WHERE len(s) > 1),
sides AS MATERIALIZED (
  SELECT n, list_filter(s, lambda x, pos: (mask >> (pos - 1)) & 1 = 1) AS a,
         list_filter(s, lambda x, pos: (mask >> (pos - 1)) & 1 = 0) AS c FROM splits),
rules AS (
  SELECT array_to_string(a, ' ') AS antecedent, array_to_string(c, ' ') AS consequent,
         sides.n::DOUBLE / f.n AS confidence FROM sides JOIN {supports} f ON array_to_string(f.s, ' ') = array_to_string(a, ' '))
SELECT antecedent, consequent, round(confidence, 6) AS confidence FROM rules
WHERE confidence >= {confidence}::DOUBLE"""


GENE_RULES = _rules(SETS, CONFIDENCE)
BASKETS = f"""baskets AS (
  SELECT l_orderkey AS patientid, list_sort(list(DISTINCT {GENE})) AS items
  FROM lineitem GROUP BY l_orderkey)"""
COUNTED_SETS = f"""{SETS}, {BASKETS}, found AS MATERIALIZED (
  SELECT s, count(*) AS n FROM frequent JOIN baskets ON list_has_all(items, s) GROUP BY s)"""
MANY = ", ".join(
    f"({i}, {0.1 * i!r}::DOUBLE, {0.07 * i!r}::DOUBLE, {3.0 - 0.1 * i!r}::DOUBLE)"
    for i in range(1, 31)
)

ORACLE: dict[str, str] = {
    "photos_per_locality":
        f"WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS} SELECT * FROM counts",
    "top_localities":
        f"WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS}, {TOP} SELECT * FROM top",
    "locality_tags":
        f"WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {TAGS} SELECT * FROM tags",
    "top_tags_per_locality": TOP_TAGS,
    "measurements_per_researcher": PER_RESEARCHER,
    "cell_clusters": CLUSTERS,
    "cell_clusters_trimmed": TRIMMED,
    "genre_average_rating": AVERAGES,
    "cancers_with_active_gene": f"""WITH {ILL_USERS}
        SELECT disease, count(*) AS n FROM ill JOIN events ON user_id = id
        WHERE event_type = 'click' AND value >= 30 GROUP BY disease""",
    "gene_itemsets": f"""WITH {SETS}
        SELECT n AS support, array_to_string(s, ' ') AS items FROM frequent""",
    "gene_rules": GENE_RULES,
    "scan_photos": """SELECT l_returnflag || ' ' || l_linestatus AS tags,
        strftime(l_shipdate, '%Y-%m-%d') AS date_taken, count(*) AS n
        FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL""",
    "scan_places": f"""WITH {PLACES} SELECT CAST(place_id AS VARCHAR) AS place_id, place_name,
        place_type_id FROM places WHERE place_type_id <> 22""",
    "min_fields": """SELECT p_size AS place_type_id, count(*) AS n FROM part
        WHERE p_size NOT IN (7, 22) GROUP BY p_size""",
    "scan_key_counts":
        f"WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS} SELECT * FROM counts",
    "scan_tag_counts": TOP_TAGS,
    "scan_many": """SELECT n_name AS name, CAST(n_regionkey AS BIGINT) AS n FROM nation
        UNION ALL SELECT r_name, r_regionkey FROM region""",
    "scan_measurements": """SELECT CAST(l_orderkey AS VARCHAR) AS sample,
        CAST(sum(trunc(l_extendedprice)) AS BIGINT) AS fsc_a,
        CAST(sum(l_quantity) AS BIGINT) AS ssc_a FROM lineitem GROUP BY l_orderkey""",
    "scan_cells": """SELECT CAST(l_quantity AS INT) AS ssc_a, round(sum(l_quantity), 6) AS ly6c,
        round(sum(l_tax), 6) AS cd11b, round(sum(l_discount), 6) AS sca1
        FROM lineitem GROUP BY l_quantity""",
    "scan_experiments": """SELECT CAST(o_orderkey AS VARCHAR) AS sample,
        o_orderpriority AS researchers FROM orders WHERE o_orderstatus <> 'F'""",
    "scan_clusters": """SELECT CAST(l_suppkey AS INT) AS cluster_id, count(*) AS n,
        max(l_quantity) AS ly6c, max(l_discount) AS cd11b, max(l_tax) AS sca1
        FROM lineitem GROUP BY l_suppkey""",
    "scan_ratings": """SELECT CAST(l_partkey AS VARCHAR) AS movie_id, sum(l_quantity) AS rating
        FROM lineitem GROUP BY l_partkey""",
    "scan_movies": """SELECT CAST(p_partkey AS VARCHAR) AS movie_id,
        '"' || p_name || ', The"' AS title, p_type || '|' || p_brand AS genres FROM part""",
    "scan_expression": f"""SELECT {GENE} AS geneid, count(*) AS n, sum(l_quantity) AS expression
        FROM lineitem GROUP BY {GENE}""",
    "scan_patients": """SELECT CAST(c_custkey AS VARCHAR) AS id,
        c_mktsegment || ' NATION_' || c_nationkey AS diseases FROM customer""",
    "scan_itemsets": f"""WITH {BASKETS}
        SELECT array_to_string(items, ' ') AS items, count(*) AS support FROM baskets
        GROUP BY items""",
    "write_key_values": f"""WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS}
        SELECT locality || chr(9) || n_photos AS line FROM counts""",
    "write_single_file": f"""SELECT row_number() OVER (ORDER BY n DESC, researcher) AS place,
        researcher || chr(9) || n AS line FROM ({PER_RESEARCHER})""",
    "write_itemsets": f"""WITH {SETS}
        SELECT n || chr(9) || array_to_string(s, chr(9)) AS line FROM frequent""",
    "write_rules": f"""SELECT antecedent || ' ' || chr(9) || consequent || ' ' AS rule, confidence
        FROM ({GENE_RULES})""",
    "write_csv": AVERAGES,
    "job_output": f"""WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS}
        SELECT locality || chr(9) || n_photos AS line FROM counts""",
    "job_preview": f"""WITH {PLACES}, {LOCALITIES}, {PHOTOS}, {COUNTS}
        SELECT CAST(row_number() OVER (ORDER BY n_photos DESC, locality) AS INTEGER) AS place,
               locality || chr(9) || n_photos AS line
        FROM counts ORDER BY place LIMIT 100""",
    "locality_name": f"WITH {PLACES}, {LOCALITIES} SELECT * FROM localities",
    "flag_in_range": f"""SELECT l_orderkey AS sample, CAST(sum({VALID}) AS BIGINT) AS n
        FROM lineitem GROUP BY l_orderkey""",
    "where_in_range": """SELECT l_orderkey AS sample, count(*) AS n FROM lineitem
        WHERE l_extendedprice BETWEEN 1000 AND 90000 AND l_quantity BETWEEN 1 AND 45
        GROUP BY l_orderkey""",
    "where_at_least": f"""SELECT l_orderkey AS patientid, count(*) AS n FROM lineitem
        WHERE {GENE} = 4 AND l_quantity >= 25 GROUP BY l_orderkey""",
    "where_member": f"WITH {ILL_USERS} SELECT * FROM ill",
    "explode_list": f"""WITH {RESEARCHERS}
        SELECT researcher, count(*) AS n FROM researchers GROUP BY researcher""",
    "strip_year": f"""WITH {PHOTOS} SELECT place_id, replace(tags, y, '') AS tags, count(*) AS n
        FROM photos GROUP BY ALL""",
    "drop_self_tags": """WITH tokens AS (
        SELECT c_mktsegment AS locality,
               unnest(string_split(o_orderpriority || ' ' || o_orderstatus, ' ')) AS tag
        FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT locality, tag, count(*) AS n FROM tokens
        WHERE NOT contains(lower(locality), lower(tag)) GROUP BY ALL""",
    "feature_vector": f"""WITH {CELLS} SELECT round(avg(ly6c), 6) AS x, round(avg(cd11b), 6) AS y,
        round(avg(sca1), 6) AS z FROM cells""",
    "count_by_lookup": """SELECT c_mktsegment, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "sum_by_partner": """SELECT o_orderpriority || '; ' || o_orderstatus AS team, count(*) AS n
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY team""",
    "count_distinct": "SELECT count(DISTINCT l_orderkey) AS n FROM lineitem",
    "distinct_items": f"SELECT DISTINCT {GENE} AS geneid FROM lineitem",
    "to_baskets": f"""WITH {BASKETS}
        SELECT patientid, array_to_string(items, ' ') AS items FROM baskets""",
    "min_support": f"""WITH pairs AS (SELECT DISTINCT l_orderkey AS b, {GENE} AS geneid FROM lineitem)
        SELECT geneid, count(*) AS n FROM pairs GROUP BY geneid
        HAVING count(*) >= floor(0.3::DOUBLE * (SELECT count(DISTINCT b) FROM pairs))""",
    "most_rated_titles": """SELECT p_name AS title, count(*) AS rating_count,
        p_name || ':' || count(*) AS label
        FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_name""",
    "top_n_per_group": """SELECT l_linestatus, l_suppkey, count(*) AS n,
        CAST(row_number() OVER (PARTITION BY l_linestatus ORDER BY count(*) DESC, l_suppkey) AS INT)
        AS rank FROM lineitem GROUP BY l_linestatus, l_suppkey QUALIFY rank <= 10""",
    "first_rows": """SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "kept_per_group": """WITH sizes AS (
        SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
        SELECT n, count(*) AS samples,
        CAST(least(n, floor(0.9::DOUBLE * n) + 1) AS BIGINT) AS kept FROM sizes GROUP BY n""",
    "trim_group_tail": """WITH ranked AS (
        SELECT l_returnflag AS flag, l_quantity, l_discount, l_tax,
               row_number() OVER (PARTITION BY l_returnflag
                                  ORDER BY l_quantity, l_discount, l_tax) AS r,
               count(*) OVER (PARTITION BY l_returnflag) AS size FROM lineitem)
        SELECT flag, l_quantity, l_discount, l_tax, count(*) AS copies FROM ranked
        WHERE r <= floor(0.7::DOUBLE * size) + 1 GROUP BY ALL""",
    "assign_nearest": f"""WITH {POINTS}, {FIRST} SELECT cluster_id, count(*) AS n,
        round(avg(dist), 6) AS dist, round(max(dist), 6) AS farthest
        FROM {_nearest('points', 'c0')} WHERE near = 1 GROUP BY cluster_id""",
    "assign_nearest_of_many": f"""WITH {CELLS},
        points AS (SELECT row_number() OVER () AS pid, ly6c, cd11b, sca1 FROM cells),
        many AS (SELECT * FROM (VALUES {MANY}) t(cluster_id, ly6c, cd11b, sca1))
        SELECT cluster_id, count(*) AS n FROM {_nearest('points', 'many')} WHERE near = 1
        GROUP BY cluster_id""",
    "centres": f"""WITH {POINTS}, {FIRST} SELECT cluster_id, count(*) AS n,
        round(avg(ly6c), 6) AS ly6c, round(avg(cd11b), 6) AS cd11b, round(avg(sca1), 6) AS sca1
        FROM {_nearest('points', 'c0')} WHERE near = 1 GROUP BY cluster_id""",
    "random_clusters": f"WITH {POINTS}, {SEEDED}, {_rounds('points', 3)} {_model('c3')}",
    "many_clusters": f"""SELECT cluster_id, n, round(ly6c, 4) AS ly6c, round(cd11b, 4) AS cd11b, round(sca1, 4) AS sca1
        FROM (WITH {POINTS}, {SEEDED_MANY}, {_rounds('points', 4)} {_model('c4')})""",
    "frequent_pairs": """WITH orders_of AS (SELECT DISTINCT l_orderkey AS b, l_suppkey AS i FROM lineitem),
        least AS (SELECT greatest(1, CAST(floor(0.0002 * count(DISTINCT b)) AS BIGINT)) AS n FROM orders_of),
        singles AS (SELECT i FROM orders_of GROUP BY i HAVING count(*) >= (SELECT n FROM least))
        SELECT p.i || ' ' || q.i AS items, count(*) AS support
        FROM orders_of p JOIN orders_of q ON p.b = q.b AND p.i < q.i
        WHERE p.i IN (FROM singles) AND q.i IN (FROM singles)
        GROUP BY p.i, q.i HAVING count(*) >= (SELECT n FROM least)""",
    "basket_fragments": """SELECT o_custkey, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n, true AS filled,
        true AS numbered FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""",
    "frequent_itemsets": f"""WITH {PART_SETS}
        SELECT array_to_string(s, ' ') AS items, n AS support FROM frequent""",
    "count_sets": f"""WITH {COUNTED_SETS}
        SELECT array_to_string(s, ' ') AS items, n AS support FROM found""",
    "recounted_rules": _rules(COUNTED_SETS, CONFIDENCE, "found"),
    "proper_subsets": f"""WITH {SETS}, splits AS (
        SELECT s AS items, unnest(range(1, CAST(pow(2, len(s)) AS INT) - 1)) AS mask FROM frequent
        WHERE len(s) > 1)
        SELECT array_to_string(list_filter(items, lambda x, pos: (mask >> (pos - 1)) & 1 = 1), ' ')
        AS items, count(*) AS n FROM splits GROUP BY ALL""",
    "association_rules": _rules(PART_SETS, 0.0),
}
