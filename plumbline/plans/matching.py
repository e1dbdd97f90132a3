"""Queries: key repair, text joins, geocode."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import geocode as geo
from plumbline.operators import match
from plumbline.operators.scale import share

from .base import CODE_SQL, customer_code, query, table

FIRST_DAY = "1996-01-01"


def registry(spark, sf):
    """Per three-letter code its customer, state and first order day."""
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    dated = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("first_day"))
    rows = customers.join(dated, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("code", customer_code())
    return rows.groupBy("code").agg(F.min("c_mktsegment").alias("customer"), F.min("n_name").alias("state"), F.min("first_day").alias("released"))


def damaged(spark, sf):
    """Orders whose code is whole, cut, missing, too long or not a code, by priority; customers are
    spelled differently by status."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("code", customer_code())
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    raw = (
        F.when(pr == "1-URGENT", F.col("code")).when((pr == "2-HIGH") & (st == "P"), F.lower(F.substring("code", 1, 2)))
        .when(pr == "2-HIGH", F.substring("code", 1, 2)).when(pr == "4-NOT SPECIFIED", F.concat("code", F.lit("Z")))
        .when(pr == "5-LOW", F.concat(F.substring("code", 1, 2), F.lit("9")))
    )
    customer = F.when(st == "F", F.concat("c_mktsegment", F.lit(" Co"))).when(st == "O", F.col("c_mktsegment"))
    day = F.when(~((pr == "3-MEDIUM") & (st == "F") & (F.col("c_mktsegment") == "MACHINERY")), F.col("o_orderdate").cast("date"))
    return rows.select("o_orderkey", raw.alias("raw_code"), customer.alias("customer"), F.col("n_name").alias("state"), day.alias("ship_day"))


def repaired(spark, sf):
    return match.repair_keys(damaged(spark, sf), registry(spark, sf), first_day=FIRST_DAY, manual=["BV", "CB"])


REPAIR_SQL = f"""reg AS (SELECT {CODE_SQL} AS code, min(c_mktsegment) AS customer, min(n_name) AS state, min(CAST(fd AS DATE)) AS released
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS fd FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1),
o AS (SELECT *, {CODE_SQL} AS code FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
rws AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN code WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN lower(substr(code, 1, 2))
    WHEN o_orderpriority = '2-HIGH' THEN substr(code, 1, 2) WHEN o_orderpriority = '4-NOT SPECIFIED' THEN code || 'Z' WHEN o_orderpriority = '5-LOW' THEN substr(code, 1, 2) || '9' END AS raw_code,
  CASE o_orderstatus WHEN 'F' THEN c_mktsegment || ' Co' WHEN 'O' THEN c_mktsegment END AS customer, n_name AS state,
  CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' AND c_mktsegment = 'MACHINERY') THEN CAST(o_orderdate AS DATE) END AS ship_day FROM o),
a0 AS (SELECT DISTINCT raw_code, customer, state, ship_day, coalesce(raw_code, '') AS raw, upper(coalesce(raw_code, '')) AS u FROM rws),
a AS (SELECT *, CASE WHEN u IN (SELECT code FROM reg) THEN 'ok' WHEN ship_day < DATE '{FIRST_DAY}' THEN 'early' WHEN raw = '' THEN 'null' WHEN u IN ('BV', 'CB') THEN 'manual'
    WHEN length(u) > 3 AND substr(u, 1, 3) IN (SELECT code FROM reg) THEN 'long' ELSE 'prefix' END AS branch FROM a0),
cand AS (SELECT a.*, reg.code, CASE WHEN branch = 'prefix' AND raw = substr(u, 1, 2) THEN 1 ELSE 0 END AS p,
    CASE WHEN contains(lower(a.customer), lower(reg.customer)) OR contains(lower(reg.customer), lower(a.customer)) THEN 1 ELSE 0 END AS c,
    CASE WHEN a.state = reg.state THEN 1 ELSE 0 END AS s, CASE WHEN abs(date_diff('day', a.ship_day, reg.released)) <= 180 THEN 1 ELSE 0 END AS d
  FROM a JOIN reg ON (branch = 'prefix' AND starts_with(reg.code, substr(u, 1, 2))) OR (branch = 'null' AND (a.state = reg.state OR contains(lower(a.customer), lower(reg.customer)) OR contains(lower(reg.customer), lower(a.customer))))),
ranked AS (SELECT *, p + c + s + d AS score, max(p + c + s + d) OVER w AS top, count(*) OVER w AS pool FROM cand WINDOW w AS (PARTITION BY raw_code, customer, state, ship_day)),
tops AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY raw_code, customer, state, ship_day) AS tied FROM ranked WHERE score = top WINDOW w AS (PARTITION BY raw_code, customer, state, ship_day ORDER BY code)),
best AS (SELECT raw_code, customer, state, ship_day, any_value(score) AS score, any_value(pool) AS pool, any_value(tied) AS tied, min(code) AS code,
    string_agg(code, ', ' ORDER BY code) FILTER (rn <= 5) AS five,
    arg_min(concat_ws('+', CASE WHEN p = 1 THEN 'Prefix' END, CASE WHEN c = 1 THEN 'Customer' END, CASE WHEN s = 1 THEN 'State' END, CASE WHEN d = 1 THEN 'Date' END), code) AS method FROM tops GROUP BY 1, 2, 3, 4),
j AS (SELECT a.*, score, pool, tied, code, method,
    CASE WHEN tied > 1 THEN 'Tied ' || tied || ' candidates at score ' || score || ': ' || five || CASE WHEN tied > 5 THEN ' (+' || (tied - 5) || ' more)' ELSE '' END
         WHEN branch = 'prefix' AND pool = 1 THEN 'Single prefix match -> ' || code ELSE 'Best of ' || pool || ' candidates (score ' || score || ')' END AS note
  FROM a LEFT JOIN best b ON a.raw_code IS NOT DISTINCT FROM b.raw_code AND a.customer IS NOT DISTINCT FROM b.customer AND a.state IS NOT DISTINCT FROM b.state AND a.ship_day IS NOT DISTINCT FROM b.ship_day),
v AS (SELECT raw_code, customer, state, ship_day,
    CASE branch WHEN 'ok' THEN u WHEN 'long' THEN substr(u, 1, 3) WHEN 'null' THEN CASE WHEN score >= 2 THEN code ELSE '' END WHEN 'prefix' THEN CASE WHEN score >= 1 THEN code ELSE '' END ELSE '' END AS fixed_code,
    CASE branch WHEN 'ok' THEN 'OK' WHEN 'early' THEN 'PRE-2016' WHEN 'manual' THEN 'NEEDS_REVIEW' WHEN 'long' THEN 'REPAIRED' WHEN 'null' THEN CASE WHEN score >= 2 THEN 'ATTRIBUTED' ELSE 'UNRESOLVABLE' END
      ELSE CASE WHEN score >= 1 THEN 'REPAIRED' ELSE 'UNRESOLVABLE' END END AS repair_status,
    CASE branch WHEN 'manual' THEN 'Manual' WHEN 'long' THEN 'High' WHEN 'null' THEN CASE WHEN score >= 3 THEN 'High' WHEN score = 2 THEN 'Medium' ELSE 'n/a' END
      WHEN 'prefix' THEN CASE WHEN score >= 3 THEN 'High' WHEN score = 2 THEN 'Medium' WHEN score = 1 THEN 'Low' ELSE 'n/a' END ELSE 'n/a' END AS repair_confidence,
    CASE branch WHEN 'manual' THEN 'Prefix' WHEN 'long' THEN 'Truncated(exact prefix)' WHEN 'null' THEN coalesce(method, '') WHEN 'prefix' THEN coalesce(method, '') ELSE '' END AS repair_method,
    CASE branch WHEN 'early' THEN CASE WHEN raw = '' THEN 'Shipped ' || ship_day || ' predates the code system' ELSE 'Partial code ''' || raw || ''' on ' || ship_day || ' predates the code system' END
      WHEN 'long' THEN '''' || raw || ''' -> ''' || substr(u, 1, 3) || '''. Starts with valid code ''' || substr(u, 1, 3) || ''''
      WHEN 'manual' THEN '''' || raw || ''' flagged for manual review. Candidates: ' || coalesce((SELECT string_agg(code, ', ' ORDER BY code) FROM reg WHERE starts_with(reg.code, u)), 'none found')
      WHEN 'null' THEN CASE WHEN score >= 2 AND ship_day IS NULL THEN '[No ship date] ' || note WHEN score IS NULL THEN 'No customer or state match found in registry' ELSE note END
      WHEN 'prefix' THEN CASE WHEN score >= 2 THEN '''' || raw || ''' -> ''' || code || '''. ' || note WHEN score = 1 THEN '''' || raw || ''' -> ''' || code || ''' (low confidence). ' || note
        WHEN score IS NULL THEN '''' || raw || ''' not fixable. No registry code starts with ''' || raw || '''' ELSE '''' || raw || ''' not fixable. All candidates scored 0 (tried ' || pool || ' codes)' END
      ELSE '' END AS repair_notes FROM j),
fixed AS (SELECT rws.*, v.fixed_code, v.repair_status, v.repair_confidence, v.repair_method, v.repair_notes FROM rws JOIN v ON rws.raw_code IS NOT DISTINCT FROM v.raw_code AND rws.customer IS NOT DISTINCT FROM v.customer
  AND rws.state IS NOT DISTINCT FROM v.state AND rws.ship_day IS NOT DISTINCT FROM v.ship_day)"""


@query("r14_key_repair", f"WITH {REPAIR_SQL} SELECT o_orderkey, raw_code, fixed_code, repair_status, repair_confidence, repair_method, repair_notes FROM fixed")
def _(spark, sf):
    """J11-J14, N39, R12-R14, W11, C26, U08."""
    return repaired(spark, sf).select("o_orderkey", "raw_code", "fixed_code", "repair_status", "repair_confidence", "repair_method", "repair_notes")


@query("f09_rejected_rows", f"WITH {REPAIR_SQL} SELECT o_orderkey, raw_code, fixed_code, repair_status, repair_confidence, repair_method, repair_notes FROM fixed WHERE repair_status <> 'OK'")
def _(spark, sf):
    return match.rejected_rows(repaired(spark, sf), "o_orderkey", ["raw_code"])


@query("a27_repair_breakdown", f"WITH {REPAIR_SQL} SELECT repair_status, repair_confidence, count(*) AS rows, round(count(*) / (SELECT count(*) FROM fixed), 4) AS share FROM fixed GROUP BY 1, 2")
def _(spark, sf):
    return match.repair_breakdown(repaired(spark, sf), ["repair_status", "repair_confidence"])


NAME_SQL = "l AS (SELECT DISTINCT c_mktsegment || ' ' || n_name AS left_name FROM customer JOIN nation ON c_nationkey = n_nationkey), r AS (SELECT DISTINCT lower(n_name) AS right_name FROM nation UNION SELECT DISTINCT c_mktsegment || ' ' FROM customer)"


@query("j12_name_pairs", f"WITH {NAME_SQL} SELECT left_name, right_name FROM l JOIN r ON contains(lower(left_name), lower(right_name)) OR contains(lower(right_name), lower(left_name))")
def _(spark, sf):
    named = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    left = named.select(F.concat_ws(" ", "c_mktsegment", "n_name").alias("left_name"))
    right = table(spark, sf, "nation").select(F.lower("n_name").alias("right_name")).union(named.select(F.concat("c_mktsegment", F.lit(" "))))
    return match.names_either_way(left, right)



def _misspelt(spark, sf):
    parts = table(spark, sf, "part")
    words = parts.select("p_brand", F.concat(F.substring("p_name", 1, 2), F.expr("substring(p_name, 4)")).alias("left_text")).distinct()
    return words, parts.select("p_brand", F.col("p_name").alias("right_text")).distinct()


@query("j16_fuzzy_lev", """WITH w AS (SELECT DISTINCT p_brand, substr(p_name, 1, 2) || substr(p_name, 4) AS left_text FROM part), d AS (SELECT DISTINCT p_brand, p_name FROM part),
s AS (SELECT w.p_brand, left_text, p_name, levenshtein(left_text, p_name) AS dist FROM w JOIN d ON w.p_brand = d.p_brand)
SELECT p_brand, left_text, arg_min(p_name, (dist, p_name)) AS match, CAST(min(dist) AS INT) AS distance FROM s WHERE dist <= 2 GROUP BY 1, 2""")
def _(spark, sf):
    """J16 by edit distance: names with a letter missing against the names of the same brand."""
    words, names = _misspelt(spark, sf)
    return match.closest_by_edits(words, names, ["p_brand"], 2)


@query("j16_fuzzy_ratio", """SELECT p_brand, substr(p_name, 1, 2) || substr(p_name, 4) AS left_text, max(p_name) AS match, round(2.0 * (length(p_name) - 1) / (2 * length(p_name) - 1), 6) AS ratio
FROM part GROUP BY 1, 2, 4""")
def _(spark, sf):
    """J16 by matching blocks. With one letter left out the measure is known; tests compare other texts with brute force."""
    words, names = _misspelt(spark, sf)
    return match.closest_text(words, names, ["p_brand"]).withColumn("ratio", F.round("ratio", 6))


# ---------------------------------------------------------------- geocode

def gazetteer(spark, sf):
    """Suppliers as gazetteer rows: zips repeat, and some cities lie in two states."""
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    state = F.when(F.col("s_acctbal") > 8000, (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
    return rows.select(
        F.col("s_suppkey").alias("row_no"), F.lpad((F.col("s_suppkey") % 60).cast("string"), 5, "0").alias("zip"), F.col("n_name").alias("city"),
        F.concat(F.lit("R"), state).alias("state"), F.concat(F.col("n_name"), F.lit(" COUNTY")).alias("county"),
        (20 + (F.col("s_suppkey") % 97) / 4).alias("lat"), (-60 - (F.col("s_suppkey") % 89) / 4).alias("lng"))


def centroids(spark, sf):
    return table(spark, sf, "region").select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("state"), (F.col("r_regionkey") * 10 + 0.5).alias("lat"), (-100.0 - F.col("r_regionkey")).alias("lng"))


def places(spark, sf):
    """Customers' places: misspelt cities, missing cities and states, wrong states, some zips."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    city = F.when(seg == "MACHINERY", F.concat(F.substring("n_name", 1, 2), F.expr("substring(n_name, 4)"))).when(seg != "FURNITURE", F.col("n_name"))
    state = F.when(bal < 1000, F.concat(F.lit("R"), (F.col("n_regionkey") + 1) % 5)).when(bal <= 9000, F.concat(F.lit("R"), F.col("n_regionkey")))
    zip_ = F.when((bal >= 500) & (bal < 2000), F.lpad((F.col("c_custkey") % 80).cast("string"), 5, "0"))
    return rows.select("c_custkey", city.alias("city"), state.alias("state"), zip_.alias("zip"))


def placed(spark, sf):
    return geo.geocode(places(spark, sf), gazetteer(spark, sf), centroids(spark, sf))


GAZ_SQL = """gaz AS (SELECT s_suppkey AS row_no, lpad(CAST(s_suppkey % 60 AS VARCHAR), 5, '0') AS zip, n_name AS city, 'R' || CASE WHEN s_acctbal > 8000 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END AS state,
    n_name || ' COUNTY' AS county, 20 + (s_suppkey % 97) / 4 AS lat, -60 - (s_suppkey % 89) / 4 AS lng FROM supplier JOIN nation ON s_nationkey = n_nationkey),
zp AS (SELECT * FROM gaz QUALIFY row_number() OVER (PARTITION BY zip ORDER BY row_no DESC) = 1),
cp AS (SELECT city, state, avg(lat) AS lat, avg(lng) AS lng FROM gaz GROUP BY 1, 2),
cs AS (SELECT city, list_sort(list(DISTINCT state)) AS valid_states FROM gaz GROUP BY 1),
cen AS (SELECT 'R' || r_regionkey AS state, r_regionkey * 10 + 0.5 AS lat, -100.0 - r_regionkey AS lng FROM region)"""
PLACE_SQL = GAZ_SQL + """, p AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN substr(n_name, 1, 2) || substr(n_name, 4) WHEN c_mktsegment <> 'FURNITURE' THEN n_name END AS city,
    CASE WHEN c_acctbal < 1000 THEN 'R' || (n_regionkey + 1) % 5 WHEN c_acctbal <= 9000 THEN 'R' || n_regionkey END AS state,
    CASE WHEN c_acctbal >= 500 AND c_acctbal < 2000 THEN lpad(CAST(c_custkey % 80 AS VARCHAR), 5, '0') END AS zip FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT DISTINCT city, state, zip FROM p),
j AS (SELECT t.*, cs.valid_states, zp.state AS zip_state FROM t LEFT JOIN cs ON t.city = cs.city LEFT JOIN zp ON t.zip = zp.zip),
k AS (SELECT *, coalesce(state IS NOT NULL AND len(valid_states) > 0 AND NOT list_contains(valid_states, state), false) AS sus FROM j),
m AS (SELECT *, sus AND len(valid_states) = 1 AND zip_state IS DISTINCT FROM state AS corrected, CASE WHEN sus AND len(valid_states) = 1 AND zip_state IS DISTINCT FROM state THEN valid_states[1] ELSE state END AS placed_state FROM k),
q AS (SELECT DISTINCT m.city, m.placed_state AS state FROM m LEFT JOIN zp ON m.zip = zp.zip LEFT JOIN cp ON m.city = cp.city AND m.placed_state = cp.state WHERE m.city IS NOT NULL AND m.placed_state IS NOT NULL AND zp.zip IS NULL AND cp.city IS NULL),
h AS (SELECT q.city, q.state, cp.city AS name, cp.lat, cp.lng, string_split(q.city, '_')[2] AS d, string_split(cp.city, '_')[2] AS e FROM q JOIN cp ON q.state = cp.state),
near AS (SELECT *, 2.0 * (CASE WHEN starts_with(city, 'NAT') THEN 7 ELSE 6 END + CASE WHEN d = e THEN length(d) WHEN contains(e, d[1]) OR contains(e, d[2]) AND length(d) = 2 THEN 1 ELSE 0 END) / (length(city) + length(name)) AS ratio FROM h),
nr AS (SELECT city, state, arg_max(lat, (ratio, name)) AS lat, arg_max(lng, (ratio, name)) AS lng FROM near WHERE ratio >= 0.85 GROUP BY 1, 2),
g AS (SELECT m.city, m.state, m.zip, m.placed_state, round(coalesce(zp.lat, cp.lat, nr.lat, cen.lat), 4) AS lat, round(coalesce(zp.lng, cp.lng, nr.lng, cen.lng), 4) AS lng,
    CASE WHEN sus AND NOT corrected THEN 3 WHEN zp.lat IS NOT NULL THEN 0 WHEN cp.lat IS NOT NULL OR nr.lat IS NOT NULL THEN 1 WHEN cen.lat IS NOT NULL THEN 2 END AS prec, sus AS suspect, corrected, valid_states
  FROM m LEFT JOIN zp ON m.zip = zp.zip LEFT JOIN cp ON m.city = cp.city AND m.placed_state = cp.state LEFT JOIN nr ON m.city = nr.city AND m.placed_state = nr.state LEFT JOIN cen ON m.placed_state = cen.state),
pl AS (SELECT p.c_custkey, g.* FROM p JOIN g ON p.city IS NOT DISTINCT FROM g.city AND p.state IS NOT DISTINCT FROM g.state AND p.zip IS NOT DISTINCT FROM g.zip)"""


@query("j15_geocode_cascade", f"WITH {PLACE_SQL} SELECT city, state, zip, placed_state, lat, lng, prec, suspect, corrected FROM g")
def _(spark, sf):
    """J15, J17, J18."""
    return placed(spark, sf).select("city", "state", "zip", "placed_state", "lat", "lng", "prec", "suspect", "corrected")


@query("x02_place_keys", f"WITH {PLACE_SQL} SELECT c_custkey, prec, CASE WHEN lat IS NULL THEN '' ELSE printf('%.4f,%.4f', lat, lng) END AS loc_key FROM pl")
def _(spark, sf):
    return geo.place_rows(places(spark, sf), placed(spark, sf)).select("c_custkey", "prec", "loc_key")


@query("a22_precision_counts", f"WITH {PLACE_SQL} SELECT coalesce(CAST(prec AS VARCHAR), 'unmapped') AS prec, count(*) AS rows FROM pl GROUP BY 1")
def _(spark, sf):
    return geo.precision_counts(geo.place_rows(places(spark, sf), placed(spark, sf)))


@query("i03_geo_anomalies", f"WITH {PLACE_SQL} SELECT c_custkey, city, state, array_to_string(valid_states, '|') AS valid_states FROM pl WHERE suspect AND NOT corrected")
def _(spark, sf):
    return geo.anomalies(geo.place_rows(places(spark, sf), placed(spark, sf)), ["c_custkey", "city", "state"])


@query("j17_suspect_rows", f"WITH {PLACE_SQL} SELECT c_custkey, p.city, p.state, zip, array_to_string(valid_states, '|') AS valid_states FROM p JOIN cs ON p.city = cs.city WHERE p.state IS NOT NULL AND NOT list_contains(cs.valid_states, p.state)")
def _(spark, sf):
    """J17, I02."""
    return geo.suspect_rows(places(spark, sf), gazetteer(spark, sf), "city", "state")


for _keep, _dir in (("first", "ASC"), ("last", "DESC")):
    def _zip(spark, sf, keep=_keep):
        return geo.zip_points(gazetteer(spark, sf), keep).select("zip", "city", "state", "lat", "lng")

    query(f"w12_zip_{_keep}", f"WITH {GAZ_SQL} SELECT zip, city, state, lat, lng FROM gaz QUALIFY row_number() OVER (PARTITION BY zip ORDER BY row_no {_dir}) = 1")(_zip)


@query("a21_city_centroids", f"WITH {GAZ_SQL} SELECT cp.city, state, round(lat, 4) AS lat, round(lng, 4) AS lng, array_to_string(valid_states, '|') AS valid_states FROM cp JOIN cs ON cp.city = cs.city")
def _(spark, sf):
    points = geo.city_points(gazetteer(spark, sf)).join(geo.city_states(gazetteer(spark, sf)), "city")
    return points.select("city", "state", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"), F.array_join("valid_states", "|").alias("valid_states"))


_ENRICH_SQL = """r AS (SELECT o_orderkey, o_custkey AS k, CASE o_orderstatus WHEN 'F' THEN 'X' END AS state, CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' END AS city FROM orders),
d AS (SELECT c_custkey AS k, n_name AS city, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS state FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _enriched(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderstatus") == "F", F.lit("X")).alias("state"), F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Y")).alias("city"))
    records = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("k"), F.col("n_name").alias("city"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("state"))
    return geo.enrich(rows, records, "k", ["state", "city"])


@query("j02_enrich", f"WITH {_ENRICH_SQL} SELECT o_orderkey, coalesce(r.state, d.state) AS state, coalesce(r.city, d.city) AS city FROM r LEFT JOIN d ON r.k = d.k")
def _(spark, sf):
    return _enriched(spark, sf).select("o_orderkey", "state", "city")


@query("j02_fill_counts", f"WITH {_ENRICH_SQL} SELECT count(CASE WHEN r.state IS NULL AND d.state IS NOT NULL THEN 1 END) AS state, count(CASE WHEN r.city IS NULL AND d.city IS NOT NULL THEN 1 END) AS city FROM r LEFT JOIN d ON r.k = d.k")
def _(spark, sf):
    return geo.fill_counts(_enriched(spark, sf), ["state", "city"])
