"""Queries: pieces ledger, reconciliation, class reports, registry aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.clean import barrel_diameter, code_to_int, lookup, quantity
from plumbline.operators import ledger, report
from plumbline.operators import registry as reg
from plumbline.operators.scale import dense_index
from plumbline.session import reliable_checkpoint

from .base import CODE_SQL, FLAG_SYSTEM, case, customer_code, query, table

KEYS = ["l_suppkey", "p_brand", "year"]
YEARS = (1997, 1999)
TYPE_CLASS = {"ECONOMY": "base", "SMALL": "rehab", "LARGE": "non-base", "STANDARD": "non-base", "PROMO": "base"}


def lines_with_parts(spark, sf):
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumns({
        "year": F.year("l_shipdate"), "system": lookup(FLAG_SYSTEM, F.col("l_returnflag"))})


def systems(spark, sf):
    rows = lines_with_parts(spark, sf).withColumn("first_line", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))
    return ledger.system_quantities(rows, KEYS, "system", quantity("l_quantity"), ["p_type", "p_size"], "first_line")


def groups(spark, sf):
    return ledger.dedup_systems(systems(spark, sf), KEYS, "system")


SYSTEMS_SQL = f"""sys AS (SELECT l_suppkey, p_brand, CAST(year(l_shipdate) AS INT) AS year, {case('l_returnflag', FLAG_SYSTEM)} AS system,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, arg_min(p_type, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS p_type,
  min((l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS fr
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE CAST(l_quantity AS BIGINT) <> 0 GROUP BY 1, 2, 3, 4)"""
GROUPS_SQL = SYSTEMS_SQL + """, grp AS (SELECT l_suppkey, p_brand, year, max(qty) AS n_pieces, string_agg(system, '+' ORDER BY system) AS source,
  CAST(sum(qty) AS BIGINT) AS raw_pieces, arg_min(p_type, fr) AS p_type FROM sys GROUP BY 1, 2, 3)"""


@query("a05_system_quantities", f"WITH {SYSTEMS_SQL} SELECT l_suppkey, p_brand, year, system, qty, p_type FROM sys")
def _(spark, sf):
    """A05, A35."""
    return systems(spark, sf).select(*KEYS, "system", "qty", F.col("meta.p_type").alias("p_type"))


@query("a06_cross_system_dedup", f"WITH {GROUPS_SQL} SELECT * FROM grp")
def _(spark, sf):
    return groups(spark, sf).select(*KEYS, "n_pieces", "source", "raw_pieces", F.col("meta.p_type").alias("p_type"))


@query("a07_piece_explode", f"WITH {GROUPS_SQL} SELECT l_suppkey, p_brand, year, n_pieces AS pieces, n_pieces - 1 AS last_seq, 'erp:' || l_suppkey || ':' || p_brand || ':' || year || ':0' AS first_id FROM grp")
def _(spark, sf):
    """Every piece is a row with an id of its own, counted back per key."""
    pieces = ledger.explode_pieces(groups(spark, sf), "n_pieces", KEYS)
    return pieces.groupBy(*KEYS).agg(F.count("*").alias("pieces"), F.max("seq").alias("last_seq"), F.max(F.when(F.col("seq") == 0, F.col("piece_id"))).alias("first_id"))


@query("q01_duplicate_ids", "SELECT l_orderkey || ':' || l_linenumber AS piece_id, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("piece_id"))
    return ledger.duplicates(ids, "piece_id")


# ---------------------------------------------------------------- overlap of two systems

def side(spark, sf, status):
    return table(spark, sf, "lineitem").where(F.col("l_linestatus") == status).select(
        F.lit("dispatch" if status == "O" else "erp").alias("source"), F.col("l_orderkey").alias("job_code"), F.year("l_shipdate").alias("year"), "l_partkey")


_SIDE = "SELECT CASE l_linestatus WHEN 'O' THEN 'dispatch' ELSE 'erp' END AS source, l_orderkey AS job_code, CAST(year(l_shipdate) AS INT) AS year, l_partkey FROM lineitem"
SIDES_SQL = f"s AS ({_SIDE}), d AS (SELECT * FROM s WHERE source = 'dispatch'), e AS (SELECT * FROM s WHERE source = 'erp')"
for _policy, _sql in {
    "erp": "SELECT * FROM e",
    "dispatch": f"SELECT * FROM d UNION ALL SELECT * FROM e WHERE year NOT BETWEEN {YEARS[0]} AND {YEARS[1]}",
    "union": "SELECT * FROM e UNION ALL SELECT * FROM d WHERE job_code NOT IN (SELECT job_code FROM e)",
}.items():
    def _run(spark, sf, policy=_policy):
        return ledger.apply_overlap(side(spark, sf, "F"), side(spark, sf, "O"), policy, years=YEARS)

    query(f"u03_overlap_{_policy}", f"WITH {SIDES_SQL} {_sql}")(_run)


@query("a10_reconcile_year", f"""WITH {SIDES_SQL}, j AS (SELECT year, job_code, count(CASE WHEN source = 'dispatch' THEN 1 END) AS d, count(CASE WHEN source = 'erp' THEN 1 END) AS e
  FROM s WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY 1, 2)
SELECT CAST(year AS VARCHAR) AS year, CAST(sum(d) AS BIGINT) AS dispatch_pieces, CAST(sum(e) AS BIGINT) AS erp_pieces, CAST(sum(d) - sum(e) AS BIGINT) AS diff,
  count(CASE WHEN d > 0 AND e = 0 THEN 1 END) AS jobs_dispatch_only, count(CASE WHEN d = 0 AND e > 0 THEN 1 END) AS jobs_erp_only, count(CASE WHEN d > 0 AND e > 0 THEN 1 END) AS jobs_both FROM j GROUP BY 1
UNION ALL SELECT 'TOTAL', CAST(sum(d) AS BIGINT), CAST(sum(e) AS BIGINT), CAST(sum(d) - sum(e) AS BIGINT), NULL, NULL, NULL FROM j""")
def _(spark, sf):
    return ledger.reconcile_by_year(side(spark, sf, "O"), side(spark, sf, "F"), YEARS)


@query("a11_reconcile_key", f"""WITH {SIDES_SQL}, j AS (SELECT job_code, count(CASE WHEN source = 'dispatch' THEN 1 END) AS d, count(CASE WHEN source = 'erp' THEN 1 END) AS e
  FROM s WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY 1)
SELECT job_code, d AS dispatch_pieces, e AS erp_pieces, d - e AS diff, CASE WHEN d > 0 AND e > 0 THEN 'both' WHEN d > 0 THEN 'dispatch_only' ELSE 'erp_only' END AS present_in FROM j""")
def _(spark, sf):
    return ledger.reconcile_by_job(side(spark, sf, "O"), side(spark, sf, "F"), YEARS)


@query("j06_only_in_one_source", """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS job_code FROM orders)
SELECT o_orderkey, job_code FROM o WHERE job_code IS NULL OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = job_code)""")
def _(spark, sf):
    """Orders without lines; orders whose key is missing stay, and do not share one task."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("job_code"))
    return ledger.only_in(orders, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_code")), "job_code")


@query("j03_location_overlay", """WITH p AS (SELECT l_orderkey AS job, n_name AS city, CASE WHEN l_returnflag = 'A' THEN NULL ELSE r_name END AS state, l_partkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT o_orderkey AS job, CASE WHEN o_orderstatus <> 'P' THEN n_name END AS city, CASE WHEN o_orderstatus = 'O' THEN r_name END AS state FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT p.job, p.l_partkey, coalesce(r.city, p.city) AS city, coalesce(r.state, p.state) AS state FROM p LEFT JOIN r ON p.job = r.job""")
def _(spark, sf):
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    own = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag").join(
        table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    pieces = own.select(F.col("l_orderkey").alias("job"), "l_partkey", "city", F.when(F.col("l_returnflag") != "A", F.col("state")).alias("state"))
    registry = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    known = registry.select(F.col("o_orderkey").alias("job"), F.when(F.col("o_orderstatus") != "P", F.col("city")).alias("city"), F.when(F.col("o_orderstatus") == "O", F.col("state")).alias("state"))
    return ledger.with_location(pieces, known, "job", ["city", "state"])


@query("a12_unshipped_rollup", """WITH r AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'))
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years,
  count(DISTINCT o_orderkey) AS structures, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS documents,
  CASE WHEN bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) THEN 'quote/drawing only' ELSE 'released, no shipment' END AS note
FROM r GROUP BY 1""")
def _(spark, sf):
    """Customers none of whose orders are finished."""
    orders = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "document": F.col("o_orderpriority")})
    shipped = orders.where(F.col("o_orderstatus") == "F").select("o_custkey")
    return ledger.unshipped(orders, shipped, "o_custkey", "o_orderkey", "year", "document", "o_orderkey", ["o_orderpriority"],
                            ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])


# ---------------------------------------------------------------- class reports

PRIORITY_DOCUMENT = {
    "1-URGENT": "Shop Drawing PDF", "2-HIGH": "BOM by Structure XML", "3-MEDIUM": "BOM by Structure PDF", "4-NOT SPECIFIED": "BOM Summary PDF", "5-LOW": "Scan",
}
_CLASS = f"coalesce({case('p_type', TYPE_CLASS)}, 'unknown')"


def classed(spark, sf):
    return lines_with_parts(spark, sf).withColumn("structure_class", F.coalesce(lookup(TYPE_CLASS, F.col("p_type")), F.lit("unknown")))


_PIVOT = ", ".join(f"count(CASE WHEN cls = '{c}' THEN 1 END) AS {c.replace('-', '_')}" for c in ("base", "rehab", "non-base", "unknown"))


@query("a08_class_by_year", f"WITH p AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, {_CLASS} AS cls FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT year, {_PIVOT}, count(*) AS total FROM p GROUP BY 1")
def _(spark, sf):
    return report.class_pivot(classed(spark, sf), F.col("year"), "year")


@query("a08_class_by_customer", f"""WITH p AS (SELECT coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, '?') AS customer, {_CLASS} AS cls FROM lineitem JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey) SELECT customer, {_PIVOT}, count(*) AS total FROM p GROUP BY 1""")
def _(spark, sf):
    """A08, J21, L04."""
    segment = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("customer"))
    return report.class_pivot(report.with_dimension(classed(spark, sf), segment, "l_orderkey", "customer"), F.col("customer"), "customer")


@query("a09_class_totals", f"WITH p AS (SELECT {_CLASS} AS cls FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT cls AS class, count(*) AS pieces FROM p GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM p")
def _(spark, sf):
    return report.class_totals(classed(spark, sf))


@query("v05_auto_filled_types", f"SELECT l_orderkey, l_partkey, {_CLASS} AS structure_class FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N' AND {_CLASS} <> 'unknown'")
def _(spark, sf):
    rows = classed(spark, sf).withColumn("part_type", F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(F.col("p_type")))
    return report.auto_filled_types(rows, "part_type").select("l_orderkey", "l_partkey", "structure_class")


@query("a13_completeness", f"""WITH b AS (SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS structure, {_CLASS} AS cls,
    CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 ELSE 1 END AS rank,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'DIAGRAM' WHEN '2-HIGH' THEN 'PER_STRUCTURE_BOM' WHEN '3-MEDIUM' THEN 'PER_STRUCTURE_BOM' ELSE 'SUMMARY_ONLY' END AS tier
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT o_custkey, structure, arg_max(tier, rank) AS tier, count(CASE WHEN cls = 'base' THEN 1 END) AS base, count(CASE WHEN cls = 'non-base' THEN 1 END) AS nb, count(CASE WHEN cls = 'rehab' THEN 1 END) AS rehab, count(*) AS n FROM b GROUP BY 1, 2),
shipped AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) >= 4 UNION ALL SELECT -c_custkey FROM customer WHERE c_acctbal < 0)
SELECT g.o_custkey, structure, tier AS data_depth, CASE WHEN base > 0 THEN 'Y' ELSE '' END AS has_base, CASE WHEN nb > 0 THEN 'Y' ELSE '' END AS has_nonbase, n AS bom_part_count,
  CASE WHEN g.o_custkey IN (SELECT o_custkey FROM shipped) THEN 'Y' ELSE '' END AS shipped_in_job,
  CASE WHEN tier <> 'SUMMARY_ONLY' AND base = 0 AND rehab = 0 THEN 'no base in BOM - verify (rehab or missing base?)' WHEN tier <> 'SUMMARY_ONLY' THEN 'complete detail on file' ELSE 'summary only - pull BOM by Structure / Shop Drawing from job release folder' END AS next_action FROM g
UNION ALL SELECT o_custkey, '(no structure detail)', 'SHIPPING_ONLY', '', '', 0, 'Y', 'shipped but no BOM/diagram found - pull BOM by Structure / Shop Drawing' FROM shipped WHERE o_custkey NOT IN (SELECT o_custkey FROM b)""")
def _(spark, sf):
    """Shipped are customers with four finished orders, and keys without any structure."""
    orders = table(spark, sf, "orders")
    bom = classed(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    often = orders.where(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 4").select("o_custkey")
    shipped = often.unionByName(table(spark, sf, "customer").where("c_acctbal < 0").select((-F.col("c_custkey")).alias("o_custkey")))
    bom = bom.select("o_custkey", F.col("o_orderkey").cast("string").alias("structure"), lookup(PRIORITY_DOCUMENT, F.col("o_orderpriority")).alias("document"), "structure_class")
    return report.completeness(bom, shipped, "o_custkey", "structure", "document", "structure_class")


# ---------------------------------------------------------------- registry

def _registry(spark, sf):
    """Order priorities stand for three sources; all customers are the key universe."""
    orders = table(spark, sf, "orders").withColumns({"d": F.date_format("o_orderdate", "yyyy-MM-dd"), "year": F.year("o_orderdate").cast("string")})
    pick = lambda *p: orders.where(F.col("o_orderpriority").isin(*p))
    sources = {
        "bom": reg.registry_source(pick("1-URGENT", "4-NOT SPECIFIED"), "o_custkey", "o_orderkey", "bom", first={"bom_state": F.nullif("o_orderstatus", F.lit("P"))},
                                   least={"released": F.col("d")}, distinct={"bom_structures": F.col("o_orderkey")}),
        "dispatch": reg.registry_source(pick("2-HIGH", "5-LOW"), "o_custkey", "o_orderkey", "dispatch", first={"dispatch_state": F.col("o_orderstatus")}, sets={"years": F.col("year")}),
        "shipping": reg.registry_source(pick("3-MEDIUM"), "o_custkey", "o_orderkey", "shipping", first={"ship_state": F.col("o_orderstatus")}),
    }
    return reg.join_registry(sources, "o_custkey", table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey")))


_SRC = "(SELECT o_custkey, {cols}, count(*) AS {n}_rows FROM orders WHERE o_orderpriority IN ({p}) GROUP BY 1)"
REGISTRY_SQL = f"""reg AS (SELECT c_custkey AS o_custkey, bom_state, released, bom_structures, dispatch_state, years, ship_state,
  coalesce(bom_rows, 0) AS bom_rows, coalesce(dispatch_rows, 0) AS dispatch_rows, coalesce(shipping_rows, 0) AS shipping_rows FROM customer
  LEFT JOIN {_SRC.format(cols="arg_min(nullif(o_orderstatus, 'P'), o_orderkey) FILTER (o_orderstatus <> 'P') AS bom_state, min(strftime(o_orderdate, '%Y-%m-%d')) AS released, count(DISTINCT o_orderkey) AS bom_structures", n='bom', p="'1-URGENT', '4-NOT SPECIFIED'")} b ON c_custkey = b.o_custkey
  LEFT JOIN {_SRC.format(cols="arg_min(o_orderstatus, o_orderkey) AS dispatch_state, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years", n='dispatch', p="'2-HIGH', '5-LOW'")} d ON c_custkey = d.o_custkey
  LEFT JOIN {_SRC.format(cols="arg_min(o_orderstatus, o_orderkey) AS ship_state", n='shipping', p="'3-MEDIUM'")} s ON c_custkey = s.o_custkey)"""


@query("a14_registry_aggregate", f"""WITH {REGISTRY_SQL} SELECT o_custkey, coalesce(bom_state, dispatch_state, ship_state) AS state, released, bom_structures, years, bom_rows, dispatch_rows, shipping_rows,
  concat_ws(' + ', CASE WHEN bom_rows > 0 THEN 'bom' END, CASE WHEN dispatch_rows > 0 THEN 'dispatch' END, CASE WHEN shipping_rows > 0 THEN 'shipping' END) AS sources FROM reg""")
def _(spark, sf):
    """A14, A15, R11."""
    return _registry(spark, sf).select(
        "o_custkey", F.coalesce("bom_state", "dispatch_state", "ship_state").alias("state"), "released", "bom_structures", F.array_join("years", ",").alias("years"),
        "bom_rows", "dispatch_rows", "shipping_rows", reg.source_names(["bom", "dispatch", "shipping"]).alias("sources"))


@query("a26_registry_summary", f"""WITH {REGISTRY_SQL} SELECT count(*) AS total, count(CASE WHEN bom_rows > 0 THEN 1 END) AS in_bom, count(CASE WHEN dispatch_rows > 0 THEN 1 END) AS in_dispatch, count(CASE WHEN shipping_rows > 0 THEN 1 END) AS in_shipping,
  count(CASE WHEN bom_rows > 0 AND dispatch_rows > 0 AND shipping_rows > 0 THEN 1 END) AS in_all, count(CASE WHEN bom_rows > 0 AND dispatch_rows = 0 AND shipping_rows = 0 THEN 1 END) AS bom_only,
  count(CASE WHEN shipping_rows > 0 AND bom_rows = 0 THEN 1 END) AS shipping_no_bom, count(CASE WHEN bom_rows = 0 AND dispatch_rows = 0 AND shipping_rows = 0 THEN 1 END) AS no_source FROM reg""")
def _(spark, sf):
    return reg.registry_summary(_registry(spark, sf), "bom", "dispatch", "shipping")


@query("a17_order_rollup", """SELECT l_orderkey, arg_min(strftime(l_shipdate, '%Y-%m-%d'), (l_linenumber, l_partkey, l_extendedprice)) AS date, bool_or(l_linestatus = 'F') AS fulfilled,
  CAST(nullif(coalesce(sum(CASE WHEN l_returnflag <> 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0), 0) AS DOUBLE) AS job_value FROM lineitem GROUP BY 1""")
def _(spark, sf):
    """Lines flagged A stand for totals and tax, which do not count."""
    lines = table(spark, sf, "lineitem").withColumn("at", F.struct("l_linenumber", "l_partkey", "l_extendedprice"))
    item = F.when(F.col("l_returnflag") == "A", F.lit("Subtotal")).otherwise(F.col("l_returnflag"))
    rolled = reg.order_rollup(lines, "l_orderkey", "at", {"date": F.date_format("l_shipdate", "yyyy-MM-dd")}, F.col("l_linestatus") == "F", item, F.col("l_extendedprice"), K.VALUE_SKIP_ITEMS)
    return rolled.withColumn("job_value", F.col("job_value").cast("double"))


@query("a18_job_rollup", f"""WITH r AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN {CODE_SQL} END AS job_code, c_mktsegment AS customer, n_name AS city, p_name, CAST(year(l_shipdate) AS INT) AS year, (l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
k AS (SELECT *, coalesce(job_code, '|' || customer || '|' || city) AS job_key FROM r),
b AS (SELECT job_key, arg_min(customer, rn) AS customer, arg_min(city, rn) AS city, min(year) AS first_year, max(year) AS last_year FROM k GROUP BY 1),
c AS (SELECT job_key, p_name, count(*) AS n FROM k GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY n DESC, p_name) AS rn FROM c),
l AS (SELECT job_key, string_agg(p_name || ':' || n, ',' ORDER BY rn) AS composition FROM t WHERE rn <= 15 GROUP BY 1)
SELECT b.*, composition FROM b JOIN l ON b.job_key = l.job_key""")
def _(spark, sf):
    """The key of rows without a code is (customer, city); top-15 parts are the report."""
    rows = lines_with_parts(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumns({"job_code": F.when(F.col("o_orderstatus") != "P", customer_code()), "customer": F.col("c_mktsegment"),
                             "rn": F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")})
    return reg.job_rollup(rows, reg.composite_job_key("job_code", "customer", "city"), "rn", ["customer", "city"], F.col("p_name"), "year")


@query("a20_size_histogram", """WITH r AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, l_returnflag, CASE WHEN p_size * 12 IN (48, 60, 72, 84, 96, 120, 144, 192) THEN CAST(p_size * 12 AS VARCHAR) ELSE '?' END AS size
  FROM lineitem JOIN part ON l_partkey = p_partkey), c AS (SELECT l_suppkey, year, l_returnflag, size, count(*) AS n FROM r GROUP BY 1, 2, 3, 4)
SELECT l_suppkey, year, l_returnflag, CAST(sum(n) AS BIGINT) AS qty, string_agg(size || ':' || n, ',' ORDER BY n DESC, size) AS sizes FROM c GROUP BY 1, 2, 3""")
def _(spark, sf):
    """A20, L08, N23."""
    return reg.size_histogram(lines_with_parts(spark, sf), ["l_suppkey", "year", "l_returnflag"], barrel_diameter(F.col("p_size") * 12))


@query("x01_dictionary", "SELECT p_brand, p_name, row_number() OVER (ORDER BY md5(p_brand || '|' || p_name), p_brand, p_name) - 1 AS id FROM (SELECT DISTINCT p_brand, p_name FROM part)")
def _(spark, sf):
    return dense_index(table(spark, sf, "part"), ["p_brand", "p_name"], "id")


@query("x01_encoded_rows", """WITH d AS (SELECT p_name, row_number() OVER (ORDER BY md5(p_name), p_name) - 1 AS name_id FROM (SELECT DISTINCT p_name FROM part))
SELECT p_partkey, p_brand, name_id FROM part JOIN d ON part.p_name = d.p_name""")
def _(spark, sf):
    coded, _ = reg.encode(table(spark, sf, "part").select("p_partkey", "p_brand", "p_name"), ["p_name"], "name_id")
    return coded


@query("l07_code_sequence", f"""WITH u AS (SELECT DISTINCT {CODE_SQL} AS code FROM customer JOIN orders ON o_custkey = c_custkey),
m AS (SELECT max((ascii(code) - 65) * 676 + (ascii(substr(code, 2, 1)) - 65) * 26 + ascii(substr(code, 3, 1)) - 65) AS top FROM u),
s AS (SELECT CAST(unnest(range(0, CAST(top AS BIGINT) + 1)) AS BIGINT) AS code_no FROM m),
c AS (SELECT code_no, chr(65 + CAST((code_no // 676) % 26 AS INT)) || chr(65 + CAST((code_no // 26) % 26 AS INT)) || chr(65 + CAST(code_no % 26 AS INT)) AS code FROM s)
SELECT code, code_no, code NOT IN (SELECT code FROM u) AS is_placeholder FROM c""")
def _(spark, sf):
    """N31, L06, L07."""
    done = table(spark, sf, "orders").select(customer_code("o_custkey").alias("code")).distinct()
    return reg.code_sequence(done, "code")


@query("n31_code_numbers", f"SELECT c_custkey, {CODE_SQL} AS code, c_custkey % 17576 AS back FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", customer_code().alias("code")).withColumn("back", code_to_int("code"))


_FILL = {"status": "nullif(o_orderstatus, 'P')", "priority": "CASE WHEN o_orderpriority < '3' THEN o_orderpriority END"}


@query("w04_fullest_row", f"""WITH r AS (SELECT o_custkey, o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year, {_FILL['status']} AS status, {_FILL['priority']} AS priority FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (status IS NOT NULL)::INT + (priority IS NOT NULL)::INT DESC, year DESC, o_orderkey) AS rn FROM r)
SELECT o_custkey, o_orderkey, year, status, priority FROM k WHERE rn = 1""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.year("o_orderdate").cast("string").alias("year"), F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") < "3", F.col("o_orderpriority")).alias("priority"))
    return reg.fullest_row(rows, "o_custkey", "year", "o_orderkey", ["status", "priority"])


for _name, _prefer, _order in (("w08_newest_record", False, "o_orderkey DESC"), ("w08_newest_with_place", True, "(o_orderstatus = 'F') DESC, o_orderkey DESC")):
    def _newest(spark, sf, prefer=_prefer):
        rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
        return reg.latest_year(rows, "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F" if prefer else None)

    query(_name, f"SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_order}) AS rn FROM orders) WHERE rn = 1")(_newest)


@query("a25_frequency", "SELECT n_name, count(*) AS jobs FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(spark, sf):
    """A04, A25."""
    named = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return reg.frequency(named, "n_name", "jobs")


@query("u07_distinct_pairs", "SELECT DISTINCT n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    named = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name").distinct()


@query("j25_second_feed", """WITH f AS (SELECT *, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS feed FROM lineitem)
SELECT l_partkey, l_returnflag AS system, CAST(sum(l_quantity) AS DOUBLE) AS qty, arg_min(l_suppkey, (feed, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS l_suppkey FROM f GROUP BY 1, 2 HAVING count(CASE WHEN l_quantity <> 0 THEN 1 END) > 0""")
def _(spark, sf):
    """Open lines are a second feed; its quantities add up, the first feed's supplier stays."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_quantity", "l_suppkey", "l_linestatus", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("row_no"))
    feeds = ledger.stack_feeds([lines.where(F.col("l_linestatus") == "F"), lines.where(F.col("l_linestatus") != "F")], "row_no")
    merged = ledger.system_quantities(feeds, ["l_partkey"], "l_returnflag", F.col("l_quantity"), ["l_suppkey"], "row_no")
    return merged.select("l_partkey", F.col("l_returnflag").alias("system"), F.col("qty").cast("double").alias("qty"), "meta.l_suppkey")


@query("l02_null_last", """WITH o AS (SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS job, o_orderstatus AS s FROM orders WHERE year(o_orderdate) BETWEEN 1990 AND 2030 AND o_orderstatus IN ('F', 'O')),
g AS (SELECT job, count(CASE s WHEN 'O' THEN 1 END) AS dispatch_pieces, count(CASE s WHEN 'F' THEN 1 END) AS erp_pieces FROM o GROUP BY 1)
SELECT job, dispatch_pieces, erp_pieces, row_number() OVER (ORDER BY job NULLS LAST) AS place FROM g""")
def _(spark, sf):
    """The place of each row in the sorted report, counted within and across its sorted files."""
    orders = table(spark, sf, "orders").select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("job"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    report_ = ledger.reconcile_by_job(orders.where(F.col("o_orderstatus") == "O"), orders.where(F.col("o_orderstatus") == "F"), (1990, 2030), "job")
    numbered = reliable_checkpoint(report_.withColumn("part", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return numbered.join(sizes, "part").select("job", F.col("dispatch_pieces").cast("bigint"), F.col("erp_pieces").cast("bigint"), (F.col("i") + F.col("shift")).alias("place"))
