"""Queries: incremental batches, snapshots, checks, documents of a job, dashboard, streams
(I01, J01, J09, K05-K07, Q*, U*, D*, W06, W07, W14, R15, R16, ST01-ST03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.clean import lookup
from plumbline.operators import documents as docs
from plumbline.operators import quality, report, snapshots
from plumbline.operators import registry as reg
from plumbline.operators.geocode import zip_points
from plumbline.operators.scale import literal_rows
from plumbline.sinks import tables
from plumbline.streaming import ingest

from .base import query, scratch, table
from .cleaning import FILES_SQL, file_names
from .matching import GAZ_SQL, PLACE_SQL, gazetteer, places
from .pieces import TYPE_CLASS

CUTOFF = "2024-01-20"


def _events(spark, sf):
    return table(spark, sf, "events")


def _history(spark, sf):
    return _events(spark, sf).where(F.col("ts") <= F.lit(CUTOFF).cast("timestamp_ntz"))


def _kept_history(spark, sf):
    path, rows = scratch(spark, "history"), _history(spark, sf)
    for half in (0, 1):
        tables.append_history(rows.where(F.col("event_id") % 2 == half), path, "ts")
    return path


# ---------------------------------------------------------------- incremental

@query("a31_high_water", f"SELECT CAST(max(ts) AS VARCHAR) AS cutoff FROM events WHERE ts <= TIMESTAMP '{CUTOFF}'")
def _(spark, sf):
    """From the footers of a history written in two batches."""
    return tables.high_water_of(spark, _kept_history(spark, sf)).select(F.col("cutoff").cast("timestamp_ntz").cast("string").alias("cutoff"))


_BATCH_SQL = f"""h AS (SELECT max(ts) AS cutoff FROM events WHERE ts <= TIMESTAMP '{CUTOFF}'), b AS (SELECT *, CASE WHEN event_type <> 'error' THEN ts END AS moment FROM events),
m AS (SELECT b.*, CASE WHEN moment IS NULL THEN 'bad_date' WHEN moment <= (SELECT cutoff FROM h) THEN 'before_cutoff' ELSE 'new' END AS batch_state FROM b)"""


def _batch(spark, sf):
    """A batch that overlaps the history; errors came without a usable date."""
    batch = _events(spark, sf).withColumn("moment", F.when(F.col("event_type") != "error", F.col("ts")))
    cutoff = tables.high_water_of(spark, _kept_history(spark, sf)).select(F.col("cutoff").cast("timestamp_ntz").alias("moment"))
    return snapshots.after_cutoff(batch, cutoff, "moment")


@query("i01_incremental", f"WITH {_BATCH_SQL} SELECT event_id, user_id, event_type FROM m WHERE batch_state = 'new'")
def _(spark, sf):
    return _batch(spark, sf).where(F.col("batch_state") == "new").select("event_id", "user_id", "event_type")


@query("i01_batch_counts", f"WITH {_BATCH_SQL} SELECT batch_state, count(*) AS rows FROM m GROUP BY 1")
def _(spark, sf):
    return _batch(spark, sf).groupBy("batch_state").agg(F.count("*").alias("rows"))


@query("a32_batch_summary", f"WITH {_BATCH_SQL} SELECT event_type, count(*) AS rows, strftime(min(moment), '%Y-%m-%d') AS first, strftime(max(moment), '%Y-%m-%d') AS last FROM m WHERE batch_state = 'new' GROUP BY 1")
def _(spark, sf):
    summary = snapshots.batch_summary(_batch(spark, sf).where(F.col("batch_state") == "new"), "event_type", "moment")
    return summary.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first", "last")})


@query("k07_target_order", "SELECT user_id, '' AS plant, event_id, event_type FROM events")
def _(spark, sf):
    return snapshots.in_target_order(_events(spark, sf), ["user_id", "plant", "event_id", "event_type"])


def _shipments(spark, sf):
    """Lines by order; the right side has orders repeated per line, its last row counts."""
    left = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("sit"), "o_custkey")
    right = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sit"), F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("row_no"), "l_partkey")
    return snapshots.join_shipments(left, right, "sit", "row_no")


_SHIP_SQL = "r AS (SELECT CAST(l_orderkey AS VARCHAR) AS sit, arg_max(l_partkey, (l_linenumber, l_partkey, l_extendedprice)) AS l_partkey FROM lineitem GROUP BY 1)"


@query("j01_shipment_join", f"WITH {_SHIP_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS sit, o_custkey, l_partkey FROM orders JOIN r ON CAST(o_orderkey AS VARCHAR) = sit")
def _(spark, sf):
    return _shipments(spark, sf)[0]


@query("j01_unmatched", f"WITH {_SHIP_SQL} SELECT count(*) AS unmatched FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT sit FROM r)")
def _(spark, sf):
    return _shipments(spark, sf)[1]


@query("k05_upsert", f"""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS entity_key, event_type AS field, CAST(value AS VARCHAR) AS chosen_value, event_id AS stamp, ts FROM events)
SELECT entity_key, field, CAST(arg_max(chosen_value, stamp) AS DOUBLE) AS chosen_value, max(stamp) AS stamp FROM e WHERE chosen_value IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    """The later half of the events written ahead of the earlier half, one of them twice."""
    rows = _events(spark, sf).select(F.col("user_id").cast("string").alias("entity_key"), F.col("event_type").alias("field"), F.col("value").cast("string").alias("chosen_value"), F.col("event_id").alias("stamp"), "ts")
    early = rows.where(F.col("ts") <= F.lit(CUTOFF).cast("timestamp_ntz")).drop("ts")
    late = rows.where(F.col("ts") > F.lit(CUTOFF).cast("timestamp_ntz")).drop("ts")
    path, keyed = scratch(spark, "k05"), (["entity_key", "field"], "chosen_value", "stamp")
    for name, batch in (("late", late), ("early", early), ("late", late)):
        tables.write_changes(batch, path, name, *keyed)
    schema = "entity_key string, field string, chosen_value string, stamp bigint"
    return tables.read_latest(spark, path, schema, *keyed).withColumn("chosen_value", F.col("chosen_value").cast("double"))


def _labels(spark, sf):
    """Two snapshots: what users did in each half of the month."""
    half = F.when(F.dayofmonth("ts") <= 15, "2024-01a").otherwise("2024-01b")
    return _events(spark, sf).select(half.alias("label"), F.concat_ws(":", "user_id", "event_type", F.get_json_object("props", "$.k")).alias("piece_id"), "event_type").distinct()


_SNAP_SQL = "s AS (SELECT DISTINCT CASE WHEN day(ts) <= 15 THEN '2024-01a' ELSE '2024-01b' END AS label, user_id || ':' || event_type || ':' || json_extract_string(props, '$.k') AS piece_id, event_type FROM events)"


@query("u05_snapshot_diff", f"""WITH {_SNAP_SQL} SELECT 'new' AS change, piece_id FROM s WHERE label = '2024-01b' AND piece_id NOT IN (SELECT piece_id FROM s WHERE label = '2024-01a')
UNION ALL SELECT 'removed', piece_id FROM s WHERE label = '2024-01a' AND piece_id NOT IN (SELECT piece_id FROM s WHERE label = '2024-01b')""")
def _(spark, sf):
    s = _labels(spark, sf)
    path = scratch(spark, "u05")
    for label in ("2024-01a", "2024-01b"):
        tables.write_digested(s.where(F.col("label") == label).select("piece_id", "event_type"), path, label, ["piece_id"])
    new, gone = tables.snapshot_difference(spark, path, "2024-01a", "2024-01b", "piece_id string, event_type string", "piece_id")
    return new.select(F.lit("new").alias("change"), "piece_id").unionByName(gone.select(F.lit("removed").alias("change"), "piece_id"))


@query("u06_metric_delta", f"""WITH {_SNAP_SQL}, c AS (SELECT m.metric, count(CASE WHEN label = '2024-01a' AND (m.metric = 'pieces' OR m.metric = event_type) THEN 1 END) AS previous,
  count(CASE WHEN label = '2024-01b' AND (m.metric = 'pieces' OR m.metric = event_type) THEN 1 END) AS current FROM s, (SELECT unnest(['pieces', 'click', 'error', 'view', 'signup', 'purchase']) AS metric) m GROUP BY 1)
SELECT metric, previous, current, current - previous AS delta FROM c""")
def _(spark, sf):
    """A23, U06."""
    s = _labels(spark, sf)
    one = lambda label: snapshots.metrics(s.where(F.col("label") == label), "event_type", ["click", "error", "view", "signup", "purchase"])
    return snapshots.metric_delta(one("2024-01a"), one("2024-01b"))


# ---------------------------------------------------------------- checks

def _judged(spark, sf):
    lines = table(spark, sf, "lineitem")
    return quality.with_reject_reason(lines, [
        ("qty_zero", F.col("l_quantity") < 2), ("bad_date", F.year("l_shipdate") > 2000), ("bad_plant", F.col("l_returnflag") == "N")])


@query("f01_reject_counts", "SELECT CASE WHEN l_quantity < 2 THEN 'qty_zero' WHEN year(l_shipdate) > 2000 THEN 'bad_date' WHEN l_returnflag = 'N' THEN 'bad_plant' ELSE 'kept' END AS reason, count(*) AS rows FROM lineitem GROUP BY 1")
def _(spark, sf):
    return quality.reject_counts(_judged(spark, sf))


@query("f01_admitted", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity >= 2 AND year(l_shipdate) <= 2000 AND l_returnflag <> 'N'")
def _(spark, sf):
    return quality.admitted(_judged(spark, sf)).select("l_orderkey", "l_linenumber", "l_partkey")


BASELINE = [(1995, 5000), (1996, 9000), (1997, 9500), (1998, 9000), (1999, 50000), (2014, 255)]


@query("q02_baseline", f"""WITH e(year, baseline) AS (VALUES {", ".join(str(b) for b in BASELINE)}), a AS (SELECT year(l_shipdate) AS year, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(e.year AS INT) AS year, CAST(baseline AS BIGINT) AS baseline, coalesce(n, 0) AS actual, coalesce(n, 0) <= baseline AS ok FROM e LEFT JOIN a ON e.year = a.year""")
def _(spark, sf):
    expected = literal_rows(spark, BASELINE, "year int, rows bigint")
    actual = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("rows"))
    return quality.baseline_check(actual, expected, "year", "rows")


@query("q06_populated_share", "SELECT round(avg(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END), 4) AS status, 1.0::DOUBLE AS o_orderkey FROM orders")
def _(spark, sf):
    return quality.populated_share(table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P"))), "status", "o_orderkey")


@query("l09_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 5")
def _(spark, sf):
    """A sample of five is the feature."""
    return quality.sample_rows(table(spark, sf, "orders"), "o_orderkey", 5, seed=7).select("o_orderkey", "o_custkey")


@query("l10_column_widths", "SELECT CAST(max(length(p_name)) AS INT) AS p_name, CAST(max(length(p_brand)) AS INT) AS p_brand, CAST(max(length(CAST(p_size AS VARCHAR))) AS INT) AS p_size FROM part")
def _(spark, sf):
    return quality.column_widths(table(spark, sf, "part").select("p_name", "p_brand", "p_size"))


# ---------------------------------------------------------------- documents of a job

_PRIO = "CASE kind WHEN 4 THEN 5 ELSE kind END"


@query("w06_best_type_files", f"WITH {FILES_SQL} SELECT o_custkey, o_orderkey, label FROM f WHERE label IS NOT NULL QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY {_PRIO}) = 1")
def _(spark, sf):
    return docs.best_type_files(file_names(spark, sf), "o_custkey", "file_name").select("o_custkey", "o_orderkey", "label")


@query("w07_first_seen", "SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY dense_rank() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey) = 1")
def _(spark, sf):
    return docs.first_seen_structures(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey", "l_orderkey").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


_PICK_SQL = FILES_SQL + """, n AS (SELECT *, CASE kind WHEN 3 THEN 'drawing' WHEN 4 THEN 'quote' ELSE 'bom' END AS g, CASE kind WHEN 4 THEN 5 ELSE kind END AS pr FROM f WHERE label IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, g ORDER BY pr, CAST(strftime(o_orderdate, '%y') AS INT) DESC, month(o_orderdate) DESC, day(o_orderdate) DESC, file_name, o_orderkey) AS rn FROM n),
p AS (SELECT o_custkey, max(CASE WHEN g = 'bom' THEN file_name END) AS bf, max(CASE WHEN g = 'bom' THEN label END) AS bl, max(CASE WHEN g = 'quote' THEN file_name END) AS qf, max(CASE WHEN g = 'quote' THEN label END) AS ql,
    max(CASE WHEN g = 'drawing' THEN file_name END) AS df FROM b WHERE rn = 1 GROUP BY 1)"""


@query("r16_document_pick", f"WITH {_PICK_SQL} SELECT o_custkey, coalesce(bf, qf) AS bom_file, coalesce(bl, ql) AS bom_doc_type, df AS shop_drawing_file FROM p")
def _(spark, sf):
    """R16, N32 with the archive's rules."""
    files = file_names(spark, sf).withColumn("structures", F.col("kind"))
    return docs.pick_documents(files, "o_custkey", "file_name", "structures").select("o_custkey", "bom_file", "bom_doc_type", "shop_drawing_file")


@query("w14_form_pick", """WITH f AS (SELECT *, CASE WHEN o_orderpriority < '3' THEN 'a_NCF.docx' ELSE 'notes.docx' END AS name, CASE WHEN o_orderstatus = 'F' THEN 'Reno' ELSE '' END AS loc FROM orders)
SELECT o_custkey, o_orderkey, name FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (name = 'a_NCF.docx') DESC, (loc <> '') DESC, o_orderkey) = 1""")
def _(spark, sf):
    """W14, N33."""
    files = table(spark, sf, "orders").withColumns({
        "name": F.when(F.col("o_orderpriority") < "3", "a_NCF.docx").otherwise("notes.docx"), "loc": F.when(F.col("o_orderstatus") == "F", "Reno").otherwise("")})
    return docs.pick_form(files, "o_custkey", "name", "loc", "o_orderkey").select("o_custkey", "o_orderkey", "name")


@query("q05_unclassified", f"WITH {FILES_SQL} SELECT o_orderkey, file_name || '2' AS file_name, '.jpg2' AS extension FROM f WHERE kind = 5")
def _(spark, sf):
    """Q05: pictures under an unknown extension stay on the list; known by-products do not."""
    name = F.when(F.col("kind") == 5, F.concat("file_name", F.lit("2"))).otherwise(F.col("file_name"))
    return docs.unclassified(file_names(spark, sf).withColumn("file_name", name), "file_name").select("o_orderkey", "file_name", "extension")


def _checked(spark, sf):
    """Customers as jobs: two places, two counts and the documents their orders stand for."""
    o = table(spark, sf, "orders")
    names = {"1-URGENT": "BOM Summary PDF", "2-HIGH": "NCF", "3-MEDIUM": "Shop Drawing PDF"}
    have = o.groupBy("o_custkey").agg(
        F.array_sort(F.collect_set(lookup(names, F.col("o_orderpriority")))).alias("documents"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("structure_count_bom"), F.nullif(F.count_if(F.col("o_orderpriority") == "3-MEDIUM"), F.lit(0)).alias("structure_count_drawing"))
    c = table(spark, sf, "customer").join(have, F.col("c_custkey") == F.col("o_custkey"))
    k = F.col("c_custkey") % 4
    return docs.cross_check(c.select(
        F.col("c_custkey").alias("job"), F.when(k != 0, F.concat("c_mktsegment", F.lit(", Texas"))).alias("location_bom"),
        F.when(k == 1, F.concat("c_mktsegment", F.lit(", TX"))).when(k == 2, F.lit("Reno, NV")).otherwise(F.lit("")).alias("location_form"),
        F.col("c_name").alias("contractor_bom"), F.when(k == 1, F.upper(F.concat(F.lit(" "), "c_name"))).when(k == 2, F.lit("other")).alias("customer_form"),
        "structure_count_bom", "structure_count_drawing", "documents"))


_CHECK_SQL = """d AS (SELECT o_custkey, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS b, count(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) AS n, nullif(count(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 END), 0) AS s FROM orders GROUP BY 1),
x AS (SELECT c_custkey AS job, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment || ', TX' ELSE '' END AS location, CASE WHEN c_custkey % 4 <> 0 THEN 'BOM' ELSE '' END AS location_source, c_custkey % 4 = 2 AS location_conflict,
  CASE c_custkey % 4 WHEN 1 THEN true WHEN 2 THEN false END AS contractor_customer_match, coalesce(b <> s, false) AS structure_count_conflict, CASE WHEN b <> s THEN 'BOM=' || b || '; ShopDrawing=' || s END AS detail,
  concat_ws(',', CASE WHEN b = 0 THEN 'BOM' END, CASE WHEN n = 0 THEN 'NCF' END, CASE WHEN s IS NULL THEN 'Shop Drawing PDF' END) AS missing FROM customer JOIN d ON c_custkey = o_custkey)"""


@query("r15_cross_check", f"WITH {_CHECK_SQL} SELECT * FROM x")
def _(spark, sf):
    """R15, N40, X04."""
    return _checked(spark, sf).select("job", "location", "location_source", "location_conflict", "contractor_customer_match", "structure_count_conflict",
                                      F.col("structure_count_conflict_detail").alias("detail"), F.array_join("documents_missing", ",").alias("missing"))


@query("a29_document_conflicts", f"""WITH {_CHECK_SQL} SELECT count(*) AS records, count(CASE WHEN location_conflict THEN 1 END) AS location_conflicts, count(CASE WHEN structure_count_conflict THEN 1 END) AS count_conflicts,
  count(CASE WHEN contractor_customer_match = false THEN 1 END) AS customer_mismatches, count(CASE WHEN contains(missing, 'BOM') THEN 1 END) AS missing_bom, count(CASE WHEN contains(missing, 'NCF') THEN 1 END) AS missing_form FROM x""")
def _(spark, sf):
    return docs.document_conflicts(_checked(spark, sf))


@query("j09_missing_folders", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, sf):
    folders = table(spark, sf, "orders").select("o_orderkey")
    return docs.missing_folders(folders, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("u02_year_union", """SELECT CAST(1995 AS INT) AS year, o_orderkey, NULL AS zip FROM orders WHERE year(o_orderdate) = 1995 UNION ALL SELECT 1996, o_orderkey, o_orderpriority FROM orders WHERE year(o_orderdate) = 1996
UNION ALL SELECT 1997, o_orderkey, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1997""")
def _(spark, sf):
    """The first year's table lacks a column; stacking goes by name."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("zip"), "o_orderdate")
    of = lambda cond: rows.where(cond).drop("o_orderdate")
    y = F.year("o_orderdate")
    return docs.source_year_union({1995: of(y == 1995).drop("zip"), 1996: of(y == 1996), 1997: of(y >= 1997)})


# ---------------------------------------------------------------- dashboard

def counts(spark, sf):
    """The map's counts: pieces by plant, state, job, year and month."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag")
    rows = lines.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("l_returnflag").alias("plant"), F.col("n_name").alias("state"), F.col("l_orderkey").alias("job"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))


COUNTS_SQL = """c AS (SELECT l_returnflag AS plant, n_name AS state, l_orderkey AS job, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 4, 5)"""


@query("d01_filtered", f"WITH {COUNTS_SQL} SELECT state, CAST(sum(qty) AS BIGINT) AS qty FROM c WHERE contains(lower(state), '_1') AND year BETWEEN 1996 AND 1999 AND plant IN ('A', 'R') GROUP BY 1")
def _(spark, sf):
    """D01, F05, F08."""
    return report.filter_map(counts(spark, sf), text="_1", text_columns=["state"], years=(1996, 1999), plants=["A", "R"]).groupBy("state").agg(F.sum("qty").alias("qty"))


@query("d02_kpis", f"""WITH {COUNTS_SQL}, s AS (SELECT state, sum(qty) AS q FROM c GROUP BY 1)
SELECT CAST(sum(qty) AS BIGINT) AS total, count(DISTINCT job) AS jobs, (SELECT count(*) FROM s) AS states, (SELECT state FROM s ORDER BY q DESC, state LIMIT 1) AS top_state FROM c""")
def _(spark, sf):
    return report.kpis(counts(spark, sf), "qty", "state", "job")


@query("d03_ytd_growth", f"""WITH {COUNTS_SQL}, y AS (SELECT year, CAST(coalesce(sum(CASE WHEN month <= 6 THEN qty END), 0) AS BIGINT) AS ytd FROM c GROUP BY 1), l AS (SELECT *, lag(ytd) OVER (ORDER BY year) AS prior FROM y)
SELECT *, round((ytd - prior) / nullif(prior, 0), 4) AS growth FROM l""")
def _(spark, sf):
    return report.year_to_date(counts(spark, sf), "qty", "year", "month", 6)


@query("d04_plant_mix", f"WITH {COUNTS_SQL} SELECT plant, CAST(sum(qty) AS BIGINT) AS qty, round(sum(qty) / (SELECT sum(qty) FROM c), 4) AS share FROM c GROUP BY 1")
def _(spark, sf):
    """D04, W13."""
    return report.mix(counts(spark, sf), "plant", "qty")


@query("d05_top_states", f"WITH {COUNTS_SQL} SELECT state, CAST(sum(qty) AS BIGINT) AS qty FROM c GROUP BY 1 ORDER BY qty DESC, state LIMIT 10")
def _(spark, sf):
    """The ten largest are the report."""
    return report.top_keys(counts(spark, sf), "state", "qty", 10)


@query("d06_cumulative", f"WITH {COUNTS_SQL}, y AS (SELECT year, CAST(sum(qty) AS BIGINT) AS qty FROM c GROUP BY 1) SELECT year, qty, CAST(sum(qty) OVER (ORDER BY year) AS BIGINT) AS cumulative FROM y")
def _(spark, sf):
    return report.cumulative(counts(spark, sf), "year", "qty")


@query("d07_flows", f"WITH {COUNTS_SQL} SELECT plant, state, CAST(sum(qty) AS BIGINT) AS qty FROM c GROUP BY 1, 2")
def _(spark, sf):
    return report.flows(counts(spark, sf), "plant", "state", "qty")


# ---------------------------------------------------------------- location review

@query("j22_zip_check", f"""WITH {PLACE_SQL} SELECT c_custkey, p.zip, CASE WHEN zp.city IS NULL THEN 'UNKNOWN_ZIP' WHEN zp.state IS DISTINCT FROM p.state THEN 'STATE_MISMATCH' WHEN p.city IS NOT NULL AND zp.city <> p.city THEN 'CITY_MISMATCH' ELSE '✓' END AS zip_ok
FROM p LEFT JOIN zp ON p.zip = zp.zip""")
def _(spark, sf):
    zips = places(spark, sf).withColumnsRenamed({"city": "confirmed_city", "state": "confirmed_state"})
    return report.zip_check(zips, zip_points(gazetteer(spark, sf), "last")).select("c_custkey", "zip", "zip_ok")


# ---------------------------------------------------------------- streams

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(spark, sf):
    return ingest.read_stream(spark, sf, EVENT_SCHEMA, pathGlobFilter="events.parquet")


@query("st01_stream_append", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    """ST01: the events as a stream, each id once; equals the batch because none is late."""
    out, mark = scratch(spark, "st01"), scratch(spark, "st01-mark")
    ingest.append_stream(ingest.new_rows(_stream(spark, sf), "event_id", "ts", "1 day"), out, mark).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("st02_stream_upsert", "SELECT CAST(user_id AS VARCHAR) AS entity_key, event_type AS field, arg_max(value, event_id) AS chosen_value, max(event_id) AS stamp FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def _(spark, sf):
    """ST02: latest event per user and type kept by the stream."""
    out, mark, schema = scratch(spark, "st02"), scratch(spark, "st02-mark"), "entity_key string, field string, chosen_value string, stamp bigint"
    keyed = ["entity_key", "field"], "chosen_value", "stamp"
    rows = _stream(spark, sf).select(F.col("user_id").cast("string").alias("entity_key"), F.col("event_type").alias("field"), F.col("value").cast("string").alias("chosen_value"), F.col("event_id").alias("stamp"))
    ingest.upsert_stream(rows, out, *keyed, mark).awaitTermination()
    return tables.read_latest(spark, out, schema, *keyed).withColumn("chosen_value", F.col("chosen_value").cast("double"))


_ANOM_SQL = """e AS (SELECT event_id, n.n_name AS city, 'R' || (user_id % 5) AS state FROM events JOIN nation n ON user_id % 25 = n_nationkey)"""


@query("st03_stream_anomalies", f"WITH {GAZ_SQL}, {_ANOM_SQL} SELECT event_id, e.city, e.state, array_to_string(valid_states, '|') AS valid_states FROM e JOIN cs ON e.city = cs.city WHERE NOT list_contains(valid_states, e.state)")
def _(spark, sf):
    """ST03: events with a place; places the gazetteer contradicts go to a table of their own."""
    named = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    rows = _stream(spark, sf).join(named, F.col("user_id") % 25 == F.col("n_nationkey")).select("event_id", "city", F.concat(F.lit("R"), F.col("user_id") % 5).alias("state"))
    out, odd, mark = scratch(spark, "st03"), scratch(spark, "st03-odd"), scratch(spark, "st03-mark")
    ingest.ingest_with_anomalies(rows, gazetteer(spark, sf), "city", "state", out, odd, mark).awaitTermination()
    return spark.read.parquet(odd).select("event_id", "city", "state", "valid_states")


# ---------------------------------------------------------------- map bundle

@query("x03_map_counts", """WITH d AS (SELECT n_name, row_number() OVER (ORDER BY md5(n_name), n_name) - 1 AS loc FROM (SELECT DISTINCT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)),
r AS (SELECT n_name, CAST(year(l_shipdate) AS INT) AS year, l_returnflag AS plant FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE p_type IN ('ECONOMY', 'PROMO'))
SELECT loc, year, plant, count(*) AS qty FROM r JOIN d ON r.n_name = d.n_name GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Counts of bases against an id of the place; the parts of the bundle stay tables."""
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag").join(table(spark, sf, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.where(lookup(TYPE_CLASS, F.col("p_type")) == "base")
    named = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    coded, _ = reg.encode(named, ["n_name"], "loc")
    return rows.join(coded, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("loc", F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("plant")).agg(F.count("*").alias("qty"))
