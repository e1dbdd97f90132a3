"""Queries: writers and readers in a round trip, listings, and the location matrix (S, K, A33, V02, F02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.clean import lookup
from plumbline.operators import report, resolve
from plumbline.operators.geocode import zip_points
from plumbline.sinks import tables
from plumbline.sources import files, tabular

from .base import CODE_SQL, customer_code, query, scratch, table
from .matching import PLACE_SQL, gazetteer, places

# ---------------------------------------------------------------- round trips


@query("k01_csv_round_trip", "SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_brand AS brand, CAST(NULL AS VARCHAR) AS plant FROM part")
def _(spark, sf):
    """Fixed columns out, all text back in, headers found by alias."""
    path = scratch(spark, "k01")
    tables.write_csv(table(spark, sf, "part"), path, ["p_partkey", "p_name", "p_brand"])
    read = tabular.read_csv(spark, path)
    return tabular.resolve_headers(read, {"code": ["job code", "P_PARTKEY"], "name": ["p_name"], "brand": ["brand", "P_Brand"], "plant": ["plant"]}).drop("source_file", "row_no")


_ODD_TEXT = [("inch", "p_size || '\" Base, ' || p_name"), ("quoted", "'\"' || p_name || '\"'"), ("lines", "p_brand || chr(10) || ' ' || p_type || ' '")]


@query("k01_csv_odd_texts", f"SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, {', '.join(f'{sql} AS {name}' for name, sql in _ODD_TEXT)} FROM part")
def _(spark, sf):
    """Inch marks, commas, quotes, line breaks and spaces at the ends come back as they were."""
    path = scratch(spark, "odd")
    rows = table(spark, sf, "part").select("p_partkey", *[F.expr(sql).alias(name) for name, sql in _ODD_TEXT])
    tables.write_csv(rows, path, rows.columns)
    return tabular.read_csv(spark, path, line_breaks=True).drop("source_file", "row_no")


@query("s05_alias_coalesce", "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN 'O' ELSE o_orderstatus END AS place FROM orders")
def _(spark, sf):
    """Each row takes the first of three columns that holds something."""
    path, st = scratch(spark, "s05"), F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(st == "F", F.col("o_orderpriority")).alias("City"), F.when(st == "O", F.concat(F.lit(" "), st)).alias("Ship City"), st.alias("town"))
    tables.write_csv(rows, path, rows.columns)
    return tabular.coalesce_headers(tabular.read_csv(spark, path), {"id": ["o_orderkey"], "place": ["city", "ship city", "town"]}).drop("source_file", "row_no")


@query("s01_row_numbers", "SELECT count(*) AS rows, count(*) AS numbers, true AS in_order FROM orders")
def _(spark, sf):
    """``row_no`` tells a file's rows apart and follows their order within each file."""
    path = scratch(spark, "rows")
    table(spark, sf, "orders").select("o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", True).csv(path)
    read = tabular.read_csv(spark, path).withColumn("k", F.col("o_orderkey").cast("bigint"))
    # In order when the smallest key of each split-sized stretch comes with its smallest row number.
    stretch = read.groupBy("source_file", F.floor(F.col("row_no") / 1000).alias("s")).agg(
        (F.min("k") == F.min_by("k", "row_no")).alias("first_ok"), (F.max("k") == F.max_by("k", "row_no")).alias("last_ok"))
    ok = stretch.agg(F.bool_and(F.col("first_ok") & F.col("last_ok")).alias("ok"))
    return read.agg(F.count("*").alias("rows"), F.countDistinct("source_file", "row_no").alias("numbers")).withColumn("in_order", ok.scalar())


@query("k02_report_tables", "SELECT 'parts' AS sheet, count(*) AS rows FROM part UNION ALL SELECT 'nations', count(*) FROM nation")
def _(spark, sf):
    path = scratch(spark, "k02")
    tables.write_report({"parts": table(spark, sf, "part"), "nations": table(spark, sf, "nation")}, path)
    return report.index_counts({n: tabular.read_csv(spark, f"{path}/{n}") for n in ("parts", "nations")}).withColumnRenamed("list", "sheet")


@query("k03_json_round_trip", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    """K03, S08."""
    path = scratch(spark, "k03")
    tables.write_json(table(spark, sf, "events").select("event_id", "user_id", "event_type"), path)
    return tabular.read_json_records(spark, path, "event_id bigint, user_id bigint, event_type string", whole_files=False)


@query("k04_append_log", "SELECT o_orderstatus, '' AS note, CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders")
def _(spark, sf):
    """Three appends to one log, in the log's column order."""
    path, orders = scratch(spark, "k04"), table(spark, sf, "orders")
    for status in ("F", "O", "P"):
        tables.append_log(orders.where(F.col("o_orderstatus") == status), path, ["o_orderstatus", "note", "o_orderkey"])
    return tabular.read_csv(spark, path, row_no=False, nullValue="\u0000", emptyValue="").select("o_orderstatus", F.coalesce("note", F.lit("")).alias("note"), "o_orderkey")


@query("k06_snapshots", "SELECT CASE l_returnflag WHEN 'A' THEN '2024q1' ELSE '2024q2' END AS quarter, count(*) AS pieces FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1")
def _(spark, sf):
    """The second quarter is written twice; its second version replaces the first."""
    path, lines = scratch(spark, "k06"), table(spark, sf, "lineitem")
    for flag, label in (("A", "2024q1"), ("N", "2024q2"), ("R", "2024q2")):
        tables.write_snapshot(lines.where(F.col("l_returnflag") == flag).select("l_orderkey", "l_linenumber"), path, "quarter", label)
    return spark.read.parquet(path).groupBy("quarter").agg(F.count("*").alias("pieces"))


@query("k08_clustered_table", "SELECT l_suppkey, l_partkey, l_orderkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 997 = 5) OR l_suppkey = 7")
def _(spark, sf):
    """A table clustered by supplier and part, with a Bloom filter of the orders; both serve lookups."""
    path, lines = scratch(spark, "k08"), table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_quantity")
    tables.write_clustered(lines, path, ["l_suppkey", "l_partkey"], indexed=["l_orderkey"])
    kept = spark.read.schema(lines.schema).parquet(path)
    wanted = table(spark, sf, "orders").where(F.col("o_orderkey") % 997 == 5).select(F.col("o_orderkey").alias("l_orderkey"))
    by_order = kept.join(wanted, "l_orderkey", "left_semi").where(F.col("l_suppkey") != 7)
    return by_order.unionByName(kept.where(F.col("l_suppkey") == 7)).select("l_suppkey", "l_partkey", "l_orderkey", "l_quantity")


@query("s06_sheet_scan", "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CASE WHEN l_linenumber % 3 > 0 THEN l_linestatus ELSE '' END AS status, l_returnflag || '<&>' AS flag, CAST(l_linenumber AS VARCHAR) AS l_linenumber, '' AS absent FROM lineitem")
def _(spark, sf):
    """Workbooks of line items, cells left out here and there, read back by header name in many tasks; second sheets do not count."""
    path, lines = scratch(spark, "sheets"), table(spark, sf, "lineitem")
    rows = lines.select("l_orderkey", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linestatus")).alias("status"), F.concat("l_returnflag", F.lit("<&>")).alias("flag"), "l_linenumber")
    tables.write_sheet_xml(rows, path, rows.columns, ["l_orderkey", "l_linenumber"])
    names = ["l_orderkey", "status", "flag", "l_linenumber", "absent"]
    return files.read_sheet_table(spark, f"{path}/*", names).select(*names)


@query("s02_csv_mark", "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer")
def _(spark, sf):
    """Files that begin with a byte-order mark; it belongs to no name."""
    path, rows = scratch(spark, "mark"), table(spark, sf, "customer").select(F.col("c_custkey").alias("\ufeffJob Code"), F.col("c_name").alias(" Name "))
    tables.write_csv(rows, path, rows.columns)
    return tabular.resolve_headers(tabular.read_csv(spark, path), {"code": ["job code"], "name": ["name"]}).select("code", "name")


@query("s07_gazetteer_file", """SELECT lpad(CAST(s_suppkey % 60 AS VARCHAR), 5, '0') AS zip, n_name AS city, 'R' || n_regionkey AS state, n_name || ' COUNTY' AS county, round(20 + (s_suppkey % 97) / 4, 2) AS lat, round(-60 - (s_suppkey % 89) / 4, 2) AS lng
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3 AND s_suppkey % 7 > 0""")
def _(spark, sf):
    """A tab-separated postal file; rows without a latitude, and those of other states, go."""
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lat = F.when(F.col("s_suppkey") % 7 > 0, (20 + (F.col("s_suppkey") % 97) / 4).cast("string")).otherwise(F.lit("n/a"))
    fields = [F.lit("US"), F.lpad((F.col("s_suppkey") % 60).cast("string"), 5, "0"), F.initcap("n_name"), F.lit("State"), F.concat(F.lit("R"), F.col("n_regionkey")),
              F.concat(F.initcap("n_name"), F.lit(" County")), F.lit("1"), F.lit(""), F.lit(""), lat, (-60 - (F.col("s_suppkey") % 89) / 4).cast("string"), F.lit("1")]
    path = scratch(spark, "gazetteer")
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    return tabular.read_gazetteer(spark, path, ["R0", "R1", "R2"]).select("zip", "city", "state", "county", F.round("lat", 2).alias("lat"), F.round("lng", 2).alias("lng"))


@query("s06_sheet_cells", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS a, '' AS b, c_name AS c, '' AS d FROM customer")
def _(spark, sf):
    """Cells with and without a position of their own."""
    cell = lambda v, at=None: F.struct(F.struct(v.alias("_VALUE")).alias("Data"), F.lit(at).cast("bigint").alias("_ss:Index"))
    raw = F.when(F.col("c_custkey") % 2 == 0, F.array(cell(F.col("c_mktsegment")), cell(F.lit(None).cast("string")), cell(F.col("c_name")))).otherwise(F.array(cell(F.col("c_name"), 3)))
    placed = table(spark, sf, "customer").select("c_custkey", files.placed_cells(raw).alias("x"))
    return placed.select("c_custkey", *[files.cell_at("x", F.lit(i)).alias(n) for i, n in enumerate("abcd", 1)])


# ---------------------------------------------------------------- listings

_LIST_SQL = """f AS (SELECT o_custkey AS job, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Job Release 2/x' WHEN '2-HIGH' THEN 'Forms' ELSE 'notes' END AS subfolder, 'Shipped' || CASE o_orderstatus WHEN 'F' THEN 'Product' ELSE '' END || o_orderkey || '.xls' AS file_name FROM orders)"""


def _listing(spark, sf):
    folder = F.when(F.col("o_orderpriority") == "1-URGENT", "Job Release 2/x").when(F.col("o_orderpriority") == "2-HIGH", "Forms").otherwise("notes")
    name = F.concat(F.lit("Shipped"), F.when(F.col("o_orderstatus") == "F", "Product").otherwise(""), F.col("o_orderkey"), F.lit(".xls"))
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("job"), "o_orderkey", folder.alias("subfolder"), name.alias("file_name"), F.col("o_orderkey").alias("modificationTime"))


for _required, _where in ((True, "contains(lower(subfolder), 'release')"), (False, "contains(lower(subfolder), 'release') OR job NOT IN (SELECT job FROM f WHERE contains(lower(subfolder), 'release'))")):
    def _release(spark, sf, required=_required):
        return files.release_files(_listing(spark, sf), "job", required=required).select("job", "o_orderkey", "subfolder")

    query(f"s13_release_files_{'required' if _required else 'or_all'}", f"WITH {_LIST_SQL} SELECT job, o_orderkey, subfolder FROM f WHERE {_where}")(_release)


@query("s12_skipped_folders", f"WITH {_LIST_SQL} SELECT o_orderkey, subfolder FROM f WHERE subfolder <> 'Forms'")
def _(spark, sf):
    return files.without_folders(_listing(spark, sf)).select("o_orderkey", "subfolder")


@query("s11_latest_file", f"WITH {_LIST_SQL} SELECT arg_max(file_name, o_orderkey) AS file_name FROM f WHERE starts_with(file_name, 'ShippedProduct')")
def _(spark, sf):
    """The newest file of the first pattern that has any."""
    return files.latest_file(_listing(spark, sf), ["ShippedNothing*.xls", "ShippedProduct*.xls", "Shipped*.xls"], path="file_name")


@query("s16_export_projection", f"SELECT {CODE_SQL} AS code, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS place FROM customer WHERE ({CODE_SQL}) < 'F'")
def _(spark, sf):
    code = customer_code()
    rows = table(spark, sf, "customer").select(F.concat(F.lit(" "), F.lower(code), F.lit("- x")).alias("code"), F.concat(F.col("c_name"), F.lit(" ")).alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("place"), "c_acctbal")
    return tabular.export_projection(rows, "code", ["name", "place"], "[A-E][A-Z0-9]{2}")


@query("f02_known_systems", "SELECT CASE l_returnflag WHEN 'A' THEN 'erp_qb' WHEN 'R' THEN 'erp_fb' END AS system, count(*) AS rows FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1")
def _(spark, sf):
    """rows of systems without a label are dropped."""
    label = F.when(F.col("l_returnflag") == "A", "QuickBooks").when(F.col("l_returnflag") == "R", "Fishbowl").otherwise("Ledger")
    rows = table(spark, sf, "lineitem").select(label.alias("label"))
    return resolve.known_systems(rows, "label").groupBy("system").agg(F.count("*").alias("rows"))


@query("s15_lookup_table", "SELECT s_suppkey, n_name AS nation, CASE WHEN s_nationkey % 2 = 0 THEN n_name ELSE '?' END AS even_nation FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(spark, sf):
    """Lookup tables written as CSV and loaded once; a missing key finds nothing."""
    path, nations = scratch(spark, "s15"), table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.concat(F.lit(" "), "n_name").alias("name"))
    tables.write_csv(nations, f"{path}/all", ["key", "name"])
    tables.write_csv(nations.where("key % 2 = 0"), f"{path}/even", ["key", "name"])
    every, even = (tabular.read_lookup(spark, f"{path}/{p}", "key", "name") for p in ("all", "even"))
    key = F.col("s_nationkey").cast("string")
    return table(spark, sf, "supplier").select("s_suppkey", lookup(every, key).alias("nation"), F.coalesce(lookup(even, key), F.lit("?")).alias("even_nation"))


# ---------------------------------------------------------------- locations of two sources

def _observed(spark, sf):
    """Customers' written places from one source, their nation and region from another."""
    written = places(spark, sf)
    own = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    melted = resolve.melt(written, "c_custkey", "bom_union", {f: (F.col(f), F.concat(F.lit("raw "), F.col(f))) for f in ("city", "state", "zip")}, "c_custkey").unionByName(
        resolve.melt(own, "c_custkey", "dispatch", {"city": (F.col("n_name"), F.col("n_name")), "state": (F.concat(F.lit("R"), F.col("n_regionkey")), F.col("n_name"))}, "c_custkey"))
    trust = F.when(F.col("source") == "bom_union", 0.5).otherwise(0.47)
    return resolve.count_observations(melted).withColumn("trust", trust)


_LOC_SQL = PLACE_SQL + """, o AS (SELECT p.c_custkey, CAST(p.c_custkey AS VARCHAR) AS entity_key, p.city, p.state, p.zip, n_name, 'R' || n_regionkey AS region, zp.city AS zip_city, zp.county AS zip_county
  FROM p JOIN customer c ON p.c_custkey = c.c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN zp ON p.zip = zp.zip)"""


@query("a33_location_matrix", f"""WITH {_LOC_SQL} SELECT entity_key, coalesce(city, n_name) AS confirmed_city, coalesce(state, region) AS confirmed_state, zip AS confirmed_zip, CASE WHEN city <> n_name THEN 'CONFLICT' ELSE 'AGREE' END AS city_status,
  CASE WHEN state <> region THEN 'CONFLICT' ELSE 'AGREE' END AS state_status, zip_city, zip_county, city AS bom_union_city, state AS bom_union_state, n_name AS dispatch_city, region AS dispatch_state FROM o""")
def _(spark, sf):
    obs = _observed(spark, sf)
    matrix = report.location_matrix(obs, resolve.vote(obs), zip_points(gazetteer(spark, sf), "last"), ["city", "state"], ["bom_union", "dispatch"])
    return matrix.drop("confirmed_project_name", "street_address")


@query("v02_city_extras", f"WITH {_LOC_SQL} SELECT entity_key, coalesce(city, n_name) AS winner, 'raw ' || city AS raw_bom, zip_county, '' AS county_flag FROM o")
def _(spark, sf):
    obs = _observed(spark, sf)
    won = resolve.vote(obs)
    listed = report.city_extras(won.where(F.col("field") == "city"), obs, zip_points(gazetteer(spark, sf), "last"), won, "bom_union")
    return listed.select("entity_key", "winner", "raw_bom", "zip_county", "county_flag")
