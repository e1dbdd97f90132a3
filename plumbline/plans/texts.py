"""Queries: document-text jobs.

Documents are written as lines from the rows of a table - one document per brand or customer - and
parsed back, so the SQL side is the table itself. Where prose will do, the whole of ``documents`` and
``conversations`` is read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.operators import text as tx
from plumbline.operators.scale import in_blocks, spread
from plumbline.sinks import pages
from plumbline.sources.files import cell_texts, front_matter, placed_cells

from .base import query, table

# A part opens a category when its size is a multiple of five; size 50 ends the list.
CATEGORIES = {"ECONOMY": "Precast", "SMALL": "Joint Seal", "LARGE": "Frame & Ring", "STANDARD": "Miscellaneous", "PROMO": "Pipe Fittings"}
_CAT = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORIES.items()) + " ELSE 'Hardware' END"


def item_lines(spark, sf):
    """One document per brand, one line per part, in part order."""
    own = F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv])
    category = F.coalesce(F.try_element_at(own, F.col("p_type")), F.lit("Hardware"))
    body = F.concat(F.col("p_size"), F.lit(" MHB"), F.col("p_partkey"), F.lit(" "), F.col("p_name"), F.lit("  1,"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))
    line = (
        F.when(F.col("p_size") == 50, F.lit("  Total Precast Weight 9,999"))
        .when(F.col("p_size") % 5 == 0, F.concat(F.lit(" "), category, F.lit("  "), body)).otherwise(F.concat(F.lit("   "), body))
    )
    return table(spark, sf, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("line_no"), line.alias("line"))


ITEMS_SQL = f"""l AS (SELECT *, CASE WHEN p_size % 5 = 0 AND p_size <> 50 THEN {_CAT} END AS own FROM part),
s AS (SELECT *, last_value(own IGNORE NULLS) OVER w AS category, count(own) OVER w AS started, count(CASE WHEN p_size = 50 THEN 1 END) OVER w AS stopped FROM l WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)),
items AS (SELECT p_brand AS doc_id, p_partkey AS line_no, category, CAST(p_size AS VARCHAR) AS quantity, 'MHB' || p_partkey AS part_number,
  CASE WHEN category = 'Precast' THEN p_name ELSE p_name || '  1,' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') END AS description,
  CASE WHEN category = 'Precast' THEN '1' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') ELSE '' END AS weight_lbs FROM s WHERE started > 0 AND stopped = 0)"""


@query("t01_line_items", f"WITH {ITEMS_SQL} SELECT * FROM items")
def _(spark, sf):
    """The category is carried along each document in blocks of lines."""
    return tx.line_items(item_lines(spark, sf))


@query("t16_extraction_quality", f"WITH {ITEMS_SQL} SELECT doc_id, count(*) AS items, count(CASE WHEN category = 'Precast' THEN 1 END) AS precast, count(CASE WHEN category = 'Precast' AND weight_lbs = '' THEN 1 END) AS no_weight FROM items GROUP BY 1")
def _(spark, sf):
    return tx.extraction_quality(tx.line_items(item_lines(spark, sf)))


@query("t03_garbled_weight", "SELECT p_partkey, '6' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS weight FROM part")
def _(spark, sf):
    """6,100 written into a word, digit by digit."""
    d = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")
    at = lambda i: F.substring(d, i, 1)
    word = F.concat(F.col("p_name"), F.lit(" TROUG6H,I"), at(1), F.lit("N"), at(2), F.lit("G"), at(3), F.lit(" 48 IN"))
    return table(spark, sf, "part").select("p_partkey", tx.garbled_weight(word).alias("weight"))


@query("t02_table_items", f"""WITH l AS (SELECT *, CASE WHEN p_size % 5 = 0 THEN CASE p_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORIES.items() if v != 'Pipe Fittings')} ELSE 'Hardware' END END AS own FROM part)
SELECT p_brand AS doc_id, p_partkey AS row_no, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey), '') AS category, CAST(p_size AS VARCHAR) AS quantity, 'MHB' || p_partkey AS part_number, p_name AS description,
  CAST(p_partkey AS VARCHAR) AS weight_lbs FROM l WHERE p_brand IN (SELECT p_brand FROM l WHERE own IS NOT NULL)""")
def _(spark, sf):
    own = F.create_map(*[F.lit(x) for kv in CATEGORIES.items() if kv[1] != "Pipe Fittings" for x in kv])
    category = F.coalesce(F.try_element_at(own, F.col("p_type")), F.lit("Hardware"))
    rest = [F.col("p_size").cast("string"), F.concat(F.lit("MHB"), F.col("p_partkey")), F.col("p_name"), F.format_number("p_partkey", 0)]
    cells = F.when(F.col("p_size") % 5 == 0, F.array(category, *rest)).otherwise(F.array(*rest))
    return tx.table_items(table(spark, sf, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("row_no"), cells.alias("cells")))


def section_lines(spark, sf):
    """One document per customer; an order is a section header, an item and a wrapped line."""
    o = table(spark, sf, "orders")
    last = F.when(F.col("o_orderstatus") == "P", F.lit("Total $9")).otherwise(F.concat(F.lit("(more "), F.col("o_orderstatus"), F.lit(")")))
    parts = F.array(
        F.concat(F.lit("Structure ID: S-"), F.col("o_orderkey"), F.lit(" 1 of 2")),
        F.concat(F.year("o_orderdate"), F.lit(" MHS4848 "), F.col("o_orderpriority"), F.lit(" $1,200.00")), last, F.lit("tail"))
    return o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey"), F.posexplode(parts).alias("pos", "line")).select(
        "doc_id", (F.col("o_orderkey") * 4 + F.col("pos")).alias("line_no"), "line")


@query("t04_sections", """SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS section_no, 'S-' || o_orderkey AS structure_name, o_orderkey * 4 + 1 AS line_no, CAST(year(o_orderdate) AS VARCHAR) AS quantity,
  'MHS4848' AS part_number, o_orderpriority || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' more ' || o_orderstatus || ' tail' END AS description, 'Precast' AS category FROM orders""")
def _(spark, sf):
    """T04, T05, W10, C23."""
    return tx.section_items(section_lines(spark, sf))


@query("t06_word_items", """SELECT p_brand AS doc_id, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS section_no, p_name AS structure_name, (p_partkey // 50) * 100000 + (p_partkey % 50) * 10 + 5 AS line_no, b AS band, CAST(p_size AS VARCHAR) AS quantity,
  CASE b WHEN 1 THEN 'MHB4848' ELSE 'JM12' END AS part_number, p_type AS description, CASE b WHEN 1 THEN 'Precast' ELSE 'Joint Seal' END AS category FROM part, (VALUES (1), (2)) v(b)""")
def _(spark, sf):
    """A priced line names a structure, the line below it has an item in each column."""
    w = lambda dy, x, t: F.struct((F.col("y0") + dy + 0.2).alias("y"), F.lit(float(x)).alias("x"), t.alias("text"))
    words = F.filter(F.array(
        w(0, 80, F.split("p_name", " ")[0]), w(0, 150, F.get(F.split("p_name", " "), F.lit(1))), w(0, 500, F.lit("$1,000")),
        w(5, 80, F.col("p_size").cast("string")), w(5, 110, F.lit("MHB4848")), w(5, 160, F.col("p_type")),
        w(5, 320, F.col("p_size").cast("string")), w(5, 350, F.lit("JM12")), w(5, 400, F.col("p_type"))), lambda x: x["text"].isNotNull())
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("doc_id"), F.floor(F.col("p_partkey") / 50).alias("page"), ((F.col("p_partkey") % 50) * 10).alias("y0"), "p_partkey", "p_name", "p_type", "p_size")
    return tx.word_items(rows.select("doc_id", "page", F.inline(words)))


@query("t07_structure_export", """SELECT CAST(p_brand AS VARCHAR) AS doc_id, p_partkey AS row_no, p_name AS structure_name, CASE p_type WHEN 'ECONOMY' THEN 'Precast' WHEN 'SMALL' THEN 'Connectors' ELSE 'Miscellaneous' END AS category, CAST(p_size AS VARCHAR) AS quantity,
  'MHB' || p_partkey AS part_number, p_type AS description, CAST(p_partkey AS VARCHAR) AS weight_lbs FROM part WHERE p_type <> 'PROMO'""")
def _(spark, sf):
    """Sparse cells are put in place first; holes and x-names are left out."""
    kind = F.when(F.col("p_type") == "ECONOMY", "StackElement").when(F.col("p_type") == "SMALL", "Connector").when(F.col("p_type") == "PROMO", "Hole").otherwise("MiscItem")
    c = lambda i, v: F.struct(F.struct(v.cast("string").alias("_VALUE")).alias("Data"), (F.lit(i) if i else F.lit(None)).cast("bigint").alias("_ss:Index"))
    raw = F.array(c(None, F.col("p_name")), c(3, kind), c(None, F.concat(F.lit("MHB"), F.col("p_partkey"))), c(6, F.col("p_type")), c(None, F.col("p_size")), c(None, F.format_number("p_partkey", 0)))
    rows = spread(table(spark, sf, "part"), "p_partkey").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("row_no"), cell_texts(placed_cells(raw)).alias("cells"))
    return tx.structure_export(rows)[1]


@query("t07_export_header", """SELECT p_brand AS doc_id, arg_min(p_name, p_partkey) AS job_name, arg_min('N' || p_partkey, p_partkey) AS job_number, arg_min(p_type, p_partkey) AS location, '' AS contractor, '3/7/2024' AS release_date FROM part GROUP BY 1""")
def _(spark, sf):
    cells = F.array(F.lit("Job Name:"), F.lit(""), F.col("p_name"), F.lit("Job Number:"), F.concat(F.lit("N"), F.col("p_partkey")), F.lit("Location"), F.col("p_type"), F.lit("Reported On"), F.lit("2024-03-07T10:00:00"))
    return tx.structure_export(spread(table(spark, sf, "part"), "p_partkey").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("row_no"), cells.alias("cells")))[0]


def job_lines(spark, sf):
    """One page of header, schedule and total per customer."""
    c = spread(table(spark, sf, "customer"), "c_custkey")
    lines = F.array(
        F.lit("Bill of Material"), F.concat(F.lit("Job Name: "), F.col("c_name"), F.lit("     Job Number: J"), F.col("c_custkey")), F.concat(F.lit("Location:  "), F.col("c_mktsegment")),
        F.concat(F.lit("MH-"), F.col("c_custkey"), F.lit("  Ship Date 1/1/2024")), F.lit("Contractor:"), F.lit("Opening Schedule"), F.concat(F.lit(" 1   24\" Clay   "), F.col("c_mktsegment"), F.lit("   N/A")), F.lit("noise"),
        F.concat(F.lit(" 2   8\" PVC   Boot   "), F.col("c_custkey"), F.lit(" IN")), F.lit("Quantity   Part Number"), F.lit(" 3   8\" PVC   Boot   12"), F.concat(F.lit("Total Precast Weight  1,"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0")))
    return c.select(F.col("c_custkey").alias("doc_id"), F.posexplode(lines).alias("line_no", "line"))


@query("t08_header_fields", "SELECT c_custkey AS doc_id, c_name AS job_name, 'J' || c_custkey AS job_number, c_mktsegment AS location, '' AS contractor, '' AS phone FROM customer")
def _(spark, sf):
    return tx.header_fields(job_lines(spark, sf))


@query("t08_quote_header", "SELECT c_custkey AS doc_id, c_name AS job_name, '3/4/2024' AS release_date, 'Reno, NV' AS location FROM customer")
def _(spark, sf):
    """T08, N38."""
    lines = F.array(F.lit("QQUUOOTTEE"), F.concat(F.lit("Ref: "), F.col("c_name")), F.lit("Quote Date: 3/4/2024 x"), F.lit("Reno, NV"), F.lit("Ref: later"))
    return tx.quote_header(spread(table(spark, sf, "customer"), "c_custkey").select(F.col("c_custkey").alias("doc_id"), F.posexplode(lines).alias("line_no", "line")))


@query("t09_opening_schedule", """SELECT c_custkey AS doc_id, 6 AS line_no, '1' AS quantity, '24" Clay' AS pipe_size, c_mktsegment AS connector, 'N/A' AS hole_size FROM customer
UNION ALL SELECT c_custkey, 8, '2', '8" PVC', 'Boot', c_custkey || ' IN' FROM customer""")
def _(spark, sf):
    return tx.opening_schedule(job_lines(spark, sf))


@query("t10_structure_names", "SELECT c_custkey AS doc_id, 'MH-' || c_custkey AS structure_name FROM customer")
def _(spark, sf):
    return tx.structure_names(job_lines(spark, sf))


@query("t11_total_weight", "SELECT c_custkey AS doc_id, CAST(1000 + c_custkey % 1000 AS INT) AS total_precast_weight FROM customer")
def _(spark, sf):
    return tx.total_weight(job_lines(spark, sf))


@query("t11_release_date", "SELECT o_custkey AS doc_id, arg_max(strftime(o_orderdate, '%-m/%-d/%Y'), o_orderkey) AS release_date FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(spark, sf):
    """Only dates in the bottom right corner count, the lowest one wins."""
    o = table(spark, sf, "orders")
    top = o.agg(F.max("o_orderkey").alias("m")).scalar()
    words = o.select(F.col("o_custkey").alias("doc_id"), (900 + 90 * F.col("o_orderkey") / top).alias("y"), F.when(F.col("o_orderstatus") == "F", 700.0).otherwise(100.0).alias("x"),
                     F.lit(1000.0).alias("width"), F.lit(1000.0).alias("height"), F.date_format("o_orderdate", "M/d/yyyy").alias("text"))
    return tx.release_date(words)


@query("t12_customer_form", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ', TX' WHEN 1 THEN 'Reno, NV' ELSE '' END AS location, CASE c_custkey % 3 WHEN 0 THEN 'NCF Job Site' WHEN 1 THEN 'NCF Billing' ELSE '' END AS location_source,
  CASE c_custkey % 3 WHEN 0 THEN '7' || c_custkey ELSE '' END AS zipcode, c_name AS job_name FROM customer""")
def _(spark, sf):
    """T12, N41."""
    k = F.col("c_custkey") % 3
    site = F.when(k == 0, F.concat(F.lit("Job Site City:  "), F.col("c_mktsegment"), F.lit(", Clark County  Job Site State:  Texas  Job Site Zip Code:  7"), F.col("c_custkey"), F.lit("  "))).otherwise("")
    bill = F.when(k < 2, F.lit("Billing City:  Reno  Billing State:  NV")).otherwise("")
    forms = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("Name of Job:  "), F.col("c_name"), F.lit("  "), site, bill).alias("text"))
    return tx.customer_form(forms).select("c_custkey", "location", "location_source", "zipcode", "job_name")


@query("t13_build_rows", """SELECT p_partkey AS doc_id, 'MHB4848' AS part_number, '48" Base 48"' AS part_name, 'Base' AS part_type, CASE p_size % 3 WHEN 0 THEN p_name || ', TX' WHEN 1 THEN 'Reno, NV' ELSE 'Elko, NV' END AS job_location,
  CASE p_size % 3 WHEN 0 THEN 'BOM' WHEN 1 THEN 'NCF Job Site' ELSE 'Manual' END AS location_source, CASE p_size % 3 WHEN 0 THEN '2024' ELSE '2020' END AS year_release, p_name AS project_name FROM part""")
def _(spark, sf):
    """T13, J19, R10."""
    p, k = table(spark, sf, "part"), F.col("p_size") % 3
    items = p.select(F.col("p_partkey").alias("doc_id"), F.col("p_partkey").alias("job_code"), F.lit("x.pdf").alias("file_name"), F.lit(2020).alias("drive_year"), F.lit("MH-1").alias("structure_name"),
                     F.lit("MHB4848").alias("part_number"), F.lit("BASE").alias("description"), F.lit("1").alias("quantity"), F.lit("").alias("weight_lbs"), F.lit("Precast").alias("category"))
    headers = p.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("job_name"), F.when(k == 0, F.concat("p_name", F.lit(", Texas"))).otherwise("").alias("location"), F.lit("").alias("contractor"),
                       F.when(k == 0, "3/4/2024").otherwise("").alias("release_date"))
    forms = p.where(k == 1).select(F.col("p_partkey").alias("job_code"), F.lit("Reno, Nevada").alias("location"), F.lit("NCF Job Site").alias("location_source"), F.lit("89501").alias("zipcode"), F.lit("").alias("job_name"), F.lit("C").alias("customer"))
    overrides = p.select(F.col("p_partkey").alias("job_code"), F.lit("Elko, NV").alias("location"), F.lit("Manual").alias("source"))
    return tx.build_rows(items, headers, forms, overrides).select("doc_id", "part_number", "part_name", "part_type", "job_location", "location_source", "year_release", "project_name")


@query("t14_flatten", """SELECT p_partkey, p_name AS job_name, p_brand AS location, p_type AS part_number, CAST(p_size AS VARCHAR) AS quantity FROM part WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, p_name, p_brand, 'extra', '1' FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, p_name, p_brand, NULL, NULL FROM part WHERE p_size % 2 = 1""")
def _(spark, sf):
    """Nested header and items as flat rows; a document without items keeps one."""
    item = lambda n, q: F.struct(n.alias("part_number"), q.alias("quantity"))
    items = F.when(F.col("p_size") % 2 == 0, F.array(item(F.col("p_type"), F.col("p_size").cast("string")), item(F.lit("extra"), F.lit("1"))))
    nested = table(spark, sf, "part").select("p_partkey", F.struct(F.col("p_name").alias("job_name"), F.col("p_brand").alias("location")).alias("header"), items.alias("items"))
    return tx.flatten(nested, "header", "items")


@query("t17_shop_drawing", """SELECT p_brand AS doc_id, 'MH-' || p_size AS structure_name, p_partkey AS page, 'Precast' AS category, '1' AS quantity, p_name AS part_number FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT p_brand, 'MH-' || p_size, min(p_partkey), '', '', '' FROM part GROUP BY p_brand, p_size HAVING count(CASE WHEN p_type <> 'SMALL' THEN 1 END) = 0""")
def _(spark, sf):
    """A page per part; structures without any item on their pages keep a blank one."""
    p = table(spark, sf, "part")
    text = F.array(F.lit("Shop drawing set"), F.concat(F.lit("MH-"), F.col("p_size")))
    lines = p.select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("page"), F.posexplode(text).alias("line_no", "line"))
    items = p.where(F.col("p_type") != "SMALL").select(
        F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("page"), F.lit(0).alias("row_no"), F.lit("Precast").alias("category"), F.lit("1").alias("quantity"),
        F.col("p_name").alias("part_number"), F.lit("").alias("description"), F.lit("").alias("weight_lbs"))
    return tx.shop_drawing(lines, items)[1].select("doc_id", "structure_name", "page", "category", "quantity", "part_number")


# ---------------------------------------------------------------- prose

_RX = lambda patterns: "(?i)" + "|".join(f"(?:{p})" for p in patterns)
_LINES_SQL = "l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS t FROM documents)"
_STRUCT_SQL = f"t <> '' AND NOT regexp_matches(t, '{_RX(K.NON_STRUCTURE_PATTERNS)}') AND regexp_matches(t, '{_RX(K.STRUCTURE_PATTERNS)}')"


@query("f06_structure_lines", f"WITH {_LINES_SQL} SELECT doc_id, count(*) AS lines, count(CASE WHEN {_STRUCT_SQL} THEN 1 END) AS structure_lines FROM l GROUP BY 1")
def _(spark, sf):
    """F06 over every line of every document."""
    lines = tx.explode_lines(table(spark, sf, "documents"), "doc_id", "text")
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(tx.is_structure_name("line")).alias("structure_lines"))


@query("a24_skipped_prefixes", f"""WITH {_LINES_SQL}, k AS (SELECT t, CASE WHEN regexp_matches(t, '^[A-Za-z]') THEN upper(regexp_extract(t, '^([A-Za-z]+)', 1)) ELSE '(non-alpha)' END AS prefix FROM l WHERE t <> '' AND NOT ({_STRUCT_SQL})),
e AS (SELECT prefix, string_agg(t, ', ' ORDER BY t) AS examples FROM (SELECT DISTINCT prefix, t FROM k QUALIFY dense_rank() OVER (PARTITION BY prefix ORDER BY t) <= 3) GROUP BY 1)
SELECT k.prefix, count(*) AS n, any_value(examples) AS examples FROM k JOIN e ON k.prefix = e.prefix GROUP BY 1""")
def _(spark, sf):
    """Lines no structure pattern fits, by their leading letters; three examples are the report."""
    lines = tx.explode_lines(table(spark, sf, "documents"), "doc_id", "text").withColumn("t", F.trim("line"))
    return tx.skipped_prefixes(lines.where((F.col("t") != "") & ~tx.is_structure_name("t")), "t")


@query("w09_forward_fill", """WITH u AS (SELECT *, CASE WHEN role = 'user' THEN turn END AS ut FROM conversations)
SELECT conv_id, turn, last_value(ut IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS last_user_turn, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS exchange FROM u""")
def _(spark, sf):
    """W09, W10 on conversations: the last user turn carried forward, exchanges numbered."""
    is_user = F.col("role") == "user"
    rows = in_blocks(table(spark, sf, "conversations"), ["conv_id"], "turn", fills={"last_user_turn": F.when(is_user, F.col("turn"))},
                     sums={"exchange": F.when(is_user, 1).otherwise(0).cast("bigint")}, width=4)
    return rows.select("conv_id", "turn", "last_user_turn", "exchange")


# ---------------------------------------------------------------- pages

def job_pages(spark, sf):
    rows = spread(table(spark, sf, "customer"), "c_custkey").withColumn("job_code", F.concat(F.lit("J"), F.col("c_custkey")))
    front = {"job_code": F.col("job_code"), "customer": pages.plain(F.concat("c_name", F.lit(": "), "c_mktsegment")), "city": pages.linked(F.col("c_mktsegment")), "erp": F.lit(None)}
    return pages.render_pages(rows, "job_code", F.col("c_name"), front, F.lit("## Shipped Items\n"))


_PAGE_SQL = """p AS (SELECT 'J' || c_custkey AS job_code, 'J' || c_custkey || ' - ' || c_name || '.md' AS file_name,
  '---' || chr(10) || 'job_code: J' || c_custkey || chr(10) || 'customer: "' || c_name || ': ' || c_mktsegment || '"' || chr(10) || 'city: "[[' || c_mktsegment || ']]"' || chr(10) || 'erp: ' || chr(10) || '---' || chr(10) || chr(10)
  || '# J' || c_custkey || ' - ' || c_name || chr(10) || chr(10) || '## Shipped Items' || chr(10) AS content FROM customer)"""


@query("k09_pages", f"WITH {_PAGE_SQL} SELECT * FROM p")
def _(spark, sf):
    return job_pages(spark, sf)


@query("k10_sections", f"""WITH {_PAGE_SQL}, o AS (SELECT o_custkey, string_agg(DISTINCT '- ' || o_orderpriority, chr(10) ORDER BY '- ' || o_orderpriority) AS items FROM orders GROUP BY 1),
b AS (SELECT 'J' || o_custkey AS job_code, chr(10) || '## Structure Registry' || chr(10) || chr(10) || '### BOM Structures' || chr(10) || items || chr(10) AS block FROM o)
SELECT p.job_code, content || CASE WHEN block IS NULL THEN '' ELSE chr(10) || block END AS content, CASE WHEN block IS NULL THEN 'unchanged' ELSE 'updated' END AS state FROM p LEFT JOIN b ON p.job_code = b.job_code""")
def _(spark, sf):
    """The priorities of its orders as a section of the customer's page."""
    done = table(spark, sf, "orders").groupBy(F.concat(F.lit("J"), F.col("o_custkey")).alias("job_code")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("p"))
    sections = done.select("job_code", pages.bullet_section("BOM Structures", F.col("p")).alias("section"))
    return pages.append_section(job_pages(spark, sf), sections, "job_code", "Structure Registry")


@query("s09_front_matter", "SELECT 'J' || c_custkey AS job_code, c_name || ': ' || c_mktsegment AS customer, c_mktsegment AS city, CAST(NULL AS VARCHAR) AS erp FROM customer")
def _(spark, sf):
    """The pages written above, read back."""
    m = front_matter("content")
    rows = job_pages(spark, sf).withColumn("m", m)
    return rows.select(*[F.try_element_at("m", F.lit(k)).alias(k) for k in ("job_code", "customer", "city", "erp")])
