"""Queries: cleaning expressions on whole tables.

Raw text is written from a table's columns in the shapes the expressions have to undo, so the SQL
side states the clean value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import clean
from plumbline.sinks.pages import plain

from .base import CODE_SQL, customer_code, query, table

STATES = ["Texas", "California", "Florida", "Nevada", "Arizona"]
CODES = ["TX", "CA", "FL", "NV", "AZ"]
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _pick(values, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))


def _customers(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.withColumns({"kind": F.col("c_custkey") % 6, "st": _pick(STATES, F.col("n_regionkey")), "cd": _pick(CODES, F.col("n_regionkey"))})


_CUST_SQL = f"c AS (SELECT *, c_custkey % 6 AS kind, {_LIST(STATES)}[n_regionkey + 1] AS st, {_LIST(CODES)}[n_regionkey + 1] AS cd FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query("n03_places", f"""WITH {_CUST_SQL} SELECT c_custkey, CASE kind WHEN 0 THEN n_name WHEN 2 THEN n_name || ' COUNTY' WHEN 4 THEN upper(st) END AS city,
  CASE kind WHEN 0 THEN n_name WHEN 1 THEN '=VLOOKUP(A1)' WHEN 2 THEN n_name WHEN 3 THEN cd WHEN 4 THEN upper(st) END AS county, kind = 2 AS is_county,
  CASE WHEN kind IN (3, 4) THEN cd END AS state, CASE kind WHEN 3 THEN cd WHEN 4 THEN cd END AS state_any, CASE kind WHEN 0 THEN n_name || ' ' || cd WHEN 1 THEN '=VLOOKUP(A1)' WHEN 2 THEN n_name || ' COUNTY' WHEN 3 THEN cd WHEN 4 THEN upper(st) END AS simple,
  CASE WHEN kind = 3 THEN cd END AS two FROM c""")
def _(spark, sf):
    """N03-N08."""
    k = F.col("kind")
    raw = (
        F.when(k == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(",  "), F.col("cd"))).when(k == 1, "=VLOOKUP(A1)")
        .when(k == 2, F.concat("n_name", F.lit("  County"))).when(k == 3, F.col("cd")).when(k == 4, F.col("st"))
    )
    return _customers(spark, sf).withColumn("raw", raw).select(
        "c_custkey", clean.norm_city("raw").alias("city"), clean.norm_county("raw").alias("county"), clean.is_county("raw").alias("is_county"),
        clean.norm_state("raw").alias("state"), clean.state_or_passthrough("raw").alias("state_any"), clean.norm_city_simple("raw").alias("simple"),
        clean.state_two_letters("raw").alias("two"))


@query("n09_zips", """SELECT c_custkey, CASE kind WHEN 0 THEN z WHEN 1 THEN z END AS zip, CASE kind WHEN 0 THEN z WHEN 1 THEN z WHEN 3 THEN '00000' END AS zip_zero,
  nullif(lpad(CAST(c_custkey AS VARCHAR), 5, '0'), '00000') AS zip_number, CASE kind WHEN 0 THEN z WHEN 1 THEN z WHEN 2 THEN CAST(c_custkey AS VARCHAR) WHEN 3 THEN '00000' WHEN 4 THEN 'n/a' END AS five
FROM (SELECT c_custkey, c_custkey % 6 AS kind, CAST(10000 + c_custkey AS VARCHAR) AS z FROM customer)""")
def _(spark, sf):
    """N09, N47.

    A number that is no ZIP code is too short, or has its four further digits run on. From 90,000 customers the SQL
    calls numbers of six digits codes, which N09 refuses.
    """
    k, z, own = F.col("c_custkey") % 6, (10000 + F.col("c_custkey")).cast("string"), F.col("c_custkey").cast("string")
    no_code = F.when(F.length(own) < 5, own).otherwise(F.concat(own, F.lit("1234")))
    raw = F.when(k == 0, z).when(k == 1, F.concat(F.lit(" "), z, F.lit("-1234"))).when(k == 2, no_code).when(k == 3, "00000").when(k == 4, "n/a")
    raw_four = F.col("c_custkey")
    return table(spark, sf, "customer").withColumn("raw", raw).select(
        "c_custkey", clean.norm_zip("raw").alias("zip"), clean.norm_zip("raw", allow_zero=True).alias("zip_zero"),
        clean.norm_zip(raw_four, numeric=True).alias("zip_number"), clean.zip_five("raw").alias("five"))


@query("n10_keys", f"""WITH k AS (SELECT c_custkey, c_custkey % 5 AS kind, {CODE_SQL} AS code FROM customer)
SELECT c_custkey, CASE kind WHEN 0 THEN code WHEN 1 THEN code || 'Z' WHEN 2 THEN substr(code, 1, 1) || ' ' || substr(code, 2) END AS any_key, CASE WHEN kind = 0 THEN code END AS three,
  CASE WHEN kind IN (0, 2) AND code < 'F' THEN code END AS lettered, CASE WHEN kind IN (0, 1, 2) AND code < 'F' THEN code END AS lettered_prefix FROM k""")
def _(spark, sf):
    """One operator, four key domains."""
    code, kind = F.col("code"), F.col("c_custkey") % 5
    raw = (
        F.when(kind == 0, F.concat(F.lit(" "), F.lower(code))).when(kind == 1, F.concat(code, F.lit("z")))
        .when(kind == 2, F.concat(F.substring(code, 1, 1), F.lit(" "), F.substring(code, 2, 2))).when(kind == 3, "None").otherwise("")
    )
    rows = table(spark, sf, "customer").withColumn("code", customer_code()).withColumn("raw", raw)
    return rows.select("c_custkey", clean.job_code("raw").alias("any_key"), clean.three_letter_code("raw").alias("three"), clean.lettered_code("raw").alias("lettered"),
                       clean.lettered_code("raw", "prefix").alias("lettered_prefix"))


@query("n12_plants", """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'SS' WHEN 'N' THEN 'BC' ELSE 'TA' END AS code, CASE l_returnflag WHEN 'A' THEN CASE l_linestatus WHEN 'O' THEN 'PC/SS' ELSE 'SS' END WHEN 'N' THEN CASE l_linestatus WHEN 'O' THEN 'BC/PC' ELSE 'BC' END
    ELSE CASE l_linestatus WHEN 'O' THEN 'PC' END END AS codes, CASE l_returnflag WHEN 'A' THEN 'Sulphur Springs' WHEN 'N' THEN 'Boulder City' ELSE 'tampa' END AS name FROM lineitem""")
def _(spark, sf):
    """N12-N14."""
    f = F.col("l_returnflag")
    raw = F.when(f == "A", "Sulphur Springs ").when(f == "N", "boulder city").otherwise("tampa")
    many = F.when(F.col("l_linestatus") == "O", F.concat(raw, F.lit(" / pc"))).otherwise(raw)
    named = F.when(f == "A", "SULPHUR SPRINGS yard").otherwise(raw)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", clean.plant_code(raw).alias("code"), clean.plant_codes_multi(many).alias("codes"),
                                               clean.plant_by_prefix(named).alias("name"))


@query("n01_blank_tokens", """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'N' AS blank, CASE l_returnflag WHEN 'A' THEN l_linestatus END AS safe, CASE l_returnflag WHEN 'A' THEN l_linestatus WHEN 'R' THEN '=A1' END AS part,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 1 ELSE 0 END + 1 AS filled, CASE WHEN l_returnflag = 'A' THEN l_linestatus WHEN l_returnflag = 'R' THEN '=A1' ELSE '#missing' END AS first FROM lineitem""")
def _(spark, sf):
    """N01, N02, N11, N42, S05."""
    f = F.col("l_returnflag")
    raw = F.when(f == "A", F.concat(F.lit(" "), F.col("l_linestatus"))).when(f == "R", "=A1").otherwise("#missing")
    rows = table(spark, sf, "lineitem").withColumns({"raw": raw, "empty": F.when(f == "N", F.lit("  ")).otherwise(raw)})
    token_free = F.when(f == "N", F.lit("None")).otherwise(F.col("raw"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", clean.is_blank("raw").alias("blank"), clean.safe_text(token_free).alias("safe"), clean.norm_part_number("raw").alias("part"),
                       clean.filled_count("empty", "l_linestatus").alias("filled"), clean.first_non_blank("empty", "raw").alias("first"))


@query("n19_dates", """SELECT o_orderkey, CASE WHEN kind < 6 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed, CASE WHEN kind IN (0, 1, 6) AND kind <> 6 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso_or_us,
  CASE WHEN kind NOT IN (5, 6) THEN CAST(year(o_orderdate) AS INT) END AS year, CASE WHEN kind IN (0, 4) THEN CAST(year(o_orderdate) AS INT) WHEN kind = 5 THEN CAST(substr(CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR), 1, 4) AS INT) END AS lead_year
FROM (SELECT *, o_orderkey % 7 AS kind FROM orders)""")
def _(spark, sf):
    """Six written forms and a spreadsheet day number."""
    d, kind = F.col("d"), F.col("o_orderkey") % 7
    raw = (
        F.when(kind == 0, F.date_format(d, "yyyy-MM-dd")).when(kind == 1, F.date_format(d, "M/d/yyyy")).when(kind == 2, F.date_format(d, "MM-dd-yyyy"))
        .when(kind == 3, F.date_format(d, "dd-MMM-yyyy")).when(kind == 4, F.date_format(d, "yyyy/MM/dd"))
        .when(kind == 5, F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")).otherwise("soon")
    )
    rows = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date")).withColumn("raw", raw)
    timed = F.when(kind == 0, F.concat("raw", F.lit("T08:15:00"))).otherwise(F.col("raw"))
    to_text = lambda c: F.nullif(clean.date_key(c), F.lit(""))
    return rows.select("o_orderkey", to_text(clean.parse_date("raw")).alias("parsed"), to_text(clean.parse_iso_or_us(timed)).alias("iso_or_us"),
                       clean.year_in_text(F.when(kind != 5, F.col("raw"))).alias("year"), clean.leading_year("raw").alias("lead_year"))


@query("n16_year_month", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INT) END AS year, CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS INT) END AS month FROM orders")
def _(spark, sf):
    raw = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("spring 1997")
    return table(spark, sf, "orders").select("o_orderkey", clean.true_year_month(raw).alias("t")).select("o_orderkey", "t.*")


@query("n22_quantity", """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS BIGINT) WHEN 'N' THEN 1 ELSE 0 END AS qty,
  CASE WHEN CAST(l_quantity AS INT) IN (4, 5, 6, 7, 8, 10, 12, 16) THEN CAST(CAST(l_quantity AS INT) * 12 AS VARCHAR) END AS diameter FROM lineitem""")
def _(spark, sf):
    """N22, N23."""
    f, q = F.col("l_returnflag"), F.col("l_quantity")
    raw = F.when(f == "A", (q + 0.75).cast("string")).when((f == "N") & (F.col("l_linestatus") == "O"), "").when(f == "N", "few").otherwise("0.0")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", clean.quantity(raw).alias("qty"), clean.barrel_diameter((q * 12).cast("string")).alias("diameter"))


@query("n24_location", f"""WITH {_CUST_SQL} SELECT c_custkey, CASE WHEN kind IN (0, 1) THEN c_mktsegment || ', ' || n_name WHEN kind = 2 THEN n_name ELSE c_mktsegment END AS city, CASE WHEN kind IN (0, 1, 2) THEN cd END AS state,
  CASE WHEN kind IN (0, 1) THEN c_mktsegment || ', ' || n_name || ', ' || cd WHEN kind = 2 THEN n_name || ', ' || cd ELSE c_mktsegment END AS standard,
  CASE WHEN kind IN (0, 1) THEN c_mktsegment WHEN kind = 2 THEN n_name END AS first_city, CASE WHEN kind IN (0, 1) THEN n_name || ', ' || CASE kind WHEN 0 THEN st ELSE cd END WHEN kind = 2 THEN 'known' END AS first_state FROM c""")
def _(spark, sf):
    """N24-N26."""
    k = F.col("kind")
    base = F.concat_ws(", ", "c_mktsegment", "n_name")
    raw = F.when(k == 0, F.concat_ws(", ", base, "st")).when(k == 1, F.concat_ws(", ", base, "cd")).when(k == 2, F.concat_ws(",", "n_name", "st")).otherwise(F.col("c_mktsegment"))
    rows = _customers(spark, sf).withColumn("raw", raw)
    with_country = F.when(k == 0, F.concat("raw", F.lit(", usa"))).otherwise(F.col("raw"))
    return rows.select("c_custkey", clean.parse_location(with_country).alias("p"), clean.standard_location("raw").alias("standard"),
                       clean.split_location_first("raw", state=F.when(k == 2, F.lit("known"))).alias("f")).select(
        "c_custkey", "p.city", "p.state", "standard", F.col("f.city").alias("first_city"), F.col("f.state").alias("first_state"))


@query("n27_routed_location", f"""WITH {_CUST_SQL} SELECT c_custkey, 'city' AS field, n_name AS norm FROM c WHERE kind = 0 UNION ALL SELECT c_custkey, 'county', n_name FROM c WHERE kind = 1
UNION ALL SELECT c_custkey, 'state', cd FROM c WHERE kind IN (0, 1) UNION ALL SELECT c_custkey, 'street_address', '12 ' || n_name || ' Rd, Unit 5' FROM c WHERE kind = 2""")
def _(spark, sf):
    k = F.col("kind")
    raw = (
        F.when(k == 0, F.concat(F.lower("n_name"), F.lit(", "), F.col("st"))).when(k == 1, F.concat("n_name", F.lit(" County, "), F.col("cd")))
        .when(k == 2, F.concat(F.lit("12 "), F.col("n_name"), F.lit(" Rd, Unit 5"))).otherwise(F.col("n_name"))
    )
    return _customers(spark, sf).select("c_custkey", F.inline(clean.route_location(raw))).select("c_custkey", "field", "norm")


@query("n28_link_text", """SELECT page_id, 'Page ' || page_id AS shown, regexp_replace(url, '[\\\\/*?:"<>|]', '', 'g') AS file_name, CASE WHEN contains(url, ':') THEN '"' || url || '"' ELSE url END AS quoted FROM pages""")
def _(spark, sf):
    """N28, N30."""
    link = F.concat(F.lit('=HYPERLINK("'), F.col("url"), F.lit('", "Page '), F.col("page_id"), F.lit('")'))
    raw = F.when(F.col("url").contains("https"), link).otherwise(F.concat(F.lit(" Page "), F.col("page_id")))
    return table(spark, sf, "pages").select("page_id", clean.link_text(raw).alias("shown"), clean.safe_file_name("url").alias("file_name"), plain(F.col("url")).alias("quoted"))


@query("n39_text_tests", """SELECT p_partkey, contains(lower(p_name), lower(p_type)) OR contains(lower(p_type), lower(p_name)) AS either_way, CASE WHEN p_size % 3 <> 0 THEN p_size % 3 = 1 END AS same,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' of ' || upper(p_type[1]) || lower(p_type[2:]) AS title FROM part""")
def _(spark, sf):
    """N29, N39, N40."""
    third = F.col("p_size") % 3
    other = F.when(third == 1, F.concat(F.lit("  "), F.upper(F.regexp_replace("p_name", " ", "   ")))).when(third == 2, F.lit("x")).otherwise(F.lit(""))
    title = clean.title_words(F.concat_ws(" of ", "p_name", "p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", clean.has_either_way("p_name", "p_type").alias("either_way"), clean.same_words("p_name", other).alias("same"),
        title.alias("title"))


@query("n44_city_variants", f"""WITH {_CUST_SQL} SELECT c_custkey, CASE kind WHEN 0 THEN 'ST ' || n_name || '|SAINT ' || n_name WHEN 1 THEN 'FORT ' || n_name || '|FT ' || n_name WHEN 2 THEN 'MT ' || n_name || '|MOUNT ' || n_name ELSE n_name END AS forms,
  CASE WHEN kind = 3 THEN n_name ELSE n_name || CASE WHEN kind = 4 THEN ' West' ELSE '' END END AS no_county FROM c""")
def _(spark, sf):
    """N41, N44."""
    k = F.col("kind")
    city = F.when(k == 0, F.concat(F.lit("ST "), F.col("n_name"))).when(k == 1, F.concat(F.lit("FORT "), F.col("n_name"))).when(k == 2, F.concat(F.lit("MT "), F.col("n_name"))).otherwise(F.col("n_name"))
    text = F.when(k == 3, F.concat("n_name", F.lit(", Clark County, more"))).when(k == 4, F.concat("n_name", F.lit(" West"))).otherwise(F.col("n_name"))
    return _customers(spark, sf).select("c_custkey", F.array_join(clean.city_variants(city), "|").alias("forms"), clean.city_without_county(text).alias("no_county"))


DOCS = ["bom by structure {}.XML", "BOM by Structure {}.pdf", "{} -BOM Summary.pdf", "Shop Drawings {}.pdf", "quote {}.pdf", "photo {}.jpg", "{}_NCF.docx"]
LABELS = ["BOM by Structure XML", "BOM by Structure PDF", "BOM Summary PDF", "Shop Drawing PDF", "Quotation PDF", None, None]


def file_names(spark, sf):
    """Each order is a file; the name carries its date."""
    kind = (F.col("o_orderkey") % 7).cast("int")
    stamp = F.date_format("o_orderdate", "M.d.yy")
    name = F.concat(F.element_at(F.array(*[F.lit(d.split("{}")[0]) for d in DOCS]), kind + 1), stamp, F.element_at(F.array(*[F.lit(d.split("{}")[1]) for d in DOCS]), kind + 1))
    return table(spark, sf, "orders").withColumns({"file_name": name, "kind": kind})


FILES_SQL = f"""f AS (SELECT *, o_orderkey % 7 AS kind, {_LIST([d.split('{}')[0] for d in DOCS])}[CAST(o_orderkey % 7 AS INT) + 1] || strftime(o_orderdate, '%-m.%-d.%y') || {_LIST([d.split('{}')[1] for d in DOCS])}[CAST(o_orderkey % 7 AS INT) + 1] AS file_name,
  CASE o_orderkey % 7 {" ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(LABELS) if v)} END AS label FROM orders)"""


@query("n32_file_names", f"""WITH {FILES_SQL} SELECT o_orderkey, label, CAST(CASE WHEN label IS NULL THEN 99 WHEN kind = 4 THEN 5 ELSE kind END AS INT) AS priority, kind = 6 AS is_form, kind IN (1, 2) AS simple_bom,
  CASE WHEN kind = 6 THEN 0 ELSE CAST(2000 + CAST(strftime(o_orderdate, '%y') AS INT) AS INT) END AS y, CASE WHEN kind = 6 THEN 0 ELSE CAST(month(o_orderdate) AS INT) END AS m, CASE WHEN kind = 6 THEN 0 ELSE CAST(day(o_orderdate) AS INT) END AS d FROM f""")
def _(spark, sf):
    """N32-N34."""
    rows = file_names(spark, sf)
    date = clean.file_name_date("file_name")
    label = clean.classify_document("file_name")
    return rows.select("o_orderkey", label.alias("label"), clean.document_priority(label).alias("priority"), clean.is_customer_form("file_name").alias("is_form"),
                       clean.is_any_bom_pdf("file_name").alias("simple_bom"), date["y"].alias("y"), date["m"].alias("m"), date["d"].alias("d"))


@query("n35_folder_codes", f"""WITH k AS (SELECT *, {CODE_SQL} AS code, c_custkey % 4 AS kind FROM customer) SELECT c_custkey, CASE WHEN kind < 2 THEN code END AS folder, CASE WHEN kind < 2 THEN c_mktsegment ELSE '_' || c_mktsegment END AS title,
  CASE WHEN kind = 2 THEN c_name END AS contractor, code AS resolved, 'MH-' || c_custkey AS structure, CASE kind WHEN 0 THEN '2024' WHEN 1 THEN '2019' ELSE '2016' END AS year FROM k""")
def _(spark, sf):
    """N17, N35-N37."""
    k, code = F.col("c_custkey") % 4, customer_code()
    folder = F.when(k < 2, F.concat(code, F.lit("- "), F.col("c_mktsegment"))).otherwise(F.concat(F.lit("_"), F.col("c_mktsegment")))
    order = F.when(k == 2, F.concat(code, F.lit(" - "), F.col("c_name"), F.lit("_PO# 77.pdf"))).otherwise("notes.pdf")
    file_name = F.when(k == 2, F.concat(code, F.lit(" list.pdf"))).otherwise("list.pdf")
    job_number = F.when(k == 3, F.concat(F.lower(code), F.lit("-12"))).otherwise("")
    summary = F.concat(code, F.lit(" 3.14.19 Job "), F.col("c_mktsegment"), F.lit("-MH-"), F.col("c_custkey"), F.lit("-BOM Summary.pdf"))
    release = F.when(k == 0, "3/4/2024").when(k == 1, "soon")
    dated = F.when(k == 1, "x 3.14.19 y.pdf").otherwise("x.pdf")
    return table(spark, sf, "customer").select(
        "c_custkey", clean.folder_code(folder).alias("folder"), clean.folder_title(folder).alias("title"), clean.order_contractor(order).alias("contractor"),
        clean.resolve_code(folder, file_name, F.lit(""), job_number, F.lit("")).alias("resolved"),
        clean.summary_structure(summary, F.concat(code, F.lit(" Job "), F.col("c_mktsegment"))).alias("structure"),
        clean.release_year(release, dated, F.lit(2016)).alias("year"))


@query("n45_labels", "SELECT c_custkey, c_name AS job, c_mktsegment AS place, c_name AS form FROM customer")
def _(spark, sf):
    """N45."""
    text = F.concat(F.lit("Bill of Material\nJob Name:  "), F.col("c_name"), F.lit("     Phone: 1\nLocation: "), F.col("c_mktsegment"), F.lit("\tx\nEnd"))
    form = F.concat(F.lit("Form  name of job:  "), F.col("c_name"), F.lit("  Billing City: A"))
    return table(spark, sf, "customer").select("c_custkey", clean.label_value(text, "Job Name:").alias("job"), clean.label_value(text, "Location:").alias("place"), clean.form_value(form, "Name of Job").alias("form"))


@query("s08_json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type || '|' || user_id AS parts, 2 AS n FROM events")
def _(spark, sf):
    """A JSON column as typed fields, a comma list as its parts."""
    listed = clean.comma_list(F.concat(F.lit(" "), F.col("event_type"), F.lit(", ,"), F.col("user_id"), F.lit(",")))
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.array_join(listed, "|").alias("parts"), F.size(listed).alias("n"))
