"""Readers and writers on small files."""

import csv
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from plumbline.operators import quality
from plumbline.sinks import pages, tables
from plumbline.sources import files, tabular

SHEET = """<?xml version="1.0"?>
<Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet">
 <Worksheet ss:Name="Results"><Table>
  <Row><Cell><Data ss:Type="String"> Job Code </Data></Cell><Cell><Data ss:Type="String">City</Data></Cell><Cell><Data ss:Type="String">State</Data></Cell><Cell><Data ss:Type="String">Qty</Data></Cell></Row>
  <Row><Cell><Data ss:Type="String">AAA</Data></Cell><Cell ss:Index="3"><Data ss:Type="String">NV</Data></Cell><Cell><Data ss:Type="Number">4</Data></Cell></Row>
  <Row><Cell ss:Index="2"><Data ss:Type="String">Reno</Data></Cell></Row>
  <Row><Cell><Data ss:Type="String">CCC</Data></Cell><Cell/><Cell><Data ss:Type="String">UT</Data></Cell></Row>
 </Table></Worksheet></Workbook>"""


def test_csv_with_mark_and_aliases(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿Job Code, City ,Ship City\nAAA,,Reno\nBBB,Elko,x\n".encode())
    df = tabular.read_csv(spark, str(path))
    assert df.columns[:3] == ["Job Code", "City", "Ship City"]
    named = tabular.resolve_headers(df, {"code": ["jobcode", "JOB CODE"], "county": ["county"]})
    assert [(r.code, r.county) for r in named.orderBy("row_no").collect()] == [("AAA", None), ("BBB", None)]
    cities = tabular.coalesce_headers(df, {"city": ["city", "ship city"], "plant": ["plant"]})
    assert [(r.city, r.plant) for r in cities.orderBy("row_no").collect()] == [("Reno", None), ("Elko", None)]


def test_row_no_follows_the_file(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("n\n" + "\n".join(f"{i:09d}" + "x" * 200 for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 * 1024 * 1024))
    try:
        df = tabular.read_csv(spark, str(path))
        assert df.rdd.getNumPartitions() > 3
        rows = [r.n[:9] for r in df.orderBy("row_no").select("n").collect()]
        assert rows == sorted(rows) and df.select("row_no").distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_row_no_holds_for_small_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "\n".join(f"{i:06d}" for i in range(60_000)))
    held = {"spark.sql.files.maxPartitionBytes": 2**16, "spark.sql.files.openCostInBytes": 2**13}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df = tabular.read_csv(spark, str(tmp_path / "a.csv"))
        assert df.rdd.getNumPartitions() >= 6
        assert [int(r.n) for r in df.orderBy("row_no").select("n").collect()] == list(range(60_000))
        assert df.select("row_no").distinct().count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_spreadsheet_xml_honours_cell_positions(spark, tmp_path):
    path = tmp_path / "export.xls"
    path.write_text(SHEET)
    got = files.sheet_records(files.read_sheet_xml(spark, str(path)), ["Job Code", "City", "State", "Qty"])
    assert [tuple(r)[2:] for r in got.orderBy("row_no").collect()] == [("AAA", "", "NV", "4"), ("", "Reno", "", ""), ("CCC", "", "UT", "")]


def test_gazetteer_json_and_projection(spark, tmp_path):
    line = lambda z, c, s, lat: "\t".join(["US", z, c, "State", s, "County", "1", "", "", lat, "-115.0", "1"])
    (tmp_path / "US.txt").write_text("\n".join([line("89001", "Alamo", "NV", "37.1"), line("00000", "Nowhere", "XX", "1.0"), line("89002", "Bad", "NV", "n/a")]))
    rows = tabular.read_gazetteer(spark, str(tmp_path / "US.txt"), ["NV", "UT"]).collect()
    assert [(r.zip, r.city, r.county, r.lat) for r in rows] == [("89001", "ALAMO", "COUNTY", 37.1)]
    (tmp_path / "db.json").write_text(json.dumps([{"job_code": "AAA", "year": 2020}, {"job_code": None, "year": 1}]))
    assert tabular.read_json_records(spark, str(tmp_path / "db.json"), "job_code string, year int").count() == 2
    df = spark.createDataFrame([(" c 12-x", " Reno "), ("zz9", "x")], "code string, city string")
    kept = tabular.export_projection(df, "code", ["city"], "[A-E][A-Z0-9]{2}")
    assert [tuple(r) for r in kept.collect()] == [("C12", "Reno")]


def test_yearly_files(spark, tmp_path):
    (tmp_path / "y2023.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y2024.csv").write_text("a,zip,b\n3,89001,4\n")
    df = tabular.read_years(spark, str(tmp_path / "y{year}.csv"), [2022, 2023, 2024])
    assert {(r.a, r.b, r.zip, r.file_year) for r in df.collect()} == {("1", "2", None, 2023), ("3", "4", "89001", 2024)}


def test_listing_release_folder_and_latest(spark, tmp_path):
    for name in ("AAA- Job/Release 1/x.xml", "AAA- Job/notes/y.pdf", "BBB- Other/z.pdf", "BBB- Other/Forms/f.docx"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x")
    listed = files.without_folders(files.list_files(spark, str(tmp_path))).withColumns(
        {"job": F.substring_index("subfolder", "/", 1), "inside": F.regexp_replace("subfolder", "^[^/]*/?", "")})
    assert {r.file_name for r in listed.collect()} == {"x.xml", "y.pdf", "z.pdf"}
    assert {r.file_name for r in files.release_files(listed, "job", "inside").collect()} == {"x.xml"}
    assert {r.file_name for r in files.release_files(listed, "job", "inside", required=False).collect()} == {"x.xml", "z.pdf"}
    old, new = tmp_path / "Shipped1.xls", tmp_path / "Shipped2.xls"
    for age, p in ((100, old), (0, new)):
        p.write_text("x")
        os.utime(p, (time.time() - age, time.time() - age))
    found = files.latest_file(files.list_files(spark, str(tmp_path)), ["ShippedProduct*.xls", "Shipped*.xls"]).first().path
    assert found.endswith("Shipped2.xls")
    quality.require_inputs(spark, [str(new)])
    with pytest.raises(FileNotFoundError):
        quality.require_inputs(spark, [str(new), str(tmp_path / "none*.xls")])


def test_pages_round_trip(spark, tmp_path):
    (tmp_path / "AAA - Job.md").write_text('---\njob_code: AAA\nCity: "[[Reno NV]]"\nempty:\njob_code: BBB\n---\n\n# AAA\ncity: not here\n')
    (tmp_path / "plain.md").write_text("no front matter")
    rows = files.read_pages(spark, str(tmp_path)).withColumn("m", files.front_matter("text"))
    got = {r.file_name: r.m for r in rows.collect()}
    assert got == {"AAA - Job.md": {"city": "Reno NV", "empty": None, "job_code": "BBB"}, "plain.md": {}}
    out = pages.append_section(
        spark.createDataFrame([("A", "text"), ("B", "x\n## Parts\n"), ("D", "keep")], "k string, content string"),
        spark.createDataFrame([("A", "- 1"), ("B", "- 2"), ("C", "- 3")], "k string, section string"), "k", "Parts")
    states = {r.k: (r.state, r.content) for r in out.collect()}
    assert {k: v[0] for k, v in states.items()} == {"A": "updated", "B": "skipped", "C": "created", "D": "unchanged"}
    assert states["A"][1] == "text\n\n## Parts\n\n- 1" and states["B"][1] == "x\n## Parts\n" and states["C"][1].startswith("---\njob_code: C\n---")
    named = out.withColumn("file_name", F.concat("k", F.lit(".md")))
    pages.write_pages(named, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).select("file_name").distinct().count() == 4
    pages.write_page_files(named, str(tmp_path / "some"), ["A.md", "D.md"])
    assert {r.file_name for r in spark.read.text(str(tmp_path / "some")).select("file_name").distinct().collect()} == {"A.md", "D.md"}


def test_changes_fold_and_snapshots(spark, tmp_path):
    path, schema, keyed = str(tmp_path / "resolutions"), "entity_key string, field string, chosen_value string, confirmed_at string", (["entity_key", "field"], "chosen_value", "confirmed_at")
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    assert tables.read_latest(spark, path, schema, *keyed).count() == 0
    tables.write_changes(rows(("A", "city", "Reno", "1"), ("A", "state", "", "1"), ("A", "city", "Old", "0")), path, "a", *keyed)
    tables.write_changes(rows(), path, "none", *keyed)
    second = rows(("A", "city", "Elko", "2"), ("B", "city", "Ely", "2"))
    for _ in range(2):  # repeating a batch changes nothing
        tables.write_changes(second, path, "b", *keyed)
    want = {("A", "city", "Elko", "2"), ("B", "city", "Ely", "2")}
    assert {tuple(r) for r in tables.read_latest(spark, path, schema, *keyed).collect()} == want
    tables.fold_changes(spark, path, str(tmp_path / "folded"), schema, *keyed)
    assert {tuple(r) for r in tables.read_latest(spark, str(tmp_path / "folded"), schema, *keyed).collect()} == want
    snap = str(tmp_path / "snap")
    for label, n in (("2024q1", 3), ("2024q2", 5), ("2024q1", 4)):
        tables.write_snapshot(spark.range(n), snap, "quarter", label)
    assert {(r.quarter, r["count"]) for r in spark.read.parquet(snap).groupBy("quarter").count().collect()} == {("2024q1", 4), ("2024q2", 5)}


def _scanned(df):
    """Rows that the file scans of a plan put out."""
    df.collect()
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        else:
            if name == "FileSourceScanExec":
                total += node.metrics().get("numOutputRows").get().value()
            stack += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_difference_reads_changed_buckets_only(spark, tmp_path):
    path, schema, n = str(tmp_path), "id string, v string", 200_000
    base = spark.range(n).select(F.col("id").cast("string"), F.md5(F.col("id").cast("string")).alias("v"))
    one = base.where("id <> '77'").unionByName(spark.createDataFrame([("new", "1")], schema))
    for label, df in (("a", base), ("b", one), ("same", base.repartition(3).orderBy(F.desc("id"))), ("value", base.withColumn("v", F.when(F.col("id") == "9", "x").otherwise(F.col("v"))))):
        tables.write_digested(df, path, label, ["id"])
    new, gone = tables.snapshot_difference(spark, path, "a", "b", schema, "id")
    assert [r.id for r in new.collect()] == ["new"] and [r.id for r in gone.collect()] == ["77"]
    changed = tables.changed_buckets(spark, path, "a", "b")
    assert 1 <= len(changed) <= 2 and len(tables.changed_buckets(spark, path, "a", "value")) == 1
    # One row of 200,000 changed: the row groups around its bucket are read, a third of the rows at most.
    [bucket] = tables.changed_buckets(spark, path, "a", "value")
    assert 0 < _scanned(tables.read_buckets(spark, path, "a", schema, [bucket])) <= n // 3
    assert tables.changed_buckets(spark, path, "a", "same") == []
    assert [x.count() for x in tables.snapshot_difference(spark, path, "a", "same", schema, "id")] == [0, 0]


def test_lookups_read_few_row_groups(spark, tmp_path):
    n, path = 400_000, str(tmp_path / "t")
    rows = spark.range(n).select(F.col("id"), (F.xxhash64("id") % 1_000_000_007).alias("other"), F.md5(F.col("id").cast("string")).alias("text"))
    tables.write_clustered(rows, path, ["id"], indexed=["other"], group_bytes=1 << 18)
    kept = spark.read.parquet(path)
    [hit] = rows.where("id = 123456").collect()
    by_key, by_other = kept.where(F.col("id") == 123_456), kept.where(F.col("other") == hit.other)
    assert by_key.collect() == by_other.collect() == [hit]
    # A tenth of the rows at most are read; without the filters of the row groups a lookup by the other key reads all.
    assert _scanned(by_key) <= n // 10 and _scanned(by_other) <= n // 10
    rows.repartitionByRange("id").write.parquet(str(tmp_path / "plain"))
    assert _scanned(spark.read.parquet(str(tmp_path / "plain")).where(F.col("other") == hit.other)) == n


def test_high_water_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in (3, 9, 5):
        tables.append_history(spark.createDataFrame([(day, f"2024-01-0{day} 10:00:00.000007"), (0, None)], "n int, at string").withColumn("at", F.to_timestamp("at")), path, "at")
    top = tables.high_water_of(spark, path)
    assert top.first()["cutoff"].isoformat() == "2024-01-09T10:00:00.000007"
    plan = top._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(_micros)]" in plan


def test_one_sheet_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "book")
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("v & <"), "id")).alias("v"), F.lit("x").alias("w"), F.lit("z" * 500).alias("long"))
    tables.write_sheet_xml(rows, path, ["id", "v", "w", "long"], ["id"])
    held = {"spark.sql.files.maxPartitionBytes": 2**20, "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        raw = files.read_sheet_xml(spark, f"{path}/*")
        # The rows of one file are worked on in several tasks.
        tasks = raw.select("source_file", F.spark_partition_id().alias("t")).groupBy("source_file").agg(F.countDistinct("t").alias("n")).collect()
        assert max(t.n for t in tasks) >= 2
        pieces = spark.read.option("lineSep", "</Row>").text(f"{path}/*")
        assert pieces.rdd.getNumPartitions() >= 8 and pieces.agg(F.max(F.length("value"))).first()[0] < 2_000
        got = files.sheet_records(raw, ["w", "id", "v"]).orderBy("source_file", "row_no").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((int(r.id), r.v, r.w) for r in got) == [(i, f"v & <{i}" if i % 4 else "", "x") for i in range(30_000)]
    for file in {r.source_file for r in got}:
        ids = [int(r.id) for r in got if r.source_file == file]
        assert ids == sorted(ids)


def test_plain_rows_are_read_as_the_parser_reads_them(spark):
    """Rows whose cells need no XML parser, and rows that are nearly so, come out as the parser gives them."""
    cell = lambda x, at="": f'<Cell{at}><Data ss:Type="String">{x}</Data></Cell>'
    texts = ["x", "a &lt;&amp;&gt; b", "&amp;lt;", "&quot;q&apos;", " x", "x ", "\u00a0x", "null", "nullx", "NULL", "", "&#65;", "&bad;", "a<!-- c -->b", "<![CDATA[x]]>", "a\nb", "é漢😀", "a\tb", "\ufeffx", "$1\\n"]
    bodies = [cell(x) + cell("z", ' ss:Index="7"') for x in texts] + ["", cell("a") + " " + cell("b"), cell("a") + "<Cell/>", '<Cell ss:Index="2" ss:y="1"><Data>x</Data></Cell>', cell("a", ' ss:Index="0"'), "t" + cell("a"), cell("a") + cell("b"), "<Cell><Data>" + cell("x") + "</Data></Cell>"]
    rows = [f"<Row{tag}>{body}" for body in bodies for tag in ("", ' ss:Height="1"', ' a="&lt;"', ' a=">"')] + ["<Row/>", '<Row ss:x="1"/>', '<Row ss:x="/>" />']
    df = spark.createDataFrame([(r, "</Row>" if not r.endswith("/>") or "<Cell" in r else "") for r in rows], "part string, closing string")
    parsed = F.coalesce(F.from_xml(F.concat("part", "closing"), f"Cell {files.CELL}", {"rowTag": "Row"})["Cell"], F.array().cast(files.CELL))
    got = df.select("part", files.row_cells("part").alias("cells"), parsed.alias("parsed")).collect()
    assert [(r.part, r.cells) for r in got] == [(r.part, r.parsed) for r in got]


def test_each_row_of_a_sheet_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "book")
    tables.write_sheet_xml(spark.range(100).select("id", F.lit(" x").alias("v")), path, ["id", "v"], ["id"])
    got = files.read_sheet_table(spark, f"{path}/*", ["v", "id", "none"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RelationV2") + plan.count("Relation [") == 2 and "min_by" not in plan  # the rows, and the kept places of the header's names
    assert sorted((r.v, int(r.id), r.none) for r in got.collect()) == [(r.v, int(r.id), "") for r in sorted(files.sheet_records(files.read_sheet_xml(spark, f"{path}/*"), ["v", "id"]).collect(), key=lambda r: int(r.id))]


def test_empty_rows_count_and_sheets_end(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<Workbook xmlns:ss="u"><Worksheet ss:Name="a/>"><Table><Row/><Row ss:Height="1"><Cell/><Cell><Data>B</Data></Cell></Row><Row ss:x="/>" />\n<Row></Row>'
                                    '<Row/></Table></Worksheet><Worksheet><Table><Row/><Row><Cell><Data>no</Data></Cell></Row></Table></Worksheet></Workbook>')
    (tmp_path / "b.xml").write_text("<Workbook><Worksheet><Table></Table></Worksheet><Worksheet><Table><Row><Cell><Data>no</Data></Cell></Row></Table></Worksheet></Workbook>")
    (tmp_path / "c.xml").write_text("")
    rows = files.read_sheet_xml(spark, str(tmp_path)).select("source_file", "row_no", files.cell_texts(files.placed_cells("raw_cells")).alias("t")).orderBy("row_no").collect()
    assert [r.t for r in rows] == [[], ["", "B"], [], [], []]


def test_plain_writers(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", 2020), ("2", "y", 2021)], "b string, a string, year int")
    tables.write_csv(df, str(tmp_path / "csv"), ["a", "b", "year"], partition_by=["year"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["a", "b", "year"]
    for _ in range(2):
        tables.append_log(df, str(tmp_path / "log"), ["a", "missing", "b"])
    log = spark.read.option("header", True).csv(str(tmp_path / "log"))
    assert log.columns == ["a", "missing", "b"] and log.count() == 4
    tables.write_report({"one": df, "two": df}, str(tmp_path / "report"))
    tables.write_bundle({"meta": df.limit(1), "rows": df}, str(tmp_path / "bundle"))
    tables.write_clustered(df, str(tmp_path / "clustered"), ["a"])
    assert spark.read.json(str(tmp_path / "bundle/rows")).count() == 2 and spark.read.parquet(str(tmp_path / "clustered")).count() == 2


def test_csv_agrees_with_other_programs(spark, tmp_path):
    rows = [["1", '48" Base 48"'], ["2", '60" Lid, 30" Opening'], ["3", "two\nlines"], ["4", ' " '], ["5", "back\\slash"]]
    with open(tmp_path / "in.csv", "w", newline="") as f:
        csv.writer(f).writerows([["n", "part"], *rows])
    read = tabular.read_csv(spark, str(tmp_path / "in.csv"), line_breaks=True)
    assert [list(r)[:2] for r in read.orderBy("row_no").collect()] == rows
    tables.write_csv(read.coalesce(1), str(tmp_path / "out"), ["n", "part"])
    [out] = (tmp_path / "out").glob("part-*.csv")
    with open(out, newline="") as f:
        assert list(csv.reader(f)) == [["n", "part"], *rows]


def test_a_sheet_may_be_wide_and_only_the_first_counts(spark, tmp_path):
    cell = lambda v, at="": f'<Cell{at}><Data ss:Type="String">{v}</Data></Cell>'
    head = "".join(cell(f"H{i}") for i in range(200))
    body = cell("v0") + cell("v150", ' ss:Index="151"') + cell("v151") + cell("again", ' ss:Index="152"')
    sheet = lambda a, b: f'<Worksheet ss:Name="x"><Table><Row>{a}</Row><Row>{b}</Row></Table></Worksheet>'
    path = tmp_path / "wide.xls"
    path.write_text(f'<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet">{sheet(head, body)}{sheet(head, cell("other"))}</Workbook>')
    [row] = files.sheet_records(files.read_sheet_xml(spark, str(path)), ["H0", "H150", "H151", "H199", "none"]).collect()
    assert tuple(row)[2:] == ("v0", "v150", "again", "", "")


def _placed(row):
    """(at, text) of cells (given position or None, text), as a spreadsheet reads them."""
    out, at = [], 0
    for given, text in row:
        at = given if given is not None else at + 1
        out.append((at, text or ""))
    return out


def test_cells_are_placed_in_one_pass(spark):
    rows = [[], [(None, "a")], [(3, "a")], [(None, "a"), (5, "b"), (None, None), (2, "c"), (None, "d"), (None, "e"), (None, "f")],
            [(4, "a"), (None, "b"), (4, "c"), (None, None)], [(1, "x"), (1, "y"), (1, "z")], [(i * 2 if i % 3 == 0 else None, str(i)) for i in range(1, 40)], None]
    data = [(n, None if r is None else [((t,), at) for at, t in r]) for n, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"n int, raw {files.CELL}").select("n", files.placed_cells("raw").alias("p"), files.cell_texts(files.placed_cells("raw")).alias("t"))
    for r in df.collect():
        want = None if rows[r.n] is None else _placed(rows[r.n])
        assert (None if r.p is None else [tuple(c) for c in r.p]) == want
        at = dict(want or [])
        assert r.t == [at.get(i, "") for i in range(1, max(at, default=0) + 1)]
    # The row is named once in the plan, whatever is made of it.
    row = F.array(F.struct(F.struct(F.lit("once").alias("_VALUE")).alias("Data"), F.lit(None).cast("bigint").alias("_ss:Index")))
    plan = lambda c: spark.range(1).select(F.when(F.col("id") >= 0, c).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan(files.cell_texts(files.placed_cells(row))).count("once") == 1
    assert plan(F.size(files.front_matter(F.concat(F.lit("once"), F.col("id"))))).count("once") == 1
