"""Queries: part numbers of four generations written from the part table, then decoded again.

The part table only gives sizes; each family below spells them its own way and states what decoding
has to give back, so the SQL side is the construction itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import classify, partname
from plumbline.functions.clean import troughing, undouble

from .base import query, table

# Sizes of a part: diameter, height, feet, two-digit feet; in the dialect both engines share.
_D = "element_at(array(48, 60, 72, 84, 96, 120, 144), CAST(p_partkey div 16 % 7 AS INT) + 1)"
SIZES = {"d": _D, "h": "(p_size % 8 + 1) * 12", "dc": "element_at(array(48, 60, 72), CAST(p_partkey div 16 % 3 AS INT) + 1)"}
SIZES_SQL = {
    "d": "[48, 60, 72, 84, 96, 120, 144][CAST(p_partkey // 16 % 7 AS INT) + 1]", "h": "(p_size % 8 + 1) * 12",
    "dc": "[48, 60, 72][CAST(p_partkey // 16 % 3 AS INT) + 1]"}
BLANK = dict(pt="''", gen="''", sub="''", dia="''", ht="''", od="''", tr="''", wall="''", sec="''", lid="''", es="''", de="''", name="'#MISSING'", cls="'unknown'", text="num", base="''")
G4 = dict(gen="'Gen4'", sub="'Standard'", dia="d", cls="'non-base'", base="num", name="num")
FEET = "lpad(CAST(CAST(CAST(d AS INT) / 12 AS INT) AS VARCHAR), 2, '0')"
# number and expected values by family; families are numbered by place.
FAMILIES = [
    dict(num="'MHB' || d || h", **{**G4, "pt": "'MHB'", "ht": "h", "de": "'0'", "cls": "'base'", "text": "d || '\" Base ' || h || '\"'"}),
    dict(num="'MHB' || d || h || '.133'", **{**G4, "pt": "'MHB'", "ht": "h", "tr": "'.133'", "de": "'0'", "cls": "'base'", "text": "d || '\" Base ' || h || '\" 1.33\"'"}),
    dict(num="'MHB' || d || h || 'FFES/DE2-3'", **{**G4, "pt": "'MHB'", "ht": "h", "tr": "'FF'", "es": "'Yes'", "de": "'2'", "wall": "'3'", "cls": "'base'", "text": "d || '\" Base ' || h || '\" Flat Floor ES DE2'"}),
    dict(num="'MHC' || dc || '24'", **{**G4, "pt": "'MHC'", "dia": "dc", "od": "'24'", "text": "dc || '\" Cone 24\"'"}),
    dict(num="'MHS' || d || h || 'NB'", **{**G4, "pt": "'MHS'", "ht": "h", "sec": "'NB'", "text": "d || '\" Section ' || h || '\" NB'"}),
    dict(num="'MHL' || d || '30CAST'", **{**G4, "pt": "'MHL'", "od": "'30'", "lid": "'CAST'", "text": "d || '\" Lid 30\" Opening'"}),
    dict(num="'RMH' || '48' || '24H'", **{**G4, "pt": "'RMH'", "sub": "'Rehab'", "dia": "'48'", "ht": "'24'", "sec": "'H'", "cls": "'rehab'", "text": "'48\" Rehab Riser 24\" Hole'"}),
    dict(num="'MHGR36X4'", **{**G4, "pt": "'MHGR'", "dia": "'36'", "ht": "'4'", "text": "'36\" Grade Ring x4'"}),
    dict(num=f"'7' || {FEET} || h || '-B133ES'", **{**G4, "gen": "'Gen2'", "pt": "'MHB'", "ht": "h", "tr": "'.133'", "es": "'Yes'", "cls": "'base'", "name": "'MHB' || d || h || '.133ES'", "base": "'MHB' || d || h || '.133ES'", "text": "num"}),
    dict(num=f"'5' || {FEET} || h || '-SNB'", **{**G4, "gen": "'Gen2'", "pt": "'MHS'", "ht": "h", "sec": "'NB'", "name": "'MHS' || d || h || 'NB'", "base": "''", "text": "num"}),
    dict(num="'60' || CAST(CAST(CAST(dc AS INT) / 12 AS INT) AS VARCHAR) || h || '-RS'", **{**G4, "gen": "'Gen2'", "pt": "'RMH'", "sub": "'Rehab'", "dia": "dc", "ht": "h", "cls": "'rehab'", "name": "'RMH' || dc || h", "base": "'MHB' || dc || h", "text": "num"}),
    dict(num=f"'S' || {FEET} || h || '-0001'", **{**G4, "gen": "'Gen3'", "pt": "'MHS'", "ht": "h", "sec": "'NB'", "name": "'MHS' || d || h || 'NB'", "base": "''", "text": "num"}),
    dict(num=f"'F' || {FEET} || h", **{**G4, "gen": "'Gen3'", "pt": "'MHB'", "ht": "h", "tr": "'FF'", "cls": "'base'", "name": "'MHB' || d || h || 'FF'", "base": "'MHB' || d || h || 'FF'", "text": "num"}),
    dict(num="d || CAST(CAST(CAST(h AS INT) / 12 AS INT) AS VARCHAR) || 'BP1.33'", **{**G4, "gen": "'Gen1'", "pt": "'MHB'", "ht": "h", "tr": "'.133'", "cls": "'base'", "name": "'MHB' || d || h || '.133'", "base": "'MHB' || d || h || '.133'", "text": "num"}),
    dict(num="d || '36CC'", **{**G4, "gen": "'Gen1'", "pt": "'MHCC'", "od": "'36'", "name": "'MHCC' || d || '36'", "base": "''", "text": "num"}),
    dict(num="'GASKET ' || p_brand", **{"text": "num"}),
]


def _choose(key: str) -> str:
    """SQL text that picks a column's value by family."""
    return "CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN CAST({f.get(key, BLANK[key]) if key != 'num' else f['num']} AS VARCHAR)" for i, f in enumerate(FAMILIES)) + " END"


def numbered(spark, sf):
    """Every part with its part number."""
    sized = table(spark, sf, "part").withColumns({k: F.expr(v).cast("string") for k, v in SIZES.items()})
    return sized.withColumn("part_number", F.expr(_choose("num").replace("VARCHAR", "STRING"))).drop(*SIZES)


_SIZED = "SELECT *, " + ", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in SIZES_SQL.items()) + " FROM part"
PARTS_SQL = f"sized AS ({_SIZED}), parts AS (SELECT *, {_choose('num')} AS num FROM sized), x AS (SELECT p_partkey, p_type, p_name, num AS part_number, " + ", ".join(
    f"{_choose(k)} AS {k}" for k in BLANK) + " FROM parts)"


@query("c17_decode", f"""WITH {PARTS_SQL} SELECT p_partkey, part_number, pt AS pn_part_type, gen AS pn_generation, sub AS pn_subcategory, dia AS pn_diameter, ht AS pn_height, od AS pn_opening_diameter, tr AS pn_troughing,
  wall AS pn_wall_variant, sec AS pn_section_suffix, lid AS pn_lid_suffix, es AS pn_es, CASE WHEN de IN ('1', '2') THEN 'Yes' ELSE '' END AS pn_de, de AS pn_de_count, name AS gen4_name FROM x""")
def _(spark, sf):
    """Decoded once per distinct number, joined back to every part."""
    decoded = partname.decode_parts(numbered(spark, sf).select("p_partkey", "part_number"), "part_number")
    return decoded.drop("pn_box_length", "pn_box_suffix")


# Boxes, tops, collars, barrels and rehab parts: the number and what each part of it says, in the dialect both engines share.
_H = "CAST(p_size + 100 AS VARCHAR)"
MORE_FAMILIES = [
    dict(num=f"'BOXF7296' || {_H} || 'FF'", pt="BOXF", dia="72", len="96", ht=_H, sfx="FF"), dict(num="'BOXS9648'", pt="BOXS", dia="96", len="48"),
    dict(num=f"'BOX4848' || {_H}", pt="BOX", dia="48", len="48", ht=_H), dict(num="'BOXL9648HATCH'", pt="BOXL", dia="96", len="48", sfx="HATCH"),
    dict(num=f"'BOXT4848' || {_H}", pt="BOXT", dia="48", len="48", ht=_H, name=f"'BOX4848' || {_H}"), dict(num="'RMHL4830HATCH'", pt="RMHL", dia="48", od="30", lid="HATCH"),
    dict(num="'RMHC6024'", pt="RMHC", dia="60", ht="'24'"), dict(num="'RMHLC6024'", pt="RMHLC", dia="60", od="24"), dict(num="'MHLC6030CAST'", pt="MHLC", dia="60", od="30", lid="CAST"),
    dict(num="'MHTL7230'", pt="MHTL", dia="72", od="30"), dict(num="'MHTLC7230-3'", pt="MHTLC", dia="72", od="30"),
    dict(num="'MHT144-' || CAST(p_size AS VARCHAR) || '.5'", pt="MHT", dia="144", ht="CAST(p_size AS VARCHAR) || '.5'"),
    dict(num="'MHGRB36'", pt="MHGRB", dia="36"), dict(num="'MT60'", pt="MT", dia="60"),
]


def _family(value) -> str:
    return f"CASE p_partkey % {len(MORE_FAMILIES)} " + " ".join(f"WHEN {i} THEN {value(f)}" for i, f in enumerate(MORE_FAMILIES)) + " END"


_MORE = {"pt": "pn_part_type", "dia": "pn_diameter", "len": "pn_box_length", "od": "pn_opening_diameter", "lid": "pn_lid_suffix", "sfx": "pn_box_suffix"}


@query("c13_box_decode", "SELECT p_partkey, " + _family(lambda f: f["num"]) + " AS part_number, " + ", ".join(
    _family(lambda f, k=k: "'" + f.get(k, "") + "'") + f" AS {c}" for k, c in _MORE.items()) + ", " + _family(lambda f: f.get("ht", "''")) + " AS pn_height, "
    + _family(lambda f: f.get("name", f["num"])) + " AS gen4_name FROM part")
def _(spark, sf):
    """Box lengths and suffixes, and the part types the other families leave out."""
    numbers = table(spark, sf, "part").select("p_partkey", F.expr(_family(lambda f: f["num"]).replace("VARCHAR", "STRING")).alias("part_number"))
    return partname.decode_parts(numbers, "part_number").select("p_partkey", "part_number", *_MORE.values(), "pn_height", "gen4_name")


# Names of the three older generations, a family for every rule: the number, then what it says. ``f`` are whole feet of height.
_F, _DF = "CAST(CAST(CAST(h AS INT) / 12 AS INT) AS VARCHAR)", "CAST(CAST(CAST(d AS INT) / 12 AS INT) AS VARCHAR)"
_TALL = f"CAST(CAST({_F} AS INT) * 12 + 6 AS VARCHAR)"
_EVEN = f"CAST(CAST({_F} AS INT) * 12 AS VARCHAR)"


def _second(suffix: str, pt: str = "", opening: bool = False, **more: str) -> dict:
    return dict(num=f"'7' || {FEET} || h || '-{suffix}'", gen="Gen2", pt=pt, **{"dia": "d", "od" if opening else "ht": "h", **more})


def _third(letter: str, tail: str, pt: str, opening: bool = False, **more: str) -> dict:
    return dict(num=f"'{letter}' || {FEET} || h || '-{tail}'", gen="Gen3", pt=pt, **{"dia": "d", "od" if opening else "ht": "h", **more})


def _first(rest: str, pt: str = "", **more: str) -> dict:
    return dict(num=f"d || {rest}", gen="Gen1", pt=pt, **{"dia": "d", **more})


OLD_FAMILIES = [
    _second("GR", "MHGR", dia=_DF), _second("S12C", "MHS"), _second("SNB", "MHS", sec="'NB'"), _second("RS12C", "RMH"), _second("RS2", "RMH"), _second("S4", "RMH"),
    _second("S", "MHS"), _second("SR", "RMH"), _second("RS", "RMH"), _second("RL", "RMHL", True), _second("RC", "RMHC", True), _second("RCL", "RMHLC", True),
    _second("C", "MHC", True), _second("CC", "MHCC", True), _second("CL", "MHLC", True), _second("CLH", "MHLC", True, lid="'HATCH'"), _second("L", "MHL", True),
    _second("HL", "MHL", True, lid="'HATCH'"), _second("LH", "MHL", True, lid="'HATCH'"), _second("HLVP", "MHL", True, lid="'HATCH'"), _second("TL", "MHTL", True),
    _second("B", "MHB"), _second("B1", "MHB", tr="'.1'"), _second("B50", "MHB", tr="'.5'"), _second("B75", "MHB", tr="'.75'"), _second("B75ES", "MHB", tr="'.75'", es="'Yes'"),
    _second("B100", "MHB", tr="'.1'"), _second("B100ES", "MHB", tr="'.1'", es="'Yes'"), _second("B116", "MHB", tr="'1.16'"), _second("B133", "MHB", tr="'.133'"),
    _second("BFF", "MHB", tr="'FF'"), _second("BFFES", "MHB", tr="'FF'", es="'Yes'"), _second("KBXS", "BOXS"), _second("BXS", "BOXS"), _second("BXSFF", "BOXS", tr="'Flat Floor'"),
    _second("TR", "MHB", tr="'TR'"), _second("XYZ"),
    _third("A", "5", "MHGR", ht="''"), _third("B", "1", "MHB"), _third("T", "2", "MHB"), _third("M", "3", "MHB"), _third("V", "4", "MHB"), _third("S", "2000", "RMH"), _third("S", "2221", "RMH"),
    _third("S", "1051", "MHS", sec="'NB'"), _third("S", "7", "MHS"), _third("P", "7", "MHS"), _third("Q", "7", "MHS"), _third("N", "1", "MHL"),
    _third("C", "001", "MHCC", True), _third("C", "100", "RMHC", True), _third("C", "101", "RMHC", True), _third("C", "9", "MHC", True), _third("L", "00100", "RMHL", True),
    _third("L", "01000", "MHL", True, lid="'HATCH'"), _third("L", "02020", "MHLC", True), _third("L", "02100", "RMHLC", True), _third("L", "20050", "MHL", True, lid="'CAST'"),
    _third("L", "22222", "MHLC", True, lid="'CAST'"), _third("L", "9", "MHL", True),
    dict(num="'27RL'", gen="Gen1", pt="RMHL", dia="'48'", od="'27'"), dict(num="'30TL'", gen="Gen1", pt="MHTL", dia="'48'", od="'30'"), dict(num="'5GR' || h || '4'", gen="Gen1", pt="MHGR", dia="h", ht="'4'"),
    _first(f"{_F} || '1.33'", "MHB", ht=_EVEN, tr="'.133'"), _first(f"{_F} || '-6BFF'", "MHB", ht=_TALL, tr="'FF'"), _first(f"{_F} || '-6BP1.33'", "MHB", ht=_TALL, tr="'.133'"),
    _first(f"{_F} || '-6B'", "MHB", ht=_TALL), _first(f"{_F} || '-6SNB'", "MHS", ht=_TALL, sec="'NB'"), _first(f"{_F} || '-6S'", "MHS", ht=_TALL), _first(f"{_F} || '-6X'", ht=_TALL),
    _first(f"{_F} || 'BFF'", "MHB", ht=_EVEN, tr="'FF'"), _first(f"{_F} || 'B'", "MHB", ht=_EVEN), _first(f"{_F} || 'RS'", "RMH", ht=_EVEN), _first(f"{_F} || 'SB'", "MHS", ht=_EVEN, sec="'NB'"),
    _first(f"{_F} || 'S'", "MHS", ht=_EVEN), _first(f"{_F} || 'S12C'", "MHS", ht=_EVEN), _first("'24CR'", "RMHC", od="'24'"), _first("'LH'", "MHL", od="'0'", lid="'HATCH'"),
    _first("'30LH'", "MHL", od="'30'", lid="'HATCH'"), _first("'24C'", "MHC", od="'24'"), _first("'24RL'", "RMHL", od="'24'"), _first("'24LR'", "RMHL", od="'24'"), _first("'30L'", "MHL", od="'30'"),
    _first("'TL'", "MHTL", od="'72'"), _first("'30TL'", "MHTL", od="'30'"), _first("'ZZ'"),
]
_OLD = {"dia": "pn_diameter", "ht": "pn_height", "od": "pn_opening_diameter", "tr": "pn_troughing", "sec": "pn_section_suffix", "lid": "pn_lid_suffix", "es": "pn_es"}


def _old(value) -> str:
    return f"CASE p_partkey % {len(OLD_FAMILIES)} " + " ".join(f"WHEN {i} THEN {value(f)}" for i, f in enumerate(OLD_FAMILIES)) + " END"


@query("c14_older_names", f"WITH sized AS ({_SIZED}) SELECT p_partkey, {_old(lambda f: f['num'])} AS part_number, " + _old(lambda f: f"'{f['gen']}'") + " AS pn_generation, "
       + _old(lambda f: f"'{f['pt']}'") + " AS pn_part_type, " + ", ".join(f"CAST({_old(lambda f, k=k: f.get(k, chr(39) * 2))} AS VARCHAR) AS {c}" for k, c in _OLD.items()) + " FROM sized")
def _(spark, sf):
    """Every rule of the three older generations, in sizes that vary from part to part."""
    sized = table(spark, sf, "part").withColumns({k: F.expr(v).cast("string") for k, v in SIZES.items()})
    numbers = sized.select("p_partkey", F.expr(_old(lambda f: f["num"]).replace("VARCHAR", "STRING")).alias("part_number"))
    return partname.decode_parts(numbers, "part_number").select("p_partkey", "part_number", "pn_generation", "pn_part_type", *_OLD.values())


@query("c04_structure_class", f"WITH {PARTS_SQL} SELECT p_partkey, coalesce(cls, 'unknown') AS structure_class FROM x")
def _(spark, sf):
    """The number decides; the word given with it carries no class."""
    rows = numbered(spark, sf)
    return rows.select("p_partkey", classify.structure_class(F.lit("custom"), "part_number").alias("structure_class"))


@query("c02_class_words", """SELECT p_partkey, CASE WHEN contains(w, 'rehab') THEN 'rehab' WHEN contains(w, 'base') THEN 'base' WHEN contains(w, 'ring') OR contains(w, 'lid') THEN 'non-base' END AS class,
  CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'base' WHEN p_type = 'LARGE' THEN 'rehab' ELSE 'unknown' END AS by_code
FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'rehab base' WHEN 'SMALL' THEN 'base slab' ELSE p_name END AS w FROM part)""")
def _(spark, sf):
    """C02, and C04's last resort, a bare code."""
    word = F.when(F.col("p_type") == "ECONOMY", "rehab base").when(F.col("p_type") == "SMALL", "Base slab").otherwise(F.col("p_name"))
    code = F.when(F.col("p_type").isin("SMALL", "PROMO"), "mhbt").when(F.col("p_type") == "LARGE", "RMHC")
    return table(spark, sf, "part").select("p_partkey", classify.class_from_word(word).alias("class"), classify.structure_class(code, F.lit("~")).alias("by_code"))


@query("c01_part_type_code", f"""WITH {PARTS_SQL} SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'CONE' ELSE regexp_extract(part_number, '^(RMHLC|MHTLC|BOXSFF|RMHL|RMHC|MHTL|MHGR|MHCC|MHLC|MHBT|BOXF|BOXS|BOXL|BOXT|RMH|MHB|MHC|MHL|MHS|MHT|BOX)') END AS part_type
FROM x WHERE p_type = 'SMALL' OR regexp_matches(part_number, '^(RMH|MH)') UNION ALL SELECT p_partkey, NULL FROM x WHERE p_type <> 'SMALL' AND NOT regexp_matches(part_number, '^(RMH|MH)')""")
def _(spark, sf):
    """C01, C30."""
    written = F.when(F.col("p_type") == "SMALL", F.lit(" cone "))
    return numbered(spark, sf).select("p_partkey", classify.part_type_or_number(written, "part_number").alias("part_type"))


@query("c19_base_names", f"WITH {PARTS_SQL} SELECT p_partkey, base AS item_name FROM x")
def _(spark, sf):
    return partname.with_base_item_name(numbered(spark, sf), "part_number").select("p_partkey", "item_name")


@query("f03_bases_by_code", f"""WITH {PARTS_SQL}, b AS (SELECT p_partkey, base AS item_name, CASE WHEN p_type <> 'LARGE' THEN substr(upper(p_name), 1, 3) END AS job_code FROM x WHERE cls = 'base')
SELECT * FROM b WHERE job_code IS NULL OR regexp_full_match(job_code, '[A-E][A-Z]{{2}}')""")
def _(spark, sf):
    """Bases with a standard code or none, sorted by code."""
    rows = numbered(spark, sf).withColumn("job_code", F.when(F.col("p_type") != "LARGE", F.substring(F.upper("p_name"), 1, 3)))
    bases = rows.where((classify.structure_class(F.lit(None).cast("string"), "part_number") == "base") & (F.col("job_code").isNull() | F.col("job_code").rlike("^[A-Ea-e][A-Za-z]{2}$")))
    return partname.with_base_item_name(bases, "part_number").select("p_partkey", "item_name", "job_code").orderBy(F.asc_nulls_last("job_code"), "p_partkey")


@query("c20_descriptions", f"WITH {PARTS_SQL} SELECT p_partkey, text AS part_name, CASE WHEN text = part_number THEN p_name ELSE text END AS label FROM x")
def _(spark, sf):
    """C20, C28."""
    rows = partname.with_description(numbered(spark, sf), "part_number", "part_name")
    return partname.with_item_label(rows, "part_number", "p_name", "label").select("p_partkey", "part_name", "label")


@query("c21_box_dimensions", """SELECT p_partkey, CAST(d AS VARCHAR) || 'x' || dc || 'x' || (p_size + 10) AS dims, 'Box Lid ' || d || 'x' || dc || 'x' || (p_size + 10) || ' Hatch' AS name
FROM (SELECT *, [48, 72, 96, 120, 144, 154][CAST(p_partkey % 6 AS INT) + 1] AS d, [48, 60, 72][CAST(p_partkey // 16 % 3 AS INT) + 1] * 0 + 36 AS dc FROM part)""")
def _(spark, sf):
    """Two known dimensions and a height."""
    d = F.element_at(F.array(*[F.lit(x) for x in (48, 72, 96, 120, 144, 154)]), (F.col("p_partkey") % 6 + 1).cast("int"))
    digits = F.concat(d, F.lit("36"), F.col("p_size") + 10)
    rows = table(spark, sf, "part").select("p_partkey", digits.alias("digits"), F.concat(F.lit("BOXL"), digits, F.lit("HATCH")).alias("pn"))
    return partname.with_description(rows, "pn", "name").select("p_partkey", partname.box_dimensions("digits").alias("dims"), "name")


@query("c22_item_types", f"""WITH {PARTS_SQL}, i AS (SELECT p_partkey, part_number, CASE p_type WHEN 'SMALL' THEN 'Joint Seal' ELSE 'Precast' END AS cat, upper(p_name) || CASE WHEN p_type = 'LARGE' THEN ' ECCENTRIC' WHEN p_type = 'SMALL' THEN ' MASTIC WRAP' ELSE '' END AS w FROM x)
SELECT p_partkey, CASE WHEN cat <> 'Precast' THEN 'Resale' WHEN starts_with(part_number, 'MHGR') THEN 'Grade Ring' WHEN starts_with(part_number, 'MHL') THEN 'Lid' WHEN starts_with(part_number, 'MHS') THEN 'Section' WHEN starts_with(part_number, 'MHB') THEN 'Base'
   WHEN starts_with(part_number, 'MHC') THEN 'Cone' WHEN starts_with(part_number, 'RMH') THEN 'Rehab Ring' ELSE '' END AS type,
  CASE WHEN cat <> 'Precast' THEN 'Mastic Wrap' WHEN contains(w, 'ECCENTRIC') THEN 'Eccentric' ELSE '' END AS subtype,
  CASE WHEN regexp_matches(part_number, '^(MH|RMH)') THEN 'Precast' WHEN contains(w, 'MASTIC') THEN 'Joint Seal' WHEN regexp_matches(part_number, '^(\\d{{3}}[A-Z]|\\d{{2}}[A-Z]{{2}})') THEN 'Precast' ELSE 'Miscellaneous' END AS inferred FROM i""")
def _(spark, sf):
    """C22, C23."""
    words = F.concat(F.col("p_name"), F.when(F.col("p_type") == "LARGE", " Eccentric").when(F.col("p_type") == "SMALL", " mastic wrap").otherwise(""))
    rows = numbered(spark, sf).withColumns({"category": F.when(F.col("p_type") == "SMALL", "Joint Seal").otherwise("Precast"), "words": words})
    return rows.select("p_partkey", classify.classify_item("category", "part_number", "words").alias("k"), classify.infer_category("part_number", "words").alias("inferred")).select(
        "p_partkey", "k.type", "k.subtype", "inferred")


@query("c24_code_maps", """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'MHB' WHEN 'LARGE' THEN 'RMH' ELSE p_type END AS product, CASE p_type WHEN 'SMALL' THEN 'Precast' WHEN 'LARGE' THEN 'Frame & Ring' END AS item,
  CASE WHEN p_type = 'SMALL' THEN 'Precast' ELSE p_type END AS category, CASE p_size % 5 WHEN 0 THEN '.133' WHEN 1 THEN '.1' WHEN 2 THEN '.75' WHEN 3 THEN 'FF' ELSE '' END AS depth FROM part""")
def _(spark, sf):
    """C24, C25, C29, N46."""
    t = F.col("p_type")
    kind = F.when(t == "SMALL", "Base").when(t == "LARGE", "Rehab Riser").otherwise(t)
    item = F.when(t == "SMALL", "StackElement").when(t == "LARGE", "Frame")
    category = F.when(t == "SMALL", F.lit("Depth Plus")).otherwise(t)
    depth = F.element_at(F.array(F.lit("1.33"), F.lit("1.0"), F.lit("0.75"), F.lit("FF"), F.lit(None).cast("string")), F.col("p_size") % 5 + 1)
    return table(spark, sf, "part").select("p_partkey", classify.product_type(kind).alias("product"), classify.item_category(item).alias("item"),
                                           classify.normal_category(category).alias("category"), troughing(depth).alias("depth"))


@query("n38_undouble", "SELECT p_partkey, p_type AS word FROM part")
def _(spark, sf):
    """Doubled words come back as they were; the SQL side is the original."""
    return table(spark, sf, "part").select("p_partkey", undouble(F.regexp_replace("p_type", "(.)", "$1$1")).alias("word"))


@query("c27_document_depth", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 ELSE 1 END AS rank,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'DIAGRAM' WHEN '2-HIGH' THEN 'PER_STRUCTURE_BOM' ELSE 'SUMMARY_ONLY' END AS tier,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Low' WHEN '2-HIGH' THEN 'Medium' ELSE 'High' END AS confidence FROM orders""")
def _(spark, sf):
    """C26, C27."""
    p = F.col("o_orderpriority")
    label = F.when(p == "1-URGENT", "Shop Drawing PDF").when(p == "2-HIGH", "BOM by Structure XML").when(p == "3-MEDIUM", "Quotation PDF").otherwise("other")
    return table(spark, sf, "orders").select("o_orderkey", classify.document_depth(label).alias("d"), classify.confidence_tier(F.substring(p, 1, 1).cast("int")).alias("confidence")).select(
        "o_orderkey", "d.rank", "d.tier", "confidence")
