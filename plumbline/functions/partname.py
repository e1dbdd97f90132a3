"""Part-number decoding (C05-C21) as ordered rewrite rules.

A rule is a pattern and a template. The first pattern that fits a number rewrites it into a
``|``-separated record, so decoding one number costs one CASE over native regexes and one split; no
Python runs per row. Numbers inside a record carry a unit mark that one shared expression resolves:

``5f`` feet, ``2f6i`` feet and inches, ``06i`` whole number, ``5h`` feet if one digit, ``t1.33`` a
written troughing depth, ``#/DE2`` a drop-encasement mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import as_col, lookup, text, troughing

# The fields a decoded part number carries, in output order.
PART_FIELDS = [
    "part_type", "subcategory", "generation", "diameter", "height", "opening_diameter", "troughing",
    "wall_variant", "section_suffix", "lid_suffix", "box_length", "box_suffix", "es", "de", "de_count",
]
MISSING = "#MISSING"

# Diameters of current and of first-generation names, lid diameters, box dimensions.
_D8 = "192|144|120|96|84|72|60|48"
_D7 = "144|120|96|84|72|60|48"
_LID = "144|120|96|84|72|60|48|36|30"
_BOX = "154|144|120|115|104|96|91|84|79|72|65|48|36"

_RECORD = ["pt", "dia", "ht", "od", "tr", "wall", "sec", "lid", "len", "sfx", "es", "de"]


def _record(**parts: str) -> str:
    return "|".join(parts.get(name, "") for name in _RECORD)


# Naming rules of the current generation, first fit wins.
GEN4_RULES = [
    (r"^(RMHLC|RMHL)(60|48)(?:(\d{2})(CAST|HATCH)?)?.*$", _record(pt="$1", dia="$2", od="$3", lid="$4")),
    (rf"^(MHTLC|MHTL)({_LID})(?:(HATCH)|(\d{{2}})(?:(CAST|HATCH)|-(TA))?(?:-([235]))?)?.*$",
     _record(pt="$1", dia="$2", od="$4", lid="$3$5$6", wall="$7")),
    (rf"^(MHLC|MHL)({_D8})(?:(HATCH)|(\d{{2}})(?:(CAST|HATCH)|-(TA))?(?:-([235]))?)?.*$",
     _record(pt="$1", dia="$2", od="$4", lid="$3$5$6", wall="$7")),
    (r"^(MHGRB)(36|30|24).*$", _record(pt="$1", dia="$2")),
    (r"^(MHGR)(?!B)(36|30|27|24)X?(\d)?.*$", _record(pt="$1", dia="$2", ht="$3")),
    (r"^(RMHC)(60)(\d{2}).*$", _record(pt="$1", dia="$2", ht="$3")),
    (r"^(MHCC|MHC)(72|60|48)(?:(\d{2})(?:-([235]))?)?.*$", _record(pt="$1", dia="$2", od="$3", wall="$4")),
    (rf"^(MHB)({_D8})(?:(\d{{3}})(?=[.FE/-]|$)|(\d{{2}}))?(\.133|\.15|\.75|\.5|\.1|FF)?(\.?ES)?(/?DE2?)?(?:-([235]))?.*$",
     _record(pt="$1", dia="$2", ht="$3$4", tr="$5", es="$6", de="#$7", wall="$8")),
    (rf"^(MHS)({_D8})(?:(\d{{2,3}})(NBH|NB|H|L)?(?:-([235L]))?)?.*$",
     _record(pt="$1", dia="$2", ht="$3", sec="$4", wall="$5")),
    (r"^(MHT)(?!L)(192|144)(?:-(\d+\.?\d*))?.*$", _record(pt="$1", dia="$2", ht="$3")),
    (r"^(RMH)(60|48)(\d{2})(?:(H)|(-?L))$", _record(pt="$1", dia="$2", ht="$3", sec="$4", wall="$5")),
    (r"^(RMH)(60|48)(\d{2})?.*$", _record(pt="$1", dia="$2", ht="$3")),
    (rf"^(BOX[SLFT]?+)({_BOX})?+({_BOX})?+(\d+)?(HATCH|FF)?$",
     _record(pt="$1", dia="$2", len="$3", ht="$4", sfx="$5")),
    (rf"^(BOX[SLFT]?+)({_BOX})?+({_BOX})?+.*?(HATCH|FF)?$", _record(pt="$1", dia="$2", len="$3", sfx="$4")),
    (r"^(MT)(\d+)?.*$", _record(pt="$1", dia="$2")),
    (r"^(RMHLC|MHTLC|MHGRB|RMHL|RMHC|MHTL|MHGR|MHCC|MHLC|RMH|MHB|MHC|MHL|MHS|MHT).*$", _record(pt="$1")),
]

_G2 = r"^[57](\d{2})(\d{2})-"


def _gen2(suffix: str, od: bool = False, **parts: str) -> tuple[str, str]:
    size = {"od": "$2i"} if od else {"ht": "$2i"}
    return rf"{_G2}{suffix}$", _record(dia="$1f", **size, **parts)


# Naming rules of the second generation.
GEN2_RULES = [
    (rf"{_G2}GR$", _record(pt="MHGR", dia="$1i", ht="$2i")),
    (rf"{_G2}S\d+C.*$", _record(pt="MHS", dia="$1f", ht="$2i")),
    (rf"{_G2}SNB.*$", _record(pt="MHS", dia="$1f", ht="$2i", sec="NB")),
    (rf"{_G2}(?:RS\d+C|R?S\d).*$", _record(pt="RMH", dia="$1f", ht="$2i")),
    _gen2("S", pt="MHS"),
    _gen2("(?:SR|RS)", pt="RMH"),
    _gen2("RL", od=True, pt="RMHL"),
    _gen2("RC", od=True, pt="RMHC"),
    _gen2("RCL", od=True, pt="RMHLC"),
    _gen2("C", od=True, pt="MHC"),
    _gen2("CC", od=True, pt="MHCC"),
    _gen2("CL", od=True, pt="MHLC"),
    _gen2("CLH", od=True, pt="MHLC", lid="HATCH"),
    _gen2("L", od=True, pt="MHL"),
    _gen2("(?:HL|LH|HLVP)", od=True, pt="MHL", lid="HATCH"),
    _gen2("TL", od=True, pt="MHTL"),
    _gen2("B", pt="MHB"),
    _gen2("B1", pt="MHB", tr=".1"),
    _gen2("B50", pt="MHB", tr=".5"),
    _gen2("B75(ES)?", pt="MHB", tr=".75", es="$3"),
    _gen2("B100(ES)?", pt="MHB", tr=".1", es="$3"),
    _gen2("B116", pt="MHB", tr="1.16"),
    _gen2("B133(ES)?", pt="MHB", tr=".133", es="$3"),
    _gen2("BFF(ES)?", pt="MHB", tr="FF", es="$3"),
    _gen2("K?BXS", pt="BOXS"),
    _gen2("K?BXSFF", pt="BOXS", tr="Flat Floor"),
    _gen2("TR", pt="MHB", tr="TR"),
    _gen2(".+"),
]

_G3 = r"(\d{2})(\d{2})-?"

# Naming rules of the third generation.
GEN3_RULES = [
    (rf"^A{_G3}.*$", _record(pt="MHGR", dia="$1f")),
    (rf"^F{_G3}.*$", _record(pt="MHB", dia="$1f", ht="$2", tr="FF")),
    (rf"^[BTMV]{_G3}.*$", _record(pt="MHB", dia="$1f", ht="$2")),
    (rf"^S{_G3}(?:2000|2020|2100|2122|2221|2222)$", _record(pt="RMH", dia="$1f", ht="$2")),
    (rf"^S{_G3}(?:0001|1001|1051|0021|0101|0120)$", _record(pt="MHS", dia="$1f", ht="$2", sec="NB")),
    (rf"^[SPQ]{_G3}.*$", _record(pt="MHS", dia="$1f", ht="$2")),
    (rf"^N{_G3}.*$", _record(pt="MHL", dia="$1f", ht="$2")),
    (rf"^C{_G3}001$", _record(pt="MHCC", dia="$1f", od="$2")),
    (rf"^C{_G3}10[01]$", _record(pt="RMHC", dia="$1f", od="$2")),
    (rf"^C{_G3}.*$", _record(pt="MHC", dia="$1f", od="$2")),
    (rf"^L{_G3}(?:00100|00051)$", _record(pt="RMHL", dia="$1f", od="$2")),
    (rf"^L{_G3}01000$", _record(pt="MHL", dia="$1f", od="$2", lid="HATCH")),
    (rf"^L{_G3}(?:02000|02020|02050)$", _record(pt="MHLC", dia="$1f", od="$2")),
    (rf"^L{_G3}02100$", _record(pt="RMHLC", dia="$1f", od="$2")),
    (rf"^L{_G3}(?:20000|20050)$", _record(pt="MHL", dia="$1f", od="$2", lid="CAST")),
    (rf"^L{_G3}(?:22000|22050|22222)$", _record(pt="MHLC", dia="$1f", od="$2", lid="CAST")),
    (rf"^L{_G3}.*$", _record(pt="MHL", dia="$1f", od="$2")),
]

# Naming rules of the first generation.
GEN1_RULES = [
    (r"^(24|27|30)RL$", _record(pt="RMHL", dia="48", od="$1")),
    (r"^(24|30)TL$", _record(pt="MHTL", dia="48", od="$1")),
    (r"^5?GR(\d{2})(\d{1,2})$", _record(pt="MHGR", dia="$1i", ht="$2i")),
    (rf"^({_D7})(\d)(1?\.\d+)$", _record(pt="MHB", dia="$1", ht="$2f", tr="t$3")),
    (rf"^({_D7})(\d)-(\d+)BFF$", _record(pt="MHB", dia="$1", ht="$2f$3i", tr="FF")),
    (rf"^({_D7})(\d)-(\d+)BP?(\d*\.\d+)?$", _record(pt="MHB", dia="$1", ht="$2f$3i", tr="t$4")),
    (rf"^({_D7})(\d)-(\d+)(?:SNB-DH|SNB|SB)$", _record(pt="MHS", dia="$1", ht="$2f$3i", sec="NB")),
    (rf"^({_D7})(\d)-(\d+)S$", _record(pt="MHS", dia="$1", ht="$2f$3i")),
    (rf"^({_D7})(\d)-(\d+).*$", _record(dia="$1", ht="$2f$3i")),
    (rf"^({_D7})(\d+)BFF$", _record(pt="MHB", dia="$1", ht="$2h", tr="FF")),
    (rf"^({_D7})(\d+)BP?(\d*\.\d+)?$", _record(pt="MHB", dia="$1", ht="$2h", tr="t$3")),
    (rf"^({_D7})(\d+)(?:SR|RS)$", _record(pt="RMH", dia="$1", ht="$2h")),
    (rf"^({_D7})(\d+)(?:SNB-DH|SNB|SB)$", _record(pt="MHS", dia="$1", ht="$2h", sec="NB")),
    (rf"^({_D7})(\d+)S(?:\d+C)?$", _record(pt="MHS", dia="$1", ht="$2h")),
    (rf"^({_D7})(\d{{2}})CRC?$", _record(pt="RMHC", dia="$1", od="$2")),
    (rf"^({_D7})LH$", _record(pt="MHL", dia="$1", od="0", lid="HATCH")),
    (rf"^({_D7})(\d{{2}})LH$", _record(pt="MHL", dia="$1", od="$2", lid="HATCH")),
    (rf"^({_D7})(\d{{2}})CC$", _record(pt="MHCC", dia="$1", od="$2")),
    (rf"^({_D7})(\d{{2}})C$", _record(pt="MHC", dia="$1", od="$2")),
    (rf"^({_D7})(\d{{2}})(?:RL|LR)$", _record(pt="RMHL", dia="$1", od="$2")),
    (rf"^({_D7})(\d{{2}})L$", _record(pt="MHL", dia="$1", od="$2")),
    (rf"^({_D7})TL$", _record(pt="MHTL", dia="$1", od="72")),
    (rf"^({_D7})(\d{{2}})TL$", _record(pt="MHTL", dia="$1", od="$2")),
    (rf"^({_D7}).*$", _record(dia="$1")),
]


def _clean_name(pn) -> Column:
    """Upper name without an inactive mark; ``60ddd-`` spelled like the other second-generation names."""
    name = F.upper(F.trim(F.regexp_replace(text(pn), r"(?i)\s*\(inactive\)\s*$", "")))
    return F.when(name.rlike(r"^60\d{3}-"), F.concat(F.lit("7"), F.substr(name, F.lit(2)))).otherwise(name)


def generation(pn) -> Column:
    """Naming generation; 'Material' when no generation fits, '' for a blank number."""
    name = _clean_name(pn)
    return (
        F.when(F.coalesce(name, F.lit("")) == "", F.lit(""))
        .when(name.rlike(r"^(?:MH|RMH|BOX|MT)"), F.lit("Gen4"))
        .when(name.rlike(r"^[57]\d{4}-"), F.lit("Gen2"))
        .when(name.rlike(r"^[SBCLANFTPMQV]\d{4}"), F.lit("Gen3"))
        .when(name.rlike(rf"^(?:5?GR\d|{_D7}|(?:24|27|30)RL|(?:24|30)TL)"), F.lit("Gen1"))
        .otherwise(F.lit("Material"))
    )


def _rewrite(name: Column, rules: list[tuple[str, str]], default: Column) -> Column:
    hits = [F.when(name.rlike(p), F.regexp_replace(name, p, t)) for p, t in rules]
    return F.coalesce(*hits, default)


def _measure(c: Column) -> Column:
    """Resolve the unit marks of one size field."""
    feet, inches = F.regexp_extract(c, r"^(\d+)f", 1), F.regexp_extract(c, r"(\d+)i$", 1)
    number = lambda x: F.coalesce(x.try_cast("int"), F.lit(0))
    return (
        F.when(c.rlike(r"^\d+f(?:\d+i)?$"), (number(feet) * 12 + number(inches)).cast("string"))
        .when(c.rlike(r"^\d+i$"), number(inches).cast("string"))
        .when(c.rlike(r"^\dh$"), (number(F.rtrim(c, F.lit("h"))) * 12).cast("string"))
        .otherwise(F.rtrim(c, F.lit("h")))
    )


def _record_of(name: Column, gen: Column) -> Column:
    empty = F.lit(_record())
    return (
        F.when(gen == "Gen4", _rewrite(name, GEN4_RULES, empty))
        .when(gen == "Gen2", _rewrite(name, GEN2_RULES, empty))
        .when(gen == "Gen3", _rewrite(name, GEN3_RULES, empty))
        .when(gen == "Gen1", _rewrite(name, GEN1_RULES, empty))
        .otherwise(empty)
    )


def _record_fields(parts: Column, gen: Column) -> dict[str, Column]:
    raw = {name: F.get(parts, F.lit(i)) for i, name in enumerate(_RECORD)}
    pt, tr, de = raw["pt"], raw["tr"], raw["de"]
    decoded = gen.isin("Gen1", "Gen2", "Gen3", "Gen4")
    subcategory = (
        F.when(~decoded | ((gen == "Gen4") & (pt == "")), F.lit(""))
        .when(F.startswith(pt, F.lit("RMH")), F.lit("Rehab"))
        .when(F.startswith(pt, F.lit("BOX")), F.lit("Box"))
        .otherwise(F.lit("Standard"))
    )
    # Label a current box name carries in place of a troughing depth.
    box_label = (
        F.when(pt == "BOX", F.lit("Standard")).when(pt == "BOXF", F.lit("Flat Floor"))
        .when(pt == "BOXL", F.lit("Lid")).when(pt == "BOXS", F.lit("Section"))
        .when(pt == "BOXT", F.lit("Unknown"))
    )
    depth = (
        F.when((gen == "Gen4") & box_label.isNotNull(), box_label)
        .when(F.startswith(tr, F.lit("t")), troughing(F.substr(tr, F.lit(2))))
        .otherwise(tr)
    )
    count = (
        F.when(de == "", F.lit("")).when(de.contains("2"), F.lit("2"))
        .when(de == "#", F.lit("0")).otherwise(F.lit("1"))
    )
    fields = {
        "part_type": pt,
        "subcategory": subcategory,
        "generation": F.when(decoded, gen).otherwise(F.lit("")),
        "diameter": _measure(raw["dia"]),
        "height": _measure(raw["ht"]),
        "opening_diameter": _measure(raw["od"]),
        "troughing": depth,
        "wall_variant": raw["wall"],
        "section_suffix": raw["sec"],
        "lid_suffix": raw["lid"],
        "box_length": raw["len"],
        "box_suffix": raw["sfx"],
        "es": F.when(raw["es"] != "", F.lit("Yes")).otherwise(F.lit("")),
        "de": F.when(count.isin("1", "2"), F.lit("Yes")).otherwise(F.lit("")),
        "de_count": count,
    }
    return {name: fields[name] for name in PART_FIELDS}


def canonical_name(prefix: str = "pn_") -> Column:
    """Current-generation name from the attribute columns, ``#MISSING`` where a size is absent."""
    a = {name: F.coalesce(F.trim(F.col(prefix + name)), F.lit("")) for name in PART_FIELDS}
    pt, dia, ht, od, tr = a["part_type"], a["diameter"], a["height"], a["opening_diameter"], a["troughing"]
    opening = F.when(od == "", od).otherwise(F.lpad(od, F.greatest(F.length(od), F.lit(2)), F.lit("0")))
    depth = (
        F.when(tr.isin("", "FF") | F.startswith(tr, F.lit(".")) | ~tr.contains("."), F.when(tr == "1", F.lit(".1")).otherwise(tr))
        .when(tr == "1.0", F.lit(".1")).when(tr == "1.33", F.lit(".133"))
        .otherwise(F.concat(F.lit("."), F.ltrim(tr, F.lit("0"))))
    )
    es = F.when(a["es"] == "Yes", F.lit("ES")).otherwise(F.lit(""))
    de = F.when(a["de_count"] == "2", F.lit("/DE2")).when(a["de_count"] == "1", F.lit("/DE")).otherwise(F.lit(""))
    wall = F.when(a["wall_variant"] != "", F.concat(F.lit("-"), a["wall_variant"])).otherwise(F.lit(""))
    hatch_or_cast = F.when(a["lid_suffix"].isin("HATCH", "CAST"), a["lid_suffix"]).otherwise(F.lit(""))
    cast = F.when(a["lid_suffix"] == "CAST", F.lit("CAST")).otherwise(F.lit(""))
    box = F.when(tr == "Flat Floor", F.lit("BOXF")).when(tr == "Lid", F.lit("BOXL")).when(tr == "Section", F.lit("BOXS")).otherwise(F.lit("BOX"))
    needs_height = pt.isin("MHB", "MHGR", "MHS", "MHT", "RMH", "RMHC")
    return (
        F.when((pt == "") | (dia == "") | (needs_height & (ht == "")), F.lit(MISSING))
        .when(pt.isin("MHC", "MHCC") & (od == ""), F.lit(MISSING))
        .when(pt == "MHB", F.concat(pt, dia, ht, depth, es, de, wall))
        .when(pt.isin("MHC", "MHCC", "MHTL", "MHTLC"), F.concat(pt, dia, opening, wall))
        .when(pt == "MHGR", F.concat(pt, dia, F.lit("X"), ht))
        .when(pt.isin("MHGRB", "MT"), F.concat(pt, dia))
        .when((pt == "MHL") & (a["lid_suffix"] == "HATCH"), F.concat(pt, dia, F.lit("HATCH"), wall))
        .when(pt.isin("MHL", "MHLC"), F.concat(pt, dia, opening, cast, wall))
        .when(pt == "RMHL", F.concat(pt, dia, opening, hatch_or_cast))
        .when(pt == "RMHLC", F.concat(pt, dia, opening))
        .when(pt == "MHS", F.concat(pt, dia, ht, a["section_suffix"], wall))
        .when(pt == "MHT", F.concat(pt, dia, F.lit("-"), ht))
        .when(pt == "RMH", F.concat(pt, dia, ht, F.when(a["section_suffix"] == "H", F.lit("H")).otherwise(F.lit(""))))
        .when(pt == "RMHC", F.concat(pt, dia, ht))
        .when(pt.isin("BOX", "BOXF", "BOXL", "BOXS", "BOXT"), F.concat(box, dia, a["box_length"], ht, a["box_suffix"]))
        .otherwise(F.lit(MISSING))
    )


def with_part_attributes(rows: DataFrame, pn: str, prefix: str = "pn_") -> DataFrame:
    """Add the 15 attribute columns (blank = '') and ``gen4_name``.

    Each step is a projection of its own, so the record of a number is worked out once and not again
    for every field read from it.
    """
    named = rows.withColumns({"_name": _clean_name(pn), "_gen": generation(pn)})
    split = named.withColumn("_parts", F.split(_record_of(F.col("_name"), F.col("_gen")), r"\|"))
    fields = _record_fields(F.col("_parts"), F.col("_gen"))
    decoded = split.withColumns({prefix + k: v for k, v in fields.items()}).drop("_name", "_gen", "_parts")
    return decoded.withColumn("gen4_name", canonical_name(prefix))


def decode_distinct(parts: DataFrame, pn: str) -> DataFrame:
    """Every distinct part number decoded once."""
    return with_part_attributes(parts.select(pn).where(F.col(pn).isNotNull()).distinct(), pn)


def decode_parts(rows: DataFrame, pn: str) -> DataFrame:
    """Rows with their decoded part attributes; the decoding runs on distinct numbers only."""
    return rows.join(decode_distinct(rows, pn), pn, "left")


# ---------------------------------------------------------------- base-only renaming

# Bases of every generation as ``diameter|height|troughing|es|de|wall``.
BASE_RULES = [
    (r"^MHB(\d{2,3})(\d{2,3})(FF|\.\d+)?(ES)?(/DE2|/DE)?(-\d)?$", "$1|$2|t$3|$4|$5|$6"),
    (r"^7(\d{2})(\d{2})-B1(?:00)?(ES)?$", "$1f|$2|.1|$3||"),
    (r"^7(\d{2})(\d{2})-B50(ES)?$", "$1f|$2|.5|$3||"),
    (r"^7(\d{2})(\d{2})-B75(ES)?$", "$1f|$2|.75|$3||"),
    (r"^7(\d{2})(\d{2})-B116(ES)?$", "$1f|$2|1.16|$3||"),
    (r"^7(\d{2})(\d{2})-B133(ES)?$", "$1f|$2|.133|$3||"),
    (r"^7(\d{2})(\d{2})-BFF(ES)?$", "$1f|$2|FF|$3||"),
    (r"^7(\d{2})(\d{2})-(?=.).*?(ES)?$", "$1f|$2||$3||"),
    (r"^F(\d{2})(\d{2}).*$", "$1f|$2|FF|||"),
    (r"^[BTMV](\d{2})(\d{2}).*$", "$1f|$2||||"),
    (rf"^({_D7})(\d)(1?\.\d+)$", "$1|$2f|t$3|||"),
    (rf"^({_D7})(\d)-(\d+)BP?(\d*\.\d+)?$", "$1|$2f$3i|t$4|||"),
    (rf"^({_D7})(\d+)BFF$", "$1|$2h|FF|||"),
    (rf"^({_D7})(\d+)BP?(\d*\.\d+)?$", "$1|$2h|t$3|||"),
]


def with_base_item_name(rows: DataFrame, pn: str, out: str = "item_name") -> DataFrame:
    """Current-generation name of a base; other current names unchanged, '' when unreadable."""
    kept, name = F.col("_kept"), F.col("_name")
    named = rows.withColumn("_kept", F.trim(F.regexp_replace(text(pn), r" ?\(inactive\)", "")))
    upper = F.upper(kept)
    named = named.withColumn(
        "_name", F.when(upper.rlike(r"^60\d{3}-"), F.concat(F.lit("7"), F.substr(upper, F.lit(2)))).otherwise(upper)
    )
    named = named.withColumn("_parts", F.split(_rewrite(name, BASE_RULES, F.lit("")), r"\|"))
    get = lambda i: F.coalesce(F.get(F.col("_parts"), F.lit(i)), F.lit(""))
    tr = F.when(F.startswith(get(2), F.lit("t")), troughing(F.substr(get(2), F.lit(2)))).otherwise(get(2))
    built = F.concat(F.lit("MHB"), _measure(get(0)), _measure(get(1)), tr, get(3), get(4), get(5))
    item = (
        F.when(F.coalesce(name, F.lit("")) == "", F.lit(""))
        .when(get(0) != "", built)
        .when(name.rlike(r"^(?:MH|RMH|BOX|MT)"), kept)
        .otherwise(F.lit(""))
    )
    return named.withColumn(out, item).drop("_kept", "_name", "_parts")


# ---------------------------------------------------------------- human descriptions

# Description rules; ``<05>`` is a number written without leading zeros.
DESCRIPTION_RULES = [
    (r"^MHGRB(\d{2,3}).*$", '$1" Grade Ring Barrel'),
    (r"^MHTLC(\d{2,3})(\d{2}).*$", '$1" Top Lid Collar <$2>" Opening'),
    (r"^RMHLC(\d{2})(\d{2}).*$", '$1" Rehab Lid Collar <$2>" Opening'),
    (r"^MHCC(\d{2})(\d{2}).*$", '$1" Conc Cone <$2>"'),
    (r"^MHGR(\d{2})X(\d).*$", '$1" Grade Ring x$2'),
    (rf"^MHLC({_D8})HATCH.*$", '$1" Lid Collar Hatch'),
    (rf"^MHLC({_D8})(\d{{2}}).*$", '$1" Lid Collar <$2>" Opening'),
    (rf"^MHLC({_D8}).*$", '$1" Lid Collar'),
    (r"^MHTL(\d{2,3})(\d{2}).*$", '$1" Top Lid <$2>" Opening'),
    (r"^RMHC(\d{2})(\d{2}).*$", '$1" Rehab Cone <$2>"'),
    (r"^RMHL(\d{2})(?:\d{2})?HATCH.*$", '$1" Rehab Lid Hatch'),
    (r"^RMHL(\d{2})(\d{2}).*$", '$1" Rehab Lid <$2>" Opening'),
    (r"^RMHL(\d{2}).*$", '$1" Rehab Lid'),
    (r"^MHC(\d{2})(\d{2}).*$", '$1" Cone <$2>"'),
    (r"^MHLHATCH.*$", "Lid Hatch"),
    (rf"^MHL({_D8})HATCH.*$", '$1" Lid Hatch'),
    (rf"^MHL({_D8})(\d{{2}}).*$", '$1" Lid <$2>" Opening'),
    (rf"^MHL({_D8}).*$", '$1" Lid'),
    (r"^MHS(\d{2,3})(\d{2,3})NBH.*$", '$1" Section <$2>" NB Hole'),
    (r"^MHS(\d{2,3})(\d{2,3})NB.*$", '$1" Section <$2>" NB'),
    (r"^MHS(\d{2,3})(\d{2,3})H.*$", '$1" Section <$2>" Hole'),
    (r"^MHS(\d{2,3})(\d{2,3})L.*$", '$1" Section <$2>" L'),
    (r"^MHS(\d{2,3})(\d{2,3}).*$", '$1" Section <$2>"'),
    (r"^MHT(\d{3})-([\d.]+).*$", '$1" Top $2'),
    (r"^RMH(\d{2})(\d{2})H.*$", '$1" Rehab Riser <$2>" Hole'),
    (r"^RMH(\d{2})(\d{2}).*$", '$1" Rehab Riser <$2>"'),
    (r"^MT(\d+).*$", '$1" Misc Top'),
]
# Words for base troughing depths and box kinds.
BASE_DEPTH_WORDS = {
    ".133": '1.33"', ".15": "Flat Floor", ".75": "3/4 Depth", ".5": "1/2 Depth", ".1": '1"', "FF": "Flat Floor",
}
BOX_WORDS = {"F": "Flat Floor Box", "L": "Box Lid", "S": "Box Section", "T": "Box", "": "Box"}
_BASE_SHAPE = r"^MHB(\d{2,3})(\d{2,3})(\.133|\.15|\.75|\.5|\.1|FF)?(\.?ES)?(/?DE2?)?.*$"
_BOX_SHAPE = r"^BOX([FLST]?)(\d.*?)(HATCH|FF)?$"


def box_dimensions(c) -> Column:
    """Leading digits cut into known box dimensions, the rest as one number, joined by x."""
    digits = F.regexp_extract(as_col(c), r"^\d+", 0)
    return F.array_join(F.regexp_extract_all(digits, F.lit(rf"({_BOX}|\d+)"), F.lit(1)), "x")


def with_description(rows: DataFrame, pn: str, out: str = "part_name") -> DataFrame:
    """C20: human description of a part number; the number itself where no rule fits."""
    name = F.col("_name")
    named = rows.withColumn("_name", F.coalesce(F.upper(text(pn)), F.lit("")))
    plain = F.regexp_replace(_rewrite(name, DESCRIPTION_RULES, as_col(pn)), r"<0*(\d+)>", "$1")
    b = lambda i: F.regexp_extract(name, _BASE_SHAPE, i)
    base = F.concat_ws(
        " ",
        F.concat(b(1), F.lit('"')),
        F.lit("Base"),
        F.concat(F.regexp_replace(b(2), r"^0+(?=\d)", ""), F.lit('"')),
        lookup(BASE_DEPTH_WORDS, b(3)),
        F.when(b(4) != "", F.lit("ES")),
        F.when(b(5).contains("2"), F.lit("DE2")).when(b(5) != "", F.lit("DE")),
    )
    x = lambda i: F.regexp_extract(name, _BOX_SHAPE, i)
    box = F.concat_ws(
        " ",
        lookup(BOX_WORDS, x(1)),
        F.nullif(box_dimensions(x(2)), F.lit("")),
        F.when(x(3) == "HATCH", F.lit("Hatch")).when(x(3) == "FF", F.lit("Flat Floor")),
    )
    described = (
        F.when(name == "", F.lit(""))
        .when(name.rlike(_BASE_SHAPE), base)
        .when(name.rlike(_BOX_SHAPE), box)
        .otherwise(plain)
    )
    return named.withColumn(out, described).drop("_name")


def with_item_label(rows: DataFrame, pn: str, description: str, out: str = "part_name") -> DataFrame:
    """Decoded description, else the written one where decoding gave nothing."""
    named = with_description(rows, pn, out)
    undecoded = F.col(out) == F.coalesce(text(pn), F.lit(""))
    return named.withColumn(
        out, F.when(undecoded, F.coalesce(F.nullif(F.col(description), F.lit("")), F.col(out))).otherwise(F.col(out))
    )
