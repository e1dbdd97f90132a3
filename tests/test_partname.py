"""Golden rows for part-number decoding, classes and descriptions."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import classify, partname
from plumbline.functions.partname import PART_FIELDS

# number, class, canonical name
GOLDEN = [
    ("MHB4836.133", "base", "MHB4836.133"),
    ("MHB6048FF/DE2-3", "base", "MHB6048FF/DE2-3"),
    ("MHB48120", "base", "MHB48120"),
    ("MHL6030-TA", "non-base", "MHL6030"),
    ("50424-C", "non-base", "MHC4824"),
    ("70448-B133ES", "base", "MHB4848.133ES"),
    ("70448-B116", "base", "MHB4848.1.16"),
    ("50306-GR", "non-base", "MHGR3X6"),
    ("S0472-0000", "non-base", "MHS4872"),
    ("C0472-001", "non-base", "MHCC4872"),
    ("L0448-01000", "non-base", "MHL48HATCH"),
    ("6041.33", "base", "MHB6048.133"),
    ("482-6BP1.33", "base", "MHB4830.133"),
    ("484SR", "rehab", "RMH4848"),
    ("601SNB", "non-base", "MHS6012NB"),
    ("6036CC", "non-base", "MHCC6036"),
    ("6030CR", "rehab", "#MISSING"),
    ("GR364", "non-base", "MHGR36X4"),
    ("24RL", "rehab", "RMHL4824"),
    ("Q0548", "unknown", "MHS6048"),
    ("", "unknown", "#MISSING"),
    (None, "unknown", "#MISSING"),
    ("60448-BFF", "base", "MHB4848FF"),
    ("MHS7248NB-3", "non-base", "MHS7248NB-3"),
    ("MHT144-3.5", "non-base", "MHT144-3.5"),
    ("RMH4824H", "rehab", "RMH4824H"),
    ("BOXF7296120FF", "base", "BOXF7296120FF"),
    ("BOXS9648", "non-base", "BOXS9648"),
    ("MHGRB36", "non-base", "MHGRB36"),
    ("48LH", "non-base", "MHL48HATCH"),
    ("72TL", "non-base", "MHTL7272"),
    ("MHB4848 (inactive)", "base", "MHB4848"),
    ("RESALE ITEM", "unknown", "#MISSING"),
]


@pytest.fixture(scope="module")
def decode(spark):
    def run(numbers, step=partname.with_part_attributes):
        rows = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, pn string").coalesce(1)
        return [r.asDict() for r in step(rows, "pn").orderBy("i").collect()]

    return run


def test_class_and_canonical_name(evaluate, decode):
    rows = [g[0] for g in GOLDEN]
    classes = evaluate(rows, lambda c: classify.structure_class(F.lit(None).cast("string"), c))
    names = [r["gen4_name"] for r in decode(rows)]
    assert list(zip(rows, classes, names)) == GOLDEN


DECODED = {
    "MHB4836.133": dict(part_type="MHB", diameter="48", height="36", troughing=".133", de_count="0", generation="Gen4", subcategory="Standard"),
    "MHB6048FF/DE2-3": dict(part_type="MHB", diameter="60", height="48", troughing="FF", de="Yes", de_count="2", wall_variant="3"),
    "MHL6030-TA": dict(part_type="MHL", diameter="60", opening_diameter="30", lid_suffix="TA"),
    "70448-B133ES": dict(part_type="MHB", diameter="48", height="48", troughing=".133", es="Yes", generation="Gen2"),
    "50306-GR": dict(part_type="MHGR", diameter="3", height="6"),
    "482-6BP1.33": dict(part_type="MHB", diameter="48", height="30", troughing=".133", generation="Gen1"),
    "484SR": dict(part_type="RMH", subcategory="Rehab", height="48"),
    "BOXF7296120FF": dict(part_type="BOXF", subcategory="Box", diameter="72", box_length="96", height="120", box_suffix="FF", troughing="Flat Floor"),
    "RMH6036-L": dict(part_type="RMH", diameter="60", height="36", wall_variant="-L"),
    "70448-XYZ": dict(part_type="", diameter="48", height="48", subcategory="Standard"),
    "MHHF48": dict(part_type="", subcategory="", generation="Gen4"),
    "484-6": dict(part_type="", diameter="48", height="54", generation="Gen1"),
}


def test_decoded_fields(decode):
    for row in decode(list(DECODED)):
        expected = DECODED[row["pn"]]
        assert [k[3:] for k in row if k.startswith("pn_")] == PART_FIELDS
        assert {k: row["pn_" + k] for k in expected} == expected, row["pn"]


def test_current_names_are_fixed_points(decode):
    rows = [f"MHB{d}{h}{t}{e}" for d in (48, 60, 144) for h in (36, 72) for t in ("", ".5", "FF") for e in ("", "ES", "/DE")]
    rows += [f"MHC{d}{o}{w}" for d in (48, 60, 72) for o in (24, 30) for w in ("", "-2")]
    rows += [f"MHS{d}{h}{s}" for d in (48, 96) for h in (12, 120) for s in ("", "NB", "H-3")]
    assert [r["gen4_name"] for r in decode(rows)] == rows


BASE_NAMES = [
    ("MHB4836.5", "MHB4836.5"), ("60448-B133ES", "MHB4848.133ES"), ("50448-B", ""), ("F0448", "MHB4848FF"),
    ("6041.33", "MHB6048.133"), ("484BFF", "MHB4848FF"), ("MHS4848", "MHS4848"), ("junk", ""),
    ("MHB4848 (inactive)", "MHB4848"), ("604-6BFF", ""), ("482-6BP1.33", "MHB4830.133"),
]


def test_base_item_name(decode):
    got = decode([b[0] for b in BASE_NAMES], partname.with_base_item_name)
    assert [(r["pn"], r["item_name"]) for r in got] == BASE_NAMES


def test_descriptions(decode):
    cases = {
        "MHB4836.133": '48" Base 36" 1.33"', "MHB6048FF/DE2-3": '60" Base 48" Flat Floor DE2',
        "MHGR36X4": '36" Grade Ring x4', "MHL6005": '60" Lid 5" Opening', "MHL48HATCH": '48" Lid Hatch',
        "MHLHATCH": "Lid Hatch", "MHS7248NB": '72" Section 48" NB', "RMHL4830HATCH": '48" Rehab Lid Hatch',
        "BOXF7296FF": "Flat Floor Box 72x96 Flat Floor", "BOX4848120": "Box 48x48x120", "BOXL9648HATCH": "Box Lid 96x48 Hatch",
        "MT24": '24" Misc Top', "MHCC4824": '48" Conc Cone 24"', "ZZ9": "ZZ9", "": "",
        "MHT144-3.5": '144" Top 3.5', "RMH4824H": '48" Rehab Riser 24" Hole',
    }
    got = {r["pn"]: r["part_name"] for r in decode(list(cases), partname.with_description)}
    assert got == cases


def test_item_rules(evaluate):
    items = [
        ("Precast", "PR24", "PRO-RING GRADE 2"), ("Precast", "MHS4848", "SECTION NO BELL"),
        ("Precast", "603C", "60 IN CONE ECC POLYMER"), ("Joint Seal", "JM1", "MASTIC WRAP 9 IN"), ("", "X", ""),
    ]
    got = evaluate(items, classify.classify_item)
    assert [tuple(g) for g in got] == [
        ("Resale", "Pro-Ring"), ("Section", "No Bell"), ("Cone", "Eccentric"), ("Resale", "Mastic Wrap"), ("Resale", ""),
    ]
    inferred = evaluate([("PR1", ""), ("MHB48", ""), ("X", "PSX 24"), ("JM7", ""), ("A-12", ""), ("603C", ""), ("60EL", ""), ("Q", "")],
                        classify.infer_category)
    assert inferred == ["Precast", "Precast", "Connectors", "Joint Seal", "Frame & Ring", "Precast", "Precast", "Miscellaneous"]
    words = evaluate(["Rehab base", "Base", "Short Riser", "custom", "nan"], classify.class_from_word)
    assert words == ["rehab", "base", "non-base", None, None]
    assert evaluate(["PPrreeccaasstt", "Depth Plus", "Book"], classify.normal_category) == ["Precast", "Precast", "Book"]
