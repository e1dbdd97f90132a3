"""Part and item classification (C01-C04, C22-C30) as CASE chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .clean import as_col, blank_to_null, lookup, text, undouble


def first_rule(value: Column, rules: list[tuple[str, str | None]], how: str = "rlike") -> Column:
    """Label of the first rule that fits, '' rules excluded; NULL when none does."""
    tests = {"rlike": lambda k: value.rlike(k), "contains": lambda k: value.contains(k),
             "starts": lambda k: F.startswith(value, F.lit(k))}
    out = None
    for key, label in rules:
        branch = F.lit(label).cast("string")
        out = F.when(tests[how](key), branch) if out is None else out.when(tests[how](key), branch)
    return out


def part_type_from_number(pn) -> Column:
    """The longest known code the number starts with."""
    codes = sorted(K.REHAB_TYPES + K.BASE_TYPES + K.NONBASE_TYPES, key=len, reverse=True)
    return F.nullif(F.regexp_extract(F.upper(text(pn)), f"^(?:{'|'.join(codes)})", 0), F.lit(""))


def class_from_word(word) -> Column:
    """Class of a human part word; rehab before base before the rest."""
    s = F.lower(blank_to_null(word))
    s = F.when(~s.isin("none", "(blank)", "nan"), s)
    return (
        F.when(s.contains("rehab"), F.lit("rehab"))
        .when(s.contains("base"), F.lit("base"))
        .when(s.rlike("|".join(K.NONBASE_WORDS)), F.lit("non-base"))
    )


# Class by shape of the part number, first fit wins; None stays open.
CLASS_RULES = [
    (r"^RMH", "rehab"),
    (r"^BOX[SLT]", "non-base"),
    (r"^(?:BOX|MHB)", "base"),
    (r"^(?:MH|MT)", "non-base"),
    (r"^[57]\d{4}-(?:R|SR)", "rehab"),
    (r"^[57]\d{4}-(?:BX|KBX)", "non-base"),
    (r"^[57]\d{4}-(?:B|TR)", "base"),
    (r"^[57]\d{4}-.", "non-base"),
    (r"^[BFTMV]\d{4}", "base"),
    (r"^Q\d{4}", None),
    (r"^[SCLANP]\d{4}", "non-base"),
    (r"^5?GR\d", "non-base"),
    (r"^(?:24|27|30)RL$", "rehab"),
    (r"^(?:24|30)TL$", "non-base"),
]
_LEADING_DIAMETER = r"^(?:144|120|96|84|72|60|48)"


def class_from_number(pn) -> Column:
    """Base / rehab / non-base over four naming generations, NULL when undetermined."""
    s = F.upper(blank_to_null(pn))
    readable = ~s.contains(" ") | s.rlike("^(?:BOX|MH|RMH)")
    rest = F.regexp_replace(s, _LEADING_DIAMETER, "")
    letters = F.regexp_replace(rest, r"[\d.\-/]", "")
    by_letters = (
        F.when(letters.rlike("^(?:SR|RS|CR|CRC|RL|LR)$"), F.lit("rehab"))
        .when(F.startswith(letters, F.lit("B")) | rest.rlike(r"^\d+(?:\.\d+)?$"), F.lit("base"))
        .when(letters.rlike("^(?:S|C|L|T|GR)"), F.lit("non-base"))
    )
    chain = first_rule(s, CLASS_RULES).when(s.rlike(_LEADING_DIAMETER), by_letters)
    return F.when(readable, chain)


def structure_class(part_type, pn) -> Column:
    """Class by number, then by word, then by code, else unknown."""
    code = F.upper(text(part_type))
    return F.coalesce(
        class_from_number(pn),
        class_from_word(part_type),
        F.when(code.isin(K.REHAB_TYPES), F.lit("rehab"))
        .when(code.isin(K.BASE_TYPES), F.lit("base"))
        .when(code.isin(K.NONBASE_TYPES), F.lit("non-base")),
        F.lit("unknown"),
    )


# Part types by prefix, by description word, and subtypes by description word.
PRECAST_PREFIXES = [
    ("MHGR", "Grade Ring"), ("MHTL", "Taper Lid"), ("MHHF", "Flat Top"), ("MHTE", "Tee"),
    ("MHRE", "Reducer"), ("MHL", "Lid"), ("MHS", "Section"), ("MHB", "Base"), ("MHC", "Cone"),
    ("RMH", "Rehab Ring"), ("BOX", "Box Culvert"),
]
PRECAST_WORDS = [
    ("CONE", "Cone"), ("LID", "Lid"), ("SECTION", "Section"), ("BASE", "Base"),
    ("GRADE RING", "Grade Ring"), ("RISER", "Riser"),
]
PRECAST_SUBTYPES = [
    ("NO BELL", "No Bell"), ("ECCENTRIC", "Eccentric"), ("ECC POLYMER", "Eccentric"),
    ("ECC", "Eccentric"), ("FLAT", "Flat"), ("CONCENTRIC", "Concentric"),
]
RESALE_SUBTYPES = [
    ("MASTIC WRAP", "Mastic Wrap"), ("MASTIC", "Mastic"), ("GASKET", "Gasket"), ("GROUT", "Grout"),
    ("EPOXY", "Epoxy"), ("SHACKLE", "Hardware"),
]
RING_SUBTYPES = [
    ("LADTECH", "Ladtech"), ("PRO-RING", "Pro-Ring"), ("GRADE", "Grade"), ("FINISH", "Finish"),
    ("FLAT", "Flat"),
]


def classify_item(category, pn, description) -> Column:
    """struct(type, subtype) of a line item."""
    empty = F.lit("")
    precast = F.coalesce(F.lower(as_col(category)).contains("precast"), F.lit(False))
    number = F.upper(F.coalesce(as_col(pn), empty))
    words = F.upper(F.coalesce(as_col(description), empty))
    ring = precast & number.rlike("^(?:PR|HDPE)")
    kind = F.coalesce(
        first_rule(number, PRECAST_PREFIXES, "starts"), first_rule(words, PRECAST_WORDS, "contains"), empty
    )
    subtype = (
        F.when(ring, first_rule(words, RING_SUBTYPES, "contains"))
        .when(precast, first_rule(words, PRECAST_SUBTYPES, "contains"))
        .otherwise(first_rule(words, RESALE_SUBTYPES, "contains"))
    )
    return F.struct(
        F.when(precast & ~ring, kind).otherwise(F.lit("Resale")).alias("type"),
        F.coalesce(subtype, empty).alias("subtype"),
    )


def infer_category(pn, description) -> Column:
    """Category of an item that names none."""
    number = F.upper(F.coalesce(text(pn), F.lit("")))
    words = F.upper(F.coalesce(as_col(description), F.lit("")))
    return (
        F.when(number.rlike("^(?:PR|MH|RMH|BOX|SPECIAL)"), F.lit("Precast"))
        .when(number.contains("PSX") | words.contains("PSX"), F.lit("Connectors"))
        .when(words.contains("MASTIC") | words.contains("GASKET") | F.startswith(number, F.lit("JM")), F.lit("Joint Seal"))
        .when(words.contains("RING AND COVER") | words.contains("FRAME AND COVER") | number.rlike(r"^A-\d"), F.lit("Frame & Ring"))
        .when(number.rlike(r"^(?:\d{3}[A-Z]|\d{2}[A-Z]{2})"), F.lit("Precast"))
        .otherwise(F.lit("Miscellaneous"))
    )


def product_type(c) -> Column:
    """Part-type code of a product word, other words unchanged."""
    return F.coalesce(lookup(K.PRODUCT_TYPES, text(c)), text(c))


def normal_category(c) -> Column:
    """Doubled letters repaired, aliases resolved."""
    repaired = undouble(c)
    return F.coalesce(lookup(K.CATEGORY_ALIASES, F.lower(repaired)), repaired)


def confidence_tier(score) -> Column:
    """C26."""
    s = as_col(score)
    return F.when(s >= 3, F.lit("High")).when(s == 2, F.lit("Medium")).when(s == 1, F.lit("Low")).otherwise(F.lit("n/a"))


def document_depth(label) -> Column:
    """struct(rank, tier) of a document label."""
    key = text(label)
    tiers = {k: v[0] for k, v in K.DOCUMENT_DEPTH.items()}
    ranks = {k: v[1] for k, v in K.DOCUMENT_DEPTH.items()}
    return F.struct(
        F.coalesce(lookup(ranks, key), F.lit(K.DEPTH_DEFAULT[1])).alias("rank"),
        F.coalesce(lookup(tiers, key), F.lit(K.DEPTH_DEFAULT[0])).alias("tier"),
    )


def item_category(kind) -> Column:
    """C29."""
    return lookup(K.ITEM_CATEGORIES, as_col(kind))


def part_type_or_number(part_type, pn) -> Column:
    """The written part type, else the code of the number."""
    return F.coalesce(F.upper(blank_to_null(part_type)), part_type_from_number(pn))
