"""Document-text jobs over line, cell and word tables.

A document is a set of rows ``(doc_id, line_no, line)``; state that a reader would carry from line
to line is a running value along ``line_no`` (see ``scale.in_blocks``), so long documents split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.classify import classify_item, infer_category, item_category, normal_category
from plumbline.functions.clean import (
    as_col, city_without_county, form_value, lookup, release_year, standard_location, undouble_words,
)
from plumbline.functions.partname import with_item_label

from .scale import bound, in_blocks, join_spreading_nulls, top_per_key

_KNOWN = "(?i)" + K.KNOWN_CATEGORIES
_ANY = "(?i)" + K.ANY_CATEGORY
_NOT_STRUCTURE = "(?i)" + "|".join(f"(?:{p})" for p in K.NON_STRUCTURE_PATTERNS)
_STRUCTURE = "(?i)" + "|".join(f"(?:{p})" for p in K.STRUCTURE_PATTERNS)


def explode_lines(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per line of each whole text."""
    return documents.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# ---------------------------------------------------------------- T01, T03

def _category(line: Column) -> Column:
    known, any_group = F.regexp_extract(line, _KNOWN, 1), F.regexp_extract(line, _ANY, 1)
    return F.coalesce(F.nullif(known, F.lit("")), F.nullif(F.trim(any_group), F.lit("")))


def _without_category(line: Column) -> Column:
    return F.trim(F.when(line.rlike(_KNOWN), F.regexp_replace(line, _KNOWN, "")).otherwise(F.regexp_replace(line, _ANY, "")))


def garbled_weight(description) -> Column:
    """A thousands-separated weight whose digits are mixed into a word of the description."""
    tokens = F.regexp_extract_all(as_col(description), F.lit(r"([\w,]+)"), F.lit(1))
    mixed = F.filter(tokens, lambda t: t.rlike("[A-Za-z]") & t.rlike(r"\d"))
    digits = F.filter(F.transform(mixed, lambda t: F.regexp_replace(t, "[A-Za-z]", "")), lambda t: t.rlike(r"^\d{1,6}(?:,\d{3})+$"))
    return F.regexp_replace(F.get(digits, F.lit(0)), ",", "")


def line_items(lines: DataFrame, keys: list[str] | None = None, start_in_items: bool = False) -> DataFrame:
    """Line items with the category carried forward from the line that opened it.

    Items start at the first line with a category (or at once) and end at the total or the opening
    schedule.
    """
    keys = keys or ["doc_id"]
    line = F.col("line")
    marked = lines.withColumn("line", F.trim("line")).withColumn("own_category", _category(line))
    stop = line.contains("Total Precast Weight") | line.contains("Opening Schedule")
    # One pass: items are over when the last stop so far is not ahead of the first start.
    marked = in_blocks(marked, keys, "line_no", fills={"raw_category": F.col("own_category"), "last_stop": F.when(stop, F.col("line_no"))},
                       mins={} if start_in_items else {"first_start": F.when(F.col("own_category").isNotNull(), F.col("line_no"))})
    running = F.lit(True) if start_in_items else F.col("first_start").isNotNull()
    ahead = F.lit(False) if start_in_items else F.col("last_stop") < F.col("first_start")
    rows = marked.where(running & (F.col("last_stop").isNull() | ahead))
    rows = rows.withColumn("body", F.when(F.col("own_category").isNotNull(), _without_category(line)).otherwise(line))
    rows = rows.where(F.col("body").rlike(r"^\d+\s+.+$"))
    rows = rows.withColumns({
        "category": _or_empty(normal_category("raw_category")),
        "quantity": F.regexp_extract("body", r"^(\d+)\s+.+$", 1),
        "rest": F.trim(F.regexp_extract("body", r"^\d+\s+(.+)$", 1)),
    })
    precast = F.lower("category") == "precast"
    weight_tail = r"\s+([\d,]+)\s*$"
    rows = rows.withColumns({
        "weight": F.when(precast, F.regexp_replace(F.regexp_extract("rest", weight_tail, 1), ",", "")).otherwise(F.lit("")),
        "rest": F.when(precast, F.trim(F.regexp_replace("rest", weight_tail, ""))).otherwise(F.col("rest")),
    })
    shape = r"^([A-Za-z0-9][A-Za-z0-9.\-/]+)\s+(.+)$"
    numbered = F.col("rest").rlike(shape) & ~F.col("rest").rlike(r"^\d+[\"'/]")
    rows = rows.withColumns({
        "part_number": F.when(numbered, F.regexp_extract("rest", shape, 1)).otherwise(F.lit("")),
        "description": F.when(numbered, F.trim(F.regexp_extract("rest", shape, 2))).otherwise(F.col("rest")),
    })
    recovered = F.when((F.col("weight") == "") & precast, garbled_weight("description"))
    rows = rows.withColumn("weight_lbs", _or_empty(F.coalesce(recovered, F.col("weight"))))
    return rows.select(*keys, "line_no", "category", "quantity", "part_number", "description", "weight_lbs")


# ---------------------------------------------------------------- T02

def table_items(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Line items from table rows ``(doc_id, row_no, cells)``; a category cell shifts its row.

    Tables without a category, and tables whose headers are packed into one cell, yield nothing.
    """
    keys = keys or ["doc_id"]
    tidy = F.transform("cells", lambda c: _or_empty(F.trim(c)))
    rows = cells.withColumn("cells", tidy)
    known = F.exists("cells", lambda c: c.rlike(_KNOWN))
    packed = F.exists("cells", lambda c: c.contains("Quantity") & c.contains("Part Number"))
    usable = rows.groupBy(*keys).agg(F.bool_or(known).alias("known"), F.bool_or(packed).alias("packed"))
    rows = rows.join(usable.where(F.col("known") & ~F.col("packed")).select(*keys), keys, "left_semi")
    # Header labels of a line-item table.
    header = F.exists("cells", lambda c: c.isin("Quantity", "Part Number", "Description", "Weight (lbs)"))
    total = F.exists("cells", lambda c: c.contains("Total Precast Weight"))
    filled = F.exists("cells", lambda c: c != "")
    rows = rows.where(~header & ~total & filled)
    at = lambda i: _or_empty(F.get("cells", F.col("shift") + i))
    opens = F.get("cells", F.lit(0)).rlike(_KNOWN)
    rows = rows.withColumn("shift", F.when(opens, 1).otherwise(0))
    rows = in_blocks(rows, keys, "row_no", fills={"raw_category": F.when(F.col("shift") == 1, F.get("cells", F.lit(0)))})
    rows = rows.select(
        *keys, "row_no", _or_empty(normal_category("raw_category")).alias("category"), at(0).alias("quantity"),
        at(1).alias("part_number"), at(2).alias("description"), F.regexp_replace(at(3), ",", "").alias("weight_lbs"))
    return rows.where((F.col("quantity") != "") | (F.col("description") != ""))


# ---------------------------------------------------------------- T04, T05, T06

def split_part_tokens(c) -> Column:
    """struct(part_number, description) of item text without its trailing price."""
    t = F.trim(F.regexp_replace(as_col(c), r"\s*\$[\d,]+(?:\.\d{2})?$", ""))
    head, tail = F.regexp_extract(t, r"^(\S+)\s+(.+)$", 1), F.trim(F.regexp_extract(t, r"^(\S+)\s+(.+)$", 2))
    single = ~t.rlike(r"\S\s+\S")
    named = F.when(single, ~t.rlike(r"^\d")).otherwise(head.rlike(r"^[A-Za-z0-9][A-Za-z0-9._:-]*$"))
    return F.struct(
        F.when(~named, F.lit("")).when(single, t).otherwise(head).alias("part_number"),
        F.when(single & named, F.lit("")).when(named, tail).otherwise(t).alias("description"),
    )


_SECTION = r"(?i)^Structure\s+ID\s*:\s*(.+?)(?:\s+\d+\s+of\s+\d+)?\s*$"
_RESET = r"(?i)^(?:Qty\b|Total\b|For:|Ref:|Quote|Page\s+\d)"


def section_items(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Items below section headers, continuation lines joined to the item before them."""
    line = F.col("line")
    kind = (
        F.when(line.rlike(_SECTION), "section").when(line.rlike(_RESET), "reset")
        .when(line.rlike(r"^\d+\s+.+"), "item").otherwise("more")
    )
    rows = lines.withColumn("line", F.trim("line")).where(F.col("line") != "").withColumn("kind", kind)
    rows = in_blocks(
        rows, [doc_id], "line_no",
        sums={"section_no": F.when(F.col("kind") == "section", 1).otherwise(0)},
        fills={
            "structure_name": F.when(F.col("kind") == "section", F.trim(F.regexp_extract(line, _SECTION, 1))),
            # The line of the item that further text belongs to; 0 after a header or a reset.
            "item_line": F.when(F.col("kind") == "item", F.col("line_no") + 1).when(F.col("kind") != "more", F.lit(0)),
        },
    )
    rows = rows.where((F.col("section_no") > 0) & (F.col("item_line") > 0))
    rows = rows.where((F.col("kind") == "item") | ~line.rlike(r"\$[\d,]+"))
    # Continuations of one item are the wrapped lines of one table cell.
    more = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "more", F.struct("line_no", F.regexp_replace(line, r"^[()]+|[()]+$", "").alias("t"))))),
        lambda x: x["t"]), " ")
    items = rows.groupBy(doc_id, "section_no", "structure_name", "item_line").agg(
        F.max(F.when(F.col("kind") == "item", line)).alias("item"), more.alias("more"))
    items = items.withColumn("p", split_part_tokens(F.regexp_extract("item", r"^\d+\s+(.+)$", 1)))
    items = items.withColumn("description", F.col("p.description"))
    return items.select(
        doc_id, "section_no", "structure_name", (F.col("item_line") - 1).alias("line_no"),
        F.regexp_extract("item", r"^(\d+)", 1).alias("quantity"), F.col("p.part_number").alias("part_number"),
        F.trim(F.concat_ws(" ", "description", F.nullif("more", F.lit("")))).alias("description"),
        infer_category(F.col("p.part_number"), F.col("description")).alias("category"))


def word_items(words: DataFrame, doc_id: str = "doc_id", price_x: float = 410, left_x: float = 70, right_x: float = 310, end_x: float = 620) -> DataFrame:
    """Items of a two-column page from positioned words ``(doc_id, page, y, x, text)``.

    Words of one rounded height form a line; a line with a price names a structure, other lines
    hold up to one item per column.
    """
    x, text = F.col("x"), F.col("text")
    placed = words.withColumns({
        "line_y": F.round("y").cast("bigint"),
        "band": F.when((x >= left_x) & (x < right_x), 1).when((x >= right_x) & (x < end_x), 2).otherwise(0),
        "priced": F.startswith(text, F.lit("$")),
    })
    # A line of a page holds as many words as fit on paper.
    in_order = lambda keep: F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(keep, F.struct(x.alias("x"), text.alias("t"))))), lambda w: w["t"]), " ")
    by_line = placed.groupBy(doc_id, "page", "line_y").agg(
        F.bool_or("priced").alias("priced"), F.min_by(F.lower(text), x).alias("first_word"),
        in_order(x < price_x).alias("name"), in_order(F.col("band") == 1).alias("left"), in_order(F.col("band") == 2).alias("right"))
    by_line = by_line.withColumn("line_no", F.col("page") * 100_000 + F.col("line_y"))
    by_line = in_blocks(
        by_line, [doc_id], "line_no", sums={"section_no": F.when(F.col("priced"), 1).otherwise(0)},
        fills={"structure_name": F.when(F.col("priced"), undouble_words("name"))})
    # Words that open a caption line.
    caption = F.col("first_word").isin("structure", "for:", "ref:", "qty", "description")
    body = by_line.where((F.col("section_no") > 0) & ~F.col("priced") & ~caption)
    body = body.select(doc_id, "line_no", "section_no", "structure_name",
                       F.explode(F.array(F.struct(F.lit(1).alias("band"), F.col("left").alias("t")), F.struct(F.lit(2).alias("band"), F.col("right").alias("t")))).alias("c"))
    body = body.where(F.col("c.t").rlike(r"^\d+(?:\s|$)")).withColumn("p", split_part_tokens(F.regexp_replace("c.t", r"^\d+\s*", "")))
    return body.select(
        doc_id, "section_no", "structure_name", "line_no", F.col("c.band").alias("band"), F.regexp_extract("c.t", r"^(\d+)", 1).alias("quantity"),
        F.col("p.part_number").alias("part_number"), F.col("p.description").alias("description"),
        infer_category(F.col("p.part_number"), F.col("p.description")).alias("category"))


# ---------------------------------------------------------------- T07

def structure_export(cells: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Header and structure items of rows ``(doc_id, row_no, cells)`` of a structure export.

    Columns: structure, id, kind, part, other part, description, quantity, weight.
    """
    def item(row):
        cell = lambda i: _or_empty(F.trim(F.get(row, F.lit(i))))
        return F.struct(cell(0).alias("structure_name"), cell(2).alias("kind"), cell(6).alias("quantity"), cell(3).alias("part_number"),
                        cell(5).alias("description"), F.regexp_replace(cell(7), ",", "").alias("weight_lbs"))

    # Conditions on generated columns stay above them, so the cells of a row are worked out once.
    rows = cells.select(doc_id, "row_no", F.inline(F.array(bound("cells", item))))
    named = (F.col("structure_name") != "") & ~F.startswith(F.lower("structure_name"), F.lit("x"))
    items = rows.where(F.col("kind").isin(list(K.ITEM_CATEGORIES)) & named).select(
        doc_id, "row_no", "structure_name", item_category(F.col("kind")).alias("category"), "quantity", "part_number", "description", "weight_lbs")
    kind = _or_empty(F.trim(F.get("cells", F.lit(2))))
    is_item = kind.isin(list(K.ITEM_CATEGORIES))
    other = cells.where(~is_item & ~kind.isin(K.DROPPED_ITEM_KINDS))
    tidy = F.filter(F.transform("cells", lambda c: F.trim(c)), lambda c: F.coalesce(c, F.lit("")) != "")
    pairs = other.withColumn("filled", tidy).select(
        doc_id, "row_no", F.posexplode("filled").alias("pos", "value"), "filled").select(
        doc_id, F.struct("row_no", "pos").alias("at"), "value", _or_empty(F.get("filled", F.col("pos") + 1)).alias("next"))
    label = F.rtrim(F.col("value"), F.lit(":"))
    first = lambda value, when: F.min_by(value, F.when(when & (value != ""), F.col("at")))
    iso = F.regexp_extract("next", r"^(\d{4})-(\d{2})-(\d{2})", 0)
    written = F.date_format(F.try_to_date(iso, "yyyy-MM-dd"), "M/d/yyyy")
    date = F.coalesce(F.when((label == "Reported On") & (iso != ""), written), F.when(F.col("value").rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.col("value")))
    header = pairs.groupBy(doc_id).agg(
        _or_empty(first(F.col("next"), label == "Job Name")).alias("job_name"),
        _or_empty(first(F.col("next"), label == "Job Number")).alias("job_number"),
        _or_empty(first(F.col("next"), label == "Location")).alias("location"),
        _or_empty(first(F.col("next"), label.isin("Contractor", "Contractor Name"))).alias("contractor"),
        _or_empty(F.min_by(date, F.when(date.isNotNull(), F.col("at")))).alias("release_date"))
    return header, items


# ---------------------------------------------------------------- T08 - T12

HEADER_LABELS = {
    "job_name": "Job Name:", "job_number": "Job Number:", "location": "Location:", "contractor": "Contractor:", "phone": "Phone:",
}


def header_fields(lines: DataFrame, doc_id: str = "doc_id", labels: dict[str, str] | None = None) -> DataFrame:
    """What follows each label on the first line that has it, cut at a wide gap."""
    labels = labels or HEADER_LABELS
    line = F.col("line")
    after = lambda label: F.trim(F.regexp_replace(F.trim(F.substr(line, F.instr(line, label) + len(label))), r"(?:\s{3,}|\t).*$", ""))
    return lines.groupBy(doc_id).agg(*[
        _or_empty(F.min_by(after(label), F.when(line.contains(label), F.col("line_no")))).alias(name) for name, label in labels.items()])


def quote_header(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """T08 for quotes: reference, date and place, each from the first line that fits."""
    rows = lines.withColumn("t", undouble_words("line"))
    shapes = {
        "job_name": r"(?i)^Ref(?:erence)?[:\s]+(.+)",
        "release_date": r"(?i)^Quote\s+Date[:\s]+(\d{1,2}/\d{1,2}/\d{4})",
        "location": r"^([A-Za-z][A-Za-z ]+,\s*[A-Z]{2})$",
    }
    return rows.groupBy(doc_id).agg(*[
        _or_empty(F.min_by(F.trim(F.regexp_extract("t", p, 1)), F.when(F.col("t").rlike(p), F.col("line_no")))).alias(n) for n, p in shapes.items()])


def opening_schedule(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows between the schedule's title and the line-item header."""
    t = F.trim("line")
    title, at = t.contains("Opening Schedule"), F.col("line_no")
    header = t.rlike(r"^Quantity\s+Part Number") & ~title
    shape = r"^(\d+)\s+(.+?)\s{2,}(.+?)\s{2,}(\S.*?)$"
    # Other lines neither open nor close anything.
    rows = lines.where(title | header | t.rlike(shape))
    rows = in_blocks(rows, [doc_id], "line_no", mins={"opened": F.when(title, at)}, fills={"closed": F.when(header, at)})
    rows = rows.where(F.col("opened").isNotNull() & ~title & (F.col("closed").isNull() | (F.col("closed") < F.col("opened"))) & t.rlike(shape))
    part = lambda i: F.trim(F.regexp_extract(t, shape, i))
    return rows.select(doc_id, "line_no", part(1).alias("quantity"), part(2).alias("pipe_size"), part(3).alias("connector"), part(4).alias("hole_size"))


def is_structure_name(c) -> Column:
    """a line that names a structure and is none of the known other things."""
    t = F.trim(as_col(c))
    return (t != "") & ~t.rlike(_NOT_STRUCTURE) & t.rlike(_STRUCTURE)


def structure_name(c) -> Column:
    """T10 for one line: the name, from after a ``label:`` in front of it, without a ship date."""
    t = F.trim(as_col(c))
    candidates = []
    for pattern in K.STRUCTURE_PATTERNS:
        if pattern.startswith("^"):
            candidates.append(F.when(t.rlike("(?i)" + pattern), t))
        else:
            at_first = rf"(?i)^(?:(?!{pattern}).)*:\s*(?={pattern})"
            candidates.append(F.when(t.rlike("(?i)" + pattern), F.when(t.rlike(at_first), F.regexp_replace(t, at_first, "")).otherwise(t)))
    name = F.coalesce(*candidates)
    return F.trim(F.regexp_replace(name, r"(?i)\s+Ship Date.*$", ""))


def structure_names(lines: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The first line of every document (or page) that names a structure."""
    keys = keys or ["doc_id"]
    hits = lines.where(is_structure_name("line"))
    return hits.groupBy(*keys).agg(structure_name(F.min_by("line", "line_no")).alias("structure_name"))


def total_weight(lines: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The first total weight of every document."""
    shape = r"Total Precast Weight\s+([\d,]+)"
    hits = lines.where(F.col("line").rlike(shape))
    value = F.regexp_replace(F.regexp_extract(F.min_by("line", "line_no"), shape, 1), ",", "").try_cast("int")
    return hits.groupBy(doc_id).agg(value.alias("total_precast_weight"))


def release_date(words: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Lowest date in the bottom right corner, from words ``(x, y, width, height, text)``."""
    corner = (F.col("y") > F.col("height") * 0.88) & (F.col("x") > F.col("width") * 0.60)
    hits = words.where(corner & F.col("text").rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"))
    return hits.groupBy(doc_id).agg(F.max_by("text", F.struct(F.col("y"), (-F.col("x")).alias("x"))).alias("release_date"))


def customer_form(forms: DataFrame, text: str = "text", customer_label: str = "Business Name of Customer") -> DataFrame:
    """Job-site place, else billing place, with the tag of where it came from."""
    value = lambda label: form_value(text, label)
    site_city, site_state = value("Job Site City"), value("Job Site State")
    bill_city, bill_state = value("Billing City"), value("Billing State")
    either = lambda a, b: F.when(a != "", a).otherwise(b)
    staged = forms.withColumns({"_sc": site_city, "_ss": site_state, "_bc": bill_city, "_bs": bill_state})
    on_site = (F.col("_sc") != "") & (F.col("_ss") != "")
    abbreviated = lambda c: F.coalesce(lookup(K.STATE_CODES, F.upper(c)), c)
    staged = staged.withColumns({
        "_city": city_without_county(F.when(on_site, F.col("_sc")).otherwise(either(F.col("_sc"), F.col("_bc")))),
        "_state": abbreviated(F.when(on_site, F.col("_ss")).otherwise(either(F.col("_ss"), F.col("_bs")))),
        "location_source": F.when(on_site, "NCF Job Site").when((F.col("_bc") != "") | (F.col("_bs") != ""), "NCF Billing").otherwise(""),
        "zipcode": F.when(on_site, value("Job Site Zip Code")).otherwise(F.lit("")),
        "job_name": value("Name of Job"), "customer": value(customer_label),
    })
    return staged.withColumn("location", F.concat_ws(", ", F.nullif("_city", F.lit("")), F.nullif("_state", F.lit("")))).drop(
        "_sc", "_ss", "_bc", "_bs", "_city", "_state")


# ---------------------------------------------------------------- T13 - T17

def build_rows(items: DataFrame, headers: DataFrame, forms: DataFrame, overrides: DataFrame, drive_year: str = "drive_year") -> DataFrame:
    """The line-item table - items with header, form and overrides.

    ``items`` has doc_id, job_code, file_name, drive_year and the item columns; ``headers`` is keyed
    by doc_id, ``forms`` and ``overrides`` by job_code.
    """
    h = headers.select("doc_id", *[F.col(c).alias(f"h_{c}") for c in ("job_name", "location", "contractor", "release_date")])
    f = forms.select("job_code", *[F.col(c).alias(f"f_{c}") for c in ("location", "location_source", "zipcode", "job_name", "customer")])
    o = overrides.select("job_code", F.col("location").alias("o_location"), F.col("source").alias("o_source"))
    rows = join_spreading_nulls(join_spreading_nulls(items.join(h, "doc_id", "left"), f, ["job_code"]), o, ["job_code"])
    given = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    from_header, from_form = given("h_location"), given("f_location")
    place = standard_location(F.coalesce(from_header, from_form))
    source = F.when(from_header.isNotNull(), "BOM").when(from_form.isNotNull(), F.coalesce("f_location_source", F.lit("NCF"))).otherwise(given("o_source"))
    rows = with_item_label(rows, "part_number", "description")
    kind = classify_item("category", "part_number", "description")
    return rows.withColumn("kind", kind).select(
        "doc_id", "job_code", "structure_name", "part_number", "part_name", "quantity", "weight_lbs", "category",
        F.col("kind.type").alias("part_type"), F.col("kind.subtype").alias("part_subtype"),
        release_year("h_release_date", "file_name", drive_year).alias("year_release"),
        _or_empty(F.col("h_release_date")).alias("release_date"),
        _or_empty(F.coalesce(given("h_job_name"), given("f_job_name"))).alias("project_name"),
        _or_empty(F.coalesce(place, given("o_location"))).alias("job_location"), _or_empty(source).alias("location_source"),
        _or_empty(F.col("f_zipcode")).alias("zip_code"), _or_empty(F.coalesce(given("h_contractor"), given("f_customer"))).alias("contractor"))


def flatten(nested: DataFrame, header: str, items: str) -> DataFrame:
    """Nested documents as flat rows; a structure without items keeps one blank row."""
    return nested.select("*", F.explode_outer(items).alias("_item")).select(
        *[c for c in nested.columns if c not in (header, items)], f"{header}.*", "_item.*")


def extraction_quality(items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Precast items, and those without a weight, per document."""
    precast = F.lower("category") == "precast"
    return items.groupBy(doc_id).agg(
        F.count("*").alias("items"), F.count_if(precast).alias("precast"),
        F.count_if(precast & (F.coalesce("weight_lbs", F.lit("")) == "")).alias("no_weight"))


def shop_drawing(lines: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Job name and structures of a drawing set.

    ``lines`` has doc_id, page, line_no, line and ``items`` doc_id, page, row_no and item columns. The
    job name is the first longer line of the first page's first 15; each page names one structure,
    and a structure collects the items of all of its pages.
    """
    t = F.trim("line")
    long_enough = (F.col("page") == 0) & (F.col("line_no") < 15) & (F.length(t) > 4) & ~t.rlike(r"^\d")
    names = lines.where(long_enough).groupBy("doc_id").agg(F.min_by(t, "line_no").alias("job_name"))
    pages = structure_names(lines, ["doc_id", "page"])
    placed = pages.join(items, ["doc_id", "page"], "left")
    with_items = placed.where(F.col("row_no").isNotNull())
    empty = placed.join(with_items.select("doc_id", "structure_name").distinct(), ["doc_id", "structure_name"], "left_anti")
    first = empty.groupBy("doc_id", "structure_name").agg(F.min("page").alias("page"))
    blank = first.select("doc_id", "structure_name", "page", *[F.lit("").alias(c) for c in ("category", "quantity", "part_number", "description", "weight_lbs")])
    both = with_items.select(*blank.columns, "row_no").unionByName(blank.withColumn("row_no", F.lit(None).cast("int")))
    return names, both


def skipped_prefixes(names: DataFrame, name: str) -> DataFrame:
    """Names no pattern fits, by leading letters, with a count and three examples."""
    prefix = F.upper(F.regexp_extract(F.col(name), r"^([A-Za-z]+)", 1))
    keyed = names.withColumn("prefix", F.when(prefix == "", F.lit("(non-alpha)")).otherwise(prefix))
    counts = keyed.groupBy("prefix").agg(F.count("*").alias("n"))
    examples = top_per_key(keyed.select("prefix", F.col(name).alias("_name")).distinct(), ["prefix"], [F.asc("_name")], 3)
    listed = examples.groupBy("prefix").agg(F.array_join(F.array_sort(F.collect_list("_name")), ", ").alias("examples"))
    return counts.join(listed, "prefix")
