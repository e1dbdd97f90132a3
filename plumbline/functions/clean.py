"""Cleaning expressions (N01-N47): every function maps columns to a column, all JVM-side."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_CODES = "|".join(sorted(K.STATE_CODES.values()))


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    return F.trim(as_col(c).cast("string"))


def blank_to_null(c) -> Column:
    return F.nullif(text(c), F.lit(""))


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(table), key)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def is_formula(c) -> Column:
    return F.startswith(text(c), F.lit("="))


# ---------------------------------------------------------------- missing values and text

def is_blank(c) -> Column:
    """Null, or a token that stands for a missing value."""
    return F.coalesce(F.upper(text(c)).isin(K.MISSING_TOKENS), F.lit(True))


def present_text(c) -> Column:
    """Trimmed upper text, NULL where the value is missing (the vote's customer/plant form)."""
    return F.when(~is_blank(c), F.upper(text(c)))


def safe_text(c, formulas: bool = True, null_words: bool = True) -> Column:
    """Trimmed text; formula strings and written-out nulls become NULL."""
    t = blank_to_null(c)
    if formulas:
        t = F.when(~F.startswith(t, F.lit("=")), t)
    if null_words:
        t = F.when(~F.lower(t).isin("none", "nan"), t)
    return t


def norm_part_number(c) -> Column:
    """N11."""
    t = blank_to_null(c)
    return F.when(~F.lower(t).isin("none", "#missing"), t)


def first_non_blank(*cols) -> Column:
    """The first non-empty of several columns of one row."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def filled_count(*cols) -> Column:
    """How many of the columns hold something."""
    return reduce(lambda a, b: a + b, [F.when(blank_to_null(c).isNotNull(), 1).otherwise(0) for c in cols])


# ---------------------------------------------------------------- places

def _place_words(c, drop: str) -> Column:
    return F.nullif(squeeze(F.regexp_replace(F.upper(as_col(c)), drop, " ")), F.lit(""))


def norm_city_simple(c) -> Column:
    """Upper text without dots and commas."""
    return _place_words(c, "[.,]")


def norm_city(c) -> Column:
    """N04 without formulas, lone state codes and a trailing state code."""
    words = F.when(~is_formula(c), norm_city_simple(c))
    return F.when(~words.rlike(f"^(?:{_CODES})$"), F.regexp_replace(words, rf"\s(?:{_CODES})$", ""))


def is_county(c) -> Column:
    """COUNTY appears as a word of its own."""
    return F.coalesce(F.upper(as_col(c)).rlike(r"(?:^|\s)COUNTY(?:\s|$)"), F.lit(False))


def norm_county(c) -> Column:
    """County name without a trailing state code and without the word COUNTY."""
    words = F.regexp_replace(_place_words(c, ","), rf"\s(?:{_CODES})$", "")
    return F.nullif(F.trim(F.regexp_replace(words, r"(?:^|\s)COUNTY$", "")), F.lit(""))


def norm_state(c) -> Column:
    """Two-letter code from a code or a full name."""
    s = F.upper(text(c))
    return F.coalesce(F.when(s.rlike(f"^(?:{_CODES})$"), s), lookup(K.STATE_CODES, s))


def state_two_letters(c) -> Column:
    """Any two-letter text, upper case."""
    return F.when(F.length(text(c)) == 2, F.upper(text(c)))


def state_or_passthrough(c) -> Column:
    """Two letters as they are, else the code of a full name."""
    return F.coalesce(state_two_letters(c), lookup(K.STATE_CODES, F.upper(text(c))))


def zip_text(c) -> Column:
    """N09 for text: cut ZIP+4, keep exactly five digits."""
    head = F.substring_index(text(c), "-", 1)
    return F.when(head.rlike(r"^\d{5}$"), head)


def zip_number(c) -> Column:
    """N09 for numbers: whole part, padded to five digits."""
    digits = as_col(c).try_cast("bigint").cast("string")
    return F.when(digits.rlike(r"^\d{1,5}$"), F.lpad(digits, 5, "0"))


def norm_zip(c, numeric: bool = False, allow_zero: bool = False) -> Column:
    z = zip_number(c) if numeric else zip_text(c)
    return z if allow_zero else F.nullif(z, F.lit("00000"))


def zip_five(c) -> Column:
    """First five characters, blank becomes NULL."""
    return F.nullif(F.substring(text(c), 1, 5), F.lit(""))


def split_last_comma(c) -> tuple[Column, Column]:
    """Both sides of the last comma; the tail is NULL where there is none."""
    t = text(c)
    has = t.contains(",")
    head = F.when(has, F.regexp_extract(t, r"(?s)^(.*),([^,]*)$", 1)).otherwise(t)
    tail = F.when(has, F.regexp_extract(t, r"(?s)^(.*),([^,]*)$", 2))
    return F.nullif(F.trim(head), F.lit("")), F.nullif(F.trim(tail), F.lit(""))


def parse_location(c) -> Column:
    """struct(city, state) split at the last comma, country suffix removed."""
    trimmed = F.trim(F.regexp_replace(text(c), r"(?i),?\s*(?:USA|US)$", ""))
    city, state = split_last_comma(trimmed)
    return F.struct(city.alias("city"), state_or_passthrough(state).alias("state"))


def split_location_first(c, city=None, state=None) -> Column:
    """Split at the first comma and fill only what is missing."""
    parts = F.split(text(c), ",", 2)
    has = F.size(parts) == 2
    head = F.when(has, F.nullif(F.trim(F.get(parts, F.lit(0))), F.lit("")))
    tail = F.when(has, F.nullif(F.trim(F.get(parts, F.lit(1))), F.lit("")))
    known_city = blank_to_null(city) if city is not None else F.lit(None).cast("string")
    known_state = blank_to_null(state) if state is not None else F.lit(None).cast("string")
    return F.struct(
        F.coalesce(known_city, head).alias("city"), F.coalesce(known_state, tail).alias("state")
    )


def standard_location(c) -> Column:
    """``City, ST`` with full state names abbreviated."""
    t = as_col(c)
    city, state = split_last_comma(t)
    abbreviated = F.coalesce(lookup(K.STATE_CODES, F.upper(state)), state, F.lit(""))
    whole = F.coalesce(lookup(K.STATE_CODES, F.upper(F.trim(t))), t)
    return F.when(t.contains(","), F.concat_ws(", ", F.coalesce(city, F.lit("")), abbreviated)).otherwise(whole)


def city_without_county(c) -> Column:
    """N41."""
    return F.trim(F.regexp_replace(as_col(c), r"(?i)\s*,?\s*\w+ County.*$", ""))


def city_variants(c) -> Column:
    """The city and its abbreviated / spelled-out prefix forms, in that order."""
    city = as_col(c)
    forms = [city]
    for short, full in K.CITY_PREFIXES:
        forms.append(F.when(F.startswith(city, F.lit(short)), F.concat(F.lit(full), F.substr(city, F.lit(len(short) + 1)))))
        forms.append(F.when(F.startswith(city, F.lit(full)), F.concat(F.lit(short), F.substr(city, F.lit(len(full) + 1)))))
    return F.array_compact(F.array(*forms))


def route_location(c) -> Column:
    """One raw location as an array of (field, norm, raw) observations.

    ``City, ST`` gives a city (or county) and a state; text whose tail is no state is a street
    address.
    """
    raw = as_col(c)
    head, tail = split_last_comma(raw)
    state = norm_state(tail)
    item = lambda name, value: F.struct(F.lit(name).alias("field"), value.alias("norm"), raw.alias("raw"))
    place = F.when(is_county(head), item("county", norm_county(head))).otherwise(item("city", norm_city(head)))
    routed = F.when(state.isNotNull(), F.array(place, item("state", state))).otherwise(
        F.array(item("street_address", text(raw)))
    )
    routed = F.when(raw.contains(","), routed)
    return F.filter(routed, lambda x: x["norm"].isNotNull())


# ---------------------------------------------------------------- keys and plants

def valid_key(c, pattern: str = ".+", mode: str = "full", squeeze_spaces: bool = False,
              upper: bool = True) -> Column:
    """The key where it fits ``pattern``; ``mode`` is full match or matching prefix."""
    t = safe_text(c, formulas=False, null_words=False)
    t = F.when(F.lower(t) != "none", t)
    if squeeze_spaces:
        t = F.regexp_replace(t, r"\s+", "")
    if upper:
        t = F.upper(t)
    anchor = f"^(?:{pattern})$" if mode == "full" else f"^(?:{pattern})"
    return F.nullif(F.regexp_extract(t, anchor, 0), F.lit(""))


def job_code(c) -> Column:
    return valid_key(c)


def three_letter_code(c) -> Column:
    return valid_key(c, "[A-Z]{3}")


def lettered_code(c, mode: str = "full") -> Column:
    return valid_key(c, "[A-E][A-Z0-9]{2}", mode, squeeze_spaces=True)


def plant_code(c) -> Column:
    """Mapped plant, else its first two letters."""
    t = blank_to_null(c)
    return F.coalesce(
        lookup(K.PLANT_CODES, F.lower(t)),
        F.when(F.length(t) >= 2, F.upper(F.substring(t, 1, 2))).otherwise(t),
    )


def plant_codes_multi(c) -> Column:
    """Several plants split at '/', mapped, distinct, sorted and joined again."""
    codes = F.transform(F.split(text(c), "/"), lambda p: lookup(K.PLANT_CODES, F.lower(F.trim(p))))
    known = F.array_sort(F.array_distinct(F.array_compact(codes)))
    return F.nullif(F.array_join(known, "/"), F.lit(""))


def plant_by_prefix(c) -> Column:
    """Plant whose name the text starts with, else the text."""
    t = blank_to_null(c)
    rules = [F.when(F.startswith(F.upper(t), F.lit(p.upper())), F.lit(p)) for p in K.PLANT_NAMES]
    return F.coalesce(*rules, t)


# ---------------------------------------------------------------- dates and numbers

def year_in_text(c) -> Column:
    """The first 19xx/20xx year anywhere in the text."""
    return F.regexp_extract(as_col(c).cast("string"), r"((?:19|20)\d{2})", 1).try_cast("int")


def true_year_month(c) -> Column:
    """struct(year, month) of a real date, NULL otherwise."""
    d = as_col(c).try_cast("date")
    return F.struct(F.year(d).alias("year"), F.month(d).alias("month"))


def leading_year(c) -> Column:
    """The first four characters as a number."""
    return F.substring(text(c), 1, 4).try_cast("int")


def release_year(release_date, file_name, drive_year) -> Column:
    """Third part of an M/D/YYYY release date, else the file-name date, else the drive year."""
    part = F.try_element_at(F.split(as_col(release_date), "/"), F.lit(3))
    three = F.size(F.split(as_col(release_date), "/")) == 3
    from_name = F.nullif(F.regexp_extract(as_col(file_name), r"\b\d{1,2}\.\d{1,2}\.(\d{2})\b", 1), F.lit(""))
    return F.coalesce(
        F.when(three & part.rlike(r"^\d+$"), part),
        F.concat(F.lit("20"), from_name),
        as_col(drive_year).cast("string"),
    )


def _dates(c, formats: list[str]) -> Column:
    return F.coalesce(*[F.try_to_date(text(c), f) for f in formats])


def parse_date(c, formats: tuple = ("yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "d-MMM-yyyy", "yyyy/M/d")) -> Column:
    """Several written formats, then a spreadsheet day number between 30000 and 60000."""
    serial = text(c).try_cast("double").try_cast("int")
    from_serial = F.when((serial > 30000) & (serial < 60000), F.date_add(F.lit("1899-12-30").cast("date"), serial))
    return F.coalesce(_dates(c, list(formats)), from_serial)


def parse_iso_or_us(c) -> Column:
    """ISO or M/D/YYYY after cutting a time part."""
    return _dates(F.substring_index(text(c), "T", 1), ["yyyy-M-d", "M/d/yyyy"])


def date_key(c) -> Column:
    """Date as text, '' for NULL."""
    return F.coalesce(F.date_format(as_col(c), "yyyy-MM-dd"), F.lit(""))


def quantity(c) -> Column:
    """Whole quantity, unreadable or blank counts as one; zero stays for the caller's filter."""
    return F.coalesce(as_col(c).try_cast("double").try_cast("bigint"), F.lit(1).cast("bigint"))


def barrel_diameter(c) -> Column:
    """Number restricted to the known diameters, as text."""
    n = text(c).try_cast("double").try_cast("int")
    return F.when(n.isin(K.BARREL_DIAMETERS), n.cast("string"))


# ---------------------------------------------------------------- text shapes

def link_text(c) -> Column:
    """Display text of a hyperlink formula, else the trimmed text."""
    shown = F.regexp_extract(as_col(c), r'HYPERLINK\("[^"]*",\s*"([^"]+)"\)', 1)
    return F.when(shown != "", F.trim(shown)).otherwise(text(c))


def title_words(c) -> Column:
    """Title case with small words kept small."""
    t = F.initcap(text(c))
    t = F.regexp_replace(t, " Of ", " of ")
    return F.regexp_replace(t, " And ", " and ")


def safe_file_name(c) -> Column:
    """Without characters that file systems refuse."""
    return F.trim(F.regexp_replace(as_col(c), r'[\\/*?:"<>|]', ""))


def front_matter_value(c) -> Column:
    """Quoted where a colon would break the front matter."""
    v = as_col(c)
    return F.when(v.contains(":") | (v != F.trim(v)), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(F.coalesce(v, F.lit("")))


def code_to_int(c, letters: int = 3) -> Column:
    """Base-26 value of a letter code."""
    t = F.upper(as_col(c))
    digits = [(F.ascii(F.substring(t, i + 1, 1)) - 65).cast("bigint") * (26 ** (letters - 1 - i)) for i in range(letters)]
    return reduce(lambda a, b: a + b, digits)


def int_to_code(c, letters: int = 3) -> Column:
    """Letter code of a base-26 value, wrapping past the last one."""
    n = as_col(c).cast("bigint")
    return F.concat(*[F.char(65 + F.pmod(F.floor(n / (26 ** (letters - 1 - i))), F.lit(26))) for i in range(letters)])


def has_either_way(a, b) -> Column:
    """Either text contains the other, ignoring case."""
    x, y = F.lower(as_col(a)), F.lower(as_col(b))
    both = (F.length(x) > 0) & (F.length(y) > 0)
    return F.coalesce(both & (x.contains(y) | y.contains(x)), F.lit(False))


def same_words(a, b) -> Column:
    """Equal after collapsing spaces and case; NULL unless both are given."""
    tidy = lambda c: F.nullif(F.trim(F.regexp_replace(F.lower(as_col(c)), r"\s+", " ")), F.lit(""))
    return tidy(a) == tidy(b)


def label_value(c, label: str) -> Column:
    """What follows a label on its line, cut at the next wide gap."""
    after = F.regexp_extract(as_col(c), re.escape(label) + r"[^\S\n]*([^\n]*)", 1)
    return F.trim(F.regexp_replace(F.trim(after), r"(?:\s{3,}|\t).*$", ""))


def form_value(c, label: str) -> Column:
    """N45 for form text: ``label: value`` up to a double space, ignoring case."""
    return F.trim(F.regexp_extract(as_col(c), "(?i)" + re.escape(label) + r"\s*:?\s+(.+?)(?:\s{2,}|$)", 1))


def _undouble(word: Column) -> Column:
    doubled = (F.length(word) >= 4) & word.rlike(r"^(?:(.)\1)+$")
    return F.when(doubled, F.regexp_replace(word, r"(.)\1", "$1")).otherwise(word)


def undouble(c) -> Column:
    """``PPrreeccaasstt`` back to ``Precast``."""
    return _undouble(as_col(c))


def undouble_words(c) -> Column:
    return F.array_join(F.transform(F.split(squeeze(as_col(c)), " "), _undouble), " ")


def troughing(c) -> Column:
    """Written troughing depth in its canonical form ('' when absent)."""
    t = F.coalesce(text(c), F.lit(""))
    return (
        F.when(t.rlike(r"^1\.3{1,2}$"), F.lit(".133"))
        .when(t.rlike(r"^1(?:\.0?)?$"), F.lit(".1"))
        .when(F.startswith(t, F.lit("0.")), F.substr(t, F.lit(2)))
        .otherwise(t)
    )


# ---------------------------------------------------------------- file names

def file_extension(c) -> Column:
    return F.lower(F.regexp_extract(as_col(c), r"(\.[^.]*)$", 1))


def classify_document(c, rules=None) -> Column:
    """Label of the first rule whose keyword and extension both fit, else NULL."""
    name = F.lower(as_col(c))
    ext = file_extension(c)
    hits = [F.when(name.contains(k) & (ext == e), F.lit(v)) for k, e, v in rules or K.DOCUMENT_RULES]
    return F.coalesce(*hits)


def document_priority(label) -> Column:
    return F.coalesce(lookup(K.DOCUMENT_PRIORITY, as_col(label)), F.lit(99))


def is_customer_form(c) -> Column:
    """N33."""
    return F.lower(as_col(c)).rlike(r"_[ne]cf\.docx$")


def is_any_bom_pdf(c) -> Column:
    """N32, simple form."""
    name = F.lower(as_col(c))
    return name.contains("bom") & F.endswith(name, F.lit(".pdf"))


def file_name_date(c) -> Column:
    """M.D.YY inside a file name as struct(y, m, d); zeros when absent."""
    pattern = r"\b(\d{1,2})\.(\d{1,2})\.(\d{2})\b"
    part = lambda i: F.coalesce(F.regexp_extract(as_col(c), pattern, i).try_cast("int"), F.lit(0))
    year = F.when(as_col(c).rlike(pattern), part(3) + 2000).otherwise(F.lit(0))
    return F.struct(year.alias("y"), part(1).alias("m"), part(2).alias("d"))


_DASH = "[-–—û]"


def folder_code(c, pattern: str = "[A-Z]{2,4}") -> Column:
    """Key at the start of a ``KEY - name`` folder."""
    return F.nullif(F.upper(F.regexp_extract(F.trim(as_col(c)), rf"^({pattern})\s*{_DASH}\s*.+$", 1)), F.lit(""))


def folder_title(c, pattern: str = "[A-Z]{2,4}") -> Column:
    return F.coalesce(
        F.nullif(F.trim(F.regexp_extract(F.trim(as_col(c)), rf"^{pattern}\s*{_DASH}\s*(.+)$", 1)), F.lit("")),
        F.trim(as_col(c)),
    )


def order_contractor(c) -> Column:
    """Contractor named in a purchase-order file name."""
    return F.nullif(F.trim(F.regexp_extract(as_col(c), rf"(?i)^[A-Z]{{2,5}}\s*[-–—]\s*(.+?)_PO#", 1)), F.lit(""))


def resolve_code(folder, file_name, subfolder, job_number, job_name, pattern: str = "[A-Z]{2,4}") -> Column:
    """Key from the folder, the file name, the first subfolder, then the document header."""
    lead = lambda c, tail: F.nullif(F.regexp_extract(as_col(c), rf"^({pattern}){tail}", 1), F.lit(""))
    first_folder = F.substring_index(F.coalesce(as_col(subfolder), F.lit("")), "/", 1)
    in_header = [lead(F.upper(text(c)), r"(?=[^A-Z]|$)") for c in (job_number, job_name)]
    return F.coalesce(
        F.coalesce(folder_code(folder, pattern), valid_key(folder, pattern, upper=False)),
        lead(file_name, r"\s"),
        folder_code(first_folder, pattern),
        *in_header,
    )


def summary_structure(file_name, job_name, keep_job_name: bool = True) -> Column:
    """Structure tag inside a summary's file name."""
    name = F.regexp_replace(as_col(file_name), r"(?i)-(?:Selected-)?BOM Summary\.pdf$", "")
    rest = F.regexp_replace(name, r"^[A-Z]{3}\s+\d+\.\d+\.\d{2}\s+", "")
    job = F.trim(F.regexp_replace(F.coalesce(as_col(job_name), F.lit("")), r"^[A-Z]{3}\s+", ""))
    lead = (job != "") & F.startswith(rest, job)
    tag = F.trim(F.regexp_replace(F.substr(rest, F.length(job) + 1), r"^-+", ""))
    if not keep_job_name:
        return F.when(lead, tag).otherwise(F.lit(""))
    picked = F.when(lead, tag).otherwise(F.trim(rest))
    return F.coalesce(F.nullif(picked, F.lit("")), as_col(job_name), F.lit(""))


# ---------------------------------------------------------------- composite text and lists

def composite_id(*parts, sep: str = "::") -> Column:
    """An id from its parts; a missing part stays visible as an empty one."""
    return F.concat_ws(sep, *[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def comma_list(c) -> Column:
    """Trimmed non-empty parts of a comma-separated text."""
    return F.filter(F.transform(F.split(as_col(c), ","), lambda x: F.trim(x)), lambda x: x != "")
