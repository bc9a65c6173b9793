"""Cleaning of texts, keys and flags."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers that count as missing.
MISSING_MARKERS = ("", "nan", "NaN", "<NA>")
#: What a delimited reader takes for missing.
CSV_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Spellings of a legal entity.
LEGAL_ENTITY = ("PESSOA JURÍDICA", "PESSOA JURIDICA", "PJ")
#: How they are written as a rule.
USUAL_LEGAL = ("Pessoa jurídica", "Pessoa Jurídica", "PESSOA JURÍDICA", "PJ", "pj", " pj ")
#: Spellings of yes and no.
YES, NO = ("SIM", "S", "1", "TRUE"), ("NAO", "NÃO", "N", "0", "FALSE")
#: Situation classes by a part of the text; the last that fits wins.
SITUATIONS = (("cobran", "irregular"), ("benef", "beneficio_fiscal"), ("negocia", "negociacao"), ("suspens", "suspenso_judicial"), ("garant", "garantia"))
OTHER_SITUATION = "outros"
#: Situations as the ledger writes them as a rule. Any other text is searched for the parts above.
USUAL_SITUATIONS = {"Em cobrança": "irregular", "Benefício Fiscal": "beneficio_fiscal", "Em negociação": "negociacao", "Suspenso por decisão judicial": "suspenso_judicial", "Garantia": "garantia", "Com Garantia": "garantia"}


#: White space of any script.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def trim_once(c: Column) -> Column:
    """trim_all that names c once: for filters, into which Spark copies what they name."""
    return F.btrim(c.cast("string"), F.lit(WHITE))


def trim_all(c: Column) -> Column:
    """Without white space of any script at both ends. A text whose ends are printable ASCII is not searched: that takes a
    third of the time."""
    t = c.cast("string")
    inner = lambda x: (x >= "!") & (x < "\x7f")
    return F.when(inner(t) & inner(F.substring(t, -1, 1)), t).otherwise(trim_once(t))


def known(t: Column, missing: tuple[str, ...] = MISSING_MARKERS) -> Column:
    """clean of a text that is trimmed already."""
    return F.when(~t.isin(*missing), t)


def clean(c: Column, missing: tuple[str, ...] = MISSING_MARKERS) -> Column:
    """Trimmed; the markers in `missing` become null."""
    return known(trim_all(c), missing)


def empty_to_null(c: Column) -> Column:
    return F.nullif(trim_all(c), F.lit(""))


def digits(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def only_digits(c: Column) -> Column:
    """Whether the text has nothing but digits, or nothing: hexadecimal digits, none of them a letter. That takes less time than
    a pattern, but names c three times: for a column, not for what is made of one. (A cast of other texts raises an error inside.)"""
    return F.unhex(c).isNotNull() & (F.upper(c) == F.lower(c))


def quick_digits(c: Column) -> Column:
    """digits, searched for only in texts that have other marks. It names c often: for a column, not for what is made of one."""
    return F.when(only_digits(c), c).otherwise(digits(c))


def shaped_key(c: Column) -> Column:
    """The digits of a text of the shape 12.345.678/0001-99, whatever stands in their places; of another shape, the text."""
    part = lambda a, n: F.substring(c, a, n)
    shaped = (F.length(c) == 18) & (F.concat(part(3, 1), part(7, 1), part(11, 1), part(16, 1)) == "../-")
    return F.when(shaped, F.concat(part(1, 2), part(4, 3), part(8, 3), part(12, 4), part(17, 2))).otherwise(c)


def full_key(c: Column, width: int = 14) -> Column:
    """The digits if there are exactly `width`, else null."""
    d = digits(c)
    return F.when(F.length(d) == width, d)


def root_of(key: Column, width: int = 8) -> Column:
    return F.substring(key, 1, width)


def padded(d: Column, width: int) -> Column:
    """fixed_digits of a text that has digits only, for those who make the digits in a projection of their own: Spark then
    makes them once, however often they are used."""
    return F.when(F.length(d).between(1, width), F.lpad(d, width, "0"))


def fixed_digits(c: Column, width: int) -> Column:
    """1 to `width` digits, padded with zeros on the left; else null."""
    return padded(digits(c), width)


def company_root(c: Column, width: int = 8, empty_is_zero: bool = False) -> Column:
    """Like fixed_digits; with empty_is_zero a text without digits becomes all zeros."""
    d = digits(c)
    return F.when(F.length(d).between(0 if empty_is_zero else 1, width), F.lpad(d, width, "0"))


def join_key(root: Column, order: Column, check: Column) -> Column:
    """The whole key from its parts; null if one is missing."""
    return F.concat(root, order, check)


def state(c: Column) -> Column:
    u = F.upper(trim_all(c))
    return F.when(F.length(u) == 2, u)


def lookup_root(c: Column) -> Column:
    """Of 14 digits the first 8, 8 as they are, else null (an invalid request)."""
    d = digits(c)
    return F.when(F.length(d) == 14, F.substring(d, 1, 8)).when(F.length(d) == 8, d)


def is_legal_entity(c: Column) -> Column:
    return F.coalesce(F.upper(trim_once(c)).isin(*LEGAL_ENTITY), F.lit(False))


def is_legal_raw(c: Column) -> Column:
    """is_legal_entity of a column as it was read; usual spellings are not trimmed."""
    return F.when(c.isin(*USUAL_LEGAL), True).otherwise(is_legal_entity(c))


def has_digits(c: Column, width: int) -> Column:
    """Whether the text has 1 to `width` digits: for a filter, into which Spark copies the digits of a projection before it as
    often as the test names them."""
    return c.cast("string").rlike(f"^[^0-9]*+(?:[0-9][^0-9]*+){{1,{width}}}+$")


def have_digits(parts: list[Column], widths: list[int]) -> Column:
    """has_digits of all of them. Texts of digits alone are tested at once."""
    each = [has_digits(c, w) for c, w in zip(parts, widths, strict=True)]
    plain = F.concat(parts[0].cast("string"), *(F.concat(F.lit("."), c.cast("string")) for c in parts[1:])).rlike("^" + r"\.".join(f"[0-9]{{1,{w}}}" for w in widths) + "$")
    return F.when(plain, True).otherwise(reduce(and_, each))


def has_key(c: Column, width: int = 14) -> Column:
    """Whether full_key finds one: for a filter, see has_digits."""
    return c.cast("string").rlike(f"^[^0-9]*+(?:[0-9][^0-9]*+){{{width}}}+$")


def yes_no(c: Column, upper: bool = False) -> Column:
    """1, 0 or null as a byte. upper: c is trimmed and in upper case."""
    u = c if upper else F.upper(trim_all(c))
    return F.when(u.isin(*YES), 1).when(u.isin(*NO), 0).cast("byte")


def quick_yes_no(c: Column) -> Column:
    """yes_no of a trimmed text; upper and lower case are told at once."""
    spelled = lambda words: (*words, *(w.lower() for w in words if w != w.lower()))
    return F.when(c.isin(*spelled(YES)), 1).when(c.isin(*spelled(NO)), 0).otherwise(yes_no(F.upper(c), upper=True)).cast("byte")


def quick_situation(c: Column) -> Column:
    """situation of a text; the usual ones are told at once."""
    found = None
    for usual, name in USUAL_SITUATIONS.items():
        found = F.when(c == usual, name) if found is None else found.when(c == usual, name)
    return found.otherwise(situation(c))


def situation(c: Column, lower: bool = False) -> Column:
    """lower: c is in lower case."""
    t, found = c if lower else F.lower(c.cast("string")), None
    for part, name in reversed(SITUATIONS):
        test = F.contains(t, F.lit(part))
        found = F.when(test, name) if found is None else found.when(test, name)
    return F.when(c.isNotNull(), found.otherwise(OTHER_SITUATION))


def file_state(name: Column) -> Column:
    """The two letters after _SIDA_ in a file name; NA without them."""
    return F.coalesce(F.nullif(F.upper(F.regexp_extract(name, r"(?i)_SIDA_([A-Z]{2})(?:_|\.|$)", 1)), F.lit("")), F.lit("NA"))


def path_part(path: Column, name: str) -> Column:
    """The number after name= in a path, else null."""
    return F.regexp_extract(path, rf"{name}=(\d+)", 1).try_cast("int")


def local_number(c: Column) -> Column:
    """1.234,56 from 1000 up, else four decimals with a comma."""
    swap = lambda x: F.translate(x, ",.", ".,")
    return F.when(F.abs(c) >= 1000, swap(F.format_number(c, 2))).otherwise(F.translate(F.format_number(c, 4), ".", ","))


def label(name: Column, labels: dict[str, str]) -> Column:
    """Descriptions of names; a name without one stays itself."""
    if not labels:
        return name
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)
