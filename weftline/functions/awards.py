"""Award identifiers: parsing, canonical forms and search variants, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .clean import let, strip

NIH, NSF = "01cwqze88", "021nxhr62"
JUNK = """- 0 0000 001 1 12 123 1234 12345 123456 12345678 123456789 123457 none abc123 abcdef n/a na na.com nil pending tbd
unspecified xxxxxxxxxxxxxxxxx""".split() + [
    "", "not applicable", "not assigned", "not yet assigned", "no aplica", "sem numero", "sem numeros", "no numbered yet",
    "no grat numbered yet", "internally funded", "independent departmental funds", "em elaboração",
]


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def nih(text: Column) -> Column:
    """struct(application_type, activity_code, institute_code, serial_number, support_year, other_suffixes).

    NULL unless two letters and six digits are found.  A prefix or suffix that fits no rule is left out.
    """
    return let(strip(F.regexp_replace(F.upper(text), "[- ]", "")), _nih)


def _nih(s: Column) -> Column:
    core = "^(.*?)([A-Z]{2})([0-9]{6})(.*)$"
    part = lambda k: F.regexp_extract(s, core, k)
    before = F.replace(F.replace(part(1), F.lit("RO1"), F.lit("R01")), F.lit("NIH"), F.lit(""))
    after = part(4)
    kind = F.when(F.length(before) != 3, F.regexp_extract(before, "^([1-9])([0-9A-Z]{3})?$", 1))
    activity = F.when(F.length(before) == 3, F.regexp_extract(before, "^([0-9A-Z]{3})$", 1)).otherwise(F.regexp_extract(before, "^[1-9]([0-9A-Z]{3})$", 1))
    long = "^([0-9]{2})([0-9A-Z]{2,4})$"
    year = F.when(F.length(after) == 2, F.regexp_extract(after, "^([0-9]{2})$", 1)).otherwise(F.regexp_extract(after, long, 1))
    more = F.when(F.length(after) == 2, F.when(after.rlike("^[0-9]{2}$"), "").otherwise(after)).otherwise(F.regexp_extract(after, long, 2))
    fields = {"application_type": kind, "activity_code": activity, "institute_code": part(2), "serial_number": part(3), "support_year": year, "other_suffixes": more}
    return F.when(s.rlike(core), F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), _some(v))]))


def nih_text(a: Column) -> Column:
    """The canonical identifier of a parsed award."""
    return let(a, _nih_text)


def _nih_text(a: Column) -> Column:
    tail = F.concat_ws("", a["support_year"], a["other_suffixes"])
    whole = F.concat_ws("", a["application_type"], a["activity_code"], a["institute_code"], a["serial_number"], F.when(tail != "", F.concat(F.lit("-"), tail)))
    return F.when(a.isNotNull(), whole)


def nih_url(appl_id: Column) -> Column:
    return F.concat(F.lit("https://reporter.nih.gov/project-details/"), appl_id.cast("string"))


def nih_variants(a: Column) -> Column:
    """Every spelling to search for: with and without year, suffix, activity code, application type and spaces."""
    return let(a, _nih_variants)


def _nih_variants(a: Column) -> Column:
    base = F.concat_ws(" ", a["institute_code"], a["serial_number"])
    dated = F.concat(base, F.lit("-"), a["support_year"])
    forms = F.array_compact(F.array(base, dated, F.concat(dated, a["other_suffixes"])))
    both = lambda xs: F.array_distinct(F.concat(xs, F.transform(xs, lambda x: F.replace(x, F.lit(" "), F.lit("")))))

    def headed(xs: Column, head: Column) -> Column:
        spaced = F.transform(xs, lambda x: F.concat(head, F.lit(" "), x))
        tight = F.transform(xs, lambda x: F.concat(head, F.replace(x, F.lit(" "), F.lit(""))))
        return F.when(head.isNull(), xs).otherwise(F.array_distinct(F.concat(xs, spaced, tight)))

    return F.when(a.isNotNull(), F.array_sort(headed(headed(both(forms), a["activity_code"]), a["application_type"])))


def nsf(text: Column) -> Column:
    """struct(org_id, award_id): from an award URL, letters and seven digits, or seven digits; else NULL."""
    url = _some(F.regexp_extract(text, "AWD_ID=([0-9]+)", 1))
    s = strip(F.replace(F.replace(text, F.lit("NSF-"), F.lit("")), F.lit("NSF"), F.lit("")))
    pair = "([A-Z]{3,4})([0-9]{7})"
    org = F.when(url.isNull(), _some(F.regexp_extract(s, pair, 1)))
    number = F.coalesce(url, _some(F.regexp_extract(s, pair, 2)), F.regexp_substr(s, F.lit("[0-9]{7}")))
    return F.when(number.isNotNull(), F.named_struct(F.lit("org_id"), org, F.lit("award_id"), number))


def nsf_text(a: Column) -> Column:
    return F.when(a.isNotNull(), F.concat_ws("-", a["org_id"], a["award_id"]))


def nsf_url(a: Column) -> Column:
    return F.concat(F.lit("https://www.nsf.gov/awardsearch/showAward?AWD_ID="), a["award_id"], F.lit("&HistoricalAwards=false"))


def nsf_variants(a: Column) -> Column:
    return F.when(a.isNotNull(), F.array_compact(F.array(a["award_id"], F.concat(a["org_id"], F.lit(" "), a["award_id"]), F.concat(a["org_id"], F.lit("-"), a["award_id"]))))


def parsed(funder_ror: Column, text: Column) -> Column:
    """Distinct canonical identifiers in a ``;`` or ``,`` separated text, by the rules of its funder; empty for others."""
    items = F.split(text, "[;,]")
    found = F.when(funder_ror == NIH, F.transform(items, lambda x: nih_text(nih(x)))).when(funder_ror == NSF, F.transform(items, lambda x: nsf_text(nsf(x))))
    return F.coalesce(F.array_distinct(F.array_compact(found)), F.array().cast("array<string>"))


def variants(funder_ror: Column, text: Column) -> Column:
    """All search spellings of :func:`parsed` awards."""
    items = F.split(text, "[;,]")
    found = F.when(funder_ror == NIH, F.transform(items, lambda x: nih_variants(nih(x)))).when(funder_ror == NSF, F.transform(items, lambda x: nsf_variants(nsf(x))))
    return F.coalesce(F.array_distinct(F.flatten(F.array_compact(found))), F.array().cast("array<string>"))


def reference(text: Column) -> Column:
    """struct(doi, journal, year, title) of a ``~`` separated reference: journal first, year second, then the last fields that fit."""
    parts = F.split(text, "~")
    back = F.reverse(F.transform(parts, lambda x, i: F.struct(i.alias("i"), strip(x).alias("v"))))
    found = F.get(F.filter(F.transform(back, lambda x: F.regexp_substr(F.lower(x["v"]), F.lit(r"10\.[0-9.]+/[^\s]+"))), lambda x: x.isNotNull()), F.lit(0))
    titled = F.filter(back, lambda x: (x["i"] >= 2) & (F.lower(x["v"]) != "n") & (x["v"] != "") & ~x["v"].rlike(r"(?i)10\.[0-9.]+/") & ~x["v"].rlike(r"^[0-9/:. APMapm-]+$"))
    return F.struct(found.alias("doi"), _some(strip(F.get(parts, F.lit(0)))).alias("journal"), _some(strip(F.get(parts, F.lit(1)))).alias("year"), F.get(titled, F.lit(0))["v"].alias("title"))
