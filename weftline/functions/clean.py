"""Text, identifier and date clean-up as column expressions; everything stays inside code generation.

NULL gives NULL unless a function says otherwise.  White space is what regex ``\\s`` matches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

PLAIN_AFFILIATION = "array<struct<name:string,affiliationIdentifier:string,affiliationIdentifierScheme:string,schemeUri:string>>"
NAME_IDENTIFIER = "array<struct<nameIdentifier:string,nameIdentifierScheme:string,schemeUri:string>>"
STOP_WORDS = ("a", "an", "and", "if", "of", "or", "the", "then", "they")
TITLES = "mr|mrs|ms|miss|dr|prof|sir|madam|lady|lord|rev"
DASHES = "-‐‑‒–—―﹣－−'’‘ʼ′‵＇´`‛"
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēęěğīįłńňōőřśšťūůűźżž"
FOLD_TO = "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeegiilnnoorsstuuuzzz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: nested uses would copy its expression, and inside lambdas evaluate each copy."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Stripped; NULL if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def null_if_in(c: Column, values: Iterable[str]) -> Column:
    """Stripped; NULL if it is one of ``values`` in any case."""
    s = strip(c)
    return F.when(~F.lower(s).isin([v.lower() for v in values]), s)


def remove_markup(c: Column, whole_entity: bool = False) -> Column:
    """Tags and quotes go, after ``&lt;`` and ``&gt`` became brackets; the ``;`` of ``&gt;`` stays unless ``whole_entity``."""
    s = F.replace(c, F.lit("&lt;"), F.lit("<"))
    s = F.replace(s, F.lit("&gt;" if whole_entity else "&gt"), F.lit(">"))
    return F.regexp_replace(F.regexp_replace(s, "<[^>]*>", ""), "['\"]", "")


def strip_html(c: Column) -> Column:
    """Tags go, after both entities became brackets; quotes stay."""
    s = F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.regexp_replace(s, "<[^>]*>", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def fold(c: Column) -> Column:
    """Lower case without Latin accents."""
    return F.translate(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), FOLD_FROM, FOLD_TO)


def comparable(c: Column) -> Column:
    """Folded, other non-ASCII dropped, punctuation dropped, spaces squeezed: titles to compare."""
    s = F.regexp_replace(F.regexp_replace(fold(c), r"[^\x00-\x7f]", ""), r"[^A-Za-z0-9_\s]", "")
    return strip(F.regexp_replace(s, r"\s+", " "))


# identifiers


def identifier(c: Column) -> Column:
    """Lower case, stripped, without the ``https://host/`` before it."""
    return F.regexp_replace(strip(F.lower(c)), "^https?://[^/]+/", "")


def loose_identifier(c: Column) -> Column:
    """Like :func:`identifier`, lower-casing last, so that any case of the scheme is removed."""
    return F.lower(F.regexp_replace(strip(c), "(?i)^https?://[^/]+/", ""))


def isni(c: Column) -> Column:
    return F.lower(strip(F.replace(c, F.lit(" "), F.lit(""))))


def orcid(c: Column, check_digit_x: bool = True) -> Column:
    """The first ORCID in the lower-cased text; ``check_digit_x=False`` sees digits only."""
    return F.regexp_substr(F.lower(c), F.lit("[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}" + ("[0-9x]" if check_digit_x else "[0-9]")))


def ror(c: Column) -> Column:
    return F.regexp_substr(c, F.lit("0[a-hj-km-np-tv-z|0-9]{6}[0-9]{2}"))


def grid(c: Column) -> Column:
    return F.regexp_substr(c, F.lit(r"grid\.[0-9]+\.[0-9]+"))


def wikidata(c: Column) -> Column:
    return F.regexp_substr(c, F.lit("Q[0-9]+"))


def fundref(c: Column) -> Column:
    return F.regexp_substr(c, F.lit("[0-9]{9,}"))


def isni_digits(c: Column) -> Column:
    """The spaced form without spaces, else the 16-character form, else the text as it is."""
    spaced = F.replace(F.regexp_substr(c, F.lit("[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{3}[0-9X]")), F.lit(" "), F.lit(""))
    return F.coalesce(spaced, F.regexp_substr(c, F.lit("[0-9]{15}[0-9X]")), c)


def any_id(c: Column) -> Column:
    """A ROR, else a funder-registry number, else the text as it is."""
    return F.coalesce(ror(c), fundref(c), c)


def doi_in(c: Column) -> Column:
    """The first DOI in a text, lower case."""
    return strip(F.lower(F.regexp_substr(c, F.lit(r"(?i)10\.[0-9.]+/[^\s]+"))))


def doi(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"^(https?://)?doi\.org/", "")


def plan_doi(c: Column) -> Column:
    """A plan id, lower case, without its first ``doi.org/``."""
    return F.regexp_replace(strip(F.lower(c)), r"^(.*?)doi\.org/", "$1")


def plan_key(c: Column) -> Column:
    """The partition key of a plan: ``PLAN#`` and its bare DOI; NULL without a DOI."""
    return F.concat(F.lit("PLAN#"), doi_in(c))


def provenance_key(c: Column) -> Column:
    return F.concat(F.lit("PROVENANCE#"), F.regexp_replace(blank_to_null(c), "^PROVENANCE#", ""))


def is_email(c: Column) -> Column:
    return F.contains(c, F.lit("@"))


def is_orcid(c: Column) -> Column:
    return c.rlike("[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}")


def grant_id(c: Column) -> Column:
    """A number in an award URL, an ``nsf…`` id, or five digits or more; else NULL."""
    url = F.nullif(F.regexp_extract(c, "AWD_ID=([0-9]+)", 1), F.lit(""))
    return F.coalesce(url, F.lower(F.regexp_substr(c, F.lit("nsf[0-9-]+"))), F.regexp_substr(c, F.lit("[0-9]{5,}")))


def collapse_ror_url(c: Column) -> Column:
    """A doubled URL prefix becomes one."""
    return F.regexp_replace(c, r"^(https?://ror\.org/){2,}", "https://ror.org/")


# names


def name(c: Column) -> Column:
    return F.nullif(F.lower(strip(c)), F.lit(""))


def bare_name(c: Column) -> Column:
    """Without bracketed parts, lower case; NULL if nothing is left."""
    return name(F.regexp_replace(c, r"\s*\(.*?\)\s*", ""))


def public_name(c: Column) -> Column:
    """Stripped; NULL for blanks, mail addresses and web addresses."""
    s = blank_to_null(c)
    return F.when(~F.contains(s, F.lit("@")) & ~s.rlike(r"^(https?://|www\.)"), s)


def person_name(c: Column) -> Column:
    """No title, hyphen, apostrophe, or initial in the middle of three; lower case; NULL if nothing is left."""
    s = F.regexp_replace(c, rf"(?i)\b({TITLES})\.?(\s+|$)", "")

    def short(parts: Column) -> Column:
        initial = (F.size(parts) == 3) & F.get(parts, F.lit(1)).rlike(r"^[a-zA-Z]\.?$")
        return F.when(initial, F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(2)))).otherwise(F.array_join(parts, " "))

    return F.nullif(F.lower(let(F.split(strip(F.translate(s, DASHES, "")), r"\s+"), short)), F.lit(""))


def author_name(c: Column) -> Column:
    """``Last, First M (x)`` becomes ``first m. last``; degrees and brackets go; NULL if nothing is left."""

    def turn(s: Column) -> Column:
        parts = F.reverse(F.filter(F.transform(F.split(s, ","), lambda x: F.lower(strip(x))), lambda x: ~F.contains(x, F.lit("ph.d"))))
        dotted = F.transform(F.split(F.array_join(parts, " "), " "), lambda x: F.when(F.length(x) == 1, F.concat(x, F.lit("."))).otherwise(x))
        return F.when(F.contains(s, F.lit(",")), F.array_join(dotted, " ")).otherwise(s)

    return name(let(F.regexp_replace(strip(F.regexp_replace(c, r"\s+", " ")), r"\s*\(.*?\)\s*", ""), turn))


def split_name(c: Column) -> Column:
    """struct(given, family): the last word is the family name."""
    parts = F.split(strip(c), r"\s+")
    given = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), " ")
    return F.struct(F.nullif(given, F.lit("")).alias("given"), F.nullif(F.element_at(parts, -1), F.lit("")).alias("family"))


def parsed_name(c: Column) -> Column:
    """struct(first_initial, given_name, middle_initials, middle_names, surname, full) of a person's name.

    ``Surname, Given Middle`` is turned; titles go; nobiliary particles belong to the surname; a single word is only
    ``full``; NULL and blank names give all NULL.
    """
    family = r"((?<=\s)(van|von|de|der|den|da|di|la|le|del|dos|du|el|al|bin|ten|ter)\s)*\S+$"
    whole = let(blank_to_null(F.regexp_replace(c, r"\s+", " ")), lambda full: F.named_struct(F.lit("full"), full, F.lit("bare"), strip(F.regexp_replace(full, rf"(?i)\b({TITLES})\.?(\s+|$)", ""))))

    def turn(n: Column) -> Column:
        bare = n["bare"]
        comma = F.concat_ws(" ", strip(F.substring_index(F.regexp_replace(bare, "^[^,]*,", ""), ",", 1)), strip(F.substring_index(bare, ",", 1)))
        return F.named_struct(F.lit("full"), n["full"], F.lit("name"), F.when(F.contains(bare, F.lit(",")), comma).otherwise(bare))

    def cut(n: Column) -> Column:
        surname = F.regexp_substr(n["name"], F.lit(family))
        return F.named_struct(F.lit("full"), n["full"], F.lit("surname"), surname, F.lit("rest"), strip(F.regexp_replace(n["name"], family, "")))

    def fields(n: Column) -> Column:
        first, middle = blank_to_null(F.substring_index(n["rest"], " ", 1)), blank_to_null(F.regexp_replace(n["rest"], r"^\S+\s*", ""))
        initials = F.nullif(F.array_join(F.transform(F.split(middle, " "), lambda x: F.upper(F.substring(x, 1, 1))), ""), F.lit(""))
        surname = F.when(n["rest"] != "", n["surname"])
        got = {"first_initial": F.nullif(F.upper(F.substring(first, 1, 1)), F.lit("")), "given_name": first, "middle_initials": initials, "middle_names": middle, "surname": surname, "full": n["full"]}
        return F.named_struct(*[x for k, v in got.items() for x in (F.lit(k), v)])

    return let(let(let(whole, turn), cut), fields)


def creator_name(given: Column, family: Column, whole: Column) -> Column:
    """:func:`parsed_name` of ``whole``, else of the given and family names."""
    return parsed_name(F.coalesce(blank_to_null(whole), blank_to_null(F.concat_ws(" ", blank_to_null(given), blank_to_null(family)))))


# dates


def date_of_parts(parts: Column) -> Column:
    """[y, m, d] is that day, [y, m] the last of the month, [y] 31 December; NULL where that is no date."""
    y, m, d = (F.get(parts, F.lit(i)) for i in range(3))
    day = F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(F.coalesce(m, F.lit(12)).cast("string"), 2, "0"), F.lpad(F.coalesce(d, F.lit(1)).cast("string"), 2, "0")), "yyyy-MM-dd")
    return F.when(F.size(parts) >= 3, day).when((F.size(parts) >= 1) & y.isNotNull(), F.last_day(day))


def date_text(parts: Column) -> Column:
    """The parts joined as ``yyyy-mm-dd``, as many as there are; NULL without any."""
    padded = F.transform(parts, lambda x, i: F.lpad(x.cast("string"), F.when(i == 0, F.lit(4)).otherwise(F.lit(2)), F.lit("0")))
    return F.nullif(F.array_join(padded, "-"), F.lit(""))


def parts_of_text(text: Column, fallback: Column) -> Column:
    """Parts of ``y-m-d``, ``y-m``, ``y`` or ``y/y`` (``-`` or ``/``), else those of a timestamp, else none."""
    s = strip(text)
    n = lambda k, pattern: F.regexp_extract(s, pattern, k).try_cast("int")
    ymd, ym = "^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})", "^([0-9]{4})[-/]([0-9]{1,2})$"
    found = F.when(s.rlike(ymd), F.array(n(1, ymd), n(2, ymd), n(3, ymd))).when(s.rlike(ym), F.array(n(1, ym), n(2, ym))).when(s.rlike(r"^([0-9]{4})(/\1)?$"), F.array(F.substring(s, 1, 4).try_cast("int")))
    return F.coalesce(found, F.when(fallback.isNotNull(), F.array(F.year(fallback), F.month(fallback), F.day(fallback))), F.array().cast("array<int>"))


def iso_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def window_end(start: Column, end: Column, years: int = 3) -> Column:
    """A project window of under ``years`` calendar years is extended to that many from its start."""
    return F.when((F.year(end) - F.year(start) < years) | end.isNull(), F.add_months(start, 12 * years)).otherwise(end)


def hub_window(start: Column, end: Column, days: int = 1095) -> Column:
    """struct(start, end): a missing start is ``days`` before the end, and the end at least ``days`` after the start."""
    first = F.coalesce(start, F.date_sub(end, days))
    return F.struct(first.alias("start"), F.greatest(end, F.date_add(first, days)).alias("end"))


# nested values


def present(items: Column, shape: Callable[[Column], Column], fields: Iterable[str]) -> Column:
    """Each item through ``shape``, those with no field set dropped."""
    fields = list(fields)
    return F.filter(F.transform(items, shape), lambda x: F.greatest(*[x[f].isNotNull() for f in fields], F.lit(False)))


def first_of(items: Column) -> Column:
    return F.get(items, F.lit(0))


def from_positions(c: Column) -> Column:
    """The text of a JSON object ``{word: [positions]}``; ``''`` for what is not one.  Words of one position go by the alphabet."""
    entries = F.map_entries(F.from_json(c, "map<string,array<int>>"))
    placed = F.flatten(F.transform(entries, lambda e: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.when(c.isNotNull(), F.coalesce(F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " "), F.lit("")))


def runs(words: Column) -> Column:
    """array<struct(w, at)>: each distinct word, in order, with its positions; sorted within the row."""

    def cut(s: Column) -> Column:
        w = lambda i: F.get(s, i)["w"]
        first = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (w(i - 1) != x["w"]), i)), lambda i: i.isNotNull())
        return let(first, lambda f: F.transform(f, lambda i, n: F.struct(w(i).alias("w"), F.transform(F.slice(s, i + 1, F.coalesce(F.get(f, n + 1), F.size(s)) - i), lambda x: x["i"]).alias("at"))))

    return let(F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))), cut)


def word_positions(words: Column) -> Column:
    """The words as an inverted index, a map of each word to its positions; empty for NULL."""
    return F.coalesce(F.map_from_entries(runs(words)), F.create_map().cast("map<string,array<int>>"))


def affiliations(c: Column) -> Column:
    """JSON object or list of affiliations as a list; empty for NULL and anything else."""
    return F.coalesce(F.from_json(c, PLAIN_AFFILIATION), F.array().cast(PLAIN_AFFILIATION))


def name_identifiers(c: Column) -> Column:
    return F.coalesce(F.from_json(c, NAME_IDENTIFIER), F.array().cast(NAME_IDENTIFIER))


def orcid_of(c: Column) -> Column:
    """The ORCID in the first name identifier whose scheme says so."""
    return orcid(first_of(F.filter(name_identifiers(c), lambda x: x["nameIdentifierScheme"].rlike("(?i)orc")))["nameIdentifier"])


def content(title: Column, abstract: Column) -> Column:
    """Title and abstract with a space between; one alone as it is."""
    return F.when(title.isNotNull() | abstract.isNotNull(), F.concat_ws(" ", title, abstract))


def page_range(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit("-"), last)


def without_stop_words(c: Column) -> Column:
    words = F.split(strip(F.lower(c)), r"\s+")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*STOP_WORDS)), " ")


def distinct_sorted(values: Column) -> Column:
    """Distinct aggregate without NULL, ordered by lower case, then exactly."""
    return F.transform(F.array_sort(F.transform(F.collect_set(values), lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))), lambda s: s["v"])


def in_order(position: Column, value: Column) -> Column:
    """Aggregate: the values as a list by position."""
    return F.transform(F.array_sort(F.collect_list(F.struct(position.alias("p"), value.alias("v")))), lambda s: s["v"])


def letter_pairs(c: Column) -> Column:
    """The pairs of adjacent letters within each word, upper case, repeated ones kept."""
    words = F.filter(F.split(F.upper(c), r"\s+"), lambda w: F.length(w) > 1)
    return F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substr(w, i, F.lit(2)))))


def pair_similarity(a: Column, b: Column) -> Column:
    """Dice coefficient of the letter pairs as bags; 0 without pairs."""

    def dice(n: Column) -> Column:
        x, y = n["x"], n["y"]
        count = lambda bag, p: F.size(F.filter(bag, lambda q: q == p))
        both = F.aggregate(F.array_intersect(x, y), F.lit(0), lambda s, p: s + F.least(count(x, p), count(y, p)))
        total = F.size(x) + F.size(y)
        return F.when(total > 0, 2.0 * both / total).otherwise(F.lit(0.0))

    return let(F.named_struct(F.lit("x"), letter_pairs(a), F.lit("y"), letter_pairs(b)), dice)


def content_hash(columns: Iterable[str]) -> Column:
    """MD5 of the columns as JSON with sorted names, NULLs kept."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def nearness(value: Column, least: Column, most: Column) -> Column:
    """1 at ``least``, 0 at ``most``, linear; NULL if both are equal."""
    return 1 - F.try_divide(value - least, most - least)


def listed(values: Column, between: str = " AND ") -> Column:
    """Aggregate: the distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(values)), between)


def distinct_with_null(values: Column) -> Column:
    """Aggregate: distinct values in order, NULL (last) among them if it occurs."""
    some = F.sort_array(F.collect_set(values))
    return F.when(F.count_if(values.isNull()) > 0, F.array_append(some, F.lit(None))).otherwise(some)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two vectors, summed as doubles."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two vectors; NULL if either is zero."""
    return 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def camel(snake: str) -> str:
    head, *rest = snake.split("_")
    return head + "".join(w.capitalize() for w in rest)
