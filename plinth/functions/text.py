"""Text, address, URL and identity expressions. All are Column builders and stay in the JVM but where noted."""

from __future__ import annotations

import functools
import html
import unicodedata
from collections.abc import Iterable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.split sees it (NBSP included); the same class works in RE2.
SPACES = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
POSTCODE = r"([A-Z]{1,2}[0-9][0-9A-Z]?\s*[0-9][A-Z]{2})"


def text(c: Column | str) -> Column:
    """The column as a string, null as ''."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def clean(c: Column | str) -> Column:
    """Single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text(c), SPACES, " "))


def canonical(c: Column | str) -> Column:
    """Upper case letters and digits, everything else one space."""
    return F.trim(F.regexp_replace(F.upper(text(c)), "[^A-Z0-9]+", " "))


def postcode(c: Column | str) -> Column:
    return F.regexp_replace(F.upper(text(c)), "[^A-Z0-9]", "")


def compact_key(c: Column | str) -> Column:
    """Lower case letters and digits only: how column and field names are compared."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


@F.pandas_udf(T.StringType())
def nfkd_fold(values: pd.Series) -> pd.Series:
    """Without accents (NFKD, combining marks dropped)."""
    known = {v: "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch)) for v in values.dropna().unique()}
    return values.map(known)


@F.pandas_udf(T.StringType())
def html_unescape(values: pd.Series) -> pd.Series:
    """All named and numeric entities."""
    known = {v: html.unescape(v) for v in values.dropna().unique()}
    return values.map(known)


def folded(c: Column | str) -> Column:
    """``canonical`` after dropping accents, with & as AND."""
    return canonical(F.regexp_replace(nfkd_fold(text(c)), "&", " AND "))


def unescape_common(c: Column | str) -> Column:
    """The five usual entities, in the JVM; &amp; last, so nothing is unescaped twice."""
    out = text(c)
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def strip_tags(c: Column | str, full: bool = False) -> Column:
    """Text of a snippet: entities, then tags as spaces, then clean."""
    return clean(F.regexp_replace(html_unescape(text(c)) if full else unescape_common(c), "<[^>]+>", " "))


def canonical_url(c: Column | str) -> Column:
    """https://authority/path of an absolute https URL, else ''. Query, fragment and trailing slashes go."""
    raw = F.trim(text(c))
    host = F.regexp_extract(raw, r"^https://([^/?#]+)", 1)
    path = F.regexp_extract(raw, r"^https://[^/?#]+([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "/+$", "")
    return F.when(host == "", "").otherwise(F.concat(F.lit("https://"), F.lower(host), F.when(path == "", "/").otherwise(path)))


def sorted_tokens(c: Column | str) -> Column:
    """Order-insensitive form of an address."""
    return F.array_join(F.array_sort(F.filter(F.split(canonical(c), " "), lambda t: t != "")), " ")


def first_filled(*columns: Column | str) -> Column:
    """The first of the columns that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("")) for c in columns])


def address_line(saon: str, paon: str, street: str, locality: str, town: str, code: str, flat: Column | None = None) -> Column:
    """Filled parts joined by ', '; the flat address where the first four are blank."""
    parts = [F.nullif(clean(c), F.lit("")) for c in (saon, paon, street, locality, town, code)]
    joined = F.concat_ws(", ", *parts)
    return joined if flat is None else F.when(F.coalesce(*parts[:4]).isNull(), clean(flat)).otherwise(joined)


def property_record_id(address: Column | str, code: Column | str, given: Column | None = None) -> Column:
    """property:{ADDRESS}|{POSTCODE or NOPOSTCODE}; a blank postcode is looked for at the address' end. The address stays whole, postcode and all. Blank address: ''."""
    line, own = canonical(address), postcode(code)
    tail = F.regexp_replace(F.regexp_extract(line, POSTCODE + "$", 1), " ", "")
    final = F.when(own != "", own).otherwise(tail)
    blank = F.when(own == "", text(given)).otherwise("") if given is not None else F.lit("")
    return F.when(line == "", blank).otherwise(F.concat(F.lit("property:"), line, F.lit("|"), F.when(final == "", "NOPOSTCODE").otherwise(final)))


def transaction_id(prefix: str, *parts: Column | str) -> Column:
    """prefix + the first 20 hex digits of SHA-256 over the upper-cased parts, white space collapsed; blank parts keep their slot."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[F.upper(clean(p)) for p in parts]), 256), 1, 20))


def sale_id(address: Column | str, code: Column | str, price: Column | str, day: Column | str, kind: Column | str, category: Column | str) -> Column:
    """The id of a registered sale; spaces within the postcode don't count."""
    return transaction_id("lr-", address, F.replace(clean(code), F.lit(" "), F.lit("")), price, day, kind, category)


def slug(c: Column | str) -> Column:
    return F.replace(F.lower(canonical(c)), F.lit(" "), F.lit("-"))


def rule_id(estate: Column | str, street: Column | str, scope: Column | str) -> Column:
    return F.concat_ws(":", F.lit("pe"), text(estate), slug(street), slug(scope))


def lookup_key(uprn: Column | str, code: Column | str, ident: Column | str) -> Column:
    """The first identity at hand: reference number, postcode, id."""
    return F.coalesce(F.concat(F.lit("uprn:"), F.nullif(clean(uprn), F.lit(""))), F.concat(F.lit("postcode:"), F.nullif(postcode(code), F.lit(""))), F.concat(F.lit("id:"), text(ident)))


def uri_tail(c: Column | str) -> Column:
    return F.element_at(F.split(F.rtrim(text(c), F.lit("/")), "/"), -1)


def category(c: Column | str) -> Column:
    """A or B, from a code or the tail of a URI; otherwise what follows CATEGORY-, and A for blank."""
    tail = F.upper(uri_tail(c))
    known = F.when(tail.endswith("CATEGORY-A") | (tail == "STANDARDPRICEPAIDTRANSACTION"), "A").when(tail.endswith("CATEGORY-B") | (tail == "ADDITIONALPRICEPAIDTRANSACTION"), "B")
    return F.coalesce(known, F.nullif(F.replace(tail, F.lit("CATEGORY-"), F.lit("")), F.lit("")), F.lit("A"))


def property_type(c: Column | str) -> Column:
    tail = F.upper(uri_tail(c))
    return F.when(tail.isin("D", "DETACHED"), "Detached").when(tail.isin("S", "SEMI-DETACHED"), "Semi Detached").when(tail.isin("T", "TERRACED"), "Terraced").when(tail.isin("F", "FLAT-MAISONETTE"), "Flat Maisonette")


def mapped(c: Column | str, table: dict[str, str]) -> Column:
    """Dictionary look-up by trimmed lower-case key; null where it's missing."""
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(literal, F.lower(clean(c)))


def price_text(c: Column | str) -> Column:
    return F.concat(F.lit("GBP "), F.format_number((F.col(c) if isinstance(c, str) else c).cast("bigint"), 0))


_IGNORED = "A AN AND AS AT FOR IN IS OF ON THE TO WITH".split()


def title_tokens(c: Column | str) -> Column:
    """Distinct words of three letters or more, without fill words."""
    return F.array_distinct(F.filter(F.split(canonical(c), " "), lambda t: (F.length(t) > 2) & ~t.isin(_IGNORED)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


_SCALES = {"BN": 1e9, "BILLION": 1e9, "M": 1e6, "MILLION": 1e6, "K": 1e3, "THOUSAND": 1e3}


def money_value(c: Column | str, strict: bool = False) -> Column:
    """The largest amount of pounds in a text, 0 without one. strict: thousands separators are read, and units end at a word's end."""
    number = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?" if strict else r"[0-9]+(?:\.[0-9]+)?"
    unit = r"(?:(BN|BILLION|M|MILLION|K|THOUSAND)\b)?" if strict else r"(BN|BILLION|M|MILLION|K|THOUSAND)?"
    pattern, upper = F.lit(rf"£\s*({number})\s*{unit}"), F.upper(text(c))
    scales = F.create_map(*[F.lit(x) for pair in _SCALES.items() for x in pair])
    values = F.zip_with(F.regexp_extract_all(upper, pattern, 1), F.regexp_extract_all(upper, pattern, 2), lambda n, u: F.replace(n, F.lit(","), F.lit("")).cast("double") * F.coalesce(F.try_element_at(scales, u), F.lit(1.0)))
    return F.coalesce(F.array_max(values), F.lit(0.0))


def lenient_number(c: Column | str) -> Column:
    """The first signed number in a text, commas dropped; null without one or if it isn't finite."""
    number = F.regexp_extract(F.replace(text(c), F.lit(","), F.lit("")), r"-?[0-9]+(?:\.[0-9]+)?", 0).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def whole_number(c: Column | str) -> Column:
    """A bigint where the text is an integer and nothing else."""
    raw = text(c)
    return F.when(raw.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(raw).try_cast("bigint"))


def finite_positive(c: Column | str) -> Column:
    value = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.coalesce((value > 0) & ~F.isnan(value) & (value < float("inf")), F.lit(False))


def present(c: Column | str) -> Column:
    return clean(c) != ""


def floor_area(*keys: Column | str) -> Column:
    """The first of the areas that lies within 25 and 4000 square metres."""
    return F.coalesce(*[F.when(lenient_number(k).between(25, 4000), lenient_number(k)) for k in keys])


def any_floor_area(flat: Column) -> Column:
    """As ``floor_area``, from a map of flattened keys: those that name floor and area, but no room."""
    hits = F.map_filter(flat, lambda k, v: F.lower(k).contains("floor") & F.lower(k).contains("area") & ~F.lower(k).contains("room"))
    return F.get(F.array_compact(F.transform(F.map_values(hits), lambda v: floor_area(v))), 0)


def house_ranges(c: Column | str, scope: Column | str = "whole") -> Column:
    """array<struct<minimum,maximum,parity>> of '7-84', '7-84 odd'; null if any entry of the array is unusable."""
    scope_parity = F.when(text(F.lit(scope) if isinstance(scope, str) else scope) == "odd_house_range", "odd").when(text(F.lit(scope) if isinstance(scope, str) else scope) == "even_house_range", "even").otherwise("")
    pattern = r"(?i)^\s*([0-9]+)\s*-\s*([0-9]+)(?:\s+(odd|even))?\s*$"

    def one(x: Column) -> Column:
        own = F.lower(F.regexp_extract(x, pattern, 3))
        return F.struct(F.regexp_extract(x, pattern, 1).try_cast("int").alias("minimum"), F.regexp_extract(x, pattern, 2).try_cast("int").alias("maximum"), F.when(own != "", own).otherwise(scope_parity).alias("parity"), own.alias("own"))

    parsed = F.transform(F.col(c) if isinstance(c, str) else c, one)
    good = F.forall(parsed, lambda r: F.coalesce((r["minimum"] <= r["maximum"]) & ((r["own"] == "") | (scope_parity == "") | (r["own"] == scope_parity)), F.lit(False)))
    return F.when(good, F.transform(parsed, lambda r: F.struct(r["minimum"].alias("minimum"), r["maximum"].alias("maximum"), r["parity"].alias("parity"))))


def short_names(names: Column, most: int = 3) -> Column:
    """'a, b, c +2 more'."""
    rest = F.size(names) - most
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(rest > 0, F.concat(F.lit(" +"), rest.cast("string"), F.lit(" more"))).otherwise(""))


def planning_year(*columns: Column | str, now_year: int) -> Column:
    """The first 19xx or 20xx but 1900; else a two-digit beginning of the last column, pivoted on ``now_year``."""
    years = F.filter(F.regexp_extract_all(F.concat_ws(" ", *[text(c) for c in columns]), F.lit(r"((?:19|20)[0-9]{2})"), 1), lambda y: y != "1900")
    two = F.regexp_extract(F.trim(text(columns[-1])), r"^([0-9]{2})[A-Za-z/]", 1).try_cast("int")
    return F.coalesce(F.get(years, 0).cast("int"), F.when(two <= now_year % 100, 2000 + two).otherwise(1900 + two))


@functools.lru_cache(maxsize=200_000)
def _ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def ratcliff_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which has no built-in counterpart; use it on distinct pairs."""
    return pd.Series([None if x is None or y is None else _ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def any_term(c: Column, terms: Iterable[str]) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | c.contains(term)
    return out


def term_hits(c: Column, terms: Iterable[str]) -> Column:
    """How many of the terms the text holds (each once)."""
    out = F.lit(0)
    for term in terms:
        out = out + c.contains(term).cast("int")
    return out
