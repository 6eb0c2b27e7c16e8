"""Text, JSON and HTML expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

_BLANKS = " \t\r\n\f\v"


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def trim_blank(text: Column) -> Column:
    """Trim ASCII white space; no pattern, and text without any at its ends is not gone through."""
    at_an_end = reduce(or_, [f(blank) for blank in _BLANKS for f in (text.startswith, text.endswith)])
    return F.when(at_an_end, F.btrim(text, F.lit(_BLANKS))).otherwise(text)


def join_chars(chars: Column) -> Column:
    """One string from an array of characters."""
    return F.array_join(chars, "")


def first_text(*columns: Column) -> Column:
    """First text that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_number(first: Column, *rest: Column) -> Column:
    """First number that is neither null nor 0; the last one is taken as it is."""
    *falls_through, last = (first, *rest)
    return F.coalesce(*[F.when(c != 0, c) for c in falls_through], last)


def satellite_label(satellite: Column) -> Column:
    """``G`` and the satellite; a missing one reads ``GNone``."""
    return F.concat(F.lit("G"), F.coalesce(satellite.cast("string"), F.lit("None")))


def class_head(text: Column) -> Column:
    return F.substring(text, 1, 1)


def class_rest(text: Column) -> Column:
    return F.substr(text, F.lit(2))


def one_decimal(x: Column) -> Column:
    """One decimal with thousands separators: ``1,234.6``."""
    return F.format_number(x, 1)


def metadata_json(
    xrslong_flux: Column,
    total_energy: Column | None = None,
    active_region: Column | None = None,
    latitude: Column | None = None,
    longitude: Column | None = None,
) -> Column:
    """The metadata object; null members stay in the text."""
    members = {
        "xrslong_flux": xrslong_flux,
        "total_energy": F.lit(0) if total_energy is None else total_energy,
        "active_region": F.lit(0) if active_region is None else active_region,
        "latitude": F.lit(0.0) if latitude is None else latitude,
        "longitude": F.lit(0.0) if longitude is None else longitude,
    }
    return F.to_json(
        F.struct(*[c.alias(name) for name, c in members.items()]),
        {"ignoreNullFields": "false"},
    )


def close_json_array(raw: Column) -> Column:
    """Trim, and append the closing bracket when an array has lost it."""
    text = trim_blank(raw)
    open_only = text.startswith("[") & ~text.endswith("]")
    return F.when(open_only, F.concat(text, F.lit("]"))).otherwise(text)


# Fixed patterns: parts of a page whose links do not count, and the links themselves.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Possessive repeats take no stack. A tag goes on over quoted values, whatever they hold; an
# attribute follows white space, a slash or the quote that ends the one before.
_TAG = r"""(?is)<a(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_ATTRIBUTE = r"""(?is)[^\s/=>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+"""
_HREF = r"""(?is)^href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def hrefs(html: Column) -> Column:
    """The ``href`` values of a page's links, in page order."""
    shown = F.regexp_replace(html, _HIDDEN, " ")
    tags = F.regexp_extract_all(shown, F.lit(_TAG), F.lit(0))
    # attribute by attribute, so that a value which reads like one does not count
    first = lambda tag: F.get(
        F.filter(
            F.regexp_extract_all(F.substr(tag, F.lit(3)), F.lit(_ATTRIBUTE), F.lit(0)),
            lambda part: F.regexp_like(part, F.lit(_HREF)),
        ),
        F.lit(0),
    )
    quoted = F.transform(
        tags, lambda tag: F.coalesce(F.regexp_extract(first(tag), _HREF, 1), F.lit(""))
    )
    return F.transform(
        F.filter(quoted, lambda h: h != ""),
        lambda h: _unescape(F.regexp_replace(h, r"""^["']|["']$""", "")),
    )


def _unescape(text: Column) -> Column:
    """Named and numeric entities; the ampersand comes last, so nothing is read twice."""
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)&#(x[0-9a-f]{1,6}|[0-9]{1,7});"), F.lit(0)))
    text = F.when(F.size(codes) > 0, F.reduce(codes, text, lambda done, code: F.replace(done, code, _character(code)))).otherwise(text)
    for entity, char in [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _character(code: Column) -> Column:
    """The character of a numeric entity; what is none stays as it is. An ampersand stays
    an entity until the end."""
    hexadecimal = F.lower(F.substring(code, 3, 1)) == "x"
    digits = F.regexp_extract(code, r"(?i)&#x?([0-9a-f]+);", 1)
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
    # UTF-32 text of the number, decoded
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    fits = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(number == 38, "&amp;").when(fits, character).otherwise(code)


def first_href_with_suffix(html: Column, suffix: str) -> Column:
    """First link that ends with ``suffix``, or null."""
    return F.get(F.filter(hrefs(html), lambda h: h.endswith(suffix)), F.lit(0))


def first_href_equal(html: Column, name: str) -> Column:
    """``name`` if the page links to it, or null."""
    return F.when(F.array_contains(hrefs(html), name), F.lit(name))
