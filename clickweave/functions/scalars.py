"""Scalar expressions: dates, numbers, packed strings, HTML, JSON, grades."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

# Grade limits and names, from best to worst.
GRADES = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
LOWEST_GRADE = "E"
GOOD_FROM = 80

# The entity names of HTML 4, as the standard library lists them, and the apostrophe's of XML.
ENTITIES = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'"}
LARGEST_CODE = 0x10FFFF

# Date formats.
DATE_HOUR, DATE_KEY, MINUTE_KEY = "yyyy-MM-dd_HH", "yyyyMMdd", "yyyyMMddHHmm"


def _col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def date_hour(ts: Column | str) -> Column:
    return F.date_format(ts, DATE_HOUR)


def date_key(ts: Column | str) -> Column:
    return F.date_format(ts, DATE_KEY)


def minute_key(ts: Column | str) -> Column:
    return F.date_format(ts, MINUTE_KEY)


def parse_date_key(key: Column | str) -> Column:
    """Date of a ``yyyyMMdd`` key; a malformed key gives null."""
    return F.try_to_timestamp(_col(key), F.lit(DATE_KEY)).cast("date")


def parse_minute_key(key: Column | str) -> Column:
    """Time of a ``yyyyMMddHHmm`` key; a malformed key gives null."""
    return F.try_to_timestamp(_col(key), F.lit(MINUTE_KEY)).cast("timestamp_ntz")


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds from ``earlier`` to ``later``, the fraction cut off; no time zone is involved."""
    return F.call_function("div", _col(later) - _col(earlier), F.expr("INTERVAL '1' SECOND"))


def is_empty(text: Column | str) -> Column:
    return F.coalesce(_col(text), F.lit("")) == ""


def trim_comma(text: Column | str) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(text, r"\A,|,\z", "")


def two_digits(text: Column | str) -> Column:
    """A two-character string as it is, anything else with a zero in front."""
    return F.when(F.length(text) == 2, _col(text)).otherwise(F.concat(F.lit("0"), _col(text)))


def packed_field(text: Column | str, name: str) -> Column:
    """Value of ``name`` in ``k=v|k=v``; null if it is missing or empty."""
    parts = F.filter(F.split(text, r"\|"), lambda p: F.split_part(p, F.lit("="), F.lit(1)) == name)
    value = F.split_part(F.get(parts, F.lit(0)), F.lit("="), F.lit(2))
    return F.when(value != "", value)


def with_packed_field(text: Column | str, name: str, value: Column | str) -> Column:
    """``k=v|k=v`` with the value of ``name`` replaced; a missing name changes nothing."""
    changed = F.transform(
        F.split(text, r"\|"),
        lambda p: F.when(
            F.split_part(p, F.lit("="), F.lit(1)) == name, F.concat(F.lit(f"{name}="), _col(value))
        ).otherwise(p),
    )
    return F.array_join(changed, "|")


def _entity(name: Column) -> Column:
    """The character of an entity without ``&`` and ``;``; null if there is none."""
    digits = F.regexp_extract(name, "^#([0-9]{1,7})$", 1)
    hexes = F.regexp_extract(name, "^#[xX]([0-9a-fA-F]{1,6})$", 1)
    code = F.coalesce(F.when(digits != "", digits.cast("long")), F.when(hexes != "", F.conv(hexes, 16, 10).cast("long")))
    sound = code.between(1, LARGEST_CODE) & ~code.between(0xD800, 0xDFFF)  # halves of a pair are no characters
    char = F.when(sound, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    named = F.create_map(*[F.lit(x) for pair in sorted(ENTITIES.items()) for x in pair])
    return F.coalesce(char, F.try_element_at(named, name))


def unescape(text: Column | str) -> Column:
    """Named and numeric HTML entities as characters; unknown ones stay. Text without an ampersand is left alone."""
    parts = F.split(_col(text), "&")
    name = lambda p: F.regexp_extract(p, "^(#?[0-9a-zA-Z]{1,9});", 1)
    undone = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.coalesce(
            F.when(name(p) != "", F.concat(_entity(name(p)), F.substring(p, F.length(name(p)) + 2, F.length(p)))), F.concat(F.lit("&"), p)
        ),
    )
    whole = F.concat(F.get(parts, F.lit(0)), F.array_join(undone, ""))
    return F.when(F.contains(_col(text), F.lit("&")), whole).otherwise(_col(text))


def grade(score: Column | str) -> Column:
    (limit, name), *rest = GRADES
    out = F.when(_col(score) >= limit, name)
    for limit, name in rest:
        out = out.when(_col(score) >= limit, name)
    return out.otherwise(LOWEST_GRADE)


def good_or_bad(score: Column | str) -> Column:
    return F.when(_col(score) >= GOOD_FROM, "GOOD").otherwise("BAD")


def json_field(text: Column | str, name: str) -> Column:
    """A field of a JSON object as text; null for bad JSON or a missing field."""
    return F.get_json_object(text, f"$.{name}")


def net_of(amount: Column | str, share: Column) -> Column:
    return _col(amount) * (1 - share)


def words_of(text: Column | str) -> Column:
    """Words between blanks and line ends, empty ones included."""
    return F.split(text, "[ \n]")
