"""Text and field parsing as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import JAVA_WHITESPACE, LIST_SEP, PY_WHITESPACE

_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]*"
# Text between outer white space, without one pair of quotes around it.
_UNWRAP = rf'(?s)\A{_SPACE}(?:"{_SPACE}(.*?){_SPACE}"|(.*?)){_SPACE}\z'
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([+-]\d{2}(:?\d{2})?)?)?$"
)


# A value as JSON has it: double quotes, and nothing behind the end.
_STRICT = {"allowSingleQuotes": "false"}


def _json(text: Column, kind: str) -> Column:
    """The JSON value that is all of ``text``; NULL if there is something else."""
    boxed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>", _STRICT)
    return let(boxed, lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def jtrim(c: Column) -> Column:
    """Strip every character up to U+0020 from both ends, 0x01 included."""
    return F.btrim(c, F.lit(JAVA_WHITESPACE))


def strip(c: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def units(c: Column) -> Column:
    """Length in UTF-16 code units."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_field(c: Column) -> Column:
    """Field text: stripped, one pair of double quotes removed, null words blanked."""
    bare = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _UNWRAP, "$1$2")
    return F.regexp_replace(bare, r"(?i)\A(?:null|none|nan)\z", "")


def _bare(x: Column) -> Column:
    return F.regexp_replace(x, "^#+", "")


def parse_list(c: Column) -> Column:
    """A list field: JSON array, JSON string, or comma separated text."""

    def parse(t: Column) -> Column:
        as_array = F.when(t.startswith("[") & t.endswith("]"), _json(t, "array<string>"))
        as_text = F.when(t.startswith('"') & t.endswith('"'), _json(t, "string"))
        return F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.coalesce(
                F.transform(_filled(F.transform(as_array, clean_field)), _bare),
                F.when(as_text.isNotNull(), _filled(F.array(_bare(clean_field(as_text))))),
                F.transform(_filled(F.transform(F.split(t, ","), strip)), _bare),
            )
        )

    return let(clean_field(c), parse)


def _filled(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def parse_timestamp(c: Column, ingest_ts: int) -> Column:
    """ISO-8601 text to whole seconds; anything else becomes the ingest time.

    A value without offset is read as UTC whatever the session time zone is.
    """

    def parse(t: Column) -> Column:
        full = F.when(t.rlike(_ISO), F.replace(t, F.lit(","), F.lit(".")))
        full = F.regexp_replace(full, r"^(\d{4}-\d{2}-\d{2})$", "$1T00")
        full = F.regexp_replace(full, r"^(.{13})(?=$|[+-])", "$1:00")
        full = F.regexp_replace(full, r"^(.{16})(?=$|[+-])", "$1:00")
        # Whatever lacks an offset gets one; short offsets are completed.
        full = F.regexp_replace(full, r"^(.{19}[^+-]*)$", "$1+00:00")
        full = F.regexp_replace(full, r"([+-]\d{2})$", "$1:00")
        full = F.regexp_replace(full, r"([+-]\d{2})(\d{2})$", "$1:$2")
        return F.unix_seconds(F.try_to_timestamp(full))

    iso = F.regexp_replace(clean_field(c), "Z$", "+00:00")
    return F.coalesce(let(iso, parse), F.lit(ingest_ts).cast("bigint"))


def parse_int(c: Column) -> Column:
    """Number text to a whole number, truncated toward zero; 0 when unreadable."""
    digits = F.replace(clean_field(c), F.lit(","), F.lit(""))
    plain = F.regexp_replace(digits, r"(?<=\d)_(?=\d)", "")
    number = F.regexp_extract(plain, _NUMBER, 0).try_cast("double")
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_bool(c: Column) -> Column:
    return F.lower(clean_field(c)).isin("true", "1", "yes")


def has_content(c: Column) -> Column:
    """Whether a JSON field carries any real value.

    Text that is not JSON counts. In an object or array some value must be non-blank;
    a nested object or array counts unless it is empty.
    """

    def filled(v: Column) -> Column:
        empty = F.regexp_replace(v, r"\s", "").isin("{}", "[]", "[{}]", "[[]]")
        return (clean_field(v) != "") & ~empty

    def check(t: Column) -> Column:
        as_map = F.when(t.startswith("{") & t.endswith("}"), _json(t, "map<string,string>"))
        as_array = F.when(t.startswith("[") & t.endswith("]"), _json(t, "array<string>"))
        return F.when(t == "", F.lit(False)).otherwise(
            F.coalesce(
                F.exists(F.map_values(as_map), filled), F.exists(as_array, filled), F.lit(True)
            )
        )

    return let(clean_field(c), check)


def media_types(photos: Column, videos: Column) -> Column:
    found = F.array(
        F.when(F.size(parse_list(photos)) > 0, F.lit("Photo")),
        F.when(F.size(parse_list(videos)) > 0, F.lit("Video")),
    )
    return F.filter(found, lambda x: x.isNotNull())


def tweet_type(parent: Column, quoted: Column) -> Column:
    return (
        F.when(has_content(parent), F.lit("Reply"))
        .when(has_content(quoted), F.lit("Quote"))
        .otherwise(F.lit("TopLevel"))
    )


def hashed(c: Column) -> Column:
    """First 32 hex digits of the SHA-256 digest."""
    return F.left(F.sha2(c, 256), F.lit(32))


def split_list(c: Column) -> Column:
    """Items of a 0x01-separated field; empty items dropped, items kept as they are."""
    items = F.split(jtrim(F.coalesce(c, F.lit(""))), LIST_SEP)
    return F.filter(items, lambda x: x != "")


def content_words(c: Column) -> Column:
    """The set of words that decide whether two texts are near duplicates.

    Lower-cased runs of letters and digits of at least four UTF-16 units.
    """
    words = F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\s]", " "), r"\s+")
    long_enough = lambda w: (F.length(w) >= 4) | (
        (F.length(w) >= 2) & (units(w) >= 4)
    )
    return F.array_distinct(F.filter(words, long_enough))


def jaccard(a: Column, b: Column) -> Column:
    """Intersection over union of two word sets; two empty sets are equal."""
    shared = F.size(F.array_intersect(a, b))
    both_empty = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both_empty, F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))
