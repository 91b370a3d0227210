"""Text-level column expressions: XML repair and value parsing.

All of these are built-in ``regexp_replace`` / ``try_cast`` compositions, so
they stay inside whole-stage codegen and run on the executors next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: repair rules ------------------------------------------------
# Bytes that XML 1.0 forbids: everything below 0x20 except TAB, LF and CR.
# One by one: the regex engine looks single characters up in a table, and asks
# the parts of a class of ranges one after the other.
CONTROL_CHARS = "[" + "".join(rf"\x{c:02X}" for c in range(0x20) if c not in (0x09, 0x0A, 0x0D)) + "]"
# Tag names the source truncates, repaired only when the truncated name is not
# the start of a longer name (next character not in [A-Z_]).
TRUNCATED_TAGS = [
    ("BASE_GIURIDICA_NAZ", "BASE_GIURIDICA_NAZIONALE"),
    ("IMPORTO_NOMIN", "IMPORTO_NOMINALE"),
]
# Numeric character references to the same forbidden code points.
ILLEGAL_CHAR_REFS = r"&#(0*([0-8]|1[124-9]|2[0-9]|3[01])|[xX]0*([0-8bBcCeEfF]|1[0-9a-fA-F]));"
# An ampersand that does not start a predefined entity or a numeric reference.
BARE_AMPERSAND = r"&(?!(amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9a-fA-F]+);)"

_WHITE_BYTE = "[" + "".join(rf"\x{c:02X}" for c in (*range(0x20), 0x7F)) + "]"
_PLAIN_AMOUNT = r"^[0-9]+([.,][0-9]+)?$"
_PLAIN_DATE = r"^[0-9]{4}-[0-9]{2}(-[0-9]*)?$"
_INT_TEXT = r"^[+-]?[0-9](_?[0-9])*$"
_FLOAT_TEXT = (r"^[+-]?(([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?)|(\.[0-9](_?[0-9])*))"
               r"([eE][+-]?[0-9](_?[0-9])*)?$")
_SPECIAL_FLOAT = r"(?i)^[+-]?(nan|inf|infinity)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scrub_control_chars(c) -> Column:
    """Drop bytes < 0x20 other than TAB/LF/CR (S3)."""
    return F.regexp_replace(_c(c), CONTROL_CHARS, "")


def repair_truncated_tags(c) -> Column:
    """Complete truncated tag names (S4). Like the source fix, it is not
    anchored to tag syntax, so the same word in text content is completed too."""
    out = _c(c)
    for short, full in TRUNCATED_TAGS:
        out = F.regexp_replace(out, short + "(?![A-Z_])", full)
    return out


def repair_entities(c) -> Column:
    """Make lenient what a strict XML parser rejects: drop references to
    forbidden code points and escape bare ampersands."""
    out = F.regexp_replace(_c(c), ILLEGAL_CHAR_REFS, "")
    return F.regexp_replace(out, BARE_AMPERSAND, "&amp;")


def repair_xml(c) -> Column:
    """The whole repair chain applied to one record's text, as separate steps."""
    return repair_entities(repair_truncated_tags(scrub_control_chars(c)))


# Namespace prefix of a tag name ("<n:TAG" -> "<TAG"); possessive so a plain
# tag name is rejected without backtracking.
TAG_PREFIX = r"<(/?)[A-Za-z_][\w.\-]*+:"


def strip_tag_prefixes(c) -> Column:
    """Remove namespace prefixes from tag names."""
    return F.regexp_replace(_c(c), TAG_PREFIX, "<$1")


def repair_record(c) -> Column:
    """Ingest repair of one record: namespace prefixes removed, then the
    ``repair_xml`` chain. Separate simple patterns are faster than one
    alternation (literal prefixes and plain classes keep the regex engine's
    fast paths); prefixes are looked for only in records containing ':', and the
    ampersand repairs run only on those containing '&'. Both are asked of the text
    as it came (no repair adds either), so the chain is not evaluated for the test."""
    c = _c(c)
    out = scrub_control_chars(F.when(c.contains(":"), strip_tag_prefixes(c)).otherwise(c))
    out = repair_truncated_tags(out)
    return F.when(c.contains("&"), repair_entities(out)).otherwise(out)


def normalize_text(c) -> Column:
    """Squeeze any Unicode whitespace run to one space, trim; missing -> '' (S5).

    The squeeze runs only on values that can need it: those with a control
    byte, two blanks in a row, or characters outside ASCII."""
    c = _c(c)
    dirty = (c != "") & ((F.length(c) != F.octet_length(c)) | c.contains("  ") | c.rlike(_WHITE_BYTE))
    return F.coalesce(F.when(dirty, F.trim(F.regexp_replace(c, r"(?U)\s+", " "))).otherwise(F.trim(c)), F.lit(""))


def parse_amount(c) -> Column:
    """Decimal-comma text -> nullable double.

    Grammar of the source parser: comma becomes point, then a float literal
    with optional digit-group underscores, or nan/inf. Anything else is NULL,
    never an error (so '1.234,56' -> '1.234.56' -> NULL)."""
    plain = _c(c).rlike(_PLAIN_AMOUNT)  # nearly all: one test, one cast
    t = normalize_text(c)
    t = F.regexp_replace(t, ",", ".")
    ok = t.rlike(_FLOAT_TEXT) | t.rlike(_SPECIAL_FLOAT)
    return (F.when(plain, F.replace(_c(c), F.lit(","), F.lit(".")).try_cast("double"))
            .when((t != "") & ok, F.regexp_replace(t, "_", "").try_cast("double")))


def _int_part(parts: Column, i: int) -> Column:
    p = F.trim(F.get(parts, i))
    return F.when(p.rlike(_INT_TEXT), F.regexp_replace(p, "_", "").try_cast("int"))


def year_month(c) -> tuple[Column, Column]:
    """(year, month) from an ISO date text.

    '' -> (0, 0); '2023' -> (2023, 0); '2023-06-15' -> (2023, 6); if the year
    or a present month is not an integer -> (0, 0)."""
    d = _c(c)
    parts = F.split(d, "-")
    y = _int_part(parts, 0)
    has_month = F.size(parts) >= 2
    m = F.when(has_month, _int_part(parts, 1)).otherwise(F.lit(0))
    good = (F.coalesce(d, F.lit("")) != "") & y.isNotNull() & m.isNotNull()
    plain = d.rlike(_PLAIN_DATE)  # nearly all: cut at fixed places
    return (F.when(plain, F.substring(d, 1, 4).cast("int")).when(good, y).otherwise(F.lit(0)).cast("int"),
            F.when(plain, F.substring(d, 6, 2).cast("int")).when(good, m).otherwise(F.lit(0)).cast("int"))
