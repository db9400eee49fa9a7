"""Expressions behind the read side: links, public source keys, stored JSON keyword lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of an absolute http(s) address: user information (if any), host, port (if any).
HTTP_PARTS = r"(?is)^https?:[/\\]*(?:[^/\\?#]*@)?(\[[^\]/\\?#]*\]|[^:/\\?#@]*)(?::([^/\\?#@]*))?(?:[/\\?#].*)?$"
FORBIDDEN_IN_HOST = r"[\x00-\x20\x7f#%/:<>?@\[\\\]^|\x{fffd}]"
IPV4_NUMBER = r"(?i)^(?:0x[0-9a-f]*|0[0-7]*|[1-9][0-9]*)$"
PUBLIC_ALIAS = r"^Fuente ([0-9]+)$"

# Spellings accepted in a stored keyword list, in order of preference.
LABEL_FIELDS = ("keyword", "canonical_keyword", "label", "name", "term")
WEIGHT_FIELDS = ("news_count", "weight", "count", "total_occurrences")
OCCURRENCE_FIELDS = ("total_occurrences", "occurrences")
MAX_KEYWORDS = 24


def _number(part: Column) -> Column:
    """Value of a part of a numeric host (decimal, octal after 0, hexadecimal after 0x); null if it is none."""
    text = F.lower(part)
    digits = F.ltrim(F.when(text.startswith("0x"), F.substr(text, F.lit(3))).otherwise(text), F.lit("0"))
    base = F.when(text.startswith("0x"), 16).when(text.startswith("0") & (F.length(text) > 1), 8).otherwise(10)
    value = F.when(base == 16, F.conv(digits, 16, 10)).when(base == 8, F.conv(digits, 8, 10)).otherwise(digits)
    # more than 12 digits exceed any address in every base
    number = F.when(digits == "", 0).when(F.length(digits) > 12, 1 << 40).otherwise(value.try_cast("bigint"))
    return F.when(part.rlike(IPV4_NUMBER), number)


def _ipv4(parts: Column) -> Column:
    """Whether the parts of a host that ends in a number make an address: the last fills the bytes left."""
    numbers = F.transform(parts, _number)
    last, n = F.element_at(numbers, -1), F.size(parts)
    others = F.forall(F.slice(numbers, 1, F.greatest(n - 1, F.lit(0))), lambda x: F.coalesce(x <= 255, F.lit(False)))
    return (n <= 4) & others & F.coalesce(last < F.pow(F.lit(256.0), F.lit(5) - n), F.lit(False))


def _ipv6(text: Column) -> Column:
    """Whether the text between brackets is an address: eight groups, or fewer around one double colon."""
    tail = F.regexp_extract(text, r"(?:^|:)([0-9]+(?:\.[0-9]+){3})$", 1)
    bytes_ok = F.forall(F.split(tail, r"\."), lambda x: x.rlike("^(?:0|[1-9][0-9]{0,2})$") & (x.try_cast("int") <= 255))
    # an IPv4 tail stands for two groups
    groups = F.when(tail == "", text).when(bytes_ok, F.regexp_replace(text, r"[0-9.]+$", "0:0")).otherwise("?")
    halves = F.split(groups, "::")
    pieces = F.flatten(F.transform(halves, lambda h: F.when(h == "", F.array().cast("array<string>")).otherwise(F.split(h, ":"))))
    filled = F.when(F.size(halves) == 1, F.size(pieces) == 8).otherwise((F.size(halves) == 2) & (F.size(pieces) <= 7))
    return filled & F.forall(pieces, lambda x: x.rlike("(?i)^[0-9a-f]{1,4}$"))


def http_url(url: Column) -> Column:
    """The link itself when it is an http(s) address that a browser would open, else null.

    Blanks around it and line ends and tabs in it do not count, backslashes are slashes, and the host is
    percent-decoded.  A host that ends in a number must be an IPv4 address (also short, octal or hexadecimal), one in
    brackets an IPv6 address; a port has at most 65535.  Names are not mapped to ASCII, so only their characters are
    judged.
    """
    text = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    host, port = (F.regexp_extract(text, HTTP_PARTS, i) for i in (1, 2))
    name = F.try_url_decode(F.replace(host, F.lit("+"), F.lit("%2B")))
    labels = F.split(F.regexp_replace(name, r"(?<=.)\.$", ""), r"\.")
    numeric = F.element_at(labels, -1).rlike("(?i)^(?:[0-9]+|0x[0-9a-f]*)$")
    named = (name != "") & ~name.rlike(FORBIDDEN_IN_HOST) & (~numeric | _ipv4(labels))
    bracketed = host.startswith("[") & _ipv6(F.substr(host, F.lit(2), F.length(host) - 2))
    open_port = (port == "") | (port.rlike("^[0-9]+$") & (F.length(F.ltrim(port, F.lit("0"))) <= 5) & (
        F.coalesce(F.nullif(F.ltrim(port, F.lit("0")), F.lit("")).try_cast("int"), F.lit(0)) <= 65535))
    return F.when(
        text.rlike(HTTP_PARTS) & open_port & F.coalesce(F.when(host.startswith("["), bracketed).otherwise(named), F.lit(False)), url
    )


def decode_keyword(value: Column) -> Column:
    """Percent-decoding of a path segment; malformed input is kept as it is. A plus sign stays a plus."""
    decoded = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    bad_bytes = (
        F.contains(decoded, F.lit("�"))
        & ~F.contains(value, F.lit("�"))
        & ~value.rlike("(?i)%EF%BF%BD")
    )
    kept = F.when(decoded.isNull() | bad_bytes, value).otherwise(decoded)
    return F.regexp_replace(kept, r"(?U)^[\s\x{feff}]+|[\s\x{feff}]+$", "")


def alias_key(alias: Column, position: Column) -> Column:
    """Public key ``fuente-N`` of an anonymised source, or its 1-based ``position`` in the list."""
    number = F.regexp_extract(alias, PUBLIC_ALIAS, 1)
    return F.concat(F.lit("fuente-"), F.coalesce(F.nullif(number, F.lit("")), position.cast("string")))


def safe_number(text: Column) -> Column:
    """Numeric value of a text, 0 when it is missing, malformed or not finite."""
    number = text.try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return F.coalesce(finite, F.lit(0.0))


def _field(item: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_variant_get(item, f"$.{n}", "string") for n in names])


def read_top_keywords(stored_json: Column) -> Column:
    """Tolerant reader of a stored keyword list: strings or objects, several key spellings, at most 24."""
    items = F.try_variant_get(F.try_parse_json(stored_json), "$", "array<variant>")

    def read(item: Column) -> Column:
        kind = F.schema_of_variant(item)
        text = F.try_variant_get(item, "$", "string")
        occurrences = F.nullif(safe_number(_field(item, OCCURRENCE_FIELDS)), F.lit(0.0))
        weight = safe_number(F.coalesce(_field(item, WEIGHT_FIELDS), F.lit("1")))
        is_text = kind == "STRING"
        return F.when(
            is_text | kind.startswith("OBJECT"),
            F.struct(
                F.when(is_text, text).otherwise(F.trim(_field(item, LABEL_FIELDS))).alias("label"),
                F.when(is_text, F.lit(1.0)).otherwise(weight).alias("weight"),
                F.when(~is_text, occurrences).alias("occurrences"),
                is_text.alias("plain"),
            ),
        )

    usable = F.filter(
        F.transform(items, read),
        lambda k: k.isNotNull() & (k["plain"] | (F.coalesce(k["label"], F.lit("")) != "")),
    )
    trimmed = F.transform(
        F.slice(usable, 1, MAX_KEYWORDS),
        lambda k: F.struct(
            k["label"].alias("label"), k["weight"].alias("weight"), k["occurrences"].alias("occurrences")
        ),
    )
    return F.coalesce(trimmed, F.expr("cast(array() as array<struct<label:string,weight:double,occurrences:double>>)"))
