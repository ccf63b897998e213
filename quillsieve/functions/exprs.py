"""Column builders for claims fields. Every builder takes and returns columns and stays inside code generation.

Casts follow one rule: a text that is not unambiguously of the wanted form gives NULL, never an error and never a
guess. Patterns end in ``\\z`` since ``$`` also matches before a last line break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of date, number and integer texts.
DATE_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
NUMBER_FORM = r"^-?[0-9]+(\.[0-9]+)?\z"
INTEGER_FORM = r"^-?[0-9]+\z"
# Unresolved-placeholder patterns, in the order in which they are tried.
PLACEHOLDERS = [r"\bTODO\b", r"\bTBD\b", r"\bFIXME\b", r"fill this in", r"\bXXX\b", r"\bunknown\b", r"lorem ipsum"]
# What is masked in free text, and the mark.
MASKED = [r"(?i)(bearer\s+)[A-Za-z0-9._\-]+", r"(?i)(postgres(?:ql)?://)[^@\s]+(?=@)"]
MARK = "***REDACTED***"


def blank_to_null(c: Column) -> Column:
    """Spaces (only spaces) trimmed; an empty text is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


# All white space that is trimmed, by code point.
WHITE = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """All white space, also beyond ASCII, trimmed; an empty text is NULL. Texts that start and end in print stay as they are."""
    printed = lambda x: x.between("!", "~")
    trimmed = F.nullif(F.regexp_replace(c, rf"^[{WHITE}]+|[{WHITE}]+\z", ""), F.lit(""))
    return F.when(printed(F.left(c, F.lit(1))) & printed(F.right(c, F.lit(1))), c).otherwise(trimmed)


def json_field(payload: Column, key: str) -> Column:
    """A top-level JSON field as text, trimmed; absent, null and blank are NULL."""
    return blank_to_null(F.get_json_object(payload, f"$.{key}"))


def json_fields(payload: Column, keys: list[str]) -> Column:
    """A struct of several fields as ``json_field`` gives them, from one parse of the payload."""
    texts = F.from_json(payload, ", ".join(f"`{k}` string" for k in keys))
    return let({"f": texts}, lambda v: F.struct(*[blank_to_null(v["f"][k]).alias(k) for k in keys]))


def effective_payload(new: Column, old: Column) -> Column:
    """The one payload of a raw row, whichever loader wrote it."""
    return F.coalesce(new, old)


def safe_date(c: Column) -> Column:
    return F.when(c.rlike(DATE_FORM), c.try_cast("date"))


def safe_numeric(c: Column, kind: str = "decimal(38,10)") -> Column:
    """One cast from the text, so that nothing is rounded twice; what overflows is NULL."""
    return F.when(c.rlike(NUMBER_FORM), c.try_cast(kind))


def safe_integer(c: Column) -> Column:
    return F.when(c.rlike(INTEGER_FORM), c.try_cast("int"))


def cents_to_amount(c: Column) -> Column:
    """Integer cents as an exact amount; blank or unreadable is NULL, never 0."""
    text = strip(c)
    return F.when(text.rlike(INTEGER_FORM), (text.try_cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)"))


def claim_type(form: Column, bill_type: Column, place: Column) -> Column:
    """Form code first, then the presence of a bill type, then that of a place of service."""
    form = strip(form)
    return (
        F.when(form == "UB04", "institutional")
        .when(form == "CMS1500", "professional")
        .when(strip(bill_type).isNotNull(), "institutional")
        .when(strip(place).isNotNull(), "professional")
        .otherwise("undetermined")
    )


def record_id(parts: list[Column]) -> Column:
    """One part as it is; several with their lengths in bytes before them, so that no two lists collide."""
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts])


def let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` over a struct of ``values``, each of which is computed once a row however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def parsed(payload: Column, fields: dict[str, str | None], body: Callable[[Column, Column], Column]) -> Column:
    """``body`` over probes of the document (key None) or its top-level fields, and over the document; it is parsed once."""
    probes = lambda d: {name: _probe(d["doc"], d["payload"], key) for name, key in fields.items()}
    return let({"doc": F.try_parse_json(payload), "payload": payload}, lambda d: let(probes(d), lambda p: body(p, d["doc"])))


def json_probe(payload: Column, key: str | None = None) -> Column:
    """(kind, text, digits) of a JSON document or of one of its top-level fields, for ``json_kind`` and ``id_part``."""
    return let({"doc": F.try_parse_json(payload), "payload": payload}, lambda d: _probe(d["doc"], d["payload"], key))


def _probe(doc: Column, payload: Column, key: str | None) -> Column:
    if key is None:  # the first character tells the kind of a whole document, whatever its size
        start = F.substring(F.ltrim(F.translate(F.substring(payload, 1, 64), "\t\n\r", "   ")), 1, 1)
        start = F.when(start != "", start).otherwise(F.substring(F.regexp_replace(payload, r"^[ \t\n\r]+", ""), 1, 1))
        kind = F.when(start == "{", "OBJECT").when(start == "[", "ARRAY").when(start == '"', "STRING").when(start.isin("t", "f"), "BOOLEAN").when(start == "n", "VOID").otherwise("BIGINT")
        return F.struct(F.when(doc.isNotNull(), kind).alias("kind"), payload.alias("text"), F.lit(None).cast("string").alias("digits"))
    kind = F.schema_of_variant(F.try_variant_get(doc, f"$.{key}", "variant"))
    # a whole number of more than 38 digits is a double in a variant; its digits are in the document
    digits = F.when(kind == "DOUBLE", F.get_json_object(payload, f"$.{key}"))
    return F.struct(kind.alias("kind"), F.try_variant_get(doc, f"$.{key}", "string").alias("text"), digits.alias("digits"))


def json_kind(probe: Column) -> Column:
    """The JSON type name of a probe; NULL if the field is absent or the document no JSON."""
    kind = probe["kind"]
    return (
        F.when(kind.isNull(), F.lit(None).cast("string"))
        .when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "string")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def is_integer(probe: Column) -> Column:
    """Whether a probe's field is a whole number written without fraction or exponent, of up to 38 digits."""
    return probe["kind"].rlike(r"^(BIGINT|INT|SMALLINT|TINYINT)") | (probe["kind"].rlike(r"^DECIMAL\([0-9]+,0\)") & (F.length(probe["text"]) > 18))


def id_part(probe: Column) -> Column:
    """A probe's field as an identifier: text stripped, whole numbers as digits at any size; all else NULL.

    A fraction of zeros is cut from a number and its digits are kept as written, so that no two different numbers share
    an identifier. A number with an exponent is read as a double, and refused from 1e38 on.
    """
    kind, text = probe["kind"], probe["text"]
    number = text.try_cast("double")
    double = F.when(probe["digits"].rlike(INTEGER_FORM), probe["digits"]).when(number == F.floor(number), number.try_cast("decimal(38,0)").cast("string"))
    return F.when(kind == "STRING", strip(text)).when(kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\([0-9]+,0\))"), text).when(kind.rlike("^(DOUBLE|FLOAT)"), double)


#: What nearly all time stamps look like, which one cast reads.
COMMON_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?\z"
# A day, and a time with an offset, in the extended and the basic form of ISO-8601.
ISO_DAY = r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})"
ISO_FORM = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})(?:[^0-9]([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?(?:Z|([+-])([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2}))?)?)?)?\z"


def updated_at(text: Column) -> Column:
    """An ISO-8601 text as a UTC timestamp (session time zone UTC); without an offset it is UTC already.

    Extended (``2024-01-02T03:04:05.6+07:00``) and basic (``20240102T030405``) forms, with any one separator between day
    and time, times of hours only up to fractions, and offsets of hours up to seconds. Fractions are cut at microseconds.
    Week dates are not read: they give NULL, as does every text that is no such day or time.
    """
    part = lambda c, i: F.regexp_extract(c, ISO_FORM, i)
    day = lambda c: F.regexp_replace(F.regexp_extract(c, ISO_DAY, 0), ISO_DAY, "$1-$2-$3")
    number = lambda c, i: F.coalesce(F.nullif(part(c, i), F.lit("")).try_cast("int"), F.lit(0))

    def read(v: Column) -> Column:
        c = v["c"]
        time = F.concat_ws(":", *[F.lpad(number(c, i).cast("string"), 2, "0") for i in (1, 2, 3)])
        local = F.concat(day(c), F.lit(" "), time, F.lit("."), F.rpad(F.substring(part(c, 4), 1, 6), 6, "0"))
        shift = F.when(part(c, 5) == "-", -1).otherwise(1) * (number(c, 6) * 3600 + number(c, 7) * 60 + number(c, 8))
        usual = (number(c, 6) < 24) & (number(c, 7) < 60) & (number(c, 8) < 60)
        return F.when(usual, F.timestamp_micros(F.unix_micros(local.try_cast("timestamp")) - shift.cast("long") * 1_000_000))

    return let({"c": strip(text)}, lambda v: F.when(v["c"].rlike(COMMON_STAMP), v["c"].try_cast("timestamp")).when(v["c"].rlike(ISO_FORM), read(v)))


def document_hash(doc: Column) -> Column:
    """SHA-256 of a parsed document with keys sorted at all depths and no white space (numbers in their shortest form)."""
    return F.sha2(F.to_json(doc), 256)


def payload_hash(payload: Column) -> Column:
    """``document_hash`` of a JSON text."""
    return document_hash(F.try_parse_json(payload))


def redact(text: Column) -> Column:
    """Bearer tokens and credentials in database addresses masked. The second pattern looks ahead to the sign that ends the
    credentials, so that one mark stands for either pattern's match."""
    for pattern in MASKED:
        text = F.regexp_replace(text, pattern, f"$1{MARK}")
    return text


def placeholders(text: Column) -> Column:
    """The first match of every placeholder pattern that occurs, in the patterns' order."""
    return F.array_compact(F.array(*[F.nullif(F.regexp_extract(text, f"(?i)({p})", 1), F.lit("")) for p in PLACEHOLDERS]))


def shortened(text: Column, most: int = 200) -> Column:
    """Longer texts cut, with three dots as the last of their ``most`` characters."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


# The forms of identifiers, path components, run ids, checksums and object keys.
FORMS = {
    "identifier": r"^[A-Za-z_][A-Za-z0-9_]{0,62}\z",
    "component": r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z",
    "uuid": r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z",
    "date_shape": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?\z",
    "sha256": r"^[0-9a-f]{64}\z",
}


def has_form(text: Column, form: str) -> Column:
    """Whether a whole text has one of ``FORMS``; NULL has none."""
    return F.coalesce(text.rlike(FORMS[form]), F.lit(False))
