"""Scalar expressions: Column to Column, evaluated in the JVM; plan-time helpers on names in Python."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip removes from ASCII text.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
TRUE_WORDS = ("1", "true", "yes", "y", "on")


def safe_double(c: Column) -> Column:
    """Double, or null for junk and NaN."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def safe_int(c: Column) -> Column:
    """Integer of numeric text ('1', '1.0'), truncated towards zero; null for junk."""
    return safe_double(c).try_cast("int")


def safe_long(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), safe_double(c).try_cast("bigint"))


def to_numeric(c: Column) -> Column:
    """Number with 0 for whatever isn't one."""
    return F.coalesce(safe_double(c), F.lit(0.0))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def null_or_empty(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def _squeezed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^a-zA-Z0-9]+", "_"), "^_+|_+$", "")


def slug(c: Column) -> Column:
    """Runs of other than ASCII letters and digits become one underscore; lower case; 'unknown' if nothing is left."""
    return F.coalesce(F.nullif(F.lower(_squeezed(c)), F.lit("")), F.lit("unknown"))


def normalize_identifier(c: Column) -> Column:
    """Like :func:`slug`, but 'col_unknown', and 'col_' before a leading digit."""
    s = F.lower(_squeezed(c))
    return F.when(s == "", "col_unknown").when(s.rlike("^[0-9]"), F.concat(F.lit("col_"), s)).otherwise(s)


def identifier(name: str) -> str:
    """:func:`normalize_identifier` of a column name, at plan time."""
    s = re.sub("[^a-zA-Z0-9]+", "_", name or "").strip("_").lower()
    return "col_unknown" if not s else f"col_{s}" if s[0].isdigit() else s


def quote_ident(name: str) -> str:
    """A checked identifier in backticks."""
    if not re.fullmatch("[a-z_][a-z0-9_]*", name):
        raise ValueError(f"not an identifier: {name!r}")
    return f"`{name}`"


def entity_table_name(entity: str) -> str:
    return f"raw_soccerdata_{identifier(entity)}"


def workflow_id(c: Column) -> Column:
    """Safe id that keeps its case."""
    return F.regexp_replace(c, "[^a-zA-Z0-9_]+", "_")


def folded(c: Column) -> Column:
    """Trimmed of all ASCII white space, lower-cased, null as ''."""
    return F.lower(F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(BLANKS)))


def truncated(c: Column, n: int = 2000) -> Column:
    return F.substring(c, 1, n)


def clock_minute(c: Column) -> Column:
    """Sum of the groups of one to three digits in a clock text; null without any (90+3' is 93)."""
    groups = F.regexp_extract_all(c, F.lit("([0-9]{1,3})"), F.lit(1))
    return F.when(F.size(groups) > 0, F.aggregate(groups, F.lit(0), lambda a, g: a + g.cast("int")))


def parse_bool(value: str | None) -> bool:
    return (value or "").strip().lower() in TRUE_WORDS


def text_value(c: Column, kind: str) -> Column:
    """Text form of a stored value: JSON for complex types, else the plain text; null stays."""
    return F.to_json(c) if kind.startswith(("array", "struct", "map")) else c.cast("string")


def quoted_json(c: Column) -> Column:
    """JSON string literal of a text (ASCII escapes as in JSON), or null."""
    inner = F.to_json(F.struct(c.cast("string").alias("v")))
    return F.coalesce(F.when(c.isNotNull(), F.substr(inner, F.lit(6), F.length(inner) - 6)), F.lit("null"))


def canonical_object(fields: dict[str, Column]) -> Column:
    """JSON text with sorted keys, ', ' and ': ' between, nulls kept; texts are quoted, whole numbers are not."""
    parts: list[Column] = []
    for i, k in enumerate(sorted(fields)):
        parts += [F.lit(f'{", " if i else "{"}"{k}": '), fields[k]]
    return F.concat(*parts, F.lit("}"))


MESSAGE_FIELDS = ("entity_type", "entity_id", "payload_format", "path", "provider", "league", "season")
KEY_FIELDS = ("entity_type", "entity_id", "provider", "league", "season")
#: What identifies one extraction of an entity: with its time, without its format.
HASH_FIELDS = ("entity_type", "entity_id", "provider", "league", "season", "path", "created_at")


def python_float(c: Column) -> Column:
    """A double as Python writes it: plain digits from 1e-4 up to 1e16, else an exponent of two digits or more."""
    text = c.cast("string")
    sign, size = F.when(F.startswith(text, F.lit("-")), "-").otherwise(""), F.ltrim(text, F.lit("-"))
    whole = F.substring_index(size, "E", 1)
    digits = F.regexp_replace(F.regexp_replace(whole, "[.]0$", ""), "[.]", "")
    e = F.substring_index(size, "E", -1).try_cast("int")
    after = F.length(digits) - 1
    large = F.when(after <= e, F.concat(digits, F.repeat(F.lit("0"), e - after), F.lit(".0"))).otherwise(F.concat(F.substr(digits, F.lit(1), e + 1), F.lit("."), F.substr(digits, e + 2)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    short = F.concat(F.regexp_replace(whole, "[.]0$", ""), F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), 2, "0"))
    plain = F.when((e >= 0) & (e < 16), large).when((e < 0) & (e >= -4), small).otherwise(short)
    return F.when(~F.contains(size, F.lit("E")), text).otherwise(F.concat(sign, plain))


def variant_texts(v: Column) -> tuple[Column, Column]:
    """(JSON text, plain text) of a variant's value, as Python's ``json.dumps`` and ``str`` give them.

    Objects and lists are compact JSON in both; null and a missing value are null in the second.
    """
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    # whole numbers of up to 18 digits are BIGINT: a DECIMAL without places is longer, or had a point
    long_number = F.coalesce(F.regexp_extract(kind, "^DECIMAL[(]([0-9]+),0[)]$", 1).try_cast("int") > 18, F.lit(False))
    number = F.when((kind == "BIGINT") | long_number, text).otherwise(python_float(F.try_variant_get(v, "$", "double")))
    nothing = kind.isNull() | (kind == "VOID")
    nested = F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))
    json = F.when(nothing, "null").when(kind == "STRING", quoted_json(text)).when((kind == "BOOLEAN") | nested, F.to_json(v)).otherwise(number)
    plain = F.when(nothing, F.lit(None).cast("string")).when(kind == "STRING", text).when(kind == "BOOLEAN", F.initcap(F.to_json(v))).when(nested, F.to_json(v)).otherwise(number)
    return json, plain


def json_text(c: Column, kind: str) -> Column:
    """The same JSON text of a typed column."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(c.cast("string"), F.lit("null"))
    if kind in ("double", "float"):
        return F.coalesce(python_float(c.cast("double")), F.lit("null"))
    return F.coalesce(c.cast("string"), F.lit("null")) if kind == "boolean" else quoted_json(c)


def message_hash(json: dict[str, Column], entity_id: Column) -> Column:
    """SHA-256 over seven message fields, each in its JSON form (``json``); the id is its text, None if missing."""
    return F.sha2(canonical_object({f: quoted_json(F.coalesce(entity_id, F.lit("None"))) if f == "entity_id" else json[f] for f in HASH_FIELDS}), 256)


#: JSON values that count as missing in a :func:`dedupe_key`.
EMPTY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")


def dedupe_key(texts: dict[str, Column]) -> Column:
    """SHA-256 over five case-folded fields; neither path nor time counts."""
    return F.sha2(canonical_object({f: quoted_json(folded(texts[f])) for f in KEY_FIELDS}), 256)


def event_signature(cols: dict[str, Column]) -> Column:
    return F.struct(*[folded(cols[f]).alias(f) for f in KEY_FIELDS])


def row_json(*cols: str) -> Column:
    """JSON of a row with its nulls."""
    return F.to_json(F.struct(*(cols or ("*",))), {"ignoreNullFields": "false"})


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")
