"""Strict number and boolean text conversions as column expressions.

Spark's own casts trim blanks, accept type suffixes and turn overflow into
infinity. Messages must not be read that loosely, so every cast here sits behind
a pattern, and a value that does not match gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings.
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = (
    r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
)
INFINITY_PATTERN = r"^[+-]?inf(inity)?$"
TRUE_WORDS = ("1", "t", "T", "true", "TRUE", "True")
FALSE_WORDS = ("0", "f", "F", "false", "FALSE", "False")

TWO_63 = 9223372036854775808.0

# JSON strings, number tokens, and what a token beyond the double range must have: an
# exponent of three digits, or very many digits. Quantifiers never backtrack.
_JSON_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_JSON_NUMBER = r"-?[0-9]++(?:[.][0-9]*+)?+(?:[eE][+-]?+[0-9]++)?+"
_JSON_LARGE = r"[0-9][.]?[eE][+]?[0-9]{3}|[0-9]{200}"


def parse_int(text: Column) -> Column:
    """Base-10 text to BIGINT; NULL when malformed or out of range."""
    return F.when(text.rlike(INT_PATTERN), text.try_cast("bigint"))


def parse_float(text: Column) -> Column:
    """Decimal text to DOUBLE; NULL when malformed or beyond the double range."""
    number = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    finite = F.when(~number.isin(float("inf"), float("-inf")), number)
    word = F.lower(text)
    special = F.when(word == "nan", F.lit(float("nan"))).when(
        word.rlike(INFINITY_PATTERN),
        F.when(word.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
    )
    return F.when(text.rlike(FLOAT_PATTERN), finite).otherwise(special)


def parse_bool(text: Column) -> Column:
    """Boolean words to BOOLEAN; NULL for anything else."""
    return F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(text.isin(*FALSE_WORDS), F.lit(False))


def float_to_int(number: Column) -> Column:
    """Truncate towards zero; NULL outside the BIGINT range and for NaN."""
    inside = (number >= -TWO_63) & (number <= TWO_63) & ~F.isnan(number)
    return F.when(inside, number.try_cast("bigint"))


def float_text(number: Column) -> Column:
    """Shortest text of a DOUBLE: plain digits up to 1e6, exponent form beyond.

    ``100.0`` gives ``100``, ``1000000.0`` gives ``1e+06``, ``1e21`` gives ``1e+21``.
    """
    size = F.abs(number)
    plain = number.cast("string")
    rewritten = plain
    for pattern, replacement in (
        (r"^(-?)([0-9])[.]([0-9]+)E-4$", "$10.000$2$3"),  # Spark switches to E below 1e-3 ...
        (r"^(-?[0-9])([0-9]{6})[.]([0-9]+)$", "$1.$2$3E6"),  # ... and only from 1e7 on
        (r"([.][0-9]*?)0+(?=E|$)", "$1"),
        (r"[.](?=E|$)", ""),
        (r"E([0-9])$", "E0$1"),
        (r"E-([0-9])$", "E-0$1"),
        (r"E([0-9]+)$", "e+$1"),
        (r"E-", "e-"),
    ):
        rewritten = F.regexp_replace(rewritten, pattern, replacement)
    return (
        F.when(F.isnan(number), "NaN")
        .when(number == float("inf"), "+Inf")
        .when(number == float("-inf"), "-Inf")
        .when(number == 0.0, F.when(plain.startswith("-"), "-0").otherwise("0"))
        .when((size < 1e6) & (F.floor(number) == number), number.try_cast("bigint").cast("string"))
        .when((size < 1e6) & (size >= 1e-3), plain)
        .otherwise(rewritten)
    )


def json_overflows(text: Column) -> Column:
    """Whether a number token of a JSON text, outside its strings, is beyond the double range.

    Only texts that show a long exponent or a long run of digits are looked at closely.
    """
    tokens = F.regexp_extract_all(F.regexp_replace(text, _JSON_STRING, '""'), F.lit(_JSON_NUMBER), F.lit(0))
    beyond = F.exists(tokens, lambda token: F.abs(token.try_cast("double")) == float("inf"))
    return F.when(text.rlike(_JSON_LARGE), beyond).otherwise(F.lit(False))


def bytes_text(data: Column) -> Column:
    """Bytes printed as a bracketed list of decimal values."""
    values = F.transform(
        F.sequence(F.lit(1), F.octet_length(data)),
        lambda i: F.conv(F.hex(F.substr(data, i, F.lit(1))), 16, 10),
    )
    body = F.when(F.octet_length(data) > 0, F.array_join(values, " ")).otherwise("")
    return F.when(data.isNotNull(), F.concat(F.lit("["), body, F.lit("]")))
