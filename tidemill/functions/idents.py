"""Quoting of identifiers and literals, and regular expressions over names."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Keywords that SQL text must quote when used as a name.
KEYWORDS = (
    "all", "and", "any", "array", "as", "asc", "between", "bigint", "boolean", "both", "case", "cast", "char", "check", "coalesce", "collate", "column", "constraint", "create", "cross", "current_date", "current_user", "default", "desc", "distinct", "do", "else", "end", "except", "exists", "extract", "false", "fetch", "float", "for", "foreign", "from", "full", "grant", "group", "having", "in", "initially", "inner", "int", "integer", "intersect", "interval", "into", "is", "join", "lateral", "leading", "left", "like", "limit", "natural", "not", "null", "numeric", "offset", "on", "only", "or", "order", "outer", "position", "primary", "real", "references", "returning", "right", "row", "select", "session_user", "setof", "smallint", "some", "substring", "table", "then", "time", "timestamp", "to", "trailing", "treat", "trim", "true", "union", "unique", "user", "using", "values", "varchar", "when", "where", "window", "with",
)
PLAIN = "^[a-z_][a-z0-9_$]*$"
_POSIX = {"alpha": "Alpha", "digit": "Digit", "alnum": "Alnum", "upper": "Upper", "lower": "Lower", "punct": "Punct", "space": "Space", "xdigit": "XDigit", "blank": "Blank", "cntrl": "Cntrl", "print": "Print", "graph": "Graph"}


def always_quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quoted_table(schema: str, table: str) -> str:
    return f"{always_quoted(schema)}.{always_quoted(table)}"


def quote_ident(name: Column) -> Column:
    """The name as it is if SQL reads it as a name, else in double quotes."""
    plain = name.rlike(PLAIN) & ~name.isin(*KEYWORDS)
    return F.when(plain, name).otherwise(F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')))


def quote_literal(value: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))


def qualified(schema: Column, table: Column) -> Column:
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(table))


def java_regex(pattern: str) -> str:
    """POSIX classes as Java writes them, also within other brackets."""
    within = re.sub(r"\[:(\w+):\]", lambda m: rf"\p{{{_POSIX[m[1]]}}}" if m[1] in _POSIX else m[0], pattern)
    return re.sub(r"\[(\^?)(\\p\{\w+\})\]", lambda m: f"[{m[1]}{m[2]}]" if m[1] else m[2], within)


def matches(name: Column, pattern: str | None) -> Column:
    """Case-insensitive search; no pattern matches all."""
    return F.lit(True) if pattern is None else name.rlike("(?i)" + java_regex(pattern))


def assert_regex(spark: SparkSession, pattern: str) -> None:
    """ValueError if the pattern is no regular expression."""
    try:
        spark.range(1).select(F.lit("").rlike("(?i)" + java_regex(pattern))).collect()
    except PySparkException as error:
        if "PATTERN" in str(error).upper() or "REGEX" in str(error).upper():
            raise ValueError(f"invalid regular expression: {pattern}") from error
        raise


def prefixed(name: str, longest: int = 63, prefix: str = "tm_") -> str:
    """A prefix for generated names; where it would exceed the longest name, it takes the place of the name's beginning."""
    return prefix + (name[len(prefix) :] if len(name) + len(prefix) >= longest else name)


def version_number(text: Column) -> Column:
    """major.minor.patch as one number; parts that are missing count as 0, and what follows the digits is ignored."""
    part = lambda k: F.coalesce(F.regexp_extract(text, rf"^(?:\d+\.){{{k}}}(\d+)", 1).try_cast("bigint"), F.lit(0))
    return part(0) * 10_000 + part(1) * 100 + part(2)
