"""String, key, JSON and nested-record helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The characters with the White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(column: Column | str) -> Column:
    """Without surrounding whitespace of any kind (plain ``trim`` removes blanks only).

    Only texts with an end outside the printable ASCII characters are searched for all of them.
    """
    text = F.col(column) if isinstance(column, str) else column
    first, last = F.ascii(text), F.ascii(F.substring(text, -1, 1))
    return F.when(first.between(33, 126) & last.between(33, 126), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def hash_key(column: Column | str, length: int = 8) -> Column:
    """Upper-case prefix of the MD5 digest."""
    return F.upper(F.substring(F.md5(column), 1, length))


def _json_values(text: Column) -> Column:
    """The JSON values a text consists of, null when it is no JSON.

    The text is parsed as the content of an array, because the parser itself
    ignores whatever follows the first value.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.try_variant_get(wrapped, "$", "array<variant>")


def parsed_json(column: Column | str) -> Column:
    """Variant of a JSON text, null when the text is not exactly one JSON value."""
    values = _json_values(F.col(column) if isinstance(column, str) else column)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def is_json_record(column: Column | str) -> Column:
    """True for a JSON object or a JSON string; numbers may be NaN or infinite."""
    text = F.col(column) if isinstance(column, str) else column
    shape = text.rlike(r"""(?s)\A[ \t\r\n]*(\{.*\}|".*")[ \t\r\n]*\z""")
    # the words stand where a value may stand; inside a text they change nothing that matters here
    finite = F.regexp_replace(text, r"([:,\[]\s*)(?:NaN|-?Infinity)(?=\s*[,\]}])", "$10")
    # only texts with such a word are parsed a second time
    loose = F.when(text.rlike("NaN|Infinity"), F.size(_json_values(finite)) == 1)
    passes = F.when(F.size(_json_values(text)) == 1, F.lit(True)).otherwise(loose)
    return F.coalesce(shape & passes, F.lit(False))


def json_or_empty(column: Column | str) -> Column:
    """Variant of the text; an empty object for a missing or invalid text."""
    return F.coalesce(parsed_json(column), F.parse_json(F.lit("{}")))


def flatten_record(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace struct columns by their leaf fields, names joined by ``separator``.

    Lists and maps stay as they are.
    """

    def leaves(path: list[str], dtype: T.DataType) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [
                leaf for field in dtype.fields for leaf in leaves([*path, field.name], field.dataType)
            ]
        quoted = ".".join(f"`{part}`" for part in path)
        return [F.col(quoted).alias(separator.join(path))]

    return df.select(
        *[leaf for field in df.schema.fields for leaf in leaves([field.name], field.dataType)]
    )
