"""Text to value: null tokens, whitespace, tolerant numbers, money, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Texts that a CSV field may hold for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Fixed value: the Unicode whitespace characters, the file/group/record/unit separators included.
SPACES = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Fixed value: a decimal number, without the type suffixes that a Spark cast would accept.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Texts that need no trimming, and numbers among them too short for an infinity: nearly all of a file.
PLAIN_NUMBER = r"^[+-]?(\d{1,100}(\.\d*)?|\.\d+)([eE][+-]?\d{1,2})?\z"
PLAIN_TEXT = r"^[!-~]([ -~]*[!-~])?\z"
MISSING = "Missing"


def col(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_token(value: Column) -> Column:
    return F.when(~value.isin(*NULL_TOKENS), value)


def strip(value: Column) -> Column:
    return F.when(value.rlike(PLAIN_TEXT), value).otherwise(F.btrim(value, F.lit(SPACES)))


def finite(value: Column) -> Column:
    """NaN and infinities become null (NaN sorts above every number)."""
    return F.when(F.abs(value) < float("inf"), value)


def absent(df: DataFrame, name: str) -> Column:
    """Whether the column has no value: null, or NaN in a floating-point column."""
    gone = col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        gone = gone | F.isnan(col(name))
    return gone


def _plain_number(value: Column) -> Column:
    return F.when(value.rlike(PLAIN_NUMBER), value.try_cast("double"))


def parse_number(value: Column) -> Column:
    bare = F.btrim(value, F.lit(SPACES))
    return _plain_number(value).otherwise(finite(F.when(bare.rlike(NUMBER), bare.try_cast("double"))))


def parse_money(value: Column) -> Column:
    return _plain_number(value).otherwise(parse_number(F.regexp_replace(value, "[$,]", "")))


def clean_category(value: Column) -> Column:
    return F.coalesce(F.nullif(strip(value.cast("string")), F.lit("")), F.lit(MISSING))


def as_number(df: DataFrame, name: str, money: bool = False) -> Column:
    """Double expression of a column, by its type: text is parsed, numbers are only made finite."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_money(col(name)) if money else parse_number(col(name))
    return finite(col(name).cast("double"))
