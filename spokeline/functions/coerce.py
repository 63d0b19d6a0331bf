"""Lenient conversion of JSON values to typed columns, as SQL expressions.

A value is read by its JSON type name (kind) and its text. Both are null for a missing field; a
JSON null has the kind VOID and no text.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space a text value is stripped of, and the number and time formats read.
_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0         "
    "       　"
)
_INT = r"^[+-]?\d+(_\d+)*$"
_FLOAT = (
    r"(?i)^([+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r"|[+-]?inf(inity)?|nan)$"
)
_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


@dataclass
class Field:
    """SQL expressions of one field of a record; falsy is never null."""

    kind: str
    text: str
    falsy: str

    @property
    def missing(self) -> str:
        return f"({self.kind} IS NULL)"

    @property
    def is_null(self) -> str:
        return f"(coalesce({self.kind}, '') = 'VOID')"

    @property
    def is_text(self) -> str:
        return f"(coalesce({self.kind}, '') = 'STRING')"

    @property
    def is_object(self) -> str:
        return f"startswith(coalesce({self.kind}, ''), 'OBJECT')"

    @property
    def is_nested(self) -> str:
        return f"({self.is_object} OR startswith(coalesce({self.kind}, ''), 'ARRAY'))"

    def or_else(self, other: "Field") -> "Field":
        """This field unless it is falsy."""
        return Field(
            f"if({self.falsy}, {other.kind}, {self.kind})",
            f"if({self.falsy}, {other.text}, {self.text})",
            f"({self.falsy} AND {other.falsy})",
        )


# The parser stops after one value without a word. This element after the last one shows that it
# got there; no text that closes the array before it is read to the end.
END_MARK = "end-of-json-text-5f1c9a7e3b"


def with_document(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the text as a VARIANT column, null unless it is exactly one JSON value."""
    wrapped = df.selectExpr("*", f"try_parse_json(concat('[', {text}, ',\"{END_MARK}\"]')) AS _wrapped")
    elements = wrapped.selectExpr(
        *df.columns,
        "try_variant_get(_wrapped, '$[0]', 'variant') AS _first",
        "try_variant_get(_wrapped, '$[1]', 'string') AS _second",
        "try_variant_get(_wrapped, '$[2]', 'variant') AS _third",
    )
    whole = f"_second = '{END_MARK}' AND _third IS NULL"
    return elements.selectExpr(*df.columns, f"if({whole}, _first, NULL) AS {name}")


def with_elements(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the elements of a JSON array text as an array of VARIANT, null unless the text is exactly
    one array. Every element is a value of its own, so the size of the text is not that of a VARIANT.
    """
    # The array is the first element of another one, so whatever follows it shows as a third.
    options = "map('allowNonNumericNumbers', 'false')"
    wrapped = f"""concat('[', {text}, ',["{END_MARK}"]]')"""
    parsed = df.selectExpr("*", f"from_json({wrapped}, 'array<array<variant>>', {options}) AS _parts")
    mark = "try_variant_get(get(get(_parts, 1), 0), '$', 'string')"
    whole = f"size(_parts) = 2 AND {mark} = '{END_MARK}'"
    return parsed.selectExpr(*df.columns, f"if({whole}, get(_parts, 0), NULL) AS {name}")


def once(df: DataFrame) -> DataFrame:
    """df with its columns computed once a row: filters on them stay above, where Spark would
    otherwise compute costly columns below the filter and again above it."""
    row = ", ".join(f"`{c}`" for c in df.columns)
    return df.select(F.inline(F.expr(f"array(struct({row}))")))


def with_fields(
    df: DataFrame, record: str, paths: dict[str, str]
) -> tuple[DataFrame, dict[str, Field]]:
    """Add the columns of a Field for every path into a VARIANT, and the fields by name.

    Each projection computes an expression once that the next one uses several times.
    """
    entries = df.selectExpr(
        "*", f"try_variant_get({record}, '$', 'map<string, variant>') AS _entries"
    )
    values = entries.selectExpr(*df.columns, *[f"{_entry(p)} AS _{n}" for n, p in paths.items()])
    typed = values.selectExpr(
        *df.columns,
        *[f"schema_of_variant(_{n}) AS _{n}_kind" for n in paths],
        *[f"try_variant_get(_{n}, '$', 'string') AS _{n}_text" for n in paths],
    )
    fields = {n: Field(f"_{n}_kind", f"_{n}_text", f"_{n}_falsy") for n in paths}
    return typed.selectExpr("*", *[f"{_is_falsy(f)} AS {f.falsy}" for f in fields.values()]), fields


def _entry(path: str) -> str:
    name, _, inner = path.partition(".")
    entry = f"_entries['{name}']"
    return f"try_variant_get({entry}, '$.{inner}', 'variant')" if inner else entry


def _is_falsy(f: Field) -> str:
    """Missing, null, false, zero, empty text, empty array or empty object."""
    empty = f"{f.text} IN ('false', '0', '0.0', '-0.0', '[]', '{{}}')"
    return f"({f.text} IS NULL OR if({f.kind} = 'STRING', {f.text} = '', {empty}))"


def strip(text: str) -> str:
    """Trim every kind of white space, not only blanks."""
    return f"btrim({text}, '{_SPACE}')"


def whole_number(text: str) -> str:
    """Integer text as INT; null when it is not an integer or does not fit."""
    number = strip(text)
    return f"if({number} RLIKE r'{_INT}', try_cast(replace({number}, '_', '') AS INT), NULL)"


def int_or_zero(f: Field) -> str:
    """Falsy is 0, true is 1, fractions are cut off; null when unreadable or beyond 32 bits."""
    return f"""CASE WHEN {f.falsy} THEN 0
        WHEN {f.kind} = 'BIGINT' THEN try_cast({f.text} AS INT)
        WHEN {f.kind} = 'STRING' THEN {whole_number(f.text)}
        WHEN {f.kind} = 'BOOLEAN' THEN 1
        WHEN {f.kind} = 'DOUBLE' THEN try_cast(CAST({f.text} AS DOUBLE) AS INT)
        ELSE try_cast(substring_index({f.text}, '.', 1) AS INT) END"""


def is_bad_int(f: Field, value: str) -> str:
    """Whether the int_or_zero value is null for something that is no number, not for its size."""
    is_number = f"if({f.is_text}, {strip(f.text)} RLIKE r'{_INT}', NOT {f.is_nested})"
    return f"({value} IS NULL AND NOT {is_number})"


def flag_or_true(f: Field) -> str:
    """Truthiness; a missing field is true, and so is any non-empty text."""
    return f"({f.missing} OR NOT {f.falsy})"


def coordinate(f: Field) -> str:
    """Number, numeric text or true as DOUBLE; null for anything else."""
    text = strip(f.text)
    return f"""CASE WHEN {f.falsy} THEN NULL
        WHEN {f.kind} = 'STRING' THEN
            if({text} RLIKE r'{_FLOAT}', try_cast(replace({text}, '_', '') AS DOUBLE), NULL)
        WHEN {f.kind} = 'BOOLEAN' THEN 1.0D
        ELSE try_cast({f.text} AS DOUBLE) END"""


def code_text(f: Field) -> str:
    """A station code as text; a missing one is empty, a JSON null has none."""
    text = f"if({f.kind} = 'BOOLEAN', initcap({f.text}), {f.text})"
    return f"if({f.missing}, '', {text})"


def district(code: str) -> str:
    """All but the last three characters as a number, when that is 1 to 99."""
    number = whole_number(f"left({code}, length({code}) - 3)")
    return f"if(length({code}) > 3 AND {number} BETWEEN 1 AND 99, {number}, NULL)"


def instant(text: str) -> str:
    """Extended ISO date or date-time text as TIMESTAMP, its offset applied; else null."""
    # To the form a cast reads: T, minutes, seconds, a point, and a colon in the offset.
    time = f"overlay(replace({text}, ',', '.') PLACING 'T' FROM 11 FOR 1)"
    time = f"regexp_replace({time}, r'^(.{{13}})(?=$|Z|[+-])', '$1:00')"
    time = f"regexp_replace({time}, r'^(.{{16}})(?=$|Z|[+-])', '$1:00')"
    time = f"regexp_replace({time}, r'([+-]\\d{{2}})(\\d{{2}})$', '$1:$2')"
    time = f"try_cast(if(length({text}) = 10, {text}, {time}) AS TIMESTAMP)"
    return f"if({text} RLIKE r'{_TIME}', {time}, NULL)"
