"""Declared document schemas, coercion and validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field kinds with their Spark types, and spellings of bools in documents.
KINDS = {
    "text": T.StringType(),
    "u64": T.LongType(),
    "i64": T.LongType(),
    "f64": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.TimestampNTZType(),
    "facet": T.StringType(),
    "bytes": T.BinaryType(),
    "json": T.StringType(),
    "ip_addr": T.StringType(),
}
TRUE_WORDS = ["true", "1"]
FALSE_WORDS = ["false", "0"]
INTEGER = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
BASE64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$"
ZONE = r"(Z|[+-]\d\d:?\d\d)$"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    stored: bool = True
    indexed: bool = True
    fast: bool = False
    analyzer: str = "default"


@dataclass(frozen=True)
class SearchSchema:
    """Fields of one document set, declared in code and never inferred."""

    fields: tuple[Field, ...]

    def __post_init__(self):
        if not self.fields:
            raise ValueError("a schema needs a field")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError("field names must differ")
        for field in self.fields:
            if field.kind not in KINDS:
                raise ValueError(f"unknown field kind: {field.kind}")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def kind(self, name: str) -> str:
        for field in self.fields:
            if field.name == name:
                return field.kind
        raise ValueError(f"unknown field: {name}")

    def add(self, field: Field) -> "SearchSchema":
        return SearchSchema((*self.fields, field))

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, KINDS[f.kind], True, metadata(f)) for f in self.fields]
        )


def metadata(field: Field) -> dict:
    return {
        "kind": field.kind, "stored": field.stored, "indexed": field.indexed,
        "fast": field.fast, "analyzer": field.analyzer,
    }


def epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz"))


def parse_date(text: Column) -> Column:
    """Epoch seconds or ISO-8601 text in UTC, to whole seconds; null if it is neither."""
    local = text.try_cast("timestamp").cast("timestamp_ntz")
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    moment = F.when(text.rlike(INTEGER), epoch_seconds(text.try_cast("bigint"))).otherwise(
        F.when(text.rlike(ZONE), zoned).otherwise(local)
    )
    return F.date_trunc("second", moment).cast("timestamp_ntz")


def is_ip(text: Column) -> Column:
    groups = F.split(text, ":")
    hexes = F.forall(groups, lambda g: g.rlike(r"^[0-9A-Fa-f]{0,4}$"))
    gaps = F.size(F.split(text, "::", -1)) - 1
    full = (gaps == 0) & (F.size(groups) == 8) & ~F.exists(groups, lambda g: g == "")
    short = (gaps == 1) & (F.size(groups) <= 8) & ~text.contains(":::")
    return text.rlike(IPV4) | (hexes & (full | short))


def is_json(text: Column) -> Column:
    """One JSON value and nothing after it.

    The parser stops at the end of a value.  Inside brackets a stray brace or bracket cannot
    follow, and as an object's member a second value cannot.
    """
    member = F.concat(F.lit('{"v":'), text, F.lit("}"))
    element = F.concat(F.lit("["), text, F.lit("]"))
    return F.try_parse_json(member).isNotNull() & F.try_parse_json(element).isNotNull()


def coerce(kind: str, value: Column) -> Column:
    """Typed value of text, or null where the text does not fit the kind."""
    text = F.trim(value)
    if kind == "u64":
        number = F.when(text.rlike(INTEGER), text.try_cast("bigint"))
        return F.when(number >= 0, number)
    if kind == "i64":
        return F.when(text.rlike(INTEGER), text.try_cast("bigint"))
    if kind == "f64":
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    if kind == "bool":
        low = F.lower(text)
        return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)
    if kind == "date":
        return parse_date(text)
    if kind == "facet":
        path = F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
        return F.when((F.length(path) > 1) & ~path.contains("//") & ~path.endswith("/"), path)
    if kind == "bytes":
        return F.when(text.rlike(BASE64), F.unbase64(text))
    if kind == "json":
        return F.when(is_json(text), text)
    if kind == "ip_addr":
        return F.when(is_ip(text), F.lower(text))
    return value


def as_text(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def lenient_cast(df: DataFrame, schema: SearchSchema) -> DataFrame:
    """Typed columns; a value that does not fit becomes null and the row stays."""
    return df.select(
        *[
            coerce(schema.kind(c), as_text(df, c)).alias(c) if c in schema.names else F.col(c)
            for c in df.columns
        ]
    )


def apply_schema(df: DataFrame, schema: SearchSchema, only_stored: bool = False) -> DataFrame:
    """Declared fields of a raw text table, typed and carrying their options as metadata."""
    columns = []
    for field in schema.fields:
        if field.stored or not only_stored:
            value = (
                coerce(field.kind, as_text(df, field.name))
                if field.name in df.columns
                else F.lit(None).cast(KINDS[field.kind])
            )
            columns.append(value.alias(field.name, metadata=metadata(field)))
    return df.select(*columns)


def validate(df: DataFrame, schema: SearchSchema, strict: bool = False) -> DataFrame:
    """Typed columns and ``errors``, an array of (field, reason) in field order.

    Columns outside the schema stay as they are; in strict mode a value in one is an error.
    """
    checks, columns = [], []
    for field in schema.fields:
        if field.name not in df.columns:
            continue
        text = as_text(df, field.name)
        typed = coerce(field.kind, text)
        wrong = text.isNotNull() & typed.isNull()
        checks.append(F.when(wrong, error(field.name, f"not a valid {field.kind}")))
        columns.append(typed.alias(field.name))
    for name in df.columns:
        if name not in schema.names:
            columns.append(F.col(name))
            if strict:
                checks.append(F.when(F.col(name).isNotNull(), error(name, "unknown field")))
    return df.select(*columns, F.array_compact(F.array(*checks)).alias("errors"))


def error(field: str, reason: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"))


def leaves(struct: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all fields that are not structs; arrays are leaves."""
    found = []
    for field in struct.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            found += leaves(field.dataType, path)
        else:
            found.append(path)
    return found


def flatten_json(df: DataFrame, column: str, schema: T.StructType, separator: str = ".") -> DataFrame:
    """JSON text to one column per leaf, named by its path."""
    parsed = df.withColumn("_json", F.from_json(column, schema))
    kept = [F.col(c) for c in df.columns if c != column]
    return parsed.select(
        *kept,
        *[
            field_at(F.col("_json"), path).alias(separator.join(path))
            for path in leaves(schema)
        ],
    )


def field_at(column: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        column = column.getField(name)
    return column


def map_json_paths(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Values at dotted paths of JSON text as columns; a missing path is null."""
    return df.withColumns(
        {name: F.get_json_object(column, f"$.{path}") for path, name in mapping.items()}
    )
