"""JSON attribute handling on Spark's VARIANT type (parse once, walk typed
values in the JVM); rewriting at any depth is one pattern over the text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_type_name(schema_str) -> F.Column:
    """Map a variant schema string to object/array/string/boolean/null/number."""
    s = F.upper(schema_str)
    return (F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array")
            .when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null")
            .otherwise("number"))


def top_level_keys(df: DataFrame, json_col: str, keep: list[str] | None = None) -> DataFrame:
    """(keep..., key, value VARIANT, jtype) per top-level key of a JSON text."""
    keep = keep or []
    sel = ", ".join([f"`{k}`" for k in keep] + ["e.key AS key", "e.value AS value"])
    x = df.sparkSession.sql(
        f"SELECT {sel} FROM {{src}}, LATERAL variant_explode(parse_json(`{json_col}`)) AS e", src=df)
    return x.withColumn("jtype", json_type_name(F.schema_of_variant("value")))


def keys_by_type(df: DataFrame, json_col: str) -> DataFrame:
    """Top-level keys grouped by JSON value type, with row counts."""
    k = top_level_keys(df, json_col)
    return k.groupBy("key", "jtype").agg(F.count(F.lit(1)).alias("n_rows"))


def typed_attributes(df: DataFrame, entity: str, attrs_col: str) -> DataFrame:
    """Unwrap entity attributes (JSON object per entity) into
    (entity, attr, kind, value): plain values as text; ``{itemsType:
    AttributeValue, items}`` lists and ``EntityReference`` lists as the
    comma-joined items / entity names; a single ``{entityType, entityName}``
    reference as its name; any other object as raw JSON."""
    k = top_level_keys(df, attrs_col, [entity]).withColumnRenamed("key", "attr")
    v = F.col("value")
    items_type = F.variant_get(v, "$.itemsType", "string")
    is_obj = F.col("jtype") == "object"
    vals = F.try_variant_get(v, "$.items", "array<string>")
    names = F.try_variant_get(v, "$.items", "array<struct<entityType:string,entityName:string>>")
    kind = (F.when(is_obj & (items_type == "AttributeValue"), "list")
            .when(is_obj & (items_type == "EntityReference"), "reference_list")
            .when(is_obj & F.variant_get(v, "$.entityName", "string").isNotNull(), "reference")
            .when(is_obj | (F.col("jtype") == "array"), "json").otherwise("scalar"))
    value = (F.when(kind == "list", F.array_join(vals, ","))
             .when(kind == "reference_list", F.array_join(F.transform(names, lambda x: x["entityName"]), ","))
             .when(kind == "reference", F.variant_get(v, "$.entityName", "string"))
             .when(kind == "json", F.to_json(v))
             .otherwise(F.variant_get(v, "$", "string")))
    return k.select(F.col(entity), "attr", kind.alias("kind"), value.alias("value"))


#: Escapes of JSON that a letter of a prefix may also be written with.
SHORT_ESCAPES = {"/": r"\\/", "\b": r"\\b", "\f": r"\\f", "\n": r"\\n", "\r": r"\\r", "\t": r"\\t", '"': r'\\"', "\\": r"\\\\"}


def _spelled(letter: str) -> str:
    """A pattern for every way JSON text can spell a letter of the basic plane."""
    code = "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in f"{ord(letter):04x}")
    ways = [rf"\\u{code}"]
    if letter in SHORT_ESCAPES:
        ways.append(SHORT_ESCAPES[letter])
    if letter not in '"\\':
        ways.append(f"[{letter}]" if letter not in "[]^-&" else "\\" + letter)
    return "(?:" + "|".join(ways) + ")"


def json_path_rewrite(df: DataFrame, json_col: str, prefix: str, new_prefix: str, out: str = "rewritten") -> DataFrame:
    """Rewrite every key and string value starting with ``prefix`` inside
    nested JSON of any depth, by one pattern: a string begins with the quote
    that stands first or follows ``[``, ``{``, ``,`` or ``:``; within strings
    quotes are escaped. All else stays as it is written. A prefix that begins
    with a blank or a mark that may follow a closing quote is an error."""
    if not prefix or prefix[0] in " \t\r\n,:]}" or max(prefix) > "\uffff":
        raise ValueError("a prefix must begin with something that cannot follow a closing quote")
    begin = r'((?:^|[\[{,:])[ \t\r\n]*")'
    new = json.dumps(new_prefix, ensure_ascii=False)[1:-1].replace("\\", "\\\\").replace("$", "\\$")
    return df.withColumn(out, F.regexp_replace(F.col(json_col), begin + "".join(map(_spelled, prefix)), "$1" + new))
