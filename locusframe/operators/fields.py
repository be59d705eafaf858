"""Typed INFO and FORMAT fields, split per ALT and joined back.

The header says for each field how many values it has: a fixed number, one
per ALT (A), one per allele (R), one per genotype (G), or any (.). Text becomes
typed columns by those rules; splitting a site gives each ALT the values that
concern it, and joining puts the values of all ALTs of a site in their places.

Genotypes of alleles j <= k have the place k(k+1)/2 + j; haploid calls have one
value per allele. Between REF and a single ALT that leaves places 0, k(k+1)/2
and k(k+1)/2 + k, or 0 and k. Values of genotypes of two different ALTs concern
no single ALT: they are null after a split and a join.

Defined results: ``.`` and absent fields are null; a list shorter than its rule
gives null where it ends; values that are not of their type are null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER = r'^##(INFO|FORMAT)=<ID=([^,]+),Number=([^,]+),Type=([^,>]+)'
TYPES = {"Integer": "int", "Float": "double", "String": "string", "Character": "string", "Flag": "boolean"}


@dataclass(frozen=True)
class Field:
    kind: str      # INFO or FORMAT
    name: str
    number: str    # a count, or A, R, G, .
    type: str      # Integer, Float, String, Character, Flag

    @property
    def scalar(self) -> bool:
        return self.number in ("0", "1")

    @property
    def sql_type(self) -> str:
        return TYPES[self.type]


def header_fields(lines: DataFrame, value: str = "value") -> list[Field]:
    """The fields that a header declares (a few hundred at most, one per
    header line); a field declared twice must be declared alike."""
    v = F.col(value)
    rows = (lines.where(v.rlike(HEADER)).select(*[F.regexp_extract(v, HEADER, i).alias(n) for i, n in
                                                  enumerate(("kind", "name", "number", "type"), 1)]).distinct().collect())
    seen: dict[tuple[str, str], Field] = {}
    for r in rows:
        f = Field(*r)
        if seen.setdefault((f.kind, f.name), f) != f:
            raise ValueError(f"{f.kind} field {f.name} is declared with different numbers or types")
        if f.type not in TYPES:
            raise ValueError(f"{f.kind} field {f.name} has the unknown type {f.type}")
    return sorted(seen.values(), key=lambda f: (f.kind, f.name))


def typed_value(text: Column, field: Field) -> Column:
    """Text of one field as a value, or as an array where it may hold several."""
    if field.type == "Flag":
        return text.isNotNull()
    present = F.when(text != ".", text)
    if field.scalar:
        return present.try_cast(field.sql_type)
    return F.transform(F.split(present, ",", -1), lambda x: x.try_cast(field.sql_type))


def with_info(sites: DataFrame, fields: list[Field], info: str = "info", prefix: str = "") -> DataFrame:
    """Adds a typed column per INFO field of ``fields``."""
    d = sites.withColumn("_info", F.split(info, ";", -1))

    def text(f: Field) -> Column:
        item = F.get(F.filter("_info", lambda p: F.substring_index(p, "=", 1) == f.name), F.lit(0))
        return F.substring(item, len(f.name) + 2, 1 << 30)  # empty for a flag, which has no "="

    return d.withColumns({prefix + f.name: typed_value(text(f), f) for f in fields if f.kind == "INFO"}).drop("_info")


def with_format(entries: DataFrame, fields: list[Field], fmt: str = "format", entry: str = "entry", prefix: str = "") -> DataFrame:
    """Adds a typed column per FORMAT field of ``fields``; the entry is split once."""
    d = entries.withColumns({"_f": F.split(fmt, ":", -1), "_e": F.split(entry, ":", -1)})

    def text(f: Field) -> Column:
        at = F.array_position("_f", f.name).cast("int")
        return F.when(at > 0, F.get("_e", at - 1))

    return d.withColumns({prefix + f.name: typed_value(text(f), f) for f in fields if f.kind == "FORMAT"}).drop("_f", "_e")


def genotype_place(j: Column, k: Column) -> Column:
    """Place of the genotype of alleles j <= k."""
    return (k * (k + 1) / 2).cast("int") + j


def genotype_alleles(place: Column) -> tuple[Column, Column]:
    """Alleles j <= k of the genotype at a place."""
    k = F.floor((F.sqrt(place.cast("double") * 8 + 1) - 1) / 2).cast("int")
    return place.cast("int") - (k * (k + 1) / 2).cast("int"), k


def split_value(value: Column, field: Field, allele: Column, n_alts: Column) -> Column:
    """What a field says about REF and the ALT ``allele`` (from 1) alone."""
    if field.scalar:
        return value
    at = allele.cast("int")
    if field.number == "A":
        return F.get(value, at - 1)
    if field.number == "R":
        return F.when(value.isNotNull(), F.array(F.get(value, F.lit(0)), F.get(value, at)))
    if field.number == "G":
        haploid = F.array(F.get(value, F.lit(0)), F.get(value, at))
        diploid = F.array(F.get(value, F.lit(0)), F.get(value, genotype_place(F.lit(0), at)), F.get(value, genotype_place(at, at)))
        return F.when(value.isNotNull(), F.when(F.size(value) == n_alts + 1, haploid).otherwise(diploid))
    return value


def split_fields(rows: DataFrame, fields: list[Field], alt: str = "alt", prefix: str = "") -> DataFrame:
    """One row per ALT: ``allele`` (from 1), ``alt`` alone, ``n_alts``, and
    every field's values for that ALT."""
    names = {prefix + f.name: f for f in fields}
    d = rows.withColumn("_alts", F.split(alt, ",", -1)).withColumn("n_alts", F.size("_alts"))
    rest = [c for c in rows.columns if c != alt and c not in names]
    d = d.select(*rest, *names, "n_alts", F.posexplode("_alts").alias("_i", alt)).withColumn("allele", F.col("_i") + 1)
    return d.select(*rest, "allele", alt, "n_alts", *[
        split_value(F.col(n), f, F.col("allele"), F.col("n_alts")).alias(n) for n, f in names.items()])


def join_fields(rows: DataFrame, keys: list[str], fields: list[Field], alt: str = "alt", prefix: str = "") -> DataFrame:
    """The inverse: one row per ``keys`` with all ALTs and whole lists. The
    rows of a key are its ALTs, so a group is as small as a site's ALT list."""
    names = {prefix + f.name: f for f in fields}
    one = F.struct("allele", alt, *names)
    g = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("_a"))

    def whole(name: str, f: Field) -> Column:
        each, first = F.transform("_a", lambda a: a[name]), F.col("_a")[0][name]
        known = F.exists("_a", lambda a: a[name].isNotNull())
        if f.number == "A":
            return F.when(known, each)
        if f.number == "R":
            ref = F.array(F.get(first, F.lit(0)))
            return F.when(known, F.concat(ref, F.transform("_a", lambda a: F.get(a[name], F.lit(1)))))
        if f.number == "G":
            def at(i: Column) -> Column:
                j, k = genotype_alleles(i)
                mine = F.get("_a", k - 1)[name]
                return (F.when(k == 0, F.get(first, F.lit(0))).when(j == 0, F.get(mine, F.lit(1)))
                        .when(j == k, F.get(mine, F.lit(2))))
            n = F.size("_a")
            diploid = F.transform(F.sequence(F.lit(0), ((n + 1) * (n + 2) / 2).cast("int") - 1), at)
            haploid = F.concat(F.array(F.get(first, F.lit(0))), F.transform("_a", lambda a: F.get(a[name], F.lit(1))))
            return F.when(known, F.when(F.exists("_a", lambda a: F.size(a[name]) == 3), diploid).otherwise(haploid))
        return first

    return g.select(*keys, F.array_join(F.transform("_a", lambda a: a[alt]), ",").alias(alt),
                    *[whole(n, f).alias(n) for n, f in names.items()])
