"""Chat formatting by schema fingerprints.

Input is one JSON record per conversation, in any of several layouts. The
nested field paths of a record are hashed; the hash selects a declarative
mapping, which turns the record into canonical turns (role, text). A template
writes the turns into one string. All steps are built-in column functions.

Defined results
* A null or malformed record, or one whose fingerprint no mapping has: layout
  null, no turns, formatted text empty.
* A null or missing text or role inside a known layout: empty string.
* A record too large for a VARIANT is matched by its top-level field names.
* Markers inside a text or role are escaped reversibly (``<|`` becomes
  ``<\\|``, a further backslash for each one that is already there).
* Repeated records give repeated rows; other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
VARIANT_BYTES = 8 * 1024 * 1024  # a VARIANT holds 16 MB; JSON text can shrink to half
LEAF_TYPES = (r": (?:VOID|BOOLEAN|BIGINT|STRING|DOUBLE|FLOAT|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY|UUID|VARIANT|"
              r"DECIMAL\(\d+,\s*\d+\))")


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    ``paths`` names the nested fields, fields in alphabetical order, e.g.
    ``OBJECT<messages: ARRAY<OBJECT<content, role>>>``. Either ``turns``
    lists (role, path) pairs, or ``items`` is the path of an array whose
    elements hold ``role`` and ``text`` fields. ``roles`` renames roles."""

    name: str
    paths: str
    turns: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "content"
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.paths.encode()).hexdigest()


SHARE_ROLES = {"human": "user", "gpt": "assistant"}
LAYOUTS = (
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", items="$.messages"),
    Layout("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", items="$.conversations",
           role="from", text="value", roles=SHARE_ROLES),
    Layout("turn list", "ARRAY<OBJECT<content, role>>", items="$"),
    Layout("prompt", "OBJECT<completion, prompt>", (("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("question", "OBJECT<answer, question>", (("user", "$.question"), ("assistant", "$.answer"))),
    Layout("instruction", "OBJECT<instruction, output>", (("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("instruction with input", "OBJECT<input, instruction, output>",
           (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("nested prompt", "OBJECT<prompt: OBJECT<system, user>, response>",
           (("system", "$.prompt.system"), ("user", "$.prompt.user"), ("assistant", "$.response"))),
)


def field_paths(record: Column) -> Column:
    """The nested field names of a parsed record, without the leaf types."""
    return F.regexp_replace(F.schema_of_variant(record), LEAF_TYPES, "")


def fingerprint(record: Column) -> Column:
    return F.sha2(field_paths(record), 256)


def _turns(record: Column, layout: Layout) -> Column:
    kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
    items = F.try_variant_get(record, layout.items, kind) if layout.items else None
    return _shape(lambda p, k: F.try_variant_get(record, p, k), items, layout)


def _shape(get, items: Column | None, layout: Layout) -> Column:
    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    if layout.items:

        def one(t: Column) -> Column:
            role = text(t[layout.role])
            for old, new in layout.roles.items():
                role = F.when(text(t[layout.role]) == old, F.lit(new)).otherwise(role)
            return F.struct(role.alias("role"), text(t[layout.text]).alias("text"))

        return F.transform(items, one)
    return F.array(*[F.struct(F.lit(r).alias("role"), text(get(p, "string")).alias("text"))
                     for r, p in layout.turns])


def _large(record: Column, layout: Layout) -> Column:
    """Turns of a record too large for a VARIANT (16 MB), parsed with the
    layout's own schema; null unless its top-level field names are those."""
    one = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
    allow = {"maxStringLen": str(2**31 - 1)}
    if layout.items == "$":
        hit, parsed = F.ltrim(record).startswith("["), F.from_json(record, one, allow)
    else:
        steps = [layout.items] if layout.items else [p for _, p in layout.turns]
        tree: dict = {}
        for p in steps:
            node = tree
            names = p.split(".")[1:]
            for n in names[:-1]:
                node = node.setdefault(n, {})
            node[names[-1]] = one if layout.items else "string"

        def ddl(node) -> str:
            return node if isinstance(node, str) else (
                "struct<" + ",".join(f"`{k}`:{ddl(x)}" for k, x in node.items()) + ">")

        parsed = F.from_json(record, ddl(tree), allow)
        hit = F.array_sort(F.json_object_keys(record)) == F.array(*[F.lit(k) for k in sorted(tree)])
        if layout.items:
            parsed = parsed[layout.items.split(".")[1]]
    return F.when(hit, _shape(lambda p, _: _walk(parsed, p), parsed, layout))


def _walk(c: Column, path: str) -> Column:
    for n in path.split(".")[1:]:
        c = c[n]
    return c


def canonical_turns(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``schema_fingerprint``, ``layout`` and ``turns``
    (array<struct<role, text>>); drops nothing."""
    v = F.try_parse_json(F.col(record))
    df = df.withColumn("_record", v).withColumn("schema_fingerprint", fingerprint(F.col("_record")))
    fp, name, turns = F.col("schema_fingerprint"), F.lit(None).cast("string"), None
    empty = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    for x in layouts:
        hit = fp == x.fingerprint
        name = F.when(hit, F.lit(x.name)).otherwise(name)
        t = _turns(F.col("_record"), x)
        turns = F.when(hit, t) if turns is None else turns.when(hit, t)
    found = empty if turns is None else turns.otherwise(empty)
    df = df.withColumn("layout", name).withColumn("turns", found)
    large = F.col("_record").isNull() & (F.octet_length(F.col(record)) > VARIANT_BYTES)
    spare = [(x, _large(F.col(record), x)) for x in layouts]
    if spare:
        by_name = F.coalesce(*[F.when(t.isNotNull(), F.lit(x.name)) for x, t in spare])
        df = (df.withColumn("layout", F.when(large, by_name).otherwise(F.col("layout")))
              .withColumn("turns", F.when(large, F.coalesce(*[t for _, t in spare])).otherwise(F.col("turns"))))
    return df.withColumn("turns", F.coalesce("turns", empty)).drop("_record")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def escape_role(c: Column) -> Column:
    """A role ends at the line break of the template, so it holds none."""
    flat = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(flat)


def unescape_role(c: Column) -> Column:
    flat = unescape(c)
    kept = F.split(flat, r"\\\\", -1)
    return F.array_join(F.transform(kept, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chats(df: DataFrame, trained: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` from ``turns``.

    ``loss_spans`` marks the trained text: per such turn its index, and start
    and length in code points from the first code point of that turn's start
    marker. Offsets are within the turn, so they cost the same for the last
    turn of a long conversation as for the first."""
    def header(t: Column) -> Column:
        return F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))

    formatted = F.array_join(F.transform("turns", lambda t: F.concat(header(t), escape(t["text"]), F.lit(END))), "")
    spans = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == trained, F.struct(
            i.alias("turn"), F.length(header(t)).alias("start"), F.length(escape(t["text"])).alias("length")))),
        lambda s: s.isNotNull())
    return df.withColumn("formatted", formatted).withColumn("loss_spans", spans)


def read_back(df: DataFrame) -> DataFrame:
    """Adds ``read_turns`` (parsed from ``formatted``) and ``loss_texts``
    (the unescaped text under each loss span, in order)."""
    pieces = F.split("formatted", r"<\|im_start\|>", -1)
    df = df.withColumn("_pieces", F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))

    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        text = F.substr(p, cut + 1, F.length(p) - cut - len(END))
        return F.struct(unescape_role(F.substr(p, F.lit(1), cut - 1)).alias("role"), unescape(text).alias("text"))

    def under(s: Column) -> Column:
        piece = F.get(F.col("_pieces"), s["turn"])
        return unescape(F.substr(piece, s["start"] + 1 - len(START), s["length"]))

    return (df.withColumn("read_turns", F.transform("_pieces", turn))
            .withColumn("loss_texts", F.transform("loss_spans", under)).drop("_pieces"))
