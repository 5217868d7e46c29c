"""Chat formatting from many record layouts, in DataFrame expressions only.

A record's layout is known by a fingerprint: the hash of its sorted nested
field paths (fields that no layout names are left out).  Each fingerprint
selects a declarative mapping that turns the record into canonical turns
``array<struct<role, text>>``.  Tables with typed columns have one fingerprint,
taken from the schema; records in JSON text have one each, taken from their keys.

The template marks turns with ``<|turn|>role<|text|>text<|end|>``.  Inside roles
and texts, a backslash becomes two, ``<`` becomes ``\\l`` and ``[`` becomes ``\\b``, so no
control string of this or other templates can arise from a text, and ``parse``
gets the very same turns back.  ``loss`` lists the spans (first character and
length) of the assistant's texts in the formatted conversation.

Defined cases: null roles and texts count as empty; rows of one turn with the
same number are ordered by role and text; a null turn number comes first; rows
with a null id form one conversation; JSON records of an unknown layout (or no
JSON) keep null turns, so nothing is lost silently; an empty table gives no
rows; further columns of a typed table do not matter; a conversation is one row, so its size is
bounded by what one value may hold.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fuelsight.llm.common import table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

#: Names under which common layouts know the roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant", "model": "assistant"}

#: Layouts: a list of messages (its field, then the fields of role and text), texts in a fixed order (roles and their fields),
#: or one row per turn (the fields of conversation, turn, role and text).
LAYOUTS = [
    {"list": ("messages", "role", "content")},
    {"list": ("messages", "role", "text")},
    {"list": ("messages", "from", "value")},
    {"list": ("conversations", "from", "value")},
    {"list": ("conversations", "role", "content")},
    {"list": ("turns", "role", "text")},
    {"fixed": (("user", "prompt"), ("assistant", "response"))},
    {"fixed": (("user", "prompt"), ("assistant", "completion"))},
    {"fixed": (("system", "system"), ("user", "prompt"), ("assistant", "response"))},
    {"fixed": (("user", "question"), ("assistant", "answer"))},
    {"fixed": (("user", "instruction"), ("assistant", "output"))},
    {"fixed": (("user", ("instruction", "input")), ("assistant", "output"))},
    {"fixed": (("user", ("instruction", "context")), ("assistant", "response"))},
    {"rows": ("conv_id", "turn", "role", "text")},
]


def _paths(layout: dict) -> list[str]:
    if "list" in layout:
        field, *inner = layout["list"]
        return [field, *(f"{field}[].{x}" for x in inner)]
    if "rows" in layout:
        return list(layout["rows"])
    return [f for _, fields in layout["fixed"] for f in ((fields,) if isinstance(fields, str) else fields)]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


MAPPINGS = {fingerprint(_paths(x)): x for x in LAYOUTS}
_KNOWN = sorted({p for x in LAYOUTS for p in _paths(x)})
_LISTS = sorted({x["list"][0] for x in LAYOUTS if "list" in x})


def schema_paths(schema: T.StructType) -> list[str]:
    """Nested field paths of a schema; elements of an array are ``[]``."""

    def walk(kind, at):
        if isinstance(kind, T.StructType):
            for f in kind:
                path = f"{at}.{f.name}" if at else f.name
                yield path
                yield from walk(f.dataType, path)
        elif isinstance(kind, T.ArrayType):
            yield from walk(kind.elementType, f"{at}[]")

    return list(walk(schema, ""))


def _under(field: str):
    return lambda key: F.concat(F.lit(f"{field}[]."), key)


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON record's known paths."""
    keys = [F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))]
    for field in _LISTS:
        items = F.from_json(F.get_json_object(record, f"$.{field}"), "array<string>")
        inner = F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), F.array().cast("array<string>")))
        named = F.transform(F.array_distinct(F.flatten(inner)), _under(field))
        keys.append(F.coalesce(named, F.array().cast("array<string>")))
    known = F.array_intersect(F.concat(*keys), F.array(*[F.lit(p) for p in _KNOWN]))
    return F.sha2(F.array_join(F.array_sort(known), "\n"), 256)


def _role(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(names[role], role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _joined(texts: list[Column]) -> Column:
    """Texts that are not empty, an empty line between."""
    return F.array_join(F.filter(F.array(*[F.coalesce(t.cast("string"), F.lit("")) for t in texts]), lambda x: x != ""), "\n\n")


def _turns(layout: dict, get, items) -> Column:
    """Turns of a record; ``get(field)`` and ``items(field, inner)`` read it."""
    if "list" in layout:
        field, role, text = layout["list"]
        return F.transform(items(field, (role, text)), lambda x: _turn(_role(x[role]), x[text]))
    both = [(role, (f,) if isinstance(f, str) else f) for role, f in layout["fixed"]]
    return F.array(*[_turn(F.lit(role), _joined([get(f) for f in fields])) for role, fields in both])


def json_turns(df: DataFrame, json_col: str, out_col: str = "turns") -> DataFrame:
    """``df`` with the canonical turns of its JSON records; null where no layout fits."""
    record, mark = F.col(f"`{json_col}`"), json_fingerprint(F.col(f"`{json_col}`"))
    get = lambda field: F.get_json_object(record, f"$.{field}")
    items = lambda field, inner: F.from_json(get(field), f"array<struct<`{inner[0]}`: string, `{inner[1]}`: string>>")
    found = F.lit(None).cast("array<struct<role: string, text: string>>")
    for key, layout in MAPPINGS.items():
        if "rows" not in layout:
            found = F.when(F.col("_mark") == key, _turns(layout, get, items)).otherwise(found)
    return df.withColumn("_mark", mark).withColumn(out_col, found).drop("_mark")


def table_turns(df: DataFrame, out_col: str = "turns") -> DataFrame:
    """Canonical turns of a typed table, by the layout that its schema's fingerprint selects.

    Rows per turn give ``(conversation id, turns)``; other layouts add ``turns`` to their rows.
    """
    layout = MAPPINGS.get(fingerprint([p for p in schema_paths(df.schema) if p in _KNOWN]))
    if layout is None:
        raise ValueError(f"no layout has the fields {schema_paths(df.schema)}")
    if "rows" in layout:
        conv, turn, role, text = layout["rows"]
        one = F.struct(F.col(turn).alias("turn"), _role(F.col(role)).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        rows = df.groupBy(conv).agg(F.array_sort(F.collect_list(one), _before).alias("rows"))
        return rows.select(conv, F.transform("rows", lambda x: F.struct(x["role"], x["text"])).alias(out_col))
    return df.withColumn(out_col, _turns(layout, lambda f: F.col(f"`{f}`"), lambda f, _: F.col(f"`{f}`")))


def _before(x: Column, y: Column) -> Column:
    """Order by turn (null first), role and text."""
    by = lambda a, b: F.when(a < b, -1).when(a > b, 1)
    nulls = F.when(x["turn"].isNull() & y["turn"].isNotNull(), -1).when(x["turn"].isNotNull() & y["turn"].isNull(), 1)
    return F.coalesce(nulls, by(x["turn"], y["turn"]), by(x["role"], y["role"]), by(x["text"], y["text"]), F.lit(0))


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: between doubled backslashes, the codes stand for their characters."""
    codes = lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.array_join(F.transform(F.split(text, "\\\\\\\\", -1), codes), "\\")


def format_turns(turns: Column) -> Column:
    """A struct of the formatted conversation ``text`` and the ``loss`` spans of the assistant's texts."""
    pieces = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn")))

    def build(p: Column) -> Column:
        nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("spans"))

        def step(s, x):
            start, size = s["at"] + F.length(x["head"]), F.length(x["body"]).cast("long")
            more = F.concat(s["spans"], F.array(F.struct(start.alias("start"), size.alias("length"))))
            return F.struct((start + size + len(END)).alias("at"), F.when(x["learn"], more).otherwise(s["spans"]).alias("spans"))

        whole = F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
        return F.struct(whole.alias("text"), F.aggregate(p, nothing, step, lambda s: s["spans"]).alias("loss"))

    return F.transform(F.array(pieces), build)[0]


def parse(text: Column) -> Column:
    """The turns of a formatted conversation."""
    quote = lambda mark: "\\Q" + mark + "\\E"
    whole = F.filter(F.split(text, quote(TURN), -1), lambda x: x != "")
    parts = F.transform(whole, lambda x: F.split(x, quote(TEXT), 2))
    return F.transform(parts, lambda x: F.struct(
        unescape(x[0]).alias("role"), unescape(F.substring_index(x[1], END, 1)).alias("text")))


def learned(text: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


CONTROL = "</s>[INST] ok [/INST]"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONTROL))
    made = table_turns(rows.union(extra)).select("conv_id", format_turns(F.col("turns")).alias("f"))
    back = made.select("conv_id", F.col("f.text").alias("t"), parse(F.col("f.text")).alias("turns"), learned(F.col("f.text"), F.col("f.loss")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("t").cast("long").alias("formatted_chars"))


ORACLE = rf"""
    with rows as (
        select conv_id, turn, role, text from conversations
        union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}'),
    plain as (
        select conv_id, turn, coalesce(case {' '.join(f"when role = '{a}' then '{b}'" for a, b in ROLES.items())} else role end, '') as role,
               coalesce(text, '') as text from rows),
    sized as (
        select *, {sum(map(len, (TURN, TEXT, END)))} + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '[', '\b'))
               + length(replace(replace(replace(text, '\', '\\'), '<', '\l'), '[', '\b')) as n from plain),
    joined as (
        select conv_id, count(*) as n_turns,
               string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as lines,
               coalesce(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text), '') as learned,
               sum(n)::bigint as formatted_chars
        from sized group by conv_id)
    select conv_id, n_turns, sha256(lines) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256, formatted_chars from joined"""
