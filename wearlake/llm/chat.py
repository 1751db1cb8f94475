"""Chat formatting: records of different layouts become one marked-up text.

A record is JSON text. Its fingerprint is a hash of its nested field paths, whatever the
order or types of the fields; ``LAYOUTS`` maps the fingerprints of known layouts to
expressions over the parsed record that yield canonical turns. A record with other
fingerprints, such as one with further fields, has the layout whose fields it holds, the one
with most fields first. Turns are rendered with control strings around them; inside texts
every ``<|`` gets one more bar, so no text can look like a control string, and taking one bar
away restores it. The loss mask holds the places of the assistant's texts, in code points.

Everything is Spark SQL. Defined results: null texts and roles are empty texts; a record
that is null, no JSON or holds the fields of no layout has a null layout and no turns; so has
a list of messages without texts. Records with texts of over 20,000,000 characters, for which
the parser of the fingerprint gives null, are read like those with further fields; an empty
list of messages has no turns. Repeated records are formatted each for itself, and columns of
the input with the names of results are replaced.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import fresh

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
# Texts of any length are read by this option; the variant parser has a limit of its own.
ANY_LENGTH = "map('maxStringLen', '2147483647')"


@dataclass(frozen=True)
class Layout:
    """A layout: an example of its shape and its turns as an expression over ``v``.

    ``plain`` has the turns over ``{m}``, a map of the record's fields to texts, for records
    that are not read as ``v``.
    """

    name: str
    shape: str
    turns: str
    plain: str | None = None

    def held(self, m: str) -> str:
        """Whether the fields of the shape are among those of ``m``, as SQL."""
        found = []
        for field, value in json.loads(self.shape).items():
            found.append(f"map_contains_key({m}, '{field}')")
            if isinstance(value, list):
                items = _items(m, field)
                inner = [f"exists({items}, x -> map_contains_key(x, '{key}'))" for item in value for key in item]
                found += inner or [f"size({items}) = 0"]
        return " AND ".join(found)

    def fields(self) -> int:
        return sum(1 + sum(len(item) for item in value if value) for value in json.loads(self.shape).values())


def _items(m: str, field: str) -> str:
    return f"from_json({m}['{field}'], 'array<map<string,string>>', {ANY_LENGTH})"


def _of_fields(name: str, **roles: str) -> Layout:
    """A layout with a text field for each role, in order."""
    shape = json.dumps({field: "" for field in roles.values()})
    told = [f"named_struct('role', '{role}', 'text', {{}})" for role in roles]
    parsed = [t.format(f"variant_get(v, '$.{field}', 'string')") for t, field in zip(told, roles.values())]
    plain = [t.format(f"{{m}}['{field}']") for t, field in zip(told, roles.values())]
    return Layout(name, shape, f"array({', '.join(parsed)})", f"array({', '.join(plain)})")


def _of_list(name: str, path: str, role: str, text: str) -> Layout:
    """A layout with a list of objects, one for each turn."""
    return Layout(
        name,
        json.dumps({path: [{role: "", text: ""}]}),
        f"transform(variant_get(v, '$.{path}', 'array<struct<`{role}`:string,`{text}`:string>>'), "
        f"m -> named_struct('role', m.`{role}`, 'text', m.`{text}`))",
        f"transform({_items('{m}', path)}, x -> named_struct('role', x['{role}'], 'text', x['{text}']))",
    )


_WITH_INPUT = (
    "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', {0}, nullif({1}, ''))),"
    " named_struct('role', 'assistant', 'text', {2}))"
)
_INPUT_FIELDS = ("instruction", "input", "output")

LAYOUTS = (
    _of_list("messages", "messages", "role", "content"),
    Layout("no_messages", '{"messages":[]}', "array()", "array()"),
    _of_list("conversations", "conversations", "from", "value"),
    _of_list("turns", "turns", "role", "text"),
    _of_fields("prompt", user="prompt", assistant="response"),
    _of_fields("completion", user="prompt", assistant="completion"),
    _of_fields("system_prompt", system="system", user="prompt", assistant="response"),
    _of_fields("instruction", user="instruction", assistant="output"),
    Layout(
        "instruction_input",
        json.dumps({field: "" for field in _INPUT_FIELDS}),
        _WITH_INPUT.format(*(f"variant_get(v, '$.{field}', 'string')" for field in _INPUT_FIELDS)),
        _WITH_INPUT.format(*(f"{{m}}['{field}']" for field in _INPUT_FIELDS)),
    ),
)
TURNS = "array<struct<role:string,text:string>>"


def paths(record: Column) -> Column:
    """The nested field paths of a JSON record, without the types of values.

    The parsed form names fields in order; a scalar type after a field is cut, so that
    nulls, numbers and texts give the same paths.
    """
    shape = F.schema_of_variant(F.try_parse_json(record))
    bare = F.regexp_replace(shape, r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9,]*\))?", "")
    # Lists whose items differ only by nulls, and lists of bare values.
    return F.regexp_replace(bare, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z]+(\([0-9,]*\))?>", "ARRAY<>")


def fingerprint(record: Column) -> Column:
    """A hash of the nested field paths; null for what is no JSON."""
    found = paths(record)
    return F.when(found.isNotNull(), F.xxhash64(found))


def turns_of(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and canonical ``turns``.

    A record read by its fields alone has a null fingerprint where a text is too long for the
    parser of fingerprints.
    """
    (own,) = fresh(records.drop("v"), "_v")
    clash = [name for name in records.columns if name.lower() == "v"]
    if clash:
        records, record = records.withColumnRenamed(clash[0], own), own if record.lower() == "v" else record
    fields, which = fresh(records, "_fields", "_which")
    marked = records.withColumn("fingerprint", fingerprint(F.col(record)))
    parsed = marked.withColumn("v", F.try_parse_json(record))
    # By fingerprint, then by the fields a record holds.
    prints = {layout: fingerprint(F.lit(layout.shape)) for layout in layouts}
    exact = F.lit(None).cast("int")
    for i, layout in reversed(list(enumerate(layouts))):
        exact = F.when(F.col("fingerprint") == prints[layout], i).otherwise(exact)
    known = parsed.withColumn(which, exact)
    others = known.withColumn(
        fields, F.when(F.col(which).isNull(), F.expr(f"from_json(`{record}`, 'map<string,string>', {ANY_LENGTH})"))
    )
    held = F.lit(None).cast("int")
    for i, layout in sorted(enumerate(layouts), key=lambda x: x[1].fields()):
        if layout.plain is not None:
            held = F.when(F.expr(layout.held(fields)), -1 - i).otherwise(held)
    chosen = others.withColumn(which, F.coalesce(F.col(which), held))
    named, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for i, layout in enumerate(layouts):
        same, among = F.col(which) == i, F.col(which) == -1 - i
        named = F.when(same | among, layout.name).otherwise(named)
        turns = F.when(same, F.expr(layout.turns).cast(TURNS)).otherwise(turns)
        if layout.plain is not None:
            turns = F.when(among, F.expr(layout.plain.replace("{m}", fields)).cast(TURNS)).otherwise(turns)
    clean = F.expr("transform(turns, t -> named_struct('role', coalesce(t.role, ''), 'text', coalesce(t.text, '')))")
    out = chosen.withColumns({"layout": named, "turns": F.coalesce(turns, F.array().cast(TURNS))})
    out = out.withColumn("turns", clean).drop("v", fields, which)
    return out.withColumnRenamed(own, clash[0]) if clash else out


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", "<|$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", "<$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def rendered(df: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """``df`` (with ``turns``) plus ``formatted`` and ``loss_spans``.

    A span is the half-open range of code points of one learned text, as escaped.
    """
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), _escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == learned_role).alias("learned"),
        ),
    )
    (held,) = fresh(df, "_pieces")
    spans = f"aggregate(`{held}`" + """, named_struct('at', 0L, 'spans', CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT>>)),
        (acc, p) -> named_struct(
            'at', acc.at + length(p.head) + length(p.body) + {tail}L,
            'spans', CASE WHEN p.learned THEN array_append(acc.spans, named_struct(
                'start', acc.at + length(p.head), 'end', acc.at + length(p.head) + length(p.body)))
              ELSE acc.spans END),
        acc -> acc.spans)""".format(tail=len(END) + 1)
    text = F.transform(held, lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n")))
    return (
        df.withColumn(held, pieces)
        .withColumns({"formatted": F.array_join(text, ""), "loss_spans": F.expr(spans)})
        .drop(held)
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text."""
    marked = F.split(formatted, r"<\|im_start\|>", -1)
    parts = F.slice(marked, F.lit(2), F.greatest(F.size(marked) - 1, F.lit(0)))
    tail = len(END) + 1
    return F.transform(
        parts,
        lambda part: F.struct(
            _unescaped_role(F.substring_index(part, "\n", 1)).alias("role"),
            unescaped(
                F.substring(part, F.locate("\n", part) + 1, F.length(part) - F.locate("\n", part) - tail)
            ).alias("text"),
        ),
    )


def learned_text(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers, as it was before escaping, in order."""
    parts = F.transform(
        spans,
        lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return F.array_join(parts, "")
