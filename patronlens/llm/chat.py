"""Chat records of many layouts as canonical turns, and turns as one marked string and back.

**Layouts.** A record is a VARIANT (or JSON text). Its schema gives the nested field paths, such as
``messages[].role``; those that some layout knows are sorted and hashed. The hash, the
fingerprint, selects a declarative mapping from the table of all layouts, which says where
roles and texts stand. Fields that no layout knows do not matter, nor do the order of fields and the types
of values. Records whose fingerprint is not in the table are returned by ``unmapped``.

**Template.** A turn is written as ``<|im_start|>role``, line feed, text, ``<|im_end|>`` and line
feed. Control strings of this and other templates inside roles and texts are written as an
escape sign and a letter, the sign itself as sign and ``0``, so that marks are always
marks and the texts come back unchanged. ``spans`` has one entry per turn: where its text
lies, in code points, and whether it is trained on; those of assistants are the loss mask.

Null texts are empty, null roles are an empty role. An absent or null optional field gives no turn;
an empty text gives a turn. Turns with the same place are ordered by role and text; repeated
rows are repeated turns. A conversation without a turn gives no row. One conversation is one
string, whose length Spark limits to 2 GB; its parts are joined once, in linear time. An
empty table gives no rows. Extra columns of records are ignored, whatever their names.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that common layouts give to the roles.
ROLE_NAMES = {
    "human": "user",
    "prompter": "user",
    "gpt": "assistant",
    "bot": "assistant",
    "chatbot": "assistant",
    "model": "assistant",
    "ai": "assistant",
    "developer": "system",
    "function": "tool",
    "observation": "tool",
}


# --- layouts ---


@dataclass(frozen=True)
class Listed:
    """A list of objects, each a turn. With ``parts`` the text is a list of objects itself."""

    path: str
    role: str
    text: str
    parts: str | None = None

    def paths(self) -> tuple[str, ...]:
        text = f"{self.path}[].{self.text}"
        return f"{self.path}[].{self.role}", text if self.parts is None else f"{text}[].{self.parts}"

    def turns(self, record: Column) -> Column:
        text = "string" if self.parts is None else f"array<struct<`{self.parts}`: string>>"
        shape = f"array<struct<`{self.role}`: string, `{self.text}`: {text}>>"
        found = F.try_variant_get(record, f"$.{self.path}", shape)

        def turn(t: Column) -> Column:
            value = t[self.text]
            if self.parts is not None:
                value = F.array_join(F.transform(value, lambda p: p[self.parts]), "")
            return F.struct(t[self.role].alias("role"), value.alias("text"))

        return F.transform(found, turn)


@dataclass(frozen=True)
class Alternating:
    """A list of strings: user and assistant by turns."""

    path: str

    def paths(self) -> tuple[str, ...]:
        return (f"{self.path}[]",)

    def turns(self, record: Column) -> Column:
        found = F.try_variant_get(record, f"$.{self.path}", "array<string>")
        role = lambda i: F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
        return F.transform(found, lambda t, i: F.struct(role(i).alias("role"), t.alias("text")))


@dataclass(frozen=True)
class Single:
    """One field, a turn of a fixed role. Several fields are joined by blank lines."""

    role: str
    fields: tuple[str, ...]

    def paths(self) -> tuple[str, ...]:
        return self.fields

    def turns(self, record: Column) -> Column:
        values = [F.try_variant_get(record, f"$.{f}", "string") for f in self.fields]
        present = F.filter(F.array(*values), lambda v: v.isNotNull())
        if len(values) > 1:  # an empty second field, such as an input, adds nothing
            present = F.filter(present, lambda v: v != "")
        turn = F.struct(F.lit(self.role).alias("role"), F.array_join(present, "\n\n").alias("text"))
        missing = F.forall(F.array(*values), lambda v: v.isNull())
        return F.when(~missing, F.array(turn))


@dataclass(frozen=True)
class Row:
    """The record itself is one turn."""

    role: str
    text: str

    def paths(self) -> tuple[str, ...]:
        return self.role, self.text

    def turns(self, record: Column) -> Column:
        role, text = (F.try_variant_get(record, f"$.{f}", "string") for f in (self.role, self.text))
        return F.array(F.struct(role.alias("role"), text.alias("text")))


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record stand. ``optional`` paths may be absent."""

    name: str
    sources: tuple[Listed | Alternating | Single | Row, ...]
    optional: tuple[str, ...] = ()
    rename: bool = True

    def paths(self) -> set[str]:
        return {p for source in self.sources for p in source.paths()}

    def path_sets(self) -> list[tuple[str, ...]]:
        """All sets of known paths that a record of this layout may have."""
        every = self.paths()
        open_ = sorted(set(self.optional) & every)
        return [
            tuple(sorted(every - set(gone))) for n in range(len(open_) + 1) for gone in combinations(open_, n)
        ]

    def turns(self, record: Column) -> Column:
        none = F.array().cast("array<struct<role:string,text:string>>")
        parts = [F.coalesce(source.turns(record), none) for source in self.sources]
        found = F.concat(*parts)
        if not self.rename:
            return found
        names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])

        def renamed(t: Column) -> Column:
            lower = F.lower(F.trim(t["role"]))
            return F.struct(F.coalesce(names[lower], lower).alias("role"), t["text"].alias("text"))

        return F.transform(found, renamed)


def _pair(name: str, user: str, assistant: str) -> Layout:
    sources = (Single("system", ("system",)), Single("user", (user,)), Single("assistant", (assistant,)))
    return Layout(name, sources, optional=("system",))


LAYOUTS = (
    Layout("messages", (Single("system", ("system",)), Listed("messages", "role", "content")), ("system",)),
    Layout(
        "message_parts",
        (Single("system", ("system",)), Listed("messages", "role", "content", parts="text")),
        ("system",),
    ),
    Layout("from_value", (Single("system", ("system",)), Listed("conversations", "from", "value")), ("system",)),
    Layout("conversation", (Listed("conversation", "role", "content"),)),
    Layout("role_text", (Listed("turns", "role", "text"),)),
    Layout("speaker_utterance", (Listed("dialogue", "speaker", "utterance"),)),
    Layout("strings", (Alternating("dialog"),)),
    Layout(
        "instruction",
        (
            Single("system", ("system",)),
            Single("user", ("instruction", "input")),
            Single("assistant", ("output",)),
        ),
        ("system", "input"),
    ),
    _pair("prompt_completion", "prompt", "completion"),
    _pair("prompt_response", "prompt", "response"),
    _pair("question_answer", "question", "answer"),
    Layout("messages_completion", (Listed("prompt", "role", "content"), Listed("completion", "role", "content"))),
)

#: Rows of one turn each, whose roles are kept as they are.
TURN_ROW = Layout("turn_row", (Row("role", "text"),), rename=False)


# --- fingerprints ---

_DEEP = 4
_ANY_LIST, _LIST_OF_OBJECTS, _NESTED = r"^ARRAY<", r"^ARRAY<OBJECT<", r"^(ARRAY|OBJECT)<"


def _names_of(schema: Column) -> Column:
    """``name: TYPE, name: TYPE`` of the objects of a list. What is nested deeper is folded into its
    kind, so that it neither hides nor feigns a field."""
    inside = F.regexp_extract(schema, r"(?s)^ARRAY<OBJECT<(.*)>>$", 1)
    for _ in range(_DEEP):
        inside = F.regexp_replace(inside, r"(ARRAY|OBJECT)<[^<>]*>", "$1")
    return inside


def _has_field(schema: Column, name: str, nested: bool = False) -> Column:
    kind = "ARRAY" if nested else "(?!ARRAY|OBJECT)"
    return schema.rlike(_LIST_OF_OBJECTS) & _names_of(schema).rlike(f"(^|, )`?{name}`?: {kind}")


def _schema_at(record: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(record, f"$.{path}", "variant"))


def _has_path(record: Column, path: str) -> Column:
    """Whether a record has a path such as ``prompt``, ``dialog[]``, ``turns[].text`` or
    ``messages[].content[].text``; a null value counts."""
    top, *steps = path.split("[]")
    schema = _schema_at(record, top)
    if not steps:
        return ~schema.rlike(_NESTED)
    first, *rest = (step.removeprefix(".") for step in steps)
    if not first:
        return schema.rlike(_ANY_LIST) & ~schema.rlike(r"^ARRAY<(ARRAY|OBJECT)<")
    if not rest:
        return _has_field(schema, first)
    elements = F.try_variant_get(record, f"$.{top}", "array<variant>")
    deeper = F.exists(elements, lambda e: F.coalesce(_has_field(_schema_at(e, first), rest[0]), F.lit(False)))
    return _has_field(schema, first, nested=True) & deeper


def field_paths(record: Column, known: Sequence[str]) -> Column:
    """The paths of ``known``, in their order, that a VARIANT has."""
    return F.array_compact(F.array(*[F.when(_has_path(record, p), F.lit(p)) for p in known]))


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _known(layouts: Sequence[Layout]) -> list[str]:
    return sorted({p for layout in layouts for p in layout.paths()})


def fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """64-bit hash of the nested field paths that the layouts know."""
    return _hash(field_paths(record, _known(layouts)))


def layout_of(print_: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Name of the layout with this fingerprint; null if there is none."""
    entries: dict[tuple[str, ...], str] = {}
    for layout in layouts:
        for paths in layout.path_sets():
            if entries.setdefault(paths, layout.name) != layout.name:
                raise ValueError(f"{layout.name} and {entries[paths]} have the same fields {paths}")
    pairs = [x for paths, name in entries.items() for x in (_hash(F.array(*map(F.lit, paths))), F.lit(name))]
    return F.create_map(*pairs)[print_]


def as_record(df: DataFrame, column: str | None = None) -> Column:
    """A record as VARIANT: a VARIANT column, a JSON text (null if it is none), or all columns."""
    if column is None:
        return F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    if isinstance(df.schema[column].dataType, T.VariantType):
        return F.col(column)
    return F.try_parse_json(column)


def with_layout(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Replace the VARIANT ``_record`` by ``layout`` and ``turns``, an array of role and text; both
    are null where no layout fits."""
    found = records.withColumn("layout", layout_of(fingerprint(F.col("_record"), layouts), layouts))
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, layout.turns(F.col("_record"))).otherwise(turns)
    return found.withColumn("turns", turns).drop("_record")


def canonical_turns(
    records: DataFrame, keep: Sequence[str], record: str | None = None, layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """``*keep, place, role, text, layout``: a row per turn of every record that has a layout.
    ``place`` counts the turns of one record."""
    if clash := {"place", "role", "text", "layout"} & set(keep):
        raise ValueError(f"kept columns have the names of turn columns: {sorted(clash)}")
    whole = records.select(as_record(records, record).alias("_record"), *keep)
    turns = with_layout(whole, layouts).select(*keep, "layout", F.posexplode("turns").alias("place", "_turn"))
    place = F.col("place").cast("long").alias("place")
    return turns.select(*keep, place, "_turn.role", "_turn.text", "layout")


def unmapped(records: DataFrame, record: str | None = None, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``fingerprint, record`` of the records whose fingerprint no layout has."""
    row = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")
    found = records.select(fingerprint(as_record(records, record), layouts).alias("fingerprint"), row)
    return found.where(layout_of(F.col("fingerprint"), layouts).isNull())


# --- template ---


@dataclass(frozen=True)
class Template:
    """Marks of a turn and how control strings inside roles and texts are written."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    escape: str = "\u241b"
    trained: tuple[str, ...] = ("assistant",)
    #: Control strings of common templates.
    control: tuple[str, ...] = (
        "<|im_start|>",
        "<|im_end|>",
        "<|endoftext|>",
        "<|begin_of_text|>",
        "<|start_header_id|>",
        "<|end_header_id|>",
        "<|eot_id|>",
        "<|system|>",
        "<|user|>",
        "<|assistant|>",
        "<s>",
        "</s>",
        "[INST]",
        "[/INST]",
        "<<SYS>>",
        "<</SYS>>",
    )

    def codes(self) -> list[tuple[str, str]]:
        """Control strings and what stands for them: the escape sign and a letter."""
        return [(c, self.escape + chr(ord("a") + i)) for i, c in enumerate(self.control)]

    def escaped(self, value: Column) -> Column:
        value = F.replace(value, F.lit(self.escape), F.lit(self.escape + "0"))
        for control, code in self.codes():
            value = F.replace(value, F.lit(control), F.lit(code))
        return value

    def escaped_role(self, value: Column) -> Column:
        """A role ends with its line, so line feeds are written as codes too."""
        return F.replace(self.escaped(value), F.lit("\n"), F.lit(self.escape + "1"))

    def unescaped(self, value: Column) -> Column:
        value = F.replace(value, F.lit(self.escape + "1"), F.lit("\n"))
        for control, code in self.codes():
            value = F.replace(value, F.lit(code), F.lit(control))
        return F.replace(value, F.lit(self.escape + "0"), F.lit(self.escape))


CHATML = Template()


def formatted(turns: DataFrame, key: str, template: Template = CHATML, order: Sequence[str] = ("place",)) -> DataFrame:
    """``key, formatted, spans`` of the conversations of ``turns(key, *order, role, text)``.

    ``spans`` is an array of ``start, end, trained``, one entry per turn, in code points of
    ``formatted``: where the text of the turn stands, and whether the loss covers it.
    """
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    marked = turns.select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
        role.alias("_role"),
        text.alias("_text"),
        F.concat(F.lit(template.opening), template.escaped_role(role), F.lit("\n")).alias("_head"),
        template.escaped(text).alias("_body"),
        role.isin(*template.trained).alias("_trained"),
    )
    # The rows of a conversation meet once: its window and its group have the same partitioning.
    by_turn = Window.partitionBy("_key").orderBy(*[f"_order{i}" for i in range(len(order))], "_role", "_text")
    length = F.length("_head") + F.length("_body") + len(template.closing)
    before = F.coalesce(F.sum(length).over(by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + F.length("_head")
    placed = marked.select(
        "_key",
        F.struct(
            F.row_number().over(by_turn).alias("place"),
            F.concat("_head", "_body", F.lit(template.closing)).alias("piece"),
            F.struct(
                start.alias("start"), (start + F.length("_body")).alias("end"), F.col("_trained").alias("trained")
            ).alias("span"),
        ).alias("_turn"),
    )
    whole = placed.groupBy("_key").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    return whole.select(
        F.col("_key").alias(key),
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("_turns", lambda t: t["span"]).alias("spans"),
    )


def _literal(text: str) -> str:
    """A regular expression that matches ``text`` alone."""
    return "\\Q" + text + "\\E"


def parsed(value: Column, template: Template = CHATML) -> Column:
    """Array of role and text of the turns in a formatted conversation, as they were."""
    segments = F.filter(F.split(value, _literal(template.closing)), lambda s: s != "")

    def turn(segment: Column) -> Column:
        role = F.substring_index(segment, "\n", 1)
        text = F.substr(segment, F.length(role) + 2)
        role = F.substr(role, F.lit(len(template.opening) + 1))
        return F.struct(template.unescaped(role).alias("role"), template.unescaped(text).alias("text"))

    return F.transform(segments, turn)


def trained_text(value: Column, spans: Column, template: Template = CHATML) -> Column:
    """All text of a formatted conversation under the loss mask, unescaped, with nothing between.

    A span is read from the piece that it lies in, the text between two closing marks, at its
    distance from the piece's start, so that the time is linear in the conversation's length.
    """
    segments = F.split(value, _literal(template.closing))

    def covered(span: Column, i: Column) -> Column:
        earlier = F.when(i > 0, F.get(spans, i - 1)["end"] + len(template.closing)).otherwise(F.lit(0))
        text = F.substr(F.get(segments, i), span["start"] - earlier + 1, span["end"] - span["start"])
        return F.when(span["trained"], template.unescaped(text)).otherwise(F.lit(""))

    return F.array_join(F.transform(spans, covered), "")
