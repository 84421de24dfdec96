"""Chat formatting: records of several layouts to turns, turns to text with a loss mask."""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER, HEADER_END, TURN_END = "### ", ":\n", "</turn>\n"
# What is escaped inside texts and roles. "&" goes first and comes back last.
ESCAPES = (("&", "&amp;"), ("</turn>", "&end;"), ("#", "&num;"))
ROLE_ESCAPES = (*ESCAPES, (":", "&col;"))
TURN = "array<struct<place:bigint,role:string,text:string>>"


class Layout(NamedTuple):
    """A declared layout: the nested field paths a record of it has, and how they become turns.

    ``turns`` lists (role, path) pairs: the turn's role and where its text stands; ``each`` names an array whose
    elements are the turns, with the paths of their role and text. ``place`` may name the turn's number.
    A path that ends in ``?`` may be missing.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: str | None = None
    role: str | None = None
    text: str | None = None
    place: str | None = None


# Common layouts of prompt, instruction and message records, and a table of turns.
LAYOUTS = (
    Layout("rows", ("turn?", "role?", "text?"), role="role", text="text", place="turn"),
    Layout("messages", ("messages[]", "messages[].role?", "messages[].content?"), each="messages", role="role", text="content"),
    Layout("shares", ("conversations[]", "conversations[].from?", "conversations[].value?"), each="conversations", role="from", text="value"),
    Layout("prompt", ("prompt", "completion?"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout(
        "instruction",
        ("instruction", "input?", "output?"),
        turns=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
)


def field_paths(schema: T.StructType, skip: tuple[str, ...] = ()) -> dict[str, Column]:
    """Each nested field path of a table with the condition that a record has it (holds no null there)."""
    found: dict[str, Column] = {}

    def walk(kind: T.DataType, path: str, value) -> None:
        for field in kind.fields:
            name = f"{path}{field.name}"
            add(field.dataType, name, lambda r, f=field.name: value(r)[f])

    def add(kind: T.DataType, name: str, value) -> None:
        if isinstance(kind, T.StructType):
            walk(kind, f"{name}.", value)
        elif isinstance(kind, T.ArrayType):
            array = value(None)
            found[f"{name}[]"] = array.isNotNull()
            if isinstance(kind.elementType, T.StructType):
                for field in kind.elementType.fields:
                    found[f"{name}[].{field.name}"] = F.exists(array, _holds(field.name))
        else:
            found[name] = value(None).isNotNull()

    for field in schema.fields:
        if field.name not in skip:
            add(field.dataType, field.name, lambda _, f=field.name: F.col(f"`{f}`"))
    return found


def _holds(field: str):
    return lambda x: x[field].isNotNull()


def fingerprint(paths: Column) -> Column:
    """Hash of a set of field paths."""
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def layout_table(spark, layouts: tuple[Layout, ...]) -> DataFrame:
    """``_print`` and ``_layout``: the fingerprints of every layout, one for each set of its optional paths.

    Where two layouts share a fingerprint the earlier one holds.
    """
    rows, seen = [], set()
    for layout in layouts:
        must = [p for p in layout.paths if not p.endswith("?")]
        may = [p[:-1] for p in layout.paths if p.endswith("?")]
        for n in range(len(may) + 1):
            for some in combinations(may, n):
                key = tuple(sorted(must + list(some)))
                if key not in seen:
                    seen.add(key)
                    paths = F.array(*[F.lit(p) for p in key]).cast("array<string>")
                    rows.append(F.struct(fingerprint(paths).alias("_print"), F.lit(layout.name).alias("_layout")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def _likeliest(layouts: tuple[Layout, ...], paths: dict[str, Column]) -> Column:
    """The name of the layout that has the most of a record's fields among its own, and all it must have; null if none has any."""
    scores = []
    for i, layout in enumerate(layouts):
        there = [paths.get(p.rstrip("?"), F.lit(False)) for p in layout.paths]
        must = [t for t, p in zip(there, layout.paths, strict=True) if not p.endswith("?")]
        fits = F.array_min(F.array(F.lit(True), *must))
        named = F.aggregate(F.array(*[t.cast("int") for t in there]), F.lit(0), lambda a, b: a + b)
        scores.append(F.when(fits & (named > 0), F.struct(named.alias("named"), F.lit(-i).alias("first"), F.lit(layout.name).alias("name"))))
    return F.array_max(F.array(*scores))["name"]


def canonical_turns(records: DataFrame, conv: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv``, ``place``, ``role``, ``text``: the turns of all records, each by the layout its fingerprint selects.

    A record is a row; the fields it has are those that hold no null. Records whose fields are not those of one layout take the
    layout that names the most of them and lacks nothing it must have, of several the first; their other fields are not read. Only a
    record that has what no layout must have gives one turn with null role and text, so that its conversation stays. Columns that no layout names are left out first.
    The table of fingerprints is declared, so its broadcast does not grow with the data.
    """
    named = {p.rstrip("?").split("[")[0].split(".")[0] for lay in layouts for p in lay.paths}
    kept = records.select(F.col(f"`{conv}`").alias("_conv"), *[F.col(f"`{c}`") for c in records.columns if c in named and c != conv])
    paths = field_paths(kept.schema, ("_conv",))
    has = F.array_compact(F.array(*[F.when(there, F.lit(p)) for p, there in paths.items()])) if paths else F.array().cast("array<string>")
    known = F.broadcast(layout_table(records.sparkSession, layouts))
    chosen = kept.withColumn("_print", fingerprint(has)).join(known, "_print", "left")
    chosen = chosen.withColumn("_layout", F.coalesce("_layout", _likeliest(layouts, paths)))
    columns = set(kept.columns)

    def turn(place: Column, role: Column, text: Column) -> Column:
        return F.struct(place.cast("bigint").alias("place"), role.cast("string").alias("role"), text.cast("string").alias("text"))

    def value(holder, name: str | None, fields: set[str]) -> Column:
        return holder(name) if name in fields else F.lit(None).cast("string")

    def from_element(lay: Layout, fields: set[str]):
        return lambda x, i: turn(i, value(x.getField, lay.role, fields), value(x.getField, lay.text, fields))

    turns = F.lit(None).cast(TURN)
    for lay in reversed(layouts):
        if lay.each and lay.each in columns:
            fields = {f.name for f in kept.schema[lay.each].dataType.elementType.fields}
            made = F.transform(F.col(lay.each), from_element(lay, fields))
        elif lay.turns:
            made = F.array(*[
                F.when(F.col(p).isNotNull(), turn(F.lit(i), F.lit(role), F.col(p)))
                for i, (role, p) in enumerate(lay.turns) if p in columns
            ]).cast(TURN)
            made = F.array_compact(made)
        elif not lay.each:
            made = F.array(turn(*[value(F.col, name, columns) for name in (lay.place, lay.role, lay.text)]))
        else:
            continue
        turns = F.when(F.col("_layout") == lay.name, made).otherwise(turns)
    return chosen.select(F.col("_conv").alias(conv), F.explode_outer(turns).alias("_turn")).select(conv, "_turn.*")


def _escaped(text: Column, escapes: tuple[tuple[str, str], ...]) -> Column:
    for plain, mark in escapes:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def _plain(text: Column, escapes: tuple[tuple[str, str], ...]) -> Column:
    for plain, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_turns(turns: DataFrame, conv: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``loss_mask``.

    A turn becomes ``### role:`` and a line end, its text, ``</turn>`` and a line end; control strings inside roles
    and texts are escaped reversibly. ``loss_mask`` lists (turn, start, end): the code points, counted within
    the turn with that number in ``formatted``, that training learns from; they cover the texts of ``loss_role``.
    Turns stand by place, then role, then text, null first. Null roles and texts count as empty. A null conv_id is a
    conversation of its own. A conversation is one row of the result, so its turns meet in one task, which
    holds them as formatted pieces.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEADER), _escaped(role, ROLE_ESCAPES), F.lit(HEADER_END))
    body = _escaped(text, ESCAPES)
    piece = F.struct(
        "place", role.alias("role"), F.concat(head, body, F.lit(TURN_END)).alias("piece"),
        F.length(head).alias("start"), (F.length(head) + F.length(body)).alias("end"),
    )
    made = turns.select(conv, piece.alias("p"))
    ordered = made.groupBy(conv).agg(F.sort_array(F.collect_list("p")).alias("p"))
    spans = F.transform("p", lambda p, i: F.when(p["role"] == loss_role, F.struct(i.alias("turn"), p["start"].alias("start"), p["end"].alias("end"))))
    return ordered.select(
        conv, F.array_join(F.transform("p", lambda p: p["piece"]), "").alias("formatted"), F.array_compact(spans).alias("loss_mask")
    )


def read_back(formatted: DataFrame, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """The ``keep`` columns, ``turns`` (role, text) and ``learnt`` (the texts under the loss mask), from the output of ``format_turns`` alone."""
    pieces = F.filter(F.split("formatted", TURN_END), lambda p: p != "")
    parted = formatted.select("*", pieces.alias("_pieces"))
    start = len(HEADER)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEADER_END, 1)
        role = head.substr(F.lit(start + 1), F.length(head))
        text = piece.substr(F.length(head) + len(HEADER_END) + 1, F.length(piece) + 1)
        return F.struct(_plain(role, ROLE_ESCAPES).alias("role"), _plain(text, ESCAPES).alias("text"))

    def under_mask(m: Column) -> Column:
        piece = F.get("_pieces", m["turn"])
        return _plain(piece.substr(m["start"] + 1, m["end"] - m["start"]), ESCAPES)

    return parted.select(*keep, F.transform("_pieces", turn).alias("turns"), F.transform("loss_mask", under_mask).alias("learnt"))
