"""Nested documents to dotted-path leaves.

A document is one VARIANT value. ``leaves`` flattens it inside its row, for rules
that need a whole document at once; ``flatten_json`` gives one row per leaf.
Neither shuffles nor joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let

LEVELS = 6


def _node(path: Column, value: Column, still_open: bool) -> Column:
    return F.struct(path.alias("path"), value.alias("v"), F.lit(still_open).alias("open"))


def _below(path: Column, segment: Column) -> Column:
    return F.concat_ws(".", path, segment)  # the root path is NULL and drops out


def _open_one(node: Column, lone_lists: bool) -> Column:
    """Children of a node, or the node itself once it is known to be a scalar."""
    members = F.map_entries(F.try_variant_get(node["v"], "$", "map<string,variant>"))
    elements = F.try_variant_get(node["v"], "$", "array<variant>")

    def child(x: Column, i: Column) -> Column:
        return _node(_below(node["path"], i.cast("string")), x, True)

    def children(listed: Column) -> Column:
        if not lone_lists:
            return F.transform(listed, child)
        return F.when(F.size(listed) == 1, F.transform(listed, lambda x: _node(node["path"], x, True))).otherwise(
            F.transform(listed, child)
        )

    return F.when(~node["open"], F.array(node)).otherwise(
        F.coalesce(
            F.transform(members, lambda e: _node(_below(node["path"], e["key"]), e["value"], True)),
            let(elements, children) if lone_lists else children(elements),
            F.array(_node(node["path"], node["v"], False)),
        )
    )


def _truthy(text: Column, kind: Column) -> Column:
    """Truth of a scalar: empty text, 0, false and null count as false."""
    return (
        F.when(text.isNull(), False)
        .when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .otherwise(F.coalesce(text.try_cast("double") != 0, F.lit(True)))
    )


def _brackets(text: Column) -> Column:
    """Opening brackets in a JSON text: no document nests deeper than that."""
    return sum((F.length(text) - F.length(F.replace(text, F.lit(b), F.lit(""))) for b in "{["), F.lit(1))


def leaves(doc: Column, text: Column, lone_lists: bool = False, segments: bool = False) -> Column:
    """All leaves of a document as an array of structs.

    ``path``, ``value`` (text, NULL for an explicit null), ``truthy``, ``kind``
    (scalar type), ``seq`` (document order: list position, then key name).
    Empty objects and lists vanish. Depth is unlimited: one level is opened per
    step, the number of opening brackets in ``text`` bounds the steps, and steps
    after the last container cost nothing. ``lone_lists`` leaves the position
    out of a list of one, which is how a repeated XML tag that occurs once reads.
    ``segments`` adds ``ends``, what the mapping rules compare: the first and the
    last segment, or the one before the last when the last contains a digit.
    """
    bound = _brackets(text)
    start = F.struct(F.lit(False).alias("done"), F.array(_node(F.lit(None).cast("string"), doc, True)).alias("nodes"))

    def step(acc: Column, _: Column) -> Column:
        advanced = let(
            F.flatten(F.transform(acc["nodes"], lambda n: _open_one(n, lone_lists))),
            lambda nodes: F.struct((~F.exists(nodes, lambda n: n["open"])).alias("done"), nodes.alias("nodes")),
        )
        return F.when(acc["done"], acc).otherwise(advanced)

    def typed(node: Column) -> Column:
        value, kind = F.try_variant_get(node["v"], "$", "string"), F.schema_of_variant(node["v"])
        if lone_lists:  # an empty XML element reads as null, an empty attribute as text
            last = F.substring_index(node["path"], ".", -1)
            value = F.when((value == "") & ~last.startswith("@"), F.lit(None)).otherwise(value)
        return F.struct(value.alias("value"), kind.alias("kind"))

    def leaf(node: Column, i: Column) -> Column:
        return let(typed(node), lambda t: described(node["path"], t, i))

    def described(path: Column, t: Column, i: Column) -> Column:
        parts = [
            path.alias("path"),
            t["value"].alias("value"),
            _truthy(t["value"], t["kind"]).alias("truthy"),
            t["kind"].alias("kind"),
            i.alias("seq"),
        ]
        if segments:
            last = F.substring_index(path, ".", -1)
            before = F.substring_index(F.substring_index(path, ".", -2), ".", 1)
            named = F.when(last.rlike("[0-9]"), before).otherwise(last)
            parts.append(F.concat_ws("|", F.substring_index(path, ".", 1), named).alias("ends"))
        return F.struct(*parts)

    return F.when(
        doc.isNotNull(),
        F.aggregate(F.sequence(F.lit(1), bound), start, step, lambda acc: F.transform(acc["nodes"], leaf)),
    )


def flatten_json(df: DataFrame, doc: str = "doc", text: str = "body", lone_lists: bool = False) -> DataFrame:
    """One row per leaf: the other columns, ``path``, ``value``, ``kind``, ``seq``.

    Levels open one after another as lateral generators, in one narrow pass.
    What still is a container after ``LEVELS`` of them is flattened inside its
    row, so depth is not limited. ``seq`` orders the leaves of a document.
    XML documents (``lone_lists``) are flattened inside the row throughout.
    """
    others = [c for c in df.columns if c not in (doc, text)]
    if lone_lists:
        laid_out = df.select(*others, F.explode(leaves(F.col(doc), F.col(text), True)).alias("_leaf"))
        return laid_out.select(*others, "_leaf.path", "_leaf.value", "_leaf.kind", "_leaf.seq")

    opened, parent = "", f"d.`{doc}`"
    for i in range(LEVELS):
        outer = "_outer" if i else ""
        opened += f", LATERAL variant_explode{outer}({parent}) l{i}"
        parent = f"l{i}.value"
    segments = ", ".join(f"coalesce(l{i}.key, cast(l{i}.pos AS string))" for i in range(LEVELS))
    places = ", ".join(f"l{i}.pos" for i in range(LEVELS))
    value = ", ".join(f"l{i}.value" for i in reversed(range(LEVELS)))
    names = ", ".join(f"d.`{c}`" for c in others)
    rows = df.sparkSession.sql(
        f"SELECT {names}{', ' if others else ''}concat_ws('.', {segments}) AS _path, array({places}) AS _place, "
        f"coalesce({value}) AS _v FROM {{d}} d{opened}",
        d=df,
    )
    typed = rows.withColumn("_kind", F.schema_of_variant("_v"))
    container = F.col("_kind").startswith("OBJECT") | F.col("_kind").startswith("ARRAY")
    deeper = F.when(container, leaves(F.col("_v"), F.to_json("_v")))
    full = typed.select("*", F.explode_outer(deeper).alias("_leaf")).filter(F.col("_leaf").isNotNull() | ~container)
    below = F.col("_leaf").isNotNull()
    return full.select(
        *others,
        F.when(below, F.concat_ws(".", "_path", "_leaf.path")).otherwise(F.col("_path")).alias("path"),
        F.when(below, F.col("_leaf.value")).otherwise(F.try_variant_get("_v", "$", "string")).alias("value"),
        F.when(below, F.col("_leaf.kind")).otherwise(F.col("_kind")).alias("kind"),
        F.array_append("_place", F.coalesce("_leaf.seq", F.lit(0))).alias("seq"),
    )


def json_path(dotted: str) -> str:
    """``a.0.b`` as a VARIANT path ``$['a'][0]['b']``."""
    return "$" + "".join(f"[{s}]" if s.isdigit() else f"['{s}']" for s in dotted.split("."))


def extract_path(doc: Column, dotted: str | Column, as_type: str = "variant") -> Column:
    """Value at a dotted path: SQL NULL when absent, a VARIANT null when explicitly null.

    A path in a column, which differs by row, is walked segment by segment.
    """
    if isinstance(dotted, str):
        return F.try_variant_get(doc, json_path(dotted), as_type)

    def below(node: Column, segment: Column) -> Column:
        member = F.try_element_at(F.try_variant_get(node, "$", "map<string,variant>"), segment)
        element = F.get(F.try_variant_get(node, "$", "array<variant>"), segment.try_cast("int"))
        return F.coalesce(member, element)

    found = F.aggregate(F.split(dotted, r"\."), doc, below)
    return found if as_type == "variant" else F.try_variant_get(found, "$", as_type)


def has_path(doc: Column, dotted: str | Column) -> Column:
    """True when the path exists and is not null."""
    found = extract_path(doc, dotted)
    return F.coalesce(found.isNotNull() & ~F.is_variant_null(found), F.lit(False))


def explode_multi_field(df: DataFrame, dotted: str | Column, doc: str = "doc", keep: str = "all") -> DataFrame:
    """One row per element of the list at ``dotted``; an object there is taken
    as the document; where the path is missing or falsy the document stays.
    ``dotted`` may be a column, so that every vendor has its own path or none.

    Adds ``element_pos`` (0 for a document that was not a list). ``keep='last'``
    keeps only the last element of a list.
    """
    if keep not in ("all", "last"):
        raise ValueError(f"keep must be 'all' or 'last', not {keep!r}")
    found = extract_path(F.col(doc), dotted)
    elements = F.try_variant_get(found, "$", "array<variant>")
    members = F.try_variant_get(found, "$", "map<string,variant>")
    parts = (
        F.when(F.size(elements) > 0, F.slice(elements, -1, 1) if keep == "last" else elements)
        .when(F.size(F.map_keys(members)) > 0, F.array(found))
        .otherwise(F.array(F.col(doc)))
    )
    skipped = F.when(F.size(elements) > 0, F.size(elements) - 1).otherwise(0) if keep == "last" else F.lit(0)
    others = [c for c in df.columns if c != doc]
    return (
        df.withColumn("_skipped", skipped)
        .select(*others, "_skipped", F.posexplode(parts).alias("_pos", doc))
        .select(*others, (F.col("_pos") + F.col("_skipped")).alias("element_pos"), doc)
    )


def path_index(path: Column, segment: Column | int | None = None, legacy: bool = False) -> Column:
    """List position inside a path.

    Taken from the given segment where the path has it, else from the first
    segment that starts with a digit, else 0. ``legacy`` reads a single digit.
    Segment 0 counts as not given.
    """
    digits = r"\.(\d)" if legacy else r"\.(\d+)"
    first = F.coalesce(F.regexp_extract(path, digits, 1).try_cast("int"), F.lit(0))
    if segment is None:
        return first
    at = segment if isinstance(segment, Column) else F.lit(segment)
    segments = F.split(path, r"\.")
    here = F.get(segments, at)
    usable = (F.coalesce(at, F.lit(0)) > 0) & (F.size(segments) > at) & path.rlike(r"\.\d")
    return F.when(usable, F.when(here.rlike(r"^\d+$"), here.try_cast("int")).otherwise(0)).otherwise(first)
