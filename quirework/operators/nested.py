"""Deeply nested records to flat, linked tables.

Two entries share one idea: every array level becomes a child table whose rows carry the parent's key and the element's
0-based position in its array.

* `flatten_struct` takes a typed DataFrame and walks its schema.
* `infer_layout` and `flatten_json` take a column of JSON text of no fixed shape. A first pass over all payloads merges what they hold
  into one layout: which keys wrap records, which fields of records are arrays of objects at any depth. The second
  pass parses each payload once into a VARIANT and explodes level after level inside the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let

#: A layout with more distinct paths than this is no record schema (keys are data); infer_layout refuses it.
MAX_PATHS = 20_000


# ---------------------------------------------------------------------------------------------------- typed tables
def flatten_struct(df: DataFrame, key: str, root: str = "record") -> dict[str, DataFrame]:
    """One table per array-of-struct level of df's schema, by path: {"record": ..., "lines": ..., "lines.words": ...}.

    Each child row has `key`, one `<parent>_pos` column per level above it, its own `<level>_pos` (0-based) and its scalar fields;
    arrays of scalars stay columns. Null elements keep their position and give no row; null or empty arrays give none. Child fields that
    clash with a key or position column get a trailing underscore. Equal keys in df stay apart only if the key is unique;
    repeated rows give repeated child rows.
    """
    out: dict[str, DataFrame] = {}

    def level(table: DataFrame, fields: list[T.StructField], at: str, path: str, links: list[str]) -> None:
        arrays = [f for f in fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
        used = {x.lower() for x in links}
        plain = []
        for f in fields:
            if f in arrays or (at == "" and f.name == key):
                continue
            name = f.name
            while name.lower() in used:
                name += "_"
            used.add(name.lower())
            plain.append(F.col(f"{at}`{f.name}`").alias(name))
        out[path or root] = table.select(*links, *plain)
        for f in arrays:
            pos = f"{f.name.rstrip('s')}_pos"
            while pos.lower() in {x.lower() for x in links}:
                pos += "_"
            child = table.select(*links, F.posexplode(F.col(f"{at}`{f.name}`")).alias(pos, "__e")).where("__e is not null")
            level(child, f.dataType.elementType.fields, "__e.", f"{path}.{f.name}" if path else f.name, [*links, pos])

    level(df, df.schema.fields, "", "", [key])
    return out


# ------------------------------------------------------------------------------------------------------ JSON text
@dataclass(frozen=True)
class Layout:
    """What all payloads together hold. wrappers: keys of a root object under which records (or one record) stand.
    arrays: paths below a record that hold arrays of objects or of nulls, also where some payloads send them as JSON text.
    kinds: every path with the kinds of value seen there. fields: names of which an object needs one to be a record."""

    wrappers: tuple[str, ...] = ()
    arrays: tuple[tuple[str, ...], ...] = ()
    kinds: dict[str, tuple[str, ...]] = field(default_factory=dict)
    fields: tuple[str, ...] = ()

    def schema_ddl(self) -> str:
        """The merged schema as sorted `path: kinds` lines."""
        return "\n".join(f"{p or '$'}: {'|'.join(k)}" for p, k in sorted(self.kinds.items()))


def json_body(payload: Column) -> Column:
    """The text from the first to the last bracket, in time linear in its length. Null if it has none."""
    first = F.regexp_instr(payload, F.lit(r"[\[{]"))
    last = F.regexp_instr(F.reverse(payload), F.lit(r"[\]}]"))
    return F.when((first > 0) & (last > 0), F.substr(payload, first, F.length(payload) - first - last + 2))


def parsed(payload: Column) -> Column:
    """payload as VARIANT: the text itself, else the text between its outermost brackets; null if neither is valid JSON."""
    return F.coalesce(F.try_parse_json(payload), F.try_parse_json(json_body(payload)))


_KIND = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}


def _loads(text: str):
    try:
        return json.loads(text)
    except ValueError:
        a = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
        b = max(text.rfind("}"), text.rfind("]"))
        if a < 0 or b < a:
            return None
        try:
            return json.loads(text[a : b + 1])
        except ValueError:
            return None


def _census(payloads: Iterable[str | None], seen: set[tuple[str, str]]) -> None:
    def walk(path: str, v) -> None:
        kind = _KIND[type(v)]
        if kind == "string" and v[:1] in ("[", "{"):
            try:
                inner = json.loads(v)
            except ValueError:
                inner = None
            if isinstance(inner, dict) or isinstance(inner, list) and any(isinstance(x, dict) for x in inner):
                seen.add((path, "text"))
                walk(path, inner)
                return
        seen.add((path, kind))
        if kind == "object":
            for k, x in v.items():
                walk(f"{path}\x1f{k}", x)
        elif kind == "array":
            kinds = set(map(type, v))
            if kinds <= {int, float, bool, str}:
                seen.update((f"{path}\x1f[]", _KIND[k]) for k in kinds)
            else:
                for x in v:
                    walk(f"{path}\x1f[]", x)

    for text in payloads:
        if text and not text.isspace():
            walk("", _loads(text))


def infer_layout(payloads: DataFrame, column: str, record_fields: Iterable[str]) -> Layout:
    """The merged layout of all payloads. record_fields: names of which an object needs one to be a record.

    One pass without a shuffle of payloads: each partition emits the distinct (path, kind) it met, at most one row per path and kind.
    Payloads that are null, blank or no JSON add nothing. Raises ValueError beyond MAX_PATHS paths.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for b in batches:
            _census(b.column(0).to_pylist(), seen)
            if len(seen) > MAX_PATHS:
                break
        rows = sorted(seen)
        yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in rows], pa.string()), "kind": pa.array([k for _, k in rows], pa.string())})

    rows = payloads.select(F.col(column).cast("string")).mapInArrow(scan, "path string, kind string").distinct().limit(MAX_PATHS + 1).collect()
    if len(rows) > MAX_PATHS:
        raise ValueError(f"more than {MAX_PATHS} distinct paths: the keys look like data")
    kinds: dict[str, set[str]] = {}
    for r in rows:
        kinds.setdefault(r.path, set()).add(r.kind)
    names = set(record_fields)

    def is_record(path: str) -> bool:
        return "object" in kinds.get(path, ()) and any(f"{path}\x1f{n}" in kinds for n in names)

    roots = [p for p in kinds if is_record(p) and p.count("\x1f") <= 2 and not any(s in names for s in p.split("\x1f"))]
    wrappers = sorted({keys[0] for p in roots if (keys := [k for k in p.split("\x1f")[1:] if k != "[]"])})
    arrays = set()
    for root in roots:
        for p, k in kinds.items():
            if p.startswith(root + "\x1f") and "array" in k and ({"object", "null"} & kinds.get(p + "\x1f[]", set())):
                rel = p[len(root) + 1 :].split("\x1f")
                if rel[0] not in wrappers and rel[0] != "[]":
                    arrays.add(tuple(x for x in rel if x != "[]"))
    return Layout(tuple(wrappers), tuple(sorted(arrays)), {p.replace("\x1f", "."): tuple(sorted(k)) for p, k in kinds.items()}, tuple(sorted(names)))


def _array(v: Column) -> Column:
    """A VARIANT's elements as array<variant>, also if it is JSON text of an array; else null."""
    inside = F.try_variant_get(F.try_parse_json(F.try_variant_get(v, "$", "string")), "$", "array<variant>")
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), inside)


def _child(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$['{name}']" if "'" not in name else f'$["{name}"]', "variant")


def _there(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def json_records(payloads: DataFrame, key: str, column: str, layout: Layout) -> DataFrame:
    """(key, rec_pos, rec): each record of each payload. A root array holds records or wrapped records; a root object is a wrapper if it has a
    wrapper key of the layout that is not null, else it is the record itself at position 0. Null records give no row."""
    v = F.col("__v")
    options = [F.try_variant_get(v, "$", "array<variant>")]
    for w in layout.wrappers:
        inner = _child(v, w)
        options += [F.when(_there(inner), _array(inner)), F.when(_there(inner), F.array(inner))]
    body = F.coalesce(*options, F.array(v))
    table = payloads.select(key, parsed(F.col(column).cast("string")).alias("__v"))
    table = table.select(key, F.posexplode(body).alias("rec_pos", "rec")).where(_there(F.col("rec")))
    rec = F.col("rec")
    # what has a field of a record is one; only what is neither that nor a wrapper may be JSON text
    plain = F.when(F.greatest(*[_child(rec, n).isNotNull() for n in layout.fields]), rec) if layout.fields else F.lit(None).cast("variant")
    unwrapped = F.coalesce(*[F.when(_there(_child(rec, w)), _child(rec, w)) for w in layout.wrappers], plain, F.try_parse_json(F.try_variant_get(rec, "$", "string")), rec)
    return table.select(key, "rec_pos", unwrapped.alias("rec"))


def json_children(parents: DataFrame, links: list[str], element: str, name: str, pos: str, child: str) -> DataFrame:
    """(links, pos, child): the elements of each parent's array `name`; null elements keep their position and give no row."""
    table = parents.select(*links, F.posexplode(_array(_child(F.col(element), name))).alias(pos, child))
    return table.where(_there(F.col(child)))


def flatten_json(payloads: DataFrame, key: str, column: str, record_fields: Iterable[str], layout: Layout | None = None) -> dict[str, DataFrame]:
    """The linked tables of a JSON text column: {"record": (key, rec_pos, rec), "lines": (key, rec_pos, line_pos, value), ...}, one
    per array path of the layout, which is inferred from all payloads if not given. Values stay VARIANT; see `page_word_fields`
    and its kin for typed columns.

    Defined cases: payloads that are null, empty, blank or no JSON give no rows; JSON null gives none; unknown fields stay inside the value;
    arrays sent as JSON text count as arrays; other columns of payloads are ignored; repeated keys give repeated rows.
    A payload in which an object repeats a key is read as no JSON unless spark.sql.variant.allowDuplicateKeys is set.
    """
    layout = layout or infer_layout(payloads, column, record_fields)
    out = {"record": json_records(payloads, key, column, layout)}

    def build(path: tuple[str, ...]) -> tuple[DataFrame, list[str], str]:
        if not path:
            return out["record"], [key, "rec_pos"], "rec"
        parent_path = next((path[:n] for n in range(len(path) - 1, 0, -1) if path[:n] in layout.arrays), ())
        parent, links, element = build(parent_path)
        rest = path[len(parent_path) :]
        for step in rest[:-1]:
            parent, element = parent.select(*links, _child(F.col(element), step).alias("__in")), "__in"
        pos = f"{rest[-1].rstrip('s')}_pos"
        table = json_children(parent, links, element, rest[-1], pos, "value")
        return table, [*links, pos], "value"

    for path in layout.arrays:
        out[".".join(path)] = build(path)[0]
    return out


def json_leaves(payloads: DataFrame, key: str, column: str, layout: Layout) -> DataFrame:
    """(key, rec_pos, path, at): the innermost elements of each record, as a path of layout.arrays (its place there) and one position per level.

    An element is innermost if no array below it holds a non-null element; null elements keep their position and give no row. The levels are walked down inside each record's row,
    as positions only: a whole record is one row until the end, nothing of its content is copied, nothing is shuffled.
    """
    paths = layout.arrays
    parent = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in paths), ()) for p in paths}

    def below(v: Column, path: tuple[str, ...]) -> Column | None:
        """array<struct<path, at>> of what is innermost below an element of a path (of the record for the empty one); null if no array can be there."""
        parts = [elements(v, child, child[len(path) :]) for child in paths if parent[child] == path]
        return F.concat(*parts) if parts else None

    def elements(v: Column, path: tuple[str, ...], steps: tuple[str, ...]) -> Column:
        for step in steps:
            v = _child(v, step)
        here = F.lit(paths.index(path)).alias("path")

        def one(e: Column, i: Column) -> Column:
            itself = F.array(F.struct(here, F.array(i).alias("at")))
            inner = below(e, path)
            if inner is None:
                return F.when(_there(e), itself)
            return F.when(_there(e), let(inner, lambda x: F.when(F.size(x) > 0, F.transform(x, lambda k: F.struct(k["path"].alias("path"), F.concat(F.array(i), k["at"]).alias("at")))).otherwise(itself)))

        return F.coalesce(F.flatten(F.filter(F.transform(_array(v), one), lambda x: x.isNotNull())), F.array().cast("array<struct<path:int,at:array<int>>>"))

    records = json_records(payloads, key, column, layout)
    inner = below(F.col("rec"), ())
    if inner is None:
        return records.select(key, "rec_pos", F.lit(0).alias("path"), F.array().cast("array<int>").alias("at")).limit(0)
    return records.select(key, "rec_pos", F.explode(inner).alias("leaf")).select(key, "rec_pos", "leaf.path", "leaf.at")


def page_word_fields(value: Column) -> list[Column]:
    """text, x1, y1, x2, y2, confidence of a word or line VARIANT; boxes come as arrays or objects, numbers also as text."""
    box = [
        F.coalesce(F.try_variant_get(value, f"$.bbox[{i}]", "int"), F.try_variant_get(value, f"$.bbox.{n}", "int")).alias(n)
        for i, n in enumerate(("x1", "y1", "x2", "y2"))
    ]
    return [F.try_variant_get(value, "$.text", "string").alias("text"), *box, F.try_variant_get(value, "$.confidence", "double").alias("confidence")]


#: Names of which an object needs one to be a page record.
PAGE_FIELDS = ("book_id", "page_num", "lines", "words")

#: The arrays that page records have, also where no payload shows them.
PAGE_ARRAYS = (("lines",), ("lines", "words"), ("words",))


def _with_page_arrays(layout: Layout) -> Layout:
    return replace(layout, arrays=tuple(sorted({*layout.arrays, *PAGE_ARRAYS})))


def page_tables(payloads: DataFrame, key: str = "raw_id", column: str = "payload", layout: Layout | None = None) -> dict[str, DataFrame]:
    """Typed records, lines, words of lines and own words of a column of page payloads, linked by position.

    records(key, rec_pos, book_id, page_num, ...), lines(key, rec_pos, line_pos, line_id, text, box), words(key, rec_pos, line_pos, word_pos, text,
    box, confidence), where a record's own words have line_pos -1.
    """
    layout = _with_page_arrays(layout or infer_layout(payloads, column, PAGE_FIELDS))
    tables = flatten_json(payloads, key, column, PAGE_FIELDS, layout)
    records, lines, rec = tables["record"], tables["lines"], F.col("rec")
    own = tables["words"].select(key, "rec_pos", F.lit(-1).alias("line_pos"), "word_pos", "value")
    get = lambda name, kind: F.try_variant_get(rec, f"$.{name}", kind).alias(name)
    return {
        "records": records.select(
            key,
            "rec_pos",
            *(get(n, "string") for n in ("run_id", "book_id", "scan_relpath", "ocr_engine")),
            get("page_num", "int"),
            get("printed_page", "int"),
            get("printed_page_text", "string"),
            get("printed_page_kind", "string"),
        ),
        "lines": lines.select(key, "rec_pos", "line_pos", F.try_variant_get(F.col("value"), "$.line_id", "string").alias("line_id"), *page_word_fields(F.col("value"))[:5]),
        "words": tables["lines.words"].unionByName(own).select(key, "rec_pos", "line_pos", "word_pos", *page_word_fields(F.col("value"))),
    }


def page_positions(payloads: DataFrame, key: str = "raw_id", column: str = "payload", layout: Layout | None = None) -> DataFrame:
    """(key, rec_pos, line_pos, word_pos): the places of all words, of all lines without words (word_pos -1), and of the records' own words (line_pos -1).

    These are the innermost elements of the page arrays; arrays of unknown fields are not gone into.
    """
    layout = _with_page_arrays(layout or infer_layout(payloads, column, PAGE_FIELDS))
    layout = replace(layout, arrays=tuple(p for p in layout.arrays if p in PAGE_ARRAYS))
    own = F.col("path") == layout.arrays.index(("words",))
    at = lambda i: F.coalesce(F.get("at", F.lit(i)), F.lit(-1))
    leaves = json_leaves(payloads, key, column, layout)
    return leaves.select(key, "rec_pos", F.when(own, -1).otherwise(at(0)).alias("line_pos"), F.when(own, at(0)).otherwise(at(1)).alias("word_pos"))
