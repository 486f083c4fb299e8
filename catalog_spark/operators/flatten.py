"""JSON documents to flat columns."""

from __future__ import annotations

import json
import logging
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

log = logging.getLogger(__name__)

SEPARATOR = "-"
# JSON texts that count as not filled.
EMPTY_JSON = r'^(""|null|false|\{\}|\[\]|-?0(\.0*)?([eE][+-]?\d+)?)$'


def column_name(path: tuple[str, ...]) -> str:
    """Joined path; dots become dashes and whitespace becomes one underscore."""
    return re.sub(r"\s+", "_", SEPARATOR.join(path).replace(".", "-"))


def json_path(path: tuple[str, ...]) -> str:
    return "$" + "".join(f'["{part}"]' if "'" in part else f"['{part}']" for part in path)


@dataclass(frozen=True)
class Leaf:
    """A value position found in the documents.

    ``mixed`` marks a position that holds an object in some documents and a plain
    value in others: it gives a column of its own beside those of the object.
    """

    path: tuple[str, ...]
    type: T.DataType
    mixed: bool = False


def _leaf_type(t: T.DataType) -> T.DataType:
    if isinstance(t, (T.LongType, T.BooleanType, T.DoubleType)):
        return t
    if isinstance(t, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    return T.StringType()


def _parse_schema(text: str) -> T.DataType:
    """Type from ``schema_of_variant_agg`` output, whose objects read OBJECT<...>."""
    quoted = re.split(r"(`(?:[^`]|``)*`)", text)
    ddl = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in quoted)
    return T.DataType.fromDDL(ddl)


def discover_leaves(docs: DataFrame, column: str, keep: list[str] | None = None, max_columns: int | None = None) -> list[Leaf]:
    """Union of the value positions over all documents, in path order.

    ``docs[column]`` is a VARIANT.  One aggregation finds the common schema; a
    position with conflicting kinds needs one more for the objects below it.
    Only the schema reaches the driver.  ``keep`` limits the result to columns
    with these names, ``max_columns`` guards against data used as keys.
    """
    return _discover(docs, column, keep, max_columns)[0]


def _discover(docs: DataFrame, column: str, keep: list[str] | None = None, max_columns: int | None = None) -> tuple[list[Leaf], int]:
    """The leaves, and the number of rows without a document."""
    leaves: dict[tuple[str, ...], Leaf] = {}
    pending: list[tuple[str, ...]] = []
    conflicts: list[tuple[str, ...]] = []

    def walk(path: tuple[str, ...], t: T.DataType) -> None:
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk((*path, f.name), f.dataType)
        elif isinstance(t, T.VariantType) and path not in pending:
            conflicts.append(path)
        elif path:
            leaves[path] = Leaf(path, _leaf_type(t))

    schema, missing = docs.agg(F.schema_of_variant_agg(column), F.count_if(F.col(column).isNull())).first()
    whole = _parse_schema(schema)
    walk((), whole)
    if not isinstance(whole, (T.StructType, T.NullType)):
        conflicts = [()]
    while conflicts:
        pending, conflicts = conflicts, []
        exprs = []
        for i, path in enumerate(pending):
            v = F.variant_get(column, json_path(path), "variant") if path else F.col(column)
            is_object = F.schema_of_variant(v).startswith("OBJECT")
            exprs += [
                F.schema_of_variant_agg(F.when(is_object, v)).alias(f"o{i}"),
                F.schema_of_variant_agg(F.when(~is_object, v)).alias(f"p{i}"),
            ]
        found = docs.agg(*exprs).first()
        for i, path in enumerate(pending):
            below, plain = _parse_schema(found[f"o{i}"]), _parse_schema(found[f"p{i}"])
            is_struct = isinstance(below, T.StructType)
            if is_struct:
                walk(path, below)
            if not isinstance(plain, T.NullType) or not is_struct:
                if path:
                    leaves[path] = Leaf(path, T.StringType() if is_struct else _leaf_type(plain), mixed=is_struct)
                elif not isinstance(plain, T.NullType):
                    leaves[()] = Leaf((), _leaf_type(plain), mixed=True)
    result = [leaves[p] for p in sorted(leaves)]
    if keep is not None:
        result = [leaf for leaf in result if column_name(leaf.path) in set(keep)]
    if max_columns is not None and len(result) > max_columns:
        raise ValueError(f"{len(result)} columns found, more than {max_columns}; pass the wanted ones in keep")
    return result, missing


def _nested_schema(leaves: list[Leaf]) -> T.StructType:
    tree: dict = {}
    for leaf in leaves:
        if leaf.mixed or not leaf.path:
            continue
        node = tree
        for part in leaf.path[:-1]:
            node = node.setdefault(part, {})
        node[leaf.path[-1]] = leaf.type

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, build(v) if isinstance(v, dict) else v) for k, v in node.items()]
        )

    return build(tree)


def _merge_names(pairs: list[tuple[str, Column]], case_sensitive: bool) -> list[Column]:
    """Columns by name; of several paths with one name the later non-null value wins."""
    by_name: dict[str, list[Column]] = {}
    for name, value in pairs:
        by_name.setdefault(name, []).append(value)
    names = by_name if case_sensitive else _told_apart(list(by_name))
    return [F.coalesce(*reversed(v)).alias(n) if len(v) > 1 else v[0].alias(n) for n, v in zip(names, by_name.values())]


def _told_apart(names: list[str]) -> list[str]:
    """Names that differ in more than case: the second of ``Ab`` and ``ab`` becomes ``ab__2``."""
    taken: set[str] = set()
    out = []
    for name in names:
        new, n = name, 1
        while new.lower() in taken:
            n += 1
            new = f"{name}__{n}"
        taken.add(new.lower())
        out.append(new)
    return out


def _place_in_text(text: str, path: tuple[str, ...]) -> Column:
    """Where a path stands in a document: the place of each of its keys among its neighbours, as comparable numbers."""
    objects = [F.col(text) if not i else F.get_json_object(text, json_path(path[:i])) for i in range(len(path))]
    return F.array(*[F.coalesce(F.array_position(F.json_object_keys(o), part), F.lit(0)) for o, part in zip(objects, path)])


def _last_in_text(text: str, leaves: list[Leaf], values: list[Column]) -> Column:
    """The value of the path that a document names last, null too; a path with an object is none."""
    found = [F.variant_get("__v", json_path(leaf.path), "variant") for leaf in leaves]
    there = [f.isNotNull() & ~F.schema_of_variant(f).startswith("OBJECT") for f in found]
    places = [F.when(t, F.struct(_place_in_text(text, leaf.path).alias("at"), F.lit(i).alias("i"))) for i, (t, leaf) in enumerate(zip(there, leaves))]
    last = F.array_max(F.array_compact(F.array(*places)))["i"]
    if len({leaf.type for leaf in leaves}) > 1:
        values = [v.cast("string") for v in values]
    picked = F.when(last == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        picked = picked.when(last == i, value)
    return picked


def flatten_json(docs: DataFrame, text: str, keep_columns: list[str] | None = None, leaves: list[Leaf] | None = None, variant: str | None = None, **limits) -> DataFrame:
    """Flat table from a column of JSON text, unparsable rows left out.

    The schema comes from ``discover_leaves`` unless given; then each document is
    parsed once with exactly that schema.  ``docs`` is read once for each, so the caller
    should have written it.  ``variant`` names a column with what the texts parse to, null if unparsable.  Arrays stay minified JSON text with key
    order and nulls kept.  ``keep_columns`` are carried along unchanged.

    Of several paths that give one name, the one that a document names last wins, null
    too; different types of them become text.  Names that differ only in case are columns
    of their own, ``Ab`` and ``ab__2``, or ``ab`` where the session tells cases apart.
    """
    carried = list(keep_columns or [])
    parsed = F.col(variant) if variant else F.try_parse_json(text)
    variants, missing = docs.select(*carried, text, parsed.alias("__v")), 1
    if leaves is None:
        leaves, missing = _discover(variants, "__v", **limits)
    case_sensitive = docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    if not case_sensitive:  # fields of a struct are found without regard to case, paths of a variant are not
        spelt = defaultdict(set)
        for leaf in leaves:
            for i in range(1, len(leaf.path) + 1):
                spelt[tuple(x.lower() for x in leaf.path[:i])].add(leaf.path[:i])
        doubtful = {leaf.path for leaf in leaves if any(len(spelt[tuple(x.lower() for x in leaf.path[:i])]) > 1 for i in range(1, len(leaf.path) + 1))}
    else:
        doubtful = set()
    schema = _nested_schema([leaf for leaf in leaves if leaf.path not in doubtful])
    rows = variants.where("__v IS NOT NULL") if missing else variants  # which would parse every text once more
    if schema.fields:
        rows = rows.withColumn("__doc", F.from_json(text, schema))
    found: dict[str, list[tuple[Leaf, Column]]] = defaultdict(list)
    for leaf in leaves:
        if not leaf.path:
            kind = F.schema_of_variant("__v")
            whole = F.get_json_object(text, "$")
            found["list"].append((leaf, F.when(kind.startswith("ARRAY"), whole)))
            found["value"].append((leaf, F.when(~kind.startswith("ARRAY") & ~kind.startswith("OBJECT"), F.variant_get("__v", "$", "string"))))
        elif leaf.mixed or (leaf.path in doubtful and isinstance(leaf.type, T.StringType)):
            v = F.variant_get("__v", json_path(leaf.path), "variant")
            plain = ~F.schema_of_variant(v).startswith("OBJECT")
            written = F.get_json_object(text, json_path(leaf.path))
            if any("'" in part for part in leaf.path):  # which the other function's paths cannot name
                written = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.to_json(v)).otherwise(F.variant_get(v, "$", "string"))
            found[column_name(leaf.path)].append((leaf, F.when(plain, written)))
        elif leaf.path in doubtful:
            found[column_name(leaf.path)].append((leaf, F.variant_get("__v", json_path(leaf.path), leaf.type.simpleString())))
        else:
            value = F.col("__doc")
            for part in leaf.path:
                value = value.getField(part)
            found[column_name(leaf.path)].append((leaf, value))
    columns = []
    for name, same in zip(found if case_sensitive else _told_apart(list(found)), found.values()):
        if len(same) > 1 and all(leaf.path for leaf, _ in same):
            log.warning("column %s comes from %d paths; the last one in a document wins", name, len(same))
            columns.append(_last_in_text(text, [leaf for leaf, _ in same], [v for _, v in same]).alias(name))
        else:
            columns.append(F.coalesce(*[v for _, v in reversed(same)]).alias(name) if len(same) > 1 else same[0][1].alias(name))
    return rows.select(*carried, *columns)


def flatten_struct(df: DataFrame) -> DataFrame:
    """Flat table from nested columns of a known schema."""
    pairs: list[tuple[str, Column]] = []

    def walk(path: tuple[str, ...], value: Column, t: T.DataType) -> None:
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk((*path, f.name), value.getField(f.name), f.dataType)
        else:
            pairs.append((column_name(path), array_text(value) if isinstance(t, T.ArrayType) else value))

    for f in df.schema.fields:
        walk((f.name,), df[f"`{f.name}`"], f.dataType)
    return df.select(*_merge_names(pairs, df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"))


def array_text(value: Column) -> Column:
    """Minified JSON with nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def explode_path(docs: DataFrame, text: str, path: tuple[str, ...], element: str, keep_columns: list[str], alias: str = "item") -> DataFrame:
    """One row per element of the array at ``path``; none where the path is missing or no array."""
    array = F.from_json(F.get_json_object(text, json_path(path)), f"array<{element}>")
    return docs.select(*keep_columns, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def first_filled(v: Column, paths: list[tuple[str, ...]]) -> Column:
    """Trimmed text of the first path whose value is filled; '', 0, false and null are not."""

    def filled(path: tuple[str, ...]) -> Column:
        # The JSON form tells the string "0" from the number 0.
        written = F.to_json(F.variant_get(v, json_path(path), "variant"))
        return F.when(~written.rlike(EMPTY_JSON), F.variant_get(v, json_path(path), "string"))

    return F.trim(F.coalesce(*[filled(p) for p in paths], F.lit("")))


# A string of a JSON text and, if it is a key with a plain value, the value.
JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
JSON_PLAIN = rf"(?:{JSON_STRING}|-?[0-9][0-9.eE+-]*+|true|false)"
JSON_ENTRY = rf"{JSON_STRING}(?::{JSON_PLAIN})?"
# A number that the two ways to write a document out may spell differently.
DOUBTFUL_NUMBER = r"-?(?:[0-9]{19}|[0-9]*[.eE])"


def _written(text: Column, wanted: str, duplicates: bool) -> Column:
    """A document without blanks around its keys and with one spelling of each; null if it does not parse.

    Copying the text is far cheaper than writing out what it was parsed to.  It would keep both of two equal keys, so it is
    only done where such a document does not parse, and not where escapes or the number under the key may come out otherwise.
    """
    parsed = F.try_parse_json(text)
    if duplicates:
        return F.to_json(parsed)

    def checked(pair: Column) -> Column:
        v, copy = pair["v"], pair["copy"]
        doubtful = copy.isNull() | copy.rlike(re.escape(wanted) + DOUBTFUL_NUMBER)
        return F.when(v.isNull(), None).when(doubtful, F.to_json(v)).otherwise(copy)

    copy = F.when(~text.contains("\\u"), F.get_json_object(text, "$"))
    return F.transform(F.array(F.struct(parsed.alias("v"), copy.alias("copy"))), checked)[0]


def key_values(docs: DataFrame, text: str, key: str, keep_columns: list[str], alias: str = "value") -> DataFrame:
    """Every distinct string or integer found under ``key`` at any depth, per carried columns.

    A document that parses is written out again, so that keys have one spelling and no blanks around them, and read by a
    pattern for the key and the plain value behind it.  A key inside a string is part of that string, so it is not found.  Truth values count as ``True`` and ``False``.  Of equal keys in one object the last counts
    if the session allows them (``spark.sql.variant.allowDuplicateKeys``); otherwise such a document does not parse.
    """
    wanted = json.dumps(key, ensure_ascii=False) + ":"
    duplicates = docs.sparkSession.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    written = _written(F.trim(text), wanted, duplicates)
    if re.match(r"\w", key):  # a quote before a letter ends no string, unless it is escaped; what ends in a quote and a colon is a key
        values = F.regexp_extract_all(written, F.lit(rf"(?<!\\){re.escape(wanted)}({JSON_PLAIN})"), F.lit(1))
    else:
        entries = F.filter(F.regexp_extract_all(written, F.lit(JSON_ENTRY), F.lit(0)), lambda e: e.startswith(wanted))
        values = F.transform(entries, lambda e: F.substring(e, F.lit(len(wanted) + 1), F.length(e)))

    def plain(value: Column) -> Column:
        return (
            F.when(value.startswith('"'), F.when(value.contains("\\"), F.variant_get(F.try_parse_json(value), "$", "string")).otherwise(F.substring(value, F.lit(2), F.length(value) - 2)))
            .when(value.rlike("^-?[0-9]+$"), value)
            .when(value.isin("true", "false"), F.initcap(value))
        )

    # as values of one array, which no filter further up works out again
    found = F.when(F.col(text).contains(key) | F.col(text).contains("\\u"), F.array_distinct(F.transform(values, plain)))
    return docs.select(*keep_columns, F.explode_outer(found).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def add_fields(doc: Column, fields: dict[str, Column]) -> Column:
    """JSON object text with string fields put in front; a field the object already has stays as it is."""
    inner = lambda text: F.substring(text, F.lit(2), F.length(text) - 2)
    keys = F.json_object_keys(doc)
    own = inner(F.trim(doc))
    parts = [F.when(~F.array_contains(keys, name), inner(F.to_json(F.struct(value.cast("string").alias(name))))) for name, value in fields.items()]
    parts.append(own)
    written = F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (F.trim(p) != "")), ",")
    return F.concat(F.lit("{"), written, F.lit("}"))


def replace_fields(doc: Column, fields: dict[str, Column]) -> Column:
    """JSON object text with string fields added or, where present, replaced."""
    kept = F.map_filter(F.from_json(doc, "map<string,variant>"), lambda k, v: ~k.isin(*fields))
    pairs = [x for name, value in fields.items() for x in (F.lit(name), value.cast("string").cast("variant"))]
    return F.to_json(F.map_concat(kept, F.create_map(*pairs)), {"ignoreNullFields": "false"})


def union_of_keys(frames: list[DataFrame]) -> DataFrame:
    """All rows under all columns, absent values NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
