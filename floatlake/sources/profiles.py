"""Nested profiles: one row per profile, arrays for everything with more dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from floatlake.sources.csv import with_row_order


def read_profiles(
    spark: SparkSession, paths: str | list[str], format: str = "parquet",
    schema: T.StructType | str | None = None, with_files: bool = False, discover: bool = False,
) -> DataFrame:
    """Profiles from Parquet, ORC or JSON. JSON needs a schema, or ``discover``.

    With ``discover`` (JSON, one profile a line) the variables are those found in the files, see
    profiles_from_json.
    """
    if discover:
        if format != "json" or schema is not None:
            raise ValueError("variables are discovered in JSON without a schema")
        lines = with_row_order(spark.read.text(paths))
        place = [name for name in lines.columns if name != "value"]
        found = profiles_from_json(lines, "value", place)
        return found if with_files else found.drop(*place)
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    elif format == "json":
        raise ValueError("profiles in JSON need a schema")
    df = reader.load(paths)
    return with_row_order(df) if with_files else df


@dataclass(frozen=True)
class Variable:
    """What all files together say of a variable: how deep its arrays are, and what is in them."""

    depth: int
    base: str

    def joined(self, other: Variable) -> Variable:
        """Whole numbers give way to fractions, and anything to text."""
        kinds = {self.base, other.base} - {"void"}
        base = kinds.pop() if len(kinds) == 1 else "void" if not kinds else "double" if kinds == {"bigint", "double"} else "string"
        return Variable(max(self.depth, other.depth), base)


def _variable(dtype: T.DataType) -> Variable | None:
    """None for objects, which no role has a place for."""
    depth = 0
    while isinstance(dtype, T.ArrayType):
        depth, dtype = depth + 1, dtype.elementType
    if isinstance(dtype, (T.StructType, T.MapType)):
        return None
    if isinstance(dtype, T.NullType):
        return Variable(depth, "void")
    if isinstance(dtype, T.LongType):
        return Variable(depth, "bigint")
    if isinstance(dtype, T.NumericType):
        return Variable(depth, "double")
    return Variable(depth, "boolean" if isinstance(dtype, T.BooleanType) else "string")


def found_variables(forms: list[tuple[str, str]]) -> dict[str, Variable]:
    """Variables by name, from all `(name, type)` they occur in."""
    found: dict[str, Variable] = {}
    for name, kind in forms:
        own = _variable(T.DataType.fromDDL(kind.replace("OBJECT<", "STRUCT<")))
        if own is not None:
            found[name] = own.joined(found[name]) if name in found else own
    return found


def _value(parsed: Column, name: str, variable: Variable) -> Column:
    """A variable at its full depth; where a file has it less deep, each level is a list of one."""
    base = "string" if variable.base == "void" else variable.base
    path = f"$['{name}']"
    if "'" in name or "\\" in name or "]" in name:
        # No path can spell such a name.
        parsed, path = F.try_variant_get(parsed, "$", "map<string,variant>")[name], "$"
    own = F.try_variant_get(parsed, path, "variant")
    depth_here = F.char_length(F.regexp_extract(F.schema_of_variant(own), "^(?:ARRAY<)*", 0)) / len("ARRAY<")
    chosen = F.when(F.lit(False), None)
    for depth in range(variable.depth, -1, -1):
        value = F.try_variant_get(own, "$", "array<" * depth + base + ">" * depth)
        for _ in range(variable.depth - depth):
            value = F.when(value.isNotNull(), F.array(value))
        chosen = chosen.when(depth_here == depth, value)
    return chosen


def profiles_from_json(lines: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """One row per JSON object, with a column for every variable of any of them.

    Profiles may hold different variables, or one variable as a value, a list or a list of lists: the deepest
    form wins, and lists stand for less deep ones. Numbers are whole only if they are in all profiles; beside text
    everything is text. Objects inside a profile, and lines that are no object, are left out. The types come
    from one aggregation: a row for each form of each variable is collected, as few as there are kinds of
    files. ``keep`` are columns to keep beside the variables.
    """
    parsed = lines.withColumn("_object", F.try_parse_json(text)).where(F.schema_of_variant("_object").startswith("OBJECT"))
    each = parsed.select(F.explode(F.try_variant_get("_object", "$", "map<string,variant>")).alias("name", "value"))
    # How many digits a number has says nothing about its variable.
    kind = F.regexp_replace(F.schema_of_variant("value"), r"DECIMAL\([0-9, ]*\)", "DOUBLE")
    forms = each.select("name", kind.alias("kind")).distinct().collect()
    variables = found_variables(sorted((r["name"], r["kind"]) for r in forms))
    taken = {c.lower() for c in keep or []}
    return parsed.select(
        *(keep or []),
        *[_value(F.col("_object"), name, x).alias(name) for name, x in sorted(variables.items()) if name.lower() not in taken],
    )
