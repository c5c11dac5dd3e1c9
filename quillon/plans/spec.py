"""Specifications of steps, compiled to predicates.

A spec names leaves with shape, type and range. Types and missing fields are checked against
the schema, before a row is read; shapes and ranges become one predicate for each leaf and
check. A null, a wrong size and NaN are violations, never errors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Leaf:
    """``low`` and ``high``: numbers for all elements, or one for each."""

    kind: str  # uint8, float32, bool, str
    shape: tuple[int, ...] = ()
    low: float | tuple[float, ...] | None = None
    high: float | tuple[float, ...] | None = None


Spec = dict  # of names to leaves or further specs

_TWO_PI = 2 * math.pi
#: The target format. Bounds are doubles, also for float fields.
TARGET: Spec = {
    "observation": {"image": Leaf("uint8", (128, 128, 3), 0, 255)},
    "action": Leaf("float32", (8,), (-1, -1, -1, -_TWO_PI, -_TWO_PI, -_TWO_PI, -1, 0), (1, 1, 1, _TWO_PI, _TWO_PI, _TWO_PI, 1, 1)),
    "discount": Leaf("float32", (), 0, 1),
    "reward": Leaf("float32", (), 0, 1),
    "is_first": Leaf("bool"),
    "is_last": Leaf("bool"),
    "is_terminal": Leaf("bool"),
    "language_instruction": Leaf("str"),
    "language_embedding": Leaf("float32", (512,)),
}

_SCALAR = {"float32": T.FloatType, "bool": T.BooleanType, "str": T.StringType, "uint8": T.BinaryType}


def leaves(spec: Spec, prefix: str = "") -> list[tuple[str, Leaf]]:
    out: list[tuple[str, Leaf]] = []
    for name, x in spec.items():
        out += leaves(x, f"{prefix}{name}.") if isinstance(x, dict) else [(prefix + name, x)]
    return out


def _type_of(schema: T.StructType, path: str) -> T.DataType | None:
    kind: T.DataType = schema
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return None
        kind = kind[name].dataType
    return kind


def schema_violations(schema: T.StructType, spec: Spec) -> list[tuple[str, str, str, str]]:
    """(field, check, expected, actual) of what the schema alone shows. Fields that the spec
    does not name are of no interest."""
    out = []
    for path, leaf in leaves(spec):
        have = _type_of(schema, path)
        if have is None:
            out.append((path, "missing", leaf.kind, "absent"))
            continue
        vector = leaf.shape and leaf.kind != "uint8"
        inner = have.elementType if vector and isinstance(have, T.ArrayType) else have
        if bool(vector) != isinstance(have, T.ArrayType) or not isinstance(inner, _SCALAR[leaf.kind]):
            out.append((path, "dtype", f"array<{leaf.kind}>" if vector else leaf.kind, have.simpleString()))
    return out


@dataclass(frozen=True)
class Check:
    field: str
    name: str
    expected: str
    ok: Column  # never null
    actual: Column


def checks(spec: Spec, strict: bool = False) -> list[Check]:
    """In order of fields, then shape before range. ``strict``: scalars must not be null
    where the spec gives no range either."""
    out: list[Check] = []
    sure = lambda c: F.coalesce(c, F.lit(False))
    for path, leaf in leaves(spec):
        c = F.col(path)
        if leaf.shape:
            n = math.prod(leaf.shape)
            have = F.length(c) if leaf.kind == "uint8" else F.size(c)
            out.append(Check(path, "shape", str(n), sure(c.isNotNull() & (have == n)), have.cast("string")))
        elif strict and leaf.low is None:
            out.append(Check(path, "shape", "scalar", c.isNotNull(), c.cast("string")))
        if leaf.low is None or leaf.kind == "uint8":  # a byte is always within 0 to 255
            continue
        if not leaf.shape:
            out.append(Check(path, "range", f"[{leaf.low}, {leaf.high}]", sure(_within(c, leaf.low, leaf.high)), c.cast("string")))
        elif isinstance(leaf.low, tuple):
            for i, (low, high) in enumerate(zip(leaf.low, leaf.high, strict=True)):
                x = F.get(c, i)
                out.append(Check(f"{path}[{i}]", "range", f"[{low}, {high}]", sure(_within(x, low, high)), x.cast("string")))
        else:
            every = F.forall(c, _inside(leaf))
            out.append(Check(path, "range", f"[{leaf.low}, {leaf.high}]", sure(every), F.concat(F.array_min(c).cast("string"), F.lit(".."), F.array_max(c).cast("string"))))
    return out


def _inside(leaf: Leaf):
    return lambda x: F.coalesce(_within(x, leaf.low, leaf.high), F.lit(False))


def _within(x: Column, low: float, high: float) -> Column:
    d = x.cast("double")
    return (d >= F.lit(float(low))) & (d <= F.lit(float(high)))


def violations(df: DataFrame, spec: Spec, keys: list[str], strict: bool = False) -> DataFrame:
    """A row for each violation: keys, field, check, expected, actual. One pass, no
    shuffle."""
    static = schema_violations(df.schema, spec)
    if static:
        raise TypeError(f"the schema does not fit: {static}")
    bad = [F.when(~c.ok, F.struct(F.lit(i).alias("place"), F.lit(c.field).alias("field"), F.lit(c.name).alias("check"), F.lit(c.expected).alias("expected"), c.actual.alias("actual"))) for i, c in enumerate(checks(spec, strict))]
    found = df.select(*keys, F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("v"))
    return found.select(*keys, "v.place", "v.field", "v.check", "v.expected", "v.actual")


def report(df: DataFrame, spec: Spec, strict: bool = False) -> DataFrame:
    """field, check, n_bad, n_good of every check, in a single aggregation."""
    static = schema_violations(df.schema, spec)
    if static:
        raise TypeError(f"the schema does not fit: {static}")
    all_checks = checks(spec, strict)
    counted = df.agg(F.count("*").alias("n"), *[F.count_if(~c.ok).alias(f"c{i}") for i, c in enumerate(all_checks)])
    rows = F.array(*[F.struct(F.lit(c.field).alias("field"), F.lit(c.name).alias("check"), F.col(f"c{i}").alias("n_bad"), (F.col("n") - F.col(f"c{i}")).alias("n_good")) for i, c in enumerate(all_checks)])
    return counted.select(F.inline(rows))


def verdict(df: DataFrame, spec: Spec, strict: bool = False) -> DataFrame:
    """One row: passed, n_rows, n_bad_rows."""
    good = F.lit(True)
    for c in checks(spec, strict):
        good = good & c.ok
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~good).alias("n_bad_rows")).select((F.col("n_bad_rows") == 0).alias("passed"), "n_rows", "n_bad_rows")


def observed(df: DataFrame, spec: Spec, strict: bool = False) -> tuple[DataFrame, Observation]:
    """``df``, and the verdict's counts (``n_rows``, ``n_bad_rows``) of the rows that pass, taken
    in the pass that the first action makes."""
    static = schema_violations(df.schema, spec)
    if static:
        raise TypeError(f"the schema does not fit: {static}")
    good, seen = F.lit(True), Observation()
    for c in checks(spec, strict):
        good = good & c.ok
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(~good).alias("n_bad_rows")), seen


def first_violation(df: DataFrame, spec: Spec, keys: list[str], strict: bool = False) -> DataFrame:
    """The violation that ``require`` names: the first in order of keys, field and check."""
    return violations(df, spec, keys, strict).orderBy(*keys, "place").limit(1)


def schema_report(df: DataFrame, spec: Spec) -> DataFrame:
    """What the schema alone shows, as rows: field, check, expected, actual."""
    return df.sparkSession.createDataFrame(schema_violations(df.schema, spec), "field string, check string, expected string, actual string")


def require(df: DataFrame, spec: Spec, keys: list[str], strict: bool = False) -> DataFrame:
    """``df``, or an error with the first violation in order of keys, field and check."""
    first = first_violation(df, spec, keys, strict).collect()
    if first:
        r = first[0]
        raise ValueError(f"{[r[k] for k in keys]}: {r['field']} fails its {r['check']} check: expected {r['expected']}, found {r['actual']}")
    return df
