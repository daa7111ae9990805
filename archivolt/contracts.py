"""Dataset contracts: typed schemas, integrity, and the classification of changes between two versions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Logical types of a contract; numbers are decimal unless declared floating.
LOGICAL = {"string": T.StringType(), "integer": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(), "time": T.LongType(), "object": T.StringType(), "array": T.StringType()}
FLOATING = {"double", "float", "float4", "float8", "real"}


@dataclass(frozen=True)
class Field:
    """A column of a contract."""

    name: str
    logical: str
    required: bool = False
    physical: str | None = None
    precision: int | None = None
    scale: int | None = None
    max_length: int | None = None
    primary: bool = False
    references: tuple[str, str] | None = None

    def data_type(self) -> T.DataType:
        """The Spark type; a scale without a precision is refused."""
        if self.scale is not None and self.precision is None:
            raise ValueError(f"{self.name}: a scale needs a precision")
        if self.logical == "number":
            return T.DoubleType() if self.physical in FLOATING else T.DecimalType(self.precision or 38, self.scale if self.scale is not None else 9 if self.precision is None else 0)
        if self.logical not in LOGICAL:
            raise ValueError(f"{self.name}: unknown logical type {self.logical}")
        return LOGICAL[self.logical]


@dataclass(frozen=True)
class Contract:
    """A named, versioned set of fields with an optional partition column."""

    name: str
    fields: tuple[Field, ...]
    version: str = "1.0.0"
    partition: str | None = "bucket"
    bindings: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        """StructType; a partition column not declared is a nullable string at the end."""
        s = T.StructType([T.StructField(f.name, f.data_type(), not f.required) for f in self.fields])
        return s.add(T.StructField(self.partition, T.StringType(), True)) if self.partition and self.partition not in s.names else s

    def align(self, df: DataFrame) -> DataFrame:
        """df cast to the contract's columns; missing ones are null, others are left out."""
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema()])


CHANGES = ("identical", "additive", "breaking")


def field_change(old: Contract, new: Contract) -> str:
    """identical, additive (optional fields only) or breaking."""
    a, b = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    if any(n not in b or (b[n].data_type(), b[n].required, b[n].primary) != (a[n].data_type(), a[n].required, a[n].primary) for n in a):
        return "breaking"
    added = [b[n] for n in b if n not in a]
    return "breaking" if any(f.required for f in added) else "additive" if added else "identical"


def version_allowed(old: str, new: str, change: str) -> bool:
    """Breaking needs a new major, additive a new minor or major, identical no older version."""
    o, n = (tuple(map(int, v.split("."))) for v in (old, new))
    return {"breaking": n[0] > o[0], "additive": n[:2] > o[:2], "identical": n >= o}[change]


def integrity(contracts: list[Contract]) -> list[str]:
    """Problems of a registry: duplicate names, no primary key, references without a target."""
    names = [c.name for c in contracts]
    fields = {(c.name, f.name) for c in contracts for f in c.fields}
    out = [f"{n}: duplicate contract" for n in sorted({n for n in names if names.count(n) > 1})]
    for c in contracts:
        if not any(f.primary for f in c.fields):
            out.append(f"{c.name}: no primary key")
        out += [f"{c.name}.{f.name}: no such target {'.'.join(f.references)}" for f in c.fields if f.references and f.references not in fields]
    return out


def select_allowed(df: DataFrame, columns: list[str], allowed: set[str]) -> DataFrame:
    """Only whitelisted columns; any other name is refused."""
    bad = [c for c in columns if c not in allowed or c not in df.columns]
    if bad:
        raise ValueError(f"columns not allowed: {bad}")
    return df.select(*columns)


def strip(column: str | Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"), r"(?U)^\s+|\s+$", "")


#: Classes of change, mildest first: of several the worst holds.
SEVERITY = ("identical", "additive", "semantic", "breaking")


def projection_change(old: dict, new: dict) -> str:
    """Change of a projection {columns, filter, keys}: more columns are additive, another filter semantic, fewer or other keys breaking."""
    if set(old["columns"]) - set(new["columns"]) or old.get("keys") != new.get("keys"):
        return "breaking"
    if old.get("filter") != new.get("filter"):
        return "semantic"
    return "additive" if set(new["columns"]) - set(old["columns"]) else "identical"


def semantic_change(old: Contract, new: Contract) -> str:
    """Change of meaning with the same fields: another binding is semantic."""
    return "identical" if old.bindings == new.bindings else "semantic"


def merged_change(*changes: str) -> str:
    """The worst of several classes of change."""
    return max(changes, key=SEVERITY.index)


def registry_problems(contracts: list[Contract], api_versions: dict[str, str], supported: tuple[str, ...] = ("v3.0.0", "v3.1.0")) -> list[str]:
    """integrity() and: bindings that two contracts share, API versions not supported, versions that are no three numbers."""
    out = integrity(contracts)
    seen: dict[str, str] = {}
    for c in contracts:
        for target in c.bindings.values():
            if target in seen and seen[target] != c.name:
                out.append(f"{c.name}: {target} is bound by {seen[target]}")
            seen.setdefault(target, c.name)
        if api_versions.get(c.name) not in supported:
            out.append(f"{c.name}: API version {api_versions.get(c.name)} is not supported")
        if len(c.version.split(".")) != 3 or not all(x.isdigit() for x in c.version.split(".")):
            out.append(f"{c.name}: {c.version} is no version")
    return out


_WIDENS = {("int", "bigint"), ("int", "float"), ("int", "double"), ("bigint", "float"), ("bigint", "double"), ("float", "double"), ("string", "binary"), ("binary", "string")}


def reader_problems(writer: T.StructType, reader: T.StructType) -> list[str]:
    """Why a reader's schema can't read a writer's rows: types that don't widen, nulls it refuses, columns it misses without default."""
    w = {f.name: f for f in writer}
    out = []
    for f in reader:
        if f.name not in w:
            if not f.nullable and "default" not in (f.metadata or {}):
                out.append(f"{f.name}: missing without a default")
            continue
        a, b = w[f.name].dataType, f.dataType
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            out += [f"{f.name}.{x}" for x in reader_problems(a, b)]
        elif isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
            if a.scale != b.scale or a.precision > b.precision:
                out.append(f"{f.name}: {a.simpleString()} doesn't fit {b.simpleString()}")
        elif a != b and (a.simpleString(), b.simpleString()) not in _WIDENS:
            out.append(f"{f.name}: {a.simpleString()} can't be read as {b.simpleString()}")
        if w[f.name].nullable and not f.nullable:
            out.append(f"{f.name}: nulls are refused")
    return out
