"""What has changed in a source table against its declared columns, found before a load is written."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

from storelens.sources.schemas import PARTITIONS, SourceTable

# whole numbers by size, with the decimal digits that hold them all and those they all hold
WHOLE = {T.ByteType(): (3, 2), T.ShortType(): (5, 4), T.IntegerType(): (10, 9), T.LongType(): (19, 18)}
ORDER = list(WHOLE)
PRINTABLE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.CharType, T.VarcharType)


class SchemaDrift(Exception):
    """A source table has lost a declared column, or has one whose values may not fit any more."""


def lossless(found: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of one type has its own value in the other."""
    if found == declared or isinstance(found, T.NullType):
        return True
    if isinstance(declared, T.StringType):
        return isinstance(found, PRINTABLE)
    if found in WHOLE and declared in WHOLE:
        return ORDER.index(found) <= ORDER.index(declared)
    if isinstance(declared, T.DecimalType):
        room = declared.precision - declared.scale
        if found in WHOLE:
            return WHOLE[found][0] <= room
        if isinstance(found, T.DecimalType):
            return found.scale <= declared.scale and found.precision - found.scale <= room
    if isinstance(found, T.DecimalType) and declared in WHOLE:
        return found.scale == 0 and found.precision <= WHOLE[declared][1]
    return (type(found), type(declared)) in ((T.FloatType, T.DoubleType), (T.DateType, T.TimestampType))


@dataclass(frozen=True)
class Drift:
    """Columns that are new, lost, widened without harm (found, declared), or narrowed."""

    added: dict[str, str] = field(default_factory=dict)
    lost: tuple[str, ...] = ()
    retyped: dict[str, tuple[str, str]] = field(default_factory=dict)
    narrowed: dict[str, tuple[str, str]] = field(default_factory=dict)

    def require_sound(self, table: SourceTable) -> None:
        faults = [f"{name} is gone" for name in self.lost]
        faults += [f"{name} is {found}, {declared} is declared" for name, (found, declared) in self.narrowed.items()]
        if faults:
            raise SchemaDrift(f"{table.schema}.{table.name}: {'; '.join(faults)}")

    def note(self) -> str | None:
        """For the manifest: what a sound load differs in, null if it does not."""
        changes = {"added": self.added, "retyped": self.retyped}
        return json.dumps(changes, sort_keys=True) if any(changes.values()) else None


def compare(table: SourceTable, found: T.StructType) -> Drift:
    """Names are compared as Spark does, whatever their case. The raw layer's own partition columns
    do not count as columns of the source."""
    declared = {f.name.lower(): f for f in T._parse_datatype_string(table.ddl)}
    columns = {f.name.lower(): f for f in found if f.name.lower() not in PARTITIONS}
    differing = {
        name: (columns[name].dataType.simpleString(), f.dataType.simpleString())
        for name, f in declared.items()
        if name in columns and columns[name].dataType != f.dataType
    }
    fits = {name: lossless(columns[name].dataType, declared[name].dataType) for name in differing}
    return Drift(
        added={f.name: f.dataType.simpleString() for name, f in columns.items() if name not in declared},
        lost=tuple(name for name in declared if name not in columns),
        retyped={name: kinds for name, kinds in differing.items() if fits[name]},
        narrowed={name: kinds for name, kinds in differing.items() if not fits[name]},
    )
