"""Schemas of a table over the positions of its log: which holds when, what was added, what does not fit.

A history is short: one entry for each change of a schema. Rows are parsed once, with the widest schema, and written with the
columns that their position had, so an added column is in a value from its position on and not before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.envelope import WIRE, row_type

# Types whose values each of the later ones in a row can hold.
_WIDER = (
    ("tinyint", "smallint", "int", "bigint"),
    ("float", "double"),
    ("date", "timestamp_ntz"),
)


def _widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds the values of both; None where there is none without a loss."""
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return old
    for row in _WIDER:
        if a in row and b in row:
            return old if row.index(a) > row.index(b) else new
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


@dataclass(frozen=True)
class SchemaHistory:
    """Schemas by the position from which on they hold, in the order of positions. The first one holds from the start."""

    versions: tuple[tuple[int, T.StructType], ...]

    @staticmethod
    def of(*versions: tuple[int, T.StructType | str]) -> SchemaHistory:
        ordered = sorted(((pos, row_type(row)) for pos, row in versions), key=lambda v: v[0])
        if not ordered or len({pos for pos, _ in ordered}) < len(ordered):
            raise ValueError("a history needs a schema, and one for each position")
        return SchemaHistory(tuple(ordered))

    def _merged(self) -> tuple[T.StructType, list[tuple[int, str, str, str]]]:
        """The widest schema, and (pos, field, type before, type from then on) of what does not fit."""
        types: dict[str, T.DataType] = {}
        faults = []
        for pos, schema in self.versions:
            for f in schema.fields:
                wider = _widened(types[f.name], f.dataType) if f.name in types else f.dataType
                if wider is None:
                    faults.append((pos, f.name, types[f.name].simpleString(), f.dataType.simpleString()))
                else:
                    types[f.name] = wider
        return T.StructType([T.StructField(n, t) for n, t in types.items()]), faults

    @property
    def widest(self) -> T.StructType:
        """Every column that a version has, in the order of their appearance; a column that changed its type without fitting keeps the old."""
        return self._merged()[0]

    def incompatible(self, spark: SparkSession) -> DataFrame:
        """Changes of a type that lose values: ``pos, field, was, became``."""
        return spark.createDataFrame(self._merged()[1], "pos BIGINT, field STRING, was STRING, became STRING")

    def number(self, pos: Column) -> Column:
        """The number of the version that holds at a position, from 0."""
        later = [F.when(pos >= start, F.lit(1)).otherwise(F.lit(0)) for start, _ in self.versions[1:]]
        return sum(later, F.lit(0))

    def text(self, row: Column, pos: Column, **more: Column) -> Column:
        """``row``, a struct of the widest schema, as JSON with the columns of the version at ``pos``, and ``more``."""
        extra = [column.alias(name) for name, column in more.items()]
        out = None
        for start, schema in self.versions:
            own = F.to_json(F.struct(*[row[f.name].alias(f.name) for f in schema.fields], *extra), WIRE)
            out = own if out is None else F.when(pos >= start, own).otherwise(out)
        return out


def observed_fields(df: DataFrame, group: str, pos: str, value: str = "value", within: str = "$") -> DataFrame:
    """What JSON texts hold: ``<group>, field, kind, first_pos, last_pos, records``; ``within`` is the path of the object.

    ``kind`` is the type of a value, ``VOID`` for a null. Each task sends one row for each group, field and kind, whatever it holds.
    A field whose kinds change is found by its positions; texts that are no objects have no fields.
    """
    held = df.select(F.col(group), F.col(pos).alias("_pos"), F.try_variant_get(F.try_parse_json(F.col(value)), within, "variant").alias("_v"))
    objects = held.where(F.schema_of_variant("_v").startswith("OBJECT"))
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    kind = F.schema_of_variant("value")
    # Objects and arrays are one kind each, whatever is in them.
    kind = F.regexp_replace(kind, "<.*", "")
    return fields.groupBy(group, F.col("key").alias("field"), kind.alias("kind")).agg(
        F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"), F.count("*").alias("records")
    )
