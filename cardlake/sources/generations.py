"""Files of several schema generations, read under one declared schema or refused by name.

A generation is a folder whose files were written under one schema.  Its
columns may be narrower than the declared ones where every value keeps its
meaning (``widens``), and columns that it lacks are null; anything else is
refused before a row is read, naming folder, column and types.  Each folder
is scanned with its own types and widened in the plan, so filters on
columns of the declared type still reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}     # decimal digits of a whole number
EXACT_IN = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}


def widens(found: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``found`` is a value of ``declared``.

    Whole numbers to longer ones, to floats that hold them exactly and to
    decimals with enough digits; float to double; decimals with no fewer
    digits on either side of the point; any type to itself; a column that only
    ever was null to any.  Structs, arrays and maps part by part.
    """
    f, d = type(found), type(declared)
    if found == declared or f is T.NullType:
        return True
    if f in DIGITS and d in DIGITS:
        return DIGITS[f] <= DIGITS[d]
    if d in EXACT_IN:
        return f in EXACT_IN[d]
    if d is T.DecimalType:
        whole, scale = (found.precision - found.scale, found.scale) if f is T.DecimalType else (DIGITS.get(f), 0)
        return whole is not None and whole <= declared.precision - declared.scale and scale <= declared.scale
    if f is d is T.ArrayType:
        return widens(found.elementType, declared.elementType)
    if f is d is T.MapType:
        return widens(found.keyType, declared.keyType) and widens(found.valueType, declared.valueType)
    if f is d is T.StructType:
        return found.names == declared.names and all(widens(a.dataType, b.dataType) for a, b in zip(found, declared))
    return False


def refusals(found: T.StructType, declared: T.StructType, required: Sequence[str] = (),
             extra: str = "refuse") -> list[str]:
    """Why files of one schema can't be read under the declared one (empty: they can).

    ``required``: columns that no generation may lack.  ``extra``: ``"refuse"``
    columns that aren't declared, or ``"drop"`` them.
    """
    if extra not in ("refuse", "drop"):
        raise ValueError("extra is 'refuse' or 'drop'")
    have = {f.name: f.dataType for f in found}
    out = [f"missing {n}" for n in declared.names if n in required and n not in have]
    if extra == "refuse":
        out += [f"extra {n}" for n in have if n not in declared.names]
    out += [f"type {f.name}: {have[f.name].simpleString()} doesn't fit {f.dataType.simpleString()}"
            for f in declared if f.name in have and not widens(have[f.name], f.dataType)]
    return out


def read_generations(spark: SparkSession, folders: Sequence[str], declared: T.StructType,
                     required: Sequence[str] = (), extra: str = "refuse") -> DataFrame:
    """Rows of all folders under the declared schema.

    No folder gives no rows.  Raises ``ValueError`` with all refusals of all
    folders; schemas are looked up in one footer a folder.
    """
    found = {path: spark.read.parquet(path) for path in folders}
    wrong = [f"{path}: {r}" for path, df in found.items() for r in refusals(df.schema, declared, required, extra)]
    if wrong:
        raise ValueError("; ".join(wrong))
    out = None
    for df in found.values():
        have = {f.name: f.dataType for f in df.schema}
        part = df.select(*[
            F.lit(None).cast(f.dataType).alias(f.name) if f.name not in have
            else F.col(f"`{f.name}`") if have[f.name] == f.dataType
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared])
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], declared) if out is None else out
