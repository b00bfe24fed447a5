"""Small helpers shared by the operators: column references, type tests and
long-form unions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def qcol(name: str) -> Column:
    """Reference a top-level column whose name may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def path_col(path: str) -> Column:
    """Reference a nested path ``a.b.c``; each part is quoted on its own."""
    parts = path.split(".")
    c = qcol(parts[0])
    for p in parts[1:]:
        c = c.getField(p)
    return c


def is_array(dt: T.DataType) -> bool:
    return isinstance(dt, T.ArrayType)


def is_groupable(dt: T.DataType) -> bool:
    """Types Spark can compare for DISTINCT: everything but maps and variants
    (also when nested)."""
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return is_groupable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(is_groupable(f.dataType) for f in dt.fields)
    return True


def is_object_id(dt: T.DataType) -> bool:
    """An ObjectId as the document readers expose it: ``struct<oid:string>``."""
    return (isinstance(dt, T.StructType) and len(dt.fields) == 1
            and dt.fields[0].name == "oid"
            and isinstance(dt.fields[0].dataType, T.StringType))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; the caller guarantees the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def chunks(items: list, size: int) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)] or [[]]


def table_namer() -> Callable[..., str]:
    """Names for tables: the field's name; if that is taken its whole path
    (or the next of several paths), and if that is taken too the last path
    with the first free number."""
    used: set[str] = set()

    def name(n: str, *paths: str) -> str:
        whole = [p.replace(".", "_") for p in paths]
        tries = chain([n], whole, (f"{whole[-1]}_{i}" for i in count(2)))
        t = next(x for x in tries if x.casefold() not in used)
        used.add(t.casefold())
        return t

    return name
