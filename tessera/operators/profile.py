"""Key profiling: row counts, distinct counts, unique columns.

Every statistic is a plain aggregate, so Spark computes it with a partial
(map-side) aggregate per task and a small final merge. A distinct count is
a two-level hash aggregate: each task ships at most one row per distinct
value it saw, never its raw rows, so a value holding a third of the rows
costs one row per task before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.operators.common import chunks, is_array, is_groupable, path_col, qcol, union_all
from tessera.sources.documents import sample_rows

NULL_RULES = ("ignore", "group")

# Columns per aggregation pass. Expand repeats each row once per distinct
# column, so very wide tables are split to keep per-task hash maps small.
DEFAULT_BATCH = 64


def row_count(df: DataFrame) -> DataFrame:
    """A1: one row, ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1 over several tables: ``table_name, n_rows``."""
    return union_all([
        row_count(df).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()])


def key_eligible_columns(df: DataFrame) -> list[str]:
    """top-level columns that may be keys.

    The reference drops every column whose ``name:type`` text contains
    "array", which also drops columns merely *named* like that; here only
    the type is tested. Maps cannot be compared, so they are left out too.
    """
    return [f.name for f in df.schema.fields
            if not is_array(f.dataType) and is_groupable(f.dataType)]


def _as_exprs(df: DataFrame, columns) -> dict[str, Column]:
    if columns is None:
        return {c: qcol(c) for c in key_eligible_columns(df)}
    if isinstance(columns, dict):
        return dict(columns)
    return {c: qcol(c) for c in columns}


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_SLOTS = "l bigint, d double, s string"


def _slots(c: Column, dt: T.DataType) -> Column | None:
    """A value as one of a number, a float or a text, equal where the values
    are; None for types (structs, arrays, ...) that no slot holds exactly."""
    slot, value = None, c
    if isinstance(dt, _WHOLE):
        slot = "l"
    elif isinstance(dt, T.BooleanType):
        slot, value = "l", c.cast("int")
    elif isinstance(dt, T.DateType):
        slot, value = "l", F.unix_date(c)
    elif isinstance(dt, T.TimestampType):
        slot, value = "l", F.unix_micros(c)
    elif isinstance(dt, (T.FloatType, T.DoubleType)):
        slot, value = "d", c.cast("double") + F.lit(0.0)  # one zero
    elif isinstance(dt, T.StringType):
        slot = "s"
    elif isinstance(dt, (T.DecimalType, T.TimestampNTZType)):
        slot, value = "s", c.cast("string")
    elif isinstance(dt, T.BinaryType):
        slot, value = "s", F.hex(c)
    if slot is None:
        return None
    return F.struct(*[(value if n == slot else F.lit(None)).cast(t).alias(n) for n, t in (x.split() for x in _SLOTS.split(", "))])


def is_columnar(df: DataFrame) -> bool:
    """Whether ``df`` reads columnar files and only picks rows and columns of
    them, so that a scan reads no more than the columns it is asked for."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.lstrip(" +-:").split(" ", 1) for line in plan.splitlines() if line.strip()]
    return all(x[0] in ("Project", "Filter") or (x[0] == "Relation" and x[-1].rstrip().endswith(("parquet", "orc"))) for x in steps)


def _long_counts(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """``t, column_name, n_rows, n_distinct, n_null`` of columns that have
    slots, one scan per table and one exchange of values for all tables: each
    row yields ``(column, value)`` pairs, which are counted per value in each
    task, then per value, then per column."""
    named, frames = [], []
    for t, (df, exprs) in tables.items():
        types = df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs.values())]).schema
        pairs = []
        for (name, e), f in zip(exprs.items(), types.fields, strict=True):
            pairs.append(F.struct(F.lit(len(named)).alias("ci"), _slots(e, f.dataType).alias("v")))
            named.append((len(named), t, name))
        frames.append(df.select(F.explode(F.array(*pairs)).alias("x")).select("x.ci", "x.v.*"))
    spark = frames[0].sparkSession
    given = F.col("l").isNotNull() | F.col("d").isNotNull() | F.col("s").isNotNull()
    counts = (union_all(frames).groupBy("ci", "l", "d", "s").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("ci").agg(F.sum("n").alias("n_rows"), F.count(F.when(given, 1)).alias("n_distinct"),
                                 F.sum(F.when(~given, F.col("n"))).alias("n_null")))
    return (spark.createDataFrame(named, "ci int, t string, column_name string").join(counts, "ci", "left")
            .select("t", "column_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_rows", "n_distinct", "n_null")]))


def distinct_counts(df: DataFrame, columns: Iterable[str] | dict[str, Column] | None = None,
                    table_name: str | None = None, batch: int = DEFAULT_BATCH,
                    strategy: str = "auto") -> DataFrame:
    """A2: ``[table_name,] column_name, n_rows, n_distinct, n_null`` per column.

    ``n_distinct`` skips NULL (SQL ``count(DISTINCT)``); ``n_null`` lets the
    caller apply either null rule. ``columns`` may map output names to
    expressions (nested paths).

    ``strategy="per_column"`` gives every column its own single-distinct
    aggregate and unions them: each branch scans only its column (Parquet/ORC
    column pruning) and hashes one narrow key, and the branches run as
    parallel stages of one job. ``"long"`` scans once: rows become (column,
    value) pairs, counted per value in each task; it suits sources where every
    scan reads or computes everything (JSON, JDBC, joins, groupings).
    ``"expand"`` leaves all columns of a ``batch`` to one aggregate with
    several ``count(DISTINCT)``. ``"auto"`` (default) is ``per_column`` for
    columnar files and ``long`` for any other source; columns of nested types
    are always counted per column.
    """
    exprs = _as_exprs(df, columns)
    names = list(exprs)
    if not names:
        raise ValueError("no column to count")
    if strategy == "auto":
        strategy = "per_column" if is_columnar(df) else "long"
    own = names
    parts = []
    if strategy == "long":
        types = df.select(*[exprs[n].alias(f"c{i}") for i, n in enumerate(names)]).schema
        slotted = [n for n, f in zip(names, types.fields, strict=True) if _slots(F.lit(None), f.dataType) is not None]
        own = [n for n in names if n not in slotted]
        if slotted:
            parts.append(_long_counts({"": (df, {n: exprs[n] for n in slotted})}).drop("t"))
    if strategy in ("per_column", "long"):
        for name in own:
            e = exprs[name]
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_distinct(e).alias("n_distinct"),
                                (F.count(F.lit(1)) - F.count(e)).alias("n_null"))
                         .select(F.lit(name).alias("column_name"), "n_rows", "n_distinct", "n_null"))
        out = union_all(parts)
    elif strategy == "expand":
        for group in chunks(names, batch):
            aggs = [F.count(F.lit(1)).alias("__n")]
            for i, name in enumerate(group):
                e = exprs[name]
                aggs.append(F.count_distinct(e).alias(f"__d{i}"))
                aggs.append((F.count(F.lit(1)) - F.count(e)).alias(f"__z{i}"))
            one = df.agg(*aggs)
            rows = F.explode(F.array(*[
                F.struct(F.lit(name).alias("column_name"),
                         F.col(f"__d{i}").alias("n_distinct"),
                         F.col(f"__z{i}").alias("n_null"))
                for i, name in enumerate(group)])).alias("r")
            parts.append(one.select(F.col("__n").alias("n_rows"), rows)
                         .select("r.column_name", "n_rows", "r.n_distinct", "r.n_null"))
        out = union_all(parts)
    else:
        raise ValueError("strategy must be 'auto', 'per_column', 'long' or 'expand'")
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), *out.columns)
    return out


def _unique_test(nulls: str) -> Column:
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls must be one of {NULL_RULES}")
    if nulls == "ignore":
        # Any NULL disqualifies: count(DISTINCT) skips it, count(*) does not.
        return F.col("n_distinct") == F.col("n_rows")
    # NULL counts as one more value, as SELECT DISTINCT does.
    return (F.col("n_distinct") + F.when(F.col("n_null") > 0, 1).otherwise(0)) == F.col("n_rows")


#: Slices of values in which repetition is looked for, one after the other:
#: what repeats often is found in a small one.
SLICES = (64, 8)


def _value_text(df: DataFrame, column: str) -> Column:
    """A value's text, equal where the values are."""
    dt = df.schema[column].dataType
    slots = _slots(qcol(column), dt)
    if slots is None:
        return F.when(qcol(column).isNotNull(), F.to_json(F.struct(qcol(column)), {"ignoreNullFields": "false"}))
    return F.coalesce(slots["l"].cast("string"), slots["d"].cast("string"), slots["s"])


def _repeating(tables: dict[str, DataFrame], sets: list[tuple[str, tuple[str, ...]]], of: int) -> set[int]:
    """Which column sets (as places in ``sets``; the first column of each is
    the one to slice by) hold a combination twice in one slice of ``of``: the
    rows where the first column's hash falls into it. Rows with the same
    combination are in the same slice, so one found twice is a proof, and with
    one slice of one the answer is exact. Combinations with a NULL are not
    looked at. Each table is scanned once; only the slices are shuffled."""
    frames = []
    for t, df in tables.items():
        own = [(i, cols) for i, (name, cols) in enumerate(sets) if name == t]
        if not own:
            continue
        used = list(dict.fromkeys(c for _, cols in own for c in cols))
        texts = df.select(F.array(*[_value_text(df, c) for c in used]).alias("texts"))
        by_first: dict[str, list] = {}
        for i, cols in own:
            by_first.setdefault(cols[0], []).append(F.struct(F.lit(i).alias("i"), F.array(*[F.lit(used.index(c)) for c in cols]).alias("at")))
        wanted = [F.when(F.pmod(F.xxhash64(F.col("texts")[used.index(c)]), F.lit(of)) == 0, F.array(*some)) for c, some in by_first.items()]
        picked = (texts.select("texts", F.explode(F.flatten(F.array_compact(F.array(*wanted)))).alias("x"))
                  .select("x.i", F.transform("x.at", lambda j: F.col("texts")[j]).alias("v")))
        frames.append(picked.where(~F.exists("v", lambda x: x.isNull())))
    if not frames:
        return set()
    twice = union_all(frames).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i").distinct()
    return {r["i"] for r in twice.collect()}


def sliced_candidates(df: DataFrame, columns: list[str], of: int = SLICES[0]) -> list[str]:
    """Rule columns out before the exact count: those with a value that occurs
    twice in one slice of their values. Nothing is dropped on an estimate."""
    gone = _repeating({"t": df}, [("t", (c,)) for c in columns], of)
    return [c for i, c in enumerate(columns) if i not in gone]


def unique_column_sets(tables: dict[str, DataFrame], max_size: int = 2, slices: Iterable[int] = SLICES) -> DataFrame:
    """A3 for combinations: ``table_name, columns, n_rows`` of every smallest
    set of up to ``max_size`` columns whose values, taken together, differ in
    all rows (composite key candidates). Columns are in schema order; a set
    that contains another one found is left out; a column with a NULL is in no
    set (rule ``ignore``).

    Level by level, all tables together. From the distinct counts of the
    columns, a set is a candidate if no smaller unique set lies in it and the
    product of its columns' counts reaches the row count. Candidates that
    repeat within a slice of the values of their most varied column are
    dropped, first in a small slice, then in a larger one; the rest, near
    keys, are tested on all rows. A table whose rows repeat over all its
    columns has no set, and is left after level one. The number of candidates
    grows with the columns to the power of ``max_size``, not with the data.
    """
    counts: dict[str, dict[str, int]] = {t: {} for t in tables}
    n_rows: dict[str, int] = {}
    for r in union_all([distinct_counts(df, table_name=t) for t, df in tables.items()]).collect():
        n_rows[r["table_name"]] = r["n_rows"]
        if r["n_null"] == 0:
            counts[r["table_name"]][r["column_name"]] = r["n_distinct"]
    found: dict[str, list[tuple[str, ...]]] = {}
    left: dict[str, list[str]] = {}
    for t, df in tables.items():
        own = [c for c in df.columns if c in counts[t]]
        found[t] = [(c,) for c in own if counts[t][c] == n_rows[t]]
        left[t] = [c for c in own if 1 < counts[t][c] < n_rows[t]]

    def varied(t: str, cols: Iterable[str]) -> tuple[str, ...]:
        return tuple(sorted(cols, key=lambda c: -counts[t][c]))

    slices = list(slices)
    if max_size > 1 and slices:
        whole = [(t, varied(t, cols)) for t, cols in left.items() if len(cols) > 1]
        same = {whole[i][0] for i in _repeating(tables, whole, slices[0])}
        left = {t: cols for t, cols in left.items() if t not in same}
    for size in range(2, max_size + 1):
        sets = [(t, some) for t, cols in left.items() for some in combinations(cols, size)
                if math.prod(counts[t][c] for c in some) >= n_rows[t] and not any(set(u) <= set(some) for u in found[t])]
        for of in [*slices, 1]:
            gone = _repeating(tables, [(t, varied(t, some)) for t, some in sets], of)
            sets = [x for i, x in enumerate(sets) if i not in gone]
        for t, some in sets:
            found[t].append(some)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([(t, list(s), n_rows[t]) for t, some in found.items() for s in some],
                                 "table_name string, columns array<string>, n_rows bigint")


_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def range_stats(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``table, column_name, n, n_nonnull, lo, hi`` for each column, from one
    global aggregate (lo/hi only for integer, date and boolean columns)."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(columns):
        aggs.append(F.count(qcol(c)).alias(f"__c{i}"))
        dt = df.schema[c].dataType
        if isinstance(dt, _RANGED):
            v = qcol(c)
            if isinstance(dt, T.DateType):
                v = F.unix_date(v)
            elif isinstance(dt, T.BooleanType):
                v = v.cast("int")
            aggs += [F.min(v).cast("decimal(38,0)").alias(f"__lo{i}"),
                     F.max(v).cast("decimal(38,0)").alias(f"__hi{i}")]
        else:
            aggs += [F.lit(None).cast("decimal(38,0)").alias(f"__lo{i}"),
                     F.lit(None).cast("decimal(38,0)").alias(f"__hi{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__c{i}").alias("n_nonnull"),
                 F.col(f"__lo{i}").alias("lo"), F.col(f"__hi{i}").alias("hi"))
        for i, c in enumerate(columns)])).alias("r")
    return one.select(F.lit(table).alias("table_name"), F.col("__n").alias("n"), rows).select(
        "table_name", "r.column_name", "n", "r.n_nonnull", "r.lo", "r.hi")


def exact_candidates_of(tables: dict[str, tuple[DataFrame, list[str]]],
                        nulls: str = "ignore") -> dict[str, list[str]]:
    """Rule columns out exactly, for many tables in one job with no shuffle
    of values: a column with more NULLs than the rule allows cannot be
    unique, and neither can an integer, date or boolean column whose value
    range holds fewer values than there are rows (pigeonhole). Typical
    foreign keys are dropped here, before their costly distinct count. The
    result has one row per column (bounded by the schema)."""
    parts = [range_stats(df, t, cols) for t, (df, cols) in tables.items() if cols]
    keep: dict[str, list[str]] = {t: [] for t in tables}
    if not parts:
        return keep
    for r in union_all(parts).collect():
        n, nn = r["n"], r["n"] - r["n_nonnull"]
        if n > 0:
            if (nulls == "ignore" and nn > 0) or (nulls == "group" and nn > 1):
                continue
            if r["lo"] is not None and int(r["hi"]) - int(r["lo"]) + 1 + (1 if nn > 0 else 0) < n:
                continue
        keep[r["table_name"]].append(r["column_name"])
    for t, (df, cols) in tables.items():
        order = {c: i for i, c in enumerate(cols)}
        keep[t].sort(key=lambda c: order[c])
    return keep


def exact_candidates(df: DataFrame, columns: list[str], nulls: str = "ignore") -> list[str]:
    """``exact_candidates_of`` for one table."""
    return exact_candidates_of({"t": (df, list(columns))}, nulls)["t"]


def unique_columns(df: DataFrame, table_name: str, nulls: str = "ignore",
                   prefilter: bool = False, id_column: str = "_id",
                   columns: Iterable[str] | None = None, prune: bool = True) -> DataFrame:
    """A3: ``table_name, column_name, n_rows, n_distinct`` for every column
    whose values are all different.

    ``nulls="ignore"`` (default): unique iff ``count(DISTINCT c) = count(*)``,
    so a NULL disqualifies. ``nulls="group"``: NULL is one more value (the
    ``SELECT DISTINCT`` rule). ``id_column`` is reported without a test, as
    the reference does for ``_id``; its ``n_distinct`` is then NULL.
    ``prune`` (default) first drops, exactly, the columns that cannot be
    unique by their NULL count or value range (``exact_candidates``).
    ``prefilter=True`` adds one pass that skips the exact count for columns
    with a value that occurs twice in a slice of their values; it pays off on
    wide tables with many high-cardinality non-key columns, not on narrow
    ones.
    """
    _unique_test(nulls)
    cand = list(columns) if columns is not None else key_eligible_columns(df)
    has_id = id_column in df.columns and id_column in cand
    cand = [c for c in cand if c != id_column]
    if prune:
        cand = exact_candidates(df, cand, nulls)
    if prefilter:
        cand = sliced_candidates(df, cand)
    spark = df.sparkSession
    schema = "table_name string, column_name string, n_rows bigint, n_distinct bigint"
    parts = []
    if cand:
        parts.append(distinct_counts(df, cand, table_name)
                     .where(_unique_test(nulls))
                     .select("table_name", "column_name", "n_rows", "n_distinct"))
    if has_id:
        parts.append(row_count(df).select(
            F.lit(table_name).alias("table_name"), F.lit(id_column).alias("column_name"),
            "n_rows", F.lit(None).cast("bigint").alias("n_distinct")))
    if not parts:
        return spark.createDataFrame([], schema)
    return union_all(parts)


def unique_columns_of(tables: dict[str, DataFrame], nulls: str = "ignore", prune: bool = True,
                      id_column: str = "_id", only: dict[str, list[str]] | None = None,
                      **kw) -> DataFrame:
    """A3 over several tables: one pruning job for all of them, then one
    job with the exact distinct counts of the remaining columns. ``only``
    limits the columns tested per table."""
    cols = {}
    for name, df in tables.items():
        allowed = None if only is None else set(only.get(name, []))
        cols[name] = [c for c in key_eligible_columns(df)
                      if c != id_column and (allowed is None or c in allowed)]
    if prune:
        cand = exact_candidates_of({n: (tables[n], cols[n]) for n in tables}, nulls)
    else:
        cand = cols
    return union_all([
        unique_columns(df, name, nulls=nulls, prune=False, id_column=id_column,
                       columns=cand[name] + ([id_column] if id_column in df.columns else []), **kw)
        for name, df in tables.items()])


# --- nested keys (A4, A5) ---------------------------------------------------

def _field_of(name: str):
    return lambda x: x.getField(name)


def _sub_exprs(df: DataFrame, column: str) -> dict[str, Column]:
    """Sub-fields ``column.sub`` of a struct, or of an array of structs (then
    the expression is the array of that sub-field per row)."""
    dt = df.schema[column].dataType
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        fields = dt.elementType.fields
        return {f"{column}.{f.name}": F.transform(qcol(column), _field_of(f.name))
                for f in fields if is_groupable(f.dataType)}
    if isinstance(dt, T.StructType):
        return {f"{column}.{f.name}": qcol(column).getField(f.name)
                for f in dt.fields if is_groupable(f.dataType)}
    return {}


def prune_keys(keys: DataFrame, column: str = "column_name",
               group_cols: Iterable[str] = ("table_name",)) -> DataFrame:
    """A5: drop a key ``a`` when another key ``a.x...`` of the same table
    lies below it (``profile`` goes when ``profile.c_name`` is a key).

    Written as an equi-join: each key emits its proper path prefixes, and
    keys equal to some emitted prefix are removed with a left anti join.
    The reference tests a plain text prefix and drops only one key.
    """
    group_cols = list(group_cols)
    parts = F.split(F.col(column), r"\.")
    prefixes = (keys.select(*group_cols, F.posexplode(parts).alias("i", "_p"), parts.alias("_parts"))
                .where(F.col("i") < F.size("_parts") - 1)
                .select(*group_cols, F.array_join(F.slice("_parts", 1, F.col("i") + 1), ".")
                        .alias(column))
                .distinct())
    return keys.join(prefixes, on=group_cols + [column], how="left_anti")


def nested_unique_columns(df: DataFrame, table_name: str, nulls: str = "ignore",
                          id_column: str = "_id") -> DataFrame:
    """A4 + A5: unique top-level columns plus unique sub-fields ``c.sub`` of
    every unique struct / array-of-struct column ``c`` (except the id), with
    parents pruned when a sub-field is a key. ``table_name, column_name``.

    Two aggregation passes: top-level columns, then all sub-fields of the
    unique composite columns together. Unlike the reference, the first
    sub-field of a struct is tested too.
    """
    top_cols = [f.name for f in df.schema.fields if is_groupable(f.dataType)]
    # One row per column: bounded by the schema width, not by the data.
    top_rows = unique_columns(df, table_name, nulls=nulls, prefilter=False,
                              id_column=id_column, columns=top_cols).collect()
    composite = {f.name for f in df.schema.fields
                 if f.name != id_column and (
                     isinstance(f.dataType, T.StructType)
                     or (isinstance(f.dataType, T.ArrayType)
                         and isinstance(f.dataType.elementType, T.StructType)))}
    spark = df.sparkSession
    keys = spark.createDataFrame([(table_name, r["column_name"]) for r in top_rows],
                                 "table_name string, column_name string")
    subs: dict[str, Column] = {}
    for r in top_rows:
        if r["column_name"] in composite:
            subs.update(_sub_exprs(df, r["column_name"]))
    if subs:
        sub_keys = (distinct_counts(df, subs, table_name)
                    .where(_unique_test(nulls)).select("table_name", "column_name"))
        keys = keys.unionByName(sub_keys)
    return prune_keys(keys)


# --- lengths and samples (A6, A7) ---------------------------------------------

def length_stats(df: DataFrame, table_name: str, include_double: bool = True) -> DataFrame:
    """``table_name, column_name, len_min, len_max`` of the text form of
    string (and, by default, double) columns at the root or one level deep
    in a struct; ``0, 0`` when a column has no value. One aggregation pass.

    Text lengths of doubles follow Spark's cast rules, which differ from
    other engines' (``1.0E7`` vs ``10000000.0``).
    """
    wanted = (T.StringType, T.DoubleType) if include_double else (T.StringType,)
    exprs: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, wanted):
            exprs[f.name] = qcol(f.name)
        elif isinstance(f.dataType, T.StructType):
            for s in f.dataType.fields:
                if isinstance(s.dataType, wanted):
                    exprs[f"{f.name}.{s.name}"] = qcol(f.name).getField(s.name)
    if not exprs:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, len_min bigint, len_max bigint")
    aggs = []
    for i, e in enumerate(exprs.values()):
        ln = F.length(e.cast("string"))
        aggs += [F.min(ln).alias(f"__lo{i}"), F.max(ln).alias(f"__hi{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"),
                 F.coalesce(F.col(f"__lo{i}"), F.lit(0)).cast("bigint").alias("len_min"),
                 F.coalesce(F.col(f"__hi{i}"), F.lit(0)).cast("bigint").alias("len_max"))
        for i, name in enumerate(exprs)])).alias("r")
    return one.select(F.lit(table_name).alias("table_name"), rows).select(
        "table_name", "r.column_name", "r.len_min", "r.len_max")


def sample_values(df: DataFrame, path: str, order_by: str,
                  n: int = FX.SAMPLE_DOCUMENTS) -> DataFrame:
    """Text of ``path`` for the first ``n`` documents under ``order_by``:
    ``<order_by>, value``. A top-k (S12), not a sort of the whole input."""
    return (sample_rows(df, n, order_by)
            .select(qcol(order_by), path_col(path).cast("string").alias("value")))
