"""Relationship discovery (R1-R10): value matching between collections,
foreign/primary key assignment, orphan checks and link edges.

The reference compares sampled key values with every document of every
other collection in nested loops. Here both sides become long-form
``(table, field, family, value)`` rows and meet in one equi-join:

* match mode (R1-R4): the searched values, distinct per column and partly so
  in each task, meet the values of the unique columns in one equi-join;
  matches are folded by a partial aggregate before the last shuffle;
* inclusion mode: values are grouped once on ``(family, value)`` into a
  bitmask of the columns holding each (a plain aggregate folded map-side,
  so hot values collapse inside each task); a second, small aggregation
  sums those bitmasks per referenced column, so no column pairs are ever
  emitted per value.

``family`` keeps integers from matching strings that happen to spell them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.functions.values import array_text
from tessera.operators.common import is_object_id, qcol, union_all
from tessera.operators.profile import range_stats, unique_columns_of
from tessera.session import stored

ID = FX.ID_FIELD
ID_RANK = 1_000_000

MATCH_SCHEMA = ("from_table string, from_field string, to_table string, to_field string, "
                "doc string, from_pos int, to_pos int, u_rank int")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _family(dt: T.DataType, mode: str) -> str | None:
    """Which values may be compared. ``text`` mode (the reference's rule):
    strings and ObjectIds only. ``inclusion`` mode adds integers (compared
    with integers only) and dates."""
    if isinstance(dt, T.StringType) or is_object_id(dt):
        return "text"
    if mode == "inclusion":
        if isinstance(dt, _INTEGRAL):
            return "int"
        if isinstance(dt, T.DateType):
            return "date"
    return None


def _text(c: Column, dt: T.DataType) -> Column:
    if is_object_id(dt):
        return c.getField("oid")
    if isinstance(dt, _INTEGRAL):
        return c.cast("bigint").cast("string")
    return c.cast("string")


def long_values(df: DataFrame, table: str, pos: int, mode: str = "text",
                arrays: bool = True, index: Mapping[tuple[str, str], int] | None = None) -> DataFrame:
    """Every comparable value of a collection in long form:
    ``table, t_pos, field, f_pos, family, value, ival, ci``.

    Text values (strings, ObjectIds) are in ``value``; integers and dates
    (inclusion mode) stay numbers in ``ival``, so they are hashed as bigints
    and never turned into text. ``ci`` is the column's number in ``index``
    (when given). Scalars (F1) give one row; arrays (F2) one row per
    element (F5 for text). A narrow explode: no shuffle.
    """
    parts = []
    for i, f in enumerate(df.schema.fields):
        dt, c = f.dataType, qcol(f.name)
        ci = (index or {}).get((table, f.name), -1)
        fam = _family(dt, mode)
        if fam is not None:
            parts.append(F.array(_element_struct(f.name, i, fam, ci)(_value_of(c, dt))))
        elif arrays and isinstance(dt, T.ArrayType):
            efam = _family(dt.elementType, mode)
            if efam is None:
                continue
            if efam == "text":
                vals = F.transform(array_text(c, dt), lambda x: F.struct(
                    x.alias("value"), F.lit(None).cast("bigint").alias("ival")))
            else:
                vals = F.transform(c, lambda x: _value_of(x, dt.elementType))
            parts.append(F.transform(vals, _element_struct(f.name, i, efam, ci)))
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "table string, t_pos int, field string, f_pos int, family string, value string, "
                "ival bigint, ci int")
    allv = F.concat(*[F.coalesce(p, F.array().cast(p_type())) for p in parts])
    return (df.select(F.explode(allv).alias("v"))
            .where(F.col("v.value").isNotNull() | F.col("v.ival").isNotNull())
            .select(F.lit(table).alias("table"), F.lit(pos).alias("t_pos"),
                    "v.field", "v.f_pos", "v.family", "v.value", "v.ival", "v.ci"))


def _value_of(c: Column, dt: T.DataType) -> Column:
    """``struct<value string, ival bigint>`` for one comparable value."""
    if isinstance(dt, _INTEGRAL):
        return F.struct(F.lit(None).cast("string").alias("value"), c.cast("bigint").alias("ival"))
    if isinstance(dt, T.DateType):
        return F.struct(F.lit(None).cast("string").alias("value"), F.unix_date(c).cast("bigint").alias("ival"))
    return F.struct(_text(c, dt).alias("value"), F.lit(None).cast("bigint").alias("ival"))


def _element_struct(name: str, pos: int, fam: str, ci: int = -1):
    def build(x: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), F.lit(pos).alias("f_pos"),
                        F.lit(fam).alias("family"), x["value"].alias("value"),
                        x["ival"].alias("ival"), F.lit(ci).alias("ci"))
    return build


def p_type() -> str:
    return ("array<struct<field:string,f_pos:int,family:string,value:string,ival:bigint,"
            "ci:int>>")


def unique_key_lists(collections: Mapping[str, DataFrame], nulls: str = "ignore",
                     id_column: str = ID, mode: str | None = None) -> dict[str, list[str]]:
    """A3 for each collection, returned as small lists in schema order (one
    entry per unique column: bounded by the schema width, not the data).
    With ``mode`` only columns that can be compared in that mode are tested
    (in ``text`` mode no numeric column is ever distinct-counted)."""
    only = None
    if mode is not None:
        only = {n: [f.name for f in df.schema.fields if _family(f.dataType, mode) is not None]
                for n, df in collections.items()}
    out: dict[str, list[str]] = {n: [] for n in collections}
    for r in unique_columns_of(dict(collections), nulls=nulls, id_column=id_column,
                               only=only).select("table_name", "column_name").collect():
        out[r["table_name"]].append(r["column_name"])
    for name, df in collections.items():
        order = {c: i for i, c in enumerate(df.columns)}
        out[name].sort(key=lambda c: order[c])
    return out


def u_rank(df: DataFrame, column: str, id_column: str = ID) -> int:
    """Rank of a unique column in the reference's loop: its key list holds
    the unique columns in reverse schema order with the id last, so the id
    is visited last and, among the rest, the first schema column is."""
    if column == id_column:
        return ID_RANK
    return -df.columns.index(column)


def order_text(column: Column, data_type: T.DataType) -> Column:
    """Text that sorts as the values of an order key do: numbers are moved
    above zero and padded."""
    if isinstance(data_type, T.NumericType):
        wide = column.cast("decimal(38,9)") + F.lit("1" + "0" * 28).cast("decimal(38,9)")
        return F.lpad(wide.cast("string"), 40, "0")
    return column.cast("string")


def sample_values(collections: Mapping[str, DataFrame], keys: Mapping[str, list[str]],
                  order_by: Mapping[str, str] | None = None, n: int | None = None,
                  mode: str = "text", id_column: str = ID) -> DataFrame:
    """The referenced side of R1-R4: for every collection, the values of its
    unique columns in all documents, or in the first ``n`` (S12) if asked for:
    ``to_table, to_pos, to_field, u_rank, doc, family, value``. ``doc`` is the
    document's order key as sortable text."""
    frames = []
    for pos, (name, df) in enumerate(collections.items()):
        us = [u for u in keys.get(name, []) if _family(df.schema[u].dataType, mode) is not None]
        if not us:
            continue
        # Natural order in a document store is insertion order, which
        # ObjectId ids follow; default to the id, else the first column.
        key = (order_by or {}).get(name) or (id_column if id_column in df.columns else df.columns[0])
        top = df if n is None else df.orderBy(qcol(key).asc_nulls_last()).limit(n)
        vals = F.array(*[F.struct(F.lit(u).alias("to_field"),
                                  F.lit(u_rank(df, u, id_column)).alias("u_rank"),
                                  F.lit(_family(df.schema[u].dataType, mode)).alias("family"),
                                  _text(qcol(u), df.schema[u].dataType).alias("value"))
                         for u in us])
        frames.append(top.select(F.lit(name).alias("to_table"), F.lit(pos).alias("to_pos"),
                                 order_text(qcol(key), df.schema[key].dataType).alias("doc"),
                                 F.explode(vals).alias("v"))
                      .select("to_table", "to_pos", "v.to_field", "v.u_rank", "doc",
                              "v.family", "v.value")
                      .where(F.col("value").isNotNull()))
    if not frames:
        return next(iter(collections.values())).sparkSession.createDataFrame(
            [], "to_table string, to_pos int, to_field string, u_rank int, doc string, "
                "family string, value string")
    return union_all(frames)


def match_sample(collections: Mapping[str, DataFrame], keys: Mapping[str, list[str]] | None = None,
                 order_by: Mapping[str, str] | None = None, n: int | None = None,
                 mode: str = "text",
                 arrays: bool = True, id_column: str = ID) -> DataFrame:
    """Every (searched column S.c, unique column C.u, document) where
    the document's value of ``u`` occurs in ``S.c`` (as a scalar, R1/R4, or as
    an array element, R2/R3), S != C. All documents of C take part; ``n``
    takes only the first ones, as the reference does.

    Columns ``MATCH_SCHEMA``; ``doc`` is the document's order key as sortable
    text, ``from_pos`` and ``to_pos`` the collection positions and ``u_rank``
    the unique column's loop rank, which R5/R6 use to pick the last match.

    The searched values are reduced to distinct ones per column first (partly
    in each task, so a hot value is a row per task), and meet the unique
    values, each once per column, in an equi-join on the value. Spark
    broadcasts the referenced side only if its measured size allows it.
    """
    if keys is None:
        keys = unique_key_lists(collections, id_column=id_column, mode=mode)
    spark = next(iter(collections.values())).sparkSession
    samples = sample_values(collections, keys, order_by, n, mode, id_column)
    parts = [long_values(df, name, pos, mode, arrays) for pos, (name, df) in enumerate(collections.items())]
    if not parts:
        return spark.createDataFrame([], MATCH_SCHEMA)
    searched = union_all(parts).select("table", "t_pos", "field", "family", "value").distinct()
    joined = searched.join(
        samples,
        (searched["family"] == samples["family"]) & (searched["value"] == samples["value"])
        & (searched["table"] != samples["to_table"]))
    return joined.select(F.col("table").alias("from_table"), F.col("field").alias("from_field"),
                         "to_table", "to_field", "doc",
                         F.col("t_pos").alias("from_pos"), "to_pos", "u_rank")


def match_summary(matches: DataFrame) -> DataFrame:
    """One row per linked column pair with the number of sampled documents
    that matched: ``from_table, from_field, to_table, to_field,
    matched_samples``."""
    return (matches.groupBy("from_table", "from_field", "to_table", "to_field")
            .agg(F.count_distinct("doc").alias("matched_samples")))


_BITS = 62  # columns per bitmask word (keeps 1 << i positive in a bigint)


def match_inclusion(collections: Mapping[str, DataFrame], keys: Mapping[str, list[str]] | None = None,
                    arrays: bool = True, id_column: str = ID, nulls: str = "ignore") -> DataFrame:
    """R1 ``mode="inclusion"``: for every column S.c and unique column C.u of
    another collection sharing at least one value, ``matched_values`` (distinct
    values of S.c found in C.u), ``distinct_values`` of S.c and
    ``coverage = matched / distinct``. All values, not a sample. Even
    coverage 1 can be a coincidence, so every candidate is returned with its
    score rather than one guess.

    Plan (one data shuffle): every comparable column gets an index (schema
    metadata). One scan of each collection in long form feeds a hash
    aggregation on ``(family, value)`` that ORs ``1 << index`` into a few
    bigint words - folded map-side, so each task ships one row per distinct
    value whatever its frequency. Each value then emits one row per
    candidate referenced column it contains (never pairs) plus one totals
    row, and ``groupBy`` on that column sums the value's bits: the sums are
    ``matched(S.c, C.u)`` for every S.c at once, and the totals row gives
    ``distinct_values``. When ``keys`` is not given, uniqueness of each
    scalar column follows from the same totals and one cheap row/NULL count
    pass (``nulls`` rule as in A3), so no separate distinct count runs.
    """
    # Comparable columns, in a fixed order: (table, field); scalars can be keys.
    columns: list[tuple[str, str]] = []
    index: dict[tuple[str, str], int] = {}
    scalar: set[int] = set()
    for name, df in collections.items():
        for f in df.schema.fields:
            dt = f.dataType
            is_scalar = _family(dt, "inclusion") is not None
            ok = is_scalar or (arrays and isinstance(dt, T.ArrayType)
                               and _family(dt.elementType, "inclusion") is not None)
            if ok:
                index[(name, f.name)] = len(columns)
                if is_scalar:
                    scalar.add(len(columns))
                columns.append((name, f.name))
    spark = next(iter(collections.values())).sparkSession
    out_schema = ("from_table string, from_field string, to_table string, to_field string, "
                  "matched_values bigint, distinct_values bigint, coverage double")
    if not columns:
        return spark.createDataFrame([], out_schema)
    n = len(columns)
    words = (n + _BITS - 1) // _BITS
    vals = union_all([long_values(df, name, pos, "inclusion", arrays, index)
                      for pos, (name, df) in enumerate(collections.items())]
                     ).select("family", "value", "ival", "ci")
    aggs = [F.expr(f"bit_or(CASE WHEN floor(ci / {_BITS}) = {w} "
                   f"THEN shiftleft(1L, CAST(ci % {_BITS} AS INT)) END)").alias(f"w{w}")
            for w in range(words)]
    masks = vals.groupBy("family", "ival", "value").agg(*aggs).select(
        *[F.coalesce(F.col(f"w{w}"), F.lit(0).cast("bigint")).alias(f"w{w}") for w in range(words)])

    def bit(i: int) -> Column:
        return F.shiftright(F.col(f"w{i // _BITS}"), i % _BITS).bitwiseAND(F.lit(1))

    if keys is not None:
        cand = sorted({index[(t, u)] for t, us in keys.items() for u in us if (t, u) in index})
    else:
        cand = sorted(scalar)
    # Per value: the candidate referenced columns it holds, and -1 for totals.
    if cand:
        holds = F.filter(F.array(*[F.when(bit(c) == 1, F.lit(c)) for c in cand]),
                         lambda x: x.isNotNull())
    else:
        holds = F.array().cast("array<int>")
    rows = masks.select("*", F.explode(F.concat(F.array(F.lit(-1)), holds)).alias("j"))
    sums = rows.groupBy("j").agg(*[F.sum(bit(i)).alias(f"s{i}") for i in range(n)])
    counts = (sums.select("j", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"s{i}").alias("n")) for i in range(n)])).alias("c"))
        .select("j", "c.i", "c.n").where(F.col("n") > 0))
    tables = [t for t, _ in columns]
    cinfo = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(columns)],
                                  "i int, table string, field string")
    totals = counts.where(F.col("j") == -1).select("i", F.col("n").alias("distinct_values"))
    if keys is not None:
        refs = spark.createDataFrame([(c,) for c in cand], "j int")
    else:
        # Unique iff its distinct values cover every row (A3's nulls rule).
        by_table: dict[str, list[str]] = {}
        for i in sorted(scalar):
            by_table.setdefault(columns[i][0], []).append(columns[i][1])
        stats = union_all([range_stats(collections[t], t, cs) for t, cs in by_table.items()])
        allowed = F.lit(0) if nulls == "ignore" else F.lit(1)
        refs = (stats.join(cinfo, (stats["table_name"] == cinfo["table"])
                           & (stats["column_name"] == cinfo["field"]))
                .join(totals, "i")
                .where(((F.col("n") - F.col("n_nonnull")) <= allowed)
                       & (F.col("distinct_values") + (F.col("n") - F.col("n_nonnull")) == F.col("n")))
                .select(F.col("i").alias("j")))
        ids = [i for i, (t, f) in enumerate(columns) if f == id_column and i in scalar]
        if ids:
            refs = refs.unionByName(spark.createDataFrame([(i,) for i in ids], "j int")).distinct()
    pairs = counts.where(F.col("j") >= 0).join(refs, "j", "left_semi")
    ti = F.array(*[F.lit(t) for t in tables])
    fi = F.array(*[F.lit(f) for _, f in columns])
    at = lambda arr, x: F.element_at(arr, x + 1)
    return (pairs.join(totals, "i")
            .where(at(ti, F.col("i")) != at(ti, F.col("j")))
            .select(at(ti, F.col("i")).alias("from_table"), at(fi, F.col("i")).alias("from_field"),
                    at(ti, F.col("j")).alias("to_table"), at(fi, F.col("j")).alias("to_field"),
                    F.col("n").alias("matched_values"), "distinct_values",
                    (F.col("n") / F.col("distinct_values")).alias("coverage")))


def assign_foreign_keys(matches: DataFrame) -> DataFrame:
    """Each searched column gets one target, the last match in the
    reference's loop order (collection, sampled document, unique column):
    ``from_table, from_field, to_table, to_field``."""
    rank = F.struct("to_pos", "doc", "u_rank")
    best = (matches.groupBy("from_table", "from_field")
            .agg(F.max_by(F.struct("to_table", "to_field"), rank).alias("t")))
    return best.select("from_table", "from_field", "t.to_table", "t.to_field")


def assign_primary_keys(matches: DataFrame, tables: list[str],
                        defaults: Mapping[str, str | None] | None = None,
                        reset_pk: bool = True, overrides: Mapping[str, str] | None = None,
                        foreign_keys: DataFrame | None = None, id_column: str = ID) -> DataFrame:
    """R6 + R7 + R10: ``table_name, primary_key`` for every collection.

    R6: the last matched unique column in loop order (sampled document,
    searched collection, unique column), else ``defaults[table]``
    (``_id`` in the reference). R7 (``reset_pk``): a key whose name is the
    target field of any foreign key becomes ``_id``. R10: ``overrides``
    (the user's choice) win over both.
    """
    spark = matches.sparkSession
    rank = F.struct("doc", "from_pos", "u_rank")
    chosen = (matches.groupBy(F.col("to_table").alias("table_name"))
              .agg(F.max_by("to_field", rank).alias("pk")))
    base = spark.createDataFrame(
        [(t, (defaults or {}).get(t, id_column)) for t in tables],
        "table_name string, default_pk string")
    pks = base.join(chosen, "table_name", "left").select(
        "table_name", F.coalesce("pk", "default_pk").alias("primary_key"))
    if reset_pk:
        fks = foreign_keys if foreign_keys is not None else assign_foreign_keys(matches)
        targets = fks.select(F.col("to_field").alias("primary_key")).distinct()
        hit = targets.withColumn("__hit", F.lit(True))
        pks = (pks.join(hit, "primary_key", "left")
               .select("table_name", F.when(F.col("__hit"), F.lit(id_column))
                       .otherwise(F.col("primary_key")).alias("primary_key")))
    if overrides:
        ov = spark.createDataFrame(list(overrides.items()), "table_name string, override string")
        pks = (pks.join(F.broadcast(ov), "table_name", "left")
               .select("table_name", F.coalesce("override", "primary_key").alias("primary_key")))
    return pks


def same_key(child: Column, child_type: T.DataType, parent: Column, parent_type: T.DataType) -> Column:
    """Whether two keys are equal: numbers of any type by value (in a type
    that holds both), equal types as they are, all else as text."""
    if child_type == parent_type:
        return child == parent
    if isinstance(child_type, T.NumericType) and isinstance(parent_type, T.NumericType):
        if any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in (child_type, parent_type)):
            return child.cast("double") == parent.cast("double")
        scale = max(getattr(t, "scale", 0) for t in (child_type, parent_type))
        return child.cast(f"decimal(38,{scale})") == parent.cast(f"decimal(38,{scale})")
    return child.cast("string") == parent.cast("string")


def count_orphans(child: DataFrame, parent: DataFrame, child_cols: list[str] | str,
                  parent_cols: list[str] | str) -> DataFrame:
    """R8 as one number, ``n_orphans``: child rows whose non-NULL key has no
    parent. Child rows are first counted per key (partial aggregation folds
    a hot key to one row per task), the parent is reduced to its distinct
    keys, and only these two key sets meet in the anti join - no child row
    is shuffled, however skewed the key."""
    cc = [child_cols] if isinstance(child_cols, str) else list(child_cols)
    pc = [parent_cols] if isinstance(parent_cols, str) else list(parent_cols)
    notnull = qcol(cc[0]).isNotNull()
    for a in cc[1:]:
        notnull = notnull & qcol(a).isNotNull()
    per_key = child.where(notnull).groupBy(*[qcol(a).alias(f"__c{i}") for i, a in enumerate(cc)]).agg(
        F.count(F.lit(1)).alias("__n"))
    keys = parent.select(*[qcol(b).alias(f"__k{i}") for i, b in enumerate(pc)]).distinct()
    cond = None
    for i, (a, b) in enumerate(zip(cc, pc)):
        c = same_key(per_key[f"__c{i}"], child.schema[a].dataType, keys[f"__k{i}"], parent.schema[b].dataType)
        cond = c if cond is None else cond & c
    return (per_key.join(keys, cond, "left_anti")
            .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_orphans")))


@dataclass(frozen=True)
class Link:
    """A foreign key: columns of one table that name rows of another."""
    from_table: str
    from_fields: tuple[str, ...]
    to_table: str
    to_fields: tuple[str, ...]

    @staticmethod
    def of(link: Link | Sequence) -> Link:
        """From ``(from_table, from_field, to_table, to_field)``, where a
        composite key has a list of fields."""
        if isinstance(link, Link):
            return link
        ft, ff, tt, tf = link
        ff, tf = ((x,) if isinstance(x, str) else tuple(x) for x in (ff, tf))
        if len(ff) != len(tf) or not ff:
            raise ValueError(f"link {ft}{ff} -> {tt}{tf}: both ends need the same number of fields")
        return Link(ft, ff, tt, tf)

    def checked(self, tables: Mapping[str, DataFrame]) -> Link:
        for t, fields in ((self.from_table, self.from_fields), (self.to_table, self.to_fields)):
            for f in fields:
                if t not in tables or f not in tables[t].columns:
                    raise ValueError(f"link end {t}.{f} is not a column of the tables {sorted(tables)}")
        return self


def common_type(a: T.DataType, b: T.DataType) -> str | None:
    """The type in which ``same_key`` compares; None if they are equal."""
    if a == b:
        return None
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in (a, b)):
            return "double"
        return f"decimal(38,{max(getattr(t, 'scale', 0) for t in (a, b))})"
    return "string"


def _key_text(df: DataFrame, fields: Sequence[str], types: Sequence[str | None]) -> Column:
    """One text per key, equal where the keys are; NULL where a field is."""
    parts, given = [], F.lit(True)
    for name, as_type in zip(fields, types, strict=True):
        c, dt = qcol(name), df.schema[name].dataType
        given = given & c.isNotNull()
        c = c if as_type is None else c.cast(as_type)
        if as_type == "double" or (as_type is None and isinstance(dt, (T.DoubleType, T.FloatType))):
            c = c + F.lit(0.0).cast(as_type or dt)  # one zero
        elif as_type is None and isinstance(dt, T.TimestampType):
            c = F.unix_micros(c)
        elif as_type is None and isinstance(dt, T.BinaryType):
            c = F.hex(c)
        elif as_type is None and isinstance(dt, (T.StructType, T.ArrayType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        parts.append(c.cast("string"))
    return F.when(given, parts[0] if len(parts) == 1 else F.to_json(F.array(*parts)))


def check_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """S6 on the rows: per table with a declared key, ``table_name,
    primary_key, n_rows, n_null`` (rows with a NULL in the key), ``n_keys``
    and ``n_duplicates`` (rows beyond the first of their key). One
    aggregation per table, partly in each task."""
    out = []
    for name, key in keys.items():
        fields = [key] if isinstance(key, str) else list(key)
        given = F.lit(True)
        for i in range(len(fields)):
            given = given & F.col(f"k{i}").isNotNull()
        per_key = tables[name].groupBy(*[qcol(f).alias(f"k{i}") for i, f in enumerate(fields)]).agg(F.count(F.lit(1)).alias("n"))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        out.append(per_key.agg(total(F.col("n")).alias("n_rows"), total(F.when(~given, F.col("n"))).alias("n_null"),
                               total(F.when(given, 1)).alias("n_keys"), total(F.when(given, F.col("n") - 1)).alias("n_duplicates"))
                   .select(F.lit(name).alias("table_name"), F.array(*[F.lit(f) for f in fields]).alias("primary_key"),
                           "n_rows", "n_null", "n_keys", "n_duplicates"))
    if not out:
        raise ValueError("no key to check")
    return union_all(out)


def check_links(tables: Mapping[str, DataFrame], links: Iterable[Link | Sequence]) -> DataFrame:
    """S7/R8 on the rows, for all links in one job: ``from_table, from_fields,
    to_table, to_fields, n_rows, n_null`` (child rows, and those with a NULL
    in the key), ``n_orphans`` and ``n_orphan_keys`` (rows and keys without a
    parent) and ``n_parent_duplicates`` (parent rows beyond the first of their
    key).

    Each table is scanned once: a child row yields its key for every link of
    the table, a parent row for every link to it. Keys are counted in each
    task before they are shuffled, so a hot key is a row per task; only
    distinct keys meet in the one join. Keys compare as ``same_key`` does.
    """
    links = [Link.of(x).checked(tables) for x in links]
    spark = next(iter(tables.values())).sparkSession
    schema = "link int, target int, from_table string, from_fields array<string>, to_table string, to_fields array<string>"
    children: dict[str, list] = {}
    parents: dict[str, dict[tuple, int]] = {}
    rows, n_targets = [], 0
    for i, k in enumerate(links):
        types = tuple(common_type(tables[k.from_table].schema[a].dataType, tables[k.to_table].schema[b].dataType)
                      for a, b in zip(k.from_fields, k.to_fields, strict=True))
        known = parents.setdefault(k.to_table, {})
        if (k.to_fields, types) not in known:
            known[k.to_fields, types] = n_targets
            n_targets += 1
        target = known[k.to_fields, types]
        children.setdefault(k.from_table, []).append((i, target, k.from_fields, types))
        rows.append((i, target, k.from_table, list(k.from_fields), k.to_table, list(k.to_fields)))
    named = spark.createDataFrame(rows, schema)
    out = ["from_table", "from_fields", "to_table", "to_fields"]
    sums = ["n_rows", "n_null", "n_orphans", "n_orphan_keys", "n_parent_duplicates"]
    if not links:
        return named.select(*out, *[F.lit(0).cast("long").alias(c) for c in sums])
    child_keys = union_all([
        tables[t].select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("link"), F.lit(g).alias("target"), _key_text(tables[t], fields, types).alias("key"))
            for i, g, fields, types in some])).alias("x")).select("x.*") for t, some in children.items()
    ]).groupBy("link", "target", "key").agg(F.count(F.lit(1)).alias("n"))
    parent_keys = union_all([
        tables[t].select(F.explode(F.array(*[
            F.struct(F.lit(g).alias("target"), _key_text(tables[t], fields, types).alias("key"))
            for (fields, types), g in some.items()])).alias("x")).select("x.*") for t, some in parents.items()
    ]).where(F.col("key").isNotNull()).groupBy("target", "key").agg(F.count(F.lit(1)).alias("m"))
    lost = F.col("key").isNotNull() & F.col("m").isNull()
    per_link = child_keys.join(parent_keys, ["target", "key"], "left").groupBy("link").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("key").isNull(), F.col("n"))).alias("n_null"),
        F.sum(F.when(lost, F.col("n"))).alias("n_orphans"), F.sum(F.when(lost, 1)).alias("n_orphan_keys"))
    per_target = parent_keys.groupBy("target").agg(F.sum(F.col("m") - 1).alias("n_parent_duplicates"))
    return (named.join(per_link, "link", "left").join(per_target, "target", "left")
            .select(*out, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums]))


def link_edges(foreign_keys: DataFrame) -> DataFrame:
    """One schema-graph link per foreign key: ``from, fromPort, to, toPort``."""
    return foreign_keys.select(F.col("from_table").alias("from"), F.col("from_field").alias("fromPort"),
                               F.col("to_table").alias("to"), F.col("to_field").alias("toPort"))


#: Orphan keys up to this many are sent to every task.
BROADCAST_KEYS = 1_000_000


def check_foreign_keys(child: DataFrame, parent: DataFrame, child_cols: list[str] | str,
                       parent_cols: list[str] | str, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The child rows whose (non-NULL) key has no parent row - the rows a
    ``FOREIGN KEY`` constraint would reject.

    The orphan keys come first, from the distinct keys of both sides, stored
    and counted. Then the child rows that hold one are picked: up to
    ``broadcast_keys`` keys go to every task and no child row moves; beyond
    that a semi join shuffles rows, whose hot keys Spark may split.
    """
    cc = [child_cols] if isinstance(child_cols, str) else list(child_cols)
    pc = [parent_cols] if isinstance(parent_cols, str) else list(parent_cols)
    names = [f"__c{i}" for i in range(len(cc))]
    notnull = F.lit(True)
    for a in cc:
        notnull = notnull & qcol(a).isNotNull()
    keys = child.where(notnull).select(*[qcol(a).alias(n) for a, n in zip(cc, names, strict=True)]).distinct()
    p = parent.select(*[qcol(b).alias(f"__p{i}") for i, b in enumerate(pc)]).distinct()
    cond = F.lit(True)
    for i, (a, b) in enumerate(zip(cc, pc, strict=True)):
        cond = cond & same_key(F.col(names[i]), child.schema[a].dataType, F.col(f"__p{i}"), parent.schema[b].dataType)
    orphans = stored(keys.join(p, cond, "left_anti"), "orphan-keys")
    if orphans.count() <= broadcast_keys:
        orphans = F.broadcast(orphans)
    same = F.lit(True)
    for a, n in zip(cc, names, strict=True):
        same = same & (qcol(a) == F.col(n))
    return child.join(orphans, same, "left_semi")
