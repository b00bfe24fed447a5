"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words. A document of a source is due
``target / source_size`` copies: the whole part is certain, the rest a
probability. Pivotal rounding takes two documents with fractional
probabilities and moves mass between them, at random and without bias and
keeping ``size * probability`` together the same, until one of them is
certain. The undecided one of a block of documents goes up a tree: blocks of
documents, then blocks of what those left over. Within a block the longest
come first, so that what is left is rather short; about ``LADDER`` documents
of each source, chosen by hash, wait for the last block for the same reason.
The last block of a source is drawn ``DRAWS`` times; a final draw settles the
one undecided document of each, and the outcome nearest to the target counts
(rejective sampling). A source's words are off by less than that document.

DataFrame operations only. Blocks hold about ``FAN`` units whatever the size
of a source, so no source is in one task; draws come from hashes of the ids,
so a rerun agrees.

Defined results: a null text has size 0 and is never in question; a null
source is a source, the last in order; repeated rows are mixed one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, numbered, written

WORD = r"[^\x20\x09-\x0D]+"
FAN = 64
LADDER = 256
DRAWS = 16
SALTS = 64
UNIT = "struct<k:bigint,h:bigint,row_id:bigint,doc_id:bigint,size:bigint,p:double>"


def uniform(seed: int | str, *columns: str) -> str:
    """SQL for a number in [0, 1) that depends on ``columns`` alone."""
    return f"(shiftrightunsigned(xxhash64({seed}, {', '.join(columns)}), 11) / 9007199254740992D)"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Per source: source_size, n, target. Words are dealt by weight; what
    exceeds ``most`` times a source's size is dealt again among the others,
    which ends at one water level for all that stay below. The table has a
    row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                              ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
           .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    every = Window.partitionBy(F.lit(0))
    lower = every.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0))))
    return (per.withColumn("level", level)
            .withColumn("level", F.min_by("level", F.when(F.col("ratio") >= F.col("level"), F.col("ratio"))).over(every))
            .withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
            .select("source", "source_size", "n", "target"))


def _pivot(units: str, seed: int | str) -> str:
    """SQL that settles an array of units up to one: struct(r, done)."""
    done = "array<struct<row_id:bigint,doc_id:bigint,size:bigint,up:int>>"

    def settle(who: str, up: int) -> str:
        return (f"concat(a.done, array(named_struct('row_id', {who}.row_id, 'doc_id', {who}.doc_id, "
                f"'size', {who}.size, 'up', {up})))")

    def stay(who: str, p: str) -> str:
        return (f"named_struct('k', {who}.k, 'h', {who}.h, 'row_id', {who}.row_id, 'doc_id', {who}.doc_id, 'size', {who}.size, "
                f"'p', least(1D, greatest(0D, {p})))")

    def both(left: str, settled: str) -> str:
        return f"named_struct('r', {left}, 'done', {settled})"

    # i is the carried unit, j the next. up_i: what i may rise until it is 1;
    # up_j: until j is 0. down_i, down_j: until i is 0, until j is 1.
    return f"""
    aggregate({units},
      named_struct('r', cast(null as {UNIT}), 'done', cast(array() as {done})),
      (a, j) -> if(a.r is null, named_struct('r', j, 'done', a.done),
        element_at(transform(array(named_struct(
            'up_i', 1D - a.r.p, 'up_j', j.p * j.size / a.r.size,
            'down_i', a.r.p, 'down_j', (1D - j.p) * j.size / a.r.size,
            'ratio', a.r.size / j.size, 'u', {uniform(seed, "a.r.doc_id", "a.r.size", "j.doc_id", "j.size")})),
          v -> if(v.u * (least(v.up_i, v.up_j) + least(v.down_i, v.down_j)) < least(v.down_i, v.down_j),
            if(v.up_i <= v.up_j, {both(stay("j", "j.p - v.up_i * v.ratio"), settle("a.r", 1))},
                                 {both(stay("a.r", "a.r.p + v.up_j"), settle("j", 0))}),
            if(v.down_i <= v.down_j, {both(stay("j", "j.p + v.down_i * v.ratio"), settle("a.r", 0))},
                                     {both(stay("a.r", "a.r.p - v.down_j"), settle("j", 1))}))), 1)))"""


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """One row per document (doc_id, text, source): row_id (see ``numbered``), doc_id, size, source_size, target,
    copies, taken."""
    sizes = written(numbered(docs.select("doc_id", "source", "text")).select(
        "row_id", F.col("doc_id").cast("long"), "source", word_count().alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, share, most)
    # A source may hold a third of all rows: its rows are dealt over salts.
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    joined = (sizes.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int")).alias("d")
              .join(targets.withColumn("salt", salt).alias("t"),
                    F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.salt") == F.col("t.salt")))
              .select("row_id", "doc_id", "size", F.col("d.source").alias("source"), "source_size", "target", "n",
                      F.least(F.lit(float(most)), F.try_divide(F.col("target"), F.col("source_size"))).alias("due")))
    due = written(joined.withColumn("base", F.coalesce(F.floor("due"), F.lit(0)).cast("int"))
                  .withColumn("p", F.coalesce(F.col("due") - F.col("base"), F.lit(0.0)))
                  .withColumn("open", (F.col("size") > 0) & (F.col("p") > 0)), "mix-due")
    constants = ["source", "source_size", "target", "base"]
    out = (due.where(~F.col("open")).withColumn("up", F.lit(0))
           .select("row_id", "doc_id", "size", *constants, "up"))
    largest = due.where("open").agg(F.max("n").alias("n")).first()["n"] or 0
    # By row: rows without an id, or with one id, are dealt like any others.
    h = F.xxhash64(F.lit(seed), "doc_id", "size", "row_id")
    fields = F.struct((-F.col("size")).alias("k"), h.alias("h"), "row_id", "doc_id", "size", "p").alias("unit")
    waits = F.pmod(F.xxhash64(F.lit(seed), "size", "doc_id", "row_id"), F.ceil(F.col("n") / LADDER)) == 0
    ladder = due.where(F.col("open") & waits).select(*constants, fields)
    units = (due.where(F.col("open") & ~waits)
             .withColumn("block", F.pmod(h, F.ceil(F.col("n") / FAN))).select(*constants, "block", fields))

    def decided(settled: DataFrame) -> DataFrame:
        return (settled.select(*constants, F.explode("s.done").alias("x"))
                .select("x.row_id", "x.doc_id", "x.size", *constants, "x.up"))

    blocks = largest if largest > LADDER else 0
    while blocks > 1:
        folded = units.groupBy(*constants, "block").agg(F.array_sort(F.collect_list("unit")).alias("units"))
        settled = written(folded.withColumn("s", F.expr(_pivot("units", seed))).select(*constants, "block", "s"), "mix-level")
        out = out.unionByName(decided(settled))
        units = settled.where("s.r is not null").select(
            *constants, F.floor(F.col("block") / FAN).alias("block"), F.col("s.r").alias("unit"))
        blocks = -(-blocks // FAN)

    top = (units.select(*constants, "unit").unionByName(ladder).groupBy(*constants)
           .agg(F.array_sort(F.collect_list("unit")).alias("units")))
    draws = F.expr(f"""
        transform(sequence(0, {DRAWS - 1}), t -> element_at(transform(array({_pivot("units", f"{seed}, t")}),
          s -> element_at(transform(array(coalesce(if({uniform(f"{seed}, t", "s.r.doc_id", "s.r.size")} < s.r.p, 1, 0), 0)),
            up -> named_struct('off', coalesce(abs(up - s.r.p) * s.r.size, 0D), 't', t, 'done',
              if(s.r is null, s.done, concat(s.done, array(named_struct(
                'row_id', s.r.row_id, 'doc_id', s.r.doc_id, 'size', s.r.size, 'up', up)))))), 1)), 1))""")
    best = top.withColumn("s", F.array_min(draws))
    out = out.unionByName(decided(best))
    return (out.withColumn("copies", F.col("base") + F.col("up"))
            .select("row_id", "doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed_documents(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The documents of a mix: each row as often as it was taken. ``docs``
    must be a scan of stored files (its rows are numbered twice)."""
    row, copies, copy = (free_name(docs.columns, f"corpus_{x}") for x in ("row", "copies", "copy"))
    taken = mix(docs, weights, share, most, seed).where("copies > 0").select(F.col("row_id").alias(row), F.col("copies").alias(copies))
    return (numbered(docs, row).join(taken, row)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .drop(row, copies, copy))
