"""URL filtering by rules and path-template trees.

A url that a rule fits takes the rule's verdict. The others are judged by
templates: the paths of each host form a tree, level by level. At a node, a
segment stays as it is if its share of bad labels differs from that of the rest
of the node: by a likelihood-ratio test at ``Z`` standard errors, corrected for
the number of segments tested at the node (those with ``MIN_LABELS`` labels or
more). All others, however many urls they have, become the wildcard ``*``. A
template with enough bad labels, smoothed toward the share of all labels, is
rejected: its urls are blocked.

The tree grows by aggregations and joins on (host, template, segment), down to
the last segment of any node whose labels still differ; below a node whose
labels are all alike or too few nothing can split, so all is wildcards there.

Defined results: a null url, or one without ``://``, has an empty host and
path, and no rule fits it; without labels everything else is allowed; a null
label counts as none; repeated urls and ids are judged one by one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

MIN_LABELS = 3
Z = 3.0
#: Levels that are added to the urls in one plan.
AT_ONCE = 8
#: Pseudo-labels toward the share of bad labels everywhere.
SMOOTH = 8.0
PURITY = 0.5
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str = "url") -> Column:
    host = F.regexp_extract(F.col(url), r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWERED), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (``host/path``) that fits, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _extended(rows: DataFrame, literal: DataFrame) -> DataFrame:
    """Adds ``segment`` (null where the path has ended) to the templates."""
    kept = rows.join(literal.withColumn("literal", F.lit(True)), ["host", "template", "segment"], "left")
    part = F.when(F.col("literal"), F.col("segment")).otherwise(F.lit("*"))
    return (kept.withColumn("template", F.when(F.col("segment").isNull(), F.col("template"))
                            .otherwise(F.concat("template", F.lit("/"), part))).drop("segment", "literal"))


def _literals(labelled: DataFrame) -> list[DataFrame]:
    """For each level the segments (host, template, segment) that stay, from
    rows with host, segments and bad."""
    out: list[DataFrame] = []
    rows = labelled.withColumn("template", F.lit(""))
    while True:
        rows = (rows.where(F.size("segments") > len(out))
                .withColumn("segment", F.element_at("segments", len(out) + 1)))
        nodes = written(rows.groupBy("host", "template", "segment")
                        .agg(F.count("*").alias("m"), F.sum(F.col("bad").cast("long")).alias("b")), "nodes")
        mixed = written(nodes.groupBy("host", "template")
                        .agg(F.sum("m").alias("pm"), F.sum("b").alias("pb"), F.sum((F.col("m") >= MIN_LABELS).cast("long")).alias("tests"))
                        .where((F.col("pb") > 0) & (F.col("pb") < F.col("pm")) & (F.col("pm") > MIN_LABELS)), "mixed")
        if mixed.isEmpty():
            return out
        m, b, pm, pb = (F.col(c).cast("double") for c in ("m", "b", "pm", "pb"))

        def part(seen: Column, rows: Column, share: Column) -> Column:
            return F.when(seen > 0, seen * F.log(seen / (rows * share))).otherwise(0.0)

        ratio = 2 * (part(b, m, pb / pm) + part(m - b, m, 1 - pb / pm) + part(pb - b, pm - m, pb / pm) + part(pm - m - pb + b, pm - m, 1 - pb / pm))
        out.append(written(nodes.where(F.col("m") >= MIN_LABELS).join(mixed, ["host", "template"])
                           .where((m < pm) & (ratio > Z * Z + 2 * F.log(F.col("tests")))).select("host", "template", "segment"), "literals"))
        rows = written(_extended(rows.join(mixed.select("host", "template"), ["host", "template"], "left_semi"), out[-1]), "labelled")


def judge(pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None) -> DataFrame:
    """Per (page_id, url) row: page_id, host, path, rule, verdict, template,
    purity (smoothed share of good labels). ``labels`` has page_id and bad."""
    rows = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict)
    if labels is None:
        rows = rows.withColumn("bad", F.lit(None).cast("boolean"))
    else:
        rows = rows.join(labels.where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad")), "page_id", "left")
    rows = written(rows.withColumn("segments", F.array_remove(F.split("path", "/"), "")).withColumn("template", F.lit("")), "urls")
    known = rows.agg(F.avg(F.col("bad").cast("double")).alias("share")).first()["share"] or 0.0
    literals = _literals(rows.where("bad is not null").select("host", "segments", "bad"))
    for level, literal in enumerate(literals, start=1):
        rows = _extended(rows.withColumn("segment", F.try_element_at("segments", F.lit(level))), literal)
        if level % AT_ONCE == 0:
            rows = written(rows, "grown")
    rest = F.greatest(F.size("segments") - len(literals), F.lit(0))
    rows = written(rows.withColumn("template", F.concat("template", F.repeat(F.lit("/*"), rest))), "templates")
    purity = (rows.groupBy("host", "template").agg(F.count("bad").alias("m"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("b"))
              .select("host", "template", (1 - (F.col("b") + SMOOTH * known) / (F.col("m") + SMOOTH)).alias("purity")))
    method = F.when(F.col("purity") < PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return (rows.join(purity, ["host", "template"])
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "template", "purity"))
