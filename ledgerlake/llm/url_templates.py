"""URL filter by a path-template tree per host.

A path is first reduced to its shape: numbers, hexadecimal names and the like
become typed wildcards.  Per host the shapes form a tree of segments.  Level
by level, children of a node that are rare, or whose labelled purity does not
differ significantly from their siblings' (two-proportion test), are merged
into a wildcard; children that do differ keep a branch.  A leaf of the
resulting tree is a template; its purity is its share of good labels, smoothed
towards its parent's, and templates below the limit are rejected.  Given host
and path rules come first, the longest that fits.

Only DataFrame functions are used.  Pages are aggregated to shapes before any
work on the tree, so a host with a third of all pages is a few hundred rows;
only the last join carries pages, keyed by host and shape.  The tree is as
deep as the paths; a shape that is alone in its node needs no more levels (its
remaining segments are the template), so there are as many rounds as two
different shapes of a host share segments.

Defined results: a null url or one without ``://`` has empty host and path;
pages without a label count for support only; several labels of a page count
as their mean; templates without labels fall back to the parent's purity, hosts
without labels to that of all pages, and without any label all is allowed;
repeated and null page ids are separate rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import written

#: A child with fewer pages than this, and less than this share of its node, is rare.
RARE, RARE_SHARE = 20, 0.005
#: Difference of a child's purity from its siblings', in standard errors.
DIFFERENT = 3.0
#: Labels that a parent's purity counts for.
SMOOTH = 8.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (verdict, ``host/path``) that fits, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """Segments of a path with typed wildcards for variable names."""
    def typed(x):
        x = F.regexp_replace(x, "^(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{12,}", "{hex}")
        return F.regexp_replace(x, "[0-9]+", "{n}")
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), typed)


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, pages, labelled, good) -> host, shape,
    template, purity."""
    spark = shapes.sparkSession
    whole = shapes.agg(F.sum("labelled").alias("n"), F.sum("good").alias("g")).first()
    overall = (whole.g or 0.0) / whole.n if whole.n else 1.0

    def smoothed(good, labelled, parent):
        return (good + SMOOTH * parent) / (labelled + SMOOTH)
    root = shapes.groupBy(F.col("host").alias("h")).agg(smoothed(F.sum("good"), F.sum("labelled"), F.lit(overall)).alias("purity"))
    at = shapes.withColumn("template", F.lit("")).join(root, F.col("host") == F.col("h")).drop("h")
    columns = [*shapes.columns, "purity", "template"]
    done, level = None, 0
    while True:
        # shapes that are alone in their node, or end here, are settled
        in_node = at.groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(F.count("*").alias("many"))
        at = at.join(in_node, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))).drop("h", "t")
        left = F.size("shape") - level
        # every further level would smooth towards the one before: in closed form
        own = F.try_divide("good", "labelled")
        pull = F.pow(F.lit(SMOOTH) / (F.col("labelled") + SMOOTH), left)
        rest = F.array_join(F.expr(f"slice(shape, {level + 1}, size(shape) - {level})"), "/")
        settled = at.where((F.col("many") == 1) | (left <= 0)).withColumn(
            "purity", F.when(left > 0, F.coalesce(own + pull * (F.col("purity") - own), "purity")).otherwise(F.col("purity"))).withColumn(
            "template", F.when(left > 0, F.concat("template", F.lit("/"), rest)).otherwise(F.col("template")))
        settled = written(spark, settled.select(columns), "url-settled")
        done = settled if done is None else done.unionByName(settled)
        at = written(spark, at.where((F.col("many") > 1) & (left > 0)).select(columns), "url-open")
        if at.isEmpty():
            return done.select("host", "shape", "template", "purity")
        seg = F.get("shape", F.lit(level))
        child = (at.where(F.size("shape") > level).groupBy("host", "template", seg.alias("seg"))
                 .agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("n"), F.sum("good").alias("g"), F.max("purity").alias("up")))
        whole_node = child.groupBy("host", "template").agg(F.sum("pages").alias("all_pages"), F.sum("n").alias("all_n"), F.sum("g").alias("all_g"))
        child = child.join(whole_node, ["host", "template"])
        rest_n, rest_g = F.col("all_n") - F.col("n"), F.col("all_g") - F.col("g")
        pooled = F.try_divide("all_g", "all_n")
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.lit(1.0), rest_n)))
        z = F.try_divide(F.abs(F.try_divide("g", "n") - F.try_divide(rest_g, rest_n)), error)  # null: no labels to compare
        rare = (F.col("pages") < RARE) & (F.col("pages") < RARE_SHARE * F.col("all_pages"))
        alone = F.col("pages") == F.col("all_pages")
        keep = alone | (~rare & F.coalesce(z >= DIFFERENT, F.lit(False)))
        branch = child.select("host", "template", "seg", "n", "g", "up", F.when(keep, F.col("seg")).otherwise("*").alias("branch"))
        merged = branch.groupBy("host", "template", "branch").agg(
            smoothed(F.sum("g"), F.sum("n"), F.max("up")).alias("own"))
        step = branch.select("host", "template", "seg", "branch").join(merged, ["host", "template", "branch"])
        step = step.select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("seg").alias("s"), "branch", "own")
        at = at.join(step, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (seg == F.col("s")), "left")
        at = at.withColumn("template", F.when(F.col("branch").isNull(), F.col("template"))
                           .otherwise(F.concat("template", F.lit("/"), "branch")))
        at = written(spark, at.withColumn("purity", F.coalesce("own", "purity")).select(columns), "url-tree")
        level += 1


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], least: float = 0.5) -> DataFrame:
    """``pages`` (page_id, url), ``labels`` (page_id, good 0..1) -> page_id,
    host, path, rule, verdict, template, purity."""
    spark = pages.sparkSession
    host, path = parse(F.col("url"))
    parsed = (pages.select("page_id", host.alias("host"), path.alias("path"))
              .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", shape(F.col("path"))))
    known = labels.where("good is not null and page_id is not null").groupBy(F.col("page_id").alias("labelled_id")).agg(
        F.avg("good").alias("good"))
    shapes = (parsed.join(known, F.col("page_id") == F.col("labelled_id"), "left")
              .groupBy("host", "shape").agg(F.count("*").alias("pages"), F.count("good").alias("labelled"),
                                            F.coalesce(F.sum("good"), F.lit(0.0)).alias("good")))
    tree = templates(written(spark, shapes, "url-shapes"))
    tree = tree.select(F.col("host").alias("h"), F.col("shape").alias("s"), "template", "purity")
    verdicts = dict((rule, verdict) for verdict, rule in rules)
    given = F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv])[F.col("rule")] if rules else F.lit(None).cast("string")
    return (parsed.join(tree, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(given, F.when(F.col("purity") < least, "block").otherwise("allow")).alias("verdict"),
                    "template", "purity"))
