"""URL filter by a path-template tree (operator 9).

Explicit rules come first; the longest rule that fits decides.  All other URLs
are judged by the template they fall under.

Per host, paths form a tree of segments.  Runs of digits in a segment are one
shape, and equal shaped paths of a host are counted together, before any
shuffle, with the labelled good and bad rows among them.  Level by level from
the root, each node's children are then generalised:

* statistically similar branches merge into a wildcard: a child stays apart
  only where its labelled bad share is above its siblings' by Z standard errors;
* a variable level - more than MAX_CHILDREN different children - turns its
  rare children into the same wildcard, unless their labels would be as
  unlikely as Z standard errors by the binomial bound too: of many small
  children some have their one or two labels bad by chance.

Levels below TREE_DEPTH are judged alike, as long as some node there has good and
bad labels on different paths (elsewhere no child can stay apart), and what follows the last branch kept apart there is one wildcard.  What remains of
a path is its template.  A template is rejected when its bad share, smoothed towards its
host's and that towards all hosts', reaches REJECT.

Everything is DataFrame functions.  The tree is built from the counted paths;
rows meet it in one equi-join on host and shaped path.

A null URL, or one without ``://``, has an empty host and path and is judged
like any other; repeated rows are judged alike.  Unlabelled tables reject nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.llm.common import lower_ascii, settle

TREE_DEPTH = 8
MAX_CHILDREN = 16
Z = 3.0
TAIL = 0.00135   # probability above Z standard errors
REJECT = 0.5
TEMPLATE_PRIOR = 10.0
HOST_PRIOR = 50.0
# (action, host and path)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.call_function("substring", url, F.instr(url, "://") + 3)).otherwise("")
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, null where none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), r[0])):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def shaped(path: Column) -> Column:
    """The path's non-empty segments with runs of digits as one shape."""
    return F.array_remove(F.split(F.regexp_replace(path, r"[0-9]+", "<n>"), "/"), "")


def _share(bad: Column, n: Column, prior: Column, weight: float) -> Column:
    return (bad + prior * weight) / (n + weight)


def template_tree(paths: DataFrame) -> DataFrame:
    """host, shape, template, and its smoothed bad share, from counted paths.

    ``paths``: host, shape, n, labelled, bad.
    """
    tree = settle(paths.withColumn("segments", F.split("shape", "/")).withColumn("template", F.lit(""))
                  .withColumn("last", F.lit(0)), "url-paths")
    size = F.size("segments")
    deepest, deepest_bad = tree.agg(F.max(size), F.max(F.when(F.col("bad") > 0, size))).first()
    # Without bad labels no child is apart.
    for depth in range(min(deepest or 0, max(TREE_DEPTH, deepest_bad or 0))):
        here = tree.filter(F.size("segments") > depth).withColumn("segment", F.col("segments")[depth])
        nodes = here.groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        parents = nodes.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kids"), F.sum("n").alias("pn"), F.sum("l").alias("pl"), F.sum("b").alias("pb"))
        judged = nodes.join(parents.withColumnsRenamed({"host": "_h", "template": "_t"}),
                            (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")))
        rare = (F.col("kids") > MAX_CHILDREN) & (F.col("n") * MAX_CHILDREN < F.col("pn"))
        others, pooled = F.col("pl") - F.col("l"), F.col("pb") / F.greatest("pl", F.lit(1))
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest("l", F.lit(1)) + 1 / F.greatest(others, F.lit(1))))
        share = F.col("b") / F.greatest("l", F.lit(1))
        gap = share - (F.col("pb") - F.col("b")) / F.greatest(others, F.lit(1))
        expected = (F.col("pb") - F.col("b") + 1) / (others + 2)
        surprise = F.col("l") * (share * F.log(share / expected)
                                 + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - expected))).otherwise(0.0))
        unlikely = (share > expected) & (surprise >= -math.log(TAIL))
        apart = (F.col("l") > 0) & (others > 0) & (error > 0) & (gap >= error * Z) & (~rare | unlikely)
        named = judged.select(F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("segment").alias("_s"),
                              F.concat("template", F.lit("/"), F.when(apart, F.col("segment")).otherwise("*")).alias("_next"),
                              F.when(apart, depth + 1).alias("_last"))
        segment = F.get(F.col("segments"), F.lit(depth))
        tree = settle(tree.join(named, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (segment == F.col("_s")), "left")
                      .withColumn("template", F.coalesce("_next", "template")).withColumn("last", F.coalesce("_last", "last"))
                      .drop("_h", "_t", "_s", "_next", "_last"), "url-tree")
        if depth + 1 >= TREE_DEPTH:
            # A child can stay apart only where good and bad labels lie on different paths.
            below = tree.filter(F.size("segments") > depth + 1).groupBy("host", "template").agg(
                F.count_if(F.col("labelled") > 0).alias("paths"), F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
            if below.filter("paths > 1 and b > 0 and b < l").isEmpty():
                break
    kept = F.greatest("last", F.lit(TREE_DEPTH))
    head = F.array_join(F.slice(F.split("template", "/"), F.lit(1), kept + 1), "/")
    tree = tree.withColumn("template", F.when(size > kept, F.concat(head, F.lit("/**"))).otherwise(F.col("template")))
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb"))
    every = hosts.agg(F.sum("hl").alias("al"), F.sum("hb").alias("ab")).first()
    overall = (every["ab"] or 0) / max(1, every["al"] or 0)
    hosts = hosts.select(F.col("host").alias("_h"), _share(F.col("hb"), F.col("hl"), F.lit(overall), HOST_PRIOR).alias("prior"))
    templates = tree.groupBy("host", "template").agg(F.sum("labelled").alias("tl"), F.sum("bad").alias("tb"))
    templates = templates.join(hosts, F.col("host") == F.col("_h")).select(
        F.col("host").alias("_h"), F.col("template").alias("_t"),
        _share(F.col("tb"), F.col("tl"), F.col("prior"), TEMPLATE_PRIOR).alias("bad_share"))
    return tree.join(templates, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t"))).select(
        "host", "shape", "template", "bad_share")


def filter_urls(pages: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """Verdict on every row of ``pages`` (page_id, url).

    ``labelled``: page_id and bad (boolean); rows of a page_id are combined (bad
    if any is).  Returns page_id, host, path, rule, verdict, template, bad_share.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shape", F.array_join(shaped(F.col("path")), "/"))
    marks = labelled.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("_bad")).withColumnRenamed("page_id", "_id")
    counted = (rows.join(marks, F.col("page_id") == F.col("_id"), "left").groupBy("host", "shape")
               .agg(F.count(F.lit(1)).alias("n"), F.count("_bad").alias("labelled"),
                    F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")))
    tree = settle(template_tree(counted), "url-templates").withColumnsRenamed({"host": "_h", "shape": "_s"})
    rule, action = matched(F.col("host"), F.col("path"), rules)
    return (rows.join(tree, (F.col("host") == F.col("_h")) & (F.col("shape") == F.col("_s")), "left")
            .withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(action, F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "template", "bad_share"))
