"""URL filters: fixed rules first, then a path-template tree learnt from labels (operator 2). DataFrame functions only.

The tree has a node for each template of a host's paths. Level by level a path's segment is replaced by its kind ({num}, {hex}
and the like) if it is variable by form; a literal segment with little support, or whose share of bad labels does not differ from
its siblings' by a two-proportion z test, joins the siblings' merged branch `*`. Templates are judged by purity: the share of
good labels, smoothed towards the host's, which is smoothed towards all hosts'.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hintforge.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path); the host's subdomains are meant too, and the longest rule that fits wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@dataclass(frozen=True)
class TemplateRules:
    #: Levels of the tree at least; see depth.
    levels: int = 3
    #: Pages that a literal branch needs, and the z score from which its labels differ from its siblings'.
    support: int = 20
    z: float = 2.58
    #: Pseudo-labels of the smoothing, and the purity under which a template is rejected.
    weight: float = 10.0
    purity: float = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path as the rules take them; both empty without a scheme."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def kind(segment: Column) -> Column:
    """A segment's form if it is variable by form, else itself; a file's extension stays."""
    dot = F.regexp_extract(segment, r"\.[A-Za-z]{1,5}$", 0)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(dot))
    made = (
        F.when(stem.rlike("^[0-9]+$"), "{num}")
        .when(stem.rlike("^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}")
        .when(stem.rlike("^[0-9a-fA-F-]{16,}$"), "{hex}")
        .when(stem.rlike("[0-9]") & (F.length(stem) > 3), "{mixed}")
        .when(F.length(stem) > 40, "{long}")
        .otherwise(stem)
    )
    return F.concat(made, dot)


def depth(pages: DataFrame, rules: TemplateRules) -> int:
    """Levels that the tree needs: as deep as some host has `support` pages, for beyond it no branch can stand by itself. What lies deeper is one tail."""
    sized = pages.groupBy("host", F.size(segments(F.col("path"))).alias("segments")).agg(F.count("*").alias("n"))
    deeper = Window.partitionBy("host").orderBy(F.desc("segments"))
    reached = sized.withColumn("so_far", F.sum("n").over(deeper)).where(F.col("so_far") >= rules.support)
    return max(rules.levels, reached.agg(F.max("segments")).first()[0] or 0)


def templates(pages: DataFrame, labels: DataFrame, rules: TemplateRules = TemplateRules(), levels: int | None = None) -> DataFrame:
    """host, levels array<string> (the path's first segments by kind), template, purity and n_labelled for each pattern of pages.

    pages(page_id, host, path); labels(doc_id, quality, toxic): a page is good if quality is 1 and it isn't toxic; several labels of
    one page count as bad if any is bad; rows without either label, or a doc_id, don't count.
    """
    levels = levels or depth(pages, rules)
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(bad.cast("int")).alias("bad"))
    patterns = (
        pages.select("page_id", "host", pattern(F.col("path"), levels).alias("levels"))
        .join(marks, "page_id", "left")
        .groupBy("host", "levels")
        .agg(F.count("*").alias("n"), F.count("bad").alias("n_labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad"))
    )
    # node: the template so far; each level is written, as the next reads it several times
    tree = stored(patterns.withColumn("node", F.lit("")), "patterns")
    for level in range(levels):
        tree = tree.withColumn("segment", F.coalesce(F.get("levels", F.lit(level)), F.lit("")))
        sums = [F.sum(c).alias(c) for c in ("n", "n_labelled", "n_bad")]
        children = tree.groupBy("host", "node", "segment").agg(*sums)
        parents = tree.groupBy("host", "node").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "n_labelled", "n_bad")))
        rest_n, rest_bad = F.col("all_n_labelled") - F.col("n_labelled"), F.col("all_n_bad") - F.col("n_bad")
        pooled = F.try_divide("all_n_bad", "all_n_labelled")
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_labelled") + F.try_divide(F.lit(1.0), rest_n)))
        z = F.try_divide(F.try_divide("n_bad", "n_labelled") - F.try_divide(rest_bad, rest_n), spread)
        own = children.where(F.col("n") >= rules.support).join(parents, ["host", "node"])
        own = own.where(F.abs(z) >= rules.z).select("host", "node", "segment", F.lit(True).alias("own"))
        form = F.when(F.col("segment") == "", "").when(F.col("segment").rlike(r"^\{"), F.col("segment")).otherwise("*")
        named = F.when(F.col("own"), F.col("segment")).otherwise(form)
        tree = tree.join(own, ["host", "node", "segment"], "left").withColumn("node", F.concat("node", F.lit("/"), named)).drop("segment", "own")
        tree = stored(tree, "patterns")
    everyone = tree.agg((1 - F.try_divide(F.sum("n_bad"), F.sum("n_labelled"))).alias("all_purity"))
    smooth = lambda good, n, prior: (good + rules.weight * prior) / (n + rules.weight)
    hosts = tree.groupBy("host").agg(F.sum("n_labelled").alias("h_n"), F.sum("n_bad").alias("h_bad")).crossJoin(F.broadcast(everyone))  # one row
    hosts = hosts.select("host", smooth(F.col("h_n") - F.col("h_bad"), F.col("h_n"), F.coalesce("all_purity", F.lit(1.0))).alias("host_purity"))
    nodes = tree.groupBy("host", "node").agg(F.sum("n_labelled").alias("t_n"), F.sum("n_bad").alias("t_bad")).join(hosts, "host")
    nodes = nodes.select("host", "node", "t_n", smooth(F.col("t_n") - F.col("t_bad"), F.col("t_n"), F.col("host_purity")).alias("purity"))
    return tree.select("host", "levels", "node").join(nodes, ["host", "node"]).select("host", "levels", F.col("node").alias("template"), "purity", F.col("t_n").alias("n_labelled"))


def segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/", ""), "/")


def pattern(path: Column, levels: int) -> Column:
    """The path's first segments by kind, one entry a level; the last level also stands for what is deeper."""
    parts = [kind(F.coalesce(F.get(segments(path), F.lit(k)), F.lit(""))) for k in range(levels)]
    deeper = F.when(F.size(segments(path)) > levels, F.concat(parts[-1], F.lit("/**"))).otherwise(parts[-1])
    return F.array(*parts[:-1], deeper)


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, tree: TemplateRules = TemplateRules()) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row for each row of pages(page_id long, url string, ...).

    A null url, or one without "://", has an empty host and path and so no rule; its template is the empty host's. Repeated rows each
    give a row. With no labels at all every template is pure. An empty table gives an empty one; other columns are not read.
    """
    host, path = split_url(F.col("url"))
    split = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    levels = depth(split, tree)
    found = templates(split, labels, tree, levels)
    rows = split.withColumn("rule", name).withColumn("rule_verdict", verdict).withColumn("levels", pattern(F.col("path"), levels))
    learnt = F.when(F.col("purity") < tree.purity, "block").otherwise("allow")
    return rows.join(found, ["host", "levels"], "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", learnt).alias("verdict"), "template", "purity")
