"""URL filter: host and path rules, then path templates learned from them.

Rules give a verdict to part of the urls; those verdicts are the labelled
samples.  For the rest a tree of path templates is built per host: segments
that look like numbers or ids become wildcards by their shape, sibling
branches whose labelled verdicts do not differ statistically are merged into
one wildcard, level by level, and a template is rejected when the share of
blocked among its labelled urls, smoothed towards the share of all, is high.
A template without enough labels is judged by its nearest ancestor on the
host that has them, else by the longest beginning of its shape that has them
over all hosts; roots say nothing about a path and are left out.  Across hosts
the labels must come from several domains, and each domain counts alike, so
what one site blocks says nothing about the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage

#: (host, path, verdict): a rule fits its host and all subdomains.
Rule = tuple[str, str, str]
#: Labelled urls that a branch needs to be compared with others, and the
#: standard deviations from which two rates differ.
MIN_LABELLED, DIFFERENT = 5, 2.0
#: Domains whose labels a shape needs before it is judged across hosts.
MIN_DOMAINS = 2
#: Pseudo-labels of the prior, and the purity from which a template goes.
PRIOR_LABELS, REJECT_PURITY = 4.0, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without "://"."""
    mark = F.instr(url, "://")
    rest = F.coalesce(F.when(mark > 0, F.substr(url, mark + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*+", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule (host and path joined) and its verdict, or null.

    ``rules`` is a short list: it becomes one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = (((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(rule_path)))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Array of a path's segments; numbers, long hexadecimals and long mixes of
    letters and digits become wildcards that keep a file ending."""
    ending = r"(\.[a-z]{1,5})?$"
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), lambda s: (
        F.when(s.rlike(r"^[0-9]+" + ending), F.regexp_replace(s, r"^[0-9]+", "<n>"))
        .when(s.rlike(r"^[0-9a-f-]{12,}" + ending), F.regexp_replace(s, r"^[0-9a-f-]+", "<h>"))
        .when((F.length(s) >= 16) & s.rlike("[0-9]") & s.rlike("[A-Za-z]"), F.lit("<id>"))
        .otherwise(s)))


def _deepest(shapes: DataFrame, keys: Sequence[str], least: int) -> int:
    """The largest depth that ``least`` labelled urls of one group reach; no
    node below it has so many labels."""
    deeper = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(F.desc("depth"))
    # a row per group and depth
    depths = (shapes.filter("n > 0").groupBy(*keys, F.size("shape").alias("depth"))
              .agg(F.sum("n").alias("n")).withColumn("n", F.sum("n").over(deeper)))
    return depths.filter(F.col("n") >= least).agg(F.max("depth")).first()[0] or 0


def domain(host: Column) -> Column:
    """The last two names of a host (no list of public suffixes is read)."""
    return F.substring_index(host, ".", -2)


def _backed_off(nodes: DataFrame, keys: Sequence[str], depth: int, name: str, min_domains: int) -> DataFrame:
    """Labels of the deepest ancestor with MIN_LABELLED of them from
    ``min_domains`` domains, the node itself included, for nodes (keys, domain,
    segments, n, b): struct ``name`` (level, n, b), where b / n is the mean of
    the domains' rates."""
    levels = nodes.filter(F.size("segments") > 0).withColumn("level", F.explode(F.sequence(
        F.lit(1), F.least(F.size("segments"), F.lit(max(depth, 1)))))).withColumn(
        "beginning", F.array_join(F.slice("segments", F.lit(1), F.col("level")), "/"))
    labels = (levels.filter("n > 0").groupBy(*keys, "level", "beginning", "domain").agg(
        F.sum("n").alias("dn"), F.sum("b").alias("db"))
        .groupBy(*keys, "level", "beginning").agg(
        F.sum("dn").alias("ln"), F.avg(F.col("db") / F.col("dn")).alias("rate"),
        F.count(F.lit(1)).alias("domains"))
        .filter((F.col("ln") >= MIN_LABELLED) & (F.col("domains") >= min_domains)))
    return (levels.join(labels, [*keys, "level", "beginning"]).groupBy(*keys, "segments").agg(
        F.max(F.struct("level", F.col("ln").alias("n"), (F.col("rate") * F.col("ln")).alias("b"))).alias(name)))


def path_templates(urls: DataFrame, min_domains: int = MIN_DOMAINS) -> DataFrame:
    """Templates of urls (host, shape, blocked: 1, 0 or null).

    Returns host, shape, template, labelled, blocked: of the template, or of
    what it is judged by if it has too few labels.
    The table of distinct shapes is worked on level by level from the root:
    a node's branches with enough labels are ordered by their rate of blocked,
    and neighbours whose rates do not differ significantly are merged under one
    wildcard ("*", the next such group "*1", ...).  Branches without enough
    labels stay apart and are judged by an ancestor or across hosts.
    """
    shapes = urls.groupBy("host", "shape").agg(
        F.count("blocked").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"))
    shapes = cut_lineage(shapes)
    state = shapes.withColumn("template", F.lit(""))
    node = ["host", "template"]
    # deeper, no node has two branches with enough labels
    compared = _deepest(shapes, ["host"], 2 * MIN_LABELLED)
    for level in range(compared):
        segment = F.get("shape", F.lit(level))
        state = state.withColumn("segment", segment)
        children = state.filter("segment is not null").groupBy(*node, "segment").agg(
            F.sum("n").alias("cn"), F.sum("b").alias("cb"))
        labelled = children.filter(F.col("cn") >= MIN_LABELLED)
        by_rate = Window.partitionBy(*node).orderBy(F.col("cb") / F.col("cn"), "segment")
        before_n, before_b = F.lag("cn").over(by_rate), F.lag("cb").over(by_rate)
        pooled = (F.col("cb") + before_b + 0.5) / (F.col("cn") + before_n + 1)
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("cn") + 1 / before_n))
        differs = F.col("cb") / F.col("cn") - before_b / before_n >= DIFFERENT * spread
        kinds = (labelled.withColumn("differs", F.coalesce(differs, F.lit(False)).cast("int"))
                 .withColumn("kind", F.sum("differs").over(by_rate))
                 .withColumn("alike", F.count(F.lit(1)).over(Window.partitionBy(*node, "kind"))))
        merged = kinds.filter("alike > 1").select(*node, "segment", F.concat(
            F.lit("*"), F.when(F.col("kind") > 0, F.col("kind").cast("string")).otherwise("")
        ).alias("wildcard"))
        state = (state.join(merged, [*node, "segment"], "left")
                 .withColumn("template", F.when(F.col("segment").isNull(), F.col("template"))
                             .otherwise(F.concat("template", F.lit("/"),
                                                 F.coalesce("wildcard", "segment"))))
                 .drop("segment", "wildcard"))
        if level % 2:
            state = cut_lineage(state)
    rest = F.slice("shape", F.lit(compared + 1), F.greatest(F.size("shape") - compared, F.lit(0)))
    state = cut_lineage(state.withColumn("template", F.when(F.size(rest) > 0, F.concat(
        "template", F.lit("/"), F.array_join(rest, "/"))).otherwise(F.col("template"))))
    depth = _deepest(shapes, [], MIN_LABELLED)
    templates = state.groupBy(*node).agg(F.sum("n").alias("n"), F.sum("b").cast("double").alias("b")).withColumn(
        "segments", F.split(F.substr("template", F.lit(2)), "/", -1)).withColumn("domain", domain(F.col("host")))
    on_host = templates.join(_backed_off(templates, ["host"], depth, "near", 1), ["host", "segments"], "left")
    everywhere = _backed_off(
        shapes.groupBy(domain(F.col("host")).alias("domain"), F.col("shape").alias("segments")).agg(
            F.sum("n").alias("n"), F.sum("b").alias("b")),
        [], depth, "far", min_domains).withColumnRenamed("segments", "shape")
    own = F.struct("n", "b")
    judged = F.when(F.col("n") >= MIN_LABELLED, own).otherwise(F.coalesce(
        *[F.when(F.col(c).isNotNull(), F.struct(F.col(c)["n"].alias("n"), F.col(c)["b"].alias("b")))
          for c in ("near", "far")], own))
    return (state.select("host", "shape", "template").join(on_host, node).join(everywhere, "shape", "left")
            .withColumn("judged", judged).select("host", "shape", "template", F.col("judged")["n"].alias("labelled"),
                                                 F.col("judged")["b"].alias("blocked")))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id",
                url_col: str = "url", min_domains: int = MIN_DOMAINS) -> DataFrame:
    """Return page_id, host, path, rule, verdict, template, purity, labelled: a row per row.

    ``verdict`` is the longest fitting rule's, else block for a template whose
    smoothed purity reaches REJECT_PURITY on MIN_LABELLED labels or more, its
    own, an ancestor's or its shape's over all hosts (``labelled``; these from
    ``min_domains`` domains), else allow.  Null urls and urls without "://" have empty host and path, fit no
    rule and are judged like others (host ""); repeated rows are kept; other
    columns are ignored; an empty table gives an empty result.
    """
    host, path = split_url(F.col("url"))
    judged = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
              .withColumn("host", host).withColumn("path", path))
    rule, ruled = match_rule(F.col("host"), F.col("path"), rules)
    judged = (judged.withColumn("rule", rule).withColumn("ruled", ruled)
              .withColumn("shape", shape(F.col("path")))
              .withColumn("blocked", (F.col("ruled") == "block").cast("int")).drop("url"))
    prior = judged.agg(F.coalesce(F.avg("blocked"), F.lit(0.0)).alias("prior"))
    # one row: the share of blocked among all labelled urls
    templates = path_templates(judged, min_domains).crossJoin(F.broadcast(prior)).withColumn(
        "purity", (F.col("blocked") + PRIOR_LABELS * F.col("prior"))
        / (F.col("labelled") + PRIOR_LABELS))
    rejected = (F.col("labelled") >= MIN_LABELLED) & (F.col("purity") >= REJECT_PURITY)
    templates = templates.select("host", "shape", "template", "purity", "labelled",
                                 rejected.alias("rejected"))
    return judged.join(templates, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "purity", "labelled")
