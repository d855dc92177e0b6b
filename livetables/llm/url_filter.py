"""URL filter: per host, a tree of path templates whose branches carry the rules' labels.

Rules (host, path, verdict) label the urls they fit. The rest is judged by the
template the url falls under:

1. Each path segment is generalised lexically: runs of digits become `#`.
2. Urls are counted by (host, generalised path) with their labels; from here on
   only this table of paths is worked on, level by level:
   - a labelled segment with few urls below it (`min_support`), or whose share of
     blocked urls does not differ from that of all its siblings (two-proportion
     z-test), is merged into the branch `*`;
   - an unlabelled segment joins `*` if it is like the labelled segments there in
     what needs no label: the same shape (letters alike), and shares of the shapes
     that follow it which don't differ from theirs (two-proportion z-test each);
   - other unlabelled segments with few urls share a branch of their own, `?`, so
     that no label reaches urls that show no evidence.
3. A template's purity is its share of blocked among labelled urls, smoothed by
   `prior_weight` urls of which the share `prior` is blocked. Purity of at least
   `reject_at` rejects the template, so one without labels is allowed.

Plan. One scan folds the urls into the path table (partial aggregate, so a hot
host costs a row per path and task); a second scan joins each url to its path's
verdict. That table is written, so Spark knows its size: small ones are
broadcast, and AQE splits a hot (host, path) otherwise.

Defined results: a null url, or one without `://`, has an empty host and path
and is one template of its own; paths deeper than `levels` share the template
of their first `levels` segments; repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livetables.llm.common import col, written

Rule = tuple[str, str, str]        # host, path, "allow" or "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0,
                  url.substr(F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none fits. Rules are a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def segments(path: Column, levels: int) -> Column:
    """The first `levels` segments, digits generalised; `**` stands for deeper ones."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, r"^/", ""), r"[0-9]+", "#"), "/")
    return F.when(F.size(parts) > levels, F.concat(F.slice(parts, 1, levels), F.array(F.lit("**")))).otherwise(parts)


def shape(seg: Column) -> Column:
    """What of a segment needs no label: runs of letters become `a`."""
    return F.regexp_replace(seg, r"\p{L}+", "a")


def path_templates(paths: DataFrame, levels: int, *, min_support: int, z: float) -> DataFrame:
    """host, key (segments), n, n_allow, n_block -> the same with `template`."""
    rows = paths.withColumn("template", F.lit(""))
    lab, n = F.col("c_block") + F.col("c_allow"), F.col("n")
    rate, p = F.try_divide("c_block", lab), F.try_divide(F.col("p_block"), F.col("p_block") + F.col("p_allow"))
    differs = F.coalesce((F.col("support") >= min_support) & (F.abs(rate - p) > z * F.sqrt(F.try_divide(p * (1 - p), lab))), F.lit(False))
    # An unlabelled branch against the labelled ones in `*`, by the shapes that follow.
    own, star = F.try_divide("own_next", F.col("support")), F.try_divide("star_next", F.col("star"))
    both = F.try_divide(F.col("own_next") + F.col("star_next"), F.col("support") + F.col("star"))
    apart = F.abs(own - star) > z * F.sqrt(both * (1 - both) * (F.try_divide(F.lit(1), F.col("support")) + F.try_divide(F.lit(1), F.col("star"))))
    for level in range(1, levels + 1):
        after = F.coalesce(shape(F.try_element_at(F.col("key"), F.lit(level + 1))), F.lit("/"))
        siblings = Window.partitionBy("host", "template")
        child = Window.partitionBy("host", "template", "seg")
        alike = Window.partitionBy("host", "template", "shape")
        in_star = F.when((lab > 0) & ~F.col("differs"), n).otherwise(0)
        name = (F.when(lab > 0, F.when(F.col("differs"), F.col("seg")).otherwise(F.lit("*")))
                .when(F.col("joins"), F.lit("*")).when(F.col("support") >= min_support, F.col("seg")).otherwise(F.lit("?")))
        rows = (rows.withColumn("seg", F.try_element_at(F.col("key"), F.lit(level)))
                .withColumn("shape", shape(F.col("seg"))).withColumn("next", after)
                .withColumn("support", F.sum("n").over(child))
                .withColumn("c_allow", F.sum("n_allow").over(child))
                .withColumn("c_block", F.sum("n_block").over(child))
                .withColumn("p_allow", F.sum("n_allow").over(siblings))
                .withColumn("p_block", F.sum("n_block").over(siblings))
                .withColumn("differs", differs)
                .withColumn("star", F.sum(in_star).over(alike))
                .withColumn("star_next", F.sum(in_star).over(Window.partitionBy("host", "template", "shape", "next")))
                .withColumn("own_next", F.sum("n").over(Window.partitionBy("host", "template", "seg", "next")))
                .withColumn("joins", (F.col("star") > 0) & ~F.max(F.coalesce(apart, F.lit(True))).over(child))
                .withColumn("template", F.when(F.col("seg").isNull(), F.col("template"))
                            .otherwise(F.concat("template", F.lit("/"), name)))
                .select("host", "key", "n", "n_allow", "n_block", "template"))
    return rows


def judge_urls(df: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url",
               levels: int = 4, min_support: int = 5, z: float = 1.96, prior: float = 0.2,
               prior_weight: float = 4.0, reject_at: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict, template, purity: one row per row of `df`."""
    host, path = host_and_path(col(url_col).cast("string"))
    urls = df.select(col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, by_rule = longest_rule(F.col("host"), F.col("path"), rules)
    urls = urls.select("id", "host", "path", rule.alias("rule"), by_rule.alias("by_rule"),
                       segments(F.col("path"), levels).alias("key"))
    paths = urls.groupBy("host", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("by_rule") == "allow").alias("n_allow"),
        F.count_if(F.col("by_rule") == "block").alias("n_block"))
    paths = written(path_templates(written(paths, "url-paths"), levels, min_support=min_support, z=z), "url-tree")
    whole = Window.partitionBy("host", "template")
    block, allow = F.sum("n_block").over(whole), F.sum("n_allow").over(whole)
    judged = paths.select("host", "key", "template",
                          ((block + prior_weight * prior) / (block + allow + prior_weight)).alias("purity"))
    verdict = F.when(F.col("purity") >= reject_at, F.lit("block")).otherwise(F.lit("allow"))
    return (urls.join(written(judged, "url-verdicts"), ["host", "key"], "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("by_rule", verdict).alias("verdict"), "template", "purity"))
