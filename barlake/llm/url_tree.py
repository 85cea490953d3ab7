"""URL filtering by rules and by a tree of path templates.

Rules judge first, the longest that fits. They also label pages, and from these labels each host's tree learns to judge
its other pages: path segments lose their numbers, a segment that takes almost as many values as it has pages becomes a
wildcard, and a branch whose share of blocked pages does not differ significantly from its parent's is merged into it.
Pages without a label count as not blocked, so a branch that no rule speaks of stands apart from blocked siblings as soon as
it has the pages to show it. What remains are templates. Each has a purity, the share of blocked among its pages, smoothed
towards the share among all pages. Templates of a purity of ``REJECT`` or more are rejected if a page of theirs is blocked,
so a host without blocked pages is allowed.

Pages are reduced to one row per host and path shape, combined before the shuffle; the tree works on these. Only
DataFrame functions are used. A null url has an empty host and path; repeated rows count each and are judged alike;
without any label nothing is rejected. A null page_id is judged like any other, and so is a path of any length, whose segments from
the third on are one. Only url and page_id are read. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from barlake.llm.common import join_hot, stored

Rule = tuple[str, str, str]  # verdict, host, path
DEPTH, FEW_VALUES, VARIABLE = 3, 16, 0.5
SIGNIFICANT, SMOOTHING, REJECT = 1.96, 4.0, 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict. ``rules`` is a short list that goes into the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _sums(leaves: DataFrame, key: str, suffix: str) -> DataFrame:
    return leaves.groupBy(key).agg(
        F.sum("pages").alias(f"pages{suffix}"), F.sum("blocked").alias(f"blocked{suffix}"), F.count("*").alias(f"leaves{suffix}"),
    )


def _key(level: int) -> Column:
    return F.concat_ws("/", "host", *[f"s{i}" for i in range(1, level + 1)])


def path_templates(parts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """host, shape, pages, template, and purity and blocked pages of the template, one row per host and path shape.

    ``parts`` has host, path and label (1 blocked, 0 allowed, null unknown). Segments beyond ``depth`` form one.
    """
    shaped = parts.select("host", "label", F.regexp_replace("path", "[0-9]+", "#").alias("shape"))
    leaves = shaped.groupBy("host", "shape").agg(
        F.count("*").alias("pages"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")
    )
    segments = F.filter(F.split("shape", "/"), lambda s: s != "")
    leaves = leaves.withColumn("_segments", segments)
    for i in range(1, depth + 1):
        one = F.get("_segments", F.lit(i - 1)) if i < depth else F.array_join(F.slice("_segments", depth, F.greatest(F.size("_segments"), F.lit(1))), "/")
        leaves = leaves.withColumn(f"s{i}", F.coalesce(one, F.lit("")))
    leaves = stored(leaves.drop("_segments"), "url-leaves")
    count, all_pages, all_blocked = leaves.agg(F.count("*"), F.sum("pages"), F.sum("blocked")).first()

    for i in range(1, depth + 1):
        keyed = leaves.withColumn("_key", _key(i - 1))
        values = keyed.groupBy("_key", f"s{i}").agg(F.sum("pages").alias("_pages"), F.count("*").alias("_leaves"))
        wide = values.groupBy("_key").agg(
            F.count("*").alias("_values"), F.sum("_pages").alias("_pages"), F.sum("_leaves").alias("_leaves")
        ).where((F.col("_values") >= FEW_VALUES) & (F.col("_values") > VARIABLE * F.col("_pages"))).select("_key", "_leaves")
        met = join_hot(keyed, wide, "_key", "_leaves", count, ["shape"])
        leaves = stored(
            met.withColumn(f"s{i}", F.when(F.col("_leaves").isNotNull(), "*").otherwise(F.col(f"s{i}"))).drop("_key", "_leaves"),
            "url-wild",
        )

    for i in range(depth + 1):
        keyed = leaves.withColumn("_key", _key(i))
        leaves = join_hot(keyed, _sums(keyed, "_key", f"_{i}"), "_key", f"leaves_{i}", count, ["shape"])
        leaves = stored(leaves.drop("_key", f"leaves_{i}"), "url-sums")
    level = F.lit(0)
    for i in range(1, depth + 1):
        own, parent = F.col(f"blocked_{i}") / F.col(f"pages_{i}"), (F.col(f"blocked_{i - 1}") + 1.0) / (F.col(f"pages_{i - 1}") + 2.0)
        apart = F.abs(own - parent) >= SIGNIFICANT * F.sqrt(parent * (1.0 - parent) / F.col(f"pages_{i}"))
        level = F.when(apart, F.lit(i)).otherwise(level)
    named = leaves.withColumn("_level", level)
    template = F.lit(None).cast("string")
    for i in range(depth + 1):
        template = F.when(F.col("_level") == i, F.concat(_key(i), F.lit("/**" if i < depth else ""))).otherwise(template)
    named = named.withColumn("template", template)
    pooled = join_hot(named, _sums(named, "template", "_t"), "template", "leaves_t", count, ["shape"])
    prior = all_blocked / all_pages if all_pages else 0.0
    purity = (F.col("blocked_t") + F.lit(SMOOTHING) * F.lit(prior)) / (F.col("pages_t") + SMOOTHING)
    return pooled.select("host", "shape", "pages", "template", purity.alias("purity"), F.col("blocked_t").alias("blocked"))


def judge_pages(pages: DataFrame, rules: Sequence[Rule], reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict and the template that judges where no rule does."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "_says": says})
    parts = parts.withColumn("label", F.when(F.col("_says") == "block", 1).when(F.col("_says") == "allow", 0))
    key = F.concat_ws("/", "host", F.regexp_replace("path", "[0-9]+", "#"))
    templates = stored(path_templates(parts), "url-templates").select(
        F.concat_ws("/", "host", "shape").alias("_key"), "pages", "template", "purity", "blocked"
    )
    total = pages.count()
    judged = join_hot(parts.withColumn("_key", key), templates, "_key", "pages", total, ["page_id"])
    learnt = F.when((F.col("purity") >= reject) & (F.col("blocked") > 0), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_says", learnt).alias("verdict"), "template")
