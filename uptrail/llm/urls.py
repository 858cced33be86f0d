"""URL filters: fixed rules by host and path, and rules mined from labels with FP-growth."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import written


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block


def lower_ascii(c: F.Column) -> F.Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: F.Column) -> F.Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; without ://, empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: F.Column) -> F.Column:
    """After the host up to ?, # or the end; without ://, empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: F.Column, path: F.Column, rules: list[Rule]) -> F.Column:
    """The longest rule that fits, as a struct (rule, verdict); null where none does. The rules are
    a parameter, so they are part of the plan."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(len(r.host + r.path)).alias("length"), F.lit(r.host + r.path).alias("rule"),
                            F.lit(r.verdict).alias("verdict"))) for r in rules]
    if not fits:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return fits[0] if len(fits) == 1 else F.greatest(*fits)


def items_of(url: F.Column) -> F.Column:
    """The tokens of a URL, each once: words of the host, words of the path, names of parameters."""
    tagged = lambda tag, parts: F.transform(parts, lambda x: F.concat(F.lit(tag), lower_ascii(x)))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    every = F.concat(tagged("h:", F.split(host_of(url), r"[.\-_]")), tagged("p:", F.split(path_of(url), r"[/.\-_]")),
                     tagged("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(F.filter(every, lambda x: F.length(x) > 2))).otherwise(
        F.array().cast("array<string>"))


BAD = "label:bad"


def mined(labelled: DataFrame, url: str, bad: str, min_support: float, min_rows: int, min_confidence: float) -> DataFrame:
    """rule, size, item: one row for each token of each rule "these tokens, then bad".

    FP-growth finds the frequent sets of tokens over all labelled rows. A rule stays if its rows are
    at least min_rows and that share of all, its confidence reaches the threshold, and no rule on a part of its tokens has as high a confidence.
    Rows without a URL or label are not labelled rows.
    """
    rows = labelled.where(F.col(url).isNotNull() & F.col(bad).isNotNull())
    baskets = rows.select(F.when(F.col(bad), F.array_append(items_of(F.col(url)), BAD))
                          .otherwise(items_of(F.col(url))).alias("items"))
    baskets = written(baskets, "url-baskets")  # FP-growth reads its input several times
    support = max(min_support, min_rows / max(1, baskets.count()))
    if support > 1:
        return baskets.sparkSession.createDataFrame([], "rule string, size int, item string")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BAD)).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = written(rules, "url-rules")
    # every rule against those on one token less: they are looked up by their tokens
    size = F.size("tokens")
    parts = rules.where(size > 1).select("tokens", "confidence", F.explode(
        F.transform(F.sequence(F.lit(1), size), lambda i: F.array_sort(F.array_except(
            "tokens", F.array(F.element_at("tokens", i)))))).alias("part"))
    smaller = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("c"))
    weak = parts.join(smaller, "part").where("c >= confidence").select("tokens").distinct()
    kept = rules.join(weak, "tokens", "left_anti")
    return kept.select(F.md5(F.concat_ws("\n", "tokens")).alias("rule"), F.size("tokens").alias("size"),
                       F.explode("tokens").alias("item"))


def blocked_urls(urls: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """The URLs on which a mined rule fits, each once. The rules' inverted index (token to rules) is
    joined to the tokens of each distinct URL; a rule fits if all its tokens were met."""
    distinct = urls.where(F.col(url).isNotNull()).select(F.col(url).alias("_url")).distinct()
    tokens = distinct.select("_url", F.explode(items_of(F.col("_url"))).alias("item"))
    met = tokens.join(rules, "item").groupBy("_url", "rule", "size").agg(F.count("*").alias("n"))
    return met.where("n = size").select("_url").distinct()


def judged(pages: DataFrame, labelled: DataFrame, fixed: list[Rule], url: str = "url", bad: str = "bad",
           min_support: float = 0.002, min_rows: int = 20,
           min_confidence: float = 0.8) -> DataFrame:
    """The pages with host, path, rule and verdict; columns of those names are replaced.

    A fixed rule decides first, the longest that fits. Else the page is blocked if a mined rule
    fits. A null URL, or one without ://, has empty host and path and is allowed. Repeated URLs are
    mined as often as they occur and judged once. Without labelled rows nothing is mined.
    """
    named = pages.drop("host", "path", "rule", "verdict")
    rules = mined(labelled, url, bad, min_support, min_rows, min_confidence)
    blocked = written(blocked_urls(named, url, rules), "url-blocked").withColumnRenamed("_url", "_urls_blocked")
    own = F.col(url)
    out = named.join(blocked, named[url] == F.col("_urls_blocked"), "left")
    out = out.withColumns({"_urls_host": host_of(own), "_urls_path": path_of(own)})
    out = out.withColumn("_urls_fixed", rule_of(F.col("_urls_host"), F.col("_urls_path"), fixed))
    method = F.when(F.col("_urls_blocked").isNotNull(), "block").otherwise("allow")
    return out.select(*named.columns, F.col("_urls_host").alias("host"), F.col("_urls_path").alias("path"),
                      F.col("_urls_fixed.rule").alias("rule"), F.coalesce(F.col("_urls_fixed.verdict"), method).alias("verdict"))
