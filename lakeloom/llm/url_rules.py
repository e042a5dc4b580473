"""URL filters: given host rules, then association rules mined from labelled URLs.

Everything runs on DataFrame functions and Spark's FP-growth."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.text import lower_ascii
from lakeloom.session import stage

#: A rule holds for this share of the labelled URLs at least, and for so many of them.
MIN_SUPPORT = 0.001
MIN_COUNT = 20
MIN_CONFIDENCE = 0.8
BLOCK = "@block"

Rule = tuple[str, str, str]  # host, path, "block" or "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL: ``h:`` labels of the host, ``p:`` path segments, both whole
    and by their parts at hyphens (a segment's without the extension), ``x:`` file name extension, ``q:`` parameter names.  Null has none."""
    labels = F.filter(F.split(host_of(url), r"\."), lambda t: t != "")
    segments = F.filter(F.split(lower_ascii(path_of(url)), "/"), lambda t: t != "")
    extension = F.regexp_extract(lower_ascii(path_of(url)), r"\.([a-z0-9]{1,5})$", 1)
    query = F.regexp_extract(lower_ascii(F.coalesce(url, F.lit(""))), r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda t: F.substring_index(t, "=", 1)), lambda t: t != "")

    def tagged(values: Column, tag: str) -> Column:
        return F.transform(values, lambda t: F.concat(F.lit(tag), t))

    def parts(values: Column) -> Column:
        return F.filter(F.flatten(F.transform(values, lambda t: F.split(t, "-"))), lambda t: t != "")

    bare = F.transform(segments, lambda t: F.regexp_replace(t, r"\.[a-z0-9]{1,5}$", ""))
    hyphened = F.filter(bare, lambda t: F.contains(t, F.lit("-")))
    return F.array_sort(F.array_distinct(F.concat(
        tagged(labels, "h:"), tagged(parts(labels), "h:"), tagged(segments, "p:"), tagged(parts(hyphened), "p:"), tagged(names, "q:"),
        F.when(extension != "", F.array(F.concat(F.lit("x:"), extension))).otherwise(F.array().cast("array<string>")))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule, tokens, alike, pivot, confidence, support) from ``labelled`` (tokens, bad).

    FP-growth finds the token sets that come with the bad label often enough; rules below
    ``min_confidence`` go, and so do rules that a shorter one implies.  A token can be part of
    a rule only if it comes with the label that often itself, so others are left out before.
    ``pivot`` is the rule's rarest token, under which the inverted index lists it.  Tokens that have
    the same labelled rows stand for each other: ``tokens`` names one of each kind, ``alike`` all of
    them, and a rule stands for every choice of them.  No labels or no bad ones give no rules."""
    rows = labelled.select(F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"),
                           F.coalesce("bad", F.lit(False)).alias("bad")).withColumn("id", F.monotonically_increasing_id())
    rows = stage(rows, "labelled")
    total = rows.count()
    support = max(min_support, min_count / max(1, total))
    spark = labelled.sparkSession
    schema = "rule long, tokens array<string>, alike array<array<string>>, pivot string, confidence double, support double"
    if support > 1:
        return spark.createDataFrame([], schema)
    counts = (rows.select("bad", F.explode("tokens").alias("token")).groupBy("token")
              .agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")).filter(F.col("bad") >= support * total))
    counts = stage(counts, "tokens")
    # a token that is confident alone is a rule, and implies every longer one it is part of: it need not
    # be mined further.  Tokens of the very same rows are one item, found by digests of their rows
    single = F.col("bad") >= min_confidence * F.col("n")
    alone = counts.filter(single).select(
        F.xxhash64(F.array("token")).alias("rule"), F.array("token").alias("tokens"), F.array(F.array("token")).alias("alike"), F.col("token").alias("pivot"),
        (F.col("bad") / F.col("n")).alias("confidence"), (F.col("bad") / F.lit(total)).alias("support"))
    open_tokens = counts.filter(~single).select("token", "n")
    met = stage(rows.select("id", "bad", F.explode("tokens").alias("token")).join(open_tokens, "token"), "met")
    digest = met.groupBy("token").agg(F.first("n").alias("n"), F.bit_xor(F.xxhash64("id")).alias("mixed"), F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("added"))
    classes = stage(digest.groupBy("n", "mixed", "added").agg(F.array_sort(F.collect_list("token")).alias("class"))
                    .select("n", "class", F.col("class")[0].alias("item")), "classes")
    # at most tokens-a-URL / support tokens are left, whatever the number of URLs
    items = (met.select("id", "bad", "token").join(classes.select(F.col("item").alias("token")), "token")
             .groupBy("id", "bad").agg(F.collect_set("token").alias("items"))
             .select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BLOCK)))).otherwise(F.col("items")).alias("items")))
    items = stage(items, "items")
    left = items.count()
    columns = ("rule", "tokens", "alike", "pivot", "confidence", "support")
    if not left:
        return alone.select(*columns)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support * total / left), minConfidence=min_confidence).fit(items)
    found = (model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCK)))
             .filter(~F.array_contains("antecedent", BLOCK))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", (F.col("support") * left / total).alias("support")))
    found = stage(found.withColumn("rule", F.xxhash64("tokens")), "rules")
    spelt = found.select("rule", F.explode("tokens").alias("item")).join(classes, "item")
    pivots = spelt.groupBy("rule").agg(F.min(F.struct("n", "item"))["item"].alias("pivot"), F.array_sort(F.collect_list("class")).alias("alike"))
    found = stage(found.join(pivots, "rule"), "rules")
    shorter = found.select(F.col("tokens").alias("part"), F.col("pivot").alias("token"))
    implied = (found.select("rule", "tokens", F.explode("tokens").alias("token")).join(shorter, "token")
               .filter((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0))
               .select("rule").distinct())
    return found.join(implied, "rule", "left_anti").select(*columns).unionByName(alone)


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, confidence, by) for the distinct ``token_sets`` (tokens) that a rule fits: the
    most confident rule and its tokens.  A set meets only rules listed under one of its tokens."""
    listed = rules.select(F.explode(F.filter("alike", lambda c: F.array_contains(c, F.col("pivot")))[0]).alias("pivot"), "alike", "confidence")
    met = (token_sets.select("tokens", F.explode("tokens").alias("pivot")).join(listed, "pivot")
           .filter(F.forall("alike", lambda c: F.arrays_overlap(c, F.col("tokens"))))
           .withColumn("needed", F.array_sort(F.transform("alike", lambda c: F.array_min(F.array_intersect(c, F.col("tokens")))))))
    return (met.groupBy("tokens").agg(F.max(F.struct("confidence", "needed")).alias("best"))
            .select("tokens", F.col("best.confidence").alias("confidence"), F.col("best.needed").alias("by")))


def given_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, else null.  A rule fits its
    host and all subdomains where the path starts with the rule's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], min_support: float = MIN_SUPPORT,
          min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, confidence, by.

    Given rules decide first, the longest that fits; then a mined rule blocks, and what none
    fits is allowed.  ``labels`` (doc_id, quality, toxic) name pages by doc_id; bad is toxic 1
    or quality 0, a page with several labels is bad if one says so.  Null urls have empty host
    and path and are allowed; rows may repeat; no pages give no rows, no labels no mined rules;
    other columns are ignored."""
    read = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    read = stage(read.withColumn("tokens", url_tokens(F.col("url"))), "urls")
    said = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.coalesce(F.bool_or((F.col("toxic") == 1) | (F.col("quality") == 0)), F.lit(False)).alias("bad")))
    labelled = read.join(said, read["page_id"] == said["doc_id"]).select("tokens", "bad")
    mined = mine(labelled, min_support, min_count, min_confidence)
    hit = match(read.select("tokens").distinct(), mined)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = given_rule(F.col("host"), F.col("path"), rules)
    return (read.withColumn("host", host).withColumn("path", path).join(hit, "tokens", "left")
            .select("page_id", "host", "path", name.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("by").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    "confidence", "by"))
