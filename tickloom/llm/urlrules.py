"""URL filtering by association rules: FP-growth over the tokens of labelled urls, matched by an inverted index.

A mined rule says that urls with all of its tokens are bad more often than others: by a factor, and by more than chance explains. No rule
is cut for its length or rank; an url table whose labels don't depend on the urls has no rules, and then the listed rules alone decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, durable, small


@dataclass(frozen=True)
class Listed:
    """A listed rule: fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


#: The listed rules.
LISTED = (
    Listed("block", "com", "/en/"),
    Listed("allow", "example.com", "/en/7"),
    Listed("allow", "net", "/de/"),
    Listed("block", "example.net", "/de/8"),
    Listed("block", "org", "/es/"),
)
#: The share of labelled urls that hold a rule's tokens and are bad, at least; how much oftener than all labelled urls those with its tokens
#: are bad, at least; and by how many standard deviations of a binomial share.
SUPPORT, LIFT, SIGMAS = 0.002, 1.5, 4.0
#: Bad urls below which a binomial share is not close to normal.
LEAST_BAD = 5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    host = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: scheme, host suffixes, words of hyphenated labels, path segments by place (digits as ``#``), query names, file ending."""
    shape = lambda s: F.regexp_replace(F.lower(s), r"[0-9]+", "#")
    tag = lambda name, values: F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(name + ":"), v))
    words = F.flatten(F.transform(F.filter(F.split(host, r"\."), lambda h: h.contains("-")), lambda h: F.split(h, "-")))
    segments = F.transform(F.split(path, "/"), lambda s, i: F.when(s == "", F.lit("")).otherwise(F.concat(i.cast("string"), F.lit("="), shape(s))))
    query = F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda q: F.substring_index(q, "=", 1))
    scheme = F.array(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))
    every = F.concat(tag("scheme", scheme), tag("host", suffixes(host)), tag("word", words), tag("path", segments), tag("query", query))
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, lift: float = LIFT, sigmas: float = SIGMAS) -> DataFrame:
    """``(antecedent, confidence, support, n)`` from ``labelled`` (tokens, bad): token sets that imply a bad url; ``n`` labelled urls hold them.

    FP-growth finds the frequent token sets of all labelled urls in which the label ``bad`` occurs. Of those, rules have a confidence of at
    least ``lift`` times the share of bad urls, and ``sigmas`` deviations above it. A rule is pruned if a part of it is as confident.
    A set with fewer bad urls than either measure could pass with isn't searched for. Null labels are none; nothing bad: no rules.
    """
    from pyspark.ml.fpm import FPGrowth

    known = durable(labelled.where(F.col("bad").isNotNull()), "labelled-urls")
    sizes = known.agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")).first()
    if not sizes.bad:
        return labelled.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, support double, n long")
    n, base = sizes.n, sizes.bad / sizes.n
    least = max(LEAST_BAD, math.ceil(support * n), math.ceil(sigmas**2 * base / (1 - base)) if base < 1 else n + 1)
    items = known.select(F.when(F.col("bad"), F.array_append("tokens", F.lit("label:bad"))).otherwise(F.col("tokens")).alias("items"))
    rules = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n), minConfidence=min(1.0, lift * base)).fit(items).associationRules
    own = rules.where(F.element_at("consequent", 1) == "label:bad").select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", F.round(F.col("support") * n / F.col("confidence")).cast("long").alias("n"))
    found = durable(own.where(F.col("confidence") - base >= sigmas * F.sqrt(base * (1 - base) / F.col("n"))), "rules")
    # a part is met by the token of its own that the fewest rules hold
    part = with_key(found).select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"), "token")
    redundant = (F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0) & (F.col("part_confidence") >= F.col("confidence"))
    pruned = found.select("antecedent", "confidence", F.explode("antecedent").alias("token")).join(part, "token").where(redundant).select("antecedent").distinct()
    return durable(found.join(pruned, "antecedent", "left_anti"), "pruned-rules")


def with_key(rules: DataFrame) -> DataFrame:
    """Adds ``token``: that of a rule's tokens which the fewest rules hold."""
    tokens_of = rules.select("antecedent", F.explode("antecedent").alias("token"))
    counts = tokens_of.groupBy("token").agg(F.count("*").alias("held"))
    keys = tokens_of.join(counts, "token").groupBy("antecedent").agg(F.min_by("token", F.struct("held", "token")).alias("token"))
    return rules.join(keys, "antecedent")


def listed_rule(host: Column, path: Column, listed: tuple[Listed, ...]) -> Column:
    """The longest listed rule that fits, as ``struct<length, rule, verdict>``; null if none does. An index from host to its rules is
    looked up for each suffix of the host."""
    if not listed:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    by_host: dict[str, list[Listed]] = {}
    for r in listed:
        by_host.setdefault(r.host, []).append(r)
    one = lambda r: F.struct(F.lit(len(r.host + r.path)).alias("length"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path"))
    index = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*[one(r) for r in rs]))])
    fits = F.flatten(F.filter(F.transform(suffixes(host), lambda s: F.try_element_at(index, s)), lambda x: x.isNotNull()))
    best = F.array_max(F.filter(fits, lambda r: F.startswith(path, r["path"])))
    return best


def judge(pages: DataFrame, rules: DataFrame, listed: tuple[Listed, ...] = LISTED) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` for every row of ``pages`` (page_id, url).

    The longest listed rule decides; else a url is blocked if it holds all tokens of a mined rule (``mined``: the first of them).
    Null urls have empty host and path and are allowed unless a rule fits; repeated rows are each judged.
    """
    url = col(pages, "url", "string")
    base = pages.select(col(pages, "page_id", "long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.coalesce(url, F.lit("")).alias("url"))
    rows = base.join(small(mined_hits(base, rules)), F.col("url") == F.col("_hit_url"), "left").withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("listed")["rule"].alias("rule"),
        F.coalesce(F.col("listed")["verdict"], F.when(F.col("hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("hit").alias("mined"),
    )


def mined_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(_hit_url, hit)`` for the urls (host, path, url) that hold all tokens of a rule. The inverted index has a row for each rule, keyed by its
    rarest token; a url looks up each of its tokens, and meets the few rules that are keyed by one of them."""
    index = durable(with_key(rules).select("token", "antecedent"), "rule-index")
    if index.isEmpty():
        return durable(urls.limit(0).select(F.col("url").alias("_hit_url"), F.lit("").alias("hit")), "hits")
    own = urls.select("url", tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))
    met = own.select("url", "tokens", F.explode("tokens").alias("token")).join(small(index), "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return durable(met.groupBy(F.col("url").alias("_hit_url")).agg(F.min(F.array_join("antecedent", " & ")).alias("hit")), "hits")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(tokens, bad)`` of the urls whose document is labelled: a url's last number in its path is the id of the document it shows.
    Bad: quality 0 or toxic 1. Null labels are no labels."""
    url = col(pages, "url", "string")
    shown = pages.select(tokens(host_of(url), path_of(url), F.coalesce(url, F.lit(""))).alias("tokens"), F.try_to_number(F.nullif(F.regexp_extract(path_of(url), r"([0-9]{1,18})(?:\D*)$", 1), F.lit("")), F.lit("9" * 18)).cast("long").alias("shown"))
    marks = labels.select(col(labels, "doc_id", "long").alias("shown"), ((col(labels, "quality", "int") == 0) | (col(labels, "toxic", "int") == 1)).alias("bad")).where("bad is not null").groupBy("shown").agg(F.max("bad").alias("bad"))
    return shown.where("shown is not null").join(marks, "shown").select("tokens", "bad")


def filter_urls(pages: DataFrame, labels: DataFrame, listed: tuple[Listed, ...] = LISTED, **how) -> DataFrame:
    return judge(pages, mine_rules(labelled_urls(pages, labels), **how), listed)
