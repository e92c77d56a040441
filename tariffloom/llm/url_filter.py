"""URL filtering with stated rules first and mined association rules for the rest.

Native: only DataFrame functions and Spark's FP-growth.

*Mining.* Each labelled URL becomes a set of tokens (scheme, sub-domain,
domain words, ending, path words, file ending, query keys, fragment) and one
token for its label. Tokens that stand in exactly the same labelled URLs count
as one, as a group of n of them would make 2**n sets that say the same. FP-growth finds the frequent sets; rules "tokens => bad"
below the support or confidence asked for are pruned, and so are rules that a
shorter one with at least their confidence covers.

*Matching.* An inverted index holds each rule under its rarest token. Only
distinct token sets are looked up in it (a host with a third of all pages has
few), candidates are kept if they have all tokens of the rule, and the verdict
goes back to the pages by a join on the token set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
BAD = "label=bad"
#: A mined rule holds for this share of the labelled rows and for this many at least, and is right this often.
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.005, 20, 0.6


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated(host: Column, path: Column, rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, without numbers; null has none."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)

    def named(kind: str, words: Column) -> Column:
        words = F.filter(words, lambda w: (w != "") & ~w.rlike(r"^[0-9]+$"))
        return F.transform(words, lambda w: F.concat(F.lit(f"{kind}:"), w))

    return F.array_sort(F.array_distinct(F.concat(
        named("scheme", F.array(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)))),
        named("host", F.split(host, r"[.:]")),
        named("word", F.filter(F.split(host, r"[.:\-]"), lambda w: F.contains(host, F.lit("-")))),
        named("path", F.split(F.regexp_replace(F.lower(path), r"\.[a-z0-9]{1,5}$", ""), r"[/_\-+%.]+")),
        named("file", F.array(F.regexp_extract(F.lower(path), r"\.([a-z0-9]{1,5})$", 1))),
        named("key", F.transform(F.split(query, "&"), lambda p: F.split(p, "=")[0])),
        named("fragment", F.array(F.when(F.contains(url, F.lit("#")), "yes").otherwise(""))),
    )))


def token_sets(labelled: DataFrame) -> DataFrame:
    """Labelled URLs (url, bad) as token sets: set_id, tokens, bad. Rows without a label or tokens are left out."""
    rows = labelled.where(F.col("bad").isNotNull()).select(tokens_of(F.col("url")).alias("tokens"), "bad").where(F.size("tokens") > 0)
    return materialize(rows.withColumn("set_id", F.monotonically_increasing_id()), "token-sets")


def twins(sets: DataFrame) -> DataFrame:
    """(token, twin): tokens that stand in the same sets as a greater one, with the greatest of these."""
    each = sets.select("set_id", F.explode("tokens").alias("token"))
    # equal sums of two hashes over equally many sets: the same sets
    marked = each.groupBy("token").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(set_id))").alias("h1"), F.expr("bit_xor(xxhash64(7, set_id))").alias("h2"))
    greatest = marked.groupBy("n", "h1", "h2").agg(F.max("token").alias("twin"))
    return materialize(marked.join(greatest, ["n", "h1", "h2"]).where("token <> twin").select("token", "twin"), "twins")


def with_twins(sets: DataFrame, same: DataFrame, key: str) -> DataFrame:
    """Add ``own``: the tokens of each set (by its unique ``key``), each as its greatest twin."""
    each = sets.select(F.col(key).alias("of_set"), F.explode("tokens").alias("token")).join(small(same), "token", "left")
    named = each.groupBy("of_set").agg(F.array_sort(F.collect_set(F.coalesce("twin", "token"))).alias("own"))
    return sets.join(named, F.col(key) == F.col("of_set"), "left").drop("of_set").withColumn("own", F.coalesce("own", F.array().cast("array<string>")))


def mine(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules from labelled URLs (url, bad): rule_tokens, confidence, bad_rows, index_token; and the twins of tokens.

    Rows without a label are ignored. No labelled row, or none that is bad,
    gives no rules.
    """
    sets = token_sets(labelled)
    same = twins(sets)
    items = with_twins(sets, same, "set_id").select(F.when(F.col("bad"), F.concat("own", F.array(F.lit(BAD)))).otherwise(F.col("own")).alias("items"))
    support = min(1.0, max(min_support, min_rows / max(1, sets.count())))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    frequent = materialize(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "frequent-sets")
    bad = frequent.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad_rows"))
    rules = bad.join(frequent, "items").select(F.col("items").alias("rule_tokens"), (F.col("bad_rows") / F.col("freq")).alias("confidence"), "bad_rows").where(F.col("confidence") >= min_confidence)
    single = frequent.where(F.size("items") == 1).select(F.col("items")[0].alias("index_token"), "freq")
    each = rules.select("*", F.explode("rule_tokens").alias("index_token"))
    rare = each.join(single, "index_token").groupBy("rule_tokens").agg(F.min_by("index_token", F.struct("freq", "index_token")).alias("index_token"))
    rules = rules.join(rare, "rule_tokens")
    # a shorter rule that is right as often covers a longer one
    general = rules.select(F.col("rule_tokens").alias("g_tokens"), F.col("confidence").alias("g_confidence"), F.col("index_token").alias("g_token"))
    covered = each.select("rule_tokens", "confidence", F.col("index_token").alias("g_token")).join(general, "g_token")
    covered = covered.where((F.size("g_tokens") < F.size("rule_tokens")) & (F.col("g_confidence") >= F.col("confidence")) & (F.size(F.array_except("g_tokens", "rule_tokens")) == 0))
    return materialize(rules.join(covered.select("rule_tokens").distinct(), "rule_tokens", "left_anti"), "rules"), same


def match(sets: DataFrame, rules: DataFrame, same: DataFrame) -> DataFrame:
    """The strongest rule (confidence, then tokens) of each distinct token set: tokens, mined_rule."""
    distinct = sets.select("tokens").distinct()
    own = with_twins(distinct, same, "tokens")
    looked = own.select("tokens", "own", F.explode("own").alias("index_token"))
    found = looked.join(rules, "index_token").where(F.size(F.array_except("rule_tokens", "own")) == 0)
    return found.groupBy("tokens").agg(F.max_by(F.array_join("rule_tokens", " "), F.struct("confidence", "rule_tokens")).alias("mined_rule"))


def judge(pages: DataFrame, labelled: DataFrame, rules: list[Rule], *, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and mined_rule of every page.

    ``rule`` is the longest stated rule that fits the URL (null if none), and
    its verdict holds. Else a mined rule blocks, and what no rule fits is
    allowed. A null URL, or one without "://", has an empty host and path and
    is allowed. Repeated rows are judged each; other columns are ignored.
    """
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens_of(F.col("url")).alias("tokens"))
    rules_found, same = mine(labelled, min_support=min_support, min_rows=min_rows, min_confidence=min_confidence)
    if rules_found.isEmpty():
        out = parts.withColumn("mined_rule", F.lit(None).cast("string"))
    else:
        out = parts.join(small(materialize(match(parts, rules_found, same), "matched-sets")), "tokens", "left")
    host, path = F.col("host"), F.col("path")
    own = F.when(F.col("mined_rule").isNotNull(), BLOCK).otherwise(ALLOW)
    return out.select("page_id", "host", "path", stated(host, path, rules, lambda r: r.text).alias("rule"), F.coalesce(stated(host, path, rules, lambda r: r.verdict), own).alias("verdict"), "mined_rule")


def document_of(url: Column) -> Column:
    """The last number in the path names the document that a page shows; else null."""
    return F.regexp_extract(path_of(url), ".*?([0-9]{1,18})[^0-9]*$", 1).try_cast("bigint")


def label_by_document(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page's last number in its path names the document it shows.

    ``bad``: of low quality, or toxic. Repeated labels of a document count as
    bad if one of them does. Pages without a label are left out.
    """
    one = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    numbered = pages.select("url", document_of(F.col("url")).alias("label_id"))
    return numbered.join(one, "label_id").where(F.col("bad").isNotNull()).select("url", "bad")
