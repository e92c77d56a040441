"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact check.

Native: only DataFrame functions, no Python on the executors.

1. *Windows.* Windows have the size of an item and start at every offset (less
   what reaches over an end of the text). One without any shingle of an item has similarity 0 with all items, so only the
   windows around such shingles are made; nothing that could be similar is lost.
2. *SimHash.* Each window's words give a fingerprint of 64 bits, and
   so do the items. The counters of the bits lie side by side in a few numbers.
3. *Multi-index.* The 64 bits are cut into RADIUS + 2 blocks. Two fingerprints
   within RADIUS bits agree on two blocks at least, so the *pairs* of blocks as
   join keys find all of them, and a key of about eleven bits selects one
   fingerprint in some 1,700.
4. *Exact check.* A candidate counts if the weighted Jaccard similarity of the
   window's and the item's shingles, weighted by their characters, reaches
   the threshold.

The radius decides recall: a passage that reaches the threshold, but none of
whose windows lies within the radius, is lost. ``tests/llm`` measure this on
edited items; the README gives the figures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

WORDS, THRESHOLD, RADIUS = 5, 0.8, 10
#: Rows up to which a table of a few numbers a row is broadcast (about 64 MB).
BROADCAST_ROWS = 1_000_000
#: Bits of a counter, and how many lie in one number. Windows with more words than a counter holds are counted bit by bit.
COUNTER, LANES = 16, 4


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column, each: int) -> Column:
    """Hash of the ``each`` words from every position on. ``words`` must be a plain column."""
    n = F.greatest(F.size(words) - (each - 1), F.lit(0))
    return F.transform(F.slice(words, F.lit(1), n), lambda w, i: F.xxhash64(F.lit(each), w, *(F.get(words, i + k) for k in range(1, each))))


def weighted_shingles(words: Column, each: int) -> Column:
    """Distinct (hash, weight) of the shingles; with fewer words than a shingle all words are one."""
    def one(i: Column, size: int) -> Column:
        parts = [F.get(words, i + k) for k in range(size)]
        weight = sum((F.length(p) for p in parts[1:]), F.length(parts[0]))
        return F.struct(F.xxhash64(F.lit(size), *parts).alias("h"), weight.cast("int").alias("w"))

    whole = F.array(F.struct(F.xxhash64(F.lit(-1), F.array_join(words, " ")).alias("h"), F.length(F.array_join(words, "")).cast("int").alias("w")))
    return F.array_distinct(F.when(F.size(words) < each, whole).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - each, F.lit(0))), lambda i: one(i, each))))


def _shift(x: Column, n: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, n)


def _simhash_by_bit(words: Column) -> Column:
    def add(sums: Column, w: Column) -> Column:
        h = F.xxhash64(w)
        return F.transform(sums, lambda s, b: s + F.getbit(h, b) * 2 - 1)

    sums = F.aggregate(words, F.array_repeat(F.lit(0).cast("bigint"), 64), add)
    return F.aggregate(F.transform(sums, lambda s, b: F.when(s > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def with_simhash(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``, 64 bits: the majority, over the words, of each bit of their hashes.

    The k-th of 16 sums adds bits k, k + 16, k + 32 and k + 48 of all hashes,
    each in 16 bits of its own.
    """
    ones = F.lit(sum(1 << (COUNTER * lane) for lane in range(LANES)))
    zero = F.lit(0).cast("bigint")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    sums = F.aggregate(hashes, F.array_repeat(zero, COUNTER), lambda acc, h: F.transform(acc, lambda s, k: s + _shift(h, k).bitwiseAND(ones)))
    held, size = fresh(df, "held", "size")
    counted = df.withColumns({held: F.when(F.size(words) < 1 << COUNTER, sums), size: F.size(words)})

    def mark(made: Column, b: Column) -> Column:
        count = _shift(F.get(held, b % COUNTER), (F.floor(b / COUNTER) * COUNTER).cast("int")).bitwiseAND(F.lit((1 << COUNTER) - 1))
        return made.bitwiseOR(F.when(2 * count > F.col(size), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(zero))

    packed = F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, mark)
    return counted.withColumn(out, F.when(F.col(held).isNull(), _simhash_by_bit(F.col(words))).otherwise(packed)).drop(held, size)


def block_keys(fingerprint: Column, radius: int) -> Column:
    """A key for each pair of ``radius`` + 2 blocks that cover the 64 bits."""
    bounds = [64 * k // (radius + 2) for k in range(radius + 3)]
    blocks = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit((1 << (b - a)) - 1).cast("bigint").alias("mask")) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))))
    # (number, bits) of each block, then a key for each of them with each later one
    cut = F.transform(blocks, lambda x: F.struct(x["k"].alias("k"), _shift(fingerprint, x["a"]).bitwiseAND(x["mask"]).alias("v")))
    return F.flatten(F.transform(cut, lambda x: F.transform(F.slice(cut, x["k"] + 2, F.lit(radius + 2)), lambda y: F.xxhash64(x["k"], y["k"], x["v"], y["v"]))))


def items_of(benchmark: DataFrame, each: int) -> DataFrame:
    """item_id, item_words, size, shingles and fingerprint of the items that have words."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    hashed = with_simhash(words, "item_words", "item_print")
    return hashed.select("item_id", "item_words", F.size("item_words").alias("size"), weighted_shingles(F.col("item_words"), each).alias("item_shingles"), "item_print")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows_of(docs: DataFrame, items: DataFrame, each: int) -> DataFrame:
    """(doc_id, window): the windows of items' sizes that hold a shingle of an item of that size.

    A window that reaches over an end of the text is cut off there.
    """
    short = sorted(r["size"] for r in items.where(F.col("size") < each).select("size").distinct().collect())
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    found = None
    for own in [*short, each]:
        fit = F.col("size") == own if own < each else F.col("size") >= own
        seeds = items.where(fit).select("size", F.explode(shingle_hashes(F.col("item_words"), own)).alias("h")).distinct()
        hits = texts.select("doc_id", F.posexplode(shingle_hashes(F.col("words"), own)).alias("at", "h")).join(_few(materialize(seeds, "seeds")), "h")
        hits = hits.select("doc_id", "size", "at", F.lit(own).alias("each"))
        found = hits if found is None else found.union(hits)
    # a document has no more places than words
    found = found.groupBy(F.col("doc_id").alias("of_doc"), "size", "each").agg(F.collect_set("at").alias("places"))
    found = materialize(found, "places")
    ids = found.select("of_doc").distinct()
    inside = docs.select("doc_id", "text").join(_few(ids), F.col("doc_id").eqNullSafe(F.col("of_doc")), "left_semi").select("doc_id", words_of(F.col("text")).alias("words"))
    inside = inside.join(found, F.col("doc_id").eqNullSafe(F.col("of_doc")))
    begins = F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(at - F.col("size") + F.col("each"), at))))

    def cut(s: Column) -> Column:
        first = F.greatest(s, F.lit(0))
        return F.slice(F.col("words"), first + 1, F.greatest(s + F.col("size") - first, F.lit(0)))

    return inside.select("doc_id", F.explode(F.transform(begins, cut)).alias("window")).where(F.size("window") > 0)


def near_prints(prints: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(print, item_id): all fingerprints within ``radius`` bits of an item's."""
    left = prints.select("print", F.explode(block_keys(F.col("print"), radius)).alias("key"))
    right = items.select("item_id", "item_print", F.explode(block_keys(F.col("item_print"), radius)).alias("key"))
    within = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    return left.join(_few(right), (left["key"] == right["key"]) & within).select("print", "item_id").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, *, words_each: int = WORDS, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity): the items that a document holds a passage of.

    Null or empty texts and items hold nothing. Items shorter than a shingle
    are searched as a whole. Rows with the same doc_id are searched each and
    told together; a null doc_id is kept as such. Repeated items each count.
    Texts are searched whole, however long.
    """
    items = materialize(items_of(benchmark, words_each), "items")
    windows = materialize(with_simhash(windows_of(docs, items, words_each), "window", "print"), "windows")
    near = materialize(near_prints(windows.select("print").distinct(), items, radius), "near-prints")
    item = items.select(F.col("item_id").alias("of_item"), "item_shingles")
    both = windows.join(_few(near), "print").join(_few(item), F.col("item_id").eqNullSafe(F.col("of_item")))
    weight = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x["w"])
    shared = both.select("doc_id", "item_id", "item_shingles", weighted_shingles(F.col("window"), words_each).alias("shingles")).withColumn("common", weight(F.array_intersect("shingles", "item_shingles")))
    alike = shared.select("doc_id", "item_id", (F.col("common") / (weight("shingles") + weight("item_shingles") - F.col("common"))).alias("similarity"))
    return alike.where(F.col("similarity") >= threshold).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, words_each: int = WORDS, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """All columns of ``docs``, item_ids, leak_similarity and leak_kept for every row.

    Rows that hold a passage of an item are not kept, nor are other rows of
    their doc_id; rows without a doc_id are judged by their own text. Columns of ``docs`` that
    bear the new names are replaced, others are kept whatever their names; an
    empty table gives no rows, an empty benchmark keeps all.
    """
    key = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.sha2("text", 256)).alias("digest"))
    found = matches(docs.select(key.alias("doc_id"), "text"), benchmark, words_each=words_each, threshold=threshold, radius=radius)
    rows = docs.drop("item_ids", "leak_similarity", "leak_kept")
    (leak_doc,) = fresh(rows, "leak_doc")
    told = found.groupBy(F.col("doc_id").alias(leak_doc)).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("leak_similarity"))
    told = _few(materialize(told, "leaks"))
    out = rows.join(told, key.eqNullSafe(F.col(leak_doc)), "left")
    return out.select(*rows.columns, "item_ids", "leak_similarity", F.col("leak_similarity").isNull().alias("leak_kept"))
