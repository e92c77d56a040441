"""SpotSigs fingerprints: chains of content words that follow common words.

Native: only DataFrame functions, no Python on the executors.

A text's words are its runs of letters and digits in lower case. Each common
word (an anchor) that a content word follows makes a signature of the anchor
and the chain of up to two content words behind it; a chain ends at the next
anchor. A fingerprint is the sorted set of the signatures' 32-bit hashes. A
text without any signature has one hash of all its words, or of itself if it
has no words; the empty text has an empty fingerprint.

Likeness is the Jaccard similarity of two sets. ``fingerprints`` compares given
pairs in full, as their exact similarity is the result. ``alike`` finds all
alike documents: sets are partitioned by length so that alike ones lie in the
same or in neighbouring partitions, candidates share one of their rarest
signatures there, and lengths that rule the similarity out are pruned before
anything is intersected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Common words of English, German, French and Spanish, the anchors.
ANCHORS = (
    "the of and a to in is that it for on was be with as by this are at from or an not have has his he she they but were which their been "
    "der die und das den von zu ist des im für mit sich dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer "
    "le la les et des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec aux ou cette "
    "el los las del y que una por con para su al lo como más pero sus este ya o sí porque esta entre cuando muy sin sobre"
).split()
CHAIN = 2
#: Rows that a window of neighbouring documents holds, about.
BUCKET_ROWS = 1000
#: Quantiles of the ids that bound buckets, at most; and buckets whose order is settled together.
QUANTILES, SUPER_BUCKETS = 1024, 4096


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def signatures(words: Column, text: Column) -> Column:
    """Sorted distinct hashes. ``words`` must be a plain column: each element looks at its neighbours in it."""
    anchors = sorted(set(ANCHORS))

    def at(w: Column, i: Column) -> Column:
        first, second = F.get(words, i + 1), F.get(words, i + 2)
        chain = F.hash(w, first, F.when(second.isin(anchors), None).otherwise(second))
        return F.when(w.isin(anchors) & first.isNotNull() & ~first.isin(anchors), chain)

    found = F.array_compact(F.transform(words, at))
    rest = F.when(F.size(words) > 0, F.array(F.hash(F.array_join(words, " ")))).when(F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(rest)))


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the signatures of the column ``text`` (null counts as empty)."""
    words = df.withColumn("_words", words_of(F.coalesce(F.col(text), F.lit(""))))
    return words.withColumn(out, signatures(F.col("_words"), F.coalesce(F.col(text), F.lit("")))).drop("_words")


def as_text(hashes: Column) -> Column:
    """The fingerprint: eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 where their lengths keep it below ``least``. Two empty sets are alike."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    return F.when(high == 0, 1.0).when((low == 0) | (low < least * high), 0.0).otherwise(exact)


@dataclass(frozen=True)
class Ranges:
    """Buckets of rows in order of doc_id: ranges between quantiles, each cut into ``parts`` of equal width."""

    bounds: list[int]
    high: int
    parts: int

    def bucket(self, doc_id: Column) -> Column:
        """The bucket of an id; null ids lie in the lowest."""
        k = F.coalesce(doc_id.cast("bigint"), F.lit(self.bounds[0]))
        # two short searches instead of one long one
        step = max(1, round(len(self.bounds) ** 0.5))
        groups = [self.bounds[n : n + step] for n in range(0, len(self.bounds), step)]
        at_most = lambda array: F.greatest(F.size(F.filter(array, lambda b: b <= k)) - 1, F.lit(0))
        group = at_most(F.array(*(F.lit(g[0]) for g in groups)))
        inside = at_most(F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), group))
        place = group * step + inside
        low = F.get(F.array(*map(F.lit, self.bounds)), place)
        width = F.get(F.array(*(F.lit(max(1, -(-(b - a) // self.parts))) for a, b in zip(self.bounds, [*self.bounds[1:], self.high + 1], strict=True))), place)
        return place.cast("bigint") * self.parts + F.least(F.floor((k - low) / width), F.lit(self.parts - 1)).cast("bigint")


def ranges_of(docs: DataFrame, rows: int) -> Ranges:
    """Ranges of about ``rows`` rows, however unevenly the ids are spread: their bounds are quantiles of all ids.

    At most QUANTILES bounds come to the driver; beyond, ranges are cut evenly.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("k"))
    count, low, high = ids.agg(F.count("k"), F.min("k"), F.max("k")).first()
    if not count:
        return Ranges([0], 0, 1)
    n = min(QUANTILES, max(1, count // rows))
    found = ids.agg(F.percentile_approx("k", [q / n for q in range(1, n)], 10 * QUANTILES)).first()[0] if n > 1 else []
    return Ranges(sorted({low, *found}), high, max(1, -(-count // (n * rows))))


def _next_bucket(heads: DataFrame) -> DataFrame:
    """(bucket, next_bucket): the nearest lower bucket that has rows; after the lowest the highest."""
    own = heads.select("bucket", F.floor(F.col("bucket") / F.lit(SUPER_BUCKETS)).alias("above"))
    supers = own.groupBy("above").agg(F.max("bucket").alias("top"))
    all_supers = Window.orderBy(F.desc("above"))
    supers = supers.select(F.col("above").alias("s"), F.lead("top").over(all_supers).alias("follows"), F.max("top").over(all_supers.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first"))
    inside = own.withColumn("lower", F.lead("bucket").over(Window.partitionBy("above").orderBy(F.desc("bucket"))))
    return inside.join(supers, F.col("above") == F.col("s")).select("bucket", F.coalesce("lower", "follows", "first").alias("next_bucket"))


#: Least similarity (in percent) of alike documents.
PERCENT = 44


def length_bounds(longest: int, percent: int) -> list[int]:
    """Least lengths of the partitions: what is alike to a set of partition k lies in k - 1, k or k + 1."""
    bounds = [1]
    while (following := 100 * bounds[-1] // percent + 1) <= longest:
        bounds.append(following)
    return bounds


def alike_sets(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, similarity): all pairs of sets (set_id, signatures) that reach ``percent``, each once.

    set_id must be unique, and the sets distinct and not empty. Of a set of n
    signatures the n - ceil(n * percent / 100) + 1 rarest are listed; two alike
    sets share one of these.
    """
    longest = sets.agg(F.max(F.size("signatures"))).first()[0] or 1
    bounds = F.array(*map(F.lit, length_bounds(longest, percent)))
    single = sets.select("set_id", F.size("signatures").alias("n"), F.explode("signatures").alias("sig"))
    often = single.groupBy(F.col("sig").alias("of_sig")).agg(F.count("*").alias("often"))
    ranked = single.join(often, F.col("sig") == F.col("of_sig")).groupBy("set_id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "sig"))).alias("ranked"))
    rare = F.slice("ranked", F.lit(1), F.col("n") - F.expr(f"int((bigint(n) * {int(percent)} + 99) div 100)") + 1)
    listed = ranked.withColumn("part", F.size(F.filter(bounds, lambda b: b <= F.col("n")))).select("set_id", "n", "part", F.explode(rare).alias("s")).select("set_id", "n", "part", F.col("s.sig").alias("sig"))
    listed = materialize(listed, "spotsigs-lists")
    short = listed.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("part").alias("part_a"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    long = listed.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), "part", "sig")
    once = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    near = once & (F.col("n_a").cast("bigint") * 100 >= F.col("n_b").cast("bigint") * percent)
    pairs = short.join(long, ["part", "sig"]).where(near).select("a", "b").distinct()
    pairs = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("signatures").alias("of_a")), "a").join(sets.select(F.col("set_id").alias("b"), F.col("signatures").alias("of_b")), "b")
    return pairs.select("a", "b", likeness(F.col("of_a"), F.col("of_b")).alias("similarity")).where(F.col("similarity") >= percent / 100)


def alike(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """(doc_id, other_id, similarity): all documents whose signature sets reach ``percent``, wherever they stand.

    Documents with equal sets are paired with the least doc_id among them
    (similarity 1); pairs of different sets are given once, by their least
    ids, the lesser one first. Rows without doc_id take no part; an id with
    several texts may be paired with itself.
    """
    rows = with_signatures(docs.select("doc_id", "text").where("doc_id is not null"), "text", "signatures")
    rows = materialize(rows.select("doc_id", "signatures").distinct(), "spotsigs-rows")
    sets = rows.groupBy("signatures").agg(F.min("doc_id").alias("least_id"))
    sets = materialize(sets.withColumn("set_id", F.monotonically_increasing_id()), "spotsigs-sets")
    copies = rows.join(sets.select("signatures", "least_id"), "signatures").where("doc_id <> least_id")
    copies = copies.select(F.col("least_id").alias("doc_id"), F.col("doc_id").alias("other_id"), F.lit(1.0).alias("similarity"))
    ids = sets.select("set_id", "least_id")
    pairs = alike_sets(sets.where(F.size("signatures") > 0).select("set_id", "signatures"), percent)
    pairs = pairs.join(ids.select(F.col("set_id").alias("a"), F.col("least_id").alias("id_a")), "a").join(ids.select(F.col("set_id").alias("b"), F.col("least_id").alias("id_b")), "b")
    return copies.unionByName(pairs.select(F.least("id_a", "id_b").alias("doc_id"), F.greatest("id_a", "id_b").alias("other_id"), "similarity"))


RESULT = ["doc_id", "n_chars", "edited_sha256", "signatures", "edited_signatures", "near_edited", "near_next"]


def compared(rows: DataFrame, *keep: str) -> DataFrame:
    """The result's columns, for rows with text, signatures, next_text and next_signatures."""
    n, cut = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next_text", F.lit(1), cut)))
    rows = with_signatures(rows, "edited", "edited_signatures")
    return rows.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "signatures", "edited_signatures",
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"), likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"), *keep,
    )


def fingerprints(docs: DataFrame, *, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprint each whole text and its edited text, and compare it with both.

    The edited text has its last floor(n/3) code points replaced by the first
    ones of the next document in descending order of doc_id (null ids last,
    equal ids by text; after the last comes the first). Texts cross the
    network once: neighbours meet in windows over ranges of doc_id, and only
    the first and last document of each range are joined. Null texts count as
    empty, whole texts are read, a single document follows itself, other
    columns are ignored, an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = with_signatures(docs.withColumn("bucket", ranges_of(docs, bucket_rows).bucket(F.col("doc_id"))), "text", "signatures")
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    rows = signed.select("*", F.lead("text").over(order).alias("next_text"), F.lead("signatures").over(order).alias("next_signatures"), F.row_number().over(order).alias("place"))
    first, last = F.col("place") == 1, F.col("next_text").isNull()
    rows = rows.withColumns({"is_first": first, "is_last": last, "edge_text": F.when(first | last, F.col("text"))})
    done = materialize(compared(rows, "bucket", "is_first", "is_last", "edge_text"), "spotsigs")
    heads = done.where("is_first").select(F.col("bucket").alias("next_bucket"), F.col("edge_text").alias("next_text"), F.col("signatures").alias("next_signatures"))
    ends = done.where("is_last").select("bucket", "doc_id", F.col("edge_text").alias("text"), "signatures")
    ends = ends.join(_next_bucket(done.where("is_first").select("bucket")), "bucket").join(heads, "next_bucket")
    out = done.where("not is_last").select(*RESULT).unionByName(compared(ends).select(*RESULT))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("signatures")).alias("fingerprint"), as_text(F.col("edited_signatures")).alias("edited_fingerprint"), "near_edited", "near_next")
