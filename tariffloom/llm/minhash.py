"""MinHash near-duplicates with tensored banding; every link is verified on full sets.

A document's set are the 64-bit hashes of its distinct word shingles. Equal
sets form a class, and only classes go on: copies are never compared.

*Tensored banding.* Two small collections of bands are computed, each of
``BANDS`` bands of ``ROWS`` minhashes. A table's key combines one band of the
first collection with one of the second: BANDS**2 tables of 2*ROWS rows out of
2*BANDS*ROWS minhashes, where tables of their own would take
2*BANDS**2*ROWS. With 12 bands of 3, two sets of similarity 0.8 meet in no
table with a probability of 4e-4, of 0.85 with 2e-5, of 0.9 with 3e-7
(computed for ideal minhashes).

*Verification without all pairs.* Classes that share a key are compared in two
steps, both on whole sets:

1. in ``ROUNDS`` rounds each class meets the centres of its buckets that it
   shares the most tables with. What is linked becomes one component, so that
   a group of near copies costs a few comparisons for each copy;
2. classes that still share a key with another component take part in a prefix
   join: elements are ordered by how many of these classes hold them, rarest
   first, and two sets that are linked share an element among their rarest.
   Only pairs of different components are made, and only where the places of
   the element, and the marks of both sets, leave room for the overlap that a
   link needs. What two copies
   have in common with their group stands last in this order, so a group's
   size does not multiply pairs. No pair that could be a link is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, small
from .components import components

BANDS, ROWS = 12, 3
#: Rounds with centres at most, and centres that a class meets in each. A round without a link is the last.
ROUNDS, CENTRES = 4, 3
#: Numbers of 64 bits that mark which elements a set holds.
MARKS = 16

_rng = np.random.default_rng(20240229)
_SEEDS = _rng.integers(1, 2**63, 2 * BANDS * ROWS, dtype=np.uint64)
_ODD = _rng.integers(1, 2**63, len(_SEEDS), dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hashes of words; emptied when full, so that memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, words_each: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles.

    Words are what lies between ASCII white space, A-Z in lower case. A text
    with fewer words than a shingle has one of all of them.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    each = min(words_each, len(h))
    out = np.zeros(len(h) - each + 1, np.uint64) + np.uint64(each)
    with np.errstate(over="ignore"):
        for k in range(each):
            out = (out ^ h[k : len(h) - each + 1 + k]) * _MIX
            out ^= out >> np.uint64(29)
    return np.unique(out)


def band_hashes(values: np.ndarray) -> np.ndarray:
    """The bands of both collections, as 64-bit numbers."""
    least = np.empty(len(_SEEDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(values), 4096):
            x = (values[k : k + 4096, None] ^ _SEEDS) * _ODD
            x ^= x >> np.uint64(32)
            x *= _MIX
            low = x.min(axis=0)
            least = low if k == 0 else np.minimum(least, low)
        rows = least.reshape(2 * BANDS, ROWS)
        bands = np.zeros(2 * BANDS, np.uint64)
        for k in range(ROWS):
            bands = (bands ^ rows[:, k]) * _MIX
            bands ^= bands >> np.uint64(31)
    return bands


def marks(values: np.ndarray) -> np.ndarray:
    """MARKS numbers with a bit for each element; elements may share bits."""
    out = np.zeros(MARKS, np.uint64)
    with np.errstate(over="ignore"):
        at = ((values * _MIX) >> np.uint64(32)) % np.uint64(64 * MARKS)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(int), np.uint64(1) << (at & np.uint64(63)))
    return out


def sketches(docs: DataFrame, words_each: int, *, whole: bool = False) -> DataFrame:
    """doc_id, n_shingles, digest (two numbers) and bands of each document; with ``whole`` its set and marks instead of the bands."""
    last = ["shingles", "marks"] if whole else ["bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                rows = []
                for text in part.column(1):
                    s = shingles(text.as_py(), words_each, cache)
                    digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    found = [s, marks(s)] if whole else [band_hashes(s) if len(s) else s]
                    rows.append((len(s), digest[0], digest[1], *(x.view(np.int64) for x in found)))
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * len(last)
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n", "d1", "d2", *last])

    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, " + ", ".join(f"{c} array<bigint>" for c in last))


def table_keys(bands: Column) -> Column:
    """The key of each table: one band of the first collection with one of the second."""
    first, second = F.slice(bands, 1, BANDS), F.slice(bands, BANDS + 1, BANDS)
    return F.flatten(F.transform(first, lambda a, i: F.transform(second, lambda b, j: F.xxhash64(a, b, i * BANDS + j))))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets (id, n, shingles) are similar enough."""
    u, v = (sets.select(F.col("id").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "uv")
    common = F.size(F.array_intersect("set_u", "set_v"))
    met = pairs.join(u, "u").join(v, "v").select("u", "v", common.alias("c"), (F.size("set_u") + F.size("set_v")).alias("both"))
    return met.where(100 * F.col("c") >= percent * (F.col("both") - F.col("c"))).select("u", "v")


def _near_sizes(a: str, b: str, percent: int) -> Column:
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows (key, id, n) with the component of their class."""
    if labels is None:
        return rows.select("*", F.col("id").alias("component"))
    joined = rows.join(small(labels.select(F.col("id").alias("of_id"), "component")), F.col("id") == F.col("of_id"), "left")
    return joined.select(*rows.columns, F.coalesce("component", "id").alias("component"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The keys under which rows of several components lie."""
    return rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")


def centre_pairs(rows: DataFrame, round_no: int, percent: int) -> DataFrame:
    """(u, v): each class with the few centres of other components that it shares the most tables with.

    A bucket's centre is the class that a hash of the round ranks first, so
    all buckets of a group of copies have few centres.
    """
    me = F.struct(F.xxhash64(F.lit(round_no), "id").alias("rank"), "id", "n", "component")
    centres = rows.groupBy("key").agg(F.min(me).alias("centre"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key", "centre")
    met = rows.join(centres, "key").where((F.col("component") != F.col("centre.component")) & _near_sizes("n", "centre.n", percent))
    met = met.groupBy(F.col("id").alias("u"), F.col("centre.id").alias("v"), F.col("centre.rank").alias("rank")).agg(F.count("*").alias("tables"))
    # a class has no more centres than tables, so the lists are bounded
    few = met.groupBy("u").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("tables")).alias("far"), "rank", "v"))), 1, CENTRES).alias("its"))
    return few.select("u", F.explode("its.v").alias("v"))


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): all pairs of different components that may be links, by a prefix join over (id, component).

    A set's elements are ordered by how many members hold them, then by value.
    A link needs percent / (100 + percent) of both sizes as overlap, hence
    shares an element among the n - ceil(n * percent / 100) + 1 first of each,
    behind the first one shared both have enough elements left, and neither has
    too many marks that the other lacks, as each stands for an element apart.
    """
    elements = sets.join(small(members), "id").select("id", "component", "n", F.explode("shingles").alias("e"))
    held = elements.groupBy("e").agg(F.count("*").alias("held")).where("held > 1")
    ranked = elements.join(held, "e").groupBy("id", "component", "n").agg(F.sort_array(F.collect_list(F.struct("held", "e"))).alias("shared"))
    # elements that no other member holds come first; they only take places
    alone = F.col("n") - F.size("shared")
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    listed = ranked.select("id", "component", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))).alias("k", "s"))
    listed = materialize(listed.select("id", "component", "n", (F.col("n") - F.col("alone") - F.col("k")).alias("left"), F.col("s.e").alias("e")), "prefixes")
    # the component that holds an element most often is never compared with itself
    most = listed.groupBy("e", "component").agg(F.count("*").alias("times")).groupBy("e").agg(F.max_by("component", F.struct("times", "component")).alias("main"), F.count("*").alias("several")).where("several > 1").select("e", "main")
    listed = listed.join(most, "e").join(sets.select("id", "marks"), "id")
    a = listed.where("component <> main").select("e", *(F.col(c).alias(f"{c}_a") for c in ("id", "component", "n", "left", "marks")))
    b = listed.select("e", "main", *(F.col(c).alias(f"{c}_b") for c in ("id", "component", "n", "left", "marks")))
    once = (F.col("component_b") == F.col("main")) | (F.col("component_a") < F.col("component_b"))
    room = F.least("left_a", "left_b") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))

    def close(x: str, y: str) -> Column:
        apart = sum((F.bit_count(F.col(f"marks_{x}")[k].bitwiseAND(F.bitwise_not(F.col(f"marks_{y}")[k]))) for k in range(1, MARKS)), F.bit_count(F.col(f"marks_{x}")[0].bitwiseAND(F.bitwise_not(F.col(f"marks_{y}")[0]))))
        return (F.col(f"n_{x}") - apart) * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))

    met = a.join(b, (a["e"] == b["e"]) & once & room & _near_sizes("n_a", "n_b", percent) & close("a", "b") & close("b", "a"))
    return met.select(F.least("id_a", "id_b").alias("u"), F.greatest("id_a", "id_b").alias("v")).distinct()


def _same_documents(rows: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(u, v): classes that one doc_id with several texts belongs to; None if there are none."""
    digest = F.struct("d1", "d2")
    several = rows.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).where("low <> high").select("doc_id")
    several = materialize(several, "several")
    if several.isEmpty():
        return None
    own = rows.join(several, "doc_id").select("doc_id", "d1", "d2").distinct().join(classes.select("d1", "d2", "id"), ["d1", "d2"])
    least = own.groupBy("doc_id").agg(F.min("id").alias("u"))
    return own.join(least, "doc_id").select("u", F.col("id").alias("v")).where("u <> v")


def near_duplicates(docs: DataFrame, *, words_each: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of (doc_id, text).

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles
    of both. component_id is the smallest doc_id that links reach; that
    document is kept. Null and empty texts, and others without words, are
    linked with nothing; texts are read whole, however long. Rows with the
    same doc_id are the same document, so one with several texts has the links
    of all of them. A null doc_id has a null component_id, links nothing and is
    kept. Other columns are ignored; an empty table gives no rows.
    """
    all_rows = materialize(sketches(docs, words_each), "sketches")
    some = all_rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    # one exchange by key serves the search for shared keys and the join with them
    placed = classes.select("id", "n", F.explode(table_keys(F.col("bands"))).alias("key")).repartition("key")
    shared = placed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min("n").alias("least")).where("low <> high").select("key")
    rows = materialize(placed.join(shared.hint("shuffle_hash"), "key"), "bucket-rows")
    wanted = materialize(classes.drop("bands").join(small(rows.select("id").distinct()), "id", "left_semi").select("id", "d1", "d2", F.col("rep").alias("doc_id")), "wanted")
    again = docs.select("doc_id", "text").join(small(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    sets = sketches(again, words_each, whole=True).join(small(wanted), ["doc_id", "d1", "d2"]).select("id", "n", "shingles", "marks").dropDuplicates(["id"])
    sets = materialize(sets, "sets")

    links = _same_documents(some, classes)
    labels = None if links is None else materialize(components(links), "labels")

    def link(found: DataFrame) -> DataFrame:
        known = found if labels is None else found.union(labels.select(F.col("id").alias("u"), F.col("component").alias("v")))
        return materialize(components(known), "labels")

    for round_no in range(ROUNDS):
        pairs = materialize(centre_pairs(_labelled(rows, labels), round_no, percent), "pairs")
        found = materialize(verified(pairs, sets, percent), "links")
        if found.isEmpty():
            break
        labels = link(found)
    rest = _labelled(rows, labels)
    members = materialize(rest.join(_mixed(rest), "key").select("id", "component").distinct(), "members")
    pairs = materialize(prefix_pairs(members, sets, percent), "pairs")
    if not pairs.isEmpty():
        found = materialize(verified(pairs, sets, percent), "links")
        if not found.isEmpty():
            labels = link(found)

    by_class = classes.select("id", "d1", "d2", "rep", "members").where("members > 1") if labels is None else None
    if by_class is None:
        own = classes.select("id", "d1", "d2", "rep", "members").join(labels.withColumnRenamed("id", "of_id"), F.col("id") == F.col("of_id"), "left").where("members > 1 or component is not null")
        least = own.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
        by_class = own.join(least, "component", "left").select("d1", "d2", F.coalesce("least", "rep").alias("rep"))
    known = materialize(by_class.select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), "rep"), "class-components")
    out = all_rows.select("doc_id", "n", "d1", "d2").join(small(known), (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
