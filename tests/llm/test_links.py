"""Near-duplicates, decontamination and fingerprints against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tariffloom.llm import decontaminate, minhash, spotsigs
from tariffloom.llm.components import components

DATA = "/root/testdata/sf0.001"


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def linked(texts, n, percent=80):
    sets = {i: shingle_set(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def fixture(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [word() for _ in range(60)]
    texts = {1: "", 2: None, 3: "One", 4: "one", 5: "Éa b", 6: "éa b", 7: "a b", 8: "A\tB\n"}
    for k in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = word()
        texts[100 + k] = " ".join(own)
    texts |= {200 + k: texts[100] for k in range(20)} | {300 + k: " ".join(word() for _ in range(rng.randint(1, 40))) for k in range(40)}
    return texts


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, n):
    texts = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, words_each=n).collect()}
    assert got == linked(texts, n)


def test_near_duplicates_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, "a b c"), (9, "a b c")], "doc_id bigint, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df, words_each=2).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(7, 2, 7, True)] * 2 + [(9, 2, 7, False)], key=str)
    assert minhash.near_duplicates(df.limit(0), words_each=2).count() == 0


def test_one_id_with_several_texts_has_the_links_of_all(spark):
    a, b = ([f"{k}{n}" for n in range(60)] for k in "ab")
    near = lambda words: " ".join([*words[:-1], "other"])
    df = spark.createDataFrame([(7, " ".join(a)), (7, " ".join(b)), (8, near(a)), (9, near(b)), (10, "alone here")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(df, words_each=2).collect())
    assert got == [(7, 7), (7, 7), (8, 7), (9, 7), (10, 10)]


def copies(n, words, edits, seed):
    """Texts that each differ from one centre at some places, far enough that many are no links of each other."""
    rng = random.Random(seed)
    word = lambda: "w" + "".join(rng.choice("abcdefgh") for _ in range(7))
    base = [word() for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(*edits)):
            k = rng.randrange(len(own))
            own[k : k + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("edits", [(1, 12), (4, 8), (8, 20)])
def test_a_group_of_near_copies_equals_brute_force(spark, edits):
    texts = dict(enumerate(copies(150, 60, edits, seed=edits[0])))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, words_each=2).collect()}
    assert got == linked(texts, 2)


def sets_table(spark, sets):
    return spark.createDataFrame([(k, len(s), s.view("int64").tolist(), minhash.marks(s).view("int64").tolist()) for k, s in enumerate(sets)], "id bigint, n bigint, shingles array<bigint>, marks array<bigint>")


def test_prefix_join_loses_no_link(spark):
    """Every pair of the similarity is among the pairs, whatever the components, and far fewer than all are made."""
    texts = [t for seed in range(3) for t in copies(60, 50, (1, 20), seed)]
    sets = [minhash.shingles(t, 2, minhash._Words()) for t in texts]
    df = sets_table(spark, sets)
    members = df.select("id", F.col("id").alias("component"))
    pairs = {(r.u, r.v) for r in minhash.prefix_pairs(members, df, 80).collect()}
    plain = [set(s.tolist()) for s in sets]
    want = {(i, j) for i, a in enumerate(plain) for j, b in enumerate(plain) if i < j and 100 * len(a & b) >= 80 * len(a | b)}
    assert want and want <= pairs and len(pairs) < len(texts) * (len(texts) - 1) / 4


def test_copies_of_one_group_make_few_pairs(spark):
    """Of a group that is one component, no pairs are made; members that it does not reach make few."""
    texts = copies(200, 80, (1, 5), 4)
    sets = [minhash.shingles(t, 2, minhash._Words()) for t in texts]
    df = sets_table(spark, sets)
    assert minhash.prefix_pairs(df.select("id", F.lit(0).cast("bigint").alias("component")), df, 80).count() == 0


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}


def test_decontamination(spark):
    items = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "tiny item"), (3, ""), (4, None)]
    docs = [(1, "x y " + items[0][1].upper().replace(" ", ",\n") + " z"), (2, "alpha beta gamma delta epsilon and nothing more of it at all here"), (3, "one Tiny ITEM more"), (4, None), (5, ""), (6, "item tiny"),
            (1, "second row with the same id"), (None, items[0][1]), (8, "q " + items[0][1].rsplit(" ", 1)[0])]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, leak_kept int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(((r.doc_id, r.item_ids, r.leak_kept) for r in decontaminate.decontaminate(d, b).collect()), key=str)
    want = [(1, [1], False), (1, [1], False), (2, None, True), (3, [2], False), (4, None, True), (5, None, True), (6, None, True), (8, [1], False), (None, [1], False)]
    assert got == sorted(want, key=str)
    assert decontaminate.decontaminate(d, b.limit(0)).where("leak_kept").count() == len(docs)
    assert decontaminate.decontaminate(d.limit(0), b).count() == 0


def test_leaks_without_id_leave_other_rows_without_id(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(None, f"x {item} y"), (None, "a clean text of its own"), (None, None), (None, ""), (1, "clean")], "doc_id bigint, text string")
    out = decontaminate.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert {r.text: r.leak_kept for r in out.collect()} == {f"x {item} y": False, "a clean text of its own": True, None: True, "": True, "clean": True}


def test_decontamination_finds_passages(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    passages = [(r.item_id, flat(r.text)) for r in items.collect()]
    want = {r.doc_id: sorted(i for i, p in passages if p in flat(r.text)) for r in docs.collect()}
    got = {r.doc_id: sorted(r.item_ids or []) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == want and any(want.values())


def _weighted(a, b):
    weigh = lambda ws: {tuple(ws[k : k + 5]): sum(map(len, ws[k : k + 5])) for k in range(len(ws) - 4)}
    x, y = weigh(a), weigh(b)
    both = sum(x[s] for s in x if s in y)
    return both / (sum(x.values()) + sum(y.values()) - both)


def test_rotated_and_shifted_passages_are_found(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words[30:] + words[:30]), "x " * 9 + " ".join(words[20:] + words[:20]) + " y" * 9, " ".join(words[5:]), " ".join(words[30:])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id for r in decontaminate.matches(d, spark.createDataFrame([(1, texts[0])], "item_id bigint, text string")).collect()}
    assert found == {0, 1, 2, 3}


def test_recall_on_edited_passages(spark):
    """Passages edited at the start, the end or within, held against brute force over all windows: at least 0.95 are found, and nothing else."""
    rng = random.Random(8)
    items = {r.item_id: re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    odd = lambda n: ["q" + "".join(rng.choice("bcdfg") for _ in range(rng.randint(1, 7))) for _ in range(n)]
    docs, want = [], set()
    for i, words in items.items():
        for n in range(1, 5):
            at = rng.randrange(len(words) - n)
            for own in ([*words[:-n], *odd(n)], [*odd(n), *words[n:]], [*words[:at], *odd(n), *words[at + n :]], [*words[:at], *odd(n), *words[at:]], [*words[:at], *words[at + n :]]):
                doc = [*odd(6), *own, *odd(6)]
                if max(_weighted(doc[max(0, s) : s + len(words)], words) for s in range(5 - len(words), len(doc) - 4)) >= 0.8:
                    want.add((len(docs), i))
                docs.append((len(docs), " ".join(doc)))
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id bigint, text string"), b).collect()}
    assert len(want) > 200 and found <= want and len(found) >= 0.95 * len(want)


def test_blocks_guarantee_the_radius_and_select(spark):
    """All fingerprints within the radius meet, and few of the others do."""
    rng = random.Random(6)
    items = [rng.getrandbits(63) for _ in range(100)]
    near = []
    for k, x in enumerate(items):
        for n in range(0, 11, 2):
            y = x
            for b in rng.sample(range(63), n):
                y ^= 1 << b
            near.append((y, k))
    far = [rng.getrandbits(63) for _ in range(2000)]
    prints = spark.createDataFrame([(y,) for y, _ in near] + [(y,) for y in far], "print bigint").distinct()
    table = spark.createDataFrame(list(enumerate(items)), "item_id int, item_print bigint")
    got = {(r["print"], r.item_id) for r in decontaminate.near_prints(prints, table, 10).collect()}
    assert got == {(y, k) for y in {y for y, _ in near} | set(far) for k, x in enumerate(items) if (x ^ y).bit_count() <= 10} >= set(near)
    keys = lambda df, c: df.select(c, F.explode(decontaminate.block_keys(F.col(c), 10)).alias("key"))
    met = keys(prints, "print").join(keys(table, "item_print"), "key").count()
    assert met < 0.15 * prints.count() * len(items)


def test_packed_counters_equal_counting_bit_by_bit(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b"],), ([f"w{k}" for k in range(40)],), (["x"] * 300 + ["y"] * 299,), ([],)], "words array<string>")
    out = decontaminate.with_simhash(df, "words", "packed").select("packed", decontaminate._simhash_by_bit(F.col("words")).alias("plain")).collect()
    assert all(r.packed == r.plain for r in out) and len({r.packed for r in out}) > 2


def test_decontamination_odd_texts(spark):
    """A very long text, a clashing column, repeated rows and an empty table of documents."""
    item = " ".join(f"w{k}" for k in range(20))
    long = "z " * 30_000 + item + " y" * 30_000
    d = spark.createDataFrame([(1, long, "a"), (1, long, "a"), (2, "z " * 30_000, "b")], "doc_id bigint, text string, leak_doc string")
    out = decontaminate.decontaminate(d, spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id bigint, text string"))
    assert sorted((r.doc_id, r.leak_doc, r.item_ids, r.leak_kept) for r in out.collect()) == [(1, "a", [1, 2], False)] * 2 + [(2, "b", None, True)]


def _edited(texts):
    order = sorted(texts, reverse=True)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        n = len(texts[i])
        yield i, j, texts[i][: n - n // 3] + texts[j][: n // 3]


def test_fingerprints(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()} | {-5: "", -4: "...", -3: "word"}
    texts[-9] = texts[3]
    df = spark.createDataFrame([(i, t or None, 0) for i, t in texts.items()], "doc_id bigint, text string, n_chars int")
    got = {r.doc_id: r for r in spotsigs.fingerprints(df.repartition(3), bucket_rows=20).collect()}
    assert set(got) == set(texts)
    cut = lambda s: {s[k : k + 8] for k in range(0, len(s), 8)}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, j, edited in _edited(texts):
        r = got[i]
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - alike(cut(r.fingerprint), cut(r.edited_fingerprint))) < 1e-9
        assert abs(r.near_next - alike(cut(r.fingerprint), cut(got[j].fingerprint))) < 1e-9
    assert got[-9].fingerprint == got[3].fingerprint and got[-5].fingerprint == "" and got[-4].fingerprint != ""


def test_fingerprint_edges(spark):
    one = spotsigs.fingerprints(spark.createDataFrame([(1, "the quick brown fox")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    same = spark.createDataFrame([(1, "the quick"), (1, "the quick"), (None, "of something"), (None, None)], "doc_id bigint, text string")
    assert spotsigs.fingerprints(same).count() == 4
    assert spotsigs.fingerprints(same.limit(0)).count() == 0


def test_ranges_are_even_for_uneven_ids(spark):
    """An outlier, clustered ids and many equal ids leave the other buckets even; order is kept."""
    ids = [*range(20_000), 2**60, *range(10**9, 10**9 + 5000), *range(-10**12, -10**12 + 3000), *([7] * 500), None]
    df = spark.createDataFrame([(i, "x") for i in ids], "doc_id bigint, text string")
    ranges = spotsigs.ranges_of(df, 500)
    got = df.select("doc_id", ranges.bucket(F.col("doc_id")).alias("bucket")).toPandas()
    assert got.groupby("bucket").size().max() <= 1500
    known = got.dropna().sort_values("doc_id", kind="stable")
    assert known["bucket"].is_monotonic_increasing and got[got["doc_id"].isna()]["bucket"].iloc[0] == got["bucket"].min()
    wide = spotsigs.Ranges(ranges.bounds, ranges.high, 3)
    assert df.select("doc_id", wide.bucket(F.col("doc_id")).alias("bucket")).toPandas().dropna().sort_values("doc_id", kind="stable")["bucket"].is_monotonic_increasing


def signatures_by_hand(text):
    """Anchors with their chains, read word by word."""
    words, anchors = re.findall(r"[^\W_]+", text.lower()), set(spotsigs.ANCHORS)
    out = set()
    for k, w in enumerate(words[:-1]):
        if w in anchors and words[k + 1] not in anchors:
            second = words[k + 2] if k + 2 < len(words) and words[k + 2] not in anchors else None
            out.add((w, words[k + 1], second))
    return out


def test_signatures_equal_brute_force(spark):
    """As many signatures as by hand, equal exactly where those are equal, and the same likeness."""
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()][:120]
    texts += [t + " the end" for t in texts[:20]]
    rows = [(k, t) for k, t in enumerate(texts) if signatures_by_hand(t)]
    got = {r.doc_id: frozenset(r.signatures) for r in spotsigs.with_signatures(spark.createDataFrame(rows, "doc_id bigint, text string"), "text", "signatures").collect()}
    by_hand = {k: signatures_by_hand(t) for k, t in rows}
    assert len(rows) > 80 and all(len(got[k]) == len(by_hand[k]) for k in got)
    for i in list(got)[:40]:
        for j in got:
            assert len(got[i] & got[j]) == len(by_hand[i] & by_hand[j])


def test_likeness_is_pruned_by_length(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2]), ([1, 2], [1, 2]), ([], []), ([1], [])], "a array<int>, b array<int>")
    got = [tuple(r) for r in df.select(spotsigs.likeness(F.col("a"), F.col("b")), spotsigs.likeness(F.col("a"), F.col("b"), 0.6)).collect()]
    assert got == [(0.5, 0.0), (1.0, 1.0), (1.0, 1.0), (0.0, 0.0)]


@pytest.mark.parametrize("percent", [44, 60, 80])
def test_alike_sets_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    sets = {frozenset(range(1000, 1000 + n)) for n in (1, 2, 3, 4, 5, 11, 25, 44, 60, 80, 100)}
    for _ in range(25):
        base = rng.sample(range(400), rng.randint(1, 60))
        sets |= {frozenset(rng.sample(base, rng.randint(1, len(base)))) | frozenset(rng.sample(range(400), rng.randint(0, 5))) for _ in range(6)}
    sets = dict(enumerate(sorted(sets, key=sorted)))
    got = {(*sorted((r.a, r.b)), r.similarity) for r in spotsigs.alike_sets(spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "set_id bigint, signatures array<int>"), percent).collect()}
    want = {(i, j, len(x & y) / len(x | y)) for i, x in sets.items() for j, y in sets.items() if i < j and 100 * len(x & y) >= percent * len(x | y)}
    assert got == want and len(want) > 5


def test_alike_documents_need_not_be_neighbours(spark):
    """Every two documents that reach the similarity, whatever their ids, against brute force."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    some = sorted(texts)[:20]
    odd = [(10**6 + i, texts[i] + " the final remark of this author") for i in some] + [(2 * 10**6 + i, texts[i]) for i in some] + [(3 * 10**6, ""), (3 * 10**6 + 1, None), (None, texts[0])]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    sets = {r.doc_id: frozenset(r.signatures) for r in spotsigs.with_signatures(docs.where("doc_id is not null"), "text", "signatures").collect()}
    got = [tuple(r) for r in spotsigs.alike(docs).collect()]
    least = {}
    for i in sorted(sets):
        least.setdefault(sets[i], i)
    alike = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    reps = sorted(least.values())
    want = [(least[x], i, 1.0) for i, x in sets.items() if least[x] != i] + [(i, j, alike(sets[i], sets[j])) for k, i in enumerate(reps) for j in reps[k + 1 :] if 100 * len(sets[i] & sets[j]) >= 44 * len(sets[i] | sets[j])]
    assert sorted(got) == sorted(want) and sum(j >= 10**6 for _, j, _ in got) >= 40
