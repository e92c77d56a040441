"""BPE, token counts and the token store against the tokenizer library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tariffloom.llm import bpe, token_count, token_store

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = [*"abcdeghinorst THE'\n\t  0123.,!?-éßñΣİ", "<|endoftext|>", "<|startoftext|>", "'s", "\x1c", "\u3000", "\u0301", "漢", "😀", "\u200b", "ing", "tion", "\xa0", "aaaa", "\u0663", "\u2167", "\x85"]


def texts(n=1500, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def rows(spark):
    some = [(3, "the thing"), (1, ""), (2, None), (5, "again again"), (5, "again again"), (4, "x" * 50_000 + " end"), (None, "no id"), (0, "a  <|endoftext|> b")]
    return spark.createDataFrame([(i, t, "clash", 9) for i, t in some], "doc_id bigint, text string, n_tokens string, start int"), some


def test_encoder_equals_library():
    own, library = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for text, ids in zip(texts(), own.encode_batch(texts()), strict=True):
        got = np.frombuffer(ids, "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids).decode() == library.decode(got, skip_special_tokens=False) == text
    assert own.proposed > own.repaired > 0


def test_pairs_decide_validity():
    own = bpe.ByteBpe(BYTE)
    rng = np.random.default_rng(1)
    good = np.flatnonzero(own.stable & (own.lengths > 0))
    a, b = rng.choice(good, 3000), rng.choice(good, 3000)
    for x, y, fits in zip(a, b, own.compatible(a, b), strict=True):
        assert (own.merge_exactly(own.token_bytes[x] + own.token_bytes[y]) == [x, y]) == fits


def test_words_equal_library():
    own, library = token_store.WordEncoder(WORD), Tokenizer.from_file(WORD)
    some = [None, "", *texts(), " ", None, "a b"]
    for given in (some, texts(40, 9), [], ["", None], ["\n"]):
        ids, sizes = own.encode(pa.array([*given, "cut off"], pa.string()).slice(0, len(given)), 2)
        want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in given]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [x for own_ids in want for x in own_ids]


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 2**32 - 1])
def test_segments(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    ids[::97] = 2**31
    data = token_store.encode_segment(ids)
    assert (token_store.decode_segment(data) == ids).all()
    if n > 1030:
        assert (token_store.decode_segment(data, 1020, 9) == ids[1020:1029]).all()


def test_outliers_are_exceptions():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[7] = 40_000
    assert len(token_store.encode_blocks(ids[None])[0]) < 9 + 6 + 1024 // 2 + 8


def test_encode_decode(spark):
    df, given = rows(spark)
    got = bpe.encode_decode(df, BYTE, keep_ids=True).collect()
    library = Tokenizer.from_file(BYTE)
    assert len(got) == len(given)
    for r in got:
        text = dict(given)[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == text
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_decode(df.limit(0), BYTE).count() == 0


def test_token_counts(spark):
    df, given = rows(spark)
    library = Tokenizer.from_file(BYTE)
    got = token_count.token_counts(df, BYTE, limit=3).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, len((t or "").encode()), n, n > 3) for i, t in given for n in [len(library.encode(t or "", add_special_tokens=False).ids)]), key=str)
    assert token_count.token_counts(df.limit(0), BYTE).count() == 0


def test_store_round_trip(spark):
    df, given = rows(spark)
    library = Tokenizer.from_file(WORD)
    start, want = 0, []
    for i, t in sorted(given, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_store.store_round_trip(df.repartition(3), WORD)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert token_store.store_round_trip(df.limit(0), WORD).count() == 0


def test_long_pieces_are_not_remembered():
    long = ["x" * 5000 + str(k) for k in range(20)]
    own = bpe.ByteBpe(BYTE)
    assert len(list(own.encode_batch([*long, "a b c"]))) == 21
    assert max(map(len, [*own.cache.young, *own.words.young])) <= bpe.LONG
    counts = token_count.Counts(BYTE, {})
    assert len(list(counts.batch([*long, "a b c"]))) == 21 and max(map(len, counts.seen.young)) <= bpe.LONG
    words = token_store.WordEncoder(WORD, entries=10)
    for _ in range(3):
        ids, sizes = words.encode(pa.array([*long, "a b c"]), 2)
        assert len(ids) == sizes.sum() and max(map(len, words.places)) <= bpe.LONG
