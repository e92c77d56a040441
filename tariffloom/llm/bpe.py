"""Byte-level BPE: speculate with greedy longest match, verify every pair.

``ByteBpe`` loads a public ``tokenizers`` JSON file. A text is cut into
chunks at white space, in places where the tokenizer's own pattern always
cuts. Chunks that a worker has not met yet are encoded together:

1. *speculate*: one pass of an Aho-Corasick automaton over all their words
   proposes the greedy longest vocabulary entries;
2. *verify*: numpy tests every adjacent pair of proposed tokens at once. A
   pair is compatible if no merge crosses the border between the two while
   both sides are rebuilt from bytes in order of rank. A sequence of stable
   tokens of which every adjacent pair is compatible is what exact merging
   gives;
3. *repair*: only words with a failing pair are merged exactly, with a heap
   over a linked list (n log n, so words of any length are fine).

Encoded chunks are kept in a bounded cache for each Python worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import bound_batches, light_task

#: The white space of the tokenizers' patterns (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-token pattern of byte-level BPE files that use "use_regex".
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Any pre-token lies within one of these chunks.
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Marks that form one pre-token at the end of a word.
MARKS = ".,;:!?*#$%&|()"
CACHE_ENTRIES = 1 << 18
BATCH_CHARS = 1_000_000
#: Characters from which on a piece of text is not remembered.
LONG = 256
TOGETHER_LENGTH = 40
SEPARATOR = "\u0100"
#: Below this code point the regex module and the library agree on letters and numbers.
PLAIN_LIMIT = "\u0250"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Generations:
    """A dictionary of bounded size that keeps what was used of late."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.young, self.old = entries, {}, {}

    def make_room(self, coming: int) -> None:
        if len(self.young) + coming > self.entries:
            self.young, self.old = {}, self.young

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def drop_long(self, keys: Iterable[str]) -> None:
        """Forget keys that are too long to come again, so that the entries bound the bytes as well."""
        for k in keys:
            if len(k) > LONG:
                self.young.pop(k, None)

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that neither generation has; those that the older has become young again."""
        new = keys.difference(self.young)
        if self.old:
            known = [k for k in new if k in self.old]
            self.young.update((k, self.old[k]) for k in known)
            new.difference_update(known)
        return list(new)


class ByteBpe:
    """Exact encoder and decoder for one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in token): k for token, k in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.token_bytes[k] = token
        for text, k in self.special.items():
            self.token_bytes[k] = text.encode()
        self.byte_id = np.array([vocab[bytes([b])] for b in range(256)])
        # birth: the rank of the merge that makes a token, -1 for single bytes
        self.birth = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        self.size = size
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y = (vocab[bytes(alphabet[c] for c in part)] for part in (a, b))
            made = vocab[self.token_bytes[x] + self.token_bytes[y]]
            self.merges[x, y] = rank, made
            if self.birth[made] < 0:
                self.birth[made], self.left[made], self.right[made] = rank, x, y
        keys = np.array([x * size + y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self.merge_keys = keys[order]
        self.merge_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.never = len(self.merges)
        self.automaton = ahocorasick.Automaton()
        for token, k in vocab.items():
            self.automaton.add_word(token.decode("latin-1"), k)
        self.automaton.make_automaton()
        self.stable = self._stable()
        self.lengths = np.array(list(map(len, self.token_bytes)), np.int64)
        self.made_by_rank = np.array([made for _, made in self.merges.values()], np.int64)
        self.cache, self.words = Generations(), Generations(CACHE_ENTRIES // 2)
        self._library = None
        self.proposed = self.repaired = 0

    def forget(self) -> None:
        """Empty the caches; the tables stay."""
        self.cache.forget()
        self.words.forget()

    def _pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        keys = x.astype(np.int64) * self.size + y
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == keys, self.merge_ranks[at], self.never)

    def compatible(self, a: np.ndarray, b: np.ndarray, bound: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens: does no merge cross the border between them?

        Both tokens are taken apart from the last merge back to bytes. While
        x ends the left side and y starts the right one, a merge of (x, y)
        happens if its rank comes before the merge that ends x, or not after
        the one that ends y (of equal ranks the leftmost goes first).
        ``bound``: only merges of a lower rank count (for stability of a + b).
        """
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        end_x = np.full(len(a), self.never, np.int64) if bound is None else bound.astype(np.int64)
        end_y = end_x if bound is None else end_x - 1
        while len(at):
            rank = self._pair_rank(x, y)
            crossed = (rank < end_x) & (rank <= end_y) & (rank < self.never)
            ok[at[crossed]] = False
            bx, by = self.birth[x], self.birth[y]
            go = ~crossed & ((bx >= 0) | (by >= 0))
            # the younger of the two was made last; equal births: the left one was made first
            undo_x = bx > by
            nx = np.where(undo_x, self.right[x], x)
            ny = np.where(undo_x, y, self.left[y])
            end_x = np.where(undo_x, bx, end_x)
            end_y = np.where(undo_x, end_y, by)
            at, x, y, end_x, end_y = at[go], nx[go], ny[go], end_x[go], end_y[go]
        return ok

    def _stable(self) -> np.ndarray:
        """Tokens that exact merging of their own bytes gives back."""
        made = np.flatnonzero(self.birth >= 0)
        alone = np.zeros(self.size, bool)
        alone[self.byte_id] = True
        own = self.compatible(self.left[made], self.right[made], self.birth[made])
        for k, good in sorted(zip(made.tolist(), own.tolist(), strict=True), key=lambda p: self.birth[p[0]]):
            alone[k] = good and alone[self.left[k]] and alone[self.right[k]]
        return alone

    def merge_exactly(self, word: bytes) -> list[int]:
        """Merge the lowest rank first, the leftmost of equals, until none is left."""
        ids: list[int] = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m[0], k, ids[k], ids[k + 1]) for k in range(len(ids) - 1) if (m := self.merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, x, y = heapq.heappop(heap)
            j = after[k]
            if ids[k] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[k], ids[j] = self.merges[x, y][1], -1
            after[k] = after[j]
            if after[k] < len(ids):
                before[after[k]] = k
            for p, q in ((before[k], k), (k, after[k])):
                if p >= 0 and q < len(ids) and (m := self.merges.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q]))
        return [x for x in ids if x >= 0]

    def merge_together(self, words: list[bytes]) -> list[bytes]:
        """Exact merging of many words of one length, a merge in each at a time."""
        n, length = len(words), len(words[0])
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)].reshape(n, length)
        ids = np.concatenate([ids, np.full((n, 1), -1)], axis=1).astype(np.int32)
        rank = np.full((n, length + 1), self.never, np.int32)
        rank[:, : length - 1] = self._pair_rank(ids[:, : length - 1], ids[:, 1:length])
        live, columns = np.arange(n), np.arange(length + 1)
        done = [b""] * n
        while True:
            at = rank.argmin(axis=1)
            rows = np.arange(len(live))
            least = rank[rows, at]
            over = least == self.never
            if over.any():
                sizes = (ids[over] >= 0).sum(axis=1)
                for k, row, size in zip(live[over].tolist(), ids[over].astype("<u4"), sizes.tolist(), strict=True):
                    done[k] = row[:size].tobytes()
                go = ~over
                ids, rank, live, at, least = ids[go], rank[go], live[go], at[go], least[go]
                if not len(live):
                    return done
                rows = np.arange(len(live))
            moved = columns[None, :-1] + (columns[None, :-1] > at[:, None])
            made = self.made_by_rank[least]
            ids = np.concatenate([np.take_along_axis(ids, moved, 1), np.full((len(live), 1), -1, np.int32)], axis=1)[:, : ids.shape[1]]
            rank = np.concatenate([np.take_along_axis(rank, moved, 1), np.full((len(live), 1), self.never, np.int32)], axis=1)[:, : rank.shape[1]]
            ids[rows, at] = made
            follow = ids[rows, at + 1]
            rank[rows, at] = np.where(follow >= 0, self._pair_rank(made, np.maximum(follow, 0)), self.never)
            led = at > 0
            rank[rows[led], at[led] - 1] = self._pair_rank(ids[rows[led], at[led] - 1], made[led])

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids (little-endian, 32 bits) of each pre-token: speculate, verify, repair."""
        if not words:
            return []
        joined = SEPARATOR.join([w.decode("latin-1") for w in words])
        found = list(self.automaton.iter_long(joined))
        ids = np.fromiter((m[1] for m in found), np.int64, len(found))
        ends = np.fromiter((m[0] for m in found), np.int64, len(found))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        last = np.cumsum(lengths + 1) - 2  # each word's last position in the joined string
        owner = np.searchsorted(last, ends)
        bad = np.bincount(owner, self.lengths[ids], len(words)).astype(np.int64) != lengths
        bad[owner[~self.stable[ids]]] = True
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        fits = self.compatible(pairs // self.size, pairs % self.size)[back]
        bad[owner[inside[~fits]]] = True
        self.proposed += len(words)
        self.repaired += int(bad.sum())
        raw = ids.astype("<u4").tobytes()
        starts = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        out = [raw[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        groups: dict[int, list[int]] = {}
        for k in np.flatnonzero(bad).tolist():
            groups.setdefault(len(words[k]), []).append(k)
        for length, members in groups.items():
            if length > TOGETHER_LENGTH:
                made = [np.array(self.merge_exactly(words[k]), "<u4").tobytes() for k in members]
            else:
                made = self.merge_together([words[k] for k in members])
            for k, x in zip(members, made, strict=True):
                out[k] = x
        return out

    def pretokens(self, chunk: str) -> list[str]:
        stem = chunk.rstrip(MARKS)
        core = stem[1:] if stem[:1] == " " else stem
        if core.isalpha() and (chunk.isascii() or max(core) < PLAIN_LIMIT):
            return [stem] if len(stem) == len(chunk) else [stem, chunk[len(stem) :]]
        if chunk.isascii() or max(chunk) < PLAIN_LIMIT:
            return PRETOKEN_REGEX.findall(chunk)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [chunk[a:b] for _, (a, b) in self._library.pre_tokenize_str(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Add the encoding of new chunks to the caches.

        Both caches have two generations: what was not asked for while one
        generation filled up is forgotten, so memory is bounded.
        """
        for cache in (self.cache, self.words):
            cache.make_room(len(chunks))
        parts: list[list[str]] = []
        for chunk in (new := self.cache.missing(chunks)):
            parts.append(self.pretokens(chunk))
        unknown = self.words.missing({p for own in parts for p in own})
        words = self.words.young
        words.update(zip(unknown, self.encode_words([w.encode() for w in unknown]), strict=True))
        self.cache.young.update((c, words[own[0]] if len(own) == 1 else b"".join([words[p] for p in own])) for c, own in zip(new, parts, strict=True))

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers; null counts as empty."""
        waiting: list[tuple[list[bytes | None], list[int], list[str]]] = []
        wanted: set[str] = set()
        size = 0
        for text in texts:
            values, chunks = self._look_up(text or "")
            places = [k for k, v in enumerate(values) if v is None] if None in values else []
            new = [chunks[k] for k in places]
            wanted.update(new)
            waiting.append((values, places, new))
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield from self._flush(waiting, wanted)
                waiting, wanted, size = [], set(), 0
        yield from self._flush(waiting, wanted)

    def _look_up(self, text: str) -> tuple[list[bytes | None], list[str]]:
        get = self.cache.young.get
        if not self.special or not any(s in text for s in self.special):
            chunks = CHUNK.findall(text)
            return list(map(get, chunks)), chunks
        values, chunks = [], []
        for part in self.special_cut.split(text):
            own = [part] if part in self.special else CHUNK.findall(part)
            values += [self.special[part].to_bytes(4, "little")] if part in self.special else map(get, own)
            chunks += own
        return values, chunks

    def _flush(self, waiting: list, wanted: set[str]) -> Iterator[bytes]:
        if wanted:
            self.learn(wanted)
        young = self.cache.young
        for values, places, new in waiting:
            for k, chunk in zip(places, new, strict=True):
                values[k] = young[chunk]
            yield b"".join(values)
        self.cache.drop_long(wanted)
        self.words.drop_long([w for w in self.words.young if len(w) > LONG] if any(len(c) > LONG for c in wanted) else ())

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the text that the ids stand for, invalid bytes replaced."""
        raw = b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


PRETOKEN_REGEX = regex.compile(PRETOKEN)


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """One encoder for each Python worker and file."""
    return ByteBpe(path)


def encode_decode(docs: DataFrame, tokenizer_path: str, *, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with
    ``keep_ids``, ids (array<int>) and decoded (string). Null and empty texts
    have no tokens; the strings of special tokens inside texts give their own
    ids, as the library does by default. Repeated rows and null doc_ids stay
    as they are; other columns are ignored, whatever their names.
    """
    bound_batches(docs.sparkSession)
    extra = ", ids array<int>, decoded string" if keep_ids else ""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        with light_task(bpe.forget):
            for batch in batches:
                rows: list[tuple] = []
                for ids in bpe.encode_batch(batch.column(1).to_pylist()):
                    decoded = bpe.decode(ids)
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    rows.append((*row, np.frombuffer(ids, "<i4"), decoded.decode()) if keep_ids else row)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()], strict=False)] if rows else [pa.array([], t) for t in [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()][: 5 if keep_ids else 3]]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 1 + len(columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
