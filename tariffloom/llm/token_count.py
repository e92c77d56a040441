"""Token counts by a map-side lookup in two tiers.

The first tier is a compact table from frequent pieces of text to their
numbers of tokens, made once and broadcast. The second is a cache in each
Python worker, filled by the tokenizer library for what the first lacks.
Pieces are looked up where their text is, without a shuffle. Only making the
table shuffles pieces: each task's sums over a bounded sample of rows are
grouped by piece. Other rows do not take part in that statistic.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CHUNK, Generations
from .common import bound_batches, light_task

#: Rows that the frequent pieces are counted on (a bounded sample; it decides speed, never results).
SAMPLE_ROWS = 4_000
#: Entries of the broadcast table, and characters of the longest: about 5 MB at most.
TABLE_ENTRIES, ENTRY_CHARS = 50_000, 24
CACHE_ENTRIES = 1 << 19
BATCH_CHARS = 2_000_000


class Counts:
    """Numbers of tokens for pieces of text, after one tokenizer file.

    ``frequent``: pieces and their counts from the broadcast table.
    """

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = set(special)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.frequent, self.seen = frequent, Generations(CACHE_ENTRIES)

    def exact(self, pieces: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str]:
        """The text cut in places where the tokenizer cuts it as well."""
        if not self.special or not any(s in text for s in self.special):
            return CHUNK.findall(text)
        return [c for part in self.cut.split(text) for c in ([part] if part in self.special else CHUNK.findall(part))]

    def batch(self, texts: list[str | None]) -> Iterator[int]:
        waiting: list[tuple[int, list[str]]] = []
        wanted: set[str] = set()
        size = 0
        for text in texts:
            pieces = self.pieces(text or "")
            found = list(map(self.frequent.get, pieces))
            if None in found:
                rest = [p for p, n in zip(pieces, found, strict=True) if n is None]
                wanted.update(rest)
                waiting.append((sum(filter(None, found)), rest))
            else:
                waiting.append((sum(found), []))
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield from self._flush(waiting, wanted)
                waiting, wanted, size = [], set(), 0
        yield from self._flush(waiting, wanted)

    def _flush(self, waiting: list[tuple[int, list[str]]], wanted: set[str]) -> Iterator[int]:
        self.seen.make_room(len(wanted))
        new = self.seen.missing(wanted)
        self.seen.young.update(zip(new, self.exact(new), strict=True))
        get = self.seen.young.__getitem__
        for known, rest in waiting:
            yield known + sum(map(get, rest))
        self.seen.drop_long(wanted)


@lru_cache(maxsize=2)
def _counts(path: str, key: str, table: "Frequent") -> Counts:
    return Counts(path, table.value)


class Frequent:
    """The broadcast table, as the same object for all calls in a worker."""

    def __init__(self, broadcast):
        self.broadcast, self.key = broadcast, repr(broadcast)

    @property
    def value(self) -> dict[str, int]:
        return self.broadcast.value

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Frequent) and self.key == other.key


def frequent_table(docs: DataFrame, tokenizer_path: str, *, sample_rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Counts of tokens for pieces that are frequent in a bounded sample of rows.

    Each task counts pieces in its own sampled rows and sends its most
    frequent ones; their sum has at most ``entries`` entries.
    """
    rows = docs.count()
    if not rows:
        return {}
    share = min(1.0, sample_rows / rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(p for p in CHUNK.findall(text or "") if len(p) <= ENTRY_CHARS)
        # what one task may send falls with the share that it stands for
        top = [(p, n) for p, n in seen.most_common(entries) if n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    sample = docs.select("text").where(F.rand(7) < share)
    found = sample.mapInArrow(run, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r.piece for r in found.orderBy(F.desc("n"), "piece").limit(entries).collect()]
    counts = Counts(tokenizer_path, {})
    return dict(zip(pieces, counts.exact(pieces), strict=True))


def token_counts(docs: DataFrame, tokenizer_path: str, *, limit: int = 512, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    Null and empty texts have no bytes and no tokens. Special strings inside
    texts count as the library takes them by default. Repeated rows and null
    doc_ids stay as they are; other columns are ignored. An empty table gives
    an empty result.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    frequent = Frequent(docs.sparkSession.sparkContext.broadcast(frequent_table(docs, tokenizer_path, sample_rows=sample_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(tokenizer_path, frequent.key, frequent)
        with light_task(counts.seen.forget):
            for batch in batches:
                numbers = pa.array(list(counts.batch(batch.column(1).to_pylist())), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), numbers], names=["row", "n_tokens"])

    bytes_and_text = docs.select("doc_id", "text")
    counted = bytes_and_text.select(F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")).alias("row"), "text").mapInArrow(run, f"row struct<doc_id: {dict(docs.dtypes)['doc_id']}, n_bytes: bigint>, n_tokens bigint")
    return counted.select("row.doc_id", "row.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
