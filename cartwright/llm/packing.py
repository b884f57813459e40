"""Packing documents into training sequences by order-preserving dynamic programming."""

from __future__ import annotations

import base64
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class PackSettings:
    """``window``: tokens per sequence, a power of two.  ``sentence_cut`` and ``hard_cut``: the price
    of a cut after a sentence and anywhere else inside a document, in tokens of padding.  ``vocabulary`` has the
    ids, ``ranks`` the same vocabulary in rank form, which encodes faster."""

    window: int = 1024
    sentence_cut: int = 2
    hard_cut: int = 12
    vocabulary: str = field(default_factory=lambda: _public("byte_bpe_50k.json"))
    ranks: str = field(default_factory=lambda: _public("byte_bpe_50k.tiktoken"))
    end_id: int = 0


#: Fixed: how the byte-level vocabulary splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    Texts are encoded with the rank form of the vocabulary, which is several times
    faster; those that hold the special token's name go to the vocabulary file's own library.
    """

    def __init__(self, settings: PackSettings):
        import tiktoken
        from tokenizers import Tokenizer

        with open(settings.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(settings.vocabulary)
        # Ids after which a sentence may end.
        self.ends = np.zeros(max(self.whole.get_vocab_size(), max(ranks.values()) + 1), bool)
        for token, k in ranks.items():
            self.ends[k] = token.strip()[-1:] in (b".", b"!", b"?") or b"\n" in token

    def encode(self, text: str) -> bytes:
        if SPECIAL in text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return array("I", ids).tobytes()


@lru_cache(maxsize=1)
def encoder(settings: PackSettings) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(settings)


def cuts(boundaries: np.ndarray, price: np.ndarray, window: int) -> list[int]:
    """Where to cut a run of tokens: ascending positions, the last is the run's end.

    ``boundaries`` ascend from the first possible cut to the end of the run, no
    two more than ``window`` apart.  best[j] = price[j] + min over i in reach of
    best[i] + window - (j - i): the minimum of best[i] + i over a sliding range of
    positions, kept in a monotone queue.  A sequence as long as a power of two needs
    no padding; those steps are tried where a document ends.
    """
    at = [0, *boundaries.tolist()]
    cost = [0, *price.tolist()]
    place = {p: k for k, p in enumerate(at)}
    best, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best[i] + i, i), ascending
    sizes = [1 << k for k in range(window.bit_length() - 1)]
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - window:
            queue.popleft()
        value, origin = queue[0]
        value += window - here
        if not cost[j]:
            for size in sizes:
                i = place.get(here - size)
                if i is not None and best[i] < value:
                    value, origin = best[i], i
        value += cost[j]
        best[j], back[j] = value, origin
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def possible_cuts(ids: np.ndarray, ends: np.ndarray, doc_ends: np.ndarray, s: PackSettings) -> tuple[np.ndarray, np.ndarray]:
    """Positions and prices: document ends are free, sentence ends cheap, and where
    neither comes for a quarter window, hard cuts close the gap.  The last
    tokens of the run also get hard cuts at each power of two before the end."""
    end = int(doc_ends[-1])
    price = np.full(end + 1, -1, np.int64)
    price[np.flatnonzero(ends[ids]) + 1] = s.sentence_cut
    grid = np.arange(s.window, end, s.window)
    price[grid[price[grid] < 0]] = s.hard_cut
    price[doc_ends] = 0
    price[0] = -1
    known = np.flatnonzero(price >= 0)
    gaps = np.diff(np.concatenate(([0], known)))
    step = max(1, s.window // 4)
    for k in np.flatnonzero(gaps > step):
        start = known[k] - gaps[k]
        price[np.arange(start + step, known[k], step)] = s.hard_cut
    rest = end - (1 << np.arange(s.window.bit_length()))
    rest = rest[rest > 0]
    price[rest[price[rest] < 0]] = s.hard_cut
    at = np.flatnonzero(price >= 0)
    return at, price[at]


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(texts: list[str | None], keys: list, s: PackSettings, first_id: int) -> tuple[list[tuple], int]:
    """Pieces of one run of documents, and how many sequences they fill."""
    code = encoder(s)
    end = np.array([s.end_id], "<u4").tobytes()
    blobs = [code.encode(t or "") + end for t in texts]
    ids = np.frombuffer(b"".join(blobs), "<u4")
    doc_ends = np.cumsum([len(b) // 4 for b in blobs])
    at = cuts(*possible_cuts(ids, code.ends, doc_ends, s), s.window)
    rows, doc, start, begin = [], 0, 0, 0
    for number, stop in enumerate(at):
        here = begin
        while here < stop:
            doc_end = int(doc_ends[doc])
            size = min(stop, doc_end) - here
            total = len(blobs[doc]) // 4
            crc = zlib.crc32(memoryview(blobs[doc])[4 * start : 4 * (start + size)])
            rows.append((keys[doc], start, size, crc, total, first_id + number, here - begin))
            here, start = here + size, start + size
            if here == doc_end:
                doc, start = doc + 1, 0
        begin = stop
    return rows, len(at)


def pack(docs: DataFrame, settings: PackSettings | None = None, run_chars: int = 2_000_000) -> DataFrame:
    """One row per piece; every id of every row lies in exactly one piece.

    Each task packs the rows it reads in their order, without a shuffle, in runs of
    about ``run_chars`` characters, so a task remembers one run.  A sequence id is
    unique: the task's number times 2 ** 40 and a counter, the same when a lost
    task is repeated.  A null text is empty and still has its end id; null and repeated
    doc_ids are packed like others; an empty table gives no rows.
    """
    s = settings or PackSettings()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last] or "") < run_chars):
                    size += len(texts[last] or "")
                    last += 1
                rows, used = _packed(texts[first:last], keys[first:last], s, next_id)
                next_id, first = next_id + used, last
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, SCHEMA)
