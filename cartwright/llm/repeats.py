"""Exact removal of repeated byte strings, with a suffix array per shard.

1. Every window of ``length`` bytes has an anchor, its k-gram with the smallest hash. Equal
   windows have equal anchors, so it suffices to compare windows with one. The windows of
   a text that share an anchor form a piece.
2. Anchors that occur once are dropped. Equal pieces collapse into one; where there were several,
   all of their windows repeat.
3. Where an anchor has different pieces, these are trimmed: a window holds, left or right of the anchor, half of
   what it holds beside it, so a side whose half no other piece has can repeat nothing.
4. Shards of what is left are sorted into a suffix array. On
   its Burrows-Wheeler transform, breadth-first backward extension derives the common
   prefixes by increasing length and stops at ``length``: neighbours
   whose boundary has not been reached by then share a whole window.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.batches import hashes, pieces, prefix_sums, utf8
from cartwright.session import shared_dir


@dataclass(frozen=True)
class RepeatSettings:
    """``length``: bytes of a string that must not repeat; ``gram``: bytes of an anchor;
    ``shard_bytes``: of one suffix array. An anchor with more bytes of different pieces
    is dealt to several shards, whose windows are then compared by digest."""

    length: int = 200
    gram: int = 32
    shard_bytes: int = 2_000_000


#: Bits of the position in the values whose minimum is sought; the rest are the hash.
PLACE = np.uint64((1 << 28) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, s: RepeatSettings) -> tuple[np.ndarray, ...]:
    """Of a run of texts: document, first and last window start of each piece, start of the anchor after the
    first of them, anchor hash, content hash."""
    none = np.empty(0, np.int64)
    if len(data) < s.length:
        return (none,) * 6
    sums = prefix_sums(data)
    at = np.arange(len(data) - s.gram + 1)
    gram = hashes(sums, at, at + s.gram)
    low = (gram & ~PLACE) | at.astype(np.uint64)
    width, reach = s.length - s.gram + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    # Windows that end in the text they start in.
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), np.maximum(sizes - s.length + 1, 0))
    if not len(doc):
        return (none,) * 6
    skipped = np.cumsum(np.concatenate(([0], np.minimum(sizes, s.length - 1)[:-1])))
    start = np.arange(len(doc)) + skipped[doc]
    place = (low[start] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    a, b, d = start[first], start[last], doc[first]
    content = hashes(sums, a, b + s.length)
    at = place[first]
    return d, a - offsets[d], b - offsets[d], at - a, gram[at].view(np.int64), content.view(np.int64)


PIECES = "doc_id long, row long, a int, b int, p int, anchor long, content long"


def all_pieces(docs: DataFrame, s: RepeatSettings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids, rows = batch.column("doc_id"), batch.column("row")
            for first, last in pieces(offsets, 300_000):
                lo, hi = offsets[first], offsets[last]
                d, *places, anchor, content = anchors(data[lo:hi], offsets[first : last + 1] - lo, s)
                which = pa.array(d + first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(which), rows.take(which), *(pa.array(x.astype(np.int32)) for x in places), pa.array(anchor), pa.array(content)],
                    names=["doc_id", "row", "a", "b", "p", "anchor", "content"],
                )

    return docs.select("doc_id", "row", "text").mapInArrow(run, PIECES)


def suffix_array(symbols: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more, equal ones by position.

    ``left``: symbols up to the end mark, which is 0 and ends a suffix. Seven symbols make the first
    key, then each round doubles the compared length of those that are still tied.
    """
    n = len(symbols)
    key = np.zeros(n, np.int64)
    for k in range(7):
        ahead = np.zeros(n, np.int64)
        ahead[: n - k] = symbols[k:]
        ahead[left < k] = 0
        key = key << 9 | ahead
    order = np.argsort(key, kind="stable")
    # A rank is the slot of the first suffix with the same key, so that later rounds change those of tied ones only.
    slots, tied, keys, reach = np.arange(n), order, key[order], 7
    rank = np.empty(n, np.int64)
    while True:
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        head = np.maximum.accumulate(np.where(new, slots, 0))
        rank[tied] = head + 1
        alone = new & np.concatenate((new[1:], [True]))
        slots, tied = slots[~alone], tied[~alone]
        if reach >= depth or not len(tied):
            return order
        ahead = np.where(left[tied] < reach, 0, rank[np.minimum(tied + reach, n - 1)])
        keys = rank[tied] * (n + 1) + ahead
        turn = np.argsort(keys, kind="stable")
        tied, keys = tied[turn], keys[turn]
        order[slots] = tied
        reach *= 2


def long_prefixes(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix array: does the suffix share ``length`` symbols with the one before it?

    Level by level, the intervals of the strings of l symbols are extended by every symbol that stands
    before one of their suffixes. The end of an extended interval that was not an end before has a common
    prefix of l symbols. What is no end after ``length`` levels shares at least so many.
    """
    n = len(symbols)
    bwt = symbols[order - 1].astype(np.int64)
    bwt[order == 0] = 0
    counts = np.bincount(symbols, minlength=258)
    first = np.concatenate(([0], np.cumsum(counts)))
    used = np.flatnonzero(np.bincount(bwt, minlength=258))
    used = used[used > 0]
    occurs = np.argsort(bwt.astype(np.int16), kind="stable")
    keys = bwt[occurs] * (n + 1) + occurs
    # Where a suffix goes when its preceding symbol is put in front: equal symbols keep their order.
    goes = np.empty(n, np.int64)
    goes[occurs] = np.arange(n)

    def extended(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all one-symbol extensions of the intervals low to high."""
        size = high - low
        # Of one suffix, of fewer than symbols are worth asking for, of many.
        one, many = size == 1, size > 2 * len(used)
        at = low[one]
        at = goes[at[bwt[at] > 0]]
        lows, highs = [at], [at + 1]
        few = np.flatnonzero(~one & ~many)
        if len(few):
            sizes = size[few]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[few], sizes)
            pair = np.repeat(few, sizes) * 512 + bwt[at]
            turn = np.argsort(pair, kind="stable")
            at, pair = at[turn], pair[turn]
            new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            times = np.diff(np.concatenate((new, [len(pair)])))
            real = (pair[new] & 511) > 0
            at = goes[at[new[real]]]
            lows.append(at)
            highs.append(at + times[real])
        if many.any():
            base = np.tile(used * (n + 1), int(many.sum()))
            x = np.searchsorted(keys, base + np.repeat(low[many], len(used)))
            y = np.searchsorted(keys, base + np.repeat(high[many], len(used)))
            lows.append(x[y > x])
            highs.append(y[y > x])
        return np.concatenate(lows), np.concatenate(highs)

    ends = np.zeros(n + 1, bool)
    ends[[0, n]] = True
    # Strings of one symbol; the end mark is one as well, but is never put in front of another.
    low, high = first[:-1][counts > 0], first[1:][counts > 0]
    ends[high] = True
    for _ in range(1, length):
        low, high = extended(low, high)
        fresh = ~ends[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        ends[high] = True
    return ~ends[:n]


def repeated_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """For every window of every text: is it there more than once, and is it the first of its kind?

    Returns text number, start, both flags.
    """
    sizes = np.array([len(t) for t in texts])
    symbols = (np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)).astype(np.int32) + 1
    stops = np.cumsum(sizes + 1) - 1
    symbols[stops] = 0
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    left = stops[text] - np.arange(len(symbols))
    order = suffix_array(symbols, left, length)
    kind = np.cumsum(~long_prefixes(symbols, order, length))
    window = left[order] >= length
    order, kind = order[window], kind[window]
    times = np.bincount(kind, minlength=1)
    starts = stops[text[order]] - sizes[text[order]]
    head = np.concatenate(([True], kind[1:] != kind[:-1])) if len(kind) else np.empty(0, bool)
    return text[order], order - starts, times[kind] > 1, head


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers in an ascending array."""
    cut = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]


RANGES = "array<struct<first:int,last:int>>"
WINDOWS = "array<struct<first:int,digest:long>>"
FOUND = f"anchor long, single boolean, doc_id long, row long, ranges {RANGES}, windows {WINDOWS}"


def trimmed(rows: list[tuple[bytes, int]], s: RepeatSettings) -> list[tuple[int, int]]:
    """Where the windows of each piece begin and end that may repeat one of another piece of its anchor.

    ``rows``: bytes of a piece and place of its anchor, of whole anchors and each piece once. A window holds
    length - gram bytes beside the anchor, so half of them on one of its sides. Where no other piece has the same
    half there, no window that holds it repeats. Begin equals end if none is left.
    """
    half = (s.length - s.gram) // 2
    before = [data[p - half : p + s.gram] if p >= half else None for data, p in rows]
    after = [data[p : p + s.gram + half] if p + s.gram + half <= len(data) else None for data, p in rows]
    left, right = Counter(before), Counter(after)
    out = []
    for (data, p), x, y in zip(rows, before, after):
        first, end = 0, len(data)
        if x is None or left[x] == 1:
            first = max(p + s.gram + half - s.length, 0)
        if y is None or right[y] == 1:
            end = min(end, p - half + s.length)
        shared = x is not None and left[x] > 1 or y is not None and right[y] > 1
        out.append((first, end) if shared and end - first >= s.length else (0, 0))
    return out


def searched(kinds: DataFrame, s: RepeatSettings) -> DataFrame:
    """Ranges of window starts that repeat in another piece, for each piece that is there once.

    ``kinds``: each different piece: anchor, content, doc_id, row, a (where it starts), p (place of the anchor in it),
    n (how often it is there), bytes. Anchors are dealt to shards; one with more than
    ``shard_bytes`` of pieces to several, by their content. For those, each shard also gives the
    digest of one window of every kind, and a window whose kind is in two shards repeats.
    """
    totals = kinds.groupBy(F.col("anchor").alias("_wide")).agg(F.sum(F.octet_length("bytes")).alias("size"))
    wide = totals.where(F.col("size") > s.shard_bytes).select(
        "_wide", F.ceil(F.col("size") / s.shard_bytes).cast("int").alias("parts")
    )
    dealt = kinds.join(wide, F.col("anchor") == F.col("_wide"), "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("content"), F.col("parts")).cast("int"), F.lit(-1))
    )
    n = int(kinds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = dealt.select("anchor", "part", "bytes", "p", (F.col("n") == 1).alias("single"), "doc_id", "row", "a", "content")
    ready = ready.repartition(n, "anchor", "part").sortWithinPartitions("anchor", "part", "content").drop("content")

    def search(rows: list[tuple], cuts: list[tuple[int, int]]) -> pa.RecordBatch:
        text, start, again, head = repeated_windows([r[2][x:y] for r, (x, y) in zip(rows, cuts)], s.length)
        start = start + np.array([x for x, _ in cuts])[text]
        order = np.lexsort((start, text))
        text, start, again, head = text[order], start[order], again[order], head[order]
        ranges: dict[int, list] = {}
        windows: dict[int, list] = {}
        single = np.array([r[4] for r in rows])
        where = np.flatnonzero(again & single[text])
        joined = text[where] * (1 << 32) + start[where]
        if len(joined):
            for x, y in zip(*runs(joined)):
                k, own = int(x >> 32), rows[int(x >> 32)][7]
                ranges.setdefault(k, []).append({"first": int(x & 0xFFFFFFFF) + own, "last": int(y & 0xFFFFFFFF) + own})
        dealt_out = np.array([r[1] >= 0 for r in rows])
        for k in np.flatnonzero(head & dealt_out[text]):
            r, at = rows[text[k]], int(start[k])
            digest = hashlib.blake2b(r[2][at : at + s.length], digest_size=8).digest()
            windows.setdefault(int(text[k]), []).append({"first": at + r[7], "digest": int.from_bytes(digest, "little", signed=True)})
        which = sorted({*ranges, *windows})
        pair = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        mark = pa.list_(pa.struct([("first", pa.int32()), ("digest", pa.int64())]))
        columns = [
            *(pa.array([rows[k][c] for k in which], t) for c, t in ((0, pa.int64()), (4, pa.bool_()), (5, pa.int64()), (6, pa.int64()))),
            pa.array([ranges.get(k, []) for k in which], pair),
            pa.array([windows.get(k, []) for k in which], mark),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "single", "doc_id", "row", "ranges", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cuts, size = [], [], 0  # of whole groups, trimmed

        def take(rows: list[tuple]) -> None:
            nonlocal size
            # The other pieces of an anchor that was dealt out are elsewhere.
            cut = trimmed([(r[2], r[3]) for r in rows], s) if rows[0][1] < 0 else [(0, len(r[2])) for r in rows]
            for r, (x, y) in zip(rows, cut):
                if y > x:
                    held.append(r)
                    cuts.append((x, y))
                    size += y - x

        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:2] != group[0][:2]:
                    take(group)
                    group = []
                    if size > s.shard_bytes // 2:
                        yield search(held, cuts)
                        held, cuts, size = [], [], 0
                group.append(row)
        if group:
            take(group)
        if held:
            yield search(held, cuts)

    return ready.mapInArrow(run, FOUND)


def spread_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``left`` with a key in ``right``, which has each key once and in ``n`` how many rows of ``left``
    have it. Both are stored tables.

    Keys with more rows than an average task, of which there are at most as many as shuffle partitions, are sent to
    all tasks, so that no task gets all of their rows.
    """
    total = right.agg(F.sum("n")).first()[0] or 0
    most = total // int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    named = right.select(*(F.col(k).alias(f"_{k}") for k in keys), "n").withColumnRenamed("n", "_n")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    hot = F.broadcast(named.where(F.col("_n") > most))
    rest = left.join(hot, same, "left_anti").join(named.where(F.col("_n") <= most), same)
    return left.join(hot, same).unionByName(rest).drop("_n", *(f"_{k}" for k in keys))


def spans(docs: DataFrame, s: RepeatSettings) -> DataFrame:
    """``doc_id, row, ranges``: window starts that are to go, from each piece of a row that has any.

    ``docs`` has doc_id, row (a hash of the text) and text.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/repeats-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    found = all_pieces(docs, s)
    often = found.groupBy(F.col("anchor").alias("_anchor")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    hits = stored(found.join(often, F.col("anchor") == F.col("_anchor")).drop("_anchor"), "pieces")

    one = F.min(F.struct("doc_id", "row", "a", "b", "p")).alias("at")
    kinds = stored(hits.groupBy("anchor", "content").agg(F.count(F.lit(1)).cast("long").alias("n"), one), "kinds")
    # All windows of a piece that is there several times repeat.
    whole = F.array(F.struct(F.col("a").alias("first"), F.col("b").alias("last")))
    copies = spread_join(hits.drop("p"), kinds.where("n > 1").drop("at"), ["anchor", "content"])
    alike = copies.select("doc_id", "row", whole.cast(RANGES).alias("ranges"))

    # The bytes of one of each kind of piece, where an anchor has several; the text is fetched for those documents only.
    differ = stored(kinds.groupBy("anchor").agg(F.count(F.lit(1)).cast("long").alias("n")).where("n > 1"), "differ")
    wanted = spread_join(kinds, differ, ["anchor"]).groupBy(F.col("at.doc_id").alias("_id"), F.col("at.row").alias("_row")).agg(
        F.collect_list(F.struct("anchor", "content", "n", "at.a", "at.b", "at.p")).alias("wanted")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    cut = (
        docs.join(wanted, same)
        .withColumn("data", F.coalesce("text", F.lit("")).cast("binary"))
        .select("doc_id", "row", "data", F.explode("wanted").alias("w"))
        .select(
            "w.anchor", "w.content", "w.n", "doc_id", "row", "w.a", "w.p",
            F.substring(F.col("data"), F.col("w.a") + 1, F.col("w.b") - F.col("w.a") + s.length).alias("bytes"),
        )
        # A row that is there several times brings its pieces several times.
        .groupBy("anchor", "content").agg(*(F.min(c).alias(c) for c in ("n", "doc_id", "row", "a", "p", "bytes")))
    )
    ranges = stored(searched(stored(cut, "bytes"), s), "found")
    marked = ranges.where(F.size("windows") > 0).select("anchor", "single", "doc_id", "row", F.explode("windows").alias("w"))
    marked = marked.select("anchor", "single", "doc_id", "row", "w.first", "w.digest")
    across = marked.groupBy(F.col("anchor").alias("_a"), F.col("digest").alias("_d")).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    met = marked.where("single").join(across, (F.col("anchor") == F.col("_a")) & (F.col("digest") == F.col("_d")))
    met = met.groupBy("anchor", "doc_id", "row").agg(
        F.collect_list(F.struct("first", F.col("first").alias("last"))).cast(RANGES).alias("ranges")
    )
    within = ranges.where(F.size("ranges") > 0).select("doc_id", "row", F.col("ranges").cast(RANGES).alias("ranges"))
    return alike.unionByName(within).unionByName(met.select("doc_id", "row", "ranges"))


def remove_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings(), keep: str = "binary") -> DataFrame:
    """The rows with the columns ``_kept`` (what remains: bytes, or with ``keep="string"`` text without the rest of
    characters that were cut, or with ``keep="none"`` null), ``_n_bytes, _n_removed, _n_spans, _kept_sha256``.

    Every byte goes that lies in a string of ``length`` bytes which starts anywhere
    else too, in the same text or another; strings are judged on the input. Null text counts as empty;
    rows with equal doc_id and text are different rows, so all of a repeated row of ``length`` bytes or more goes;
    texts below that length keep everything. Text is shuffled by doc_id and a hash, never by its content.
    """
    s = settings
    rows = docs.withColumn("_row", F.xxhash64(F.coalesce("text", F.lit(""))))
    keyed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_row").alias("row"), "text")
    gone = (
        spans(keyed, s)
        .groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_of"))
        .agg(F.flatten(F.collect_set("ranges")).alias("_gone"))
    )
    joined = rows.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_of")), "left")
    joined = joined.drop("_id", "_of", "_row")
    extra = f"_kept {'binary' if keep == 'none' else keep}, _n_bytes long, _n_removed long, _n_spans long, _kept_sha256 string"
    names = [part.split()[0] for part in extra.split(", ")]
    kinds = [pa.string() if keep == "string" else pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def cut(data: bytes, gone: list | None) -> tuple:
        kept, at, removed, count = [], 0, 0, 0
        open_first, open_end = 0, -1
        for first, end in [*sorted((g["first"], g["last"] + s.length) for g in gone or []), (len(data), len(data))]:
            if first > open_end or first == end:
                if open_end >= 0:
                    kept.append(data[at:open_first])
                    at, removed, count = open_end, removed + open_end - open_first, count + 1
                open_first, open_end = first, end
            else:
                open_end = max(open_end, end)
        kept.append(data[at:])
        rest = b"".join(kept)
        shown = {"binary": rest, "none": None}.get(keep) if keep != "string" else rest.decode("utf-8", "ignore")
        return shown, len(data), removed, count, hashlib.sha256(rest).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.schema.get_field_index("_gone")
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [cut((t.as_py() or "").encode(), g.as_py()) for t, g in zip(texts, batch.column(where))]
            added = [pa.array(c, t) for c, t in zip(zip(*found), kinds)] if found else [pa.array([], t) for t in kinds]
            kept = [k for k in range(batch.num_columns) if k != where]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept] + added, names=[batch.schema.names[k] for k in kept] + names
            )

    schema = joined.drop("_gone").schema
    for part in extra.split(", "):
        schema = schema.add(*part.split())
    return joined.mapInArrow(run, schema)
