"""Similarity join on word shingles with a token-group matrix.

Documents with the same two smallest token hashes form a group, which similar documents mostly have in
common; a group's row of the matrix is the union of its members' tokens, of which only those that
a link cannot avoid are spread over the cluster. Groups that share enough of them are compared: the overlap
of a document with the other group's whole union bounds its overlap with any member, and only groups
that pass are opened.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.batches import hashes, in_small_batches, mixed, pieces, prefix_sums, utf8
from cartwright.llm.components import components
from cartwright.llm.sieve import sifted
from cartwright.session import shared_dir


@dataclass(frozen=True)
class JaccardSettings:
    """Two sets link when 100 * intersection >= ``percent`` * union. ``members``: documents of a group, about.
    ``run``: of a token in at most so many groups all pairs are counted at once; of others first each group with
    two of them, then those that are still apart meet in blocks of about ``block`` tokens. ``cells``: of the frequency
    sketch, a power of two."""

    words: int = 5
    percent: int = 75
    members: int = 64
    run: int = 24
    block: int = 100_000
    cells: int = 1 << 22

    def least_common(self, n: int) -> int:
        """So many leading tokens a set has in common with any linked set that is not smaller."""
        return 1 + n // 16

    def prefix(self, n: int) -> int:
        """A linked set has at least percent * n tokens in common, so all but so many leading tokens
        can hold at most all but least_common(n) of them."""
        return n - -(-self.percent * n // 100) + self.least_common(n)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Ascending distinct 64-bit shingle hashes of each text.

    A-Z are lower-cased, words end at U+0020 and U+0009 to U+000D; with fewer than ``words`` words the
    whole sequence is one shingle, without any the set is empty.
    """
    n = len(offsets) - 1
    if not len(data):
        return [np.empty(0, np.uint64)] * n
    data = _LOWER[data]
    space = _SPACE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    before = np.concatenate(([True], space[:-1])) | opens[:-1]
    after = np.concatenate((space[1:], [True])) | opens[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    word = hashes(prefix_sums(data), starts, ends)
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    many = max(0, len(word) - words + 1)
    total = np.zeros(many, np.uint64)
    for k in range(words):
        total += word[k : k + many] * factors[k]
    shingle = mixed(total)
    at = np.searchsorted(starts, offsets)
    out = []
    for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
        if last - first >= words:
            out.append(np.unique(shingle[first : last - words + 1]))
        elif last > first:
            some = np.arange(last - first)
            out.append(mixed(np.array([(word[first:last] * factors[some]).sum() + np.uint64(last - first)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


#: Texts are worked on in slices of about so many bytes, so that memory follows neither the rows of a batch nor their length.
SLICE_BYTES = 500_000


def _sets(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """The sets of a column's texts, slice by slice in their order; whoever keeps none of a slice keeps its memory low."""
    data, offsets = utf8(column)
    for first, last in pieces(offsets, SLICE_BYTES):
        lo, hi = offsets[first], offsets[last]
        yield shingle_sets(data[lo:hi], offsets[first : last + 1] - lo, words)


SLICES = 64


def frequencies(docs: DataFrame, s: JaccardSettings) -> np.ndarray:
    """How many documents have a token, at most: counts by the leading bits of the hash.

    Each task counts all tokens of its documents in an array of fixed size; slices of the arrays are added in two
    steps, and the driver gets one array of ``cells`` numbers.
    """
    bits, part = s.cells.bit_length() - 1, s.cells // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(s.cells, np.int32), 0
        for batch in batches:
            for sets in _sets(batch.column(0), s.words):
                n += len(sets)
                cell, times = np.unique(np.concatenate(sets) >> np.uint64(64 - bits), return_counts=True)
                total[cell.astype(np.int64)] += times.astype(np.int32)
        if n:
            blobs = [zlib.compress(total[k * part : (k + 1) * part].astype("<i8").tobytes(), 1) for k in range(SLICES)]
            spread = [n % 64] * SLICES
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array(spread, pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "lane", "blob"]
            )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.int64)
        for batch in batches:
            for blob in batch.column("blob"):
                total += np.frombuffer(zlib.decompress(blob.as_py()), "<i8")
        lane = key[1].as_py() if len(key) > 1 else 0
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([lane], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())],
            names=["slice", "lane", "blob"],
        )

    schema = "slice int, lane int, blob binary"
    summed = docs.select("text").mapInArrow(count, schema).groupBy("slice", "lane").applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    out = np.zeros(s.cells, np.float32)
    for row in summed.toLocalIterator():
        out[row["slice"] * part : (row["slice"] + 1) * part] = np.frombuffer(zlib.decompress(row["blob"]), "<i8")
    return out


@dataclass(frozen=True)
class Order:
    """The order of tokens: rare before frequent ones, else by hash. The estimates decide on the work only, never on a result."""

    counts: np.ndarray
    mean: float
    settings: JaccardSettings

    def leading(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """The tokens of the prefix, and the group of the set."""
        s = self.settings
        mean = self.mean
        seen = self.counts[(tokens >> np.uint64(65 - s.cells.bit_length())).astype(np.int64)]
        # What is in the range of chance counts as rare; above that, powers of two.
        level = np.log2(np.maximum((seen - mean) / (3 * np.sqrt(mean) + 3), 1)).astype(np.int8)
        lead = tokens[np.argsort(level, kind="stable")][: s.prefix(len(tokens))]
        parts = max(1, -(-int(seen[:2].min() - 2 * mean) // s.members))
        own = [int(tokens[0]), int(tokens[min(1, len(tokens) - 1)]), int(node_of(tokens)) % parts]
        return lead, int(mixed(mixed(np.array(own, np.uint64)) * np.array([1, 3, 5], np.uint64)).sum().view(np.int64))


def order_of(docs: DataFrame, s: JaccardSettings) -> Order:
    counts = frequencies(docs, s)
    return Order(counts, float(counts.mean(dtype=np.float64)), s)


def node_of(tokens: np.ndarray) -> np.uint64:
    """A 64-bit name of a set; equal sets have equal names."""
    return mixed(np.array([mixed(tokens ^ np.uint64(0xA0761D6478BD642F)).sum() + np.uint64(len(tokens))], np.uint64))[0]


TAGS = "doc_id long, row long, node long, n long, gid long"


def tagged(docs: DataFrame, shared, s: JaccardSettings) -> DataFrame:
    """``doc_id, row, node, n, gid`` of each document; gid is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, groups = [], [], []
            for sets in _sets(batch.column("text"), s.words):
                for tokens in sets:
                    nodes.append(node_of(tokens))
                    sizes.append(len(tokens))
                    groups.append(shared.value.leading(tokens)[1] if len(tokens) else None)
            named = pa.array(np.array(nodes, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), named, pa.array(sizes, pa.int64()), pa.array(groups, pa.int64())],
                names=["doc_id", "row", "node", "n", "gid"],
            )

    return docs.select("doc_id", "row", "text").mapInArrow(run, TAGS)


#: The sizes of sets travel as eighths of powers of two, rounded down and up.
def rounded(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power = 8 * np.log2(n)
    return np.floor(power).astype(np.uint8), np.ceil(power).astype(np.uint8)


def merged(token: np.ndarray, gid: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each pair of token and group once, in order, with the smallest and the largest size."""
    order = np.lexsort((gid, token))
    token, gid, low, high = token[order], gid[order], low[order], high[order]
    new = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (gid[1:] != gid[:-1]))))
    return token[new], gid[new], np.minimum.reduceat(low, new), np.maximum.reduceat(high, new)


#: Pairs of token and group that a task brings together before it sends them; some 30 MB at the peak.
PACKED = 400_000
BLOCK = "range int, tokens binary, groups binary, low binary, high binary"
MET = "token long, a long, b long, k long, low int, high int"


def candidates(docs: DataFrame, shared, s: JaccardSettings) -> DataFrame:
    """Rows of two kinds. ``a, b, k, low``: two groups, how many tokens of their matrix rows were seen together, and
    the smaller lower bound of their sizes. ``token, b, low, high``: a group of a token in more than ``run`` groups.

    The matrix travels in blocks: a task packs the pairs of token and group it has seen, each once, by ranges of
    tokens, and the task of a range sorts what it gets. Of a token, 40 bits after those of its range are kept; a chance
    match only costs a comparison. Groups whose sizes rule out a link are no pair.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    n = 1 << (n - 1).bit_length()
    bits = n.bit_length() - 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads, groups, sizes, held = [], [], [], 0
        for batch in batches:
            for sets in _sets(batch.column(0), s.words):
                for tokens in sets:
                    if len(tokens):
                        lead, gid = shared.value.leading(tokens)
                        leads.append(lead)
                        groups.append(np.full(len(lead), gid, np.int64))
                        sizes.append(np.full(len(lead), len(tokens), np.int32))
                        held += len(lead)
                # Blocks are sent when enough pairs came together, across batches.
                if held >= PACKED:
                    yield blocks_of(leads, groups, sizes)
                    leads, groups, sizes, held = [], [], [], 0
        if leads:
            yield blocks_of(leads, groups, sizes)

    def blocks_of(leads: list, groups: list, sizes: list) -> pa.RecordBatch:
        token, gid, low, high = merged(np.concatenate(leads), np.concatenate(groups), *rounded(np.concatenate(sizes)))
        at = np.searchsorted(token >> np.uint64(64 - bits), np.arange(n + 1).astype(np.uint64))
        rest = (token >> np.uint64(24 - bits)) & np.uint64((1 << 40) - 1)
        five = rest.view(np.uint8).reshape(-1, 8)[:, :5]
        full = np.flatnonzero(np.diff(at))
        blobs = [[x[at[k] : at[k + 1]].tobytes() for k in full] for x in (five, gid, low, high)]
        return pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), *(pa.array(x, pa.binary()) for x in blobs)],
            names=["range", "tokens", "groups", "low", "high"],
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[list[bytes]] = [[], [], [], [], []]
        for batch in batches:
            for k, name in enumerate(("tokens", "groups", "low", "high")):
                blocks[k] += batch.column(name).to_pylist()
            blocks[4] += batch.column("range").to_pylist()
        if not blocks[0]:
            return
        five = np.frombuffer(b"".join(blocks[0]), np.uint8).reshape(-1, 5)
        token = np.zeros((len(five), 8), np.uint8)
        token[:, :5] = five
        token = token.view(np.uint64).ravel()
        token |= np.repeat(np.array(blocks[4], np.uint64), [len(x) // 5 for x in blocks[0]]) << np.uint64(40)
        gid, low, high = (np.frombuffer(b"".join(blocks[k]), t) for k, t in ((1, np.int64), (2, np.uint8), (3, np.uint8)))
        blocks.clear()
        token, gid, low, high = merged(token, gid, low, high)
        least, most = np.floor(2.0 ** (low / 8)), np.ceil(2.0 ** (high / 8))
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.concatenate((first, [len(token)])))
        left, right = [], []
        for m in range(2, s.run + 1):
            here = first[size == m]
            for x in range(m):
                for y in range(x + 1, m):
                    left.append(here + x)
                    right.append(here + y)
        inside = np.flatnonzero(np.repeat(size > s.run, size))
        whose = np.repeat(np.arange(len(first)), size)[inside]
        hubs = [first[whose], first[whose] + size[whose] - 1]
        x, y = np.concatenate([first[:0], *left, *hubs]), np.concatenate([first[:0], *right, inside, inside])
        fits = (x != y) & (100 * most[x] >= s.percent * least[y]) & (100 * most[y] >= s.percent * least[x])
        x, y = x[fits], y[fits]
        a, b = np.minimum(gid[x], gid[y]), np.maximum(gid[x], gid[y])
        order = np.lexsort((b, a))
        a, b, seen, small = a[order], b[order], np.ones(len(a), np.int64), np.minimum(low[x], low[y])[order]
        if len(a):
            new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            yield _met(None, a[new], b[new], np.add.reduceat(seen, new), np.minimum.reduceat(small, new), None)
        if len(inside):
            yield _met(token[inside].view(np.int64), None, gid[inside], None, low[inside], high[inside])

    packed = docs.select("text").mapInArrow(pack, BLOCK)
    return packed.repartition(n, "range").mapInArrow(meet, MET)


def _met(*columns: np.ndarray | None) -> pa.RecordBatch:
    n = next(len(c) for c in columns if c is not None)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.nulls(n, t) if c is None else pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in MET.split(", ")])


def enough(seen: DataFrame) -> DataFrame:
    """``a, b`` of the pairs that share as many tokens as a link would need."""
    size = F.floor(F.pow(F.lit(2.0), F.min("low") / 8))
    return seen.groupBy("a", "b").agg(F.sum("k").alias("k"), (F.floor(size / 16) + 1).alias("need")).where("k >= need").select("a", "b")


class Forest:
    """Union-find over a few sets."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending arrays."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def opened(sides: tuple[list[int], list[int]], sets: list[np.ndarray], s: JaccardSettings) -> Iterator[tuple[int, int]]:
    """Links between two groups, or within one if both sides are the same; as many as connect what links connect."""
    forest = Forest(len(sets))

    def linked(q: int, x: int) -> bool:
        few, more = sorted((len(sets[q]), len(sets[x])))
        if 100 * few < s.percent * more or forest.root(q) == forest.root(x):
            return False
        common = overlap(sets[q], sets[x])
        return 100 * common >= s.percent * (few + more - common) and forest.join(q, x)

    def inside(side: list[int]) -> Iterator[tuple[int, int]]:
        return ((q, x) for k, q in enumerate(side) for x in side[k + 1 :] if linked(q, x))

    if sides[0] is sides[1]:
        yield from inside(sides[0])
        return
    # What is linked inside a group is reported by its own comparison.
    for side in sides:
        for _ in inside(side):
            pass
    union = np.unique(np.concatenate([sets[y] for y in sides[1]]))
    for q in sides[0]:
        if 100 * overlap(sets[q], union) >= s.percent * len(sets[q]):
            yield from ((q, x) for x in sides[1] if linked(q, x))


def met(sides: tuple[list[int], list[int]], sets: list[np.ndarray], s: JaccardSettings) -> Iterator[tuple[int, int]]:
    """The same of two blocks, or of one: what each set of the one side has in common with all of the other is counted
    at once, from the places of its tokens."""
    left, right = sides
    forest, place = Forest(len(sets)), np.array(right)
    size = np.array([len(sets[x]) for x in right])
    token, whose = np.concatenate([sets[x] for x in right]), np.repeat(np.arange(len(right)), size)
    order = np.argsort(token, kind="stable")
    token, whose = token[order], whose[order]
    for q in left:
        first, last = np.searchsorted(token, sets[q], "left"), np.searchsorted(token, sets[q], "right")
        many = last - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(whose[at], minlength=len(right))
        linked = 100 * common >= s.percent * (len(sets[q]) + size - common)
        yield from ((q, x) for x in place[linked].tolist() if forest.join(q, x))


def compared(
    docs: DataFrame, pairs: DataFrame, reps: DataFrame, folder: str, s: JaccardSettings, links_between: Callable = opened
) -> DataFrame:
    """``a, b``: links found between the groups of each pair (a, b); a pair of a group with itself looks inside.

    Only texts of the groups' documents are shuffled. Who these are is written to ``folder`` first.
    """
    rows = pairs.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("g"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    wanted = rows.join(reps, F.col("g") == F.col("gid")).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.first("gid").alias("gid"), F.first("node").alias("node"), F.collect_list(F.struct("pa", "pb")).alias("pairs")
    )
    wanted.write.parquet(folder)
    wanted = docs.sparkSession.read.parquet(folder)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    near = sifted(docs, ["doc_id", "row"], wanted, ["_id", "_row"])
    sent = near.join(wanted, same).select("text", "gid", "node", F.explode("pairs").alias("p")).select("p.pa", "p.pb", "gid", "node", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    ready = sent.repartition(n, "pa", "pb").sortWithinPartitions("pa", "pb", "node")

    def links_of(group: list[tuple]) -> list[tuple[int, int]]:
        """group: a pair's (gid, node, set), each node once."""
        once = list({node: (gid, node, tokens) for gid, node, tokens in group}.values())
        sets, nodes = [t for _, _, t in once], [x for _, x, _ in once]
        gids = sorted({gid for gid, _, _ in once})
        left = [k for k, one in enumerate(once) if one[0] == gids[0]]
        right = left if len(gids) == 1 else [k for k, one in enumerate(once) if one[0] != gids[0]]
        return [(nodes[q], nodes[x]) for q, x in links_between((left, right), sets, s)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = [], None
        for batch in batches:
            out = []
            sets = itertools.chain.from_iterable(_sets(batch.column("text"), s.words))
            keys = zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())
            for k, gid, node, tokens in zip(keys, batch.column("gid").to_pylist(), batch.column("node").to_pylist(), sets):
                if k != key and group:
                    out += links_of(group)
                    group = []
                key = k
                group.append((gid, node, tokens))
            yield _links(out)
        if group:
            yield _links(links_of(group))

    return ready.mapInArrow(run, "a long, b long")


def still_apart(known: DataFrame) -> DataFrame:
    """The rows (token, gid, low, high, ...) of the tokens whose groups do not all have one label; ``low`` and ``high`` are
    the least and the greatest label of a group."""
    apart = known.groupBy(F.col("token").alias("t")).agg(F.min("low").alias("x"), F.max("high").alias("y")).where("x <> y").select("t")
    return known.join(apart, F.col("token") == F.col("t")).drop("t")


def tiled(left: DataFrame, reps: DataFrame, s: JaccardSettings, stored: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The nodes of the groups in ``left`` (token, gid) with a block as their ``gid``, and the pairs of blocks that have a token in common.

    A group belongs to the token that most groups have, of its own, so a token meets few blocks besides that of a more frequent one.
    What belongs to a token is dealt to as many blocks as it fills. So a node goes to blocks, not to all the groups it shares tokens with.
    """
    times = left.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("times"))
    owner = left.join(times, F.col("token") == F.col("t")).groupBy(F.col("gid").alias("g")).agg(F.max(F.struct("times", "token")).getField("token").alias("owner"))
    owned = reps.join(owner, F.col("gid") == F.col("g")).drop("g")
    filled = owned.groupBy(F.col("owner").alias("o")).agg(F.ceil(F.sum("n") / s.block).alias("parts"))
    block = F.xxhash64("owner", F.pmod(F.xxhash64("node"), F.col("parts")))
    blocks = stored(owned.join(filled, F.col("owner") == F.col("o")).withColumn("block", block).select("node", "doc_id", "row", "gid", "block"), "blocks")
    of_group = blocks.select(F.col("gid").alias("g"), "block").distinct()
    of_token = stored(left.join(of_group, F.col("gid") == F.col("g")).select("token", "block").distinct(), "token-blocks")
    there = of_token.select(F.col("token").alias("t"), F.col("block").alias("other"))
    tiles = of_token.join(there, (F.col("token") == F.col("t")) & (F.col("block") <= F.col("other")))
    return blocks.drop("gid").withColumnRenamed("block", "gid"), tiles.select(F.col("block").alias("a"), F.col("other").alias("b")).distinct()


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def labelled(docs: DataFrame, settings: JaccardSettings = JaccardSettings()) -> DataFrame:
    """``doc_id, row, n_shingles, label`` for each row of ``docs`` (doc_id, text).

    Rows have the same ``label``, a 64-bit hash of one of their sets, exactly if links connect them, whatever their ids;
    ``row`` is a hash of the text that tells rows with equal ids apart. Equal sets are one node, whatever their number.
    A null or wordless text has an empty set, links with nothing and has a null label.
    """
    s, spark = settings, in_small_batches(docs.sparkSession)
    folder = f"{shared_dir(spark)}/jaccard-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    shared = spark.sparkContext.broadcast(order_of(rows, s))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    tags = stored(tagged(rows, shared, s), "tags")
    found = stored(candidates(rows, shared, s), "candidates")
    shared.unpersist()  # What needs the counts is written.
    first = F.min(F.struct("doc_id", "row", "gid")).alias("r")
    reps = tags.where("gid is not null").groupBy("node").agg(first, F.first("n").alias("n")).select("node", "r.doc_id", "r.row", "r.gid", "n")
    within = reps.groupBy("gid").count().where("count > 1").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    seen = found.where("token is null").select("a", "b", "k", "low")
    pairs = stored(enough(seen).unionByName(within), "pairs")
    links = stored(compared(rows, pairs, reps, f"{folder}/wanted", s), "links")
    labels = components(links)

    # Tokens in many groups: only what is still apart is left to compare.
    crowded = found.where("token is not null").select("token", F.col("b").alias("gid"))
    if not crowded.isEmpty():
        of_node = reps.join(labels.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
        of_group = of_node.groupBy(F.col("gid").alias("g")).agg(
            F.min(F.coalesce("label", "node")).alias("low"), F.max(F.coalesce("label", "node")).alias("high"), F.min("n").alias("least")
        )
        known = crowded.join(of_group, F.col("gid") == F.col("g")).drop("g")
        left = stored(still_apart(known), "crowded")
        # A linked set has at least ``percent`` of the size, so a group with fewer of these tokens than such a link needs
        # also shares others with what it is linked to: then they were seen together.
        need = F.floor(F.ceil(F.col("least") * s.percent / 100) / 16) + 1
        shares = left.groupBy("gid").agg(F.count(F.lit(1)).alias("q"), *(F.first(c).alias(c) for c in ("low", "high", "least")))
        shares = stored(shares.withColumn("heavy", F.col("q") >= need), "shares")
        one, other = (shares.select(F.col("gid").alias(f"_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in shares.columns[1:])) for x in "ab")
        both = seen.join(one, F.col("a") == F.col("_a")).join(other, F.col("b") == F.col("_b"))
        both = both.where("not (heavy_a and heavy_b) and not (low_a = high_a and low_b = high_b and low_a = low_b)")
        most = both.groupBy("a", "b").agg((F.sum("k") + F.first(F.least("q_a", "q_b"))).alias("k"), F.first(F.least("least_a", "least_b")).alias("n"))
        rest = stored(most.where("k > floor(n / 16)").select("a", "b").join(pairs, ["a", "b"], "left_anti"), "rest")
        more = stored(compared(rows, rest, reps, f"{folder}/wanted-rest", s), "more")
        # The others can be linked by these tokens alone.
        heavy = shares.where("heavy").select(F.col("gid").alias("g"))
        blocks, tiles = tiled(still_apart(left.join(heavy, F.col("gid") == F.col("g"), "left_semi")), reps, s, stored)
        across = stored(compared(rows, tiles, blocks, f"{folder}/wanted-tiles", s, met), "across")
        labels = components(links.unionByName(more).unionByName(across))

    label = F.when(F.col("gid").isNotNull(), F.coalesce("label", "node"))
    named = tags.join(labels.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
    return named.select("doc_id", "row", F.col("n").alias("n_shingles"), label.alias("label"))


def joined(docs: DataFrame, settings: JaccardSettings = JaccardSettings()) -> DataFrame:
    """``doc_id, row, n_shingles, label, component_id`` for each row of ``docs`` (doc_id, text); the first four
    as from ``labelled``.

    ``component_id`` is the smallest doc_id reachable by links, its own included. A null or wordless text is its own
    component. Null ids never are a component's smallest id; a component of such rows only has a null id.
    """
    named = labelled(docs, settings)
    least = named.where("label is not null").groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return named.join(least, F.col("label") == F.col("_label"), "left").select(
        "doc_id", "row", "n_shingles", "label", own.alias("component_id")
    )
