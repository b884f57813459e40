"""SimHash fingerprints of word shingles, and all links between fingerprints that differ in few bits."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.batches import pieces, utf8
from cartwright.llm.components import components
from cartwright.session import shared_dir

#: Of the shingles' XXH64.
SEED = 42
#: Parts of 16 bits whose population counts name a tile; there are at most 17 ** 4 names, whatever the input.
PARTS = 4


@dataclass(frozen=True)
class SimHashSettings:
    width: int = 3
    radius: int = 3
    #: Texts of about so many bytes are worked on at a time.
    slice_bytes: int = 1 << 20
    #: Fingerprints in a tile at most; more of one name become several tiles.
    tile: int = 4096


def shingles(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text, lower-cased (A-Z) and joined by one space, as one string of bytes; the byte range of every
    shingle in it; and the number of shingles of each text. A text with fewer words than ``width`` has one shingle of all its words,
    one without words has none."""
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    gap = (lower == 32) | ((lower >= 9) & (lower <= 13))
    # A word starts after a gap or where its text does.
    fresh = np.ones(len(raw) + 1, bool)
    fresh[1:-1] = gap[:-1] if len(raw) else False
    fresh[offsets] = True
    starts = np.flatnonzero(~gap & fresh[:-1])
    ended = np.ones(len(raw), bool)
    ended[:-1] = gap[1:]
    ended[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(~gap & ended) + 1
    lengths = ends - starts
    words = np.searchsorted(starts, offsets)  # Index of the first word of each text.
    counts = np.diff(words)
    # Every word followed by one space; a shingle is a stretch of that without its last space.
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    joined = np.full(at[-1], 32, np.uint8)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    joined[inside] = lower[~gap]
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(words[:-1] - np.concatenate([[0], np.cumsum(made)[:-1]]), made) + np.arange(made.sum())
    last = first + np.repeat(np.minimum(counts, width), made)
    return joined.tobytes(), at[first], at[last] - 1, made


def majorities(hashes: np.ndarray, made: np.ndarray) -> np.ndarray:
    """For each run of ``made`` hashes the bits that are 1 in over half of them; zero for an empty run.

    Eight bits at a time are counted in the bytes of one word, in pieces of at most 255 hashes.
    """
    out = np.zeros(len(made), np.uint64)
    runs = np.flatnonzero(made)
    if not len(runs):
        return out
    cuts = -(-made[runs] // 255)
    begins = np.cumsum(made[runs]) - made[runs]
    owner = np.repeat(np.arange(len(runs)), cuts)
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    edges = begins[owner] + 255 * nth
    heads = np.cumsum(cuts) - cuts
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & np.uint64(0x0101010101010101)
        counted = np.add.reduceat(lanes, edges).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(counted, heads, axis=0, dtype=np.int64)
        over = (2 * total > made[runs][:, None]).astype(np.uint64)
        for lane in range(8):
            out[runs] |= over[:, lane] << np.uint64(8 * lane + shift)
    return out


def fingerprints_of(column: pa.Array, settings: SimHashSettings) -> np.ndarray:
    """A 64-bit fingerprint for each text; null is an empty text."""
    raw, offsets = utf8(column)
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    for first, last in pieces(offsets, settings.slice_bytes):
        joined, starts, ends, made = shingles(
            raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], settings.width
        )
        hashes = np.empty(len(starts), np.uint64)
        for k in range(0, len(starts), 1 << 15):
            some = zip(starts[k : k + (1 << 15)].tolist(), ends[k : k + (1 << 15)].tolist())
            count = min(1 << 15, len(starts) - k)
            hashes[k : k + count] = np.fromiter((digest(joined[a:b], SEED) for a, b in some), np.uint64, count)
        out[first:last] = majorities(hashes, made)
    return out


def fingerprints(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """``doc_id, fp`` for every row: the 64 bits as a signed long."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column("text"), settings).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, "doc_id long, fp long")


def counts_of(fp: str) -> list[Column]:
    """Population counts of the parts."""
    return [F.expr(f"bit_count(shiftrightunsigned({fp}, {16 * k}) & 65535L)") for k in range(PARTS)]


def named(counts: list[Column]) -> Column:
    """One number for the counts of a tile; 17 is one more than a count can be."""
    out = F.lit(0)
    for one in counts:
        out = out * 17 + one
    return out.cast("int")


def steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts that two fingerprints within the radius can have, one of each opposite pair."""
    reach = range(-radius, radius + 1)
    return [s for s in itertools.product(reach, repeat=PARTS) if sum(map(abs, s)) <= radius and s >= (0,) * PARTS]


def tiles(distinct: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``name, part, fps``: the fingerprints of equal population counts in tiles of a bounded size, as packed numbers.

    A name with more fingerprints than a tile holds is dealt out by hash to as many parts as it needs, twice as many
    tiles as at best. The counts by name are a table of at most 17 ** 4 rows.
    """
    of = distinct.select("fp", named(counts_of("fp")).alias("name"))
    sizes = of.groupBy("name").agg(F.ceil(F.count(F.lit(1)) * 2 / settings.tile).cast("int").alias("parts"))
    dealt = of.join(F.broadcast(sizes), "name")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    return dealt.groupBy("name", part.alias("part"), "parts").agg(F.collect_list("fp").alias("fps"))


def tile_pairs(tiled: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``name, part, fps, others``: each tile beside each tile that its population counts allow, itself included.

    Pairs of tiles whose counts differ by more than the radius in sum are never made: a tile is sent to the names within the radius only
    (65 of them, for a radius of 3), and there to every part.
    """
    counts = [F.expr(f"name div {17 ** (PARTS - 1 - k)} % 17") for k in range(PARTS)]
    near = F.array(*(F.array(*map(F.lit, s)) for s in steps(settings.radius)))
    moved = [c + F.col("step")[k] for k, c in enumerate(counts)]
    inside = F.lit(True)
    for k in range(PARTS):
        inside &= moved[k].between(0, 16)
    sent = tiled.select("name", "part", "fps", F.explode(near).alias("step")).where(inside)
    sent = sent.select(named(moved).alias("name"), F.col("name").alias("_from"), F.col("part").alias("_part"), F.col("fps").alias("others"))
    homes = tiled.select("name", "parts").distinct()
    sent = sent.join(F.broadcast(homes), "name")  # At most 17 ** 4 rows.
    sent = sent.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).drop("parts")
    met = tiled.drop("parts").join(sent, ["name", "part"])
    # Two parts of one name meet once.
    return met.where("_from <> name or _part <= part").select("name", "part", "fps", "others")


def links(pairs: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``a, b``: links between different fingerprints that join what the links within the radius join.

    Every pair of fingerprints of two tiles is compared, by exclusive-or and bit count. Links are told to a union-find of the two tiles and only
    those are returned that join something, fewer than there are fingerprints.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts = batch.column("name").to_numpy(), batch.column("part").to_numpy()
            homes, others = batch.column("fps"), batch.column("others")
            row = 0
            while row < batch.num_rows:
                # Rows of one tile that follow each other are compared in one go, up to a tile's size.
                last, size = row + 1, len(others[row])
                while last < batch.num_rows and names[last] == names[row] and parts[last] == parts[row] and size < settings.tile:
                    size += len(others[last])
                    last += 1
                home = homes[row].values.to_numpy().view(np.uint64)
                other = others.slice(row, last - row).flatten().to_numpy().view(np.uint64)
                yield joined(home, other, settings.radius)
                row = last

    return pairs.mapInArrow(compared, "a long, b long")


def joined(home: np.ndarray, other: np.ndarray, radius: int) -> pa.RecordBatch:
    """The links of one comparison, without those that join nothing new."""
    values, places = np.unique(np.concatenate([home, other]), return_inverse=True)
    up = list(range(len(values)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept: list[tuple[int, int]] = []
    step = max(1, (1 << 18) // max(1, len(other)))
    for k in range(0, len(home), step):
        some = home[k : k + step]
        rows, cols = np.nonzero(np.bitwise_count(some[:, None] ^ other[None, :]) <= radius)
        for a, b in zip(places[k + rows].tolist(), places[len(home) + cols].tolist()):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
                kept.append((a, b))
    at = np.array(kept, np.int64).reshape(-1, 2)
    ends = values.view(np.int64)[at]
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def near_duplicates(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Null and empty texts have fingerprint zero and link like others. The component's id is the smallest doc_id reached, null where only
    rows without id are. Equal fingerprints are one before anything is compared. Columns other than doc_id and text may have any name.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/simhash-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = stored(fingerprints(docs, settings), "rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    tiled = stored(tiles(distinct.select("fp"), settings), "tiles")
    found = components(links(tile_pairs(tiled, settings), settings))
    labelled = distinct.join(found.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named_rows = stored(labelled.join(least, "label").select("fp", "n", "component_id"), "components")
    # Fingerprints with more rows than an average task are fewer than twice the tasks; they are told to all, the others are joined.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = named_rows.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * parts > max(total, parts)
    told = rows.join(F.broadcast(named_rows.where(hot).select("fp", F.col("component_id").alias("_id"), F.lit(True).alias("_hot"))), "fp", "left")
    done = told.where("_hot").select("doc_id", "fp", F.col("_id").alias("component_id"))
    rest = told.where("_hot is null").select("doc_id", "fp").join(named_rows.where(~hot).select("fp", "component_id"), "fp")
    return done.unionByName(rest).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
