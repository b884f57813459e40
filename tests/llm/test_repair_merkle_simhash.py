"""Conversation repair, the Merkle manifest and SimHash against brute force, on small tables and on odd ones."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from cartwright.llm import merkle, queries, ranks, repair, simhash

SPACE = " \t\n\x0b\x0c\r"


# --- Conversation repair


def plain_search(roles: str, faults: str) -> tuple[int, str]:
    """Paths in the order of (cost, audit); the first that ends well is the answer."""
    legal = re.compile("(s?(ua)+)?")
    heap = [(0, "", 0, "")]
    done = set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        if i == len(roles) and legal.fullmatch(out):
            return cost, audit
        # What is put out matters only by its last turn.
        if (i, out[-1:]) in done:
            continue
        done.add((i, out[-1:]))
        steps = []
        for turn in "ua":
            steps.append((2, "I", i, out + turn))
        if i < len(roles):
            steps.append((3, "D", i + 1, out))
            if faults[i] in "-t":
                more = int(faults[i] == "t")
                steps.append((more, "K", i + 1, out + roles[i]))
                steps += [(2 + more, "R", i + 1, out + turn) for turn in "ua"]
        for price, edit, j, put in steps:
            if re.fullmatch("s?(ua)*u?", put):
                heapq.heappush(heap, (cost + price, audit + edit, j, put))


def test_search_from_both_ends_equals_a_plain_search():
    for n in range(5):
        for roles in itertools.product("sua-", repeat=n):
            faults = "".join(random.Random(str(roles)).choice("---bdt") for _ in roles)
            assert repair.cheapest("".join(roles), faults) == plain_search("".join(roles), faults)
    draw = random.Random(5)
    for _ in range(400):
        n = draw.randint(5, 40)
        roles = "".join(draw.choice(draw.choice(["ua", "suua-", "uuu", "aas"])) for _ in range(n))
        faults = "".join(draw.choice(draw.choice(["-", "-t", "-bdt"])) for _ in range(n))
        assert repair.cheapest(roles, faults) == plain_search(roles, faults), (roles, faults)


def test_long_conversations_are_searched_in_time_near_their_length():
    for roles in ("ua" * 4000, "u" * 8000, "au" * 4000):
        cost, audit = repair.cheapest(roles, "-" * len(roles))
        assert len(audit.replace("I", "")) == len(roles)
        assert cost == {"ua" * 4000: 0, "u" * 8000: 8000, "au" * 4000: 4}[roles]


def conversation_by_hand(rows: list[tuple]) -> tuple:
    after = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        dealt = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
        role = "user" if dealt == 4 else role
        after += [(turn, role, text)] * (dealt != 0) + [(turn, role, text)] * (dealt == 3)

    def place(row):
        turn, role, text = row
        return turn is not None, turn or 0, role, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    after.sort(key=place)
    faults, seen = "", set()
    for _, role, text in after:
        bare = text.strip(SPACE)
        faults += "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
    roles = "".join(r[:1] if r[:1] in ("s", "u", "a") else "-" for _, r, _ in after)
    cost, audit = plain_search(roles, faults)
    lines, rest = [], iter(after)
    for edit in audit:
        row = next(rest) if edit != "I" else (None, "", "")
        if edit == "D":
            continue
        put = "".join(x[:1] for x in lines)
        wanted = "assistant" if put.endswith("u") else "user"
        lines.append(f"{row[1] if edit == 'K' else wanted}:{row[2]}")
    turns = [t for t, _, _ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    counts = (faults.count("b"), faults.count("d"), faults.count("t"))
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired_equals_hand(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in repair.repair(df).collect()}
    ids = {r[0] for r in rows}
    assert set(got) == ids
    for one in ids:
        assert got[one] == conversation_by_hand([r for r in rows if r[0] == one]), one


def test_repair_equals_brute_force(spark):
    repaired_equals_hand(spark.read.parquet(f"{SMALL}/conversations.parquet"))


def test_repair_of_odd_conversations(spark):
    draw = random.Random(9)
    texts = [None, "", " \t\n", "Yes.", "yes", "Why?! ", "x" * 200_000, "a\nb.", "é…", "Yes."]
    rows = [(draw.choice([None, 1, 2, 3, 7]), draw.choice([None, 0, 1, 2, 9]), draw.choice([None, "", "user", "assistant", "system", "tool", "user"]), draw.choice(texts)) for _ in range(120)]
    rows += [(100 + k, 0, "user", "gone?") for k in range(60)] + [(5, k, "user", "Same.") for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = df.selectExpr("*", "1 AS copy", "2 AS late", "'x' AS report", "'y' AS digest", "3 AS dealt", "4 AS _id", "5 AS cost")
    repaired_equals_hand(clash)
    got = {r.conv_id: r for r in repair.repair(clash).collect()}
    empty = [r for r in got.values() if r.conv_id and r.conv_id >= 100 and r.audit == ""]
    assert empty and all(r.repaired_sha256 == hashlib.sha256().hexdigest() and r.cost == 0 for r in empty)
    assert repair.repair(clash.where("false")).count() == 0
    named = repair.repair(df.withColumn("conv_id", F.col("conv_id").cast("string"))).collect()
    assert {r.audit for r in named} == {r.audit for r in got.values()}


# --- Merkle manifest


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row, text) -> str:
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_by_hand(digests: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The top and, per leaf, the siblings left and right of its way up."""
    above = [[] for _ in digests]
    at, level = list(range(len(digests))), digests
    while len(level) > 1:
        for k, place in enumerate(at):
            run = place // 3 * 3
            above[k].append((level[run:place], level[place + 1 : run + 3]))
        at = [p // 3 for p in at]
        level = [sha(*level[k : k + 3]) for k in range(0, len(level), 3)]
    return level[0], above


def manifest_by_hand(rows) -> list[tuple]:
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        mine = [(r, leaf_by_hand(r, r.text)) for r in rows if r.source == source]
        mine.sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        trees.append((mine, *tree_by_hand([leaf for _, leaf in mine])))
    root, tops = tree_by_hand([top for _, top, _ in trees])
    out = []
    for (mine, subroot, above), upper in zip(trees, tops):
        for (row, leaf), way in zip(mine, above):
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and row.text is not None
            at = leaf_by_hand(row, row.text.replace("\n", "")) if hit else leaf
            for left, right in way + upper:
                at = sha(*left, at, *right)
            proof = sha(*(x for left, right in way + upper for x in left + right))
            out.append((row.doc_id, leaf, subroot, root, proof, at, at == root))
    return out


def in_order(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


ROWS = [
    (None, None, None, None, None), (None, "a", "xx", 3, "one\ntwo"), (None, "a", "xx", 3, "one\ntwo"), (3, "a", None, 0, ""), (0, "a", "xx", 1, "\n"),
    (1, "é", "xx", 1, "x\ny"), (1, "z", "xx", 1, "x\ny"), (2, "", "xx", 1, None), (-5, "a", "xx", 9, "y" * 300_000 + "\n"),
]


def test_manifest_equals_brute_force(spark):
    docs = spark.createDataFrame(ROWS + [(k, "many", "xx", k, "same\n") for k in range(100)] + [(7, "same", "xx", 1, "q")] * 40, "doc_id long, source string, lang string, n_chars long, text string")
    clash = docs.selectExpr("*", "1 AS rank", "2 AS owner", "3 AS n", "'d' AS digest", "'p' AS path", "4 AS _range", "5 AS root")
    found = merkle.verified(clash, merkle.tampered_text()).collect()
    assert in_order(found) == in_order(manifest_by_hand(docs.collect()))
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_every_height(spark, n):
    rows = [(k, "s", "xx", 1, f"t{k}\n") for k in range(n)] + [(1000 + k, f"s{k}", "xx", 1, "t") for k in range(n % 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert in_order(merkle.verified(docs, merkle.tampered_text()).collect()) == (in_order(manifest_by_hand(docs.collect())) if n else [])


def test_proofs_of_some_rows_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    manifest = merkle.build(docs.select("source", "doc_id", merkle.leaf_of().alias("digest")), merkle.new_folder(spark))
    asked = manifest.rows.where("doc_id in (3, 77)")
    found = merkle.proofs(manifest, asked).select("doc_id", "root", merkle.folded(F.col("digest"), F.col("path")).alias("folded")).collect()
    assert sorted(r.doc_id for r in found) == [3, 77] and all(r.root == r.folded == manifest.root().first()[0] for r in found)


def test_ranks_in_groups_of_any_size(spark, folder):
    rows = [(k % 3 if k % 4 else None, k % 7) for k in range(500)] + [(9, 1)] * 300
    df = spark.createDataFrame(rows, "g long, v long")
    found = ranks.ranked(df, "g", ["v"], folder("ranks")).collect()
    groups = sorted({g for g, _ in rows}, key=lambda g: (g is not None, g or 0))
    for number, group in enumerate(groups):
        mine = sorted((r.rank, r.v) for r in found if r.g == group)
        assert [r for r, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for g, v in rows if g == group)
        assert {(r.owner, r.n) for r in found if r.g == group} == {(number, len(mine))}


# --- SimHash


def fingerprint_by_hand(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(marks: list[int], ids: list, radius: int) -> list:
    up = list(range(len(marks)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(marks):
        for j in range(i):
            if (x ^ marks[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    least: dict = {}
    for k, one in enumerate(ids):
        if one is not None:
            least[root(k)] = min(least.get(root(k), one), one)
    return [least.get(root(k)) for k in range(len(ids))]


def near_equals_hand(docs, settings=simhash.SimHashSettings()):
    rows = docs.select("doc_id", "text").collect()
    marks = [fingerprint_by_hand(r.text) for r in rows]
    found = components_by_hand(marks, [r.doc_id for r in rows], settings.radius)
    want = in_order((r.doc_id, f"{m:016x}", c) for r, m, c in zip(rows, marks, found))
    assert in_order(simhash.near_duplicates(docs, settings).collect()) == want
    return want


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    near_equals_hand(docs)
    near_equals_hand(docs, simhash.SimHashSettings(slice_bytes=100, radius=2, tile=8))


def test_simhash_of_odd_rows(spark):
    long = " ".join(str(k % 977) for k in range(400_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO "), (6, "a b c"), (7, "É a b"), (8, "É A\x0bB"), (8, "É A\x0bB"), (None, "no id"),
        (9, "no id"), (None, "none at all"), (10, long), (11, long + " tail"), (12, "x" * 100_000), (-3, "x" * 100_000), (13, " one two"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS name", "3 AS part", "4 AS n", "5 AS label", "6 AS component_id")
    want = near_equals_hand(docs)
    assert (2, "0" * 16, 1) in want and (None, f"{fingerprint_by_hand('none at all'):016x}", None) in want
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("tile", [4, 64])
def test_tiles_lose_no_link_and_links_stay_few(spark, tile):
    draw = np.random.default_rng(4)
    heads = draw.integers(0, 1 << 63, 12, dtype=np.uint64)
    marks = {int(h) for h in heads} | {0, (1 << 64) - 1}
    for h in heads:
        for _ in range(60):
            marks.add(int(h) ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 7), replace=False)))
    marks = sorted(marks)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    settings = simhash.SimHashSettings(tile=tile)
    distinct = spark.createDataFrame([(m,) for m in signed], "fp long")
    tiled = simhash.tiles(distinct, settings)
    assert sorted(x for r in tiled.collect() for x in r.fps) == sorted(signed)
    found = simhash.links(simhash.tile_pairs(tiled, settings), settings).collect()
    at = {m: k for k, m in enumerate(signed)}
    assert all((marks[at[a]] ^ marks[at[b]]).bit_count() <= 3 for a, b in found)
    up = list(range(len(marks)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        a, b = sorted((root(at[a]), root(at[b])))
        up[b] = a
    assert [root(k) for k in range(len(marks))] == components_by_hand(marks, list(range(len(marks))), 3)


def test_every_new_query_is_registered():
    assert {"op11_conversation_repair", "op12_merkle_manifest", "op13_simhash"} <= set(queries.QUERIES)
