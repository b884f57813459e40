"""Conversation structure repair: the cheapest edits that make the turns of each conversation alternate.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in pairs. Edits form a lattice: its
nodes are (rows used, what the last kept turn was), its edges keep, rerole, delete or insert a turn. The cheapest path is found from
both ends by Dijkstra's algorithm.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs of the edits; a row that stays although it is cut off costs one more.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: What was put out last: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that must or may come next, and where it leads; a system turn may also come first.
NEXT = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
FINAL = (NOTHING, ASSISTANT)
ROLES = {"s": "system", "u": "user", "a": "assistant"}

#: A row's fault, one letter each.
FINE, BLANK, DUPLICATE, TRUNCATED = "-bdt"


def edits(roles: str, faults: str, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(initial, cost, rows used, state) of each edit at a node; no two have one initial."""
    wanted, after = NEXT[state]
    if i < len(roles):
        yield "D", DELETE, i + 1, state
    yield "I", INSERT, i, after
    if i < len(roles) and faults[i] not in (BLANK, DUPLICATE):
        more = CUT if faults[i] == TRUNCATED else 0
        if roles[i] == wanted:
            yield "K", KEEP + more, i + 1, after
        elif roles[i] == "s" and state == NOTHING:
            yield "K", KEEP + more, i + 1, SYSTEM
        yield "R", REROLE + more, i + 1, after


#: From which states each state is reached by a turn put out, and the turn.
BEFORE = {NOTHING: (), SYSTEM: ((NOTHING, "s"),), USER: ((NOTHING, "u"), (SYSTEM, "u"), (ASSISTANT, "u")), ASSISTANT: ((USER, "a"),)}


def edits_into(roles: str, faults: str, j: int, after: int) -> Iterator[tuple[str, int, int, int]]:
    """(initial, cost, rows used before, state before) of each edit that ends at a node."""
    if j:
        yield "D", DELETE, j - 1, after
    kept = j and faults[j - 1] not in (BLANK, DUPLICATE)
    more = CUT if j and faults[j - 1] == TRUNCATED else 0
    for state, turn in BEFORE[after]:
        if turn != "s":
            yield "I", INSERT, j, state
        if kept:
            if roles[j - 1] == turn:
                yield "K", KEEP + more, j - 1, state
            if turn != "s":
                yield "R", REROLE + more, j - 1, state


class Forward:
    """The least audit among the cheapest paths to each node, as a tree of nodes.

    Of two audits with one cost to one node neither starts with the other (what is longer would hold more inserts), so the lesser stays lesser
    whatever follows. They are compared where the paths part; a jump pointer per node finds that place in logarithmic time.
    """

    def __init__(self) -> None:
        self.parent: dict = {}
        self.jump: dict = {}
        self.depth: dict = {}
        self.edit: dict = {}

    def add(self, node, parent, edit: str) -> None:
        self.parent[node], self.edit[node] = parent, edit
        if parent is None:
            self.depth[node], self.jump[node] = 0, node
            return
        self.depth[node] = self.depth[parent] + 1
        far = self.jump[parent]
        even = self.depth[parent] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]]
        self.jump[node] = self.jump[far] if even else parent

    def less(self, one, edit: str, other, its_edit: str) -> bool:
        """Whether the path to ``one`` and then ``edit`` gives a lesser audit than that to ``other`` and ``its_edit``."""
        if one == other:
            return edit < its_edit
        depth = min(self.depth[one], self.depth[other])
        a, last_a = self.lifted(one, depth, edit)
        b, last_b = self.lifted(other, depth, its_edit)
        if a == b:
            return last_a < last_b
        while self.parent[a] != self.parent[b]:
            if self.jump[a] != self.jump[b]:
                a, b = self.jump[a], self.jump[b]
            else:
                a, b = self.parent[a], self.parent[b]
        return self.edit[a] < self.edit[b]

    def lifted(self, node, depth: int, edit: str):
        """The node's ancestor at ``depth``, and the edit that leads from it towards the node's ``edit``."""
        while self.depth[node] > depth:
            if self.depth[self.jump[node]] > depth:
                node = self.jump[node]
            else:
                node, edit = self.parent[node], self.edit[node]
        return node, edit

    def audit(self, node) -> str:
        out = []
        while self.parent[node] is not None:
            out.append(self.edit[node])
            node = self.parent[node]
        return "".join(reversed(out))


def cheapest(roles: str, faults: str) -> tuple[int, str]:
    """The cost of the cheapest edits and, of those, the least audit.

    Both heaps order nodes by cost and then by rows from their end, so edits that cost nothing come after all that lead to them. The search goes on while
    the two smallest costs left add up to no more than the best path found, and thus settles every node where a
    cheapest path may cross from one side to the other: the last node settled forward, and the next one, settled in reverse. Of all
    such crossings the least joined audit is the answer.
    """
    n = len(roles)
    start = (0, NOTHING)
    cost, back = {start: 0}, {(n, state): 0 for state in FINAL}
    reach: dict = {start: (None, "")}  # The best way to a node so far.
    onward: dict = {node: (None, "") for node in back}
    tree, settled, closed = Forward(), set(), set()
    heap, rear = [(0, 0, NOTHING)], [(0, 0, state) for state in FINAL]
    best = back.get(start, 1 << 60)
    while heap and rear and heap[0][0] + rear[0][0] <= best:
        if heap[0][0] <= rear[0][0]:
            so_far, i, state = heapq.heappop(heap)
            node = (i, state)
            if node in settled:
                continue
            settled.add(node)
            tree.add(node, *reach[node])
            for edit, price, j, after in edits(roles, faults, i, state):
                to, total = (j, after), so_far + price
                known = cost.get(to)
                if known is None or total < known:
                    cost[to] = total
                    reach[to] = (node, edit)
                    heapq.heappush(heap, (total, j, after))
                elif total == known and to not in settled and tree.less(node, edit, *reach[to]):
                    reach[to] = (node, edit)
                if to in back:
                    best = min(best, total + back[to])
        else:
            so_far, behind, after = heapq.heappop(rear)
            node = (n - behind, after)
            if node in closed:
                continue
            closed.add(node)
            for edit, price, i, state in edits_into(roles, faults, n - behind, after):
                to, total = (i, state), so_far + price
                known = back.get(to)
                if known is None or total < known:
                    back[to] = total
                    onward[to] = (node, edit)
                    heapq.heappush(rear, (total, n - i, state))
                elif total == known and to not in closed and edit < onward[to][1]:
                    onward[to] = (node, edit)
                if to in cost:
                    best = min(best, total + cost[to])
    found = [tree.audit(node) for node in settled if node[0] == n and node[1] in FINAL and cost[node] == best]
    for node in settled:
        for edit, price, j, after in edits(roles, faults, *node):
            to = (j, after)
            if to not in settled and to in closed and cost[node] + price + back[to] == best:
                rest = []
                at = to
                while at is not None:
                    at, one = onward[at]
                    rest.append(one)
                found.append(tree.audit(node) + edit + "".join(rest))
    return best, min(found)


@lru_cache(maxsize=1 << 16)
def _short(roles: str, faults: str) -> tuple[int, str]:
    return cheapest(roles, faults)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy``: the rows after the damage that the hash of (conv_id, turn) deals to them.

    Of 20 hashes 0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role user.
    A null role or text is one space, as is a null conv_id or turn in the hash.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    dealt = rows.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).cast("int").alias("dealt")).where("dealt <> 0")
    text = F.coalesce("text", space)
    changed = dealt.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("dealt") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return changed.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy"))


def features(rows: DataFrame) -> DataFrame:
    """What the search needs of each row: role's initial, digest of role and text, blank or cut off. Texts are left behind."""
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "copy",
        digest().alias("digest"),
        F.when(last == "", BLANK).when(~last.isin(*ENDS), TRUNCATED).otherwise(FINE).alias("fault"),
    )


def digest() -> Column:
    """Rows with one role and text have one digest; the length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


#: Rows of one turn are ordered by role and digest, so that the order does not depend on how the table was read.
ORDER = ["turn", "role", "digest", "copy"]
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass
class Open:
    """A conversation while its rows go by: a few bytes for each row, no text."""

    conv_id: object
    roles: list[str] = field(default_factory=list)
    faults: list[str] = field(default_factory=list)
    seen: set = field(default_factory=set)
    turns: list = field(default_factory=lambda: [None, None, 0])
    illegal: int = 0

    def add(self, turn, role: str, fault: str, mark: bytes) -> None:
        if fault != BLANK and mark in self.seen:
            fault = DUPLICATE
        self.seen.add(mark)
        initial = role[:1]
        if self.roles and self.roles[-1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.roles.append(initial if initial in ROLES else "-")
        self.faults.append(fault)
        if turn is not None:
            if turn != self.turns[1]:
                self.turns[2] += 1
            self.turns[0] = turn if self.turns[0] is None else self.turns[0]
            self.turns[1] = turn

    def report(self) -> tuple:
        roles, faults = "".join(self.roles), "".join(self.faults)
        cost, audit = (_short if len(roles) <= 64 else cheapest)(roles, faults)
        low, high, distinct = self.turns
        gaps = 0 if low is None else high - low + 1 - distinct
        return (self.conv_id, gaps, *(faults.count(x) for x in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost, audit)


def reports(rows: DataFrame) -> DataFrame:
    """``conv_id`` and REPORT for each conversation with rows, from ``features``.

    Rows come to one task per conversation, sorted by Spark, and are read in batches; a row leaves some bytes and its digest behind.
    """
    name = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {name}, {REPORT}"
    kept = pa.schema([("conv_id", pa.null()), *((c.split()[0], pa.int64()) for c in REPORT.split(", ")[:-1]), ("audit", pa.string())])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Open | None = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "fault", "digest"))
            for conv_id, turn, role, fault, mark in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.report())
                    now = Open(conv_id)
                now.add(turn, role, fault, mark)
            if done:
                yield packed(done, kept, batch.schema.field("conv_id").type)
            kind = batch.schema.field("conv_id").type
        if now is not None:
            yield packed([now.report()], kept, kind)

    return gathered(rows, ORDER).mapInArrow(told, schema)


def packed(rows: list[tuple], schema: pa.Schema, kind: pa.DataType) -> pa.RecordBatch:
    schema = schema.set(0, pa.field("conv_id", kind))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def gathered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of one conversation after each other, in order, nulls first."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): REPORT and ``repaired_sha256``, the digest of
    the repaired turns as ``role:text`` lines.

    A conversation's audit is sent ahead of its rows to the task that reads them in order, so texts go by one at a time and
    the digest grows with them. A null conv_id is a conversation of its own, null turns come first.
    """
    found = reports(features(rows))
    nothing = (F.lit(None).cast(kind).alias(c) for c, kind in NO_ROW)
    heads = found.select("conv_id", F.lit(0).alias("late"), *nothing, F.struct("*").alias("report"))
    lines = rows.select("conv_id", F.lit(1).alias("late"), "turn", "role", digest().alias("digest"), "copy", "text")
    lines = lines.withColumn("report", F.lit(None).cast(found.schema))
    fields = ["conv_id", *(c.split()[0] for c in REPORT.split(", "))]
    name = rows.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("late", "role", "text", "report"))
            for late, role, text, report in zip(*columns):
                if not late:
                    if work is not None:
                        done.append(work.end())
                    work = Lines(report)
                else:
                    work.add(role, text)
            kind = batch.schema.field("conv_id").type
            if done:
                yield packed(done, out, kind)
        if work is not None:
            yield packed([work.end()], out, kind)

    out = pa.schema([("conv_id", pa.null()), *((c, pa.int64()) for c in fields[1:-1]), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    both = gathered(heads.unionByName(lines), ["late", *ORDER])
    return both.mapInArrow(hashed, f"conv_id {name}, {REPORT}, repaired_sha256 string")


NO_ROW = [("turn", "long"), ("role", "string"), ("digest", "binary"), ("copy", "int"), ("text", "string")]


class Lines:
    """The digest of a conversation's repaired lines, while its rows go by."""

    def __init__(self, report: dict) -> None:
        self.report, self.audit, self.at, self.state = report, report["audit"], 0, NOTHING
        self.sum, self.first = hashlib.sha256(), True

    def put(self, role: str, text: str) -> None:
        self.sum.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            turn, self.state = NEXT[self.state]
            self.put(ROLES[turn], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        turn, after = NEXT[self.state]
        if edit == "K" and role[:1] == "s":
            after = SYSTEM
        self.state = after
        self.put(role if edit == "K" else ROLES[turn], text)

    def end(self) -> tuple:
        self.inserts()
        return (*self.report.values(), self.sum.hexdigest())


def repair(conversations: DataFrame) -> DataFrame:
    """Damages ``conversations`` as the check asks and repairs them; one row for every conv_id there was.

    Conversations without rows left have zeros, an empty audit and the digest of nothing. Columns other than conv_id, turn, role and text
    take no part and may have any name.
    """
    rows = damaged(conversations)
    found = repaired(rows)
    gone = conversations.select(F.col("conv_id").alias("_id")).distinct()
    all_ids = gone.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zeros = {c.split()[0]: F.lit(0).cast("long") for c in REPORT.split(", ")[:-1]}
    zeros |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return all_ids.select(F.col("_id").alias("conv_id"), *(F.coalesce(c, z).alias(c) for c, z in zeros.items()))
