"""Repair of conversation structure: the cheapest edits after which the roles
of every conversation read ``(system? (user assistant)+)?``.

1. turns are range-partitioned into conversation order and stored, so a long
   conversation spreads over many tasks; every row gets its place;
2. each row becomes one byte (role initial and first fault); blocks of bounded
   size collect these bytes, so a conversation arrives at its task with one
   byte per turn;
3. a cost table over (row, grammar state) marks the optimal arcs.  Each edit
   letter leads from a node to one node, so a node's least audit of 2**k letters
   ends at one node: its pointer.  Nodes are ranked by their first letter, then
   by (own rank, rank at the pointer) for 2, 4, 8 ... letters; the least audit
   is read off the doubled pointers.  A long conversation is solved in blocks
   from the back: four costs and four ranks go from a block to the one before;
4. edits go back to the stored rows by their place.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path
from .common import shared

BLANKS = " \t\n\x0b\x0c\r"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
BLOCK_BITS = 12
UNIT = 1 << 16
# A row's byte: its role initial, and a bit for its first fault.
SYSTEM, USER, ASSISTANT = 1, 2, 3
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16
# States: nothing yet, after system, after user, after assistant; the grammar
# ends in the first or the last.  From each state one of user and assistant may
# follow.
NEXT = np.array([2, 2, 3, 2])
KEPT = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
# After the last row: what is still to be inserted, by state.
TAIL = ["", "ua", "a", ""]
LETTERS = np.array(list("DIKR"))
NEVER = 1 << 40
ROLE_NAMES = {"u": "user", "a": "assistant"}


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of test damage that depends on id and turn
    alone: dropped, emptied, cut punctuation, repeated, wrong role."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code, text = F.col("code"), F.coalesce("text", blank)
    return (
        turns.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("code"))
        .filter(code != 0)
        .select(
            "conv_id",
            "turn",
            F.when(code == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def placed(turns: DataFrame) -> DataFrame:
    """The turns in conversation order, stored with their place.  Equal rows
    are spread by a random key, so no run of rows is too long to split."""
    src = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    digest = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    order = ["conv_id", "turn", "role", "digest"]
    rows = src.withColumns({"digest": digest, "salt": F.rand(11)}).repartitionByRange(*order, "salt").sortWithinPartitions(*order)
    path = scratch_path(turns.sparkSession, f"turns-{uuid.uuid4().hex}")
    rows.drop("salt").withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    return turns.sparkSession.read.parquet(path)


def row_bytes(rows: DataFrame) -> DataFrame:
    """(conv_id, place, kind) of the placed rows."""
    same = rows.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    again = shared(same.filter("n > 1").select(F.col("conv_id").alias("same_conv"), F.col("digest").alias("same"), "first"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select(
        "conv_id",
        "digest",
        "place",
        F.substring("role", 1, 1).alias("initial"),
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    joined = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("same_conv")) & (F.col("digest") == F.col("same")), "left")
    initial = F.col("initial")
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    fault = F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0)
    return joined.select("conv_id", "place", (role + fault).cast("tinyint").alias("kind"))


def blocks(kinds: DataFrame, block_bits: int) -> DataFrame:
    """(conv_id, start, kinds): runs of at most 2**block_bits rows with
    consecutive places."""
    return (
        kinds.groupBy("conv_id", F.shiftright("place", block_bits).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "kind"))).alias("rows"))
        .select("conv_id", F.col("rows")[0]["place"].alias("start"), F.col("rows.kind").alias("kinds"))
    )


class Solved:
    """Optimal arcs of runs of rows, given costs and ranks of the four states
    after each run.  Node 4 * row + state; the states after run c are the nodes
    4 * (number of rows + c) + state."""

    def __init__(self, kinds: np.ndarray, bounds: np.ndarray, end_cost: np.ndarray, end_rank: np.ndarray):
        n, runs = len(kinds), len(bounds) - 1
        self.n, self.starts = n, bounds[:-1]
        after = np.arange(1, n + 1)
        after[bounds[1:] - 1] = n + np.arange(runs)
        editable = (kinds & (BLANK | DUPLICATE)) == 0
        late = np.where(kinds & TRUNCATED, TRUNCATED_COST, 0)
        # Per node and letter D, I, K, R: where it leads and what it costs.
        state = np.arange(4)
        base = 4 * after[:, None]
        kept = KEPT[kinds & 3]
        target = np.stack([base + state, 4 * np.arange(n)[:, None] + NEXT, base + np.maximum(kept, 0), base + NEXT], axis=2)
        price = np.stack(
            [
                np.full((n, 4), DELETE_COST),
                np.full((n, 4), INSERT_COST),
                np.where((kept >= 0) & editable[:, None], KEEP_COST + late[:, None], NEVER),
                np.where(editable, REROLE_COST + late, NEVER)[:, None].repeat(4, axis=1),
            ],
            axis=2,
        )
        cost = np.zeros(4 * (n + runs), np.int64)
        cost[4 * n :] = end_cost.ravel()
        order = np.argsort(-np.diff(bounds), kind="stable")
        length = np.diff(bounds)[order]
        for step in range(int(length.max(initial=0))):  # rows from the end, of all runs that are as long
            row = bounds[1:][order[: np.searchsorted(-length, -step, "left")]] - 1 - step
            best = (price[row][:, :, [0, 2, 3]] + cost[target[row][:, :, [0, 2, 3]]]).min(axis=2)
            user, assistant = best[:, 2].copy(), best[:, 3].copy()
            best[:, 2] = np.minimum(user, INSERT_COST + assistant)
            best[:, 3] = np.minimum(assistant, INSERT_COST + user)
            best[:, :2] = np.minimum(best[:, :2], INSERT_COST + best[:, 2:3])
            cost[4 * row[:, None] + state] = best
        self.cost = cost
        optimal = price + cost[target] == cost[: 4 * n].reshape(n, 4, 1)
        self.letter = optimal.argmax(axis=2).ravel()  # the least of the optimal letters
        # Ranks of audits of 1, 2, 4 ... letters, and where these letters end.
        rank = np.concatenate([4 + self.letter, end_rank.ravel()])
        pointer = np.concatenate([target.reshape(-1, 4)[np.arange(4 * n), self.letter], 4 * n + np.arange(4 * runs)])
        length = np.concatenate([np.ones(4 * n, np.int64), np.zeros(4 * runs, np.int64)])
        self.pointers = [pointer]
        while (pointer < 4 * n).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            length = length + length[pointer]
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        self.rank, self.length = rank, length

    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """Costs and ranks of the four states at the start of each run."""
        nodes = 4 * self.starts[:, None] + np.arange(4)
        ranks = self.rank[nodes]
        return self.cost[nodes], (ranks[:, :, None] > ranks[:, None, :]).sum(axis=2)

    def paths(self, entry: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per run the edits from state ``entry``: bounds, rows, letters, role
        after the edit ('u' or 'a', of inserted and rerolled rows); and the
        state each run ends in."""
        start = 4 * self.starts + entry
        bounds = np.concatenate([[0], np.cumsum(self.length[start])])
        node = np.repeat(start, np.diff(bounds))
        step = np.arange(len(node)) - np.repeat(bounds[:-1], np.diff(bounds))
        for k, pointer in enumerate(self.pointers):
            node = np.where(step >> k & 1, pointer[node], node)
        role = np.where(NEXT[node % 4] == 2, "u", "a")
        return bounds, node // 4, LETTERS[self.letter[node]], role, (self.pointers[-1][start] - 4 * self.n) % 4


END_COST = np.array([[INSERT_COST * len(t) for t in TAIL]])
END_RANK = np.array([[len(t) for t in TAIL]])  # '' before 'I' before 'II'


def edits_of(kinds: np.ndarray, bounds: np.ndarray, unit: int) -> Iterator[tuple[np.ndarray, list[str], list[str], int]]:
    """(rows, letters, roles, cost) per conversation, rows counted from its
    start; rows inserted after the last one have its length as row."""
    runs = len(bounds) - 1
    if runs == 1 and bounds[1] > unit:
        cuts = np.append(np.arange(0, bounds[1], unit), bounds[1])
        ends = [(END_COST, END_RANK)]
        for lo, hi in zip(cuts[-2::-1], cuts[:0:-1]):
            ends.append(Solved(kinds[lo:hi], np.array([0, hi - lo]), *ends[-1]).before())
        entry, rows, letters, roles = np.zeros(1, np.int64), [], [], []
        for lo, hi, end in zip(cuts[:-1], cuts[1:], ends[-2::-1]):
            _, row, letter, role, entry = Solved(kinds[lo:hi], np.array([0, hi - lo]), *end).paths(entry)
            rows.append(lo + row)
            letters += letter.tolist()
            roles += role.tolist()
        found = [(np.concatenate(rows), letters, roles, int(ends[-1][0][0, 0]), int(entry[0]))]
    else:
        solved = Solved(kinds, bounds, END_COST.repeat(runs, axis=0), END_RANK.repeat(runs, axis=0))
        at, row, letter, role, last = solved.paths(np.zeros(runs, np.int64))
        cost = solved.before()[0][:, 0]
        found = (
            (row[lo:hi] - first, letter[lo:hi].tolist(), role[lo:hi].tolist(), int(c), int(s))
            for lo, hi, first, c, s in zip(at[:-1], at[1:], bounds[:-1], cost, last)
        )
    for (rows, letters, roles, cost, state), length in zip(found, np.diff(bounds)):
        tail = TAIL[state]
        yield np.append(rows, [length] * len(tail)).astype(np.int64), letters + ["I"] * len(tail), roles + list(tail), cost


def faults(kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per conversation: blank, duplicate, truncated rows, illegal neighbours."""
    role = kinds & 3
    legal = np.isin(role[:-1] * 4 + role[1:], [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
    illegal = np.append(~legal, False)
    illegal[bounds[1:] - 1] = False
    marks = [(kinds & BLANK) > 0, (kinds & DUPLICATE) > 0, (kinds & TRUNCATED) > 0, illegal]
    return np.stack([np.add.reduceat(m.astype(np.int64), bounds[:-1]) for m in marks], axis=1)


PIECE = "start bigint, letters string, roles string, rows array<int>, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def solve(runs: DataFrame, unit: int) -> DataFrame:
    """Edits of every block (counts and cost stand on a conversation's first)."""

    def flush(pending: list[tuple]) -> pa.RecordBatch:
        ids, first = [], []  # conversations, and their first blocks
        for i, (conv, _, _) in enumerate(pending):
            if not i or conv != ids[-1]:
                ids.append(conv)
                first.append(i)
        cuts = np.concatenate([[0], np.cumsum([len(k) for _, _, k in pending])])
        kinds, bounds = np.concatenate([k for _, _, k in pending]), cuts[first + [len(pending)]]
        counts, out = faults(kinds, bounds), []
        for c, (rows, letters, roles, cost) in enumerate(edits_of(kinds, bounds, unit)):
            last = first[c + 1] if c + 1 < len(first) else len(pending)
            inner = cuts[first[c] : last] - cuts[first[c]]
            at = np.append(np.searchsorted(rows, inner), len(rows))
            for b, (lo, hi) in enumerate(zip(at[:-1], at[1:])):
                stats = (cost, *counts[c].tolist()) if b == 0 else (0, 0, 0, 0, 0)
                block = pending[first[c] + b]
                out.append((block[0], block[1], "".join(letters[lo:hi]), "".join(roles[lo:hi]), (rows[lo:hi] - inner[b]).tolist(), *stats))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in batches:
            lists = batch.column(2)
            flat, at = np.asarray(lists.flatten(), np.int64).astype(np.int8), np.concatenate([[0], np.cumsum(np.diff(np.asarray(lists.offsets)))])
            for i, (conv, start) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                kinds = flat[at[i] : at[i + 1]]
                # A conversation beyond the unit is solved alone, in parts.
                if pending and conv != pending[-1][0] and (size >= unit or size + len(kinds) > unit):
                    yield flush(pending)
                    pending, size = [], 0
                elif pending and conv == pending[-1][0] and size <= unit < size + len(kinds):
                    done = next((k for k in range(len(pending), 0, -1) if pending[k - 1][0] != conv), 0)
                    if done:
                        yield flush(pending[:done])
                        pending = pending[done:]
                        size = sum(len(p[2]) for p in pending)
                pending.append((conv, start, kinds))
                size += len(kinds)
        if pending:
            yield flush(pending)

    schema = f"conv_id {runs.schema['conv_id'].dataType.simpleString()}, {PIECE}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    ordered = runs.repartition("conv_id").sortWithinPartitions("conv_id", "start")
    return ordered.select("conv_id", "start", "kinds").mapInArrow(run, schema)


class Repair:
    """``summary``: per conversation its counts, cost and audit.  ``rows``: the
    repaired rows, ordered within a conversation by (start, step), each with its
    edit; inserted rows have a null turn."""

    def __init__(self, summary: DataFrame, rows: DataFrame):
        self.summary, self.rows = summary, rows


def repair(turns: DataFrame, block_bits: int = BLOCK_BITS, unit: int = UNIT) -> Repair:
    """Repair the conversations of ``turns`` (conv_id, turn, role, text).

    Rows are taken by turn (null turns first), rows of one turn by role, then
    by a digest of role and text, so that equal rows are neighbours.  A null
    role or text is one space; a null id is one conversation of its own; a role
    of another initial than s, u, a (an empty one too) can only be changed or
    deleted.  An empty table gives empty results; other columns are ignored.
    A conversation's audit is one string of about a letter per row.
    """
    rows = placed(turns)
    pieces = shared(solve(blocks(row_bytes(rows), block_bits), unit))
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("start", "letters")))["letters"], "")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    solved = pieces.groupBy("conv_id").agg(*sums, audit.alias("audit")).withColumnRenamed("conv_id", "solved_id")
    summary = gaps.join(solved, F.col("conv_id").eqNullSafe(F.col("solved_id"))).drop("solved_id")
    edits = pieces.select(
        "conv_id", "start", F.posexplode(F.arrays_zip(F.split("letters", "").alias("letter"), F.split("roles", "").alias("role"), "rows")).alias("step", "e")
    ).select(
        "conv_id", "start", "step", (F.col("start") + F.col("e.rows")).alias("place"), F.col("e.letter").alias("edit"), F.col("e.role").alias("as")
    )
    role = F.when(F.col("as") == "u", "user").otherwise("assistant")
    stay = edits.filter("edit in ('K', 'R')").select("start", "step", "place", "edit", "as").join(rows.drop("digest"), "place")
    kept = stay.select(
        "conv_id", "start", "step", "edit", "turn", F.when(F.col("edit") == "R", role).otherwise(F.col("role")).alias("role"), "text"
    )
    new = edits.filter("edit = 'I'").select(
        "conv_id", "start", "step", "edit", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), role.alias("role"), F.lit("").alias("text")
    )
    return Repair(summary, kept.union(new))


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): ``role:text`` lines joined by newlines.  Rows
    stream through their task in order; nothing of them is kept."""
    id_type = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for conv, role, text in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and conv == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], batch.column(0).type), pa.array([o[1] for o in out])], schema=names(batch))
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.column(0).type), pa.array([digest.hexdigest()])], schema=names(batch))

    def names(batch: pa.RecordBatch) -> pa.Schema:
        return pa.schema([("conv_id", batch.column(0).type), ("repaired_sha256", pa.string())])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "start", "step")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {id_type.simpleString()}, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged conversations: one row per original conv_id,
    also where no row is left (zeros, empty audit, hash of the empty string)."""
    done = repair(damage(conversations))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [
        conversations.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in counts], F.lit("").alias("audit"), F.lit("").alias("sha")),
        done.summary.select("conv_id", *counts, "audit", F.lit("").alias("sha")),
        digests(done.rows).select("conv_id", *[F.lit(0).cast("long").alias(c) for c in counts], F.lit("").alias("audit"), F.col("repaired_sha256").alias("sha")),
    ]
    whole = parts[0].union(parts[1]).union(parts[2])
    aggregates: list[Column] = [F.max(c).alias(c) for c in [*counts, "audit", "sha"]]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.groupBy("conv_id").agg(*aggregates).select(
        "conv_id", *counts, "audit", F.when(F.col("sha") == "", empty).otherwise(F.col("sha")).alias("repaired_sha256")
    )


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _step(state: int) -> str:
    """SQL: the best way on from a state by consuming row r."""
    to = int(NEXT[state]), "user" if NEXT[state] == 2 else "assistant"
    late = f"(CASE WHEN r.fault = 'truncated' THEN {TRUNCATED_COST} ELSE 0 END)"
    free = "r.fault NOT IN ('blank', 'duplicate')"
    options = [
        f"struct_pack(cost := {DELETE_COST} + s{state}.cost, audit := 'D' || s{state}.audit, lines := s{state}.lines)",
        f"struct_pack(cost := CASE WHEN {free} THEN {REROLE_COST} + {late} + s{to[0]}.cost ELSE {NEVER} END,"
        f" audit := 'R' || s{to[0]}.audit, lines := list_prepend('{to[1]}:' || r.text, s{to[0]}.lines))",
    ]
    for code, initial in ((SYSTEM, "s"), (USER, "u"), (ASSISTANT, "a")):
        end = int(KEPT[code][state])
        if end >= 0:
            options.append(
                f"struct_pack(cost := CASE WHEN {free} AND r.role[1] = '{initial}' THEN {late} + s{end}.cost ELSE {NEVER} END,"
                f" audit := 'K' || s{end}.audit, lines := list_prepend(r.role || ':' || r.text, s{end}.lines))"
            )
    return _least(*options) + f" AS b{state}"


def _insert(state: int, source: str) -> str:
    role = "user" if NEXT[state] == 2 else "assistant"
    return (
        f"struct_pack(cost := {INSERT_COST} + {source}.cost, audit := 'I' || {source}.audit, lines := list_prepend('{role}:', {source}.lines))"
    )


ORACLE = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 20 AS code
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, range(CASE WHEN code = 3 THEN 2 ELSE 1 END) t(copy) WHERE code <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM damaged
), r AS (
  SELECT conv_id, turn, role, text, i,
         CASE WHEN body = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM ordered
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
), dp AS (
  SELECT conv_id, n AS i,
         struct_pack(cost := 0::BIGINT, audit := '', lines := []::VARCHAR[]) AS s0,
         struct_pack(cost := {2 * INSERT_COST}::BIGINT, audit := 'II', lines := ['user:', 'assistant:']) AS s1,
         struct_pack(cost := {INSERT_COST}::BIGINT, audit := 'I', lines := ['assistant:']) AS s2,
         struct_pack(cost := 0::BIGINT, audit := '', lines := []::VARCHAR[]) AS s3
  FROM stats
  UNION ALL
  SELECT conv_id, i, {_least("b0", _insert(0, "c2"))}, {_least("b1", _insert(1, "c2"))}, c2, {_least("b3", _insert(3, "b2"))}
  FROM (
    SELECT *, {_least("b2", _insert(2, "b3"))} AS c2
    FROM (
      SELECT dp.conv_id, dp.i - 1 AS i, {", ".join(_step(q) for q in range(4))}
      FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i
    )
  )
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.cost, 0) AS cost,
       coalesce(s0.audit, '') AS audit, sha256(coalesce(array_to_string(s0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM dp WHERE i = 0) d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
