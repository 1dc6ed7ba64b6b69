"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``, found by A*.

The lattice has a node for each number of rows used and each state of the grammar; edits are its edges. A* pops nodes by
(cost plus heuristic, audit), where the audit is the initials of the edits so far and the heuristic the suffix sum of what
the rows still cost at the least: 4 for a row that has to go, 3 for a truncated one. It never exceeds the true rest and falls by
no more than an edge costs, so that a node's first pop is its cheapest and, among those, its ASCII-least audit: from one state,
audits of equal cost over the same rows are never prefixes of each other.

Rows get a global order once (a range sort, ties dealt over tasks) and are cut into blocks of :data:`BLOCK` rows. A block's search
gives the best edits from each state to each state for a conversation that reaches over its ends, and blocks of a conversation
compose like matrices over (min, +): no task needs a whole conversation. Edits go back to the rows by an equi-join. Only
SHA-256 of a whole conversation (:func:`digest`) reads it in order in one task, as a stream.

Odd input: null roles and texts are one space; a role without an initial can't be kept; equal turns are ordered by the
SHA-256 of role and text, null turns come first; repeated rows are duplicates; a null conv_id is a conversation of its own; other
columns are left out; no rows give none.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._spark import prepare, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after a system row, after a user row, after an assistant row; which role comes next, and the state then.
NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
BLOCK = 512
SPACES = r"\x20\x09-\x0D"


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows dropped, emptied, unpunctuated, repeated or given the role user, by a hash of their key."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("code"))
    damaged = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter(F.col("code") != 0).select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), damaged.alias("text"), "code")
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def ordered(conversations: DataFrame) -> DataFrame:
    """(seq, conv_id, turn, role, text, h): rows with a number that follows conversation and turn, stored."""
    prepare(conversations.sparkSession)
    text = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    hashed = rows.withColumn("h", F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).withColumn("at", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "h", "at"]  # "at" parts equal rows, which may be many
    dealt = hashed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return store(dealt.select(F.monotonically_increasing_id().alias("seq"), "conv_id", "turn", "role", "text", "h"))


def faults(rows: DataFrame) -> DataFrame:
    """(seq, conv_id, turn, initial, kind) of ordered rows; kind: B blank, D duplicate, T truncated, or empty."""
    blank, ended = ~F.col("text").rlike(f"[^{SPACES}]"), F.col("text").rlike(rf"[.!?][{SPACES}]*\z")
    light = rows.select("seq", "conv_id", "turn", "h", F.substring("role", 1, 1).alias("initial"), F.when(blank, "B").when(~ended, "T").otherwise("").alias("kind"))
    firsts = light.groupBy("conv_id", "h").agg(F.min("seq").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    firsts = firsts.select(F.col("conv_id").alias("of"), F.col("h").alias("same"), "first")
    marked = light.join(firsts, light.conv_id.eqNullSafe(firsts.of) & (light.h == firsts.same), "left")
    kind = F.when((F.col("kind") != "B") & (F.col("seq") > F.col("first")), "D").otherwise(F.col("kind"))
    return marked.select("seq", "conv_id", "turn", "initial", kind.alias("kind"))


def search(rows: list[tuple[str, str]], start: int, goals: tuple[int, ...], first_only: bool = False) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the best edits of (kind, initial) rows from a state to each goal (``first_only``: to the best goal)."""
    least = {"B": DELETE, "D": DELETE, "T": TRUNCATED}
    rest = [0] * (len(rows) + 1)
    for i in reversed(range(len(rows))):
        rest[i] = rest[i + 1] + least.get(rows[i][0], 0)
    queue, done, found = [(rest[0], "", 0, start)], set(), {}
    while queue and len(found) < (1 if first_only else len(goals)):
        f, audit, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in goals:
            found[state] = (f, audit)
        role, after = NEXT[state]
        edges = [(INSERT, "I", i, after)]
        if i < len(rows):
            kind, initial = rows[i]
            edges.append((DELETE, "D", i + 1, state))
            if kind not in ("B", "D"):
                charge = TRUNCATED if kind == "T" else 0
                edges.append((REROLE + charge, "R", i + 1, after))
                if initial == role or (initial == "s" and state == 0):
                    edges.append((KEEP + charge, "K", i + 1, 1 if initial == "s" else after))
        for cost, letter, j, to in edges:
            if (j, to) not in done:
                heapq.heappush(queue, (f - rest[i] + cost + rest[j], audit + letter, j, to))
    return found


def walk(audit: str, initials: list[str], state: int) -> tuple[list[tuple[list[str], str | None, str]], list[str], int]:
    """For each row (roles inserted before it, its new role if it gets one, its edit), roles inserted at the end, and the last state."""
    edits, inserted = [], []
    for letter in audit:
        role, after = NEXT[state]
        if letter == "I":
            inserted.append(ROLES[role])
            state = after
            continue
        if letter == "K":
            state = 1 if initials[len(edits)] == "s" and state == 0 else after
        elif letter == "R":
            state = after
        edits.append((inserted, ROLES[role] if letter == "R" else None, letter))
        inserted = []
    return edits, inserted, state


_COUNTS = "n long, blank long, duplicate long, truncated long, illegal long, lo long, hi long, turns long"
_STEPS = pa.list_(pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_EDITS = pa.list_(pa.struct([("seq", pa.int64()), ("before", pa.list_(pa.string())), ("role", pa.string()), ("edit", pa.string()), ("after", pa.list_(pa.string()))]))


def _of_block(table: pa.Table) -> pa.Table:
    """A row for each conversation of a block: its counts, and its best edits between states."""
    table = table.sort_by("seq")
    seqs, turns, initials, kinds = (table.column(c).to_pylist() for c in ("seq", "turn", "initial", "kind"))
    ids = table.column("conv_id").to_pylist()
    runs = [list(g) for _, g in groupby(range(len(ids)), key=lambda i: ids[i])]
    out: dict[str, list] = {c: [] for c in ("conv_id", "seq", "initials", "steps", "n", "blank", "duplicate", "truncated", "illegal", "lo", "hi", "turns")}
    for k, run in enumerate(runs):
        at = slice(run[0], run[-1] + 1)
        rows, first = list(zip(kinds[at], initials[at], strict=True)), initials[at]
        inner = 0 < k < len(runs) - 1
        steps = [{"start": s, "goal": g, "cost": c, "audit": a} for s in ((0,) if inner else NEXT) for g, (c, a) in search(rows, s, ENDS if inner else tuple(NEXT), inner).items()]
        known = [t for t in turns[at] if t is not None]
        bad = sum(f"{a}{b}" not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        values = (ids[run[0]], seqs[run[0]], first, steps, len(run), *(kinds[at].count(x) for x in "BDT"), bad, *((known[0], known[-1]) if known else (None, None)), len(set(known)))
        for name, value in zip(out, values, strict=True):
            out[name].append(value)
    types = [table.schema.field("conv_id").type, pa.int64(), pa.list_(pa.string()), _STEPS, *[pa.int64()] * 8]
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)})


def _of_conversation(parts: list[dict]) -> list[dict]:
    """A row for each block of a conversation: the edits of its rows; the first one also has the conversation's sums."""
    best: dict[int, tuple[int, str, list[str]]] = {0: (0, "", [])}
    for part in parts:
        after: dict[int, tuple[int, str, list[str]]] = {}
        for step in part["steps"]:
            if step["start"] in best:
                cost, audit, pieces = best[step["start"]]
                found = (cost + step["cost"], audit + step["audit"], [*pieces, step["audit"]])
                after[step["goal"]] = min(after.get(step["goal"], found), found)
        best = after
    cost, audit, pieces = min(best[g] for g in ENDS if g in best)
    sums = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(f"{a['initials'][-1]}{b['initials'][0]}" not in ("su", "ua", "au") for a, b in zip(parts, parts[1:], strict=False))
    known = [p for p in parts if p["lo"] is not None]
    distinct = sum(p["turns"] for p in known) - sum(a["hi"] == b["lo"] for a, b in zip(known, known[1:], strict=False))
    sums |= {"cost": cost, "audit": audit, "gaps": known[-1]["hi"] - known[0]["lo"] + 1 - distinct if known else 0}
    out, state = [], 0
    for part, piece in zip(parts, pieces, strict=True):
        edits, last, state = walk(piece, part["initials"], state)
        rows = [{"seq": part["seq"] + i, "before": before, "role": role, "edit": edit, "after": last if i == len(edits) - 1 else []} for i, (before, role, edit) in enumerate(edits)]
        out.append({"conv_id": part["conv_id"], "edits": rows, **(dict.fromkeys(sums) if out else sums)})
    return out


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Composes the blocks of each conversation; they come in order."""
    kept: list[dict] = []
    schema = None

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    ready: list[dict] = []
    for b in batches:
        schema = schema or pa.schema([("conv_id", b.schema.field("conv_id").type), ("edits", _EDITS), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("gaps", pa.int64())])
        for row in b.to_pylist():
            if kept and kept[0]["conv_id"] != row["conv_id"]:
                ready += _of_conversation(kept)
                kept = []
            kept.append(row)
            if len(ready) >= 1024:
                yield batch(ready)
                ready = []
    if kept:
        ready += _of_conversation(kept)
    if ready:
        yield batch(ready)


def plans(rows: DataFrame) -> DataFrame:
    """(conv_id, edits, and in one row of each conversation its sums) for ordered rows, stored."""
    key = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)])
    steps = "array<struct<start: int, goal: int, cost: long, audit: string>>"
    of_block = T._parse_datatype_string(f"seq long, initials array<string>, steps {steps}, {_COUNTS}")
    blocks = faults(rows).select("seq", "conv_id", "turn", "initial", "kind").groupBy(F.shiftright("seq", BLOCK.bit_length() - 1).alias("block")).applyInArrow(_of_block, T.StructType([*key, *of_block]))
    edits = "array<struct<seq: long, before: array<string>, role: string, edit: string, after: array<string>>>"
    of_conversation = T._parse_datatype_string(f"edits {edits}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, gaps long")
    return store(blocks.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_fold, T.StructType([*key, *of_conversation])))


def _edited(rows: DataFrame, made: DataFrame) -> DataFrame:
    edits = made.select(F.explode("edits").alias("e")).select(F.col("e.seq").alias("seq"), "e.before", F.col("e.role").alias("new"), "e.edit", "e.after")
    met = rows.select("seq", "conv_id", "turn", "role", "text").join(edits.hint("merge"), "seq")  # edits are stored so compressed that Spark would take them for small
    row = lambda role, text, edit: F.struct(role.alias("role"), text.alias("text"), edit.alias("edit"))
    inserted = lambda c: F.transform(c, lambda r: row(r, F.lit(""), F.lit("I")))
    own = F.when(F.col("edit") == "D", F.expr("array()")).otherwise(F.array(row(F.coalesce("new", "role"), F.col("text"), F.col("edit"))))
    return met.select("conv_id", "seq", F.posexplode(F.concat(inserted("before"), own, inserted("after"))).alias("sub", "row")).select("conv_id", "seq", "sub", "row.role", "row.text", "row.edit")


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, seq, sub, role, text, edit), in the order of (seq, sub); edit: K kept, R given another role, I inserted."""
    rows = ordered(conversations)
    return _edited(rows, plans(rows))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` lines of each conversation, row by row as they come."""
    key, sha, at = None, None, None
    for b in batches:
        ids, roles, texts = (b.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        key, done = key or b.schema.field("conv_id").type, []
        for i, role, text in zip(ids, roles, texts, strict=True):
            if sha is None or i != at:
                if sha is not None:
                    done.append((at, sha.hexdigest()))
                sha, at = hashlib.sha256(), i
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], key), pa.array([x for _, x in done])], ["conv_id", "repaired_sha256"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], key), pa.array([sha.hexdigest()])], ["conv_id", "repaired_sha256"])


def digest(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The contract's row for each conversation, and for each conv_id of ``ids`` that has no row here."""
    rows = ordered(conversations)
    made = plans(rows)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    sums = made.filter("audit IS NOT NULL").select("conv_id", *names).hint("merge")
    hashed = _edited(rows, made).select("conv_id", "seq", "sub", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "seq", "sub")
    hashes = hashed.mapInArrow(_hashes, T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())]))
    all_ids = (conversations if ids is None else ids).select(F.col("conv_id").alias("id")).distinct()
    met = all_ids.join(sums, all_ids.id.eqNullSafe(sums.conv_id), "left").drop("conv_id")
    met = met.join(hashes, met.id.eqNullSafe(hashes.conv_id), "left").drop("conv_id")
    empty = hashlib.sha256(b"").hexdigest()
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names[:-1]]
    return met.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


#: Dynamic programming over the rows of a conversation; v holds, for each state, its cheapest cost, audit and repaired text.
ORACLE_SQL = r"""
WITH keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(4294967295, list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)),
               lambda acc, b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(acc, b)), CAST(4294967295 AS BIGINT))) % 20 AS code
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM keyed WHERE code <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS pos FROM damaged
), marked AS (
    SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'B' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'D'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'T' ELSE '' END AS kind
    FROM placed
), listed AS (
    SELECT conv_id, count(*) FILTER (WHERE kind = 'B') AS blank, count(*) FILTER (WHERE kind = 'D') AS duplicate, count(*) FILTER (WHERE kind = 'T') AS truncated,
           count(*) FILTER (WHERE pos > 1 AND (earlier || initial) NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           list({'kind': kind, 'i': initial, 'role': role, 'text': text} ORDER BY pos) AS rows
    FROM marked GROUP BY conv_id
), solved AS (
    SELECT * EXCLUDE (rows), list_reduce(list_concat(rows, [{'kind': 'end', 'i': '', 'role': '', 'text': ''}]), lambda v, r: [
        CASE WHEN r.kind = 'end' THEN v[1] ELSE {'c': v[1].c + 4, 's': v[1].s || 'D', 'r': v[1].r} END,
        CASE WHEN r.kind = 'end' THEN v[2] ELSE list_min([
            {'c': v[2].c + 4, 's': v[2].s || 'D', 'r': v[2].r},
            {'c': v[1].c + CASE WHEN r.kind IN ('B', 'D') OR r.i <> 's' THEN 1000000000 WHEN r.kind = 'T' THEN 3 ELSE 0 END, 's': v[1].s || 'K', 'r': v[1].r || chr(10) || r.role || ':' || r.text}]) END,
        list_min(flatten(list_transform([
            v[3], {'c': v[1].c + 3, 's': v[1].s || 'I', 'r': v[1].r || chr(10) || 'user:'}, {'c': v[2].c + 3, 's': v[2].s || 'I', 'r': v[2].r || chr(10) || 'user:'},
            {'c': v[4].c + 3, 's': v[4].s || 'I', 'r': v[4].r || chr(10) || 'user:'}], lambda x: [{'c': x.c + CASE WHEN r.kind = 'end' THEN 0 ELSE 4 END, 's': x.s || CASE WHEN r.kind = 'end' THEN '' ELSE 'D' END, 'r': x.r}]))
          || flatten(list_transform([v[1], v[2], v[4], {'c': v[3].c + 3, 's': v[3].s || 'I', 'r': v[3].r || chr(10) || 'assistant:'}], lambda x: [
            {'c': x.c + CASE WHEN r.kind IN ('B', 'D', 'end') OR r.i <> 'u' THEN 1000000000 WHEN r.kind = 'T' THEN 3 ELSE 0 END, 's': x.s || 'K', 'r': x.r || chr(10) || r.role || ':' || r.text},
            {'c': x.c + CASE WHEN r.kind IN ('B', 'D', 'end') THEN 1000000000 WHEN r.kind = 'T' THEN 6 ELSE 3 END, 's': x.s || 'R', 'r': x.r || chr(10) || 'user:' || r.text}]))),
        list_min(flatten(list_transform([
            v[4], {'c': v[3].c + 3, 's': v[3].s || 'I', 'r': v[3].r || chr(10) || 'assistant:'}, {'c': v[1].c + 6, 's': v[1].s || 'II', 'r': v[1].r || chr(10) || 'user:' || chr(10) || 'assistant:'},
            {'c': v[2].c + 6, 's': v[2].s || 'II', 'r': v[2].r || chr(10) || 'user:' || chr(10) || 'assistant:'}], lambda x: [{'c': x.c + CASE WHEN r.kind = 'end' THEN 0 ELSE 4 END, 's': x.s || CASE WHEN r.kind = 'end' THEN '' ELSE 'D' END, 'r': x.r}]))
          || flatten(list_transform([
            v[3], {'c': v[1].c + 3, 's': v[1].s || 'I', 'r': v[1].r || chr(10) || 'user:'}, {'c': v[2].c + 3, 's': v[2].s || 'I', 'r': v[2].r || chr(10) || 'user:'}, {'c': v[4].c + 3, 's': v[4].s || 'I', 'r': v[4].r || chr(10) || 'user:'}], lambda x: [
            {'c': x.c + CASE WHEN r.kind IN ('B', 'D', 'end') OR r.i <> 'a' THEN 1000000000 WHEN r.kind = 'T' THEN 3 ELSE 0 END, 's': x.s || 'K', 'r': x.r || chr(10) || r.role || ':' || r.text},
            {'c': x.c + CASE WHEN r.kind IN ('B', 'D', 'end') THEN 1000000000 WHEN r.kind = 'T' THEN 6 ELSE 3 END, 's': x.s || 'R', 'r': x.r || chr(10) || 'assistant:' || r.text}])))],
        [{'c': CAST(0 AS BIGINT), 's': '', 'r': ''}, {'c': 1000000000, 's': '', 'r': ''}, {'c': 1000000000, 's': '', 'r': ''}, {'c': 1000000000, 's': '', 'r': ''}]) AS v
    FROM listed
), best AS (SELECT * EXCLUDE (v), list_min([v[1], v[4]]) AS b FROM solved)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(b.c, 0) AS cost, coalesce(b.s, '') AS audit, sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN best ON i.conv_id IS NOT DISTINCT FROM best.conv_id
"""
