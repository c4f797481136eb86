"""Repair of conversations whose turns should read ``(s?(ua)+)?``, by survivor-coalescence Viterbi.

Every row is kept, gets another role or is deleted, and empty rows are inserted, at the least total cost; of
repairs that cost the same, the one whose edits' initials are least in ASCII is taken. A conversation passes
through one task as a sorted stream. After each row one survivor is left for each state of the pattern. Their
edits form a tree of backpointers with reference counts: as soon as all survivors share an ancestor, its edits
are final, leave the task as rows and are forgotten, so that only the unresolved rows are held. Where two ways
into a state cost the same, their whole unresolved suffixes decide. All survivors end in the edit of the same
row, so none is the beginning of another, and their order never changes again: it is kept as a rank from row
to row instead of being read anew.

A conversation's digest is a hash of its text in order, which has no parallel form; so the rows of one
conversation meet in one task, streamed from a sort that spills, and never as a group in memory. What can
stay unresolved for long is a run of rows none of which has a role of the pattern.

Null ``role`` and ``text`` are one space. Rows without ``conv_id`` are one conversation, rows without ``turn``
come first in theirs, and rows of one turn follow role and text. Repeated rows count as duplicates. Very long
texts pass as they are. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import ASCII_SPACE, partitions, process_cache, table

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping a row is free
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired conversation ends with so far
INSERTED = {NOTHING: (NOTHING, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT),
            ASSISTANT: (ASSISTANT, USER)}  # states after 0, 1, ... insertions; more of them lead nowhere new
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # state after a row with a new role
ENDING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # insertions that complete the pattern
START = (((NOTHING, 0),), 0, ())
NAMES = {USER: "user", ASSISTANT: "assistant"}
EDITS = "step long, edit string, fault string, turn long, found_role string, role string, text string"


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, or None where the pattern has no place for it."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def row_edits(state: int, initial: str, fault: str | None) -> list[tuple[int, int, str]]:
    """(next state, cost, edit) of a row after any insertions."""
    found = [(state, DELETE, "D")]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        found.append((NEXT[state], RELABEL + more, "R"))
        after = kept_state(state, initial)
        if after is not None:
            found.append((after, more, "K"))
    return found


def survivors_after(before: tuple, initial: str, fault: str | None) -> tuple[tuple, int, tuple]:
    """One row further: survivors, cost that all of them share, and each one's (rank before, edits).

    A survivor is (state, cost above the cheapest); survivors stand in the order of their edits. Those that can
    no longer be part of a cheapest repair are left out: what follows SYSTEM or NOTHING is open to ASSISTANT
    too, for at most the deletion of a system row, and one insertion leads from USER to ASSISTANT.
    """
    best: dict[int, tuple[int, int, str]] = {}
    for rank, (state, cost) in enumerate(before):
        for count, between in enumerate(INSERTED[state]):
            for after, price, edit in row_edits(between, initial, fault):
                way = (cost + INSERT * count + price, rank, "I" * count + edit)
                if after not in best or way < best[after]:
                    best[after] = way
    far = 1 << 60
    cost = {state: best[state][0] if state in best else far for state in NEXT}
    open_end = min(cost[ASSISTANT], cost[USER] + INSERT)
    if open_end + DELETE < cost[NOTHING]:
        best.pop(NOTHING, None)
    if min(open_end, cost[NOTHING]) < cost[SYSTEM]:
        best.pop(SYSTEM, None)
    ordered = sorted(best, key=lambda s: best[s][1:])
    least = min(way[0] for way in best.values())
    return tuple((s, best[s][0] - least) for s in ordered), least, tuple(best[s][1:] for s in ordered)


class Edit:
    """A node of the tree of backpointers: the edits up to one row after those of its parent."""

    __slots__ = ("parent", "edits", "references")

    def __init__(self, parent: Edit | None, edits: str):
        self.parent, self.edits = parent, edits
        self.references: set[Edit] = set()  # later nodes that lead back to this one


class Repair:
    """The survivors of one conversation; gives edits as soon as they are final."""

    def __init__(self, steps: dict):
        self.steps = steps  # what survivors_after gave before: relative costs repeat all the time
        self.root = Edit(None, "")
        self.survivors, self.leaves = START[0], [self.root]

    def add(self, initial: str, fault: str | None) -> Iterator[str]:
        """Takes the next row and yields the edits, row by row, that are final now."""
        key = (self.survivors, initial, fault)
        if key not in self.steps:
            self.steps[key] = survivors_after(*key)
        self.survivors, _, ways = self.steps[key]
        before, self.leaves = self.leaves, []
        for rank, edits in ways:
            leaf = Edit(before[rank], edits)
            before[rank].references.add(leaf)
            self.leaves.append(leaf)
        for node in before:
            while not node.references and node is not self.root:  # nobody's ancestor any more
                node.parent.references.discard(node)
                node = node.parent
        leaves = set(self.leaves)
        while len(self.root.references) == 1 and self.root not in leaves:
            self.root = self.root.references.pop()
            self.root.parent = None
            yield self.root.edits

    def finish(self) -> Iterator[str]:
        """Yields the edits that were not final yet, of the cheapest survivor, and insertions at the end."""
        ways = [(cost + INSERT * len(ENDING[state]), rank) for rank, (state, cost) in enumerate(self.survivors)]
        rank = min(ways)[1]
        node, path = self.leaves[rank], []
        while node is not self.root:
            path.append(node.edits)
            node = node.parent
        yield from reversed(path)
        if ENDING[self.survivors[rank][0]]:
            yield ENDING[self.survivors[rank][0]]


def with_faults(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and each row's first fault, every conversation sorted inside one partition."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"))
    by_turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(by_turn)
    dealt = rows.repartition(partitions(rows.sparkSession), "conv_id").withColumn("nth", F.row_number().over(same))
    shown = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    fault = (F.when(shown == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "truncated"))
    return dealt.select("conv_id", "turn", "role", "text", fault.alias("fault")).sortWithinPartitions(
        "conv_id", by_turn, "role", "text", F.col("fault").asc_nulls_first())


def _repairing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = process_cache("conversation steps", dict)
    now: list = [None, None, deque(), NOTHING, 0]  # conversation, repair, rows waiting, state, steps

    def rows_of(edits: str) -> Iterator[tuple]:
        for edit in edits:
            state = now[3]
            if edit == "I":
                row = (None, None, None, NAMES[NEXT[state]], "")
                now[3] = NEXT[state]
            else:
                turn, role, text, fault = now[2].popleft()
                if edit == "D":
                    row = (fault, turn, role, None, text)
                elif edit == "R":
                    row = (fault, turn, role, NAMES[NEXT[state]], text)
                    now[3] = NEXT[state]
                else:
                    row = (fault, turn, role, role, text)
                    now[3] = kept_state(state, role[:1])
            yield (now[0], now[4], edit, *row)
            now[4] += 1

    def packed(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
        names = ["conv_id", *(c.split()[0] for c in EDITS.split(", "))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    types: list[pa.DataType] = []
    for batch in batches:
        text = pa.string()
        types = [batch.schema.field(0).type, pa.int64(), text, text, pa.int64(), text, text, text]
        ready: list[tuple] = []
        for conv, turn, role, words, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if now[1] is None or conv != now[0]:
                if now[1] is not None:
                    for edits in now[1].finish():
                        ready += rows_of(edits)
                now[:] = [conv, Repair(steps), deque(), NOTHING, 0]
            now[2].append((turn, role, words, fault))
            for edits in now[1].add(role[:1], fault):
                ready += rows_of(edits)
        if ready:
            yield packed(ready, types)
    if now[1] is not None:
        ready = [row for edits in now[1].finish() for row in rows_of(edits)]
        if ready:
            yield packed(ready, types)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """One row per edit, in order inside each conversation: conv_id, step, edit (K, R, D, I), the row's fault,
    turn and found_role, and the role and text of the repair (no role where the row is deleted)."""
    key = conversations.schema["conv_id"].dataType.simpleString()
    return with_faults(conversations).mapInArrow(_repairing, f"conv_id {key}, {EDITS}")


DIGEST = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _digesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    prices = {"K": 0, "R": RELABEL, "D": DELETE, "I": INSERT}
    legal = ("su", "ua", "au")

    class Digest:
        def __init__(self, conv):
            self.conv, self.faults = conv, {"blank": 0, "duplicate": 0, "truncated": 0}
            self.low = self.high = self.initial = None
            self.turns = self.illegal = self.cost = 0
            self.audit: list[str] = []
            self.hash, self.first = hashlib.sha256(), True

        def add(self, edit, fault, turn, found, role, text):
            self.audit.append(edit)
            self.cost += prices[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            if found is not None:
                if self.initial is not None and self.initial + found[:1] not in legal:
                    self.illegal += 1
                self.initial = found[:1]
            if role is not None:
                self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
                self.first = False

        def row(self):
            gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
            return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())

    names = ["conv_id", *(c.split()[0] for c in DIGEST.split(", "))]
    now, schema = None, None
    for batch in batches:
        schema = pa.schema([pa.field(n, t) for n, t in zip(names, [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()])])
        done = []
        for conv, step, *edit in zip(*(c.to_pylist() for c in batch.columns)):
            if step == 0:
                if now is not None:
                    done.append(now.row())
                now = Digest(conv)
            now.add(*edit)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(now.row(), schema)], schema=schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: faults found, cost and initials of the edits, hash of the repaired rows."""
    key = conversations.schema["conv_id"].dataType.simpleString()
    return repaired_turns(conversations).mapInArrow(_digesting, f"conv_id {key}, {DIGEST}")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by a checksum of conversation and turn: dropped, emptied, without sentence
    ends, repeated, or from the user."""
    def word(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id", "turn", word("role").alias("role"), word("text").alias("text"),
        (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20).alias("fate")).where("fate != 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.sequence(F.lit(1), times))).drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table; one that lost all rows has zeros, no edits and the hash of nothing."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(rows)).withColumnRenamed("conv_id", "found")
    whole = rows.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("found")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# A recursive query over the rows of each conversation; a state is its cost, its edits and its text, and the
# least of such triples is the cheapest way with the least edits.
OP12_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
               string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''),
               lambda c: ascii(c)::UBIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: z::UBIGINT)),
                                      lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))),
             4294967295::UBIGINT) % 20 AS fate
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM hurt),
rows AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS r,
         CASE WHEN ending = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM placed),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 't': ''} AS n, {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS s,
         {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS u, {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS a
  FROM rows
  UNION ALL
  SELECT conv_id, i,
         {'c': n.c + 4, 'a': n.a || 'D', 't': n.t},
         list_min([{'c': s.c + 4, 'a': s.a || 'D', 't': s.t}, {'c': n.c + keep + if(r = 's', 0, 1000000000), 'a': n.a || 'K', 't': n.t || kept}]),
         list_min([{'c': pu.c + 4, 'a': pu.a || 'D', 't': pu.t}, {'c': pb.c + keep + if(r = 'u', 0, 1000000000), 'a': pb.a || 'K', 't': pb.t || kept},
                   {'c': pb.c + keep + 3, 'a': pb.a || 'R', 't': pb.t || chr(10) || 'user:' || text}]),
         list_min([{'c': pa.c + 4, 'a': pa.a || 'D', 't': pa.t}, {'c': pu.c + keep + if(r = 'a', 0, 1000000000), 'a': pu.a || 'K', 't': pu.t || kept},
                   {'c': pu.c + keep + 3, 'a': pu.a || 'R', 't': pu.t || chr(10) || 'assistant:' || text}])
  FROM (
    SELECT *, list_min([n, s, pa]) AS pb FROM (
      SELECT walk.conv_id, rows.i, n, s, rows.r, rows.text, chr(10) || rows.role || ':' || rows.text AS kept,
             CASE rows.fault WHEN 't' THEN 3 WHEN '' THEN 0 ELSE 1000000000 END AS keep,
             list_min([u, {'c': n.c + 3, 'a': n.a || 'I', 't': n.t || chr(10) || 'user:'}, {'c': s.c + 3, 'a': s.a || 'I', 't': s.t || chr(10) || 'user:'},
                       {'c': a.c + 3, 'a': a.a || 'I', 't': a.t || chr(10) || 'user:'}]) AS pu,
             list_min([a, {'c': u.c + 3, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'},
                       {'c': n.c + 6, 'a': n.a || 'II', 't': n.t || chr(10) || 'user:' || chr(10) || 'assistant:'},
                       {'c': s.c + 6, 'a': s.a || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS pa
      FROM walk JOIN rows ON walk.conv_id IS NOT DISTINCT FROM rows.conv_id AND rows.i = walk.i + 1))),
ends AS (
  SELECT conv_id, list_min([n, a, {'c': u.c + 3, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'},
                            {'c': s.c + 6, 'a': s.a || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS best
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
found AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN found ON every.conv_id IS NOT DISTINCT FROM found.conv_id
LEFT JOIN ends ON every.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
