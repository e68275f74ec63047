"""Conversation structure repair: a generalised LR parser of roles with weighted edits.

The role initials of a repaired conversation follow ``(s?(ua)+)?``, as a grammar

    talk -> open | nothing      open -> lead pair | open pair
    lead -> s | nothing         pair -> u a

Each turn can be kept, given another role, or deleted, and empty turns can be inserted
anywhere; a parser that may do all of this at once has many stacks.  They are one
graph: stacks share their lower nodes (``Node.push``), and after each turn the heads whose
stack tops are equal are merged into the one with the smallest (cost, audit).  Equal tops
take the same continuations in this grammar, so no cheapest repair is lost, and there
are never more than four heads, however long the conversation.

Audits (the edits' initials D, I, K, R in order) are compared without building them.
An audit is cut into segments, one a turn: the insertions before it, then what is done to
it.  No segment is the beginning of another, so audits with equal numbers of segments
compare as their first different segments do, and a head needs only the rank of its
audit among the heads and its last segment.

What a head has repaired so far is held as a running hash, not as text.  The rows of a
conversation go past one task in order, and the task holds one conversation's audit, no
texts: the hash of a conversation is sequential by its definition.  ``repaired`` builds the
repaired turns from the audits by joins on (conversation, place), which deal a long
conversation out over tasks.

Order: by turn, nulls first; rows of one turn by role, then text.  Faults, of which a
row has the first that holds: ``blank`` (nothing but white space), ``duplicate`` (role and
text seen earlier in the conversation), ``truncated`` (the last character that is not
white space is none of ``.!?``).  Blank and duplicate rows must be deleted.

Defined results: a null role or text is one space, so a null text is blank and a null role
has to be changed; an empty role has no initial; a null turn sorts first and does not count
in gaps; a null conv_id is a conversation like any other; repeated rows are duplicates;
conversations without a row left have zeros, an empty audit and the hash of nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

_SPACE = " \t\n\x0b\x0c\r"


class Node:
    """A node of the stack graph: an LR state and the node below."""

    __slots__ = ("above", "below", "state")

    def __init__(self, state: str, below: Node | None = None):
        self.state, self.below, self.above = state, below, {}

    def push(self, state: str) -> Node:
        """The node of ``state`` on this one; the same node for every stack that gets there."""
        if state not in self.above:
            self.above[state] = Node(state, self)
        return self.above[state]

    def shift(self, symbol: str) -> Node | None:
        """The stack after ``symbol`` and all reductions, or None where it does not fit."""
        if symbol == "s":
            return self.push("lead") if self.state == "start" else None  # lead -> s
        if symbol == "u" and self.state != "user":
            under = self.push("lead") if self.state == "start" else self  # lead -> nothing
            return under.push("user")
        if symbol == "a" and self.state == "user":
            return self.below.below.push("open")  # pair -> u a, then open -> lead pair | open pair
        return None


#: States behind which a conversation may end.
ACCEPTED = {"start", "open"}


class Repair:
    """The repair of one conversation, a turn at a time."""

    def __init__(self):
        # A head: cost, rank of its audit, stack, audit as linked segments, hash of what is repaired so far.
        self.heads = [(0, 0, Node("start"), None, hashlib.sha256())]
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._last = self._first_turn = self._last_turn = None
        self._turns = 0

    def _inserted(self) -> list[tuple]:
        """The heads after any insertions, merged by stack top: cost, rank, segment, stack, head, inserted symbols."""
        found: dict[str, tuple] = {}
        queue = [(cost, rank, "", k, node, head, "") for k, head in enumerate(self.heads)
                 for cost, rank, node, *_ in (head,)]
        heapq.heapify(queue)
        while queue:
            cost, rank, segment, k, node, head, symbols = heapq.heappop(queue)
            if node.state in found:
                continue
            found[node.state] = (cost, rank, segment, node, head, symbols)
            for symbol in ROLES:
                after = node.shift(symbol)
                if after is not None and after.state not in found:
                    heapq.heappush(queue, (cost + INSERT, rank, segment + "I", k, after, head, symbols + symbol))
        return list(found.values())

    def turn(self, turn, role: str, text: str, duplicate: bool) -> None:
        """Take the next row."""
        shown = text.rstrip(_SPACE)
        fault = "blank" if not shown else "duplicate" if duplicate else "truncated" if shown[-1] not in ".!?" else ""
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        initial = role[:1]
        if self._last is not None and self._last + initial not in LEGAL:
            self.illegal += 1
        self._last = initial
        if turn is not None and turn != self._last_turn:
            self._turns += 1
            self._first_turn = turn if self._first_turn is None else self._first_turn
            self._last_turn = turn
            self.gaps = turn - self._first_turn + 1 - self._turns

        best: dict[str, tuple] = {}

        def offer(cost, rank, segment, node, head, symbols, edit):
            held = best.get(node.state)
            if held is None or (cost, rank, segment) < held[:3]:
                best[node.state] = (cost, rank, segment, node, head, symbols, edit)

        undone = TRUNCATED if fault == "truncated" else 0
        for cost, rank, segment, node, head, symbols in self._inserted():
            offer(cost + DELETE, rank, segment + "D", node, head, symbols, "D")
            if fault in ("blank", "duplicate"):
                continue
            kept = node.shift(initial)
            if kept is not None:
                offer(cost + undone, rank, segment + "K", kept, head, symbols, "K")
            for symbol in ROLES:
                after = node.shift(symbol)
                if after is not None:
                    offer(cost + REROLE + undone, rank, segment + "R", after, head, symbols, symbol)
        self._drop_hopeless(best)
        ranks = {pair: k for k, pair in enumerate(sorted({b[1:3] for b in best.values()}))}
        self.heads = [(cost, ranks[rank, segment], node, (head[3], segment),
                       self._written(head, symbols, edit, role, text))
                      for cost, rank, segment, node, head, symbols, edit in best.values()]

    @staticmethod
    def _drop_hopeless(best: dict[str, tuple]) -> None:
        """Drop heads that another beats whatever follows, so that few are left."""
        at = lambda state: best[state][0] if state in best else float("inf")
        # What follows a lead may follow the start and an open as well.
        if at("lead") > min(at("start"), at("open")):
            best.pop("lead", None)
        # What follows the start may follow an open, for one more deletion at most (of a system turn).
        if at("start") > at("open") + DELETE:
            best.pop("start", None)

    @staticmethod
    def _written(head: tuple, symbols: str, edit: str, role: str, text: str):
        """The hash of ``head`` after the inserted turns and the kept one."""
        lines = [f"{ROLES[s]}:" for s in symbols]
        if edit != "D":
            lines.append(f"{role if edit == 'K' else ROLES[edit]}:{text}")
        if not lines:
            return head[4]
        out = head[4].copy()
        out.update(("" if head[2].state == "start" else "\n").encode() + "\n".join(lines).encode())
        return out

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        cost, _, segment, _, head, symbols = min((x for x in self._inserted() if x[3].state in ACCEPTED),
                                                 key=lambda x: x[:3])
        audit, trail = [segment], head[3]
        while trail is not None:
            trail, segment = trail
            audit.append(segment)
        return (self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                "".join(reversed(audit)), self._written(head, symbols, "D", "", "").hexdigest())


def filled(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``rows``, nulls of role and text as one space."""
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    bounded_batches(rows.sparkSession)
    held = filled(rows).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    ordered = (held.withColumn("duplicate", F.row_number().over(seen) > 1)
               .sortWithinPartitions(F.asc_nulls_first("conv_id"), *_order()))
    kind = rows.schema["conv_id"].dataType
    schema = (f"conv_id {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, "
              "cost long, audit string, repaired_sha256 string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, repair, out = None, None, []

        def flush(ids_type):
            columns = list(zip(*out))
            arrays = [pa.array(columns[0], ids_type), *(pa.array(c, pa.int64()) for c in columns[1:7]),
                      *(pa.array(c, pa.string()) for c in columns[7:])]
            out.clear()
            return pa.record_batch(arrays, names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                                                  "cost", "audit", "repaired_sha256"])

        ids_type = None
        for batch in batches:
            ids_type = batch.schema.field(0).type
            for conv, turn, role, text, duplicate in zip(*(c.to_pylist() for c in batch.columns)):
                if repair is None or conv != current:
                    if repair is not None:
                        out.append((current, *repair.result()))
                    current, repair = conv, Repair()
                repair.turn(turn, role, text, duplicate)
            if out:
                yield flush(ids_type)
        if repair is not None:
            out.append((current, *repair.result()))
            yield flush(ids_type)

    return ordered.mapInArrow(run, schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (K, R or I), role, text.

    ``found`` is what ``repairs`` gave for ``rows``.  Role and text of a turn come from the
    row with its place in the conversation; changed and inserted roles alternate behind
    the system turn, if one is kept."""
    in_order = Window.partitionBy("conv_id").orderBy(*_order())
    numbered = filled(rows).withColumn("row", (F.row_number().over(in_order) - 1).cast("int"))
    edits = (found.select(F.col("conv_id").alias("conv"), F.explode(F.transform(
                 F.split("audit", "(?<=[DKR])(?=.)"), lambda s, k: F.struct(s.alias("s"), k.alias("k")))).alias("e"))
             .select("conv", F.col("e.k").alias("k"), F.posexplode(F.split("e.s", "")).alias("i", "edit"))
             .where("edit <> ''"))
    joined = (edits.join(numbered, edits.conv.eqNullSafe(numbered.conv_id) & (F.col("k") == F.col("row")), "left")
              .where("edit <> 'D'"))
    line = Window.partitionBy("conv").orderBy("k", "i")
    placed = joined.withColumns({
        "place": F.row_number().over(line) - 1,
        "led": F.first(F.when((F.col("edit") == "K"), F.substring("role", 1, 1) == "s").otherwise(F.lit(False))).over(line)})
    turn = F.when((F.col("place") - F.col("led").cast("int")) % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return placed.select(F.col("conv").alias("conv_id"), "place", "edit",
                         F.when(F.col("edit") == "K", F.col("role")).otherwise(turn).alias("role"),
                         F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with the faults that the query repairs, chosen by crc32(conv_id:turn) mod 20."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    drawn = filled(rows).withColumn("draw", draw.cast("int")).where("draw <> 0")
    return drawn.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1)))).drop("col")


def digest(conversations: DataFrame) -> DataFrame:
    """The query over ``conversations``: the repair of each after damage."""
    found = repairs(damaged(conversations)).withColumnRenamed("conv_id", "conv")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every.conv_id.eqNullSafe(found.conv), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


ORACLE_SQL = r"""
WITH RECURSIVE
filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                                        list_transform(string_split(k, ''), lambda z: CAST(ord(z) AS BIGINT))),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
                  CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)),
              CAST(4294967295 AS BIGINT)) % 20 AS d
  FROM filled),
hurt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE d <> 0),
placed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM hurt),
faulty AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair
  FROM placed),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
fits(state, symbol, next) AS (
  VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
inserts(state, next, edits, lines) AS (
  VALUES ('', '', '', ''), ('s', 's', '', ''), ('u', 'u', '', ''), ('a', 'a', '', ''),
         ('', 'u', 'I', chr(10) || 'user:'), ('s', 'u', 'I', chr(10) || 'user:'),
         ('a', 'u', 'I', chr(10) || 'user:'), ('u', 'a', 'I', chr(10) || 'assistant:'),
         ('', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
         ('s', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, '' AS state,
         {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS b
  FROM stats
  UNION ALL
  SELECT conv_id, pos, state, min(b) AS b
  FROM (
    SELECT f.conv_id, f.pos, e.next AS state,
           {'cost': p.b.cost + 3 * length(i.edits) + e.cost + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
            'audit': p.b.audit || i.edits || e.edit, 'lines': p.b.lines || i.lines || e.line} AS b
    FROM best p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
    JOIN inserts i ON i.state = p.state
    CROSS JOIN LATERAL (
      SELECT i.next AS next, 'D' AS edit, CAST(4 AS BIGINT) AS cost, '' AS line
      UNION ALL
      SELECT t.next, 'K', CAST(0 AS BIGINT), chr(10) || f.role || ':' || f.text FROM fits t
      WHERE t.state = i.next AND t.symbol = f.i AND f.fault NOT IN ('blank', 'duplicate')
      UNION ALL
      SELECT t.next, 'R', CAST(3 AS BIGINT), chr(10) || CASE t.symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text
      FROM fits t WHERE t.state = i.next AND t.symbol <> 's' AND f.fault NOT IN ('blank', 'duplicate')) e)
  GROUP BY conv_id, pos, state),
final AS (
  SELECT s.conv_id, min({'cost': p.b.cost + 3 * length(i.edits), 'audit': p.b.audit || i.edits,
                         'lines': p.b.lines || i.lines}) AS b
  FROM stats s JOIN best p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.pos = s.n
  JOIN inserts i ON i.state = p.state AND i.next IN ('', 'a') GROUP BY s.conv_id)
SELECT c.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(f.b.cost, 0) AS BIGINT) AS cost,
       coalesce(f.b.audit, '') AS audit, sha256(substr(coalesce(f.b.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
"""
