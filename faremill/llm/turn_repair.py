"""Repair of conversations whose turns got lost, doubled, cut or given to the wrong role.

The cheapest edits make a conversation's role initials fit ``(s?(ua)+)?``: Keep costs 0, Rerole to
user or assistant 1, Delete 2, Insert of an empty turn 5, and a truncated turn that stays 5 more.
Blank and repeated turns must go. Of equally cheap edits the sequence of initials (D, I, K, R) that
is least in ASCII wins.

A Viterbi pass over the four states of the pattern reads the turns in order. Its survivors are the
tips of a backpointer tree whose nodes count their children: a node without children goes, and as
soon as the root has one child left, all survivors share that edit and it is given out. So a task
holds the unresolved turns only, not the conversation. A survivor is given up when another one costs
less even after imitating whatever may follow it. Two sequences over the same turns never begin one
another (an Insert comes right before the turn that follows it), so ties are decided at their first
difference: survivors are kept in the order of their complete unresolved sequences, which is compared
first by the parents' order and then by the new edits. Steps are remembered by the survivors' states, relative costs and
order, of which the limits above leave few.

Spark finds turns seen before with a window that needs no memory of its own, and sorts each
conversation. A conversation is read by one task, as its edits depend on all turns before; the task
streams it, so its length is no matter of memory. Only where whole stretches allow no decision (for
example nothing but system turns) are their turns held until one falls.

Defined cases: null role or text counts as one space (so the turn is blank, or its role is of no
kind); turns without a number come first; turns of equal number are taken in the order of role, then
text; a null conversation id is a conversation; a conversation without turns, or an empty table,
gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from faremill.llm import common

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what was put out last
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
        (USER, "a"): ASSISTANT}
WANTED = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ENDS = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
NAMES = {"u": "user", "a": "assistant"}
# most that the first state pays more than the second, whatever follows
IMITATES = {(ASSISTANT, NOTHING): 2, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 5,
            (USER, ASSISTANT): 5, (USER, NOTHING): 7, (USER, SYSTEM): 5,
            (SYSTEM, USER): 5, (SYSTEM, ASSISTANT): 10, (SYSTEM, NOTHING): 12,
            (NOTHING, ASSISTANT): 0, (NOTHING, SYSTEM): 0, (NOTHING, USER): 5}
FORCED = "!"  # a turn that must go


@lru_cache(1 << 16)
def step(survivors: tuple, initial: str, cut: bool) -> tuple[int, tuple, tuple]:
    """One turn: (added cost, survivors, moves) from survivors (state, relative cost) in the order
    of their sequences. A move names the parent's place and the edits with their roles."""
    best: dict[int, tuple] = {}

    def offer(state, cost, rank, edits):
        found = (cost, rank, "".join(e for e, _ in edits), edits)
        if state not in best or found[:3] < best[state][:3]:
            best[state] = found

    for rank, (state, cost) in enumerate(survivors):
        offer(state, cost + DELETE, rank, (("D", None),))
        if initial == FORCED:
            continue
        stays = CUT if cut else 0
        first = WANTED[state]
        for before, at, paid in (((), state, cost),
                                 ((("I", NAMES[first]),), NEXT[state, first], cost + INSERT)):
            if (at, initial) in NEXT:
                offer(NEXT[at, initial], paid + KEEP + stays, rank, (*before, ("K", None)))
            role = WANTED[at]
            offer(NEXT[at, role], paid + REROLE + stays, rank, (*before, ("R", NAMES[role])))
    alive = [(rank, text, state, cost, edits) for state, (cost, rank, text, edits) in best.items()
             if not any(other != state and c + IMITATES[other, state] < cost
                        for other, (c, *_) in best.items())]
    alive.sort(key=lambda a: a[:2])
    least = min(a[3] for a in alive)
    return (least, tuple((state, cost - least) for _, _, state, cost, _ in alive),
            tuple((rank, edits) for rank, _, _, _, edits in alive))


class Node:
    """An edit of the backpointer tree; ``children`` are its references."""
    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent, edits):
        self.parent, self.edits, self.children = parent, edits, []
        if parent is not None:
            parent.children.append(self)


class Repair:
    """Edits of one conversation, given out as soon as no later turn can change them."""

    def __init__(self):
        self.root = Node(None, ())
        self.tips, self.survivors, self.cost = [self.root], ((NOTHING, 0),), 0

    def read(self, initial: str, cut: bool = False) -> list:
        """Takes one turn; returns the edits, turn by turn, that are settled now."""
        added, self.survivors, moves = step(self.survivors, initial, cut)
        self.cost += added
        old, self.tips = self.tips, [Node(self.tips[rank], edits) for rank, edits in moves]
        for node in old:
            while not node.children and node.parent is not None:
                node.parent.children.remove(node)
                node = node.parent
        settled = []
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            settled.append(self.root.edits)
        return settled

    def finish(self) -> tuple[list, tuple]:
        """The edits still open, turn by turn, and those after the last turn."""
        ends = [(cost + INSERT * len(ENDS[state]), place, ENDS[state])
                for place, (state, cost) in enumerate(self.survivors)]
        cost, place, end = min(ends)
        self.cost += cost
        path, node = [], self.tips[place]
        while node is not self.root:
            path.append(node.edits)
            node = node.parent
        roles = {"": (), "I": ("assistant",), "II": ("user", "assistant")}[end]
        return path[::-1], tuple(("I", role) for role in roles)


def ordered_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conversation, turn, role, text, fault), whole conversations to a task, in order."""
    space = F.lit(" ")
    rows = df.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), space).alias("role"),
                     F.coalesce(F.col(text).cast("string"), space).alias("text"))
    same = Window.partitionBy("conversation", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim("text", F.lit(BLANKS))
    return (rows.repartition("conversation")
            .withColumn("nth", F.row_number().over(same))
            .withColumn("fault", F.when(body == "", "blank").when(F.col("nth") > 1, "duplicate")
                        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated"))
            .sortWithinPartitions("conversation", F.col("turn").asc_nulls_first(), "role", "text",
                                  "nth")
            .select("conversation", "turn", "role", "text", "fault"))


def repaired(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per edit: (conversation, place, edit, fault, turn, found_role, role, text).

    ``place`` counts a conversation's edits from 0; role and text are those of the repaired turn
    and null for a deleted one; an inserted turn has no found_role. The edits of a conversation
    stand together in a task, in order."""
    types = [to_arrow_type(df.schema[c].dataType) for c in (conversation, turn)]
    fields = pa.schema([("conversation", types[0]), ("place", pa.int64()), ("edit", pa.string()),
                        ("fault", pa.string()), ("turn", types[1]), ("found_role", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])
    ddl = (f"conversation {df.schema[conversation].dataType.simpleString()}, place long, "
           f"edit string, fault string, turn {df.schema[turn].dataType.simpleString()}, "
           "found_role string, role string, text string")

    def run(batches):
        made: list[tuple] = []
        held = size = 0
        name, open_rows, repair, place = None, [], None, 0

        def settle(turns):
            nonlocal held, place, size
            for edits in turns:
                number, found, body, fault = open_rows[held]
                open_rows[held] = None
                held += 1
                for edit, new in edits:
                    if edit == "I":
                        made.append((name, place, edit, None, None, None, new, ""))
                    elif edit == "D":
                        made.append((name, place, edit, fault, number, found, None, None))
                    else:
                        made.append((name, place, edit, fault, number, found, new or found, body))
                        size += len(body)
                    place += 1
            if held > 1024 and 2 * held > len(open_rows):  # drop the settled turns
                del open_rows[:held]
                held = 0

        def close():
            nonlocal place
            path, end = repair.finish()
            settle(path)
            for edit, new in end:
                made.append((name, place, edit, None, None, None, new, ""))
                place += 1

        def batch_of():
            nonlocal made, size
            columns = list(zip(*made)) if made else [()] * len(fields)
            made, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

        for batch in batches:
            for who, number, found, body, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if repair is None or who != name:
                    if repair is not None:
                        close()
                    name, open_rows, held, repair, place = who, [], 0, Repair(), 0
                open_rows.append((number, found, body, fault))
                initial = FORCED if fault in ("blank", "duplicate") else found[:1]
                settle(repair.read(initial, fault == "truncated"))
                if len(made) >= common.BATCH_ROWS or size > 1 << 22:
                    yield batch_of()
        if repair is not None:
            close()
        yield batch_of()

    rows = ordered_turns(common.bounded_batches(df), conversation, turn, role, text)
    return rows.mapInArrow(run, ddl).withColumnRenamed("conversation", conversation)


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def reports(edits: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation from the result of ``repaired`` (its order is needed): what was
    found, cost and initials of the edits, digest of the repaired turns."""
    kind = to_arrow_type(edits.schema[conversation].dataType)
    ddl = f"{conversation} {edits.schema[conversation].dataType.simpleString()}, {REPORT}"
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    fields = pa.schema([(conversation, kind), *((c, pa.int64()) for c in columns),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    class Report:
        def __init__(self, name):
            self.name, self.counts = name, dict.fromkeys(columns, 0)
            self.audit, self.digest, self.lines = [], hashlib.sha256(), 0
            self.low = self.high = self.last = None
            self.turns, self.before = 0, None

        def add(self, edit, fault, turn, found, role, text):
            counts = self.counts
            counts["cost"] += COSTS[edit] + (CUT if fault == "truncated" and edit != "D" else 0)
            self.audit.append(edit)
            if len(self.audit) > 4096:
                self.audit = ["".join(self.audit)]
            if role is not None:
                self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
                self.lines += 1
            if found is None:
                return
            if fault is not None:
                counts[fault] += 1
            if turn is not None:  # turns come in order
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.high
                self.high = turn
            if self.before is not None and self.before + found[:1] not in ("su", "ua", "au"):
                counts["illegal"] += 1
            self.before = found[:1]

        def row(self):
            if self.low is not None:
                self.counts["gaps"] = self.high - self.low + 1 - self.turns
            return (self.name, *self.counts.values(), "".join(self.audit), self.digest.hexdigest())

    def run(batches):
        report = None
        for batch in batches:
            made = []
            for who, *edit in zip(*(c.to_pylist() for c in batch.columns)):
                if report is None or report.name != who:
                    if report is not None:
                        made.append(report.row())
                    report = Report(who)
                report.add(*edit)
            yield from emitted(made)
        yield from emitted([report.row()] if report is not None else [])

    def emitted(rows):
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return edits.select(conversation, "edit", "fault", "turn", "found_role", "role", "text"
                        ).mapInArrow(run, ddl)


def damaged(df: DataFrame) -> DataFrame:
    """The stated damage to (conv_id, turn, role, text)."""
    space = F.lit(" ")
    luck = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                               F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    return (df.select("conv_id", "turn", luck.alias("luck"), role.alias("role"), text.alias("text"))
            .filter("luck != 0")
            .select("conv_id", "turn",
                    F.when(F.col("luck") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("luck") == 1, "")
                    .when(F.col("luck") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("luck") == 3, 2).otherwise(1)))
                    .alias("copy"))
            .drop("copy"))


def query(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    found = reports(repaired(damaged(turns))).withColumnRenamed("conv_id", "id")
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


# CRC-32 as in the SQL of op2; a recursive step reads one turn of every conversation and keeps the
# best (cost, initials) of each state.
SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
lots AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS luck FROM named, crc_table),
broken AS (
  SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN luck = 1 THEN '' WHEN luck = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
      ELSE text END AS text
  FROM lots, unnest(range(CASE WHEN luck = 3 THEN 2 ELSE 1 END)) WHERE luck <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM broken),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i
  FROM seen),
faulty AS (
  SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS init,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS init_before,
    CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
-- state before, turn's initial (* any: the turn gets the role), edits, state after, cost, new turns
moves(st, init, edits, st2, cost, inserted, role) AS (VALUES
  (0, 's', 'K', 1, 0, '', NULL), (0, 'u', 'K', 2, 0, '', NULL), (1, 'u', 'K', 2, 0, '', NULL),
  (3, 'u', 'K', 2, 0, '', NULL), (2, 'a', 'K', 3, 0, '', NULL),
  (0, '*', 'R', 2, 1, '', 'user'), (1, '*', 'R', 2, 1, '', 'user'), (3, '*', 'R', 2, 1, '', 'user'),
  (2, '*', 'R', 3, 1, '', 'assistant'),
  (0, 'a', 'IK', 3, 5, 'user:', NULL), (1, 'a', 'IK', 3, 5, 'user:', NULL),
  (3, 'a', 'IK', 3, 5, 'user:', NULL), (2, 'u', 'IK', 2, 5, 'assistant:', NULL),
  (0, '*', 'IR', 3, 6, 'user:', 'assistant'), (1, '*', 'IR', 3, 6, 'user:', 'assistant'),
  (3, '*', 'IR', 3, 6, 'user:', 'assistant'), (2, '*', 'IR', 2, 6, 'assistant:', 'user')),
search(conv_id, i, st, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '', [] ::VARCHAR[] FROM faulty
  UNION ALL
  SELECT conv_id, i, st, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) AS best FROM (
      SELECT s.conv_id, f.i, m.st2 AS st,
        s.cost + m.cost + CASE WHEN fault = 'truncated' AND edits <> 'D' THEN 5 ELSE 0 END AS cost,
        s.audit || edits AS audit,
        CASE WHEN edits = 'D' THEN lines
          ELSE list_concat(CASE WHEN inserted = '' THEN lines ELSE list_append(lines, inserted) END,
                           [coalesce(m.role, f.role) || ':' || f.text]) END AS lines
      FROM search s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
      JOIN (FROM moves UNION ALL
            SELECT st, '*', 'D', st, 2, '', NULL FROM range(4) r(st)) m
        ON m.st = s.st AND (m.edits = 'D' OR (fault NOT IN ('blank', 'duplicate')
                                              AND m.init IN ('*', f.init)))))
  WHERE best = 1),
ended AS (
  SELECT conv_id, s.i, cost + 5 * length(e.edits) AS cost, audit || e.edits AS audit,
    list_concat(lines, e.added) AS lines
  FROM search s JOIN (VALUES (0, '', []::VARCHAR[]), (3, '', []), (2, 'I', ['assistant:']),
                             (1, 'II', ['user:', 'assistant:'])) e(st, edits, added) USING (st)),
chosen AS (
  SELECT * FROM ended JOIN (SELECT conv_id AS who, count(*) AS n FROM faulty GROUP BY 1)
    ON who IS NOT DISTINCT FROM conv_id AND n = i
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
found AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (init_before IS NOT NULL
                     AND init_before || init NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
