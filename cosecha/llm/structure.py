"""Conversation structure repair (operator 11): survivor-coalescence Viterbi.

The rows of a conversation, in order, are kept (K), given another role (R) or
deleted (D), and rows without text are inserted (I), at the least cost such that
the roles read: nothing, or an optional system row and then user and assistant
in turns, the assistant last. Of equally cheap repairs the one whose edits, as
a string of those letters, come first in ASCII wins.

One pass over a conversation holds four states (nothing yet, after system, after
user, after assistant), each with its cheapest path, its survivor. Paths are a
tree of backpointers; a node whose last path or child goes is freed (reference
counts). As soon as all survivors share an ancestor the edits up to it are
settled: they are emitted and leave the tree. Each path has the running hash of
its repaired rows, so no text waits for that. Equally cheap paths of a state are
compared by their whole unsettled suffixes. They consume the same rows, so neither
is the beginning of the other: the smaller one stays the smaller whatever
follows. A state that another one beats whatever follows is dropped, so that
survivors meet.

Spark deals the rows by conversation and sorts them (spilling to disk when a
conversation is large); a task reads them as a stream and holds the unsettled
edits only. What must see a whole conversation (its hash) streams through one
task, but no task gathers one: whether a text came before is found by a grouped
minimum and a join, so a hot text or conversation is no table in a worker.

Defined cases: nulls of any column count as one space, but a null turn comes
first and leaves no gap; a null ``conv_id`` is a conversation like any other; an
empty role has no initial and can't be kept; rows of one turn are ordered by
role and text, as damaged; repeated rows are duplicates; a conversation whose
rows are all dropped is returned with zeros; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cosecha.llm.common import prepare, store

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BODY = r"[^\x20\x09-\x0D]"
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> the state after a row whose role has this initial
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: state -> the state after a row that an edit gave its role
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}


class Node:
    """An edit at the end of a path. ``refs``: paths and edits that go on from
    it; ``jump``: an ancestor far above, for long ways up."""

    __slots__ = ("letter", "state", "up", "jump", "depth", "refs", "below")

    def __init__(self, letter: str, state: int, up: Node | None):
        self.letter, self.state, self.up, self.refs, self.below = letter, state, up, 0, []
        self.depth, self.jump = 0, self
        if up is not None:
            self.depth, far = up.depth + 1, up.jump
            even = up.depth - far.depth == far.depth - far.jump.depth
            self.jump = far.jump if even else up


def first_in_ascii(a: Node, b: Node) -> bool:
    """Whether path ``a`` comes before path ``b``. Two edits that follow the same
    path differ in their letter, so the whole suffixes are compared where the
    paths part, which ``jump`` finds without a walk over every edit."""
    longer = a.depth > b.depth
    for _ in range(2):  # lift the deeper one
        while a.depth > b.depth:
            a = a.jump if a.jump.depth >= b.depth else a.up
        a, b = b, a
    if a is b:
        return not longer
    while a.up is not b.up:
        if a.jump is not b.jump and a.jump.depth == b.jump.depth:
            a, b = a.jump, b.jump
        else:
            a, b = a.up, b.up
    return a.letter < b.letter


class Repair:
    """The cheapest repair of one conversation. ``emit(letter, role, text)`` gets
    every settled edit in order: the role of the repaired row (None: deleted) and
    its text (None, unless ``with_text``). A path carries the running hash of its
    repaired rows, so the texts themselves are let go at once."""

    def __init__(self, emit: Callable[[str, str | None, str | None], None], with_text: bool = False):
        self.emit, self.with_text = emit, with_text
        self.root = Node("", START, None)
        self.root.refs = 1
        self.paths: dict[int, tuple] = {START: (0, self.root, None)}  # state -> cost, node, hash
        self.rows: deque = deque()  # (role, text) of rows whose edit isn't settled

    # ------------------------------------------------------------ the tree

    def _grow(self, up: Node, letter: str, state: int) -> Node:
        node = Node(letter, state, up)
        up.refs += 1
        up.below.append(node)
        return node

    def _free(self, node: Node) -> None:
        """One path less through ``node``."""
        node.refs -= 1
        while not node.refs and node.up is not None:
            up = node.up
            up.below.remove(node)
            up.refs -= 1
            node = up

    @staticmethod
    def _better(a: tuple, b: tuple) -> bool:
        return a[0] < b[0] if a[0] != b[0] else first_in_ascii(a[1], b[1])

    def _replace(self, arrivals) -> None:
        """The best (cost, node, hash, line) of each state survives; the others
        and the old paths are freed."""
        best: dict[int, tuple] = {}
        for state, *path in arrivals:
            path[1].refs += 1
            old = best.get(state)
            if old is None or self._better(path, old):
                best[state] = path
                path = old
            if path is not None:
                self._free(path[1])
        before, self.paths = self.paths, {}
        for state, (cost, node, digest, line) in best.items():
            self.paths[state] = (cost, node, digest if line is None else _longer(digest, line))
        for path in before.values():
            self._free(path[1])

    # ------------------------------------------------------------ the steps

    def _insert(self) -> None:
        """A row may be inserted here. Two in a row bring a state back to where it
        was, or cost more than deleting the system row before them."""
        here = [(s, c, n, h, None) for s, (c, n, h) in self.paths.items()]
        more = [(NEXT[s], c + INSERT, self._grow(n, "I", NEXT[s]), h, f"{ROLE[NEXT[s]]}:") for s, c, n, h, _ in here]
        self._replace(here + more)

    def _drop_beaten(self) -> None:
        """After an assistant's row all goes on that goes on after a system row,
        and all that does from the start if the system row there is deleted."""
        done = self.paths.get(ASSISTANT)
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            path = self.paths.get(state)
            if done and path and (path[0] > done[0] + more or state == SYSTEM and not self._better(path, done)):
                del self.paths[state]
                self._free(path[1])

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self._insert()
        self.rows.append((role, text) if self.with_text else (role, None))
        arrivals = []
        for state, (cost, node, digest) in self.paths.items():
            arrivals.append((state, cost + DELETE, self._grow(node, "D", state), digest, None))
            if must_go:
                continue
            cost += TRUNCATED * truncated
            to = KEEP[state].get(role[:1])
            if to is not None:
                arrivals.append((to, cost, self._grow(node, "K", to), digest, f"{role}:{text}"))
            to = NEXT[state]
            arrivals.append((to, cost + REROLE, self._grow(node, "R", to), digest, f"{ROLE[to]}:{text}"))
        self._replace(arrivals)
        self._drop_beaten()
        self._settle()

    def _settle(self) -> None:
        """Emit the edits that all survivors share."""
        while self.root.refs == 1 and self.root.below:
            node = self.root.below[0]
            # what is above is reached by jumps only, a logarithmic number
            self.root.below, node.up = [], None
            self.root = node
            if node.letter == "I":
                self.emit("I", ROLE[node.state], "" if self.with_text else None)
                continue
            role, text = self.rows.popleft()
            self.emit(node.letter, None if node.letter == "D" else role if node.letter == "K" else ROLE[node.state], text)

    def finish(self) -> tuple[int, str]:
        """Emit the rest; the cost and the hash of the repaired rows."""
        self._insert()
        ends = [self.paths[s] for s in (START, ASSISTANT) if s in self.paths]
        best = ends[0]
        for path in ends[1:]:
            best = path if self._better(path, best) else best
        for path in self.paths.values():
            if path is not best:
                self._free(path[1])
        self._settle()
        return best[0], (best[2] or hashlib.sha256()).hexdigest()


def _longer(digest, line: str):
    """A running hash after one more line; ``digest`` stays as it is."""
    if digest is None:
        return hashlib.sha256(line.encode())
    digest = digest.copy()
    digest.update(("\n" + line).encode())
    return digest


def _space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows by crc32("conv_id:turn") % 20
    dropped (marked), emptied, robbed of their sentence ends, repeated or given
    the role user."""
    code = F.crc32(F.concat(_space("conv_id"), F.lit(":"), _space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _space("role").alias("role"), _space("text").alias("text"), code.alias("code"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
        .alias("text"), (F.col("code") == 0).alias("dropped"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")) \
        .drop("__copy")


def _faults(rows: DataFrame) -> DataFrame:
    """rows with blank, seen (role and text came in an earlier turn), truncated."""
    mark = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = store(rows.withColumn("mark", mark), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.where(~F.col("dropped")).groupBy(F.col("conv_id").alias("c"), F.col("mark").alias("m")).agg(
        F.min(place).alias("first"), F.count("*").alias("times")).where(F.col("times") > 1)
    same = rows["conv_id"].eqNullSafe(first["c"]) & (rows["mark"] == first["m"])
    seen = F.coalesce(place > F.col("first"), F.lit(False))
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return rows.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "dropped", (~F.col("text").rlike(BODY)).alias("blank"), seen.alias("seen"),
        (~whole).alias("truncated"))


def repair(conversations: DataFrame, with_rows: bool = False, dropped: Column | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256[, repaired: the rows as ``role:text``].
    ``conversations``: conv_id, turn, role, text; rows for which ``dropped`` holds
    only name their conversation."""
    prepare(conversations.sparkSession)
    rows = _faults(conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _space("role").alias("role"), _space("text").alias("text"),
        F.coalesce(dropped if dropped is not None else F.lit(False), F.lit(False)).alias("dropped")))
    conv = rows.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(it):
        key = fields = None

        def row():
            seen = {c: fields[c] for c in counts}
            if fields["low"] is not None:
                seen["gaps"] = fields["high"] - fields["low"] + 1 - fields["turns"]
            seen["cost"], digest = fields["repair"].finish()
            out = {"conv_id": key, **seen, "audit": "".join(fields["audit"]), "repaired_sha256": digest}
            return {**out, "repaired": fields["kept"]} if with_rows else out

        def begin():
            f = dict.fromkeys(counts, 0) | {"low": None, "high": None, "turns": 0, "last": None, "audit": [], "kept": []}

            def emit(letter, role, text):
                f["audit"].append(letter)
                if with_rows and role is not None:
                    f["kept"].append(f"{role}:{text}")

            f["repair"] = Repair(emit, with_rows)
            return f

        def take(turn, role, text, blank, seen, truncated):
            if turn is not None:
                if fields["low"] is None:
                    fields["low"] = turn
                fields["turns"] += fields["high"] != turn
                fields["high"] = turn
            last = fields["last"]
            duplicate = not blank and (seen or last == (turn, role, text))
            truncated = truncated and not blank and not duplicate
            fields["blank"] += blank
            fields["duplicate"] += duplicate
            fields["truncated"] += truncated
            if last is not None:
                fields["illegal"] += last[1][:1] + role[:1] not in ("su", "ua", "au")
            fields["last"] = (turn, role, text)
            fields["repair"].add(role, text, blank or duplicate, truncated)

        out = []
        for b in it:
            for conv_id, turn, role, text, dropped, *marks in zip(*(c.to_pylist() for c in b.columns)):
                if fields is None or conv_id != key:
                    if fields is not None:
                        out.append(row())
                    key, fields = conv_id, begin()
                if not dropped:
                    take(turn, role, text, *marks)
            if len(out) >= 1000:
                yield from tables(out)
                out = []
        if fields is not None:
            out.append(row())
        yield from tables(out)

    ddl = f"conv_id {conv.simpleString()}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string" + \
          (", repaired array<string>" if with_rows else "")
    types = [("conv_id", to_arrow_type(conv)), *[(c, pa.int64()) for c in counts], ("audit", pa.string()),
             ("repaired_sha256", pa.string())] + ([("repaired", pa.list_(pa.string()))] if with_rows else [])

    def tables(out):
        if out:
            yield from pa.Table.from_pylist(out, schema=pa.schema(types)).to_batches()

    # rows of one turn in the order of role and text, so equal rows are neighbours
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, ddl)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage, then repair every conversation."""
    prepare(conversations.sparkSession)
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return repair(damage(c), dropped=F.col("dropped"))


# crc32 has no SQL function: bit by bit over the bytes of the (ASCII) key
ORACLE = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
codes AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, len(key) + 1), lambda i: CAST(ascii(key[i]) AS UBIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
      lambda x, y: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1)))), CAST(4294967295 AS UBIGINT)) % 20 AS code FROM k),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM codes, range(CASE WHEN code = 3 THEN 2 ELSE 1 END) WHERE code <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
rows_ AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end FROM ordered),
faults AS (
  SELECT *, NOT blank AND nth > 1 AS duplicate, NOT blank AND nth = 1 AND open_end AS truncated,
    blank OR nth > 1 AS goes, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM rows_),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS size
  FROM faults GROUP BY conv_id),
-- a state's value: nine digits of cost, then its edits; least() picks the cheapest, then the first in ASCII
states AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000' AS z, '~' AS s, '000000003I' AS u, '~' AS a FROM counted
  UNION ALL
  SELECT conv_id, n, z, s,
    least(u, CASE WHEN least(z, s, a) = '~' THEN '~' ELSE least(
      CASE WHEN z = '~' THEN '~' ELSE printf('%09d', CAST(left(z, 9) AS BIGINT) + 3) || substr(z, 10) || 'I' END,
      CASE WHEN s = '~' THEN '~' ELSE printf('%09d', CAST(left(s, 9) AS BIGINT) + 3) || substr(s, 10) || 'I' END,
      CASE WHEN a = '~' THEN '~' ELSE printf('%09d', CAST(left(a, 9) AS BIGINT) + 3) || substr(a, 10) || 'I' END) END),
    least(a, CASE WHEN u = '~' THEN '~' ELSE printf('%09d', CAST(left(u, 9) AS BIGINT) + 3) || substr(u, 10) || 'I' END)
  FROM (
    SELECT conv_id, n, z || '' AS z,
      CASE WHEN zk = '~' THEN sd ELSE least(sd, zk) END AS s, least(ud, uk, ur) AS u, least(ad, ak, ar) AS a
    FROM (
      SELECT t.conv_id, f.n,
        printf('%09d', CAST(left(z, 9) AS BIGINT) + 4) || substr(z, 10) || 'D' AS z,
        CASE WHEN s = '~' THEN '~' ELSE printf('%09d', CAST(left(s, 9) AS BIGINT) + 4) || substr(s, 10) || 'D' END AS sd,
        CASE WHEN u = '~' THEN '~' ELSE printf('%09d', CAST(left(u, 9) AS BIGINT) + 4) || substr(u, 10) || 'D' END AS ud,
        CASE WHEN a = '~' THEN '~' ELSE printf('%09d', CAST(left(a, 9) AS BIGINT) + 4) || substr(a, 10) || 'D' END AS ad,
        CASE WHEN goes OR r <> 's' THEN '~' ELSE printf('%09d', CAST(left(z, 9) AS BIGINT) + 3 * truncated::INT) || substr(z, 10) || 'K' END AS zk,
        CASE WHEN goes OR r <> 'u' THEN '~' ELSE least(
          printf('%09d', CAST(left(z, 9) AS BIGINT) + 3 * truncated::INT) || substr(z, 10) || 'K',
          CASE WHEN s = '~' THEN '~' ELSE printf('%09d', CAST(left(s, 9) AS BIGINT) + 3 * truncated::INT) || substr(s, 10) || 'K' END,
          CASE WHEN a = '~' THEN '~' ELSE printf('%09d', CAST(left(a, 9) AS BIGINT) + 3 * truncated::INT) || substr(a, 10) || 'K' END) END AS uk,
        CASE WHEN goes THEN '~' ELSE least(
          printf('%09d', CAST(left(z, 9) AS BIGINT) + 3 + 3 * truncated::INT) || substr(z, 10) || 'R',
          CASE WHEN s = '~' THEN '~' ELSE printf('%09d', CAST(left(s, 9) AS BIGINT) + 3 + 3 * truncated::INT) || substr(s, 10) || 'R' END,
          CASE WHEN a = '~' THEN '~' ELSE printf('%09d', CAST(left(a, 9) AS BIGINT) + 3 + 3 * truncated::INT) || substr(a, 10) || 'R' END) END AS ur,
        CASE WHEN goes OR r <> 'a' OR u = '~' THEN '~' ELSE printf('%09d', CAST(left(u, 9) AS BIGINT) + 3 * truncated::INT) || substr(u, 10) || 'K' END AS ak,
        CASE WHEN goes OR u = '~' THEN '~' ELSE printf('%09d', CAST(left(u, 9) AS BIGINT) + 3 + 3 * truncated::INT) || substr(u, 10) || 'R' END AS ar
      FROM states t JOIN faults f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.n = t.n + 1))),
best AS (
  SELECT c.*, CAST(left(least(z, a), 9) AS BIGINT) AS cost, substr(least(z, a), 10) AS audit
  FROM counted c JOIN states t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND t.n = c.size),
edits AS (
  SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS i FROM best),
numbered AS (
  SELECT conv_id, i, audit[i] AS e, len(regexp_replace(audit[:i], 'I', '', 'g')) AS n,
    len(regexp_replace(audit[:i], 'D', '', 'g')) AS place FROM edits),
kept AS (
  SELECT e.conv_id, e.i, e.e, e.place, f.role, f.text,
    max(CASE WHEN place = 1 AND e = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system
  FROM numbered e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.n = e.n AND e.e <> 'I'
  WHERE e.e <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END ||
    ':' || coalesce(text, ''), chr(10) ORDER BY i) AS all_rows FROM kept GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(all_rows, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
