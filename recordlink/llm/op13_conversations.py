"""Conversation structure repair by a survivor-coalescence Viterbi.

A conversation's rows, taken by turn, are edited at least cost until the initials of their roles
read ``(s?(ua)+)?``: an optional system row, then user and assistant in turn. Keep costs 0, Rerole
(to user or assistant) 3, Delete 4, Insert (an empty user or assistant row, anywhere) 3; blank and
duplicate rows must go, a truncated row that stays costs 3 more. Of the cheapest edit strings
(initials K, R, D, I in order) the least by ASCII wins.

The pattern has four states: nothing yet, after system, after user, after assistant. In any state
an edit's outcome is fixed, so an edit string names one result. Per state one survivor is kept, the
head of a chain in a tree of back pointers whose nodes count what refers to them. A survivor that
another undercuts on every continuation is dropped, a node without references frees its ancestors,
and whenever all survivors share an ancestor the edits down to it are emitted and the rows behind
them forgotten: memory holds the unresolved part only, however long the conversation. Ties are
broken by the complete unresolved suffixes: survivors keep their order as strings, two new strings
of different survivors compare as those do, two of one survivor by the few letters added. (Inserts
are placed before the row that follows, so no survivor's string begins another's.)

Spark sorts the rows by conversation and turn and a task streams through its partition; one
conversation is one chain (its audit and its digest are sequential) and is never collected. Which
row is the first of its role and text is found beforehand by an aggregate over digests, so a task
keeps no table of texts either.

Edge cases: null role or text reads as one space (so a null text is blank), a null turn sorts
first; rows of one turn go by role, then by the SHA-256 of role and text, equal rows side by side;
a null conversation id is a conversation of its own; conversations whose rows are all gone give
zeros, an empty audit and the digest of the empty string; empty tables give no rows; other columns
are ignored. A row is a duplicate if an earlier row of the conversation has its role and text
(compared by SHA-256).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import tasks_of

BLANKS = " \t\n\x0b\x0c\r"

# Costs of the edits, and of keeping a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3


def damage(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` after the damage that crc32(``conv_id:turn``) modulo 20
    selects: 0 drops, 1 empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 sets role
    user. Nulls read as one space."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                                (F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn"))) % 20).alias("_h"))
    text = (F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return (rows.filter("_h <> 0")
            .select("conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("_h") == 3, 2).otherwise(1))).alias("_c"))
            .drop("_c"))


def _row_moves() -> dict:
    """Row class -> [(state, new state, cost, letters added)]: inserts before the row, then the row's
    edit. A class is (initial, truncated), or None for a row that must go."""
    wants = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}
    table: dict = {}
    for kind in [None, *((i, t) for i in ("s", "u", "a", "") for t in (False, True))]:
        best: dict = {}
        for start in range(4):
            state, cost, letters = start, 0, ""
            while True:
                options = [(state, DELETE, "D")]
                if kind is not None:
                    initial, cut = kind
                    more = TRUNCATED if cut else 0
                    options.append((after[wants[state]], REROLE + more, "R"))
                    if initial == wants[state] or (initial == "s" and state == 0):
                        options.append((after[initial], more, "K"))
                for new, price, letter in options:
                    way = (cost + price, letters + letter)
                    best[start, new] = min(best.get((start, new), way), way)
                if len(letters) == 2:       # a third insert returns to a state already seen
                    break
                state, cost, letters = after[wants[state]], cost + INSERT, letters + "I"
        table[kind] = [(a, b, *way) for (a, b), way in sorted(best.items())]
    return table


# What it costs at most to follow from state q the continuations of state p: (q, p) -> cost.
FOLLOW = {(3, 0): DELETE, (3, 1): 0, (3, 2): INSERT, (0, 1): 0, (0, 2): INSERT, (0, 3): 0, (1, 0): 2 * INSERT, (1, 2): INSERT,
          (1, 3): 2 * INSERT, (2, 3): INSERT, (2, 1): INSERT, (2, 0): INSERT + DELETE}


def repairer():
    """The class that repairs one conversation, row by row."""
    moves = _row_moves()
    names = {"u": "user", "a": "assistant"}
    wants = ("u", "u", "a", "u")
    states = {"s": 1, "u": 2, "a": 3}

    class Node:
        __slots__ = ("parent", "letters", "row", "times", "kids", "held")

        def __init__(self, parent, letters, row):
            self.parent, self.letters, self.row = parent, letters, row
            self.times, self.kids, self.held = 1, [], 0

    class Repair:
        """``row()`` for each row in order, then ``finish()``; both return the edits that became
        certain as (letter, role, text, row). ``cost`` and ``unresolved`` may be read."""

        def __init__(self):
            self.root = Node(None, "", None)        # everything up to here is emitted
            self.root.held = 1
            self.survivors = {0: (0, 0, self.root)}     # state -> (cost, order as a string, node)
            self.state, self.cost, self.unresolved = 0, 0, 0

        def row(self, role: str, text: str, gone: bool, truncated: bool, tag=None) -> list:
            initial = role[:1]
            kind = None if gone else (initial if initial in ("s", "u", "a") else "", truncated)
            old = self.survivors
            best: dict = {}
            for start, new, price, letters in moves[kind]:
                s = old.get(start)
                if s is not None:
                    way = (s[0] + price, s[1], letters, start)
                    if new not in best or way < best[new]:
                        best[new] = way
            kept = {p: w for p, w in best.items()
                    if not any(v[0] + FOLLOW[q, p] < w[0] for q, v in best.items() if q != p)}
            order = {p: i for i, (_, p) in enumerate(sorted(((w[1], w[2]), p) for p, w in kept.items()))}
            uses: dict = {}
            for w in kept.values():
                uses[w[3]] = uses.get(w[3], 0) + 1
            payload = None if gone else (role, text, tag)
            heads = {}
            for p, (cost, _, letters, start) in kept.items():
                node = old[start][2]
                if letters == "D" and uses[start] == 1 and node.letters == "D" and node.row is None and tag is None:
                    node.times += 1             # a run of deletions is one node
                else:
                    node, parent = Node(node, letters, payload if letters[-1] != "D" else (None, None, tag) if tag is not None else None), node
                    parent.kids.append(node)
                    self.unresolved += 1
                heads[p] = (cost, order[p], node)
            for _, _, node in heads.values():
                node.held += 1
            for _, _, node in old.values():
                self._release(node)
            self.survivors = heads
            return self._settle()

        def _release(self, node):
            node.held -= 1
            while node is not self.root and not node.held and not node.kids:
                node.parent.kids.remove(node)
                self.unresolved -= 1
                node = node.parent
            # a run of deletions whose side branches are gone is one node again
            kid = node.kids[0] if len(node.kids) == 1 and not node.held and node is not self.root else None
            if kid is not None and kid.letters == node.letters == "D" and kid.row is None and node.row is None:
                kid.times += node.times
                kid.parent = node.parent
                node.parent.kids[node.parent.kids.index(node)] = kid
                self.unresolved -= 1

        def _settle(self) -> list:
            out = []
            while not self.root.held and len(self.root.kids) == 1:
                node = self.root.kids[0]
                out += self._emit(node)
                if node.held:               # still a head: its letters are out, only a mark stays
                    node.letters, node.row, node.times = "", None, 1
                node.parent = None
                self.root = node
                self.unresolved -= 1
            return out

        def _emit(self, node) -> list:
            out = []
            for _ in range(node.times):
                for letter in node.letters:
                    if letter == "D":
                        out.append(("D", None, None, node.row[2] if node.row else None))
                        continue
                    name = wants[self.state]
                    if letter == "I":
                        out.append(("I", names[name], "", None))
                    else:
                        role, text, tag = node.row
                        if letter == "K":
                            name = role[0]
                        out.append((letter, role if letter == "K" else names[name], text, tag))
                    self.state = states[name]
            return out

        def finish(self) -> list:
            """The last edits: a pair must be closed."""
            ends = []
            for p, (cost, rank, node) in self.survivors.items():
                letters = {0: "", 1: "II", 2: "I", 3: ""}[p]
                ends.append(((cost + INSERT * len(letters), rank, letters), node))
            (self.cost, _, letters), last = min(ends, key=lambda e: e[0])
            path, node = [], last
            while node is not self.root:
                path.append(node)
                node = node.parent
            out = [e for n in reversed(path) for e in self._emit(n)]
            return out + self._emit(Node(None, letters, None))

    return Repair


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
EDITS = "seq long, edit string, turn long, role string, text string"


def _ordered(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows by conversation and turn in each partition. ``_kind`` 0 announces a conversation, 1 says
    that the row after it is the first of its role and text, 2 is a row."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    data = (rows.select(F.col("conv_id").alias("_conv"), F.col("turn").cast("long").alias("_turn"), role.alias("_role"), text.alias("_text"))
            .withColumn("_digest", F.unhex(F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256))))
    # turns as (is set, turn): the minimum takes a null turn first
    first = (data.groupBy("_conv", "_digest").agg(F.min(F.struct(F.col("_turn").isNotNull().alias("s"), F.col("_turn").alias("t"))).alias("f"),
                                                  F.min("_role").alias("_role"))
             .select("_conv", F.col("f.t").alias("_turn"), "_role", F.lit(None).cast("string").alias("_text"), "_digest", F.lit(1).alias("_kind")))
    none = F.lit(None)
    known = rows.select("conv_id") if ids is None else ids.select("conv_id")
    opening = (known.distinct().select(F.col("conv_id").alias("_conv"), none.cast("long").alias("_turn"), none.cast("string").alias("_role"),
                                       none.cast("string").alias("_text"), none.cast("binary").alias("_digest"), F.lit(0).alias("_kind")))
    return (data.withColumn("_kind", F.lit(2)).unionByName(first).unionByName(opening)
            .withColumn("_open", F.col("_kind") != 0)
            .repartition(tasks_of(rows.sparkSession), "_conv")
            .sortWithinPartitions("_conv", "_open", F.col("_turn").asc_nulls_first(), "_role", "_digest", "_kind")
            .select("_conv", "_turn", "_role", "_text", "_digest", "_kind"))


def _stream(edits: bool):
    """Arrow function over sorted rows: one report per conversation, or one row per edit."""
    def run(batches):
        import hashlib

        import pyarrow as pa
        Repair = repairer()
        schema, out, held = None, [], 0
        ended, conv, at = True, None, None

        def flush():
            nonlocal out, held
            cols = list(zip(*out)) if out else [[] for _ in schema]
            b = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)
            out, held = [], 0
            return b

        def take(edits_now):
            nonlocal held
            for letter, role, text, tag in edits_now:
                at["audit"].append(letter)
                if edits:
                    out.append((conv, at["seq"], letter, tag[0] if tag else None, role, text))
                    held += 64 + len(text or "")
                at["seq"] += 1
                if letter != "D":
                    at["sha"].update((("\n" if at["some"] else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    at["some"] = True

        def end():
            nonlocal held
            take(at["repair"].finish())
            gaps = 0 if at["low"] is None else at["high"] - at["low"] + 1 - at["turns"]
            if not edits:
                audit = "".join(at["audit"])
                out.append((conv, gaps, *at["faults"], at["illegal"], at["repair"].cost, audit, at["sha"].hexdigest()))
                held += 128 + len(audit)

        for b in batches:
            if schema is None:
                kinds = ([("seq", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
                         if edits else [*((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
                schema = pa.schema([("conv_id", b.schema.field(0).type), *kinds])
            # slices bound what is held as Python objects
            for lo in range(0, b.num_rows, 1024):
                for c, turn, role, text, digest, kind in zip(*(col.to_pylist() for col in b.slice(lo, 1024).columns)):
                    if kind == 0:
                        if not ended:
                            end()
                        conv, ended = c, False
                        at = {"repair": Repair(), "audit": [], "seq": 0, "sha": hashlib.sha256(), "some": False, "low": None, "high": None,
                              "turns": 0, "faults": [0, 0, 0], "illegal": 0, "before": None, "first": None}
                        continue
                    if kind == 1:
                        at["first"] = digest
                        continue
                    if turn is not None:
                        if at["low"] is None:
                            at["low"] = turn
                        if turn != at["high"]:
                            at["turns"] += 1
                        at["high"] = turn
                    bare = text.rstrip(BLANKS)
                    fresh = at["first"] == digest
                    at["first"] = None
                    fault = 0 if not bare else 1 if not fresh else 2 if bare[-1] not in ".!?" else None
                    if fault is not None:
                        at["faults"][fault] += 1
                    if at["before"] is not None and at["before"] + role[:1] not in ("su", "ua", "au"):
                        at["illegal"] += 1
                    at["before"] = role[:1]
                    take(at["repair"].row(role, text, fault in (0, 1), fault == 2, (turn,) if edits else None))
                    if held > 4_000_000:
                        yield flush()
                if held > 4_000_000 or len(out) > 10_000:
                    yield flush()
        if not ended:
            end()
        if out:
            yield flush()

    return run


def _schema(rows: DataFrame, rest: str) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {rest}"


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``ids`` (default: of ``rows``): faults, least cost, audit string
    and the digest of the repaired conversation."""
    return _ordered(rows, ids).mapInArrow(_stream(False), _schema(rows, REPORT))


def repair_edits(rows: DataFrame) -> DataFrame:
    """The edits themselves, in order: ``conv_id, seq, edit, turn, role, text``. Rows whose edit is
    not D are the repaired conversation; a deleted row has no role and text here."""
    return _ordered(rows, None).mapInArrow(_stream(True), _schema(rows, EDITS))
