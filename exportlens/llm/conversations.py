"""Conversation repair: the cheapest edits that make turns alternate, by a dynamic program over shared edit prefixes."""

from __future__ import annotations

import hashlib
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from exportlens.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
RE_ROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5  # costs of edits, and of a truncated row that stays
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
TURN = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a new or renamed turn leads to
KEEPS = {(NONE, "s"): SYSTEM, **{(state, {USER: "u", ASSISTANT: "a"}[to]): to for state, to in TURN.items()}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
MODULUS = (1 << 61) - 1


class Prefixes:
    """Edit strings as a tree: a node is its parent's string and one letter more.

    A node knows its length, a rolling hash of its string, and its ancestors 1, 2, 4, … letters up.
    So a string costs one node however many others share its beginning, and two strings are compared
    by a search for their longest common prefix. Equal hashes only guide that search: the prefix found
    is verified letter by letter down to the node that both strings really share.
    """

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.hash, self.length, self.ups = [""], [0], [0], [()]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        ups = [parent]
        while len(self.ups[ups[-1]]) >= len(ups):
            ups.append(self.ups[ups[-1]][len(ups) - 1])
        self.letter.append(letter)
        self.hash.append((self.hash[parent] * 1_000_003 + ord(letter)) % self.modulus)
        self.length.append(self.length[parent] + 1)
        self.ups.append(tuple(ups))
        return node

    def _upto(self, node: int, length: int) -> int:
        """The ancestor of that many letters."""
        while self.length[node] > length:
            more = self.length[node] - length
            node = self.ups[node][more.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether a's string comes before b's in ASCII order; a proper prefix comes first."""
        shorter = self.length[a] < self.length[b]
        size = min(self.length[a], self.length[b])
        a, b = self._upto(a, size), self._upto(b, size)
        x, y, first = a, b, None
        if self.hash[a] != self.hash[b]:
            for k in reversed(range(size.bit_length())):
                if k < len(self.ups[x]) and self.hash[self.ups[x][k]] != self.hash[self.ups[y][k]]:
                    x, y = self.ups[x][k], self.ups[y][k]
            first = (self.letter[x], self.letter[y])
            x, y = self.ups[x][0], self.ups[y][0]
        while x != y:  # the prefix that the hashes call common
            if self.letter[x] != self.letter[y]:
                first = (self.letter[x], self.letter[y])
            x, y = self.ups[x][0], self.ups[y][0]
        return shorter if first is None else first[0] < first[1]

    def string(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.ups[node][0]
        return "".join(reversed(out))


def best_edits(rows, starts=(NONE,), modulus: int = MODULUS) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits of successive rows from each start state to each end state: cost and letters.

    ``rows`` are (initial of the role, must be deleted, is truncated). Equal costs go to the string that
    is least in ASCII order. Two strings for the same rows and states never are prefixes of each
    other, so what follows can't change their order and only the least is carried on.
    """
    out = {}
    for start in starts:
        tree = Prefixes(modulus)

        def offer(into, state, cost, parent, letter):
            known = into.get(state)
            if known is None or cost < known[0]:
                into[state] = (cost, tree.add(parent, letter))
            elif cost == known[0]:
                node = tree.add(parent, letter)
                if tree.less(node, known[1]):
                    into[state] = (cost, node)

        def inserted(live):
            # One turn, or a second after the first: a third comes back to a state that was reached for less.
            fresh = dict(live)
            for _ in range(2):
                more: dict = {}
                for state, (cost, node) in fresh.items():
                    offer(more, TURN[state], cost + INSERT, node, "I")
                fresh = {}
                for state, (cost, node) in more.items():
                    known = live.get(state)
                    if known is None or cost < known[0] or cost == known[0] and tree.less(node, known[1]):
                        live[state] = fresh[state] = (cost, node)
            return live

        live = inserted({start: (0, 0)})
        for initial, gone, truncated in rows:
            then: dict = {}
            more = CUT_OFF if truncated else 0
            for state, (cost, node) in live.items():
                offer(then, state, cost + DELETE, node, "D")
                if not gone:
                    if (state, initial) in KEEPS:
                        offer(then, KEEPS[state, initial], cost + more, node, "K")
                    offer(then, TURN[state], cost + more + RE_ROLE, node, "R")
            live = inserted(then)
        for state, (cost, node) in live.items():
            out[start, state] = (cost, tree.string(node))
    return out


def apply_edits(audit: str, rows):
    """(role, text) of each turn that the edits leave; ``rows`` is an iterator of (role, text)."""
    state = NONE
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = KEEPS[state, role[:1]]
        else:
            state = TURN[state]
            role = NAMES[state]
        yield role, text


def _digest(turns) -> str:
    h, first = hashlib.sha256(), True
    for role, text in turns:
        h.update((("" if first else "\n") + role + ":" + text).encode())
        first = False
    return h.hexdigest()


def _faults(group) -> list[tuple[str, str, bool, bool, str]]:
    """(role, text, must be deleted, is truncated, fault) of each row, copies spelled out."""
    out = []
    for _, role, text, copies, first in group:
        if not copies:
            continue
        bare = text.strip(BLANKS)
        for k in range(copies):
            fault = "blank" if not bare else "duplicate" if k or not first else "truncated" if bare[-1] not in ".!?" else ""
            out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated", fault))
    return out


FACTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
SLICE = ("conv_id {id}, part int, whole boolean, start int, `end` int, cost long, audit string, sha256 string, "
         "blank long, duplicate long, truncated long, illegal long, turns long, least string, most string, head string, tail string")


def _slices(conv, group, part: int, whole: bool, starts) -> list[tuple]:
    """Rows of SLICE for the rows of one conversation in one partition, in order."""
    rows = _faults(group)
    turns = [turn for turn, _, _, copies, _ in group if turn is not None and copies]
    initials = [role[:1] for role, *_ in rows]
    facts = [sum(fault == name for *_, fault in rows) for name in FACTS[:3]]
    facts += [sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), len(set(turns))]
    ends = [str(turns[0]), str(turns[-1])] if turns else [None, None]
    ends += [initials[0], initials[-1]] if rows else [None, None]
    found = best_edits([(role[:1], gone, cut) for role, _, gone, cut, _ in rows], starts)
    if whole:
        found = dict([min(((k, v) for k, v in found.items() if k[1] in ENDS), key=lambda x: x[1])])
    out = []
    for (start, end), (cost, audit) in found.items():
        sha = _digest(apply_edits(audit, ((role, text) for role, text, *_ in rows))) if start == NONE and end in ENDS else None
        out.append((conv, part, whole, start, end, cost, audit, sha, *facts, *ends))
    return out


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row of the slices of a conversation: their cheapest chain, and their facts together.

    A chain is a linked list of slices, so chains share what they have in common; equal costs are compared from the
    slice on in which two chains part.
    """
    pdf = pdf.sort_values(["part", "start", "end"])
    nodes: list[tuple[int, str]] = [(-1, "")]

    def tail(node, stop):
        out = []
        while node != stop:
            out.append(nodes[node][1])
            node = nodes[node][0]
        return "".join(reversed(out))

    def chain(node):
        out = []
        while node >= 0:
            out.append(node)
            node = nodes[node][0]
        return out

    live = {NONE: (0, 0)}
    parts = []
    for _, entries in pdf.groupby("part", sort=True):
        parts.append(entries.iloc[0])
        then: dict = {}
        for row in entries.itertuples(index=False):
            state, end, extra, audit = int(row.start), int(row.end), int(row.cost), row.audit
            if state not in live:
                continue
            cost, parent = live[state]
            nodes.append((parent, audit))
            new, known = (cost + extra, len(nodes) - 1), then.get(end)
            if known is not None and known[0] == new[0]:
                above = set(chain(known[1]))
                stop = next(n for n in chain(new[1]) if n in above)
                if tail(new[1], stop) < tail(known[1], stop):
                    then[end] = new
            elif known is None or new[0] < known[0]:
                then[end] = new
        live = then
    last = [live[s] for s in ENDS if s in live]
    cost, node = min(last, key=lambda x: (x[0], tail(x[1], 0)))
    facts = {name: sum(int(p[name]) for p in parts) for name in FACTS}
    with_rows = [p for p in parts if p["head"] is not None]
    facts["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(with_rows, with_rows[1:]))
    with_turns = [p for p in parts if p["least"] is not None]
    facts["turns"] -= sum(a["most"] == b["least"] for a, b in zip(with_turns, with_turns[1:]))
    sha = None
    if len(parts) == 1:
        audit = tail(node, 0)
        sha = next(r.sha256 for r in pdf.itertuples() if r.start == NONE and r.end in ENDS and r.audit == audit and r.cost == cost)
    return pd.DataFrame([{
        "conv_id": pdf["conv_id"].iloc[0], "cost": cost, "audit": tail(node, 0), "sha256": sha, **facts,
        "least": with_turns[0]["least"] if with_turns else None, "most": with_turns[-1]["most"] if with_turns else None}])


def ordered_rows(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies, first, sha): distinct rows, and whether the first of their role and text in the conversation.

    ``rows`` has conv_id, turn, role and text. The column ``copies`` names, where given, says how often a row is there;
    0 is a row that is gone and only names its conversation. Null roles and texts are read as one space.
    """
    copies = F.coalesce(F.col(copies), F.lit(1)) if copies else F.lit(1)
    there = copies > 0
    space = lambda c: F.when(there, F.coalesce(F.col(c), F.lit(" ")))
    rows = rows.select("conv_id", F.when(there, F.col("turn").cast("long")).alias("turn"), space("role").alias("role"), space("text").alias("text"), copies.cast("long").alias("copies"))
    rows = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")))
    rows = rows.withColumn("sha", F.unhex(F.sha2("text", 256)))
    # Where role and text come up once there is nothing to join, so the other side is small unless repeats abound.
    again = rows.where("copies > 0").groupBy("conv_id", "role", "sha").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("turn")).alias("at")).where("n > 1")
    again = again.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("sha").alias("_s"), F.col("at.turn").alias("_t"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("sha") == F.col("_s"))
    first = F.col("_s").isNull() | F.col("turn").eqNullSafe(F.col("_t"))
    return rows.join(again, same, "left").select("conv_id", "turn", "role", "text", "copies", first.alias("first"), "sha")


ORDER = ["conv_id", "turn", "role", "sha"]


def repair(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``rows``.

    Rows are taken by turn, nulls first; rows of one turn by role and by the SHA-256 of their text. Each row's first
    fault counts: blank, a repeat of role and text in its conversation, not ended by one of ``.!?``. The audit
    gives the cheapest edits in order, Delete, Insert, Keep and Rerole by their initials, after which the turns are
    an optional system turn and pairs of user and assistant; of equal costs the least string in ASCII order.
    gaps: turns missing between the least and the greatest. illegal: neighbours that are none of su, ua, au.

    Nulls: a null conv_id is a conversation of its own, null turns come first and leave no gaps, null roles and texts are one
    space. Empty texts are blank. Ties: equal rows are one row and repeats of it. A conversation without rows that are
    there (see :func:`ordered_rows`) has zeros, an empty audit and the digest of nothing. An empty table gives no rows. Other columns of
    ``rows`` are ignored, whatever their names.

    Rows are dealt by ranges of conversation and turn, so a conversation of any length is spread over
    tasks: a task solves whole conversations, and for the first and the last of its range the edits from each start to
    each end state, which a second step chains. Equal rows are counted before they are dealt. The digest of a conversation that
    crosses ranges is taken in one stream, as SHA-256 has to be; its text is not held.
    """
    rows = ordered_rows(rows, copies)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(SLICE.format(id=kind))
    names, arrow = [f.name for f in schema], to_arrow_schema(schema)

    def walk(batches):
        part = TaskContext.get().partitionId()
        conversations = groupby((row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])), key=lambda row: row[0])
        waiting, number, out = None, 0, []

        def close(last):
            conv, group = waiting
            inner = number > 1 and not last
            return _slices(conv, group, part, inner, (NONE,) if number > 1 else (NONE, SYSTEM, USER, ASSISTANT))

        for conv, group in conversations:
            if waiting is not None:
                out += close(False)
            waiting, number = (conv, [row[1:6] for row in group]), number + 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)
                out = []
        if waiting is not None:
            out += close(True)
        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)

    dealt = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    slices = stored(dealt.select("conv_id", "turn", "role", "text", "copies", "first").mapInArrow(walk, schema))

    done = ["conv_id", "cost", "audit", "sha256", *FACTS, "least", "most"]
    whole = slices.where("whole").select(*done)
    chained = slices.where("NOT whole").groupBy("conv_id").applyInPandas(_joined, T.StructType([schema[c] for c in done]))
    chained = stored(chained)
    apart = chained.where("sha256 IS NULL").drop("sha256").join(_digests(rows, chained.where("sha256 IS NULL"), kind).withColumnRenamed("conv_id", "_c"),
                                                                F.col("conv_id").eqNullSafe(F.col("_c")), "left").select(*done)
    found = whole.unionByName(chained.where("sha256 IS NOT NULL")).unionByName(apart)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.coalesce((wide("most") - wide("least") + 1 - F.col("turns")).try_cast("long"), F.lit(0))
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256"))


def _edited(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of the conversations that ``audits`` names, a row with the audit in front of each, by conversation and in order."""
    named = audits.select(F.col("conv_id").alias("_c"))
    rows = rows.join(named, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")
    rows = rows.where("copies > 0").select(F.lit(1).alias("head"), *ORDER, "text", "copies")
    heads = audits.select(F.lit(0).alias("head"), "conv_id", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "sha")],
                          F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "head", "turn", "role", "sha").select("head", "conv_id", "role", "text", "copies")


def _edited_groups(batches):
    """(conv_id, repaired turns as an iterator) of the rows of :func:`_edited`; rows are read as they are needed."""
    stream = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for conv, group in groupby(stream, key=lambda row: row[1]):
        audit = next(group)[3]
        yield conv, apply_edits(audit, ((role, text) for _, _, role, text, copies in group for _ in range(copies)))


def _digests(rows: DataFrame, audits: DataFrame, kind: str) -> DataFrame:
    """(conv_id, sha256) of the repaired conversations."""
    schema = T._parse_datatype_string(f"conv_id {kind}, sha256 string")
    target = to_arrow_schema(schema)

    def run(batches):
        for conv, turns in _edited_groups(batches):
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "sha256": _digest(turns)}], schema=target)

    return _edited(rows, audits).mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, repaired: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations, from rows and the result of :func:`repair`.

    Places count from 0. A conversation of which no turn is left has no rows. Rows are read as a stream.
    """
    rows = ordered_rows(rows, copies)
    schema = T._parse_datatype_string(f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, text string")
    target = to_arrow_schema(schema)

    def run(batches):
        for conv, turns in _edited_groups(batches):
            out = []
            for place, (role, text) in enumerate(turns):
                out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=target)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return _edited(rows, repaired.select("conv_id", "audit")).mapInArrow(run, schema)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with faults, each settled by the CRC-32 of conversation and turn modulo 20.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user; null fields are
    read as one space. A dropped row stays with 0 copies, so that its conversation is not forgotten.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(what == 1, F.lit("")).when(what == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return rows.select("conv_id", "turn", F.when(what == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"),
                       F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"))
