"""Conversation structure repair over a suffix-shared automaton (operator 12).

A conversation's rows become a signature of one letter a row: the role's
initial and the row's fault.  What the rest of a conversation costs depends on
the rest of its signature and on where the role grammar stands, nothing else.
So the distinct signatures of all conversations are read from their ends: a
node is a distinct ending, and holds for each grammar state the cheapest cost to
go and the first edit of the best audit; the rest of that audit is a node's
that is there already.

Signatures are range-partitioned and sorted by their reversed letters, so those
that share an ending follow each other, and a task needs one path of the
automaton in memory.  An ending is worked out once; one that lies across a
border between tasks, once on either side.

Texts move once: signatures come from rows without their texts, and the edits
found meet the texts when a conversation is put together.  That is one string
by contract, so a conversation is the unit that has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stage

# --- fixed values: damage by remainder, and what edits cost ----------------------
DAMAGE_MODULUS = 20
DROP, EMPTY, UNPOINT, REPEAT, AS_USER = range(5)
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

#: Grammar states of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Role that a new or changed row has in each state, and the state it leads to.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: State that a kept row of an initial leads to; others are not legal.
KEPT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
FOREVER = float("inf")


class Node(NamedTuple):
    """An ending of signatures: cost to go and best first edit by state."""
    cost: tuple[float, ...]
    edit: tuple[str, ...]


def with_inserts(cost: list[float], edit: list[str]) -> Node:
    """Costs when rows may be inserted before what is left.  Of equally cheap
    edits the least letter wins, as it does in the whole audit."""
    cost = list(cost)
    for _ in range(2):  # two inserts lead from any state to any other that they can reach
        for s in range(4):
            cost[s] = min(cost[s], INSERT_COST + cost[NEXT_STATE[s]])
    return Node(tuple(cost), tuple(cost_edit(s, cost, edit) for s in range(4)))


def cost_edit(s: int, cost: list[float], edit: list[tuple[float, str]]) -> str:
    options = [*edit[s], (INSERT_COST + cost[NEXT_STATE[s]], "I")]
    return min((letter for c, letter in options if c == cost[s]), default="")


def ending() -> Node:
    """The empty ending: a conversation may stop at the start or after a."""
    options = [[(0.0, "")], [], [], [(0.0, "")]]
    return with_inserts([0.0, FOREVER, FOREVER, 0.0], options)


def before(letter: str, rest: Node) -> Node:
    """The ending that ``letter`` and ``rest`` make."""
    initial, fine = letter.lower(), 0 if letter.islower() else TRUNCATED_COST
    options: list[list[tuple[float, str]]] = []
    for s in range(4):
        edits = [(DELETE_COST + rest.cost[s], "D")]
        if initial != "x":
            edits.append((REROLE_COST + fine + rest.cost[NEXT_STATE[s]], "R"))
            if initial in KEPT[s]:
                edits.append((fine + rest.cost[KEPT[s][initial]], "K"))
        options.append(edits)
    return with_inserts([min(c for c, _ in o) for o in options], options)


class Endings:
    """The path of the automaton that the last signature read took, from the
    empty ending on.  Signatures that come sorted by their reversed letters
    make each ending once."""

    def __init__(self):
        self.letters: list[str] = []
        self.nodes = [ending()]
        self.made = 0

    def read(self, signature: str) -> None:
        backwards = signature[::-1]
        same = 0
        for a, b in zip(self.letters, backwards):
            if a != b:
                break
            same += 1
        del self.letters[same:], self.nodes[same + 1:]
        for letter in backwards[same:]:
            self.letters.append(letter)
            self.nodes.append(before(letter, self.nodes[-1]))
            self.made += 1

    def repair(self, signature: str) -> tuple[int, str, list[int | None], list[str | None]]:
        """Cost and audit of ``signature``, and of each repaired row the place
        of its row (None: inserted) and its new role (None: its own)."""
        self.read(signature)
        n, at, state = len(signature), 0, START
        audit, places, roles = [], [], []
        while edit := self.nodes[n - at].edit[state]:
            audit.append(edit)
            if edit in "IR":
                places.append(at if edit == "R" else None)
                roles.append(NEXT_ROLE[state])
                state = NEXT_STATE[state]
            elif edit == "K":
                places.append(at)
                roles.append(None)
                state = KEPT[state][signature[at].lower()]
            at += edit != "I"
        return int(self.nodes[n].cost[START]), "".join(audit), places, roles


def repairs(signatures: DataFrame) -> DataFrame:
    """Rows ``signature, cost, audit, places, roles``, one per distinct
    ``signature`` of letters s, u, a, o (any other role), capital if
    truncated, and x for a row that must go."""
    schema = "signature string, cost long, audit string, places array<int>, roles array<string>"

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            cost, audit, places, roles = zip(*map(endings.repair, texts))
            yield pa.record_batch([pa.array(texts), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(places, pa.list_(pa.int32())),
                                   pa.array(roles, pa.list_(pa.string()))], names=["signature", "cost", "audit", "places", "roles"])

    backwards = signatures.select("signature").distinct().withColumn("backwards", F.reverse("signature"))
    ordered = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return ordered.select("signature").mapInArrow(solve, schema)


def spaced(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``conv_id, turn, role, text, n`` of ``rows`` after damage by the
    checksum of ``conv_id:turn``: ``n`` is 0 for a dropped row, 2 for one to
    be repeated and else 1.  Nulls are one space in the checksum, the role and
    the text."""
    of = F.pmod(F.crc32(F.concat(spaced(F.col(conv_id)), F.lit(":"), spaced(F.col(turn))).cast("binary")), F.lit(DAMAGE_MODULUS))
    said = spaced(F.col(text))
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(of == AS_USER, "user").otherwise(spaced(F.col(role))).alias("role"),
        F.when(of == EMPTY, "").when(of == UNPOINT, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(of == DROP, 0).when(of == REPEAT, 2).otherwise(1).alias("n"))


def in_order(*more: Column) -> Column:
    """Sorted array of a conversation's rows, repeats included: by turn (nulls
    first), ties by role and by two hashes of the text."""
    row = F.struct("turn", "role", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), *more)
    return F.sort_array(F.flatten(F.collect_list(F.when(F.col("n") > 0, F.array_repeat(row, F.col("n"))))))


def row_letters(rows: Column) -> Column:
    """A letter for each of the ordered ``rows``: b (blank), d (seen earlier),
    or the role's initial, capital if truncated."""
    placed = F.transform(rows, lambda r, i: F.struct(r["role"].alias("role"), r["h1"].alias("h1"), r["h2"].alias("h2"), i.alias("i")))

    def flagged(alike):  # equal rows are neighbours, the earliest first
        def seen(r, k):
            last = F.get(alike, k - 1)
            return (r["role"] == last["role"]) & (r["h1"] == last["h1"]) & (r["h2"] == last["h2"])

        return F.array_sort(F.transform(alike, lambda r, k: F.struct(r["i"].alias("i"), F.coalesce(seen(r, k), F.lit(False)).alias("again"))))

    repeated = F.transform(F.array(F.array_sort(placed)), flagged)[0]

    def letter(r, again):
        own = F.when(r["initial"].isin("s", "u", "a"), r["initial"]).otherwise("o")
        return F.when(r["state"] == "b", "b").when(again["again"], "d").when(r["state"] == "t", F.upper(own)).otherwise(own)

    return F.array_join(F.zip_with(rows, repeated, letter), "")


def signatures(damaged: DataFrame) -> DataFrame:
    """Rows ``conv_id, gaps, blank, duplicate, truncated, illegal, signature``,
    one per conversation of :func:`damage`'s rows."""
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    narrow = damaged.withColumns({"initial": F.substring("role", 1, 1),
                                  "state": F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t").otherwise("f")})
    there = F.when(F.col("n") > 0, F.col("turn"))
    held = narrow.groupBy("conv_id").agg(
        in_order(F.col("initial"), F.col("state")).alias("rows"), F.min(there).alias("first"), F.max(there).alias("last"),
        F.size(F.collect_set(there)).alias("distinct"))
    told = held.withColumn("letters", row_letters(F.col("rows")))
    pairs = F.zip_with("rows", F.slice("rows", 2, F.size("rows")), lambda a, b: F.concat(a["initial"], b["initial"]))

    def count(letters):
        return F.length(F.regexp_replace("letters", f"[^{letters}]+", "")).cast("long")

    return told.select(
        "conv_id", F.coalesce((F.col("last") - F.col("first") + 1 - F.col("distinct")).cast("long"), F.lit(0).cast("long")).alias("gaps"),
        count("b").alias("blank"), count("d").alias("duplicate"), count("SUAO").alias("truncated"),
        F.size(F.filter(F.slice(pairs, 1, F.greatest(F.size("rows") - 1, F.lit(0))), lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal"),
        F.translate("letters", "bd", "xx").alias("signature"))


def repair_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired``, one per conversation of ``rows``: what damage and repair make
    of it; ``repaired`` is the rows ``role:text`` joined by newlines.

    A null role or text is one space and a null id a conversation of its own;
    rows of null turns come first.  Rows of one turn are ordered by role and by
    XXH64 of the text (seed 42; then that seeded by the hash of 1), and equal
    rows follow each other.  Repeated rows are damaged alike and count as rows.
    A conversation that loses all rows has zeros and an empty audit and text;
    an empty table gives an empty table; other columns are left out, so they
    cannot clash.  Long texts only move; one conversation has to fit a task."""
    damaged = damage(rows, conv_id, turn, role, text)
    told = stage(signatures(damaged), "conversation_signatures")
    solved = stage(repairs(told), "signature_repairs")
    edits = told.join(solved, "signature").withColumnRenamed("conv_id", "conv")
    texts = damaged.groupBy("conv_id").agg(in_order(F.col("text")).alias("rows"))

    def line(place, new_role):
        own = F.get("rows", place)
        return F.concat(F.coalesce(new_role, own["role"]), F.lit(":"), F.coalesce(own["text"], F.lit("")))

    both = texts.join(edits, texts["conv_id"].eqNullSafe(edits["conv"]))
    return both.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                       F.array_join(F.zip_with("places", "roles", line), "\n").alias("repaired"))
