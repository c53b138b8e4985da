"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tessera.llm import conversation_repair as C
from tessera.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def least_edits(rows):
    """Cheapest edits of ``(role, text, fault)`` rows, least audit first: the
    shortest path over (rows read, role initials so far by grammar)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    word = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        nxt = after[last]
        heapq.heappush(heap, (cost + 2, audit + "I", at, nxt, out + ((word[nxt], ""),)))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, nxt, out + ((word[nxt], text),)))
        if role[:1] == nxt or (role[:1] == "s" and last == ""):
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], out + ((role, text),)))


def plain(rows):
    def spaced(x):
        return " " if x is None else str(x)

    def signed(x, seed):
        h = xxhash.xxh64_intdigest(x.encode(), seed)
        return h - 2**64 if h >= 2**63 else h

    one = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    held = {}
    for conv, turn, role, text in rows:
        mine = held.setdefault(conv, [])
        of = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if of == 0:
            continue
        if of == 1:
            text = ""
        if of == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if of == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if of == 3 else 1)
    out = []
    for conv, mine in held.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), signed(r[2], 42), signed(r[2], one)))
        seen, faulty = set(), []
        for _, role, text in mine:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit, repaired = least_edits(faulty)
        turns = [t for t, *_ in mine if t is not None]
        n = lambda f: sum(x[2] == f for x in faulty)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(faulty))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n("blank"), n("duplicate"), n("truncated"), illegal,
                    cost, audit, "\n".join(f"{r}:{t}" for r, t in repaired)))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(8)
    said = ["", " ", "Yes.", "No!", "why?", "cut off", "end. \n", "É🙂.", "a:b\nc.", None, "...", "x." * 200]
    rows = []
    for conv in [*range(150), None]:
        rows += [(conv, t, rng.choice(["user", "assistant", "user", "assistant", "system", "usher", "Admin", "", None]), rng.choice(said))
                 for t in range(rng.randrange(1, 9)) if rng.random() < 0.9]
    rows += [(conv, rng.choice([None, 0, 0, 1, 5]), rng.choice(["user", "assistant"]), rng.choice(said)) for conv in range(200, 260) for _ in range(5)]
    rows += [(300, t, ["user", "assistant"][t % 2], f"Line {t % 40}.") for t in range(400)]
    rows += rows[:40]
    rows += [(400, None, None, None), (-7, 2**40, "user", "long " * 100_000 + ".")]
    return rows


def test_against_a_search_over_all_edits(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    df = df.withColumns({c: F.lit("mine") for c in ("gaps", "signature", "cost", "audit", "n", "rows", "initial", "state", "conv", "places", "h1")})
    got = sorted((tuple(r) for r in C.repair_conversations(df).collect()), key=repr)
    assert got == plain(rows)
    assert any(r[2] for r in got) and any(r[3] for r in got) and any(r[7] == "" for r in got) and any("I" in r[7] and "R" in r[7] for r in got)


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_the_query_on_given_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest()) for r in plain(rows)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_every_short_signature():
    endings = C.Endings()
    every = ["".join(x) for n in range(5) for x in itertools.product("xsuaoSUAO", repeat=n)]
    fault = lambda c: "blank" if c == "x" else "truncated" if c.isupper() else None
    for signature in sorted(every, key=lambda x: x[::-1]):
        cost, audit, places, roles = endings.repair(signature)
        want = least_edits([(c.lower(), str(i), fault(c)) for i, c in enumerate(signature)])
        made = [(r or signature[p].lower(), "" if p is None else str(p)) for p, r in zip(places, roles)]
        assert (cost, audit, made) == want
    assert endings.made == len(every) - 1  # sorted by their ends, each ending is made once


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_conversations(empty).collect() == []
