"""Repairs held against enumeration of edit strings, and the registered query against a plain table."""
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recordlink.llm.op13_conversations import damage, repair_edits, repair_report, repairer

SF = "/root/testdata/sf0.01"
PATTERN = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def _faults(rows):
    """First fault of each (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        marks = BLANK.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _enumerate(rows):
    """Cheapest, then least edit string by trying all of them."""
    faults, best = _faults(rows), None
    inserts = [c for n in range(3) for c in itertools.product("ua", repeat=n)]
    options = [[("D", 4, None)] if f in ("blank", "duplicate") else
               [("D", 4, None), ("K", 3 * (f == "truncated"), (role, text)), ("R", 3 + 3 * (f == "truncated"), ("user", text)),
                ("R", 3 + 3 * (f == "truncated"), ("assistant", text))] for (role, text), f in zip(rows, faults)]
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*options):
        for ins in itertools.product(inserts, repeat=len(rows) + 1):
            cost = 3 * sum(map(len, ins)) + sum(e[1] for e in edits)
            if best is not None and cost > best[0]:
                continue
            audit, kept = "", []
            for i, e in zip(ins, [*edits, None]):
                audit += "I" * len(i)
                kept += [(names[x], "") for x in i]
                if e:
                    audit += e[0]
                    kept += [e[2]] if e[2] else []
            if PATTERN.fullmatch("".join(r[:1] or "_" for r, _ in kept)):
                found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in kept))
                best = found if best is None else min(best, found)
    return best


def _dynamic(rows):
    """The same by whole strings per state, for rows too many to enumerate."""
    faults = _faults(rows)
    go = {0: ("u", "s"), 1: ("u",), 2: ("a",), 3: ("u",)}
    to, names = {"s": 1, "u": 2, "a": 3}, {"u": "user", "a": "assistant"}
    table = {0: (0, "", ())}

    def insert(table):
        for _ in range(3):
            for p, (c, w, k) in list(table.items()):
                x = go[p][0]
                new = (c + 3, w + "I", (*k, f"{names[x]}:"))
                if to[x] not in table or new[:2] < table[to[x]][:2]:
                    table[to[x]] = new
        return table

    for (role, text), f in zip(rows, faults):
        out, more = {}, 3 * (f == "truncated")
        for p, (c, w, k) in insert(table).items():
            ways = [(p, (c + 4, w + "D", k))]
            if f not in ("blank", "duplicate"):
                if role[:1] in go[p]:
                    ways.append((to[role[:1]], (c + more, w + "K", (*k, f"{role}:{text}"))))
                x = go[p][0]
                ways.append((to[x], (c + 3 + more, w + "R", (*k, f"{names[x]}:{text}"))))
            for q, way in ways:
                if q not in out or way[:2] < out[q][:2]:
                    out[q] = way
        table = out
    c, w, k = min((v for p, v in insert(table).items() if p in (0, 3)), key=lambda v: v[:2])
    return c, w, "\n".join(k)


def _streamed(rows):
    r, out, most = repairer()(), [], 0
    for (role, text), f in zip(rows, _faults(rows)):
        out += r.row(role, text, f in ("blank", "duplicate"), f == "truncated")
        most = max(most, r.unresolved)
    out += r.finish()
    return (r.cost, "".join(e[0] for e in out), "\n".join(f"{e[1]}:{e[2]}" for e in out if e[0] != "D")), most


def test_small_conversations_equal_enumeration():
    rng = random.Random(3)
    roles, texts = ["system", "user", "assistant", "tool", "", "unit"], ["a.", "b!", "c", "", " \t", "d?", "e."]
    assert _streamed([])[0] == (0, "", "") == _enumerate([])
    for _ in range(120):
        rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, 3))]
        assert _streamed(rows)[0] == _enumerate(rows), rows


@pytest.mark.parametrize("weights", [(1, 4, 4, 1, 0, 0), (3, 3, 3, 3, 1, 1), (0, 1, 0, 0, 0, 0), (5, 1, 1, 0, 0, 0)])
def test_long_conversations_equal_whole_string_tables(weights):
    rng = random.Random(sum(weights))
    roles = ["system", "user", "assistant", "tool", "", "unit"]
    for _ in range(40):
        rows = [(rng.choices(roles, weights)[0], rng.choice(["", "x", f"{rng.random()}.", f"{rng.random()}"])) for _ in range(60)]
        assert _streamed(rows)[0] == _dynamic(rows)


def test_memory_holds_the_unresolved_part_only():
    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "tool"]), f"{i}.") for i in range(20_000)]
    assert _streamed(rows)[1] < 400
    blanks = [("user", "a."), *[("user", "")] * 50_000, ("assistant", "b.")]
    (cost, audit, text), most = _streamed(blanks)
    assert (cost, text, most < 50) == (4 * 50_000, "user:a.\nassistant:b.", True) and audit == "K" + "D" * 50_000 + "K"


def _expected(rows):
    """Report of (conv, turn, role, text) rows, from the contract's words."""
    text_of = lambda v: " " if v is None else str(v)
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c]
        role, text, h = text_of(role), text_of(text), zlib.crc32(f"{text_of(c)}:{text_of(turn)}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        by[c] += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for c, conv in by.items():
        conv.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = [t for t, _, _ in conv if t is not None]
        body = [(r, t) for _, r, t in conv]
        faults, first = _faults(body), [r[:1] for r, _ in body]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit, text = _dynamic(body)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                  illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def _got(df):
    return {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in df.collect()}


def test_query_equals_the_contract(spark):
    from recordlink.llm.registry import op13_conversation_repair
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want, got = _expected(rows), op13_conversation_repair(spark, SF)
    assert _got(got) == want and len({v[6] for v in want.values()}) > 10
    kept = defaultdict(list)
    for r in repair_edits(damage(spark.read.parquet(f"{SF}/conversations.parquet"))).orderBy("conv_id", "seq").collect():
        if r.edit != "D":
            kept[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(kept[c]).encode()).hexdigest() == v[7] for c, v in want.items())


def test_edge_rows(spark):
    rng = random.Random(8)
    rows = [(c, rng.choice([None, 0, 1, 2, 7]), rng.choice([None, "user", "assistant", "system", "Ü", ""]),
             rng.choice([None, "", " \x1f", "Ja.", "東京 。", "nein", "x" * 200_000 + "!", "Ja.\x0b "])) for c in (None, 1, 2, 3) for _ in range(25)]
    rows += [(4, None, "user", "a"), *[(5, 3, "user", "same.")] * 40]
    for conv in range(100, 160):                    # some lose their only row
        rows.append((conv, 0, "user", "hi."))
    df = (spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
          .select("*", F.lit(1).alias("_turn"), F.lit("x").alias("cost"), F.lit("y").alias("seq")))
    got = _got(repair_report(damage(df), df))
    assert got == _expected(rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, v in got.items() if c and c >= 100)
    none = df.limit(0)
    assert repair_report(damage(none), none).count() == 0 and repair_edits(none).count() == 0
