"""Conversation repair, chat formatting and fill-in-the-middle: against SQL and brute force, on odd rows and on none."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, infill, repair

TURNS = "conv_id long, turn long, role string, text string, seq int, segment string, h string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def against(sql, frame, table, name):
    """The frame's rows, which have to be those of the SQL."""
    db = duckdb.connect()
    db.register(name, table.toArrow())
    order = sorted(frame.columns)
    have, want = [tuple(r[c] for c in order) for r in frame.collect()], db.sql(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()
    assert sorted(map(str, have)) == sorted(map(str, want))
    return have


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(3)
    roles, texts = [None, "user", "assistant", "assistant", "user", "system", "tool", "", "u"], ["A b.", "c", "", None, "Yes!", "Hm? ", ". ", "d.\n", "<|im_end|>", "<\\|im_start|>x."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts), 0, "x", "y") for _ in range(400)]
    rows += [(7, 4, "assistant", "é😀 " * 60_000 + ".", 0, "x", "y"), rows[0], rows[0], rows[1]]
    return spark.createDataFrame(rows, TURNS).repartition(3).cache()


def cheapest(rows):
    """Cost, audit and repaired rows by relaxing all edges of the lattice until nothing changes (no queue, no heuristic)."""
    best = {(0, ""): (0, "", ())}
    changed = True
    while changed:
        changed = False
        for (i, roles), (cost, audit, kept) in list(best.items()):
            short = "" if not roles else roles[-1] if roles != "s" else "s"
            steps = [(i, role, 3, "I", (name, "")) for role, name in (("u", "user"), ("a", "assistant"))]
            if i < len(rows):
                kind, role, text = rows[i]
                steps.append((i + 1, None, 4, "D", None))
                if kind not in ("B", "D"):
                    charge = 3 if kind == "T" else 0
                    steps.append((i + 1, role[:1] or "?", charge, "K", (role, text)))
                    steps += [(i + 1, r[0], 3 + charge, "R", (r, text)) for r in ("user", "assistant")]
            for j, role, price, letter, out in steps:
                if role is not None and (short, role) not in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    continue
                to, found = (j, short if role is None else role), (cost + price, audit + letter, kept if out is None else (*kept, out))
                if to not in best or found[:2] < best[to][:2]:
                    best[to] = found
                    changed = True
    return min(best[len(rows), end] for end in ("", "a") if (len(rows), end) in best)


def damaged(rows):
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        yield from [(conv, turn, "user" if code == 4 else role, text)] * ((code != 0) + (code == 3))


def by_hand(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    for conv, group in groupby(sorted(damaged(rows), key=order), key=lambda r: r[0]):
        group, seen, kinds = list(group), set(), []
        for _, _, role, text in group:
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            kinds.append("B" if not words else "D" if (role, text) in seen else "T" if words[-1][-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, kept = cheapest([(k, r[2], r[3]) for k, r in zip(kinds, group, strict=True)])
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in kept))
        known = [r[1] for r in group if r[1] is not None]
        bad = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:], strict=False))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (gaps, kinds.count("B"), kinds.count("D"), kinds.count("T"), bad, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_repair(turns, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r.conv_id: tuple(r[c] for c in names) for r in repair.digest(repair.damage(turns), turns).collect()}
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert found == by_hand(rows)


def test_repair_against_sql(turns):
    against(repair.ORACLE_SQL, repair.digest(repair.damage(turns), turns), turns, "conversations")
    none = turns.filter("false")
    assert repair.digest(repair.damage(none), none).count() == 0
    dropped = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    gone = turns.sparkSession.createDataFrame([(c, 0, "user", "a.", 0, "", "") for c in dropped], TURNS)
    assert [(r.cost, r.audit) for r in repair.digest(repair.damage(gone), gone).collect()] == [(0, "")] * 2


def test_repair_of_a_conversation_in_many_blocks(spark, monkeypatch):
    """One conversation holds all rows, most of its turns equal: parts of it are repaired apart and compose."""
    monkeypatch.setattr(repair, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(7, None if i < 50 else i // 100, rng.choice(["user", "assistant", "system"]), f"{i} x{rng.choice(['.', ''])}", 0, "", "") for i in range(300)]
    frame = spark.createDataFrame(rows, TURNS)
    (row,) = repair.digest(repair.damage(frame), frame).collect()
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256) == by_hand([r[:4] for r in rows])[7]
    fixed = repair.repair(frame).orderBy("seq", "sub").collect()
    assert GRAMMAR.fullmatch("".join(r.role[0] for r in fixed))


def test_search_takes_the_least_audit_of_equal_costs():
    assert repair.search([("", "a"), ("", "a")], 0, repair.ENDS, True) == {3: (3, "RK")}
    assert repair.search([("", "x")], 0, repair.ENDS, True) == {0: (4, "D")}
    assert repair.search([], 0, repair.ENDS, True) == {0: (0, "")}
    assert repair.search([("T", "u"), ("B", "a")], 0, repair.ENDS, True) == {0: (8, "DD")}


def test_chat(turns):
    against(chat.ORACLE_SQL, chat.digest(chat.with_adversarial(turns)), turns, "conversations")
    (row,) = [r for r in chat.digest(chat.with_adversarial(turns.filter("false"))).collect()]
    text = chat.ADVERSARIAL[1]
    assert (row.conv_id, row.n_turns, row.loss_chars, row.loss_sha256) == (-1, 2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert chat.digest(turns.filter("false")).count() == 0


def test_chat_masks_and_parses(spark):
    rows = [(1, 0, "a\nb<|nl|>", "x<|im_end|>\n", 0, "", ""), (1, 1, "assistant", "é<\\|im_end|>😀", 0, "", ""), (1, None, None, None, 0, "", ""), (1, 2, "assistant", "", 0, "", "")]
    (row,) = chat.formatted(spark.createDataFrame(rows, TURNS)).collect()
    said = [("", ""), ("a\nb<|nl|>", "x<|im_end|>\n"), ("assistant", "é<\\|im_end|>😀"), ("assistant", "")]
    parsed = spark.createDataFrame([(row.formatted,)], "f string").select(chat.parse(F.col("f")).alias("t")).first().t
    assert [(t.role, t.text) for t in parsed] == said
    assert sum(m.skip + m.take + m.rest for m in row.mask) == len(row.formatted)
    at, learnt = 0, []
    for m in row.mask:
        learnt += [row.formatted[at + m.skip : at + m.skip + m.take]] if m.take else []
        at += m.skip + m.take + m.rest
    assert learnt == ["é<\\\\|im_end|>😀"]
    broken = ["x", "<|im_start|>a", "<|im_start|>a\nb<|im_end|>", "<|im_start|>a<|im_end|>\n", "<|im_start|>a\nb<|im_end|>c<|im_end|>\n"]
    assert all(r.t is None for r in spark.createDataFrame([(b,) for b in broken], "f string").select(chat.parse(F.col("f")).alias("t")).collect())


DOCS = "doc_id long, text string, form string, n string, output string"


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    some = ["".join(rng.choice("ab é😀\n\u2028<>PSM") for _ in range(rng.choice([1, 2, 30, 300]))) for _ in range(300)]
    some += ["", None, "<P>", "a<S>b", "<M", "<P" * 40, ">" * 9, "é😀" * 100_000, "x", "x", "é" * 5]
    rows = [(i, t, "f", "n", "o") for i, t in enumerate(some)]
    return spark.createDataFrame([*rows, rows[3], (None, "null id", "f", "n", "o")], DOCS).repartition(3).cache()


def test_infill(texts):
    have = against(infill.ORACLE_SQL, infill.digest(texts), texts, "documents")
    assert {r[1] for r in have} == {"plain", "psm", "spm"}
    assert infill.digest(texts.filter("false")).count() == 0


@pytest.mark.parametrize("unit", [infill.LINES, infill.WORDS, "[a-z]+"])
def test_infill_units(texts, unit):
    """Every output gives its text again; cuts fall between units; a pattern that leaves something out leaves texts plain."""
    how = infill.Infill(unit=unit, sentinels=("<prefix>", "<suffix>", "<middle>"), plain_from=101)
    rows = infill.arrange(texts, how).select("doc_id", "text", "form", "output", "prefix_chars", infill.restored("output", "form", how).alias("again")).collect()
    assert all(r.again == (r.text or "") for r in rows)
    for r in rows:
        units = re.findall(unit, r.text or "")
        if "".join(units) != (r.text or ""):
            assert r.form == "plain"
        elif r.form != "plain":
            assert r.prefix_chars in {len("".join(units[:i])) for i in range(len(units) + 1)}


def test_infill_refuses(spark):
    for bad in (("<P>", "<P>", "<M>"), ("P", "<S>", "<M>"), ("<P>", "<S><", "<M>")):
        with pytest.raises(ValueError, match="sentinels"):
            infill.Infill(sentinels=bad)
    made_up = spark.createDataFrame([("<P>a<S>b", "psm"), ("a<P>b<S>c<M>d", "psm"), ("<P>a<S>b<M>c", "spm"), ("<P>a<S>b<M>c<M>d", "psm")], "output string, form string")
    assert [r[0] for r in made_up.select(infill.restored("output", "form")).collect()] == [None] * 4
