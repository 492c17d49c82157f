import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tapespark.llm import queries, repair

PATH = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """{conv_id: rows (turn, role, text)} after damage."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, told = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        told.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return told


def fits(initials):
    return re.fullmatch("(s?(ua)+)?", "".join(initials)) is not None


def every_way(rows, told):
    """(cost, audit, lines) of every repair with up to two insertions at each place."""
    inserted = [[], *([r] for r in ("user", "assistant")), *([a, b] for a, b in product(("user", "assistant"), repeat=2))]
    edited = []
    for (_, role, text), fault in zip(rows, told):
        ways = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            ways += [(extra, "K", [(role, text)])] + [(2 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        edited.append(ways)
    inserts = [(2 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserted]
    choices = [inserts]
    for ways in edited:
        choices += [ways, inserts]
    for way in product(*choices):
        lines = [line for _, _, part in way for line in part]
        if fits([role[:1] or "-" for role, _ in lines]):
            yield sum(c for c, _, _ in way), "".join(a for _, a, _ in way), lines


def plain_cheapest(rows, told):
    """The same by states, for conversations of any length, from the end to the start."""
    into = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {s: (0, "", []) if s in (0, 3) else None for s in range(4)}

    def insertions(values):
        for _ in range(3):
            for (s, r), to in into.items():
                if r != "s" and values[to] is not None:
                    cost, audit, lines = values[to]
                    role = "user" if r == "u" else "assistant"
                    way = (cost + 2, "I" + audit, [(role, "")] + lines)
                    if values[s] is None or way[:2] < values[s][:2]:
                        values[s] = way
        return values

    best = insertions(best)
    for (_, role, text), fault in reversed(list(zip(rows, told))):
        now = {}
        for s in range(4):
            ways = []
            if best[s] is not None:
                ways.append((best[s][0] + 3, "D" + best[s][1], best[s][2]))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for new, cost, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    to = into.get((s, new[:1]))
                    if to is not None and best[to] is not None:
                        ways.append((best[to][0] + cost + extra, letter + best[to][1], [(new, text)] + best[to][2]))
            now[s] = min(ways, key=lambda w: w[:2]) if ways else None
        best = insertions(now)
    return best[0]


def plain_report(rows):
    out = {}
    for conv, kept in plain_damage(rows).items():
        kept = sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
        told = faults(kept)
        turns = {r[0] for r in kept if r[0] is not None}
        initials = [r[1][:1] for r in kept]
        cost, audit, lines = plain_cheapest(kept, told)
        text = "\n".join(f"{role}:{text}" for role, text in lines)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            told.count("blank"), told.count("duplicate"), told.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report_of(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


SCHEMA = "conv_id long, turn long, role string, text string"
SAID = ["Yes.", "no", "", " \n", None, "Fine! ", "What?", "a. b"]


def made(seed, convs=40, most=12):
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(draw.randint(1, most)):
            rows.append((
                conv, draw.choice([turn, turn, turn, 3, None]),
                draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), draw.choice(SAID),
            ))
    return rows


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{PATH}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report_of(queries.QUERIES["op12_repair"](spark, PATH)) == plain_report(rows)


def test_agenda_finds_the_least_of_all_repairs():
    draw = random.Random(5)
    for _ in range(60):
        rows = [(0, draw.choice(["user", "assistant", "system", "tool", ""]), "x") for _ in range(draw.randint(0, 3))]
        told = [draw.choice(["", "", "truncated", "blank", "duplicate"]) for _ in rows]
        want = min(every_way(rows, told), key=lambda w: w[:2])
        known = [(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for (_, role, _), fault in zip(rows, told)]
        cost, audit = repair.lightest(known, repair.ACCEPTED)[repair.START]
        assert (cost, audit) == want[:2] == plain_cheapest(rows, told)[:2]
        lines = [(role or rows[at][1]) for at, _, role in repair.repaired([k[0] for k in known], audit)]
        assert lines == [role for role, _ in want[2]] and fits([r[:1] for r in lines])


@pytest.mark.parametrize("long, segment", [(256, 512), (2, 3), (0, 1)])
def test_conversations_of_any_length_are_repaired_alike(spark, monkeypatch, long, segment):
    monkeypatch.setattr(repair, "LONG", long)
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = made(7)
    docs = spark.createDataFrame([(*r, True, 1) for r in rows], f"{SCHEMA}, gone boolean, copy int").repartition(5)
    assert report_of(repair.report(repair.damage(docs))) == plain_report(rows)
    lines = repair.repair(repair.damage(docs)).orderBy("conv_id", "place").collect()
    texts = {}
    for r in lines:
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, want in plain_report(rows).items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == want[-1]


def test_a_hot_conversation_is_spread(spark):
    draw = random.Random(9)
    rows = [(1, turn, draw.choice(["user", "assistant"]), draw.choice(SAID[:4]) or "x") for turn in range(5000)]
    rows += [(2, 0, "user", "Only this."), (2, 1, "assistant", "y" * 200_000 + ".")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert report_of(repair.report(repair.damage(docs))) == plain_report(rows)


def test_edges(spark):
    # 0:16 is dropped by its check sum, so nothing of its conversation is left.
    dropped = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, dropped, "user", "Gone."), (6, None, None, None), (7, -(1 << 62), "user", "a."), (7, 1 << 62, "assistant", "b."), (7, (1 << 63) - 1, "user", "c.")]
    got = report_of(repair.report(repair.damage(spark.createDataFrame(rows, SCHEMA))))
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = plain_report(rows)
    assert got[7][0] == min(want[7][0], (1 << 63) - 1) and got[7][1:] == want[7][1:] and got[6] == want[6]
    assert repair.report(repair.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    whole = repair.repair(repair.untouched(spark.createDataFrame(rows[2:4], SCHEMA))).collect()
    assert [(r.role, r.text, r.edit) for r in sorted(whole, key=lambda r: r.place)] == [("user", "a.", "K"), ("assistant", "b.", "K")]
