import hashlib
import random
import re
import sys
import zlib
from os.path import dirname

import pyarrow.parquet as pq

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
TARGET = re.compile(r"(s?(ua)+)?")


def all_cheapest(rows):
    """Cheapest audit of rows (initial, fault), from the last row to the first:
    a letter before two rests keeps their order, so the least rest is enough."""
    follows = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
    never = (1 << 60, "")

    def with_inserts(best):
        best = dict(best)
        for _ in range(3):
            for state, x in sorted(follows):
                if x != "s" and best[x][0] < never[0]:
                    best[state] = min(best[state], (best[x][0] + 3, "I" + best[x][1]))
        return best

    best = with_inserts({"": (0, ""), "a": (0, ""), "s": never, "u": never})
    for initial, fault in reversed(rows):
        now = {}
        for state in best:
            options = [(best[state][0] + 4, "D" + best[state][1])]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                options += [(best[x][0] + extra, "K" + best[x][1]) for x in "sua" if x == initial and (state, x) in follows]
                options += [(best[x][0] + 3 + extra, "R" + best[x][1]) for x in "ua" if (state, x) in follows]
            now[state] = min(options)
        best = with_inserts(now)
    return best[""]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        s = lambda v: " " if v is None else str(v)
        chance = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        if chance == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(chance, text)
        out += [(conv, turn, "user" if chance == 4 else role, text)] * (2 if chance == 3 else 1)
    return out


def brute(rows, hurt):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for _, t, _, _ in mine if t is not None]
        initials = [r[:1] for _, _, r, _ in mine]
        cost, audit = all_cheapest(list(zip(initials, faults)))
        lines, i, said = [], 0, ""
        for x in audit:
            _, _, role, text = mine[i] if x != "I" else (0, 0, 0, "")
            i += x != "I"
            if x in "IR":
                role = "assistant" if said[-1:] == "u" else "user"
            if x != "D":
                lines.append(f"{role}:{text}")
                said += role[:1]
        assert TARGET.fullmatch(said) and i == len(mine)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations():
    rng = random.Random(11)
    texts = ["Fine.", "Fine!", "cut off", " \t\n", "", None, "Ends in space. \n", "ü?", "a:b\nc."]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]), rng.choice(texts)) for c in range(100, 400) for t in range(rng.randint(1, 7))]
    rows += [(None, None, "user", "no ids."), (None, 1, None, None), (9, None, "user", "x."), (9, None, "assistant", "y."), (9, 5, "user", "x."), (10, 3, "tool", "only")]
    rows += [(11, 7, "user", "same row.")] * 5 + [(12, t // 2, "user", f"tie {t}.") for t in range(9)] + [(13, -(2**63), "user", "far."), (13, 2**63 - 1, "assistant", "apart.")]
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_conversations(spark):
    rows = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.01/conversations.parquet").to_pylist()]
    df = llm_cases.clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert collected(repair.repair_damaged(df)) == brute(rows, damage(rows))


def test_odd_conversations(spark):
    rows = odd_conversations()
    got, want = collected(repair.repair_damaged(spark.createDataFrame(rows, SCHEMA).repartition(3))), brute(rows, damage(rows))
    wide = lambda out: [r for r in out if r[0] != 13]
    assert wide(got) == wide(want)
    assert [r[1:2] + r[6:8] for r in got if r[0] == 13] in ([(None, 0, "KK")], [(0, 3, "KI")], [(0, 3, "IK")], [(None, 3, "KK")], [(None, 6, "KK")])


def test_long_conversation_in_many_pieces(spark, monkeypatch):
    """Pieces of a few rows, dealt over many tasks, give the whole's audit."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Yes.", "No", f"Turn {t}.", f"Turn {t}", ""])) for t in range(700)]
    rows += [(2, 1, "user", "again."), *[(3, 4, "assistant", "equal.")] * 40]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, damage(rows))
    for piece, batch in ((3, 8), (50, 100), (1 << 16, 1 << 18)):
        monkeypatch.setattr(repair, "PIECE", piece)
        monkeypatch.setattr(repair, "BATCH", batch)
        assert collected(repair.repair_damaged(df)) == want


def test_rules_are_shared_and_matrices_join():
    rng = random.Random(4)
    sequences = [bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 8]) for _ in range(rng.randint(1, 30))) for _ in range(200)] + [bytes([1]) * 33, bytes([1, 2]) * 50]
    grammar = repair.Grammar(sequences)
    assert len(grammar.cost) - repair.GONE - 1 < sum(map(len, sequences)) / 2
    for s, root in zip(sequences, grammar.roots):
        rows = [("suax"[x % 4] if x < 8 else "x", "blank" if x == 8 else "truncated" if x >= 4 else "") for x in s]
        ends = [(grammar.cost[root, 0, j] + tail[0], grammar.audit(root, 0, j) + tail[1]) for j, tail in enumerate(repair.TAIL) if grammar.cost[root, 0, j] < repair.NEVER]
        assert min(ends) == all_cheapest(rows)


def test_empty_table(spark):
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []
