import hashlib
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from rowtide.llm import chat_repair

SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 0:
            continue
        if harm == 1:
            text = ""
        if harm == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if harm == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if harm == 3 else 1)
    return out


def naive(rows):
    """All edits of a conversation row by row, with whole audits as texts."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    ways = {("", ""): (0, "", ())}  # (last initial, has system) -> cost, audit, written rows

    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def inserts(table):
        table = dict(table)
        for _ in range(3):
            for (last, system), (cost, audit, written) in list(table.items()):
                role = "assistant" if last == "u" else "user"
                better(table, (role[0], ""), (cost + 2, audit + "I", (*written, f"{role}:")))
        return table

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        late = fault == "truncated"
        for (last, system), (cost, audit, written) in inserts(ways).items():
            better(after, (last, system), (cost + 3, audit + "D", written))
            if fault not in ("blank", "duplicate"):
                need = "assistant" if last == "u" else "user"
                better(after, (need[0], ""), (cost + 2 + late, audit + "R", (*written, f"{need}:{text}")))
                if role[:1] == need[0] or (role[:1] == "s" and last == ""):
                    better(after, (role[0], ""), (cost + late, audit + "K", (*written, f"{role}:{text}")))
        ways = after
    cost, audit, written = min(w for (last, _), w in inserts(ways).items() if last in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(written).encode()).hexdigest(),
    )


def expected(rows, harm=True):
    convs = {}
    for row in rows:
        convs.setdefault(row[0], []).append(row)
    plain = lambda rs: [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rs]
    return {c: naive(damaged(rs) if harm else plain(rs)) for c, rs in convs.items()}


def found(frame, id_col="conv_id"):
    return {r[0]: tuple(r)[1:] for r in frame.select(id_col, *[c.split()[0] for c in chat_repair.REPORT.split(", ")]).collect()}


def test_every_short_conversation_is_repaired_at_least_cost():
    texts = {"f": "good.", "b": "", "t": "cut"}
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("f", "t")] + [("user", "b")]
    for length in (1, 2, 3, 4):
        for combo in product(kinds if length < 4 else kinds[:5], repeat=length):
            rows = [(i, r, texts[t] and f"{i} {texts[t]}") for i, (r, t) in enumerate(combo)]
            codes = [4 * "sua".find(r[0]) + {"f": 0, "b": 1, "t": 3}[t] if r[0] in "sua" else 12 + {"f": 0, "t": 3}[t] for r, t in combo]
            edits = chat_repair.edits_of(codes, [1] * length, chat_repair.EMPTY, None)
            assert "".join(edits) == naive(rows)[6]


@pytest.fixture(scope="module")
def chats(llm):
    roles, texts = ("user", "assistant", "system", "tool", "", None), ("Hello there.", "cut off", " \t", "", None, "Yes!", "same?")
    rows = []
    for conv in range(120):
        for turn in range(zlib.crc32(b"%d" % conv) % 12):
            h = zlib.crc32(f"{conv}/{turn}".encode())
            role = roles[turn % 2] if h % 3 else roles[h // 3 % 6]
            text = texts[h // 31 % 7] if h % 2 else f"turn {h}."
            rows.append((conv, None if h % 17 == 0 and turn == 0 else turn, role, text))
    rows += [(None, t, "user", "x.") for t in (None, 3, 9)] + [(500, t, r, f"{t}.") for t in range(700) for r in ("user",)]
    rows += [(501, 1, "user", "again.")] * 40 + [(502, None, "user", "a."), (502, None, "assistant", "b.")]
    return rows


def test_repair_matches_brute_force(llm, chats):
    frame = llm.createDataFrame(chats, "conv_id long, turn long, role string, text string")
    clash = frame.withColumns({c: F.lit(1) for c in ("id", "key", "code", "copies", "at", "same")}).repartition(5)
    for harm in (True, False):
        want = expected(chats, harm)
        assert found(chat_repair.repair_conversations(clash, harm=harm)) == want
        assert found(chat_repair.repair_conversations(clash, harm=harm, piece=7)) == want


def test_registered_query_and_empty_table(llm):
    from rowtide.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = found(QUERIES["op12_chat_repair"](llm, sf))
    rows = [tuple(r) for r in llm.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == expected(rows)
    empty = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert found(chat_repair.repair_conversations(empty)) == {}
