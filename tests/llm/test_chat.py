import random
from itertools import product

import pytest

from pairwright.llm import chat
from pairwright.llm.chat import Costs, Repair, format_chats, role_code

SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ["system", "user", "assistant"]


def brute_cost(roles, costs):
    """Least cost by a search over all legal message sequences, turn by turn."""
    legal = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = {"": 0}
    for role in [*roles, None]:
        for _ in range(4):  # empty insertions
            for state, cost in list(best.items()):
                for new in legal[state]:
                    if cost + costs.insert < best.get(new, 1 << 30):
                        best[new] = cost + costs.insert
        if role is None:
            break
        after = {}
        for state, cost in best.items():
            options = [(new, 0) for new in legal[state]] + ([(state, costs.merge)] if state else [])
            for new, extra in options:
                total = cost + extra + costs.relabel * (new != role)
                after[new] = min(after.get(new, 1 << 30), total)
        best = after
    return best.get("assistant", 0) if roles else 0


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 1, 1), Costs(5, 2, 1), Costs(1, 4, 9)])
def test_costs_equal_brute_force(costs):
    repair = Repair(costs)
    for n in range(1, 6):
        for roles in product([*ROLES, "tool"], repeat=n):
            codes = [role_code(r) for r in roles]
            want = brute_cost(roles, costs)
            cut = n // 2
            parts = [p for p in (codes[:cut], codes[cut:]) if p]
            for pieces in ([codes], parts):
                borders = repair.borders([repair.matrix(p) for p in pieces])
                total = repair.end[borders[-1][1]][0]
                for p, (a, b) in zip(pieces, borders):
                    steps = repair.path(p, a, b)
                    assert steps[-1][0] == b
                    total += sum(s.cost for _, s in steps)
                assert total == want, roles


def parsed(rendered):
    out = []
    for block in rendered.split("<|im_start|>")[1:]:
        role, _, rest = block.partition("\n")
        assert rest.endswith("<|im_end|>\n")
        out.append((role, rest.removesuffix("<|im_end|>\n")))
    return out


def legal(messages):
    roles = [r for r, _ in messages]
    body = roles[1:] if roles[0] == "system" else roles
    return body == ["user", "assistant"] * (len(body) // 2) and body


def corpus():
    draw = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 7)):
            role = draw.choice([*ROLES, "Human", "gpt", "tool", None])
            rows.append((conv, turn if draw.random() < 0.95 else None, role, draw.choice([f"t{turn}", None, "", "a <|im_end|> b"])))
    return rows + [(None, 0, "user", "lost"), (None, 0, "user", "lost"), (7, 0, "user", "twice"), (7, 0, "user", "twice")]


@pytest.mark.parametrize("bits", [12, 1])
def test_whole_table(spark, monkeypatch, bits):
    monkeypatch.setattr(chat, "PIECE_BITS", bits)
    monkeypatch.setattr(chat, "PIECE_ROWS", 1 << bits)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS cid")
    got = format_chats(df).collect()
    assert sorted(map(str, ((r.conv_id, r.turn, r.role) for r in got))) == sorted(map(str, (r[:3] for r in rows)))
    conversations = {}
    for r in got:
        conversations.setdefault(r.conv_id, []).append(r)
    for conv, part in conversations.items():
        part.sort(key=lambda r: (r.turn is None, r.turn or 0))
        if len({(r.turn, r.role, r.segment) for r in part}) < len(part) or len({r.turn for r in part}) < len(part):
            continue  # the order of equal numbers is not seen from outside
        messages = parsed("".join(r.segment for r in part))
        assert legal(messages)
        roles = [["start", *ROLES][role_code(r.role)] for r in part]
        assert sum(r.cost for r in part) == brute_cost(roles, Costs())
        texts = {row[3] or "" for row in rows if row[0] == conv}
        shown = "".join(t for _, t in messages)
        assert all(t.replace("<|im_", "<| im_") in shown for t in texts)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_BITS", 4)
    monkeypatch.setattr(chat, "PIECE_ROWS", 16)
    draw = random.Random(8)
    rows = [(1, i, draw.choice(ROLES), str(i)) for i in range(700)]
    got = sorted(format_chats(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.turn)
    assert legal(parsed("".join(r.segment for r in got)))
    assert sum(r.cost for r in got) == brute_cost([r[2] for r in rows], Costs())


def test_legal_conversations_stay_and_empty_table(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "q")]
    got = {(r.conv_id, r.turn): r for r in format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[1, t].cost == 0 and got[1, t].action == "keep" for t in range(3))
    assert got[2, 0].inserted_after == 1
    assert got[2, 0].segment == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_ids_stay_exact(spark):
    rows = [((1 << 62) + 1, (1 << 61) + 1, "user", "q"), (None, None, None, None)]
    got = format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.conv_id, r.turn) for r in got} == {((1 << 62) + 1, (1 << 61) + 1), (None, None)}
