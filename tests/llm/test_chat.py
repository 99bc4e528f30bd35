import itertools
import random

import pytest

from tripmill.llm import chat

ROLES = [None, chat.SYSTEM, chat.USER, chat.ASSISTANT]


def cheapest(roles):
    """Least cost by trying every way to place every turn."""
    best = {chat.START: 0.0}
    for role in roles:
        new = {}
        for state, cost in best.items():
            ways = [(to, 0.0) for to in chat.LEGAL[state]]
            ways += [(to, chat.INSERT) for empty in chat.LEGAL[state] for to in chat.LEGAL[empty]]
            ways += [(state, chat.MERGE)] if state != chat.START else []
            for to, price in ways:
                total = cost + price + (chat.RELABEL if to != role else 0)
                new[to] = min(total, new.get(to, total))
        best = new
    return min(best.values())


def legal(sequence):
    state = chat.START
    for role in sequence:
        if role not in chat.LEGAL[state]:
            return False
        state = role
    return True


def placed(moves):
    out = []
    for _, to, empty, merged in moves:
        out += [empty] if empty else []
        out += [] if merged else [to]
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_least_cost_and_legal(n):
    for roles in itertools.product(ROLES, repeat=n):
        moves, cost = chat.path(list(roles))
        assert cost == cheapest(roles) == sum(m[0] for m in moves)
        assert legal(placed(moves)) and len(moves) == n


def test_pieces_cost_as_much_as_the_whole():
    rng = random.Random(4)
    for _ in range(60):
        roles = [rng.choice(ROLES) for _ in range(rng.randrange(2, 30))]
        cuts = sorted(rng.sample(range(1, len(roles)), min(3, len(roles) - 1)))
        pieces = [roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)])]
        states = chat.borders([chat.matrix(p) for p in pieces])
        moves = [m for p, (enter, leave) in zip(pieces, states) for m in chat.path(p, enter, leave)[0]]
        assert sum(m[0] for m in moves) == cheapest(roles) and legal(placed(moves))


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def parsed(text):
    parts = text.split("<|im_end|>\n")
    assert parts[-1] == ""
    return [tuple(p.removeprefix("<|im_start|>").split("\n", 1)) for p in parts[:-1]]


@pytest.mark.parametrize("partitions", [1, 7])
def test_conversations_over_partitions(spark, partitions):
    """One conversation holds most turns and lies in many partitions."""
    rng = random.Random(9)
    names = ["system", "user", "assistant", "bot", None]
    rows = [(1, i, rng.choice(names), f"t{i}") for i in range(400)]
    rows += [(c, i, rng.choice(names), f"c{c}t{i}") for c in range(2, 30) for i in range(rng.randrange(1, 6))]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.format_chats(frame(spark, rows)).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r.conv_id, r.turn) for r in found] == sorted((c, t) for c, t, _, _ in rows)
    for conv, turns in itertools.groupby(found, key=lambda r: r.conv_id):
        turns = list(turns)
        assert sum(t.cost for t in turns) == cheapest([chat.role_of(t.old_role) for t in turns])
        told = parsed("".join(t.piece for t in turns))
        assert legal([chat.ROLES[role] for role, _ in told])
        texts = [line for _, text in told for line in text.split("\n") if line]
        assert texts == [text for c, _, _, text in sorted(rows, key=lambda r: r[:2]) if c == conv]


def test_hard_turns(spark):
    rows = [(None, None, None, None), (None, 1, "user", ""), (5, 1, "USER ", "a"), (5, 1, "USER ", "a"), (6, None, "assistant", "x" * 300_000)]
    df = frame(spark, rows).selectExpr("*", "'c' as piece", "1L as seq", "'r' as action")
    found = chat.format_chats(df).orderBy("seq").collect()
    assert [(r.conv_id, r.new_role, r.action, r.inserted) for r in found] == [
        (None, "system", "keep+relabel", None), (None, "user", "keep", None), (5, "user", "keep", None), (5, "user", "merge", None),
        (6, "assistant", "keep", "user"),
    ]
    assert chat.format_chats(df.limit(0)).count() == 0
