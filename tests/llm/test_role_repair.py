import itertools
import random
import re

import pytest

from tallyline.llm import role_repair as R
from tests.llm.corpora import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, block string, entry string"
COSTS = R.Costs()


def cheapest(roles):
    """Minimum over all ways to label, merge and insert, by trying them all."""
    best = R.FAR
    for labels in itertools.product((R.SYSTEM, R.USER, R.ASSISTANT), repeat=len(roles)):
        cost, ways = 0, {R.START: 0}
        for role, label in zip(roles, labels, strict=True):
            named = 0 if role == R.ROLES[label] else COSTS.unknown if role is None else COSTS.relabel
            after = []
            for state, so_far in ways.items():
                if label in R.NEXT[state]:
                    after.append(so_far + named)
                if label == state:
                    after.append(so_far + named + COSTS.merge)
                if any(label in R.NEXT[m] for m in R.NEXT[state]):
                    after.append(so_far + named + COSTS.insert)
            ways = {label: min(after)} if after else {}
        cost = min((c + COSTS.closing(s).cost for s, c in ways.items()), default=R.FAR)
        best = min(best, cost)
    return best


def spent(roles, states):
    steps = [dict(COSTS.steps[r, a])[b] for r, a, b in zip(roles, states[:-1], states[1:], strict=True)]
    return sum(s.cost for s in steps) + COSTS.closing(states[-1]).cost


@pytest.mark.parametrize("length", range(6))
def test_repairs_are_cheapest(length):
    for roles in itertools.product(("system", "user", "assistant", None), repeat=length):
        assert spent(roles, R.traced(list(roles), COSTS, R.FROM_START, None)) == cheapest(roles)


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def legal(text):
    roles = re.findall(r"<\|(system|user|assistant)\|>", text)
    body = roles[1:] if roles[:1] == ["system"] else roles
    return bool(body) and len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def random_rows(conversations=30, most=60):
    draw = random.Random(4)
    roles = ["system", "user", "assistant", " User ", None, "tool"]
    return [(c, t, draw.choice(roles), f"text {c} {t}") for c in range(conversations) for t in range(draw.randint(1, most))]


def test_blocks_change_nothing(spark):
    rows = random_rows()
    whole = rows_of(R.repaired(turns(spark, rows)))
    for block in (1, 3, 16):
        assert rows_of(R.repaired(turns(spark, rows), block=block)) == whole
    texts = {}
    for conv, turn, *_, piece in sorted(whole):
        texts[conv] = texts.get(conv, "") + piece
    assert all(map(legal, texts.values())) and len(whole) == len(rows)
    assert all(f"text {c} {t}" in texts[c] for c, t, *_ in rows)


def test_rendered(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "user", "there"), (1, 2, "assistant", "Hello"), (1, 3, "user", "Bye")]
    got = [r["rendered"] for r in R.repaired(turns(spark, rows)).orderBy("turn").collect()]
    assert "".join(got) == "<|user|>\nHi\nthere<|end|>\n<|assistant|>\nHello<|end|>\n<|user|>\nBye<|end|>\n<|assistant|>\n<|end|>\n"


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (2, None, "assistant", "x"), (2, 5, "", "y"), (3, 0, "user", "q"), (3, 0, "user", "q")]
    got = R.repaired(turns(spark, rows))
    assert got.count() == len(rows)
    assert rows_of(got.filter("conv_id = 3").select("action")) == [("keep",), ("relabel",)]  # 2, a merge costs 1 and the empty answer 3
    assert R.repaired(turns(spark, [])).count() == 0
