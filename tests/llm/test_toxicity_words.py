"""Toxic words that clean documents use too: told apart by the word before them, or by how many there are."""

import random

import pytest

from tidegate.llm import toxicity


def made(kind, n, rnd):
    rows = []
    for k in range(n):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(20, 120))]
        toxic = int(k % 4 == 0)
        for _ in range(rnd.randint(2, 4) if toxic or kind == "order" else rnd.random() < 0.4):
            a, b = rnd.choice(["vekan", "slur", "dorn"]), rnd.choice(["mok", "tapi", "gul"])
            words.insert(rnd.randrange(len(words) + 1), a if kind == "number" else f"{a} {b}" if toxic else f"{b} {a}")
        rows.append((" ".join(words), toxic))
    return rows


@pytest.mark.parametrize("kind", ["order", "number"])
def test_words_of_clean_documents(kind):
    rnd = random.Random(7)
    model = toxicity.fit(made(kind, 700, rnd), 0.25)
    found = [(model.score(t)[0] >= toxicity.THRESHOLD, y) for t, y in made(kind, 400, rnd)]
    caught, left = ([x for x, y in found if y == kind] for kind in (1, 0))
    assert sum(caught) >= 0.95 * len(caught) and sum(left) <= 0.05 * len(left)
