"""All matching pairs, where marks go out in several parts and texts lie in many cells."""

import random

import pytest

from siltworks import queries
from siltworks.operators import alike, dedup


def drawn(seed, size):
    rng = random.Random(seed)
    draw = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared, base = draw(40), draw(300)
    cut = lambda: (i := rng.randrange(280), base[:i] + draw(rng.randrange(30)) + base[i + 20 :])[1]
    return [x for _ in range(size) for x in (shared + draw(rng.randrange(5, 400)), cut())] + ["", "a", "abcde"]


def by_hand(texts, t):
    sets = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in texts]
    return {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}


@pytest.mark.parametrize("t", [0.12, 0.6, 1.0])
def test_cells(spark, t):
    texts = drawn(2, 25)
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, sig string")
    got = dedup.matches(rows, t, most=20, block=9).collect()
    assert {(r["a"], r["b"]): r["jaccard"] for r in got} == by_hand(texts, t)
    assert len(got) == len({(r["a"], r["b"]) for r in got})


def test_copies_and_order(spark, tmp_path):
    """Copies of a text match each other and what its other rows match; empty input has no pairs."""
    texts = drawn(5, 6)
    texts = texts * 3 + texts[:1] * 20
    ids = random.Random(1).sample(range(-500, 500), len(texts))
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.near_dedup_edges(spark, str(tmp_path)).collect()
    want = {(min(ids[a], ids[b]), max(ids[a], ids[b])): round(j, 9) for (a, b), j in by_hand(texts, 0.6).items()}
    assert {(r["a"], r["b"]): r["jaccard"] for r in got} == want and len(got) == len(want)
    assert dedup.matches(spark.createDataFrame([], "ord long, sig string"), 0.6).count() == 0


def test_marks_are_a_bound():
    rng = random.Random(6)
    for _ in range(50):
        a = alike.gram_set("".join(rng.choice("abcd") for _ in range(rng.randrange(900))), 5)
        b = alike.gram_set("".join(rng.choice("abcd") for _ in range(rng.randrange(900))), 5)
        x, y = int.from_bytes(alike.mark(a)), int.from_bytes(alike.mark(b))
        assert (x ^ y).bit_count() <= len(set(a.tolist()) ^ set(b.tolist()))
