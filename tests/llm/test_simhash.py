"""Fingerprints by their definition, tries against all pairs, components by search."""

import re

import numpy as np
import pytest
import xxhash
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.llm import simhash

DOCS = "doc_id long, text string, fp string, id string"


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    ids, prints = list(ids), np.array(list(prints), np.uint64)
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 3):
            up[root(i)] = root(int(j))
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(root(i), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


@settings(max_examples=80, deadline=None)
@given(st.text(" aAbBÄ\x0b\x1c\u00a0\n", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_long_text_in_strips(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    monkeypatch.setattr(simhash, "STRIP", 37)
    assert simhash.fingerprint(text) == plain_print(text)


def test_against_all_pairs(spark):
    got = simhash.op2_simhash(spark, DATA).toPandas()
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {i: f"{p:016x}" for i, p in prints.items()} == dict(zip(got["doc_id"], got["fingerprint"], strict=True))
    assert plain_components(prints.keys(), prints.values()) == dict(zip(got["doc_id"], got["component_id"], strict=True))


@pytest.mark.parametrize("cell_rows", [3, 512])
def test_dense_groups(spark, cell_rows):
    rng = np.random.default_rng(1)
    centers = rng.integers(0, 2**63, 6, dtype=np.uint64)
    prints = {0, 2**64 - 1}
    for c in centers:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            prints.add(int(c) ^ int(sum(1 << int(b) for b in flips)))
    prints |= {int(x) for x in rng.integers(0, 2**63, 200, dtype=np.uint64)}
    signed = [p - 2**64 if p >= 2**63 else p for p in sorted(prints)]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), cell_rows)
    roots = dict(simhash.components(edges).collect())
    got = {p: roots.get(p, p) for p in signed}
    want = plain_components(signed, [p % 2**64 for p in signed])
    assert {p: want[p] for p in signed} == got


def test_node_pairs_walked_in_small_steps(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 1)
    monkeypatch.setattr(simhash, "FRONTIER", 8)
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**12, 200).astype(np.uint64) * np.uint64(2**30))
    forest = simhash.join_tries(keys, np.array([0]), np.array([len(keys)]))
    want = plain_components(range(len(keys)), keys)
    assert [want[i] for i in range(len(keys))] == forest.up.tolist()


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7)], "a long, b long")
    roots = dict(simhash.components(edges).collect())
    assert roots == {**{i: 0 for i in range(1, 101)}, 501: 500}


def test_edges_of_input(spark):
    rows = [(5, "one two three four", "", ""), (3, "one  two\nTHREE four", "", ""), (9, None, "", ""), (8, "", "", ""), (7, " \t", "", ""), (None, "one two three four", "", ""), (3, "one two three four", "", ""), (4, "hello", "", "")]
    got = simhash.classes(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r["id"]), r["component_id"]) for r in got) == [("3", 3), ("3", 3), ("4", 4), ("5", 3), ("7", 7), ("8", 7), ("9", 7), ("None", 3)]
    assert simhash.classes(spark.createDataFrame([], DOCS)).count() == 0
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp", "id"] and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "7"]
    # Rows that share an id without being alike each stay; of null ids one stays for its group.
    apart = [(5, "completely different words here now", "a", ""), (5, "nothing in common with that one", "b", ""), (None, "no id at all", "c", ""), (None, "no id at all", "c", "")]
    assert sorted((str(r["doc_id"]), r["fp"]) for r in simhash.keep_one(spark.createDataFrame(apart, DOCS)).collect()) == [("5", "a"), ("5", "b"), ("None", "c")]


def test_groups_by_whole_shingle_sets(spark):
    """Near copies of similarity 0.8 whose fingerprints differ in more than op2's three bits."""
    rng = np.random.default_rng(5)
    texts, passage = [], [f"p{i}" for i in range(30)]
    for c in range(30):
        base = [f"c{c}w{x}" for x in rng.integers(0, 500, 120)]
        for k in range(6):
            words = list(base)
            for at in rng.choice(120, k, replace=False):
                words[at] = f"x{rng.integers(1_000_000)}"
            texts.append(" ".join(words + passage * (c % 3 == 0)))
    texts += [None, "", " \t", "one two three four", "ONE two  three four", "one two three"]
    ids = list(range(1000, 1000 + len(texts)))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for t in texts]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    up = list(range(len(ids)))
    missed = 0
    for i in range(len(ids)):
        for j in range(i):
            if near(sets[i], sets[j]):
                missed += (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).bit_count() > simhash.BUDGET
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in zip(ids, texts, strict=True)], DOCS)
    assert missed > 10
    assert {r["id"]: r["component_id"] for r in simhash.classes(docs).collect()} == {i: ids[x] for i, x in zip(ids, up, strict=True)}
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted({ids[x] for x in up})


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 150, 3000):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        for k in (0, 1, 10, 100):
            y = np.union1d(x[min(k, n) :], rng.integers(0, 2**63, k, dtype=np.uint64))
            differ = int(np.bitwise_count((simhash.sketch(x) ^ simhash.sketch(y)).view(np.uint64)).sum())
            assert differ <= len(np.setxor1d(x, y)) and (differ > 0 or k == 0 or n == 0)


def test_near_copies_that_are_not_alike_seldom_meet(spark, monkeypatch):
    """Of a large group that shares its shingles without being alike, few pairs leave the join, and the groups stay those of all pairs."""
    rng = np.random.default_rng(4)
    base, texts = [f"w{x}" for x in rng.integers(0, 400, 150)], []
    for k in [1] * 30 + [4] * 60 + [6] * 60:
        words = list(base)
        for at in rng.choice(150, k, replace=False):
            words[at] = f"x{rng.integers(1_000_000)}"
        texts.append(" ".join(words))
    sets = [set(simhash.shingle_set(t).tolist()) for t in texts]
    up, by_shingle = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            by_shingle += len(sets[i] & sets[j]) < 0.8 * len(sets[i] | sets[j])
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    made, meetings = [], simhash.meetings
    monkeypatch.setattr(simhash, "meetings", lambda split, similarity: made.append((meetings(split, similarity).count(), meetings(split, 0.01).count())) or meetings(split, similarity))
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    assert {r["id"]: r["component_id"] for r in simhash.classes(docs).collect()} == dict(enumerate(up))
    assert by_shingle > 5000 and made[0][1] > 5000 and made[0][0] < made[0][1] / 20
