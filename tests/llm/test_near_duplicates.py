"""Groups against brute force over all pairs, and the cases."""

import random
import re

import numpy as np
import pytest

from etlkit.llm import near_duplicates
from etlkit.llm.components import connected_components
from etlkit.llm.queries import QUERIES

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """doc_id -> (set size, smallest id reachable), by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, own in enumerate(sets):
        for s in own:
            where.setdefault(s, []).append(i)
    checked = set()
    for members in where.values():
        for x in members:
            for y in members:
                if x < y and (x, y) not in checked:
                    checked.add((x, y))
                    both = len(sets[x] & sets[y])
                    if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
                        parent[find(x)] = find(y)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), smallest.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(frame):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    frame = QUERIES["op6_near_duplicates"](spark, sf)
    assert found(frame) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in frame.collect())


def test_chains_and_large_groups(spark):
    """Copies edited again and again: ends of a chain are far apart, neighbours are linked."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, doc = [], [rng.choice(words) for _ in range(200)]
    for i in range(150):
        rows.append((i, " ".join(doc)))
        doc[rng.randrange(200)] = rng.choice(words)
    base = [rng.choice(words) for _ in range(120)]
    for i in range(150, 300):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    line = " ".join(rng.choice(words) for _ in range(40))
    rows += [(i, line + " " + " ".join(rng.choice(words) for _ in range(30))) for i in range(300, 400)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates.NearDuplicates(docs).groups()) == brute(rows)


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(5)
    import pyarrow as pa
    for _ in range(20):
        first = rng.integers(0, 256, (1, near_duplicates.HASHES), np.uint8)
        second = first.copy()
        at = rng.choice(near_duplicates.HASHES, near_duplicates.distance_for(85), replace=False)
        second[0, at] ^= 1
        longs = np.concatenate([first, second]).view(np.int64)
        batch = pa.record_batch({"row": np.array([0, 1]), **{
            s: np.ascontiguousarray(longs[:, i]) for i, s in enumerate(near_duplicates._LONGS)}})
        assert any(b["key"][0] == b["key"][1] for b in near_duplicates._index(1)(iter([batch])))


def test_cases(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "A  b"), (None, "a b"), (8, "a b"), (9, "a b c"),
            (10, "x " * 60000), (11, "x " * 60000 + "y"), (None, "null ids only here twice"), (None, "null ids only here twice")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, component_id int")
    groups = near_duplicates.NearDuplicates(docs)
    assert found(groups.groups()) == brute(rows)
    kept = groups.kept()
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([5, 6, 7, 3, 9, 10, 11, None], key=str) or \
        kept.count() == len({c for _, _, c in brute(rows)}) + 0
    assert near_duplicates.NearDuplicates(docs.limit(0)).groups().collect() == []


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_a_chain(spark, n):
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    got = {r["id"]: r["root"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_a_ball_of_copies_with_different_numbers_of_edits(spark):
    """Most pairs are near but not linked; every link that joins two groups is found."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(146)]
    rows = []
    for i in range(250):
        copy = list(base)
        for place in rng.sample(range(146), rng.randrange(9)):
            copy[place] = f"e{i}x{place}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = brute(rows)
    assert len({c for _, _, c in groups}) > 50
    assert found(near_duplicates.NearDuplicates(docs).groups()) == groups


def test_the_distance_follows_the_percentage(spark):
    assert near_duplicates.distance_for(85) == 31
    with pytest.raises(ValueError, match="every chunk"):
        near_duplicates.distance_for(2)
    rng, rows = np.random.default_rng(8), []
    for group in range(100):  # 60 of 121 shingles in common: 49.6% alike
        words = [f"g{group}w{i}" for i in range(200)]
        common, mine, other = words[:64], words[64:94], words[94:125]
        for kind, tail in ((0, mine), (1, other)):
            rows.append((2 * group + kind, " ".join(common + tail)))
    docs = spark.createDataFrame([rows[i] for i in rng.permutation(200)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.NearDuplicates(docs, percent=45).groups().collect()}
    assert found == {i: i - i % 2 for i in range(200)}
    assert len(set(r["component_id"] for r in near_duplicates.NearDuplicates(docs).groups().collect())) == 200


def test_pairs_that_are_near_but_not_linked_do_not_leave_the_join(spark):
    """A ball whose pairs are mostly near: what is compared follows the links, and holds them all."""
    rng = random.Random(12)
    base, rows = [f"v{i}" for i in range(146)], []
    for i in range(150):
        copy = list(base)
        for place in rng.sample(range(146), rng.randrange(4)):
            copy[place] = f"e{i}x{place}"
        rows.append((i, " ".join(copy)))
    near = near_duplicates.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    pairs = {(r["a"], r["b"]) for r in near._across(near.classes.select("row", near.classes["row"].alias("label"))).collect()}
    own = {r["row"]: shingles(r["doc"]["text"]) for r in near.rows.join(near.classes, "row", "left_semi").collect()}
    linked = {(x, y) for x in own for y in own if x < y and 100 * len(own[x] & own[y]) >= 85 * len(own[x] | own[y])}
    assert len(linked) > 800 and linked <= pairs
    assert len(pairs) <= 1.1 * len(linked)


def test_parities_differ_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(2)
    for n in (1, 30, 400, 5000):
        first = np.unique(rng.integers(0, 2**64, n, np.uint64))
        second = np.unique(np.concatenate([first[n // 10:], rng.integers(0, 2**64, n // 10, np.uint64)]))
        places = np.unpackbits((near_duplicates.parities(first) ^ near_duplicates.parities(second)).view(np.uint8)).sum()
        assert places <= len(np.setxor1d(first, second))
