import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import graph, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def near_prints(seed, groups=30, size=12):
    """Chains and clouds of fingerprints with few differing bits, and lone ones."""
    rng = random.Random(seed)
    out = set()
    for _ in range(groups):
        p = rng.getrandbits(64)
        for _ in range(rng.randrange(1, size)):
            out.add(p)
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                p ^= 1 << b
    return sorted(out)


def test_fingerprints_equal_plain_ones(odd_rows):
    texts = [t or "" for _, t in odd_rows] + ["A b", "a B c", "a b c d"]
    assert simhash.fingerprints_of(texts).tolist() == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprints_of([]).tolist() == []


def test_patterns_are_the_coset_words():
    patterns = simhash.error_patterns(2)
    assert sum(map(len, patterns)) == 1 + 31 + 31 * 30 // 2
    assert all(bin(p[0]).count("1") <= 1 for p in patterns)  # the covering radius is 1
    assert {len(p) for p in patterns[1:]} == {16} and len(patterns[0]) == 1


def test_linked_pairs_meet_at_a_home_anchor():
    rng = random.Random(4)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randrange(0, 3)):
            y ^= 1 << b
        rows = [simhash.anchor_rows(np.array([p], dtype=np.uint64).view(np.int64), 1, {}) for p in (x, y)]
        homes = {(a, p) for a, p, v in zip(*[c.tolist() for c in rows[0][:3]]) if v == 0}
        assert homes & set(zip(rows[1][0].tolist(), rows[1][1].tolist()))


def components_of(spark, prints, **options):
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    found = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(5), **options)
    roots = {r.fp & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in found.collect()}
    groups = {}
    for p in prints:
        groups.setdefault(roots.get(p, p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def expected_components(prints):
    groups = {}
    for p, r in brute_components(prints).items():
        groups.setdefault(r, set()).add(p)
    return sorted(map(sorted, groups.values()))


def test_components_equal_all_pairs(spark):
    prints = near_prints(1)
    assert components_of(spark, prints) == expected_components(prints)


def test_split_anchors_lose_no_link(spark):
    center = 0x1234_5678_9ABC_DEF0
    rng = random.Random(9)
    crowd = {center} | {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in rng.sample(range(64), 6)}
    prints = sorted(crowd | set(near_prints(2)))
    assert components_of(spark, prints, part_size=4) == expected_components(prints)


def test_large_groups_lose_no_link():
    rng = random.Random(3)
    base = rng.getrandbits(64)
    members = np.array(sorted({base ^ (rng.getrandbits(10) << 40) for _ in range(700)}), dtype=np.uint64)
    a, b = simhash._near(members, members, 2)
    linked = {p: p for p in members.tolist()}
    for x, y in zip(a.tolist(), b.tolist()):
        linked[x] = y
    assert len({p for p in members.tolist() if linked[p] == p}) == len(set(brute_components(members.tolist()).values()))


def test_forest_and_stars_agree(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    stars = {(r.fp, r.root) for r in found.collect()}
    x, y = graph.forest(*(np.array(c) for c in zip(*edges)))
    assert stars == set(zip(x.tolist(), y.tolist()))
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(make_docs, odd_rows):
    rows = odd_rows + [(40, prose(40, 400)), (41, prose(40, 400).upper()), (42, prose(40, 400) + " end")]
    docs = make_docs(rows)
    found = simhash.simhash_components(docs, F.col("doc_id"), F.col("text")).collect()
    assert len(found) == len(rows)
    prints = {t: brute_fingerprint(t) for _, t in rows}
    assert sorted((str(i), prints[t]) for i, t in rows) == sorted((str(r.doc_id), r.fp & (1 << 64) - 1) for r in found)
    roots = brute_components(sorted(set(prints.values())))
    for r in found:
        members = [i for i, t in rows if i is not None and roots[prints[t]] == roots[r.fp & (1 << 64) - 1]]
        assert r.component_id == (min(members) if members else None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    chosen = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in chosen if i is not None) == sorted({r.component_id for r in found if r.component_id is not None})
    assert chosen.count(None) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_different_texts_under_one_id_stay(make_docs):
    docs = make_docs([(1, prose(1)), (1, prose(2)), (1, prose(2)), (2, prose(1)), (3, prose(3))])
    docs = docs.withColumn("__digest", F.lit("y")).withColumn("__chosen", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, prose(1)), (1, prose(2)), (3, prose(3))])
