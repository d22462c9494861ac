"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from conftest import rows

from freightlens.llm import exact_dedup, simhash, substring_dedup
from freightlens.llm.graph import components
from freightlens.llm.suffix_automaton import SuffixAutomaton

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def docs(spark):
    """Documents from (doc_id, text) pairs; further columns have names that the operators use themselves."""

    def make(pairs):
        data = [(i, t, "en", "s", 0, "x", 1, [1], "y") for i, t in pairs]
        clash = "digest string, n long, members array<int>, fp string"
        return spark.createDataFrame(data, f"{SCHEMA}, {clash}").repartition(3)

    return make


EDGES = [
    (1, "Hello World"), (2, "hello world"), (3, "HELLO world "), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "hello world"),
    (8, LONG), (9, LONG), (10, "x"), (10, "x"), (11, "x"), (11, "X"), (None, None), (12, " \t\n"),
]


def plain_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups_of(pairs):
    groups: dict[str, list] = {}
    for i, t in pairs:
        groups.setdefault(plain_lower(t), []).append(i)
    return groups


def brute_exact(pairs):
    """(doc_id, keep_id, group_size, digest) of every row."""
    groups = groups_of(pairs)
    out = []
    for i, t in pairs:
        own = groups[plain_lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), hashlib.sha256(plain_lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows", [1, 2, 10_000])
def test_exact_duplicates(docs, hot_rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10_000)
    found = exact_dedup.exact_duplicates(docs(EDGES), hot_rows=hot_rows)
    assert sorted((tuple(r) for r in found.drop("kept").collect()), key=str) == brute_exact(EDGES)
    kept = [r.keep_id for r in found.where("kept").collect()]
    assert len(kept) == len(groups_of(EDGES))
    assert all(r.doc_id == r.keep_id for r in found.where("kept").collect())


@pytest.mark.parametrize("hot_rows", [1, 10_000])
def test_a_weak_digest_never_merges_different_texts(docs, hot_rows):
    from pyspark.sql import functions as F

    weak = lambda c: (F.length(c) % 2).cast("string")
    found = exact_dedup.exact_duplicates(docs(EDGES), digest=weak, hot_rows=hot_rows)
    got = sorted(((r.doc_id, r.keep_id, r.group_size) for r in found.collect()), key=str)
    assert got == sorted((x[:3] for x in brute_exact(EDGES)), key=str)
    assert found.where("kept").count() == len(groups_of(EDGES))


def test_exact_keep_one_returns_whole_rows(docs):
    table = docs(EDGES)
    kept = exact_dedup.keep_one(table)
    assert kept.columns == table.columns
    assert kept.count() == len(groups_of(EDGES))
    assert ("hello world" in {r.text for r in kept.collect()}) and 9 in {r.doc_id for r in kept.collect()}
    assert exact_dedup.keep_one(docs([])).count() == 0
    assert exact_dedup.exact_duplicates(docs([])).count() == 0


def brute_fingerprint(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", plain_lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(docs):
    pairs = [p for p in EDGES if p[0] is not None] + [(20, "one two"), (21, "a b c d"), (22, "a\x0bb\x0cc d e f g h")]
    got = {r.doc_id: r.fp & (2**64 - 1) for r in simhash.fingerprints(docs(pairs)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in pairs}


@pytest.mark.parametrize("dense", [0, 1, 3, 64])
def test_links_connect_what_is_close(spark, dense):
    rng = random.Random(dense)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(25):
            s ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                s ^= 1 << rng.randrange(64)
            prints.add(s)
    prints |= {0, 2**64 - 1, 1, 3, 2**63}
    nodes = sorted(prints)
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    signed = lambda x: x - 2**64 if x >> 63 else x
    frame = spark.createDataFrame([(signed(x),) for x in nodes], "fp long")
    edges = simhash.links(frame, dense=dense)
    for r in edges.collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2
    root = {r.node & (2**64 - 1): r.root for r in components(edges).collect()}
    got: dict = {}
    for x in nodes:
        got.setdefault(root.get(x, ("alone", x)), set()).add(x)
    want: dict = {}
    for x in nodes:
        want.setdefault(find(x), set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(docs):
    base = " ".join(f"word{i % 97} other{i}" for i in range(400))
    pairs = EDGES + [(30, base), (31, base + " tail"), (32, base.upper()), (33, "something else entirely here")]
    pairs = [p for p in pairs if p[0] is not None]
    found = simhash.near_duplicates(docs(pairs))
    prints = {i: brute_fingerprint(t) for i, t in pairs}
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: find(i) for i in prints}
    assert found.count() == len(pairs)
    kept = simhash.keep_one(docs(pairs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in prints})
    assert kept.columns == docs(pairs).columns
    assert simhash.near_duplicates(docs([])).count() == 0


def test_near_duplicates_without_ids(docs):
    found = simhash.near_duplicates(docs([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, "q r s t u")]))
    assert sorted(((r.doc_id, r.component_id) for r in found.collect()), key=str) == sorted(
        [(None, 5), (None, 5), (5, 5), (None, None)], key=str
    )


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 9), (None, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {7: 3, 3: 3, 9: 3}


def test_suffix_automaton_counts():
    rng = random.Random(3)
    parts = [[rng.randrange(2) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
    times = [rng.randrange(1, 4) for _ in parts]
    automaton = SuffixAutomaton()
    for p, n in zip(parts, times):
        automaton.add(p, n)
    automaton.close()

    def occurrences(f):
        return sum(n * sum(p[i : i + len(f)] == f for i in range(len(p) - len(f) + 1)) for p, n in zip(parts, times))

    for least in (1, 3, 5):
        query = [rng.randrange(3) for _ in range(60)] + parts[0]
        for end, (size, count) in enumerate(automaton.statistics(query, least)):
            longest = max((k for k in range(end + 2) if occurrences(query[end + 1 - k : end + 1]) or k == 0), default=0)
            assert size == longest
            assert count == (occurrences(query[end + 1 - least : end + 1]) if longest >= least else 0)


def brute_repeats(pairs, window):
    texts = [(t or "").encode().split() for _, t in pairs]
    count: dict = {}
    for w in texts:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            count[key] = count.get(key, 0) + 1
    out = []
    for (i, _), w in zip(pairs, texts):
        gone = set()
        for s in range(len(w) - window + 1):
            if count[tuple(w[s : s + window])] > 1:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_runs", [0, 2, 2000])
def test_remove_repeats(docs, hot_runs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 10_000_000)
    rng = random.Random(hot_runs)
    pairs = []
    passages = [[f"p{k}_{rng.randrange(50)}" for _ in range(rng.randrange(8, 30))] for k in range(3)]
    for i in range(60):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 60))]
        for p in passages:
            if rng.random() < 0.4:
                at = rng.randrange(len(words) + 1)
                words[at:at] = p
        if i % 9 == 0:
            words += ["loop", "back"] * rng.randrange(10)
        if i % 11 == 0:
            words += ["same"] * rng.randrange(30)
        pairs.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    pairs += [(100, pairs[5][1]), (100, pairs[5][1]), (101, None), (102, ""), (None, pairs[7][1]), (103, "ab a"), (104, "a ba")]
    found = substring_dedup.remove_repeats(docs(pairs), window=7, seed=3, hot_runs=hot_runs)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()), key=str)
    assert got == brute_repeats(pairs, 7)
    for r in found.collect():
        assert sum(s.z - s.a for s in r.spans) == r.n_removed


def test_remove_repeats_of_long_texts_and_none(docs):
    got = rows(substring_dedup.remove_repeats(docs([(1, LONG), (2, "start " + LONG), (3, "z")])), "doc_id", "n_removed")
    assert got == [(1, 30_000), (2, 30_000), (3, 0)]
    assert substring_dedup.remove_repeats(docs([])).count() == 0
