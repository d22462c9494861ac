"""Whitening, the conversation trie and MinHash near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from freightlens.llm import minhash, whitening
from freightlens.llm.common import ordered
from freightlens.llm.conversation_trie import conversation_trie, ranked
from freightlens.llm.whitening import whiten

# --- whitening ----------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, n long, x array<int>, component int, d string"


@pytest.fixture(scope="module")
def vectors(spark):
    """A table of (vec_id, vector) rows with further columns named as the operator's own."""

    def make(pairs):
        return spark.createDataFrame([(i, v, 1, 7, [1], 3, "x") for i, v in pairs], VECTORS).repartition(3)

    return make


def exact_fit(pairs):
    """x of every usable row, the fit list, n times each deviation vector and the exact covariance."""
    usable = [(i, v) for i, v in pairs if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {k: tuple(math.floor(64 * Fraction(c)) + 1_000_000 for c in v) for k, (_, v) in enumerate(usable)}
    fit = sorted(set(x.values()))
    n, d = len(fit), len(fit[0])
    total = [sum(v[j] for v in fit) for j in range(d)]
    cov = [[Fraction(sum(v[i] * v[j] for v in fit), n) - Fraction(total[i] * total[j], n * n) for j in range(d)] for i in range(d)]
    away = {k: [n * a - s for a, s in zip(v, total)] for k, v in x.items()}
    return usable, fit, away, np.array([[float(c) for c in row] for row in cov])


def check_whitening(pairs, got, components=16):
    usable, fit, away, cov = exact_fit(pairs)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, len(cov))
    assert len(got) == k * len(usable)
    assert {r.n for r in got} == {len(fit)}
    want = Counter()
    for r, (i, _) in enumerate(usable):
        square = sum(a * a for a in away[r])
        want[i, square if square < 1 << 63 else None] += k
    assert Counter((r.vec_id, r.deviation) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, rows in by.items():
        share = values[c - 1] / np.trace(cov)
        assert all(abs(r.explained - share) <= 1e-4 * share + 1e-15 for r in rows)
        if values[c - 1] < 1e-9 * values[0]:
            assert all(r.whitened is None for r in rows)
            continue
        own = [float(np.dot(np.array(away[r], float) / len(fit), axes[:, c - 1]) / math.sqrt(values[c - 1])) for r in range(len(usable))]
        mine = sorted(r.whitened for r in rows)
        same, turned = (max(abs(a - b) for a, b in zip(mine, sorted(s * v for v in own))) for s in (1, -1))
        assert min(same, turned) < 1e-7
    assert all(r.identity_error < 1e-4 for r in got)


def test_whitening_against_exact_fractions(vectors):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(20, 20))
    pairs = [(i, (rng.normal(size=20) @ mix / 9).tolist()) for i in range(300)]
    pairs += [(1000 + i, pairs[3][1]) for i in range(150)]  # a third of all rows hold one vector
    pairs += [(3, pairs[3][1]), (None, pairs[5][1]), (7, None), (8, [None] * 20), (9, [math.nan] + [0.0] * 19)]
    pairs += [(10, [math.inf] * 20), (11, [-math.inf] * 20)]
    check_whitening(pairs, whiten(vectors(pairs)).collect())


def test_whitening_of_wide_and_negative_ranges(vectors):
    rng = np.random.default_rng(2)
    pairs = [(i, [float(rng.normal()) * 3000, -float(rng.integers(0, 9)), 0.1 * i]) for i in range(70)]
    check_whitening(pairs, whiten(vectors(pairs)).collect())
    pairs = [(i, [float(rng.normal()) * 10**6, float(rng.normal()) * 10**5]) for i in range(70)]
    got = whiten(vectors(pairs)).collect()
    check_whitening(pairs, got)
    assert any(r.deviation is None for r in got) and any(r.deviation for r in got)


def test_whitening_of_little(vectors):
    assert whiten(vectors([])).count() == 0
    assert whiten(vectors([(1, None), (2, []), (3, [math.nan])])).count() == 0
    (row,) = whiten(vectors([(1, [0.5])])).collect()
    assert tuple(row) == (1, 1, 1, 0, None, None, None)
    # The commonest length counts, and of two the longer; what has no 64-bit x is left out.
    pairs = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0]), (4, [2.0]), (5, [1e300, 0.0]), (6, [1.0, 1.0]), (7, [3.0])]
    assert {r.vec_id for r in whiten(vectors(pairs)).collect()} == {1, 2, 6}


def test_constant_dimension_has_no_whitened_value(vectors):
    pairs = [(i, [float(i), 5.0, float(i % 3)]) for i in range(30)]
    got = whiten(vectors(pairs)).collect()
    check_whitening(pairs, got)
    assert all(r.whitened is None for r in got if r.component == 3)


def test_bit_planes_give_exact_cross_products():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 1 << 62, (130, 3))
    y[:, 1] = 0
    widths = [int(v).bit_length() for v in y.max(axis=0)]
    got = whitening._weigh(whitening._counts(whitening._planes(y.view(np.uint64), widths)), widths)
    for i in range(3):
        for j in range(i, 3):
            assert got[i][j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


# --- conversation trie --------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, size string, pos long, c int, last string"


@pytest.fixture(scope="module")
def talks(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 9, "x", 5, 3, "y") for r in rows], TURNS).repartition(4)

    return make


def _lanes(role, text):
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return [int.from_bytes(bytes.fromhex(digest[16 * i : 16 * i + 16]), signed=True) for i in range(4)]


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), _lanes(role or "", text or ""), role or "", text or ""))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        own_bytes = (len(who) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own_bytes
            leaves[p[:d]] += p not in children
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(whole[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(who), len(p), above, len(who), children[p], leaves[p], saved[p], digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [2, 10_000])
def test_trie(talks, block):
    rng = random.Random(block)
    openings = ["hello", "Hello", "", "é" * 9]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 13)):
            text = rng.choice(openings) if t < 3 else f"{rng.randrange(3)} {t}"
            rows.append((c, t * rng.choice([1, 2]), ("user", "assistant")[t % 2], text))
    # One conversation with a third of all turns, its copy, and odd rows.
    rows += [(c, t, "user", f"{t % 7}") for c in (200, 300) for t in range(150)]
    rows += [(61, None, None, None), (61, 3, "user", None), (61, 3, "user", None), (61, 3, None, "b"), (None, 1, "user", "lost")]
    rows += [(64, 0, "us", "er"), (63, 0, "user", ""), (10**12, 0, "user", "big")]
    assert found(conversation_trie(talks(rows), block)) == brute_trie(rows)


def test_trie_of_one_crowded_node(talks, monkeypatch):
    from freightlens.llm import conversation_trie as module

    monkeypatch.setattr(module, "CHUNK", 10)
    rows = [(c, t, "user", "same") for c in range(400) for t in range(10)]
    assert found(conversation_trie(talks(rows), 7)) == brute_trie(rows)


def test_trie_of_nothing(talks):
    assert conversation_trie(talks([])).count() == 0
    assert conversation_trie(talks([(None, 1, "a", "b")])).count() == 0
    # Conversation 1 takes turns from 0, which does not exist, and leaves out its own.
    assert zlib.crc32(b"1") % 9 > 0
    (root,) = conversation_trie(talks([(1, 0, "user", "x")])).collect()
    assert tuple(root) == (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())


def test_list_ranking(spark):
    order = list(range(-2, 35))
    random.Random(4).shuffle(order)
    arcs = list(zip(order, [*order[1:], None]))
    got = {r.arc: r.pos for r in ranked(spark.createDataFrame(arcs, "arc long, next long"), len(order)).collect()}
    assert got == {a: i for i, a in enumerate(order)}


def test_positions_are_dense_and_ordered(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(1000)]
    got = ordered(spark.createDataFrame(rows, "a long, b long").repartition(5), "a", "b").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.pos)] == sorted(rows)
    assert sorted(r.pos for r in got) == list(range(1000))


# --- MinHash ------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, node long, n long, signature string, token long, posted int, tile long, pos long"


@pytest.fixture(scope="module")
def texts(spark):
    def make(pairs, parts=3):
        return spark.createDataFrame([(i, t, 1, 2, "s", 3, 4, 5, 6) for i, t in pairs], DOCS).repartition(parts)

    return make


def brute_near(pairs, percent=85):
    sets = []
    for _, t in pairs:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for j, s in enumerate(sets):
        if pairs[j][0] is None:
            continue
        common = Counter(k for x in s for k in having[x])
        for k, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[k]) - both):
                root[find(j)] = find(k)
        for x in s:
            having[x].append(j)
    low = {}
    for j, (i, _) in enumerate(pairs):
        if i is not None:
            low[find(j)] = min(i, low.get(find(j), i))
    return sorted(((i, len(s), None if i is None else low[find(j)], i is None or low[find(j)] == i) for j, ((i, _), s) in enumerate(zip(pairs, sets))), key=str)


def edited(rng, base, edits):
    copy = list(base)
    for at in rng.sample(range(len(base)), edits):
        copy[at] = f"new{rng.randrange(10**9)}"
    return " ".join(copy)


@pytest.mark.parametrize("sizes", [{}, {"short": 2, "block": 3}])
def test_minhash_against_brute_force(texts, sizes):
    rng = random.Random(5)
    out = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        out.append(" ".join(base))
        out += [edited(rng, base, rng.randrange(1, 8)) for _ in range(4)]
    out += [out[3].upper(), out[3], f"{out[7]}  \n", "one two", "ONE\ttwo", "one two three", "", None, " \n", "é", "É"]
    license_line = " ".join(f"l{i}" for i in range(30))
    out += [f"{license_line} {' '.join(f'x{rng.randrange(9999)}' for _ in range(rng.randrange(4, 60)))}" for _ in range(80)]
    pairs = [(3 * i + 1, t) for i, t in enumerate(out)]
    pairs += [(1, out[0]), (4, out[30]), (None, out[0]), (None, None), (-5, out[1]), (9999, " ".join(f"w{i % 4000}" for i in range(30_000)))]
    got = found(minhash.near_duplicates(texts(pairs), **sizes))
    assert got == brute_near(pairs)


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 8), (3, 40)])
def test_minhash_of_a_loose_group(texts, seed, parts):
    """300 copies of one text with 1.5 % of words replaced: most pairs are just below the similarity."""
    rng = random.Random(seed)
    base = [f"g{i}" for i in range(400)]
    pairs = [(i, edited(rng, base, 6)) for i in range(300)]
    got = found(minhash.near_duplicates(texts(pairs, parts), short=20, block=50))
    assert got == brute_near(pairs)


def test_minhash_of_nothing(texts):
    assert minhash.near_duplicates(texts([])).count() == 0
    got = found(minhash.near_duplicates(texts([(1, None), (2, ""), (None, "a")])))
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True)], key=str)


def test_a_close_group_is_never_paired(texts):
    """A group whose classes all resemble its first one costs a pair each, and leaves nothing to the blocks."""
    rng = random.Random(6)
    base = [f"g{i}" for i in range(400)]
    table = texts([(i, edited(rng, base, 1)) for i in range(200)])
    placed = ordered(minhash.prints(table), "set_key", "doc_id")
    distinct = minhash.classes(placed)
    posted = minhash.postings(distinct)
    heads = minhash.list_heads(posted.where("holders > 20"))
    pairs = minhash.head_pairs(heads)
    assert 150 < pairs.count() <= 5 * 200
    roots = minhash.components(minhash.confirmed(pairs, distinct, table))
    assert roots.select("root").distinct().count() == 1
    assert minhash.far_links(heads, roots, distinct, table).count() == 0


def test_common_elements_of_sets():
    rng = np.random.default_rng(7)
    a, b = ([np.unique(rng.integers(0, 200, rng.integers(1, 60)).astype(np.uint64)) for _ in range(k)] for k in (7, 9))
    for columns in (1, 50, 4096):
        assert minhash.common(a, b, columns).tolist() == [[len(set(x) & set(y)) for y in b] for x in a]
    assert minhash.common(a, [np.array([999], np.uint64)]).tolist() == [[0]] * 7


# --- registered SQL -----------------------------------------------------------------------------------------------


def test_sql_covers_the_odd_rows(talks, texts):
    """The SQL gives brute force's rows too where nulls, ties and empty texts are at hand."""
    import duckdb

    from freightlens.llm.oracles import NEAR, TRIE

    rows = [(c, t, "user", f"{(c + t) % 3}") for c in range(25) for t in range(9)] + [(30, None, None, None), (31, 0, "u", None)]
    con = duckdb.connect()
    con.register("conversations", talks(rows).toPandas())
    assert sorted((tuple(int(v) if isinstance(v, float) and v == v else v for v in r) for r in con.execute(TRIE).fetchall()), key=str) == brute_trie(rows)
    pairs = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, None), (4, "x"), (5, "X"), (6, "")]
    con.register("documents", texts(pairs).toPandas())
    assert sorted(con.execute(NEAR).fetchall(), key=str) == brute_near(pairs)
