"""Encoding, packing, token files, counts, language, decontamination, scoring and URL filters."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import public_tokenizers
import pytest

from freightlens.llm import decontaminate, language, language_model, packing, token_counts, token_files, url_filter
from freightlens.llm.tokens import Encoder
from freightlens.session import scratch_path

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
LONG = " ".join(f"word{i}" for i in range(5000))
TEXTS = ["Hello there, world.", "", None, "  two  spaces\n\n", LONG, "naïve Été.", "a\0b", "x" * 3000, "<|endoftext|> end"]


@pytest.fixture(scope="module")
def docs(spark):
    def make(texts, ids=None):
        data = [(i, t, "en", "s", 1, 9, 9) for i, t in zip(ids or range(len(texts)), texts)]
        schema = "doc_id long, text string, lang string, source string, length long, ids int, sequence_id int"
        return spark.createDataFrame(data, schema).repartition(2)

    return make


def library_ids(path, text):
    return Encoder(path).library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library(path):
    rng = random.Random(7)
    bits = [" ", "  ", "\n", "\n\n", "\t", "'s", "don't", "a", "é", "é", "́", "12", ".", "...", ",", "Word", "WORD.",
            "\u0085", " ", "Σ", "<|endoftext|>", "<|ENDOFTEXT|>", "\0", "\U0001f600", "\r\n", " ", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(4000)] + [t or "" for t in TEXTS]
    use = Encoder(path, cache_words=500)
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        ids, ends = use.encode(some)
        want = [e.ids for e in use.library.encode_batch(some, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_cuts_bytes_where_the_rules_cut(path):
    rng = random.Random(11)
    bits = [" ", " ", "\n", "  ", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2009", "\u2028", "\u202f", "\u3000", "\u200b", "’", "…", "“a”",
            "a", "Be", "É", "é", "ß", "ŉ", "ſ", "×", "÷", "Ж", "ж", "中", "\u0301", "J\u030c", "H\u0331", "İ", "K", ".", ",", "!!", "$$$", "&&&",
            "***", ")", ":", "#1", "%", "'s", "'", "_", "0", "\0", "\t", "\U0001f600"]
    for some in (bits, [b for b in bits if "\u030c" not in b and "\u0331" not in b and b != "\u0301"]):
        texts = ["".join(rng.choice(some) for _ in range(rng.randrange(9))) for _ in range(4000)]
        use = Encoder(path, cache_words=700)
        for at in range(0, len(texts), 800):
            part = texts[at : at + 800]
            ids, ends = use.encode(part)
            want = [e.ids for e in use.library.encode_batch(part, add_special_tokens=False)]
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
            assert use.lengths(part).tolist() == [len(w) for w in want]
    assert use.lengths([]).tolist() == [] and use.lengths(["", ""]).tolist() == [0, 0] and use.encode(["", ""])[1].tolist() == [0, 0, 0]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_learns_a_word_once_whatever_punctuation_follows(path):
    use = Encoder(path)
    text = "x" + "".join(f" {w}{mark}" for w in ("word", "früh", "été") for mark in ("", ".", ",", "!!", "$$$", "***", "&&&", "%%%", "###", ")."))
    ids, _ = use.encode([text])
    assert ids.tolist() == library_ids(path, text)
    learned = {w.strip(" .,!$*&%#)") for w in use.cache} - {""}
    assert learned == {"x", "word", "früh", "été"} and len([w for w in use.cache if w.strip(" ")[:1].isalpha()]) == 4


def test_packing(docs):
    table = docs(TEXTS + ["again"] * 200)
    packed = packing.pack_documents(table, BYTES, end_id=0, window=64, shard_docs=50)
    whole = {i: library_ids(BYTES, t) + [0] for i, t in enumerate(TEXTS + ["again"] * 200)}
    seen, used = {i: [] for i in whole}, {}
    for r in packed.collect():
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length <= 64 and r.doc_tokens == len(whole[r.doc_id])
        seen[r.doc_id].append((r.start, own))
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in seen.items():
        assert [x for _, p in sorted(parts) for x in p] == whole[i]
        assert all(s % 64 == 0 for s, _ in parts)
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(map(len, whole.values()))
    assert total / (64 * len(used)) > 0.9
    made = {r.sequence_id: (r.length, len(r.ids) // 4) for r in packing.sequences(packed).collect()}
    assert all(a == b for a, b in made.values()) and set(made) == set(used)
    assert packing.pack_documents(docs([]), BYTES, end_id=0).count() == 0


def test_best_fit_is_tightest():
    rng = random.Random(1)
    windows, plain = packing.OpenWindows(100), []
    for sequence in range(3000):
        length = rng.randrange(1, 101)
        found = windows.take(length)
        fits = [room for room in plain if room >= length]
        assert (found is None) == (not fits)
        if found:
            assert found[0] == min(fits)
            plain.remove(found[0])
        if rng.random() < 0.7:
            room = rng.randrange(1, 101)
            windows.add(room, sequence, 0)
            plain.append(room)


def test_token_files(spark, docs):
    ids = [7, 3, None, 12, 5, 5, 40, 41, 42]
    table = docs(TEXTS, ids)
    path = scratch_path(spark, "test-orc")
    token_files.write_ids(table, path, WORDS, end_id=2, file_docs=3)
    back = token_files.read_ids(spark, path)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_files.with_crc32(token_files.with_start(back).select("doc_id", "start", "n_tokens", "ids")).collect()))
    order = sorted(zip(ids, TEXTS), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    want, start = [], 0
    for i, t in order:
        own = library_ids(WORDS, t) + [2]
        want.append((i is not None, i or 0, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert got == sorted(want)
    plan = back.where("doc_id = 40")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,40)" in plan
    assert back.where("doc_id = 40").count() == 1
    empty = token_files.written(spark, docs([]), WORDS, 2)
    assert token_files.with_start(empty).count() == 0


def test_token_counts_are_idempotent(spark, docs):
    table = docs(TEXTS)
    counts = token_counts.count_tokens(table, {"b": BYTES, "w": WORDS})
    by_hand = {v: sum(len(library_ids(p, t)) for t in TEXTS) for v, p in (("b", BYTES), ("w", WORDS))}
    rollup = token_counts.Rollup(spark, scratch_path(spark, "test-rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit("day-1", token_counts.change(counts, 1))
    assert not rollup.commit("day-1", token_counts.change(counts, 1))
    got = {r.tokenizer: (r.source, r.lang, r.documents, r.tokens) for r in rollup.totals().collect()}
    assert got == {v: ("s", "en", len(TEXTS), n) for v, n in by_hand.items()}
    gone = counts.where("doc_id = 4")
    rollup.commit("day-2", token_counts.change(gone, -1))
    left = {r.tokenizer: r.tokens for r in rollup.totals().collect()}
    assert left == {"b": by_hand["b"] - len(library_ids(BYTES, LONG)), "w": by_hand["w"] - len(library_ids(WORDS, LONG))}
    rollup.commit("day-3", token_counts.change(counts.where("doc_id <> 4"), -1))
    assert rollup.totals().count() == 0 and rollup.batches() == ["day-1", "day-2", "day-3"]
    with pytest.raises(ValueError):
        rollup.commit("../x", token_counts.change(counts, 1))


def test_op6_against_brute_force(spark):
    from freightlens.llm.registry import op6_token_counts

    folder = "/root/testdata/sf0.001"
    want: Counter = Counter()
    libraries = {"byte_bpe_50k": Encoder(BYTES).library, "word_bpe_49k": Encoder(WORDS).library}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r.doc_id % 10 == 0:
            continue
        text = r.text or ""
        if r.doc_id % 10 == 1:
            text = text[text.index("\n") + 1 :] if "\n" in text else ""
        for v, lib in libraries.items():
            want[r.source, r.lang, v, "d"] += 1
            want[r.source, r.lang, v, "t"] += len(lib.encode(text, add_special_tokens=False).ids)
    got: Counter = Counter()
    for r in op6_token_counts(spark, folder).collect():
        got[r.source, r.lang, r.tokenizer, "d"] = r.documents
        got[r.source, r.lang, r.tokenizer, "t"] = r.tokens
    assert +got == +want


def test_language(spark):
    rng = random.Random(0)
    letters = {"aa": "abcde", "bb": "efghié", "cc": "xyzαβ"}
    data = []
    for i in range(300):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(20))
        data.append((i, text, lang if i % 10 else None, "s", 0.5))
    data += [(1000, None, "aa", "s", 0.0), (1001, "", "aa", "s", 0.0), (1002, "123 !?", "bb", None, 0.0), (None, "abc abd", "aa", "s", 0.0),
             (1003, "abcde " * 50_000, "aa", "s", 0.0)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, score double").repartition(3)
    got = {r.doc_id: r for r in language.identify(table).collect()}
    assert len(got) == len(data)
    for i, _, lang, _, _ in data[:300]:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert lang is None or got[i].lang_pred == lang
        assert 0 <= got[i].score <= 1
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "aa", "aa"]
    kept = language.keep_identified(table)
    assert kept.columns == table.columns and kept.count() == len(data) - 3
    none = language.identify(table.where("false"))
    assert none.count() == 0
    assert {r.lang_pred for r in language.identify(table.withColumn("lang", table["lang"].substr(9, 1)).where("lang is null")).collect()} <= {"und", ""}


def test_held_out_accuracy(spark):
    found = language.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(truth, "doc_id").where("lang is not null")
    assert held.where("lang = lang_pred").count() / held.count() > 0.98


def test_decontamination(spark, docs):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(6)]
    filler = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    edited = items[2].split()
    for at in (4, 11, 19, 27, 33):
        edited[at] = "changed"
    del edited[22]
    texts = [filler(300), f"{filler(50)} {items[0]} {filler(50)}", items[1].upper().replace(" ", ", "), f"{filler(99)} {' '.join(edited)}",
             None, "", "v1 v2", f"{filler(40_000)} {items[3]} {filler(10)}", items[0], items[0]]
    table = docs(texts)
    bench = spark.createDataFrame([*enumerate(items), (90, "too short"), (91, None), (None, "v1 v2 v3 v4"), (92, "")], "item_id long, text string")
    want = {(1, 0), (2, 1), (3, 2), (7, 3), (8, 0), (9, 0)}
    for block_words in (1_000_000, 50):
        found = decontaminate.contaminated(table, bench, block_words=block_words).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want
    scores = {r.doc_id: r.score for r in found}
    assert scores[1] == scores[8] == 1 and 0.5 < scores[3] < 1
    spans = {r.doc_id: (r.first_word, r.last_word) for r in found}
    assert spans[1] == (50, 89) and spans[8] == (0, 39)
    clean = decontaminate.drop_contaminated(table, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [0, 4, 5, 6] and clean.columns == table.columns
    assert decontaminate.contaminated(docs([]), bench).count() == 0
    assert decontaminate.contaminated(table, bench.where("false")).count() == 0


def test_copies_with_edits_in_every_stretch(spark, docs):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(6)]
    items = [" ".join(rng.choice(common) if rng.random() < 0.5 else f"i{i}x{k}" for k in range(36)) for i in range(4)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    copies = [(i, " ".join(f"new{k}" if k % every == off else w for k, w in enumerate(item.split())))
              for i, item in enumerate(items) for every in (4, 5, 6, 7) for off in (1, 3)]
    filler = [" ".join(rng.choice(common) for _ in range(200)) for _ in range(5)]
    for beside in ([], items):
        texts = [f"{rng.choice(filler)} {t} {rng.choice(filler)}" for _, t in copies] + filler + beside
        want = {}
        for d, text in enumerate(texts):
            numbers = {w: k for k, w in enumerate(text.split(), 1)}
            for i, item in enumerate(items):
                own = np.array([numbers.get(w, -1 - k) for k, w in enumerate(item.split())])
                score = decontaminate.align(own, np.array([numbers[w] for w in text.split()]))[0] / (2 * len(own))
                if score >= 0.5:
                    want[d, i] = score
        assert {(d, i) for d, (i, _) in enumerate(copies)} <= set(want)
        found = decontaminate.contaminated(docs(texts), bench).collect()
        assert {(r.doc_id, r.item_id): r.score for r in found} == want


def test_alignment_score_equals_the_table():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(0, 5) for _ in range(rng.randrange(0, 20))]
        best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
                table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] + decontaminate.GAP, table[i][j - 1] + decontaminate.GAP)
                best = max(best, table[i][j])
        score, first, last = decontaminate.align(np.array(a), np.array(b, int))
        assert score == best
        if best:
            again, _, _ = decontaminate.align(np.array(a), np.array(b[first : last + 1], int))
            assert again == best


@pytest.mark.parametrize(("order", "share"), [(2, 100_000), (2, 3), (3, 50), (3, 100_000)])
def test_language_model(docs, order, share, monkeypatch):
    monkeypatch.setattr(language_model, "HOT_SHARE", share)
    rng = random.Random(order)
    texts = [" ".join(f"w{min(rng.randrange(12), rng.randrange(12))}" for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [None, "", "W1 w1", "rare words only here"]
    found = {r.doc_id: r for r in language_model.score(docs(texts), order=order, size=8).collect()}
    split = [(t or "").lower().split() for t in texts]
    total = Counter(w for s in split for w in s)
    low = min((c for c in set(total.values()) if c >= 2 and sum(v >= c for v in total.values()) <= 8), default=10**9)
    top = {w for w in total if total[w] >= low}
    assert 3 <= len(top) <= 8
    grams = {k: Counter(tuple(s[i : i + k]) for s in split for i in range(len(s) - k + 1)) for k in (1, 2, 3)}
    n = sum(total.values())

    def word(context, w):
        if not context:
            return math.log(grams[1][(w,)] / n)
        key = (*context, w)
        if grams[len(key)][key] >= 2:
            return math.log(grams[len(key)][key] / grams[len(key) - 1][key[:-1]])
        return math.log(0.4) + word(context[1:], w)

    for i, s in enumerate(split):
        want = sum(word(tuple(s[max(0, k - order + 1) : k]), w) for k, w in enumerate(s))
        assert found[i].n_words == len(s) and abs(found[i].logprob - want) < 1e-6
        assert (found[i].per_word is None) == (not s)
    assert language_model.score(docs([]), order=order).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_tells_words_beyond_its_vocabulary_apart(docs, order):
    texts = ["a a a rare pair a", "a a rare pair rare", "pair rare a a a once", "rare rare a pair", "once more"]
    wide, narrow = (
        {r.doc_id: (r.n_words, round(r.logprob, 9)) for r in language_model.score(docs(texts), order=order, size=n).collect()}
        for n in (100, 1)
    )
    assert wide == narrow


def test_language_model_cuts_words_as_white_space_does():
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u2003", "A", "bC", "É", "\0", ".", "\U0001f600"]
    texts = ["", " ", *("".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(500)), ""]
    words, sizes = language_model.cut(texts)
    want = [t.encode().lower().split() for t in texts]
    assert words.to_pylist() == [w for ws in want for w in ws] and sizes.tolist() == [len(ws) for ws in want]


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_has_no_row_for_each_ngram(docs, order, monkeypatch):
    """A row of its own for each word and n-gram, in shuffles and joins, took most of the time."""
    rng = random.Random(order)
    texts = [" ".join(f"w{int(1000 * rng.random() ** 2)}" for _ in range(1000)) for _ in range(20)]
    rows, keep = [], language_model.materialize

    def counted(df, label, **options):
        out = keep(df, label, **options)
        rows.append(out.count())
        return out

    monkeypatch.setattr(language_model, "materialize", counted)
    found = language_model.score(docs(texts), order=order)
    assert found.count() == len(texts) and 0 < sum(rows) < 200
    pairs = Counter(pair for t in texts for pair in zip(t.split(), t.split()[1:]))
    assert sum(n >= 2 for n in pairs.values()) > 500  # so many in the model


def test_url_filter(spark):
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    urls = ["http://user:pw@A.b.Example.com:80/x/y?q#f", "https://example.com", "http://other.org/x", None, "nonsense", "http://localhost/",
            "http://example.com./x//y/z"]
    captures = spark.createDataFrame([(10 * i + d, u, day(d), "k") for i, u in enumerate(urls) for d in (0, 5, 9)] + [(99, urls[0], None, "k")],
                                     "page_id long, url string, fetched date, key string")
    entries = [("l1", "block", "example.com", True, day(2)), ("l1", "block", "example.com", False, day(7)), ("l2", "allow", "b.example.com", True, day(0)),
               ("l3", "block", "b.example.com", True, day(8)), ("l1", "block", "other.org/x", True, day(5)), ("l1", "block", "other.org/x", False, day(5)),
               ("l9", "block", None, True, day(0)), ("l9", "block", "localhost", True, None), ("l4", "block", "example.com/x/y", True, day(9)),
               ("l4", "block", "localhost", None, day(0))]
    table = spark.createDataFrame(entries, "list_name string, kind string, key string, listed boolean, dated date")

    def keys(url):
        import re

        m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)", url or "")
        if not m or not m[1]:
            return "", []
        host = m[1].lower().removesuffix(".")
        labels, parts = host.split("."), [p for p in m[2].split("/") if p]
        return host, [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))] + [f"{host}/{'/'.join(parts[: i + 1])}" for i in range(len(parts))]

    def active(key, on):
        for name, kind in {(e[0], e[1]) for e in entries}:
            dated = [e for e in entries if e[:2] == (name, kind) and e[2] == key and e[4] is not None and e[4] <= on]
            if dated:
                last = max(e[4] for e in dated)
                if any(e[3] for e in dated if e[4] == last):
                    yield name, kind

    for r in url_filter.judge(captures, table).collect():
        url, on = next((c.url, c.fetched) for c in captures.collect() if c.page_id == r.page_id)
        host, own = keys(url)
        hits = [(k, n, kind) for k in own for n, kind in (active(k, on) if on else ())]
        best = min(hits, key=lambda h: (-len(h[0]), [-ord(c) for c in h[0]], h[2] != "block", h[1]), default=(None,) * 3)
        assert (r.host, r.n_active, r.key, r.list_name, r.kind) == (host, len(hits), *best)
        assert r.blocked == (best[2] == "block")
    assert url_filter.judge(captures, table).count() == captures.count()
    assert url_filter.judge(captures.where("false"), table).count() == 0
    assert url_filter.judge(captures, table.where("false")).where("blocked").count() == 0


def test_url_filter_tells_capitals_of_paths_apart(spark):
    day = date(2024, 1, 1)
    urls = ["http://Example.com/Foo/Bar", "http://example.com/foo", "http://EXAMPLE.com/a/Q", "http://other.org/x", "http://other.org/X?y"]
    captures = spark.createDataFrame([(i, u, day) for i, u in enumerate(urls)], "page_id long, url string, fetched date")
    entries = [("l", "block", k, True, day) for k in ("example.com/Foo", "EXAMPLE.com/a/Q", "Other.ORG/x", "É.example.com/É")]
    table = spark.createDataFrame(entries, "list_name string, kind string, key string, listed boolean, dated date")
    found = {r.page_id: r.key for r in url_filter.judge(captures, table).collect()}
    assert found == {0: "example.com/Foo", 1: None, 2: "example.com/a/Q", 3: "other.org/x", 4: None}
    assert {r.key for r in url_filter.validity(table).collect()} == {"example.com/Foo", "example.com/a/Q", "other.org/x", "é.example.com/É"}
