"""Encoding whole texts with the tokenizers library, each distinct word once per worker.

A pre-tokenizer splits a text before the merges run, so the ids of a text are the ids of its parts in order, as long as
the cuts are places where it always splits:

* a single space or line feed between two other non-space characters, for byte-level rules, where a word carries its
  leading space and runs of white space belong together;
* any space or line feed, for rules that drop white space;
* before common punctuation that follows a Latin letter.

Cuts are found in the bytes of many texts at once.  Words are looked up in a cache, misses are encoded by the library.
Other tokenizers get whole texts.
"""

from __future__ import annotations

import ctypes
import json
import os
import re

import numpy as np
import pyarrow as pa

#: Words a worker keeps, in two generations: half of it is filled while the half before is still looked up.
CACHE_WORDS = 1_000_000
#: Letters, but for U+0130: its small form ends in a mark, which is a part with the sign after it.
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-\u012f\u0131-ɏ]+")
#: Characters that one call encodes at most, but for a single longer text: bounds a worker's memory.
CHUNK = 4_000_000

#: Kinds of bytes: plain letters, common punctuation, first bytes of characters that may be white space; from _SPACE on
#: white space, of which only space and line feed are cut at.
_OTHER, _LETTER, _STOP, _FIRST, _SPACE, _NO_CUT = range(6)
_KINDS = bytearray(256)
for _kind, _bytes in (
    (_LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (_STOP, b".,!?;:#$%&*)"),
    (_FIRST, b"\xc2\xe1\xe2\xe3"),
    (_SPACE, b" \n"),
    (_NO_CUT, b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f"),
):
    for _byte in _bytes:
        _KINDS[_byte] = _kind
#: White space beyond ASCII, by the length of its UTF-8.
_WIDE = {2: [0x85, 0xA0], 3: [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]}

_ENCODERS: dict[tuple[str, int], "Encoder"] = {}


def encoder(path: str, cache_words: int = CACHE_WORDS) -> "Encoder":
    """The worker's encoder for a tokenizer file."""
    if (path, cache_words) not in _ENCODERS:
        _ENCODERS[path, cache_words] = Encoder(path, cache_words)
    return _ENCODERS[path, cache_words]


class Encoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.mode, self.cache_words = _mode(rules), cache_words
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.added = [t["content"] for t in rules.get("added_tokens", [])]
        normal = (rules.get("normalizer") or {}).get("normalizers", [])
        # Other replacements or patterns might change or split plain letters.
        usual = self.mode != "dropped" or (
            all(n["type"] != "Replace" or n["pattern"] == {"Regex": r"\s+"} for n in normal)
            and r"[\p{L}]+" in rules["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", "")
        )
        self.lowers = self.mode == "dropped" and usual and any(n["type"] == "Lowercase" for n in normal)
        # Plain letters are one part as they are, so the library's model can do without the rules; a mark tells words apart.
        self.mark = {"spaced": "\n", "dropped": "."}.get(self.mode, "")
        if not usual or any(_LETTERS.fullmatch(t) for t in self.added):
            self.mark = ""
        if self.mark:
            self.ascii_mark = {"spaced": "Ċ", "dropped": "."}[self.mode]
            self.model = Tokenizer(self.library.model)
            self.model.pre_tokenizer = pre_tokenizers.Split(self.ascii_mark, "isolated")
            ids = self.library.encode(self.mark, add_special_tokens=False).ids
            if len(ids) == 1 and self.model.encode(self.ascii_mark, add_special_tokens=False).ids == ids:
                self.mark_id = ids[0]
            else:
                self.mark = ""

    def _parts(self, raw: bytes, bounds: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bytes of texts that begin at ``bounds`` (last entry: the end), cut into parts whose ids, in order, are the ids of
        the texts: their bytes, where each begins (one more entry: the end), and how many there are before each text."""
        if self.mode == "whole":
            starts = np.unique(bounds)
            return raw, starts, np.searchsorted(starts, bounds)
        if self.lowers and b"\xcc" not in raw and b"\xcd" not in raw:
            # The rules lower-case after composing: a capital with a mark may compose otherwise than a small letter.
            lower = raw.lower()
            if not any(t.encode() in lower for t in self.added):
                raw = lower
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        cut = np.zeros(len(raw) + 1, bool)
        cut[bounds] = True
        stops = np.flatnonzero(kinds[1:] == _STOP) + 1
        cut[stops[kinds[stops - 1] == _LETTER]] = True
        # U+00C0 to U+017F are letters, but for two signs, and U+0130, whose small form ends in a mark.
        stops, data = stops[stops > 1], np.frombuffer(raw, np.uint8)
        first, second = data[stops - 2], data[stops - 1]
        cut[stops[(first >= 0xC3) & (first <= 0xC5) & ~np.isin(second, [0x97, 0xB0, 0xB7])]] = True
        if self.mode == "dropped":
            cut[:-1] |= kinds == _SPACE
            starts = np.flatnonzero(cut)
            gone = kinds[starts[:-1]] == _SPACE
            before = np.searchsorted(starts, bounds)
            starts[1:] -= np.cumsum(gone)
            return raw.translate(None, b" \n"), starts, before
        kinds = _with_wide_spaces(raw, kinds)
        spaces = np.flatnonzero(kinds[1:-1] == _SPACE) + 1
        spaces = spaces[(kinds[spaces - 1] < _SPACE) & (kinds[spaces + 1] < _SPACE)]
        cut[spaces] = True
        cut[spaces[data[spaces] == 10] + 1] = True
        starts = np.flatnonzero(cut)
        return raw, starts, np.searchsorted(starts, bounds)

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of each of some distinct words."""
        if len(self.cache) > self.cache_words // 2:
            self.cache, self.old = {}, self.cache
        cache, old = self.cache, self.old
        found = list(map(cache.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            ids = old.get(words[i])
            if ids is None:
                new.append(words[i])
            else:
                cache[words[i]] = ids
        self._learn(new)
        for i in missing:
            found[i] = cache[words[i]]
        if self.mode == "whole":
            self.cache = {}
        return found

    def _learn(self, words: list[str]) -> None:
        """Encode words; words of letters alone go in one text with a mark between them that is always a part."""
        plain, wide, other = [], [], [""]
        for w in words:
            if not self.mark or not _LETTERS.fullmatch(w):
                other.append(w)
            elif w.isascii():
                plain.append(w)
            else:
                wide.append(w)
        other += self._learn_letters(self.model, self.ascii_mark, plain, True) if plain else []
        other += self._learn_letters(self.library, self.mark, wide, False)
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            for w, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False)):
                self.cache[w] = np.array(e.ids, "<u4").tobytes()

    def _learn_letters(self, library, mark: str, words: list[str], prepared: bool) -> list[str]:
        """Encode words of letters, and return those that the mark did not tell apart; ``prepared``: in the characters
        that the rules make of them, which for plain letters are small letters or themselves, and a sign for a space."""
        cache, groups, other = self.cache, [words[at : at + 64] for at in range(0, len(words), 64)], []
        for at in range(0, len(groups), 64):
            texts = [mark.join(g) for g in groups[at : at + 64]]
            if prepared:
                texts = [t.lower() for t in texts] if self.lowers else [t.replace(" ", "Ġ") for t in texts]
            for group, e in zip(groups[at : at + 64], library.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                cuts = np.flatnonzero(ids == self.mark_id)
                if len(cuts) != len(group) - 1:
                    other += group
                    continue
                raw, begin = ids.tobytes(), [0, *(4 * cuts + 4).tolist()]
                for w, a, z in zip(group, begin, [*(4 * cuts).tolist(), len(raw)]):
                    cache[w] = raw[a:z]
        return other

    def _looked_up(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The parts of all texts as numbers of distinct words, the ids of these, and how many parts there are before each
        text (one more entry: all)."""
        each = [t.encode() for t in texts]
        bounds = np.cumsum([0, *map(len, each)])
        raw, starts, before = self._parts(b"".join(each), bounds)
        buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)]
        words = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, buffers).dictionary_encode()
        return words.indices, self._known(words.dictionary.to_pylist()), before

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text begins in it (one more entry: the end)."""
        if not any(texts):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        index, known, before = self._looked_up(texts)
        ends = np.cumsum([0, *map(len, known)], dtype=np.int64)
        flat = [None, pa.py_buffer(ends), pa.py_buffer(b"".join(known))]
        _, ends, ids = pa.Array.from_buffers(pa.large_binary(), len(known), flat).take(index).buffers()
        ends = np.frombuffer(ends, np.int64)[: len(index) + 1] // 4
        return np.frombuffer(ids, "<u4", int(ends[-1])) if ids else np.zeros(0, "<u4"), ends[before]

    def lengths(self, texts: list[str]) -> np.ndarray:
        """The number of ids of each text."""
        if not any(texts):
            return np.zeros(len(texts), np.int64)
        index, known, before = self._looked_up(texts)
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ends = np.concatenate(([0], np.cumsum(size[index.to_numpy()])))
        return np.diff(ends[before])


def _with_wide_spaces(raw: bytes, kinds: np.ndarray) -> np.ndarray:
    """``kinds`` with the bytes of white space beyond ASCII marked as such."""
    first = np.flatnonzero(kinds == _FIRST)
    if not len(first):
        return kinds
    kinds, data = kinds.copy(), np.frombuffer(raw, np.uint8)
    for size, spaces in _WIDE.items():
        at = first[(data[first] == 0xC2) == (size == 2)]
        code = data[at].astype(np.int32) & (0x1F if size == 2 else 0x0F)
        for k in range(1, size):
            code = (code << 6) | (data[at + k] & 0x3F)
        for k in range(size):
            kinds[at[np.isin(code, spaces)] + k] = _NO_CUT
    return kinds


def release() -> None:
    """Hand freed memory back to the machine: allocators keep what a large batch has needed, and a worker shares its
    executor's memory with others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def chunks(batches, columns: tuple[str, ...], text: str = "text", limit: int = CHUNK):
    """Lists of the named columns of Arrow batches, in pieces of about ``limit`` characters of text."""
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in columns]
        texts = lists[columns.index(text)]
        begin = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t or "") > limit:
                yield [x[begin:i] for x in lists]
                release()
                begin, size = i, 0
            size += len(t or "")
        if begin < len(texts):
            yield [x[begin:] for x in lists]
            release()


def _mode(rules: dict) -> str:
    """Where a tokenizer file's rules allow cuts: spaced, dropped or whole."""
    pre, normal = rules.get("pre_tokenizer") or {}, rules.get("normalizer") or {}
    added = rules.get("added_tokens", [])
    plain = not any(t["lstrip"] or t["rstrip"] or re.search(r"\s|\w[.,!?;:#$%&*)]", t["content"]) for t in added)
    if not plain or rules.get("post_processor"):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normal:
        return "spaced"
    steps = pre.get("pretokenizers", [])
    kinds = {n.get("type") for n in normal.get("normalizers", [])}
    if (
        [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and not steps[1].get("use_regex")
        and not steps[1].get("add_prefix_space")
        and kinds <= {"NFC", "Replace", "Lowercase"}
    ):
        return "dropped"
    return "whole"
