"""Token ids of whole texts by a public vocabulary of the tokenizers library."""

from __future__ import annotations

import itertools
import json
import os
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fleetscope.llm.common import split_words


def default_vocabulary() -> str:
    """Path of the installed public word-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable bytes stand for themselves, the others for U+0100 onwards."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Generation:
    """Words and their lists of ids, in flat arrays that grow by doubling."""

    def __init__(self, lists: int, dtype: type):
        self.place: dict[str, int] = {}
        self.chars = 0
        self.first = [np.zeros(1 << 10, np.int64) for _ in range(lists)]
        self.size = [np.zeros(1 << 10, np.int32) for _ in range(lists)]
        self.flat = [np.zeros(1 << 12, dtype) for _ in range(lists)]
        self.used = [0] * lists

    def add(self, words: list[str], lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Numbers of the new words, whose lists are (sizes, flat ids)."""
        n, m = len(self.place), len(words)
        for k, (size, flat) in enumerate(lists):
            while len(self.first[k]) < n + m:
                self.first[k], self.size[k] = (np.concatenate((a, np.zeros_like(a))) for a in (self.first[k], self.size[k]))
            while len(self.flat[k]) < self.used[k] + len(flat):
                self.flat[k] = np.concatenate((self.flat[k], np.zeros_like(self.flat[k])))
            self.size[k][n:n + m] = size
            self.first[k][n:n + m] = self.used[k] + np.cumsum(size) - size
            self.flat[k][self.used[k]:self.used[k] + len(flat)] = flat
            self.used[k] += len(flat)
        self.place.update(zip(words, range(n, n + m)))
        self.chars += sum(map(len, words))
        return np.arange(n, n + m)

    def find(self, words: list[str]) -> np.ndarray:
        """Number of each word, -1 if unknown."""
        return np.fromiter(map(self.place.get, words, itertools.repeat(-1)), np.int64, len(words))

    def lists(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and flat ids of the words' ``k``-th lists."""
        n = self.size[k][at].astype(np.int64)
        ends = np.cumsum(n)
        where = np.arange(int(n.sum())) + np.repeat(self.first[k][at] - (ends - n), n)
        return n, self.flat[k][where]


class WordStore:
    """Lists of ids per word, learned once while the word keeps occurring.

    Two generations bound the memory: when the young one holds half of
    ``words`` (or 16 times as many characters) it becomes the old one, and the
    former old one goes. A word found in the old generation moves to the
    young one, so frequent words are never learned again and words seen once
    are dropped. Results do not depend on the bound.
    """

    def __init__(self, learn: Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]], lists: int, dtype: type, words: int):
        self.learn, self.n_lists, self.dtype, self.words = learn, lists, dtype, words
        self.young, self.old = _Generation(lists, dtype), _Generation(lists, dtype)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words in the young generation."""
        at = self.young.find(words)
        missing = np.flatnonzero(at < 0)
        if len(missing) and self.young.place and (2 * (len(self.young.place) + len(missing)) > self.words or self.young.chars > 8 * self.words):
            self.young, self.old = _Generation(self.n_lists, self.dtype), self.young
            missing = np.arange(len(words))
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            known = self.old.find(new)
            kept = np.flatnonzero(known >= 0)
            if len(kept):
                at[missing[kept]] = self.young.add([new[i] for i in kept.tolist()], [self.old.lists(k, known[kept]) for k in range(self.n_lists)])
            fresh = np.flatnonzero(known < 0)
            if len(fresh):
                new = [new[i] for i in fresh.tolist()]
                at[missing[fresh]] = self.young.add(new, self.learn(new))
        return at

    def lists(self, distinct: list[str], place: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sizes and flat ids of words given as places among distinct ones."""
        at = self.look_up(distinct)[place]
        return [self.young.lists(k, at) for k in range(self.n_lists)]


def listed(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and flat values of lists."""
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return size, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))


def coded(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words and each word's place among them."""
    d = words.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return d.dictionary.to_numpy(zero_copy_only=False).tolist(), d.indices.to_numpy(zero_copy_only=False)


class WordTokenizer:
    """Ids of many texts, encoding each distinct word once per worker.

    Valid for byte-level vocabularies that drop white space, fold ASCII case
    and never join characters across white space: there a text's ids are
    those of its white-space separated pieces in order. ``cache_words``
    bounds the remembered words, and so the memory; the ids do not depend on
    it. New words of basic Latin letters are folded and cut together by the
    vocabulary's own pattern and merged by tiktoken from the vocabulary's own
    ranks; every other new word goes through the
    library's whole encoder.
    """

    # Code points from here on always take the library's whole encoder. Below
    # it no character composes with another and lower case is one character
    # (but for U+0130), so folding is all that normalising does.
    LATIN_END = "\u0250"

    def __init__(self, path: str, cache_words: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        cut, level = spec["pre_tokenizer"]["pretokenizers"]
        if (cut["type"], level["type"], cut["invert"], cut["behavior"]) != ("Split", "ByteLevel", True, "Removed"):
            raise ValueError(f"{path} does not cut words by a pattern followed by a byte level")
        # New words stand in lines; pieces never hold a line end.
        self.cut = re.compile(self._latin_pattern(cut["pattern"]["Regex"]) + "|\n").findall
        plain = "".join(re.escape(chr(c)) for c in range(0x21, ord(self.LATIN_END)) if chr(c).isprintable() and c != 0x130)
        self.odd = re.compile(rf"[^{plain}\n]|<\|").search
        self._make_merger(spec["model"])
        self.store = WordStore(self._learn, 1, np.uint16 if self.vocabulary_size() <= 1 << 16 else np.uint32, cache_words)

    # Stands for the end of a piece; no plain word holds it.
    END = "\x1f"

    def _latin_pattern(self, pattern: str) -> str:
        """The pattern with letters and numbers spelt out below LATIN_END."""
        latin = [chr(c) for c in range(ord(self.LATIN_END))]
        for kind in "LN":
            pattern = pattern.replace(rf"\p{{{kind}}}", "".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == kind))
        if "\\p" in pattern:
            raise ValueError("the pattern uses other character classes than letters and numbers")
        return pattern

    def _make_merger(self, model: dict) -> None:
        """Merge pieces by the vocabulary's ranks. An id's rank is its number,
        so a byte with the end mark, numbered before all merges, forms first."""
        import tiktoken
        suffix, end = model["end_of_word_suffix"], self.END.encode()
        letters = byte_of_letter()
        ranks = {}
        for token, i in model["vocab"].items():
            core = token[:-len(suffix)] if suffix and token.endswith(suffix) else token
            if all(c in letters for c in core):
                raw = bytes(letters[c] for c in core)
                if len(raw) == 1 or end not in raw:
                    ranks[raw + (end if len(core) < len(token) else b"")] = i
        made = [model["vocab"][a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        if not suffix or made != sorted(made) or min(made) != 512 or any(ranks.get(bytes([b]) + end, 512) >= 512 for b in range(256) if b != end[0]):
            raise ValueError("ids are not ranked as merges over bytes with an end mark")
        self.line_end = ranks[b"\n" + end]
        self.merge = tiktoken.Encoding("words", pat_str=f"[^{self.END}]+{self.END}", mergeable_ranks=ranks, special_tokens={})

    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _learn(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        lines = "\n".join(words)
        # Mostly all words are plain; else each is looked at.
        plain = [True] * len(words) if not self.odd(lines) else [not self.odd(w) and "\n" not in w for w in words]
        if not all(plain):
            lines = "\n".join(w if p else "" for w, p in zip(words, plain))
        pieces = self.cut(lines.lower() + "\n")
        ids = self.merge.encode_to_numpy(self.END.join(pieces) + self.END, disallowed_special=())
        lines = np.flatnonzero(ids == self.line_end)
        size = np.diff(lines, prepend=-1) - 1
        flat = np.delete(ids, lines)
        if all(plain):
            return [(size, flat)]
        other = [i for i, p in enumerate(plain) if not p]
        whole = [e.ids for e in self.tokenizer.encode_batch([words[i] for i in other], add_special_tokens=False)]
        ends = np.cumsum(size)
        size[other] = list(map(len, whole))
        extra = np.concatenate([np.asarray(w, np.uint32) for w in whole])
        return [(size, np.insert(flat, np.repeat(ends[other], size[other]), extra))]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (rows + 1) and the flat ids of all texts (null: none)."""
        offsets, words = split_words(text)
        if len(words) == 0:
            return offsets, np.zeros(0, np.uint32)
        # Case is folded beforehand only where nothing else can change.
        fold = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
        distinct, place = coded(pc.if_else(fold, pc.ascii_lower(words), words))
        n, ids = self.store.lists(distinct, place)[0]
        return np.concatenate(([0], np.cumsum(n)))[offsets], ids.astype(np.uint32)


_workers: dict[str, WordTokenizer] = {}


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker process, loaded once and kept."""
    if path not in _workers:
        _workers[path] = WordTokenizer(path)
    return _workers[path]
