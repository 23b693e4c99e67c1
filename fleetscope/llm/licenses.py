"""Licence scans by a generalised suffix automaton of licence texts.

1. **Automaton.** All templates go into one suffix automaton over words (at
   most twice as many states as words). The suffix links form a tree; a walk
   through it lists the places of every state's string as one stretch of an
   array, so all template places of a match cost only their number.
2. **Matching statistics.** A text's words stream through the automaton,
   which keeps the longest string ending at each word that occurs in any
   template. A match counts where it cannot be extended, from ``min_match``
   words on. Only stretches are streamed whose neighbouring words are
   neighbours in some template; numpy cuts away the rest, which no long match
   can cross.
3. **Chains.** Matches of one template in the same order in text and template,
   at most ``max_gap`` words apart in both, form a chain (dynamic programming
   over the matches within reach). It covers template words; a chain that
   covers at least ``min_cover`` of its template is a span and gives the
   template's label. Of spans that overlap in the text, the one covering more
   words stays.

A plain scan for fixed phrases stands beside it (``n_base``, ``base_labels``).
Words are runs of ASCII letters and digits and of any characters beyond
ASCII; A-Z are lower-cased. One map pass over whole texts, no shuffle; the
automaton's size is that of the templates, a parameter.

Defined cases: null and empty texts have no words, no places and score 0;
repeated rows, ties and null ids are rows of their own; an empty table gives
no rows; input columns named like results are replaced, all others pass
through. The score is 1 where a phrase stands, else the best share of a
template that a chain covers.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import small_batches, split_words, text_slices
from fleetscope.llm.license_texts import PHRASES, TEMPLATES

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 12, 0.75
SLICE_BYTES = 2_000_000
SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), *(T.StructField(n, T.LongType()) for n in
                                                                        ("first_word", "last_word", "covered", "template_words"))]))


def _word_bytes() -> np.ndarray:
    """Every byte as the scan sees it: A-Z lower-cased, other ASCII that is no
    letter or digit as a space, bytes of other characters as they are."""
    out = np.full(256, 32, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalnum():
            out[b] = ord(c.lower()) if b < 128 else b
    return out


WORD_BYTES = _word_bytes()


def scan_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and the flat lower-cased words of many texts."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    return split_words(pa.LargeStringArray.from_buffers(len(text), pa.py_buffer((bounds - bounds[0]).astype(np.int64)), pa.py_buffer(WORD_BYTES[data])))


def words_of(text: str) -> list[str]:
    return scan_words(pa.array([text]))[1].to_pylist()


@dataclass(frozen=True)
class Chain:
    template: int
    first: int                # words of the text, both included
    last: int
    covered: int              # words of the template


class LicenseAutomaton:
    def __init__(self, templates: Sequence[Sequence[int]]):
        """``templates`` are words as numbers."""
        self.size = [len(t) for t in templates]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, int]] = []           # state, template, words up to its end
        for k, words in enumerate(templates):
            last = 0
            for at, c in enumerate(words):
                last = self._extend(last, c)
                ends.append((last, k, at + 1))
        self._list_places(ends)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(dict(edges))
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        """State of the longest string after one more word; strings that an
        earlier template holds are found, not made again."""
        known = self.next[last].get(c)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        new = -1 if known is not None else self._state(self.length[last] + 1, 0, {})
        p, q = last, known
        while known is None and p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if known is None:
            if p < 0:
                return new
            q = self.next[p][c]
        if self.length[q] != self.length[p] + 1:
            copy = self._state(self.length[p] + 1, self.link[q], self.next[q])
            self.link[q] = copy
            while p >= 0 and self.next[p].get(c) == q:
                self.next[p][c] = copy
                p = self.link[p]
            q = copy
        if known is not None:
            return q
        self.link[new] = q
        return new

    def _list_places(self, ends: list[tuple[int, int, int]]) -> None:
        """Places (template, end) in the order of a walk through the tree of
        suffix links; ``low`` and ``high`` bound each state's own."""
        own: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state, k, end in ends:
            own[state].append((k, end))
        children: list[list[int]] = [[] for _ in self.next]
        for state in range(1, len(self.next)):
            children[self.link[state]].append(state)
        self.low, self.high = [0] * len(self.next), [0] * len(self.next)
        self.places: list[tuple[int, int]] = []
        stack = [(0, False)]
        while stack:
            state, done = stack.pop()
            if done:
                self.high[state] = len(self.places)
                continue
            self.low[state] = len(self.places)
            self.places += own[state]
            stack.append((state, True))
            stack += [(child, False) for child in children[state]]

    def statistics(self, words: Sequence[int]) -> list[tuple[int, int]]:
        """Per word: the length of the longest string of the templates that
        ends there, and its state."""
        out = []
        state = length = 0
        edges, link, size = self.next, self.link, self.length
        for c in words:
            to = edges[state].get(c)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = edges[state].get(c)
            state, length = (to, length + 1) if to is not None else (0, 0)
            out.append((length, state))
        return out

    def matches(self, words: Sequence[int], base: int, min_match: int) -> list[tuple[int, int, int, int]]:
        """Matches that cannot be extended, at every place of the templates:
        (template, first word of the text, first word there, words)."""
        found = []
        stats = self.statistics(words)
        for i, (length, state) in enumerate(stats):
            if length >= min_match and (i + 1 == len(stats) or stats[i + 1][0] != length + 1):
                for k, end in self.places[self.low[state]:self.high[state]]:
                    found.append((k, base + i + 1 - length, end - length, length))
        return found


def chains(matches: list[tuple[int, int, int, int]], max_gap: int) -> list[Chain]:
    """Best chains of matches, each match in at most one, by template."""
    out: list[Chain] = []
    matches = sorted(set(matches))
    low = 0
    while low < len(matches):
        high = low
        while high < len(matches) and matches[high][0] == matches[low][0]:
            high += 1
        own = matches[low:high]                     # one template, by place in the text
        best, back = [m[3] for m in own], [-1] * len(own)
        longest = max(m[3] for m in own)
        first = 0
        for j, (_, d, t, n) in enumerate(own):
            while own[first][1] + longest + max_gap < d:
                first += 1
            for i in range(first, j):
                _, d0, t0, n0 = own[i]
                # Overlaps are cut off the later match.
                cut = max(0, d0 + n0 - d, t0 + n0 - t)
                if d > d0 and t > t0 and cut < n and d - d0 - n0 <= max_gap and t - t0 - n0 <= max_gap and best[i] + n - cut > best[j]:
                    best[j], back[j] = best[i] + n - cut, i
        used = [False] * len(own)
        for j in sorted(range(len(own)), key=lambda j: (-best[j], own[j][1], own[j][2])):
            if used[j]:
                continue
            i, start, clean = j, j, True
            while i >= 0 and clean:
                clean, start, i = not used[i], i, back[i]
            if not clean:
                continue                            # its better part belongs to a chain already taken
            i = j
            while i >= 0:
                used[i], i = True, back[i]
            out.append(Chain(own[j][0], own[start][1], own[j][1] + own[j][3] - 1, best[j]))
        low = high
    return out


class LicenseScanner:
    """Phrases and templates made ready for many texts."""

    def __init__(self, templates: Mapping[str, Sequence[str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, min_match: int = MIN_MATCH,
                 max_gap: int = MAX_GAP, min_cover: float = MIN_COVER):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        cut = [(label, words_of(t)) for label in sorted(templates) for t in templates[label]]
        said = [(words_of(p), label) for p, label in phrases.items()]
        self.vocabulary = sorted({w for _, t in cut for w in t} | {w for p, _ in said for w in p})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.phrases = [([number[w] for w in p], label) for p, label in said if p]
        self.labels = [label for label, t in cut if t]
        coded = [[number[w] for w in t] for _, t in cut if t]
        self.automaton = LicenseAutomaton(coded)
        self.pairs = np.unique(np.array([a * len(number) + b for t in coded for a, b in zip(t, t[1:])], np.int64))

    def codes(self, words: pa.Array) -> np.ndarray:
        """Number of each word; -1: in no template or phrase."""
        at = pc.index_in(words, pa.array(self.vocabulary, pa.large_string()))
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def phrase_places(self, codes: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
        """Per phrase the words (of all texts) where it starts."""
        out = []
        for phrase, _ in self.phrases:
            n = len(codes) - len(phrase) + 1
            if n <= 0:
                out.append(np.zeros(0, np.int64))
                continue
            here = text[:n] == text[len(phrase) - 1:]
            for k, c in enumerate(phrase):
                here &= codes[k:k + n] == c
            out.append(np.flatnonzero(here))
        return out

    def stretches(self, codes: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of words that are neighbours in some template, long
        enough for a match."""
        need = max(1, self.min_match)
        if need == 1:
            near = (text[1:] == text[:-1]) if len(text) else np.zeros(0, bool)
        else:
            key = codes[:-1] * len(self.vocabulary) + codes[1:]
            near = (codes[:-1] >= 0) & (codes[1:] >= 0) & (text[1:] == text[:-1]) & np.isin(key, self.pairs)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], near, [False])).astype(np.int8)))
        s, e = edges[::2], edges[1::2] + 1
        long = e - s >= need
        return list(zip(s[long].tolist(), e[long].tolist()))

    def spans(self, found: list[Chain]) -> list[Chain]:
        """Chains that cover enough, without overlaps in the text."""
        size = self.automaton.size
        out: list[Chain] = []                       # by place in the text
        for c in sorted(found, key=lambda c: (-c.covered, -c.covered / size[c.template], c.first, c.template)):
            k = bisect.bisect_left(out, c.first, key=lambda o: o.first)
            clear = (k == 0 or out[k - 1].last < c.first) and (k == len(out) or out[k].first > c.last)
            if clear and c.covered >= self.min_cover * size[c.template]:
                out.insert(k, c)
        return out

    def scan(self, text: pa.Array) -> dict[str, list]:
        offsets, words = scan_words(text)
        rows = len(offsets) - 1
        owner = np.repeat(np.arange(rows), np.diff(offsets))
        codes = self.codes(words)
        count = np.zeros(rows, np.int64)
        first, last = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
        base: list[set[str]] = [set() for _ in range(rows)]
        for (_, label), at in zip(self.phrases, self.phrase_places(codes, owner)):
            row = owner[at]
            np.add.at(count, row, 1)
            np.minimum.at(first, row, at - offsets[row])
            np.maximum.at(last, row, at - offsets[row])
            for r in np.unique(row).tolist():
                base[r].add(label)
        matches: dict[int, list[tuple[int, int, int, int]]] = {}
        for s, e in self.stretches(codes, owner):
            r = int(owner[s])
            found = self.automaton.matches(codes[s:e].tolist(), s - int(offsets[r]), self.min_match)
            if found:
                matches.setdefault(r, []).extend(found)
        labels = [set(b) for b in base]
        score = (count > 0).astype(np.float64)
        spans: list[list[dict]] = [[] for _ in range(rows)]
        for r, found in matches.items():
            linked = chains(found, self.max_gap)
            score[r] = max(score[r], max(min(1.0, c.covered / self.automaton.size[c.template]) for c in linked))
            for c in self.spans(linked):
                name = self.labels[c.template]
                labels[r].add(name)
                spans[r].append({"label": name, "first_word": c.first, "last_word": c.last, "covered": c.covered,
                                 "template_words": self.automaton.size[c.template]})
        return {"n_words": np.diff(offsets), "n_base": count, "first_word": [f if n else None for f, n in zip(first.tolist(), count)],
                "last_word": [x if n else None for x, n in zip(last.tolist(), count)], "base_labels": [",".join(sorted(b)) for b in base],
                "labels": [",".join(sorted(x)) for x in labels], "score": score, "spans": spans}


RESULT = T.StructType([*(T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")),
                       T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("spans", SPANS)])


def license_scan(docs: DataFrame, text: str = "text", scanner: LicenseScanner | None = None) -> DataFrame:
    """``docs`` with the phrase places, labels, score and covered template
    spans of every whole text."""
    scanner = scanner or LicenseScanner()
    names = RESULT.names
    keep = [f for f in docs.schema.fields if f.name not in names]
    kept = [f.name for f in keep]
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(),
                                pa.list_(pa.struct([("label", pa.string()), *((n, pa.int64()) for n in ("first_word", "last_word", "covered", "template_words"))]))]
    sent = docs.sparkSession.sparkContext.broadcast(scanner)
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in text_slices(batch, text, SLICE_BYTES):
                found = own.scan(part.column(text))
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + [pa.array(found[n], t) for n, t in zip(names, types)],
                                                 names=kept + names)

    return docs.select(*[F.col(f"`{k}`") for k in kept]).mapInArrow(work, T.StructType(keep + RESULT.fields))
