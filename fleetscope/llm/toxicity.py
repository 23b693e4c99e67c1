"""Toxicity: a subsequence string kernel machine with Nystroem landmarks.

Kernel. Two strings are compared by the subsequences of ``LENGTH`` letters
they share, contiguous or gapped; an occurrence that spans ``s`` characters
counts ``DECAY ** (s - LENGTH)``, up to ``LENGTH + GAPS`` characters. Letters
are folded (case), digits and marks are left out, white space stays
as a gap; so "i.d.i.o.t", "idi ot" and "idxiot" share subsequences with
"idiot".

Landmarks. ``m`` short strings cut from the labelled sentences: those that
cover the label-1 documents best against the label-0 documents, and random
ones for contrast. With K the kernel matrix of the landmarks, a fragment is
mapped to ``K^(-1/2) k(fragment)`` and a linear hinge-loss machine is fitted
there by dual coordinate descent.

Sentences. A label holds for a document, so labelled sentences come from it
in rounds: in a label-1 document the best fragment (``WINDOW`` characters
inside a sentence) of the present model is labelled 1; in a label-0 document
its best fragments (the hardest) and a random one are labelled 0.

Scoring. A sum over landmarks of kernels is a weight per subsequence, so the
fitted machine is one table over all ``32 ** LENGTH`` subsequences. Every
whole text is scored by table lookups in numpy, one per position and gap
pattern, and takes the margins of its best ``PLACES`` fragments: a string that
clean texts hold once by chance marks a text that holds it often. A logistic
curve over them, fitted on margins of texts left out of their machine, gives a
probability. One map pass, no shuffle.

Fitting uses a bounded sample (``per_class`` documents of each class with at
most ``max_chars`` characters) on the driver; the table is 4 MB.

Defined cases: null and empty texts get the margin of an empty fragment;
without labels of both classes the score is the share of label 1 (0.5 without
labels); repeated rows score alike; input columns named like results are
replaced, all others pass through.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import hinge_dual, labelled_sample, small_batches, text_slices

LENGTH, GAPS, DECAY, WINDOW = 4, 3, 0.5, 20
SYMBOLS = 32                      # 0: white space; 1-26: a-z; 27-31: other letters
# Steps between chosen letters, with at most GAPS characters left out in all.
STEPS = [s for s in product(range(1, GAPS + 2), repeat=LENGTH - 1) if sum(s) <= LENGTH - 1 + GAPS]
PAD = LENGTH - 1 + GAPS
# Best fragments of a text that its score looks at.
PLACES = 3
# Landmarks that each label-1 text should hold.
COVER = 6
# Code of a line end, which ends a fragment, and of what is left out.
STOP, OMIT = 255, 254


def _letter(c: int, accents: bool) -> int:
    ch = chr(c)
    if ch.isspace():
        return STOP if ch == "\n" else 0
    base = unicodedata.normalize("NFKC" if accents else "NFKD", ch.casefold())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + ord(base) % 5 if base.isalpha() else OMIT


# Codes below U+0250: accented letters as letters of their own, or as the
# letters without their accents.
FOLDS = {accents: np.array([_letter(c, accents) for c in range(0x250)], np.uint8) for accents in (True, False)}


def fold(text: str, accents: bool = True) -> np.ndarray:
    """Codes of the letters, spaces and line ends of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = FOLDS[accents]
    out = table[np.minimum(points, len(table) - 1)]
    far = points >= len(table)
    if far.any():
        kinds, place = np.unique(points[far], return_inverse=True)
        out[far] = np.array([OMIT if 0xD800 <= c < 0xE000 else _letter(c, accents) for c in kinds.tolist()], np.uint8)[place]
    return out[out != OMIT]


def _shifted(code: np.ndarray) -> tuple[list[np.ndarray], int]:
    c = np.zeros(len(code) + PAD, np.int32)
    c[:len(code)] = np.where(code == STOP, 0, code)
    return [c << (5 * (LENGTH - 1 - k)) for k in range(LENGTH)], len(code)


def subsequences(code: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each gap pattern: the subsequence number at every position (those
    with a non-letter must weigh nothing in tables), and the decay weight."""
    parts, n = _shifted(code)
    for steps in STEPS:
        at, number = 0, parts[0][:n]
        for k, s in enumerate(steps):
            at += s
            number = number | parts[k + 1][at:at + n]
        yield number, DECAY ** (at - (LENGTH - 1))


def letters_only() -> np.ndarray:
    """True for subsequence numbers made of letters alone."""
    number = np.arange(SYMBOLS ** LENGTH)
    ok = np.ones(len(number), bool)
    for k in range(LENGTH):
        ok &= (number >> (5 * k)) % SYMBOLS != 0
    return ok


def feature_map(string: bytes) -> dict[int, float]:
    """Weighted subsequences of a short string of codes, to unit length."""
    out: Counter = Counter()
    for number, weight in subsequences(np.frombuffer(string, np.uint8)):
        for x in number.tolist():
            if all((x >> (5 * k)) % SYMBOLS for k in range(LENGTH)):
                out[x] += weight
    norm = sum(v * v for v in out.values()) ** 0.5
    return {k: v / norm for k, v in out.items()} if norm else {}


def position_sums(code: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of table weights of the subsequences that start at each position."""
    total = np.zeros(len(code), np.float32)
    for number, weight in subsequences(code):
        total += table[number] * np.float32(weight)
    return total


def window_sums(code: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Kernel sum of the fragment that starts at each position: the sums of
    ``WINDOW`` positions, cut at the end of the line."""
    n = len(code)
    c = np.concatenate(([0.0], np.cumsum(sums, dtype=np.float64)))
    end = np.minimum(np.arange(n) + WINDOW, n)
    stops = np.flatnonzero(code == STOP)
    if len(stops):
        k = np.searchsorted(stops, np.arange(n))
        end = np.minimum(end, np.append(stops, n)[k] + 1)
    return c[end] - c[:n]


@dataclass(frozen=True)
class Model:
    table: np.ndarray          # weight of every subsequence
    bias: float
    slopes: np.ndarray         # of a text's facts
    offset: float

    def _facts(self, code: np.ndarray) -> np.ndarray:
        out = np.full(PLACES + 2, self.bias)
        out[-1] = np.log1p(len(code))
        if len(code):
            sums = window_sums(code, position_sums(code, self.table))
            out[-2] += sums.mean()
            for k in range(PLACES):
                at = int(sums.argmax())
                if sums[at] == -np.inf:
                    break
                out[k] = sums[at] + self.bias
                sums[max(0, at - WINDOW + 1):at + WINDOW] = -np.inf
        return out

    def facts(self, text: str) -> np.ndarray:
        """Margins of the best ``PLACES`` fragments that do not overlap, best
        first (an empty fragment's where a short text has no more), the mean
        margin of all fragments and the logarithm of their number. A text with
        accents is read with and without them, and the better margins count."""
        code = fold(text)
        out = self._facts(code)
        if ((code >= 27) & (code < SYMBOLS)).any():
            np.maximum(out, self._facts(fold(text, accents=False)), out=out)
        return out

    def score(self, text: str) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slopes @ self.facts(text) + self.offset, -35, 35))))


def candidate_strings(text: str) -> set[bytes]:
    """Letter runs of 4 to 6 characters, as codes, that landmarks are chosen
    from."""
    code = fold(text)
    out = set()
    for w in set(np.where(code < SYMBOLS, code, 0).astype(np.uint8).tobytes().split(b"\0")):
        for n in (4, 5, 6):
            out.update(w[i:i + n] for i in range(len(w) - n + 1))
    return out


def choose_landmarks(texts: list[str], y: np.ndarray, m: int, seed: int = 5) -> list[bytes]:
    """Strings that cover the label-1 texts (each ``COVER`` times) with the
    best ratio against label 0, then random strings."""
    seen: list[Counter] = [Counter(), Counter()]
    sets = []
    for t, c in zip(texts, y):
        s = candidate_strings(t)
        seen[c].update(s)
        sets.append(s if c else None)
    n = np.bincount(y, minlength=2)
    lift = {s: np.log((k + 0.1) / (n[1] + 0.2)) - np.log((seen[0][s] + 0.1) / (n[0] + 0.2)) for s, k in seen[1].items() if k >= 2}
    best = sorted(lift, key=lambda s: (-lift[s] * np.sqrt(seen[1][s]), s))[:4000]
    where: dict[bytes, list[int]] = {s: [] for s in best}
    for i, s in enumerate(sets):
        for x in s or ():
            if x in where:
                where[x].append(i)
    need = np.where(y == 1, COVER, 0).astype(np.int64)
    chosen: list[bytes] = []
    # Lazy greedy cover: the top gain is recomputed until it stays on top.
    heap = [(-lift[s] * len(where[s]), s) for s in best if lift[s] > 0]
    heapq.heapify(heap)
    while heap and len(chosen) < m // 2:
        gain, s = heapq.heappop(heap)
        now = -lift[s] * int((need[where[s]] > 0).sum())
        if now == gain < 0:
            chosen.append(s)
            need[where[s]] -= 1
        elif now < 0:
            heapq.heappush(heap, (now, s))
    rest = sorted((set(seen[0]) | set(seen[1])) - set(chosen))
    rng = np.random.default_rng(seed)
    extra = rng.choice(len(rest), min(len(rest), m - len(chosen)), replace=False) if rest else []
    return chosen + [rest[i] for i in extra]


def fit_machine(texts: list[str], y: np.ndarray, m: int, rounds: int, cost: float, seed: int = 9) -> tuple[np.ndarray, float]:
    """Weight of every subsequence and the offset, from texts of both classes."""
    table = np.zeros(SYMBOLS ** LENGTH, np.float32)
    rng = np.random.default_rng(seed)
    marks = choose_landmarks(texts, y, m)
    maps = [f for f in map(feature_map, marks) if f]
    number = {x: i for i, x in enumerate(sorted({x for f in maps for x in f}))}
    z = np.zeros((len(number), len(maps)))
    for j, f in enumerate(maps):
        for x, v in f.items():
            z[number[x], j] = v
    numbers = np.array(sorted(number), np.int64)
    row_of = np.full(SYMBOLS ** LENGTH, -1, np.int32)
    row_of[numbers] = np.arange(len(numbers))
    values, vectors = np.linalg.eigh(z.T @ z)
    root = vectors / np.sqrt(np.maximum(values, 0) + 1e-3) @ vectors.T      # K^(-1/2), ridged
    codes = [fold(t) for t in texts]

    def embed(code: np.ndarray, start: int) -> np.ndarray:
        end = min(start + WINDOW, len(code))
        stop = np.flatnonzero(code[start:end] == STOP)
        end = start + int(stop[0]) + 1 if len(stop) else end
        window = code[start:min(len(code), end + PAD)]
        rows, decays = [], []
        for num, decay in subsequences(window):
            own = row_of[num[:end - start]]
            own = own[own >= 0]
            rows.append(own)
            decays.append(np.full(len(own), decay))
        at, place = np.unique(np.concatenate(rows), return_inverse=True)
        weights = np.bincount(place, np.concatenate(decays), minlength=len(at))
        return root @ (weights @ z[at])

    lean = np.array([1.0 if s in set(marks[:m // 2]) else 0.0 for s in marks if feature_map(s)])
    table[numbers] = z @ lean
    bias = 0.0
    pool_x: list[np.ndarray] = []
    pool_y: list[int] = []
    for turn in range(rounds):
        if turn == 0:
            pool_x, pool_y = [], []
        else:                                  # label-1 fragments are chosen anew, label-0 ones add up
            pool_x = [x for x, c in zip(pool_x, pool_y) if c == 0]
            pool_y = [0] * len(pool_x)
        for code, c in zip(codes, y):
            if not len(code):
                continue
            sums = window_sums(code, position_sums(code, table))
            starts = [int(sums.argmax())]
            if c == 0:
                other = sums.copy()
                other[max(0, starts[0] - WINDOW):starts[0] + WINDOW] = -np.inf
                if np.isfinite(other.max()):
                    starts.append(int(other.argmax()))
                if turn == 0:
                    starts.append(int(rng.integers(len(code))))
            for s in starts:
                pool_x.append(embed(code, s))
                pool_y.append(int(c))
        x, labels = np.array(pool_x), np.array(pool_y)
        balance = np.array([len(labels) / (2 * max(1, (labels == c).sum())) for c in (0, 1)])
        all_columns = np.arange(x.shape[1])
        w, bias = hinge_dual([all_columns] * len(x), list(x), labels, x.shape[1], cost * balance[labels], epochs=15)
        table = np.zeros(SYMBOLS ** LENGTH, np.float32)
        table[numbers] = z @ (root @ w)
    return table, float(bias)


def fit(texts: list[str], y: np.ndarray, counts: np.ndarray, m: int = 512, rounds: int = 3, cost: float = 1.0,
        folds: int = 3, seed: int = 9) -> Model:
    """Fit on labelled texts; ``counts`` are the class sizes among all labels.

    The curve over the best margins is fitted on margins of texts that their
    machine has not seen (``folds`` machines), then one machine on all texts."""
    none = np.zeros(PLACES + 2)
    share = counts[1] / counts.sum() if counts.sum() else 0.5
    prior = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if counts.min() == 0 or len(np.unique(y)) < 2:
        return Model(np.zeros(SYMBOLS ** LENGTH, np.float32), 0.0, none, prior)
    fold_of = np.empty(len(y), np.int64)
    rng = np.random.default_rng(seed)
    for c in (0, 1):
        own = np.flatnonzero(y == c)
        fold_of[rng.permutation(own)] = np.arange(len(own)) % folds
    facts = np.full((len(y), PLACES + 2), np.nan)
    for k in range(folds):
        seen, unseen = np.flatnonzero(fold_of != k), np.flatnonzero(fold_of == k)
        if len(unseen) and len(np.unique(y[seen])) == 2:
            table, bias = fit_machine([texts[i] for i in seen], y[seen], m, rounds, cost)
            model = Model(table, bias, none, 0.0)
            facts[unseen] = [model.facts(texts[i]) for i in unseen]
    table, bias = fit_machine(texts, y, m, rounds, cost)
    for i in np.flatnonzero(np.isnan(facts[:, 0])):
        facts[i] = Model(table, bias, none, 0.0).facts(texts[i])
    weight = (counts / np.maximum(1, np.bincount(y, minlength=2)))[y]
    slopes, offset = logistic_fit_many(facts, y, weight * len(y) / weight.sum())
    return Model(table, bias, slopes, offset)


def logistic_fit_many(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Slopes and offset of a weighted logistic curve over several values
    (Newton steps, halved until the loss falls)."""
    full = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(full.shape[1])
    keep = np.append(np.full(x.shape[1], ridge), 1e-6)

    def loss(w: np.ndarray) -> float:
        z = full @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (keep * w * w).sum())

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -35, 35)))
        grad = full.T @ (weight * (p - y)) + keep * w
        hess = (full * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ full + np.diag(keep)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w, before = w - size * step, now
        now = loss(w)
        if before - now < 1e-9 * max(1.0, abs(now)):
            break
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = 2500,
                 max_chars: int = 10_000) -> Model:
    """Model from the labelled rows that are not held out (bounded sample)."""
    return fit(*labelled_sample(docs, labels, target, per_class, max_chars))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` for every whole text."""
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_numpy(zero_copy_only=False)
                score = np.array([own.score(t or "") for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(score, pa.float64()), pa.array(score >= threshold).cast(pa.int32())],
                    names=names + ["score", "predicted"])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(work, schema)
