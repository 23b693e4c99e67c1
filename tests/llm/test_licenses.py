import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetscope.llm.license_texts import PHRASES, TEMPLATES
from fleetscope.llm.licenses import Chain, LicenseAutomaton, LicenseScanner, chains, license_scan, scan_words
from fleetscope.llm.queries import op13_licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_matches(templates, words, min_match):
    """Longest template string ending at each word, by trying all places."""
    best = []
    for i in range(len(words)):
        n = 0
        for t in templates:
            for e in range(1, len(t) + 1):
                k = 0
                while k < min(e, i + 1) and t[e - 1 - k] == words[i - k]:
                    k += 1
                n = max(n, k)
        best.append(n)
    out = set()
    for i, n in enumerate(best):
        if n >= min_match and (i + 1 == len(best) or best[i + 1] != n + 1):
            out.update((k, i + 1 - n, s, n) for k, t in enumerate(templates) for s in range(len(t) - n + 1) if t[s:s + n] == words[i + 1 - n:i + 1])
    return best, out


word = st.integers(0, 3)


@settings(max_examples=300, deadline=None)
@given(templates=st.lists(st.lists(word, max_size=14), max_size=4), words=st.lists(word, max_size=20), least=st.integers(1, 4))
def test_matches_equal_brute_force(templates, words, least):
    own = LicenseAutomaton(templates)
    best, want = brute_matches(templates, words, least)
    assert [n for n, _ in own.statistics(words)] == best
    got = own.matches(words, 0, least)
    assert set(got) == want and len(got) == len(want)
    assert len(own.next) <= 2 * max(1, sum(map(len, templates))) + 1


def brute_chain(matches, max_gap):
    """Most template words that any chain covers, by trying all orders."""
    best = 0

    def grow(m, covered):
        nonlocal best
        best = max(best, covered)
        for x in matches:
            cut = max(0, m[1] + m[3] - x[1], m[2] + m[3] - x[2])
            if x[0] == m[0] and x[1] > m[1] and x[2] > m[2] and cut < x[3] and x[1] - m[1] - m[3] <= max_gap and x[2] - m[2] - m[3] <= max_gap:
                grow(x, covered + x[3] - cut)

    for m in matches:
        grow(m, m[3])
    return best


@settings(max_examples=200, deadline=None)
@given(matches=st.lists(st.tuples(st.just(0), st.integers(0, 30), st.integers(0, 20), st.integers(1, 5)), min_size=1, max_size=7, unique=True),
       gap=st.integers(0, 10))
def test_best_chain_equals_brute_force(matches, gap):
    assert max(c.covered for c in chains(matches, gap)) == brute_chain(matches, gap)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aZé0 -_.\n\x7f`{@[日", max_size=60)), max_size=5))
def test_words(texts):
    offsets, words = scan_words(pa.array(texts, pa.string()))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(offsets[:-1], offsets[1:])] == [brute_words(t) for t in texts]


def brute_base(text):
    words, places, labels = brute_words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def brute_labels(scanner, text):
    """Base and method labels without cutting stretches first."""
    number = {w: i for i, w in enumerate(scanner.vocabulary)}
    templates = [[number[w] for w in brute_words(t)] for label in sorted(TEMPLATES) for t in TEMPLATES[label]]
    words = [number.get(w, -1) for w in brute_words(text)]
    found = chains(sorted(brute_matches(templates, words, scanner.min_match)[1]), scanner.max_gap)
    return {scanner.labels[c.template] for c in scanner.spans(found)}


def test_query_over_all_documents(spark, sf):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_licenses(spark, sf).collect()
    assert len(got) == len(rows)
    scanner = LicenseScanner()
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(rows[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])
    said = [r for r in got if r["labels"]]
    for r in said[:8]:
        assert set(r["labels"].split(",")) == (brute_labels(scanner, rows[r["doc_id"]]) | set(r["base_labels"].split(","))) - {""}


def scan(text):
    return {k: v[0] for k, v in LicenseScanner().scan(pa.array([text])).items()}


def test_every_template_is_found_whole_and_damaged():
    for label, texts in TEMPLATES.items():
        for t in texts:
            r = scan("Some words before. " + t + " And some after it.")
            assert label in r["labels"].split(","), label
            words = t.split()
            if len(words) > 40:
                words[20] = "SOMETHING"
                words[30:30] = ["quite", "new"]
                assert label in scan(" ".join(words))["labels"].split(","), label


def test_versions_are_told_apart():
    assert scan("This work is licensed under the GNU General Public License, version 3.")["labels"] == "gpl,gpl-3.0"
    assert scan("This work is licensed under the GNU General Public License, version 2.")["labels"] == "gpl,gpl-2.0"
    assert scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,cc-by-nc-4.0"
    assert scan("Licensed under CC BY 4.0.")["labels"] == "cc-by,cc-by-4.0"
    assert scan("Released under the MIT License.")["labels"] == "mit"


def test_prose_stays_clean():
    r = scan("The use of the software in the office is at the discretion of the staff, and the authors of the report are not liable for any of it.")
    assert r["labels"] == "" and r["spans"] == [] and r["score"] < 0.75


def test_two_notices_give_two_spans():
    mit, isc = TEMPLATES["mit"][0], TEMPLATES["isc"][0]
    r = scan(mit + " x " * 30 + isc)
    assert [s["label"] for s in r["spans"]] == ["mit", "isc"]
    n = len(brute_words(mit))
    assert (r["spans"][0]["first_word"], r["spans"][0]["last_word"], r["spans"][0]["covered"]) == (0, n - 1, n)
    assert r["spans"][1]["first_word"] == n + 30


def test_a_notice_repeated_often_stays_linear():
    r = scan("Licensed under the Apache License, Version 2.0. " * 20_000)
    assert r["n_base"] == 20_000 and len(r["spans"]) == 20_000


def test_overlapping_spans_keep_the_one_that_covers_more():
    s = LicenseScanner({"long": ["a b c d e f g h"], "short": ["a b c d"]}, {})
    assert [(c.template, c.first, c.last) for c in s.spans(chains(s.automaton.matches(s.codes(pa.array("a b c d e f g h".split(), pa.large_string())).tolist(), 0, 4), 3))] == [(0, 0, 7)]
    assert chains([(0, 0, 0, 4), (0, 6, 5, 4)], 3) == [Chain(0, 0, 9, 8)]


def test_odd_rows(spark, odd_docs, no_docs):
    got = license_scan(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_text = {r["text"]: r for r in got}
    for t in (None, "", " \t\n "):
        r = by_text[t]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"], r["spans"]) == (0, 0, None, None, "", "", 0.0, [])
    for r in got:
        assert r["n_words"] == len(brute_words(r["text"])) and r["kept"] is True
    assert license_scan(no_docs).count() == 0
