import re
from collections import Counter

from fleetscope.llm.repetition import RepetitionRules, quality_rules
from tests.conftest import SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
    words = [text[a:b] for a, b in spans]

    def cover(n):
        grams = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        inside = set()
        for i in range(len(words) - n + 1):
            if grams[tuple(words[i:i + n])] > 1:
                inside.update(range(i, i + n))
        return inside
    seen, lines, chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                lines += 1
                chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_dup_lines": lines, "dup_line_chars": chars, "n_repeat_words": len(cover(8))}
    for n in RepetitionRules().ngrams:
        out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in cover(n))
    rules = RepetitionRules()
    out["base_failed"] = len(words) < 20 or 100 * out["n_repeat_words"] > 30 * len(words)
    out["kept"] = not out["base_failed"] and chars <= rules.max_line_share * out["word_chars"] and all(
        out[f"dup_{n}gram_chars"] <= s * out["word_chars"] for n, s in zip(rules.ngrams, rules.max_ngram_share))
    return out


def hold(rows):
    for r in rows:
        want = brute(r["text"])
        assert {k: r[k] for k in want} == want, r["doc_id"]


def test_equals_brute_force(spark, sf):
    hold(quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).collect())


def test_odd_rows(odd_docs, no_docs):
    got = quality_rules(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and got.columns.count("n_words") == 1
    hold(rows)
    assert quality_rules(no_docs).count() == 0


def passages(length, times, total=1000):
    """``total`` words, ``times`` passages of ``length`` words standing twice, each between words of its own."""
    fresh = iter(range(10_000, 99_999))
    parts = [[str(next(fresh)) for _ in range(length)] for _ in range(times)]
    words = []
    for part in parts + parts:
        words += [*part, str(next(fresh))]
    return words + [str(next(fresh)) for _ in range(total - len(words))]


def test_each_rule_rejects_by_itself(spark):
    single = [str(x) for x in range(10_000, 11_000)]
    lines = passages(4, 48)
    cut = [i for i in range(0, 96 * 5, 5)]
    as_lines = "\n".join([" ".join(lines[i:i + 4]) + "\n" + lines[i + 4] for i in cut] + [" ".join(lines[96 * 5:])])
    texts = {"clean": " ".join(single), "lines": as_lines, "5": " ".join(passages(5, 35)), "6": " ".join(passages(6, 26)), "8": " ".join(passages(8, 18, 990)),
             "10": " ".join(passages(120, 1)), "below": " ".join(passages(95, 1))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    rules = RepetitionRules()
    failing = {}
    for r in quality_rules(docs).collect():
        share = {str(n): r[f"dup_{n}gram_chars"] / r["word_chars"] for n in rules.ngrams}
        over = {k for k, limit in zip(share, rules.max_ngram_share) if share[k] > limit}
        failing[r["doc_id"]] = over | ({"lines"} if r["dup_line_chars"] > rules.max_line_share * r["word_chars"] else set())
        assert not r["base_failed"] and r["kept"] == (not failing[r["doc_id"]]), r["doc_id"]
    assert failing == {k: (set() if k in ("clean", "below") else {k}) for k in texts}


def test_labelled_texts(spark):
    """Beyond the base rule the limits reject no text labelled good."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").join(spark.read.parquet(f"{SF01}/labels.parquet").filter("quality = 1").select("doc_id"), "doc_id")
    judged = quality_rules(docs)
    assert judged.filter("NOT base_failed").count() > 100 and judged.filter("NOT base_failed AND NOT kept").isEmpty()
