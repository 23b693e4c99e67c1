import numpy as np
import pytest

from fleetscope.llm import quality, toxicity
from fleetscope.llm.common import held_out, hinge_dual, labelled_sample
from fleetscope.llm.queries import op1_toxicity, op5_quality

SF01 = "/root/testdata/sf0.1"


def accuracy(spark, rows, target, threshold):
    labels = {r["doc_id"]: r[target] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all((s >= threshold) == bool(p) and 0 <= s <= 1 for _, p, s in got)
    return np.array([(y, p) for y, p, _ in got])


def test_quality_held_out(spark):
    yp = accuracy(spark, op5_quality(spark, SF01).collect(), "quality", 0.7)
    assert len(yp) > 500 and (yp[:, 0] == yp[:, 1]).mean() > 0.94


def test_toxicity_held_out(spark):
    """English and all languages together at the same bounds; the other
    languages, with 11 to 20 held-out positives each, at wider ones."""
    rows = op1_toxicity(spark, SF01).collect()
    assert len(rows) == 10000
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    rates = {}
    for group in (("en",), ("fr",), ("de",), ("es",), ("en", "fr", "de", "es")):
        yp = accuracy(spark, [r for r in rows if lang[r["doc_id"]] in group], "toxic", 0.3)
        rates[group] = (yp[yp[:, 0] == 1][:, 1].mean(), yp[yp[:, 0] == 0][:, 1].mean())
    for group, (recall, alarms) in rates.items():
        wide = len(group) == 1 and group != ("en",)
        assert recall > (0.7 if wide else 0.85) and alarms < (0.05 if wide else 0.02), rates


def test_margin_is_the_naive_kernel_sum(insults):
    """The table's window sums equal sums over all gapped subsequences."""
    model, text = insults
    code = toxicity.fold("a grob nix, so")
    sums = toxicity.window_sums(code, toxicity.position_sums(code, model.table))
    for start in range(len(code)):
        total = 0.0
        for first in range(start, min(start + toxicity.WINDOW, len(code))):
            for steps in toxicity.STEPS:
                at = [first]
                for s in steps:
                    at.append(at[-1] + s)
                if at[-1] < len(code):
                    number = 0
                    for k in at:
                        number = number * toxicity.SYMBOLS + int(code[k])
                    total += float(model.table[number]) * toxicity.DECAY ** (at[-1] - first - toxicity.LENGTH + 1)
        assert abs(total - sums[start]) < 1e-3 * max(1, abs(total))


@pytest.fixture(scope="module")
def insults():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("aeioustrnlmdp"), rng.integers(3, 8)))
    text = lambda k: ". ".join(" ".join(word() for _ in range(8)) for _ in range(k))
    texts = [text(5) for _ in range(200)] + [f"{text(2)} you grobnix {text(2)}" for _ in range(100)]
    y = np.array([0] * 200 + [1] * 100)
    return toxicity.fit(texts, y, np.bincount(y)), text


def test_gaps_and_inserted_characters_are_tolerated(insults):
    model, text = insults
    for form in ("grobnix", "GROBNIX", "g.r.o.b.n.i.x", "gr obnix", "gro-bnix", "grobxnix", "Gröbnix"):
        assert model.score(f"{text(3)} {form} {text(3)}") > 0.3, form
    assert max(model.score(text(6)) for _ in range(30)) < 0.3


def test_degenerate_fits():
    for mod in (toxicity, quality):
        assert abs(mod.fit(["a b", "c"], np.array([1, 1]), np.array([0, 2])).score("" if mod is toxicity else np.zeros(0, np.int64)) - 1) < 1e-6
        assert mod.fit([], np.zeros(0, np.int64), np.array([0, 0])).score("" if mod is toxicity else np.zeros(0, np.int64)) == 0.5


def test_hinge_dual_separates():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 5))
    y = (x @ np.array([1, -2, 0.5, 0, 3]) > 0.2).astype(int)
    w, b = hinge_dual([np.arange(5)] * 300, list(x), y, 5, np.full(300, 10.0), epochs=200)
    assert ((x @ w + b > 0).astype(int) == y).mean() > 0.98


def test_sample_leaves_held_out_rows_alone(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts, y, counts = labelled_sample(docs, labels, "toxic", 10_000, 10 ** 9)
    want = labels.filter(~held_out()).count()
    assert len(texts) == counts.sum() == want and y.sum() == counts[1]


def test_odd_rows(spark, sf, odd_docs, no_docs):
    for mod, target, score in ((toxicity, "toxic", toxicity.score_toxicity), (quality, "quality", quality.score_texts)):
        texts, y, counts = labelled_sample(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), target, 200, 5000)
        model = mod.fit(texts, y, counts)
        got = score(odd_docs, model)
        rows = got.collect()
        assert len(rows) == odd_docs.count() and got.columns.count("score") == 1 and all(0 <= r["score"] <= 1 for r in rows)
        empty = {r["score"] for r in rows if not (r["text"] or "")}
        assert len(empty) == 1
        assert score(no_docs, model).count() == 0
