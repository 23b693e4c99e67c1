import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fleetscope.llm.alignment import Aligner, align_documents, alignment_report, default_paths
from fleetscope.llm.queries import op12_alignment
from fleetscope.llm.tokens import byte_of_letter


@pytest.fixture(scope="module")
def sides():
    a, b = default_paths()
    t = Tokenizer.from_file(a)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=b)


@pytest.fixture(scope="module")
def own():
    return Aligner(*default_paths())


def brute(sides, text):
    """Ids of both sides, groups text and links by comparing all intervals."""
    letters = byte_of_letter()
    a = sides[0].encode(" " + (text or ""), add_special_tokens=False).ids
    b = sides[1].encode(text or "")
    bytes_a = [bytes(letters[c] for c in sides[0].id_to_token(i)) for i in a]
    bytes_b = [bytes([int(sides[1].id_to_piece(i)[3:-1], 16)]) if sides[1].is_byte(i) else sides[1].id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = b" " + (text or "").encode()
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], [], "", []

    def spans(parts):
        at = 0
        for p in parts:
            yield at, at + len(p)
            at += len(p)

    sa, sb = list(spans(bytes_a)), list(spans(bytes_b))
    links, first = [], 0
    for i, (s, e) in enumerate(sa):
        while sb[first][1] <= s:
            first += 1
        j = first
        while j < len(sb) and sb[j][0] < e:
            links.append((i, j))
            j += 1
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, i, j = [], 0, 0
    for c in cuts:
        k, m = i, j
        while k < len(sa) and sa[k][1] <= c:
            k += 1
        while m < len(sb) and sb[m][1] <= c:
            m += 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    return a, b, ";".join(groups), links


def reports(sides, rows):
    done = [(doc_id, *brute(sides, text)) for doc_id, text in rows]
    count = Counter(p for _, a, b, _, links in done for p in {(a[i], b[j]) for i, j in links})
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, a, b, groups, links in done:
        n = [(count[a[i], b[j]], most[a[i]]) for i, j in links]
        out.append((doc_id, len(a), len(b), len(groups.split(";")) if groups else 0, len(links), sum(x == y for x, y in n), sum(x for x, _ in n), groups))
    return out


ODD = ["", " ", "  two  spaces \n\n and lines\t", "a▁b", "<|endoftext|> <s> <0x0A> </s>", "日本語のテキスト、漢字。", "naïve café ﬁne ſtart", "\x00\x01 \x85 \xa0 x",
       "🙂🙃 emoji 👩‍👩‍👧", "I'll we've they'd 's 'S", "12345 67,890.12", " " * 3000 + "x" + "\n" * 700, "x" * 5000, "Ω≈ç√∫˜µ≤≥÷", "İstanbul ǅ ŉ ẞ"]


def one(own, text):
    x = own.align(pa.array([text], pa.string()))
    links = sorted(zip(x.link_a.tolist(), x.link_b.tolist()))
    return x.a_ids.tolist(), x.b_ids.tolist(), own.group_texts(x)[0].as_py(), links


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_brute_force(own, sides, text):
    assert one(own, text) == brute(sides, text)


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(st.text(max_size=80), st.text(alphabet="abcdeéü ßIlL'stv.,\n\t 0129<|>", max_size=200),
                      st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=120)))
def test_any_text_equals_brute_force(own, sides, text):
    assert one(own, text) == brute(sides, text)


def test_a_text_that_differs_drops_out_alone(own, sides):
    texts = ["good text", "a▁b", None, "more of it", "", "▁"]
    x = own.align(pa.array(texts, pa.string()))
    assert [bool(n) for n in (x.a_off[1:] - x.a_off[:-1])] == [True, False, False, True, False, False]
    assert own.group_texts(x).to_pylist() == [brute(sides, t)[2] for t in texts]


key = lambda r: (r[0] is not None, r[0] or 0, r[-1])


@pytest.mark.parametrize("parts", [1, 7])
def test_report_equals_brute_force(spark, sf, odd_docs, no_docs, sides, parts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for table in (docs, odd_docs):
        table = table.select("doc_id", "text")
        want = reports(sides, [(r["doc_id"], r["text"]) for r in table.collect()])
        got = alignment_report(table.repartition(parts))      # one block a task at least
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert alignment_report(no_docs).count() == 0


def test_query_gives_digests(spark, sf, sides):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in reports(sides, [(r["doc_id"], r["text"]) for r in docs])]
    got = op12_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_documents_carry_links_and_groups(spark, odd_docs, no_docs, sides):
    got = align_documents(odd_docs).collect()
    want = [(r["doc_id"], *brute(sides, r["text"])) for r in odd_docs.collect()]
    mine = [(r["doc_id"], r["a_ids"], r["b_ids"], r["groups"], [tuple(x) for x in r["links"]]) for r in got]
    by = lambda r: (key(r[:1] + (r[3],)), r[1])
    assert sorted(mine, key=by) == sorted(want, key=by)
    assert align_documents(no_docs).count() == 0
