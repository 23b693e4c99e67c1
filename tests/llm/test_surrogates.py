import re
from collections import defaultdict

from pyspark.sql import functions as F

from fleetscope.llm import surrogates as sg


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def replaced(spark, texts, key="k"):
    return [r["text"] for r in sg.replace_entities(docs(spark, texts), key).orderBy("doc_id").collect()]


def test_formats_and_coreference(spark):
    a, b, c = replaced(spark, [
        "Write to Jane.Doe-7@Mail4.example.com or call +1 (275) 555-5927, card 4177 1770 2397 8468 from 81.0.209.178.",
        "jane.doe-7@mail4.example.com again; phone +1 (275) 555-5927 / +1 275 555 5927 and 4177177023978468, ip 81.0.209.178",
        'Mr. Alan Brown and Mrs. Mary Brown met Frau Schmidt. Alan was late, said Dr Brown. token = "08813ad77930c5f69132"'])
    mail = re.search(r"\S+@\S+\.com", a).group()
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}-\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.com", mail) and mail.lower() in b
    assert "Jane" not in a and "275" not in a and "81.0.209.178" not in a + b
    phone = re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", a).group()
    assert phone in b and re.sub(r"\D", "", phone) in re.sub(r"\D", "", b.split("/")[1])
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", a).group().replace(" ", "")
    assert card in b and luhn(card) and card[0] == "4"
    ip = re.search(r"\d+\.\d+\.\d+\.\d+", a).group()
    assert ip in b and all(1 <= int(o) <= 254 for o in ip.split("."))
    m = re.fullmatch(r'Mr\. (\w+) (\w+) and Mrs\. (\w+) (\w+) met Frau (\w+)\. Alan was late, said Dr (\w+)\. token = "([0-9a-f]{20})"', c)
    assert m and m[2] == m[4] == m[6] and m[1].endswith("on") and m[3].endswith("ina") and m[5] != m[2] and m[7] != "08813ad77930c5f69132"
    assert "Brown" not in c and "Schmidt" not in c


def test_script_and_gender(spark):
    (a,) = replaced(spark, ["г-жа Елена Иванова и г-н Иванова; κυρία Μαρία Παππά"])
    m = re.fullmatch(r"г-жа (\w+) (\w+) и г-н (\w+); κυρία (\w+) (\w+)", a)
    assert m and m[2] == m[3] and m[1].endswith("ина") and re.fullmatch("[А-Яа-я]+", m[2]) and re.fullmatch("[Ͱ-Ͽ]+", m[5])


def test_surrogates_are_distinct_and_not_real(spark):
    # Nearly every value of a small domain is taken, so many attempts collide.
    rows = [("phone", f"{i:03d}") for i in range(600)] + [("name_s", f"n{i}") for i in range(3000)]
    got = sg.surrogate_map(spark.createDataFrame(rows[600:] + [("ssn", f"{i:04d}") for i in range(900)], "type string, entity string"), "k").collect()
    seen = defaultdict(set)
    for r in got:
        assert r["surrogate"] not in seen[r["type"]]
        seen[r["type"]].add(r["surrogate"])
    assert len(got) == 3900 and not seen["ssn"] & {f"{i:04d}" for i in range(900)}


def test_another_key_gives_others_and_reruns_agree(spark):
    text = ["mail a.b@c.example.org and 10.20.30.40"]
    assert replaced(spark, text, "k") == replaced(spark, text, "k") != replaced(spark, text, "other")


def test_table_has_no_entity_left(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in table.collect()}
    found = {m for t in before.values() for p in (r"[\w.+-]+@[\w.-]+\w", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"(?<!\d)\d{16}(?!\d)", r"[0-9a-f]{20,}")
             for m in re.findall(p, t)}
    got = sg.replace_entities(table)
    assert got.columns == table.columns + ["n_entities"]
    after = {r["doc_id"]: r for r in got.collect()}
    assert found and not [m for m in found if any(m in r["text"] for r in after.values())]
    assert all((after[d]["text"] == t) == (after[d]["n_entities"] == 0) for d, t in before.items())


def test_odd_rows(odd_docs, no_docs):
    rows = sg.replace_entities(odd_docs.withColumn("n_entities", F.lit("x")).withColumn("d1", F.lit(3)))
    got = {(r["doc_id"], r["text"]) for r in rows.collect()}
    assert got == {(r["doc_id"], r["text"]) for r in odd_docs.collect()} and rows.count() == odd_docs.count()
    assert sg.replace_entities(no_docs).count() == 0


def test_very_long_text_with_many_mentions(spark):
    (a,) = replaced(spark, [" ".join(f"user{i}@mail.example.com" for i in range(3000)) + " " + "x" * 200_000])
    found = re.findall(r"\S+@mail\S*|\S+@\S+\.com", a)
    assert len(found) == len(set(found)) == 3000


def test_whole_names_particles_and_bare_repeats(spark):
    a, b, c, d = replaced(spark, [
        "Mary Anne Smith met Mr. John Ronald Brown. Brown said BROWN's brown hat; Mary left Brownie and Smith.",
        "Carmen de la Cruz, Herr von Braun, Monsieur de Villiers et Madame d’Artagnan; Braun, Villiers, Cruz, l'Artagnan.",
        "Carlos y María Ruiz saw Mrs Brown's house and Mr Brown.", "Brown bread without a person, 10.20.30.40"])
    m = re.fullmatch(r"(\w+) (\w+) (\w+) met Mr\. (\w+) (\w+) (\w+)\. (\w+) said (\w+)'s brown hat; (\w+) left Brownie and (\w+)\.", a)
    assert m and m[6] == m[7] and m[8] == m[6].upper() and m[9] == m[1] and m[10] == m[3]
    assert not re.search("Mary|Anne|Smith|John|Ronald|Brown(?!ie)|BROWN", a)
    m = re.fullmatch(r"(\w+) de la (\w+), Herr von (\w+), Monsieur de (\w+) et Madame d’(\w+); (\w+), (\w+), (\w+), l'(\w+)\.", b)
    assert m and (m[6], m[7], m[8], m[9]) == (m[3], m[4], m[2], m[5]) and not re.search("Carmen|Cruz|Braun|Villiers|Artagnan", b)
    m = re.fullmatch(r"Carlos y (\w+) (\w+) saw Mrs (\w+)'s house and Mr (\w+)\.", c)
    assert m and m[3] == m[4] and m[1] != "María" and d.startswith("Brown bread")
    counts = {r["doc_id"]: r["n_entities"] for r in sg.replace_entities(docs(spark, ["Mr. Brown left. Brown came back, Brown slept."])).collect()}
    assert counts == {0: 3}


def test_letters_of_scripts_without_spaces_beside_mentions(spark):
    values = ["97.51.17.173", "4177 1770 2397 8468", "DE89 3704 0044 0532 0130 00", "123-45-6789", "+1 (017) 555-7713",
              "sk_abcdefghijklmnop1234", "08813ad77930c5f69132", "jane.doe@mail.example.com"]
    for before, after in (("地址", "请回复"), ("アドレス", "です"), ("주소", "에서"), ("ที่อยู่", "ครับ")):
        got = replaced(spark, [before + v + after for v in values])
        for v, t in zip(values, got):
            assert t.startswith(before) and t.endswith(after) and v not in t and len(t) >= len(before + after) + 7, (v, t)
        assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", got[4][len(before):-len(after)]) and "+1 (017)" not in got[4]
        assert re.fullmatch(r"[a-z]{4}\.[a-z]{3}@[a-z]{4}\.[a-z]{7}\.com", got[7][len(before):-len(after)])
    a, b, c = replaced(spark, ["见用户@mail.example.com", "mail user@例子.公司 now", "Mr. Brown说"])
    assert "用户" not in a and "例子" not in b and "user" not in b and re.fullmatch(r"Mr\. \w+说", c) and "Brown" not in c
