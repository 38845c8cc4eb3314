from __future__ import annotations

import random

from gristmill.llm import decontaminate, license_scan
from gristmill.llm.jaccard_join import WORD


def grams(text, width=5):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(docs, items):
    out = {}
    for d, text in docs:
        has = grams(text)
        for i, item in items.items():
            held = grams(item)
            if held and len(held & has) / len(held) >= 0.8:
                out[d, i] = len(held & has) / len(held)
    return out


def tables(draw):
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: draw.choices(vocabulary, k=n)
    items = {i: " ".join(some(n)) for i, n in enumerate((5, 9, 30, 40, 60, 90, 200, 700, 3))}
    items |= {20: "", 21: None}
    docs = []
    for i in range(9):
        body = items[i].split()
        docs.append((len(docs), " ".join(some(50) + body + some(30))))
        edited = list(body)
        edited[len(edited) // 2] = "edited"
        docs.append((len(docs), " ".join(some(3000) + edited + some(700))))
        docs.append((len(docs), " ".join(body[: len(body) // 2])))
    docs.append((len(docs), " ".join(some(30_000) + items[3].split())))
    docs += [(900, ""), (901, None), (902, "one two"), (None, items[2]), (0, docs[0][1]), (0, items[4])]
    return docs, items


def test_items_against_brute_force(spark):
    docs, items = tables(random.Random(1))
    asked = spark.createDataFrame([(*d, "a", "b", 1) for d in docs], "doc_id long, text string, item string, shingles string, class int")
    tests = spark.createDataFrame(list(items.items()) + [(0, items[0])], "item_id long, text string")
    got = [(r.doc_id, r.item, r.containment) for r in decontaminate.find_items(asked, tests).collect()]
    want = []
    for d in docs:
        want += [(*k, v) for k, v in brute([d], items).items()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)
    kept = decontaminate.without_items(asked, tests)
    assert kept.columns == asked.columns
    bad = {k[0] for k in brute(docs, items)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_large_items_are_shuffled_with_the_same_result(spark, monkeypatch):
    docs, items = tables(random.Random(2))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    asked = spark.createDataFrame(docs[:12], "doc_id long, text string")
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item): r.containment for r in decontaminate.find_items(asked, tests).collect()}
    assert got == brute(docs[:12], items)


def test_short_items_in_long_documents(spark):
    draw = random.Random(6)
    some = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    items = {i: " ".join(some(5 + i % 6)) for i in range(60)} | {60: " ".join(some(20)), 61: " ".join(some(21))}
    docs = []
    for d in range(3):
        words = some(200)
        for i in range(62):
            words += items[i].split() + some(70)
        docs.append((d, " ".join(words)))
    broken = items[60].split()  # 12 of 16 shingles: below the threshold; 13 of 16: above
    docs += [(3, " ".join(some(900) + broken[:16] + some(90))), (4, " ".join(some(900) + broken[:17] + some(90)))]
    asked = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item): r.containment for r in decontaminate.find_items(asked, tests).collect()}
    assert got == brute(docs, items) and len(got) >= 3 * 62 + 1


def test_clean_documents_without_or_with_a_repeated_id_stay(spark):
    item = " ".join(f"w{i}" for i in range(20))
    clean = [" ".join(f"c{i}x{j}" for j in range(20)) for i in range(4)]
    rows = [(None, f"a b c {item}"), (None, clean[0]), (None, clean[1]), (7, item), (7, clean[2]), (8, clean[3]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = [tuple(r) for r in decontaminate.without_items(docs, items).collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if item not in (r[1] or "")], key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(docs, none).count() == 0
    assert decontaminate.without_items(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_items(docs.where("false"), some).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (decontaminate.find_items(docs, some), license_scan.find_licenses(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))


def test_licenses_against_brute_force(spark):
    draw = random.Random(3)
    filler = lambda n: " ".join(draw.choice(("the", "of", "license", "work", "under", "foo", "bar", "2", "0")) for _ in range(n))
    docs = []
    for body in license_scan.TEMPLATES.values():
        docs.append((len(docs), f"{filler(draw.randint(0, 300))}\n{body}\n{filler(40)}"))
        docs.append((len(docs), body.upper()))
        docs.append((len(docs), body[: len(body) // 2]))
    docs += [(500, ""), (501, None), (None, license_scan.TEMPLATES["MIT"]), (502, filler(20_000))]
    asked = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license): r.containment for r in license_scan.find_licenses(asked).collect()}
    assert got == brute(docs, license_scan.TEMPLATES)
    assert license_scan.find_licenses(asked.where("false")).count() == 0


def test_items_of_one_id_or_none_are_all_found(spark):
    draw = random.Random(8)
    some = lambda n: " ".join(draw.choices([f"v{i}" for i in range(4000)], k=n))
    texts = [some(n) for n in (9, 40, 12, 60)]
    items = spark.createDataFrame(list(zip([1, 1, None, None], texts)) + [(1, texts[0])], "item_id long, text string")
    bodies = [f"{some(300)} {t} {some(300)}" for t in texts] + [some(600)]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    found = decontaminate.find_items(docs, items).collect()
    assert sorted((r["doc_id"], str(r["item"]), r["containment"]) for r in found) == [
        (0, "1", 1.0), (1, "1", 1.0), (2, "None", 1.0), (3, "None", 1.0)
    ]
    assert [r["doc_id"] for r in decontaminate.without_items(docs, items).collect()] == [4]
    # A document that holds two items of one id has a row for each.
    both = spark.createDataFrame([(7, f"{texts[0]} {some(50)} {texts[1]}")], "doc_id long, text string")
    assert decontaminate.find_items(both, items).count() == 2


def test_hash_functions_miss_no_more_than_the_formula(spark):
    """Windows of 16 shingles of which 4 are shared: a miss has chance (1 - 4 / 28)^64 = 5e-5."""
    from pyspark.sql import functions as F

    from gristmill.llm.windows import set_signatures, signature_values

    pairs = spark.range(4000).select("id", F.sequence(F.lit(0), F.lit(15)).alias("s"))
    one = pairs.select("id", F.transform("s", lambda i: F.xxhash64("id", i)).alias("h"))
    two = pairs.select("id", F.transform("s", lambda i: F.xxhash64("id", i + 12)).alias("h"))
    values = [signature_values(set_signatures(x, ["id"], "h"), ["id"]) for x in (one, two)]
    met = values[0].join(values[1], ["id", "value"]).select("id").distinct().count()
    assert met >= 3995
    # Unrelated sets meet by chance only.
    other = values[1].withColumn("id", F.col("id") + 1)
    assert values[0].join(other, ["id", "value"]).count() <= 20


def test_templates_can_be_given(spark):
    docs = spark.createDataFrame([(1, "this text is Licensed  under our very own house terms, indeed")], "doc_id long, text string")
    found = license_scan.find_licenses(docs, templates={"house": "licensed under our very own house terms"}).collect()
    assert [(r["license"], r["containment"]) for r in found] == [("house", 1.0)]
    assert license_scan.find_licenses(docs).count() == 0
