"""Dictionary recogniser: set form, join form and brute force agree."""

import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from spanmask import anonymize, scan
from spanmask.operators.gazetteer import (GAZETTEER_SCORE, PERSON_NAMES, PLACE_NAMES, Trie, _normal, add_gazetteer, builtin_dictionary,
                                          candidates, fuzzy_spans, gazetteer_detector, gazetteer_spans, measure_dictionary, normalise_dictionary)


def rows_of(df):
    return sorted((r[0], r.term, r.entity_type, r.start, r.end) for r in df.collect())


def test_forms_and_brute_force(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    a = rows_of(gazetteer_spans(docs, "doc_id", "text", broadcast=True))
    assert a == rows_of(gazetteer_spans(docs, "doc_id", "text", broadcast=False))
    assert a == rows_of(gazetteer_spans(docs, "doc_id", "text", max_bytes=10))          # measured too large: joins
    assert a == rows_of(gazetteer_spans(docs, "doc_id", "text", broadcast=False, filter_bits=6))
    terms = {n: "PERSON" for n in PERSON_NAMES} | {n: "LOCATION" for n in PLACE_NAMES}
    want = []
    for r in docs.select("doc_id", "text").collect():
        for m in regex.finditer(r"\p{L}+", r.text):
            t = m.group().lower()
            if t in terms:
                want.append((r.doc_id, t, terms[t], m.start(), m.end()))
    assert a == sorted(want) and len(a) > 0
    det = gazetteer_detector(builtin_dictionary(spark))
    found = docs.select("doc_id", F.inline(det(F.col("text")))).collect()
    assert sorted((r.doc_id, r.entity_type, r.start, r.end) for r in found) == sorted((w[0], w[2], w[3], w[4]) for w in want)
    assert all(r.score == GAZETTEER_SCORE for r in found)


@pytest.fixture()
def dictionary(spark):
    rows = [("paris", "PERSON", 0.4), ("Paris", "LOCATION", 0.9), ("New  York", "LOCATION", 0.8), ("o'brien", "PERSON", 0.7), ("paris", "PERSON", 0.3)]
    return spark.createDataFrame(rows, "term string, entity_type string, score double")


@pytest.mark.parametrize("broadcast", [True, False])
def test_all_labels_and_terms_of_several_words(spark, dictionary, broadcast):
    df = spark.createDataFrame([(1, "PARIS, new\nyork and O'Brien; new, york"), (2, None), (3, "")], "id int, t string")
    got = rows_of(gazetteer_spans(df, "id", "t", dictionary, broadcast=broadcast))
    assert got == [
        (1, "new york", "LOCATION", 7, 15), (1, "o'brien", "PERSON", 20, 27), (1, "paris", "LOCATION", 0, 5), (1, "paris", "PERSON", 0, 5),
    ]


def test_into_scan_and_anonymise(spark, dictionary):
    df = spark.createDataFrame([(1, "Paris a@b.co", "x"), (2, None, "New York"), (3, "", None)], "id int, t string, u string")
    s = scan(df, exclude=["id"])
    joined = anonymize(add_gazetteer(s, "id", dictionary, broadcast=False))
    assert joined.columns == df.columns
    want = [(1, "<LOCATION> <EMAIL_ADDRESS>", "x"), (2, None, "<LOCATION>"), (3, "", None)]
    assert sorted(map(tuple, joined.collect())) == want
    from spanmask import detect
    both = scan(df, exclude=["id"], detector=[detect, gazetteer_detector(dictionary)])
    assert sorted(map(tuple, anonymize(both).collect())) == want


def test_limits_are_checked(spark, dictionary):
    with pytest.raises(ValueError, match="bytes"):
        gazetteer_detector(dictionary, max_bytes=10)
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    with pytest.raises(ValueError, match="bytes"):
        gazetteer_spans(df, "id", "t", dictionary, broadcast=True, max_bytes=10)
    with pytest.raises(ValueError, match="letter"):
        gazetteer_detector(spark.createDataFrame([("c++",)], "term string"))


def test_empty_dictionary(spark):
    df = spark.createDataFrame([(1, "x y")], "id int, t string")
    none = spark.createDataFrame([], "term string")
    for broadcast in (True, False):
        assert gazetteer_spans(df, "id", "t", none, broadcast=broadcast).collect() == []


ALPHABET = ["a", "b", "ab", "é", "İ", "Σ", "ς", "漢", "B", " ", "  ", "\n", "-", "'", "\u00a0", "😀", "7"]


def random_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def random_terms(rng, n):
    terms = {_normal(random_text(rng, rng.randint(1, 8))) for _ in range(3 * n)}
    return sorted(t for t in terms if t and regex.match(r"\p{L}", t[0]) and regex.match(r"\p{L}", t[-1]))[:n]


def test_trie_against_all_candidates():
    rng = random.Random(6)
    terms = random_terms(rng, 60)
    trie = Trie.build([(t, e, 0.5) for i, t in enumerate(terms) for e in ["A", "B"][:1 + i % 2]])
    texts = [random_text(rng, rng.randint(0, 60)) for _ in range(400)] + ["", None, "ab " * 3000]
    got = trie.spans(texts).to_pylist()
    labels = {t: ["A", "B"][:1 + i % 2] for i, t in enumerate(terms)}
    for text, spans in zip(texts, got):
        want = sorted(((a, -b, e) for t, a, b in candidates(text or "", 60) for e in labels.get(t, ())))
        assert [(s["start"], -s["end"], s["entity_type"]) for s in spans] == want


def test_both_forms_on_random_texts(spark):
    rng = random.Random(7)
    dictionary = spark.createDataFrame([(t.upper() if i % 3 else t, "X") for i, t in enumerate(random_terms(rng, 40)) if t.upper().lower() == t], "term string, entity_type string")
    df = spark.createDataFrame([(i, random_text(rng, 50)) for i in range(300)], "id int, t string")
    a = rows_of(gazetteer_spans(df, "id", "t", dictionary, broadcast=True))
    assert a and a == rows_of(gazetteer_spans(df, "id", "t", dictionary, broadcast=False, filter_bits=8))


def test_a_long_term_costs_no_candidates(spark):
    long = " ".join(f"w{chr(97 + i)}" for i in range(20))
    trie = Trie.build([(long, "X", 1.0), ("plain", "Y", 1.0)])
    text = ("plain words of all kinds " * 40_000) + long
    began = time.process_time()
    found = trie.spans([text]).to_pylist()[0]
    assert time.process_time() - began < 5
    assert len(found) == 40_001 and found[-1]["end"] - found[-1]["start"] == len(long)


def test_built_size_is_measured(spark):
    rng = random.Random(9)
    rows = [(t, e, 0.5) for t in random_terms(rng, 200) for e in ("A", "B")]
    terms = normalise_dictionary(spark.createDataFrame(rows, "term string, entity_type string, score double"))
    size, words = measure_dictionary(terms)
    trie = Trie.build([tuple(r) for r in terms.collect()])
    assert trie.nbytes <= size + 64 and words == trie.words


def test_one_pass_for_all_columns(spark, dictionary):
    df = spark.createDataFrame([(1, "Paris", "New York", "x"), (1, "o'brien", None, "Paris"), (2, "", "-", None)], "id int, a string, `b.c` string, d string")
    s = scan(df, exclude=["id"])
    narrow = add_gazetteer(s, "id", dictionary)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and plan.count("Scan ExistingRDD") == 1
    want = sorted([(1, "<LOCATION>", "<LOCATION>", "x"), (1, "<PERSON>", None, "<LOCATION>"), (2, "", "-", None)], key=str)
    assert sorted(map(tuple, anonymize(narrow).collect()), key=str) == want         # also with a repeated id
    unique = df.where("d is null or d <> 'x'")
    joined = add_gazetteer(scan(unique, exclude=["id"]), "id", dictionary, broadcast=False)
    assert sorted(map(tuple, anonymize(joined).collect()), key=str) == want[1:]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("bits", [26, 6])
def test_fuzzy_against_edit_distance(spark, bits):
    rng = random.Random(10)
    terms = ["maria", "marie", "new york", "o'brien", "abcdef", "müller", "abc", "san juan de"]
    pieces = terms + ["mario", "mara", "newyork", "new  yrk", "obrien", "mullr", "muller", "xbcdef", "san juande", "abd", "word", "MARIA", "marria", "NEW YORKS"]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(99, None)]
    dictionary = spark.createDataFrame([(t, "X", 0.5) for t in terms], "term string, entity_type string, score double")
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    got = sorted((r.id, r.word, r.term, r.distance, r.start, r.end, r.score) for r in fuzzy_spans(df, "id", "t", dictionary, filter_bits=bits).collect())
    want = []
    for i, text in rows:
        for word, a, b in candidates(text or "", 3):
            for t in terms:
                d = levenshtein(word, t)
                if len(t) >= 5 and d <= 1:
                    want.append((i, word, t, d, a, b, 0.5 if d == 0 else 0.4))
    assert got == sorted(want) and any(w[3] for w in want)


def test_fuzzy_on_nothing(spark):
    df = spark.createDataFrame([(1, "x y")], "id int, t string")
    assert fuzzy_spans(df, "id", "t", spark.createDataFrame([], "term string")).collect() == []
    assert fuzzy_spans(df.limit(0), "id", "t").collect() == []
