import zlib

from pyspark.sql import functions as F

from spanmask.llm.langid import ORDER, build, identify
from spanmask.llm.text import utf8


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(df, keep=("doc_id", "lang")).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    test = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in test) >= 0.98 * len(test)


def test_labels_of_held_out_rows_do_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = df.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert sorted(identify(df).collect()) == sorted(identify(other).collect())


def test_no_letter_and_nothing_learnt(spark, empty, odd):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("der die das und", "de"), ("the of and to", "en"), ("12 34 !!", "en"), (None, "en"), ("", "en"), ("漢字", "en"), ("→ € …", "en")] * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang_pred for r in identify(df).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 6)] == ["de", "en", "und", "und", "und", "und"] and got[5] != "und"
    assert identify(empty).collect() == []
    assert {r.lang_pred for r in identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert identify(odd).count() == 6


def test_code_lengths_follow_the_escapes():
    """Against the definition, byte by byte."""
    import numpy as np
    import pyarrow as pa

    texts = ["abab abba", "the tea"]
    counts: list[dict] = [{}, {}]
    grams, lang, n = [], [], []
    for i, text in enumerate(texts):
        padded = " " * ORDER + text
        for at in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                node = counts[i].setdefault(padded[at - k:at], {})
                node[padded[at]] = node.get(padded[at], 0) + 1
            grams.append(int.from_bytes(padded[at - ORDER:at + 1].encode(), "big"))
            lang.append(i)
            n.append(1.0)
    model = build(["x", "y"], np.array(grams), np.array(lang), np.array(n))

    def bits(i, history, byte):
        node, price = counts[i].get(history), 0.0
        if node:
            total, distinct = sum(node.values()), len(node)
            if byte in node:
                return -np.log2(node[byte] / (total + distinct))
            price = -np.log2(distinct / (total + distinct))
        return price + (bits(i, history[1:], byte) if history else 8.0)

    for text in ("abba tea", "zzz the"):
        padded = " " * ORDER + text
        got = model.bits(*utf8(pa.array([text])))[0]
        want = [sum(bits(i, padded[at - ORDER:at], padded[at]) for at in range(ORDER, len(padded))) for i in range(2)]
        assert np.allclose(got, want, rtol=1e-5)


def test_a_rare_language_keeps_its_contexts():
    """The contexts of one language do not depend on how much text another one has."""
    import numpy as np
    import pyarrow as pa

    def counted(texts):
        out = {}
        for text in texts:
            padded = " " * ORDER + text
            for at in range(ORDER, len(padded)):
                key = int.from_bytes(padded[at - ORDER:at + 1].encode(), "big")
                out[key] = out.get(key, 0) + 1
        return out

    rare, common = counted(["ozi ruka vimo lesta"]), counted(["the tea and the sea " * 50 + "".join(chr(97 + i * 7 % 26) for i in range(999))])
    grams, lang, n = zip(*[(g, i, float(c)) for i, table in enumerate((common, rare)) for g, c in table.items()])
    model = build(["common", "rare"], np.array(grams), np.array(lang), np.array(n), contexts=60)
    alone = build(["rare"], np.array(list(rare)), np.zeros(len(rare), dtype=int), np.array(list(rare.values()), dtype=float), contexts=60)
    text = utf8(pa.array(["ozi lesta vimo"]))
    assert np.isclose(model.bits(*text)[0][1], alone.bits(*text)[0][0]) and model.bits(*text)[0].argmin() == 1
