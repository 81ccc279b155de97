import corpus_pipeline as pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanmask.llm import langid
from spanmask.llm.line_dedup import MIN_PAGES, RATIO

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, empty, SF).collect() == []
    assert pipeline.pack(spark, empty, SF).collect() == []


def test_run_against_brute_force(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    source = {r.doc_id: r for r in read("documents").collect()}
    accepted = {r.doc_id for r in langid.identify(read("documents")).where("lang_pred <> 'und'").collect()}
    docs = {i: r.text for i, r in source.items() if i in accepted}
    pages, having = {}, {}
    for host, text in {(source[i].source or "", t) for i, t in docs.items()}:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in text.split("\n")} - {""}:
            having[host, line] = having.get((host, line), 0) + 1
    gone = {k for k, n in having.items() if n >= MIN_PAGES and n > RATIO * pages[k[0]]}
    docs = {i: "\n".join(x for x in t.split("\n") if (source[i].source or "", x.strip(" ")) not in gone) for i, t in docs.items()}
    near = brute.near_duplicates(list(docs.items()), num=80)
    docs = {i: t for i, t in docs.items() if near[i][2]}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    grams = {tuple(w[i:i + 8]) for w in (brute.words(t, True) for _, t in items) for i in range(len(w) - 7)}
    suspects = [(i, t) for i, t in docs.items() if any(tuple(w[j:j + 8]) in grams for w in [brute.words(t, True)] for j in range(len(w) - 7))]
    leaked = {d for d, _ in brute.leaks(suspects, items)}
    rows = sorted((i, t) for i, t in docs.items() if i not in leaked)
    want = {i: ids for (i, _), (ids, _) in zip(rows, brute.token_digests(rows, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))))}
    got = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        part = want[r.doc_id][r.start:r.start + r.length]
        assert (r.ids_crc32, r.doc_tokens) == (brute.zlib.crc32(part.tobytes()), len(want[r.doc_id]))
    assert sum(r.length for r in got) == sum(map(len, want.values()))


def test_clashing_columns_keep_their_values(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    names = ("held_out", "lang_pred", "score", "_host", "_lines", "n_lines", "n_dropped", "component_id", "kept", "key", "item_id")
    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names}).cache()
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)


def test_odd_rows(spark, odd):
    kept = odd
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
    assert kept.where(F.col("doc_id") == 4).count() == 0


def test_near_dedup_stage_links_from_four_fifths(spark):
    rows = []
    for i in range(40):                                  # shared shingles of 100 in both: 80, and 79 of 101
        shared = [f"s{i}x{j}" for j in range(84)]
        rows += [(10 * i + d, " ".join(shared + [f"o{i}x{d}x{j}" for j in range(10)])) for d in (0, 1)]
        rows += [(1000 + 10 * i + d, " ".join(["t" + w for w in shared[:83]] + [f"p{i}x{d}x{j}" for j in range(11)])) for d in (0, 1)]
    kept = pipeline.near_dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    want = {i for i, (_, _, keep) in brute.near_duplicates(rows, num=80).items() if keep}
    assert {r.doc_id for r in kept.collect()} == want == {i for i, _ in rows if i >= 1000 or i % 10 == 0}


def test_repeated_rows_and_rows_without_id(spark):
    say = lambda name, n=40: " ".join(f"{name}{j}" for j in range(n))
    for last in (7, (1 << 63) - 1):
        rows = [(5, say("a"))] * 4 + [(5 if last == 7 else 6, say("b")), (last, say("c") + " end")]
        rows += [(None, say("a")), (None, say("c") + " stop"), (None, say("d") + " x"), (None, say("d") + " y"), (None, say("e"))]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = [(r.doc_id, r.text[:2]) for r in pipeline.near_dedup_stage(spark, df, SF).collect()]
        assert sorted(t for _, t in got) == ["a0", "b0", "c0", "d0", "e0"] and (None, "d0") in got and (None, "e0") in got
        assert last > 7 or {(5, "a0"), (5, "b0"), (last, "c0")} < set(got)


def test_rows_without_id_are_decontaminated(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, f"some words before {item}"), (None, "a clean text of its own"), (3, item), (4, "another clean text")]
    out = pipeline.decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r.text for r in out.collect()) == ["a clean text of its own", "another clean text"]
