import zlib

from pyspark.sql import functions as F

from tests.llm.conftest import corpus
from touchpath.llm import langid
from touchpath.llm.queries import QUERIES


def test_held_out_accuracy_on_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    out = QUERIES["op3_language_id"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(truth)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert sum(r["rejected"] for r in out) <= 0.01 * len(out)


def test_letterless_null_and_odd_rows(spark, table):
    rows = corpus() + [(9001, "123 -- !!", "en", "s", 9), (9002, "😀😀", "en", "s", 2), (9003, "Ω", "en", "s", 1), (9004, "é" * 70000, "fr", "s", 1)]
    out = QUERIES["op3_language_id"](spark, table(rows)).collect()
    assert len(out) == len(rows)
    und = {r["doc_id"] for r in out if r["lang_pred"] == "und"}
    assert und == {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert all(r["rejected"] and r["score"] == 0 for r in out if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in out} <= {"en", "fr", "und"}


def test_nothing_learned_and_empty_table(spark, table):
    rows = [(i, "some text", None, None, 0) for i in range(5)]
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in QUERIES["op3_language_id"](spark, table(rows)).collect()} == {("und", 0.0, False)}
    assert QUERIES["op3_language_id"](spark, table([])).collect() == []


def test_scores_do_not_depend_on_blocks_or_batches(docs, monkeypatch):
    model = langid.fit(docs)
    assert model.langs == ["en", "fr"]
    one = {r["text"]: r["score"] for r in langid.identify(docs, model).collect()}
    monkeypatch.setattr(langid, "_BLOCK", 97)
    two = {r["text"]: r["score"] for r in langid.identify(docs.repartition(1), model).collect()}
    assert all(abs(one[t] - two[t]) < 1e-9 for t in one)


def test_labels_of_predicted_rows_are_no_input(docs):
    model = langid.fit(docs)
    out = langid.identify(docs, model).select("text", "lang_pred", "score")
    blind = langid.identify(docs.withColumn("lang", F.lit("zz")).withColumns({c: F.lit(7) for c in ("score", "_guess", "_letter", "guess", "letter", "row")}), model).select("text", "lang_pred", "score")
    assert sorted(map(str, out.collect())) == sorted(map(str, blind.collect()))


def test_copies_and_nulls_do_not_shrink_the_sample(spark, monkeypatch):
    rows = [(i, f"the text number {i % 20} of few", "en") for i in range(6000)] + [(i, f"le texte {i}", "fr") for i in range(100)]
    rows += [(i, None, "fr") for i in range(5000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langid, "train", lambda lang_of, *rest: seen.extend(lang_of))
    langid.fit(d)
    learned = {t for i, t, lang in rows if t and lang == "fr" and zlib.crc32(str(i).encode()) % 3 != 1}
    # each text whole and as an excerpt
    assert seen.count("en") == 2 * 20 and seen.count("fr") == 2 * len(learned)
