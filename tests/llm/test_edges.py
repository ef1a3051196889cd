"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sunledger.llm import common, decontaminate, fingerprint, language, language_model, licenses, near_dedup, packing, repeats, token_files, url_filter
from sunledger.llm.registry import URL_RULES

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 9973} is{i % 7}" for i in range(400_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the big red dog in the garden.", "en", "a", 10),
    (2, "The cat sat on the mat and looked at the big red dog in the garden.", "en", "a", 10),
    (2, "Der Hund lief schnell über die große Wiese hinter dem alten Haus.", "de", None, None),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 0),
    (6, "123 456 ... !!", None, "b", 0),
    (None, "Le chat est assis sur la table de la cuisine avec un grand chien.", "fr", "c", 1),
    (None, "Le chat est assis sur la table de la cuisine avec un grand chien.", "fr", "c", 1),
    (7, "Der Hund lief schnell über die große Wiese hinter dem alten Haus.", "de", "c", 1),
    (8, "word", "en", "c", 1),
    (9, LONG, "en", "long", 5),
    (10, "日本語 のテキスト <|endoftext|> émoji 😀 a\u00a0b  c\r\nd", None, "x", 5),
    (10, "日本語 のテキスト <|endoftext|> émoji 😀 a\u00a0b  c\r\nd", None, "x", 5),
    (-5, "The The The The The The The The " * 40, "en", "x", 5),
]
CLASHES = ["block", "row", "bucket", "node", "rows", "ends", "data", "score", "lang_pred", "text_hash", "group_id", "_id", "_text", "k", "h", "c0", "held_out", "absent", "answers"]


def clashing(df):
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return clashing(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "sat on the mat and looked at the big red dog in"), (1, "sat on the mat and looked at the big red dog in"), (2, None), (3, ""), (None, "word"), (4, "nothing of this stands anywhere")]
    return spark.createDataFrame(rows, "item_id long, text string")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=str)


ALL = sorted((r[0] for r in ROWS), key=str)


def test_licenses(docs, none):
    model = licenses.fit(docs)
    got = licenses.scan(docs, model).collect()
    assert ids(got) == ALL
    assert {r["doc_id"]: r["n_paragraphs"] for r in got if r["doc_id"] in (3, 4, 5)} == {3: 0, 4: 0, 5: 2}
    assert all(not n["confirmed"] for r in got for n in r["notices"])
    assert licenses.scan(none, licenses.fit(none)).collect() == []


def test_language_model(docs, none):
    held = docs.drop("held_out").withColumn("held_out", F.col("doc_id") == 1).fillna({"held_out": False})
    got = language_model.score(held).collect()
    assert ids(got) == ALL
    assert all(r["score"] < 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert language_model.score(none.drop("held_out").withColumn("held_out", F.lit(False))).collect() == []
    alone = language_model.score(docs.drop("held_out").withColumn("held_out", F.lit(True))).collect()
    assert {r["train_tokens"] for r in alone} == {0} and {r["n_known"] for r in alone} == {0}


def test_language(docs, none):
    model = language.fit(docs, PIECES)
    got = {r["doc_id"]: r for r in language.predict(docs, model, "doc_id").collect()}
    assert [got[i]["lang_pred"] for i in (3, 4, 5, 6)] == ["und"] * 4
    assert got[7]["lang_pred"] == "de" and got[None]["lang_pred"] == "fr"
    empty = language.fit(none, PIECES)
    assert {r["lang_pred"] for r in language.predict(docs, empty, "doc_id").collect()} == {"und"}
    assert language.predict(none, model, "doc_id").collect() == []


def test_fingerprints(docs, none, spark):
    got = fingerprint.compare_with_next(docs).collect()
    assert ids(got) == ALL
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (3, 4)}) == 1
    assert fingerprint.compare_with_next(none).collect() == []
    (one,) = fingerprint.compare_with_next(spark.createDataFrame(ROWS[:1], SCHEMA)).collect()
    assert one["near_next"] == 1.0


def test_packing(docs, none):
    got = packing.pack(docs, BPE).collect()
    assert ids([r for r in got if r["piece"] == 0]) == ALL
    for seq in {r["sequence_id"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["sequence_id"] == seq), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    assert packing.pack(none, BPE).collect() == []


def test_repeats(docs, none):
    got = repeats.removals(docs).collect()
    assert ids(got) == ALL
    assert {r["doc_id"]: r["n_removed"] == r["n_bytes"] for r in got}[-5]
    assert repeats.removals(none).collect() == []
    kept = repeats.without_repeats(docs)
    assert kept.schema == docs.schema and kept.count() == len(ROWS)
    assert kept.where("doc_id = 3").head()["text"] is None


def test_token_files(docs, none, spark):
    for df, n in ((docs, len(ROWS)), (none, 0)):
        folder = common.Stage(spark).path("ids")
        token_files.write(df, folder, BPE)
        got = sorted(token_files.read_digests(spark, folder).collect(), key=lambda r: r["start"])
        assert len(got) == n
        assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(n)]
        back = {(r["doc_id"], r["text"]) for r in token_files.read_texts(spark, folder, BPE).collect()}
        assert back == {(r["doc_id"], r["text"] or "") for r in df.collect()}


def test_decontamination(docs, none, bench):
    got = decontaminate.contamination(docs, bench).collect()
    assert ids(got) == ALL
    hit = {(r["doc_id"], r["n_hit"], r["n_items"]) for r in got if r["contaminated"]}
    assert hit == {(1, 12, 1), (2, 12, 1), (8, 1, 1)}
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())
    assert decontaminate.contamination(none, bench).collect() == []
    kept = decontaminate.clean(docs, bench)
    assert kept.schema == docs.schema and kept.count() == len(ROWS) - 3


def test_near_duplicates(docs, none):
    got = near_dedup.near_duplicates(docs).collect()
    assert ids(got) == ALL
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert by[(1, 12)] == 1 and by[(2, 12)] == 1 and by[(7, 8)] == 2 and by[(2, 8)] == 2 and by[(4, 0)] == 4
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert near_dedup.near_duplicates(none).collect() == []
    kept = near_dedup.one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, None, 8, 9, 10, -5]))


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (None, "https://WWW.Example.COM/en/x?q"), (4, "https://example.com/en/x#f"), (5, "ftp://a.net/es/"), (6, "x://com/"), (7, "http://com"), (8, "http://a.org/" + "x" * 100_000), (4, "https://example.com/en/x#f")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("score", F.lit("s")).withColumn("rule", F.lit("r")).withColumn("host", F.lit("h"))
    got = {r["page_id"]: r for r in url_filter.judge(pages, URL_RULES).collect()}
    assert (got[None]["host"], got[None]["path"], got[None]["rule"], got[None]["verdict"]) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (got[4]["rule"], got[4]["verdict"]) == ("example.com/en/", "block")
    assert (got[5]["rule"], got[6]["rule"], got[7]["rule"]) == ("net/es/", "com/", None)
    assert all(got[i]["host"] == got[i]["path"] == "" for i in (1, 2, 3))
    assert url_filter.judge(pages.limit(0), URL_RULES).collect() == []
    unruled = url_filter.judge(pages.where("page_id = 8"), URL_RULES).collect()
    assert [r["verdict"] for r in unruled] == ["allow"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, name, tmp_path):
    bench = spark.createDataFrame([(1, "word")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    step = dict(corpus_pipeline.STAGES)[name]
    got = step(spark, docs, str(tmp_path))
    assert got.count() > 0
    assert name == "best_fit_packing" or got.columns == docs.columns
    assert step(spark, none, str(tmp_path)).count() == 0
