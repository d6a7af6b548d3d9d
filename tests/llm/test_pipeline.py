import hashlib

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from flowlab.llm import byte_bpe, language_id
from tests.llm.edge import CLASHES, ROWS, edge_docs, no_docs
from tests.llm.test_mixing import expected as mixed
from tests.llm.test_simhash import fingerprint, reachable


def encoded(text: str) -> tuple:
    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.coder(path, P.PATTERN).ranks, special_tokens={})
    ids = library.encode_ordinary(text)
    data = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def brute(rows, languages) -> list[tuple]:
    """(doc_id, n_tokens, digests) of rows (doc_id, text, lang, source); languages: doc ids that pass."""
    rows = [r for r in rows if r[0] in languages]
    last = {r[1]: r for r in sorted(rows, key=lambda r: r[0])}
    rows = list(last.values())
    components = dict(reachable([(r[0], fingerprint(r[1])) for r in rows], 2))
    rows = [r for r in rows if components[r[0]] == r[0]]
    out = []
    for r, plan in zip(rows, mixed(rows), strict=True):
        assert plan[0] == r[0]
        out += [(r[0], *encoded(r[1]))] * plan[4]
    return out


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf_dir).collect()}
    assert len(kept) == len(rows)  # all of these are clean or at least in a language
    found = corpus_pipeline.run(spark, sf_dir).collect()
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found]
    assert sorted(got) == sorted(brute(rows, kept))
    assert all(r.exact and hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in found)


def test_stages_keep_columns_and_survive_edges(spark, tmp_path):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, "").write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns, name
        assert all(r[c] == f"other {c}" for r in after.collect() for c in CLASHES)
        docs = after
    assert all(r.exact for r in corpus_pipeline.encode(spark, docs, "").collect())


def test_language_stage_rejects_what_has_no_letters(spark):
    rows = corpus_pipeline.identify_language(spark, edge_docs(spark), "").collect()
    letters = [r[0] for r in ROWS if r[1] and any(map(str.isalpha, r[1]))]
    assert {r.doc_id for r in rows} <= set(letters)
    assert language_id.UNDETERMINED not in {r.lang for r in rows}
    assert {4, 5, 6, 7, 9} <= {r.doc_id for r in rows}


def test_language_stage_keeps_short_texts_and_drops_foreign_ones(spark):
    known = [(i, "these are the plain words of a language that has been learned " * 3, "en") for i in range(40)]
    odd = [(100, "Ja.", "en"), (101, "日本語の文章は" * 60, None), (102, "1234 !?", None), (103, "xq", None)]
    docs = spark.createDataFrame(known + odd, "doc_id bigint, text string, lang string")
    rows = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert {r.doc_id for r in rows} == {*range(40), 100, 103}


def test_language_stage_without_learned_languages_keeps_all_texts_with_letters(spark):
    texts = [f"This is clean English text number {i}, and it says so." for i in range(20)] + ["12 !?", "", None, "é"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {*range(20), 23} and kept.columns == docs.columns


def test_language_stage_rejects_a_language_that_was_not_learned(spark, sf_dir):
    """One of the languages of the given documents is taken for not labelled: the share of its documents
    that is rejected is stated in README. Of the others a few go that repeat single words a hundred times."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect() if r.lang}
    rates = {}
    for foreign in sorted(counts):
        labelled = docs.withColumn("own", F.col("lang")).withColumn("lang", F.when(F.col("lang") != foreign, F.col("lang")))
        kept = {r.own: r["count"] for r in corpus_pipeline.identify_language(spark, labelled, "").groupBy("own").count().collect()}
        rates[foreign] = 1 - kept.get(foreign, 0) / counts[foreign]
        assert all(kept[lang] >= 0.98 * n for lang, n in counts.items() if lang != foreign)
    print({lang: round(rate, 3) for lang, rate in rates.items()})
    assert min(rates.values()) >= 0.5


def test_every_stage_takes_an_empty_table(spark, tmp_path):
    docs = no_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_near_copies_are_decided_by_row(spark, tmp_path):
    """Ids that repeat or are null name no row: a clean text stays, and a group keeps one document."""
    words = [f"word{i}" for i in range(400)]
    near, clean = " ".join(words), "a clean text that is like no other one here"
    twin = " ".join(f"twin{i}" for i in range(400))
    lone = " ".join(f"lone{i}" for i in range(400))
    rows = [(1, near), (2, near.upper()), (2, clean), (3, twin), (3, twin.upper()), (None, lone), (None, lone.upper())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, _metadata string")
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    for table in (docs, spark.read.parquet(str(tmp_path / "docs"))):
        kept = corpus_pipeline.drop_near_copies(spark, table, "")
        assert kept.columns == docs.columns
        found = sorted((str(r.doc_id), r.text.lower()) for r in kept.collect())
        assert found == sorted([("1", near), ("2", clean), ("3", twin), ("None", lone)])


def test_near_copies_are_found_without_broadcasts(spark, tmp_path, monkeypatch):
    """Only the places of dropped rows, of a fixed number at most, may pass through the driver."""
    rows = spark.range(50).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of text"), F.col("id") % 40).alias("text"))
    rows.write.parquet(str(tmp_path / "rows"))
    plans, real = [], corpus_pipeline.join_narrow

    def watched(left, right, *others):
        plans.append(right._jdf.queryExecution().executedPlan().toString())
        return real(left, right, *others)

    monkeypatch.setattr(corpus_pipeline, "join_narrow", watched)
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "rows")), "")
    assert kept.count() == 40
    assert plans and not any("Broadcast" in plan for plan in plans)


def test_many_places_of_dropped_rows_are_sorted_not_broadcast(spark, tmp_path, monkeypatch):
    """More places than may be broadcast lie in small files: the planner alone would broadcast them."""
    rows = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of text"), F.col("id") % 40).alias("text"))
    rows.write.parquet(str(tmp_path / "rows"))
    docs = spark.read.parquet(str(tmp_path / "rows"))
    few = corpus_pipeline.drop_near_copies(spark, docs, "")
    monkeypatch.setattr(corpus_pipeline, "MOST_PLACES", 3)
    many = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert "Broadcast" in few._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 40
