"""The pipeline's stages and the registered queries."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from plumbline.llm import queries  # noqa: E402

from .conftest import SCHEMA, words  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and labels: clean texts, copies, near copies, a shared passage and toxic texts."""
    r = random.Random(4)
    passage = words(500, 70)
    data, labels = [], []
    for i in range(300):
        toxic = int(i % 6 == 0)
        w = words(i, 90)
        if toxic:
            w[10:10] = ["vermin", "filth", "vermin"]
        if i % 7 == 1:
            w[40:40] = passage
        data.append((i, " ".join(w)))
        if i < 200:
            labels.append((i, 1 - r.randint(0, 1), toxic))
    clean = [d for d in data if d[0] % 6]
    data += [(1000 + i, t) for i, t in clean[:20]]
    data += [(2000 + i, " ".join([*t.split()[:30], "edited", *t.split()[31:]])) for i, t in clean[20:40]]
    data += [(3000, None), (3001, ""), (None, "no id here"), (3002, "x"), (3002, "x")]
    at = tmp_path_factory.mktemp("corpus")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], SCHEMA)
    frame.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), data, clean


def test_stages_on_planted_cases(spark, corpus):
    at, data, clean = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    toxicity, simhash, substrings, packing = (f for _, f in corpus_pipeline.STAGES)
    one = toxicity(spark, docs, at)
    kept = [r["doc_id"] for r in one.collect()]
    assert one.columns == docs.columns and not [i for i in kept if i is not None and i < 300 and i % 6 == 0]
    assert {i for i, _ in clean} <= set(kept) and len(kept) == len(data) - 50
    two = simhash(spark, docs, at)
    kept = [r["doc_id"] for r in two.collect()]
    assert two.columns == docs.columns and not [i for i in kept if i is not None and 1000 <= i < 3000]
    assert set(range(300)) <= set(kept) and kept.count(3002) == 1
    three = substrings(spark, docs.where("doc_id < 300"), at)
    texts = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == docs.columns and sum(" ".join(words(500, 70)) in r["text"] for r in texts.values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    assert all(texts[i]["text"] == t for i, t in data if i is not None and i < 300 and i % 7 != 1)
    four = packing(spark, docs, at)
    assert four.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert four.where("piece = 0").count() == len(data)


def test_run_is_the_stages_one_after_the_other(spark, corpus):
    at, data, clean = corpus
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, at).select("doc_id").collect()]
    assert {i for i, _ in clean} <= set(got) and len(got) == len(set(got)) == len(clean) + 3


def test_stages_on_an_empty_table(spark, corpus):
    at, _, _ = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, at).count() == 0


def test_stages_with_clashing_columns(spark, corpus):
    """Columns named as those that operators use inside or add."""
    at, _, _ = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet").where("doc_id % 5 = 1 or doc_id % 5 = 4").limit(60)
    names = "doc p_toxic p_low_quality sequence_id offset piece start length ids id row key fp node size ticket root least text_hash h1 pos label family run other a b n_words n_removed n place".split()
    docs = docs.withColumns({c: F.lit(7) for c in names if c not in ("n_words", "n_removed")})
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns and out.where(" or ".join(f"`{c}` <> 7" for c in docs.columns[5:])).count() == 0, name
        assert 0 < out.count() <= 60
    packed = corpus_pipeline.pack(spark, docs, at)
    assert packed.where("offset + length > 2048").count() == 0


def test_registered_names():
    numbers = {n.split("_")[0] for n in queries.QUERIES if n.startswith("op")}
    assert numbers == {f"op{k}" for k in range(1, 14)} and "pipeline" in queries.QUERIES
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substrings", "packing"]


@pytest.mark.parametrize("name", ["op1_warc_zstd", "op4_suffix_tree_dedup", "op11_threshold_negatives", "op12_auction_repair", "op13_line_bitmaps"])
def test_sql_twin(spark, name):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    import check_queries

    at = "/root/testdata/sf0.001"
    assert check_queries.compare(queries.QUERIES[name](spark, at), check_queries.connect(at), queries.ORACLES[name])[0] is None
