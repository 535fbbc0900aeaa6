import hashlib
import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridledger.llm import mixing, simhash

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    root, docs = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{PATH}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, PATH).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs)
    return out


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "personal", "mixing", "bpe"]


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    kept = {r.doc_id for r in steps[1].select("doc_id").collect()}
    rows = labels.collect()
    assert sum(r.doc_id in kept for r in rows if not r.toxic) >= 0.98 * sum(not r.toxic for r in rows)
    assert sum(r.doc_id not in kept for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)


def test_one_of_each_group_stays(steps):
    before = {r.doc_id: simhash.fingerprint(r.text) for r in steps[1].collect()}
    after = {r.doc_id for r in steps[2].collect()}
    low = {i: i for i in before}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(before, 2):
        if (before[a] ^ before[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    assert after == {i for i in before if find(i) == i}


def test_personal_data_is_masked(steps):
    assert steps[3].count() == steps[2].count()
    mail = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    assert steps[2].where(F.col("text").rlike(mail)).count() and not steps[3].where(F.col("text").rlike(mail)).count()
    assert not steps[3].where("n_chars <> char_length(text) AND contains(text, '<EMAIL>')").count()


def test_mixing_keeps_all_and_tokens_decode(steps):
    texts = sorted((r.doc_id, r.text) for r in steps[3].collect())
    assert sorted((r.doc_id, r.text) for r in steps[4].collect()) == texts
    assert sorted((r.doc_id, r.decoded_sha256) for r in steps[5].collect()) == [
        (i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts]


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, PATH).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps[5].collect()))


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(200)]
    one, two, three = (" ".join(words[i : i + 60]) for i in (0, 60, 120))
    rows = [(5, one), (5, one), (6, one), (None, one), (None, two), (None, two), (5, three), (4, three), (4, three), (None, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_distinct(spark, docs.repartition(3), PATH)
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(5, one), (None, two), (4, three), (9, None)]))


def test_result_has_the_order_of_the_mixture(spark, tmp_path):
    names = ["b", "a", "a", "c", "a", "b", "a"]
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "0L AS n_chars").withColumn(
        "source", F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 7 + 1).cast("int")))
    mixed = corpus_pipeline.mix(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), PATH)
    mixed.write.option("maxRecordsPerFile", 700).parquet(f"{tmp_path}/mixed")
    read = spark.read.parquet(f"{tmp_path}/mixed")
    assert len(read.inputFiles()) > 4
    got = {r.mix_order: r.doc_id for r in corpus_pipeline.tokens(spark, read, PATH).collect()}
    assert sorted(got) == list(range(5000)) and sorted(got.values()) == list(range(5000))
    sizes = Counter(names[i % 7] for i in range(5000))
    weights = {s: n**0.5 / sum(m**0.5 for m in sizes.values()) for s, n in sizes.items()}
    order, taken = [names[got[i] % 7] for i in range(5000)], Counter()
    for t, s in enumerate(order, 1):
        taken[s] += 1
        if taken[s] == sizes[s]:
            break
        if t % mixing.BLOCK_ROWS == 0:
            assert all(abs(taken[x] - w * t) < mixing.BLOCK_ROWS for x, w in weights.items())
    assert t > 20 * mixing.BLOCK_ROWS


def test_run_has_the_order(spark, steps):
    rows = corpus_pipeline.run(spark, PATH).collect()
    assert sorted(r.mix_order for r in rows) == list(range(steps[4].count()))
