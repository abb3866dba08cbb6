"""The registered queries against their DuckDB SQL, and the pipeline's stages."""

import random
import uuid
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.test_queries import _bag
from tidemark.llm import decontaminate, queries, rows, simhash
from tidemark.sinks import tables
from tidemark.sinks.tables import materialize


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(res.columns, res.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    want = docs
    for _, stage in corpus_pipeline.STAGES[:3]:  # the filters, one after the other
        want = stage(spark, want, SF_SMALL).select(*docs.columns)
    assert ids == {r.doc_id for r in want.select("doc_id").collect()}
    assert out.columns == [*docs.columns, "size", "shard", "slot"]


def _near(fps):
    """Groups of fingerprints that differ in at most three bits, directly or through others."""
    root = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_pipeline_stages_against_brute_force(spark):
    """Each filter's rows at sf0.001 from its own definition, by comparing everything with everything."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.score for r in queries.op6_toxicity(spark, SF_SMALL).collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF_SMALL).collect()}
    assert kept == {i for i in texts if scores[i] < 0.5} and 0 < len(kept) < len(texts)

    fps = {i: simhash.fingerprint(t, 3) & (1 << 64) - 1 for i, t in texts.items()}
    ids = sorted(texts)
    root = _near([fps[i] for i in ids])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL).collect()}
    assert kept == {i for k, i in enumerate(ids) if root[k] == k}

    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    pairs = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items, cosine=-1.0).collect()}  # every passage
    gone = texts.keys() - {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, SF_SMALL).collect()}
    assert gone <= {d for d, _ in pairs} and len(gone) >= 0.9 * len({d for d, _ in pairs})

    placed = corpus_pipeline.shard(spark, docs, SF_SMALL).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t in texts.items()}
    total, done = sum(sizes.values()), 0
    want = {}
    for i in ids:
        done += sizes[i]
        want[i] = min(15, (2 * done - sizes[i]) * 16 // (2 * total))
    assert {r.doc_id: r.shard for r in placed} == want and {r.doc_id: r.text for r in placed} == texts
    for k in set(want.values()):
        assert sorted(r.slot for r in placed if r.shard == k) == list(range(list(want.values()).count(k)))


@pytest.mark.parametrize("given", [[], [(None, None, None, None, None)] * 3, [(1, "one text", "en", "s", 8)]])
def test_pipeline_of_odd_tables(spark, tmp_path, given):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == min(1, len(given))


def test_pipeline_deletes_what_it_does_not_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "work_path", lambda s, *parts: f"{tmp_path}/{'-'.join(parts)}-{uuid.uuid4().hex}")
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and len(list(tmp_path.iterdir())) == 1


def test_rows_are_joined_where_they_are_read(spark, tmp_path):
    rng = random.Random(3)
    spark.createDataFrame([(i, "x" * rng.randint(0, 9), i % 3) for i in range(500)], "i long, t string, __row int").repartition(7).write.parquet(f"{tmp_path}/t")
    keyed = rows.keyed(spark.read.parquet(f"{tmp_path}/t"))
    keys = {r.i: r[rows.ROW] for r in keyed.collect()}
    assert len(set(keys.values())) == 500 and keyed.columns.count(rows.ROW) == 1
    thin = materialize(keyed.where("i % 4 = 0").select(rows.ROW, (F.col("i") + 1000).alias("n")))
    for most in (1000, 20, 1):  # one part, some, a part for each file
        left = {r.i for r in rows.join_rows(keyed, thin, "left_anti", most).collect()}
        assert left == {i for i in range(500) if i % 4}
        both = rows.join_rows(keyed, thin, "left", most)
        assert {r.i: r.n for r in both.collect()} == {i: None if i % 4 else i + 1000 for i in range(500)}
        assert "Exchange hashpartitioning" not in both._jdf.queryExecution().executedPlan().toString()
    assert rows.unkeyed(keyed).columns == ["i", "t"]


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(n))


def test_pipeline_filters_decide_by_row(spark, tmp_path):
    rng = random.Random(14)
    items = [(k, _prose(rng, 30)) for k in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean, copy, lone = [_prose(rng, 80) for _ in range(12)], _prose(rng, 80), _prose(rng, 80)
    leaks = [_prose(rng, 40) + " " + t + " " + _prose(rng, 40) for _, t in items]
    texts = [(1, t) for t in clean[:6]] + [(None, t) for t in clean[6:]]  # ids that stand for many texts
    texts += [(1, leaks[0]), (None, leaks[1]), (2, leaks[2])]
    texts += [(None, copy), (7, copy), (7, copy), (1, copy), (None, lone), (None, lone)]
    rows = [(i, t, "en", "rare" if k == 0 else "big", len(t)) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    def bag(df):
        return Counter((r.doc_id, r.text) for r in df.collect())

    want = Counter(texts) - Counter([(1, leaks[0]), (None, leaks[1]), (2, leaks[2])])
    assert bag(corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))) == want
    groups = {}
    for i, t in texts:
        groups[t] = min(groups.get(t, (True, 0)), (i is None, i or 0))
    assert bag(corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))) == Counter(
        (None if none else i, t) for t, (none, i) in groups.items())
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert bag(mixed) >= Counter(texts) and {r.source for r in mixed.collect() if r.text == clean[0]} == {"rare"}
    assert max(bag(mixed)[i, t] / n for (i, t), n in Counter(texts).items()) <= 2
