"""The corpus pipeline and the registered queries on sf0.001, each stage against a brute-force version."""

import collections
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acreage.llm import decontaminate, queries, quality_rules
from acreage.llm.words import Words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The tables of sf0.001, with columns whose names clash with the operators' own, null ids and texts, and repeated rows."""
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.where("doc_id = 5")).unionByName(docs.where("doc_id = 5").withColumn("text", F.lit(None).cast("string")))
    clash = {c: F.col("doc_id") + 1000 for c in ("n_words", "kept", "probability", "_doc", "_row", "_t", "_n", "_size", "_unit", "_bucket", "_mark", "kinds", "_k", "_c0", "node")}
    docs.unionByName(odd).withColumns(clash).write.parquet(f"{folder}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    return folder


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def roots(sets):
    root = {s: s for s in sets}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    several = list(sets)
    for i, a in enumerate(several):
        for b in several[:i]:
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    return {s: find(s) for s in sets}


def plain(text):
    w = Words.of(pa.array([text or ""]), lower=True, plain=True)
    return w.hashes()


def test_alignment():
    rng = np.random.default_rng(4)
    for _ in range(30):
        item, passage = rng.integers(0, 4, 6), rng.integers(0, 4, 12)
        h = np.zeros((7, 13))
        for i in range(6):
            for j in range(12):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if item[i] == passage[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.align(item, passage)[0] == h.max() / 12


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "jaccard_join", "decontamination", "mixing", "sharding"]
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: str((r.doc_id, r.text))

    kept = stages["quality_rules"](spark, docs, sf_dir).cache()
    assert kept.columns == docs.columns and kept.where("not (n_words <=> doc_id + 1000)").count() == 0
    model = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    w = Words.of(pa.array([r.text or "" for r in docs.collect()]))
    verdict = ~quality_rules.base_failed(quality_rules.figures(w, w.hashes())) & (model.probability(w, w.hashes()) >= 0.5)
    assert sorted(map(key, kept.collect())) == sorted(key(r) for r, v in zip(docs.collect(), verdict, strict=True) if v) and 50 < kept.count() < docs.count()

    one = stages["jaccard_join"](spark, docs, sf_dir).cache()
    assert one.columns == docs.columns
    rows = docs.collect()
    classes = roots({shingles(r.text) for r in rows if words(r.text)})
    best = {}
    for r in rows:
        if words(r.text):
            root = classes[shingles(r.text)]
            best[root] = min(best.get(root, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    got = one.collect()
    assert collections.Counter((r.doc_id is None, r.doc_id or 0) for r in got if words(r.text)) == collections.Counter(best.values())
    assert sum(not words(r.text) for r in got) == sum(not words(r.text) for r in rows) and len(best) < len(rows) - 5

    clean = stages["decontamination"](spark, docs, sf_dir)
    assert clean.columns == docs.columns
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    said = [r for r in rows if not any(decontaminate.align(x, plain(r.text))[0] >= 0.5 for x in items if len(x) >= 3)]
    assert sorted(map(key, clean.collect())) == sorted(map(key, said)) and len(said) < len(rows)

    mixed = stages["mixing"](spark, docs, sf_dir).collect()
    size = collections.Counter()
    for r in rows:
        size[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, target, left, open_ = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, {}, 1.5 * sum(size.values()), set(order)
    while full := {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]}:
        target |= {s: 2 * size[s] for s in full}
        left, open_ = left - sum(target[s] for s in full), open_ - full
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    taken = collections.Counter()
    for r in mixed:
        taken[r.source] += len(WORD.findall(r.text or ""))
    longest = max(len(WORD.findall(r.text or "")) for r in rows)
    assert all(abs(taken[s] - target[s]) <= longest for s in order) and list(mixed[0].asDict()) == docs.columns
    assert not collections.Counter(map(key, mixed)) - collections.Counter(2 * list(map(key, rows)))

    sharded = stages["sharding"](spark, docs, sf_dir).collect()
    assert sorted(map(key, sharded)) == sorted(map(key, rows))
    by = collections.defaultdict(list)
    for r in sharded:
        by[r.shard].append(r)
    assert set(by) == set(range(8)) and all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    assert all(r["size"] == len((r.text or "").encode()) + 1 for r in sharded)
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert max(sizes) - min(sizes) <= max(max(r["size"] for r in sharded), 0.1 * sum(sizes) / 8)
    homes = collections.defaultdict(set)
    for r in sharded:
        homes[r.text].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_run(spark, sf_dir):
    """Each stage's decisions take effect on what its predecessor kept, and the texts reach the shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = corpus_pipeline.run(spark, sf_dir).collect()
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir).cache()
    texts = {r.text for r in docs.collect()}
    assert {r.text for r in got} <= texts and len({r.text for r in got}) > 0.7 * len(texts)
    assert max(collections.Counter((r.doc_id, r.text) for r in got).values()) <= 2


def test_stages_of_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_registered_queries(spark):
    """Every query runs over the whole of sf0.001 and has a row for each row of its table."""
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    n["conversations"] = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count() + 1
    for name, query in queries.QUERIES.items():
        got = query(spark, SF)
        table = {"op3_chat_format": "conversations", "op9_warc": "pages"}.get(name, "documents")
        if name == "op4_decontaminate":
            pairs = {(r.doc_id, r.item_id) for r in got.collect()}
            items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
            assert pairs == {(r.doc_id, i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, x in items.items() if len(x) >= 3 and decontaminate.align(x, plain(r.text))[0] >= 0.5}
        elif name in ("op12_phrase_mining", "op13_source_divergence"):  # rows of their own
            said = duckdb.sql(queries.ORACLE_SQL[name].replace("from documents", f"from '{SF}/documents.parquet'"))
            assert sorted(tuple(r[c] for c in said.columns) for r in got.collect()) == sorted(said.fetchall()), name
        elif name in ("op6_substring_dedup", "op7_jaccard_join"):
            said = duckdb.sql(queries.ORACLE_SQL[name].replace("from documents", f"from '{SF}/documents.parquet'"))
            rows = [tuple(r[c] for c in said.columns) for r in got.collect()]
            assert len(rows) == n[table] and sorted(rows) == sorted(said.fetchall()), name
        else:
            assert got.count() == n[table], name
