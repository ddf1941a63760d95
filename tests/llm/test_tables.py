"""Mixing, sharding, near vectors and the pipeline."""
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle
from millrace.llm import common, lang_pieces, mixing, near_vectors, order_minhash, packing, spaced_seeds
from test_texts import ODD, brute_groups, brute_overlap, frame


def sourced(spark, counts):
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            rows.append((i, source, f"text {i}"))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def brute_schedule(parts, slots):
    """Earliest deadline first among released blocks, slot by slot."""
    length, sent, out = sum(parts), [0] * len(parts), []
    for t in range(slots):
        open_ = [(-(-(sent[i] + 1) * length // x), i) for i, x in enumerate(parts) if sent[i] * length // x <= t]
        i = min(open_)[1]
        sent[i] += 1
        out.append(i)
    return out


def test_mix_follows_the_schedule_within_one_block(spark):
    docs = sourced(spark, {"a": 1500, "b": 300, None: 200, "": 40})
    got = mixing.mixed(docs, block_rows=4, period=64).collect()
    assert len(got) == 2040 and {r["doc_id"] for r in got} == set(range(2040))
    blocks = {r["slot"]: r for r in got}
    weight = {r["source"]: r["weight"] for r in got}
    assert abs(sum(weight.values()) - 1) < 1e-9
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    end = max(r["slot"] for r in got if r["in_mix"])
    sent = Counter()
    for t in range(end + 1):
        sent[blocks[t]["source"]] += 1
        assert all(abs(sent[s] - w * (t + 1)) < 1 for s, w in weight.items())
    names = sorted(weight, key=lambda s: (s is not None, s))
    length = 64
    want = brute_schedule([round(weight[s] * length) for s in names], end + 1)
    assert [names.index(blocks[t]["source"]) for t in range(end + 1)] == want
    rows = Counter((r["source"], r["block"]) for r in got)
    assert max(rows.values()) == 4 and sum(n < 4 for n in rows.values()) == 0


def test_mix_given_weights_and_edges(spark):
    docs = sourced(spark, {"a": 50, "b": 50, "c": 5})
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("gone", 9.0), ("c", 0.0)], "source string, weight double")
    got = mixing.mixed(docs, weights, block_rows=1, period=16).collect()
    assert {r["source"]: r["weight"] for r in got} == {"a": 0.75, "b": 0.25, "c": 0.0}
    assert Counter(r["source"] for r in got if r["in_mix"])["a"] == 50
    assert all(r["slot"] is None and not r["in_mix"] for r in got if r["source"] == "c")
    assert mixing.mixed(docs.limit(0)).count() == 0
    repeated = docs.where("source = 'a'").union(docs.where("source = 'a'"))
    assert mixing.mixed(repeated, block_rows=1).count() == 100


def test_mix_stage_keeps_all_rows_beside_a_rare_source(spark):
    """A hot and a five-row source against a mix dealt slot by slot, in which empty sources are passed over."""
    counts = {"hot": 3000, "b": 400, None: 70, "rare": 5}
    docs = sourced(spark, counts)
    out = corpus_pipeline.mix(spark, docs, SF)
    got = out.collect()
    assert out.columns[:3] == docs.columns and sorted(r["doc_id"] for r in got) == list(range(sum(counts.values())))
    assert sum(r["in_mix"] for r in mixing.mixed(docs).collect()) < 3475
    small = mixing.ordered(docs, block_rows=4, period=64).collect()
    weight = {r["source"]: r["weight"] for r in mixing.mixed(docs, block_rows=4, period=64).collect()}
    names = sorted(counts, key=lambda s: (s is not None, s))
    left, want = dict(counts), []
    for i in brute_schedule([round(weight[s] * 64) for s in names], 4000):
        want += [names[i]] * min(4, left[names[i]])
        left[names[i]] -= min(4, left[names[i]])
    assert not any(left.values())
    assert [r["source"] for r in sorted(small, key=lambda r: (r["mix_slot"], r["mix_row"]))] == want
    assert len({(r["mix_slot"], r["mix_row"]) for r in small}) == len(small) == 3475
    assert mixing.ordered(docs.limit(0)).count() == 0


def test_mix_of_many_sources(spark):
    """Equal and unequal weights of 300 sources against the schedule slot by slot; rows without id, repeated ids, and a
    column that has the name of a result."""
    parts = [1 + (i * 7) % 11 for i in range(300)]
    weights = spark.createDataFrame([(f"s{i:04}", float(p)) for i, p in enumerate(parts)], "source string, weight double")
    docs = weights.selectExpr("cast(null as bigint) doc_id", "source", "'t' text", "7 mix_slot").union(
        weights.selectExpr("5L doc_id", "source", "'u' text", "8 mix_slot"))
    got = mixing.mixed(docs, weights, block_rows=1, period=4096).collect()
    length = 4096
    scheduled = [round(w * length) for _, w in sorted({(r["source"], r["weight"]) for r in got})]
    assert sum(scheduled) == length and len(got) == 600
    want = brute_schedule(scheduled, length)
    at = {r["slot"]: int(r["source"][1:]) for r in got}
    assert all(want[t % length] == i for t, i in at.items())
    out = mixing.ordered(docs, weights, block_rows=1, period=4096)
    assert out.columns == ["doc_id", "source", "text", "mix_slot", "mix_row"]
    assert len({(r["mix_slot"], r["mix_row"]) for r in out.collect()}) == 600


def test_mix_runs_no_python(spark):
    for df in (mixing.mixed(sourced(spark, {"a": 9, "b": 3})),
               spaced_seeds.contaminated(frame(spark, [(1, "a b")]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan.split("== Physical Plan ==")[1].split("Scan ExistingRDD")[0]


def test_positions_are_gapless_in_every_group(spark):
    docs = sourced(spark, {"a": 500, None: 70, "b": 1})
    got = common.positions(docs, "source", [F.col("doc_id")], "rank", per=16).groupBy("source").agg(
        F.count("*"), F.min("rank"), F.max("rank"), F.countDistinct("rank")).collect()
    assert {tuple(r) for r in got} == {("a", 500, 0, 499, 500), (None, 70, 0, 69, 70), ("b", 1, 0, 0, 1)}


def test_a_group_that_fits_a_shard_stays_whole(spark):
    texts = [(i, f"text number {i} " + "x" * (i % 50)) for i in range(6000)]
    for share, parts in ((1 / 32, 1), (1 / 53, 1), (1 / 17.5, 1), (1 / 3, 2)):
        n = int(6000 * share / (1 - share))
        docs = frame(spark, texts + [(10_000 + i, "text number 17 again") for i in range(n)])
        hot = {r["shard"] for r in packing.assign(docs).where("doc_id >= 10000").collect()}
        assert len(hot) == 1 if parts == 1 else len(hot) > 1
        assert packing.sharded(docs).where("doc_id >= 10000").select("shard").distinct().count() == len(hot) or parts > 1


def test_shards_are_near_equal_and_gapless(spark):
    rng = np.random.default_rng(0)
    texts = [(10_000 + i, "w" * int(n)) for i, n in enumerate(rng.integers(1, 400, 3000))] + [(5000 + i, "hot text " * 20) for i in range(1500)]
    texts += ODD
    got = packing.assign(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    size = [sum(r["size"] for r in by[s]) for s in range(16)]
    assert max(size) / min(size) < 1.02
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by.values())
    known = dict(texts)
    for r in got:
        raw = (known[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
    same = defaultdict(set)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] >= 10_000:
            same[known[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in same.values())
    assert packing.assign(frame(spark, [])).count() == 0
    full = packing.sharded(frame(spark, texts).withColumn("shard", F.lit("own")))
    assert full.count() == len(texts) and dict(full.dtypes)["shard"] == "int"


def brute_links(rows):
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.append((k, np.array(v, float), label))
    links, parent = Counter(), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (k, v, label) in enumerate(usable):
        for m, u, other in usable[:n]:
            if label == other and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98:
                links[k] += 1
                links[m] += 1
                parent[root(k)] = root(m)
    ids = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        ids[root(k)].append(i)
    return [(i, links[k], min((x for x in ids[root(k)] if x is not None), default=None)) for k, (i, _, _) in enumerate(rows)]


def test_near_vectors_match_brute_force(spark):
    rng, rows = np.random.default_rng(1), []
    for i in range(300):
        rows.append((i, rng.standard_normal(16).astype("f4").tolist(), int(i % 3)))
    for c in range(4):  # dense and chained groups
        centre = rng.standard_normal(16)
        for k in range(60):
            rows.append((1000 + c * 100 + k, (centre + rng.standard_normal(16) * (0.03 + 0.03 * c)).astype("f4").tolist(), c % 2))
    rows += [(2000 + k, rows[0][1], 0) for k in range(40)] + [(2000, rows[0][1], 0), (None, rows[1][1], 1)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [None] * 16, 1), (3004, [float("nan")] * 16, 1),
             (3005, rows[1][1], None), (3006, rows[1][1][:8], 1), (3007, [float("inf")] + [0.0] * 15, 1)]
    got = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(brute_links(rows))
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def cap_groups(sizes, apart, spread, seed=5):
    """Groups of vectors around centres whose cosine is about ``apart``."""
    rng, rows = np.random.default_rng(seed), []
    one, two = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
    for g, n in enumerate(sizes):
        centre = np.cos(g * np.arccos(apart)) * one + np.sin(g * np.arccos(apart)) * two
        for k in range(n):
            v = centre + rng.standard_normal(32) * spread / np.sqrt(32)
            rows.append((g * 1000 + k, v.tolist(), 0))
    return rows


def test_near_vectors_between_dense_groups(spark):
    """Every vector has ten nearer neighbours in its own group, and still links across."""
    rows = cap_groups([12, 12], 0.986, 0.055) + [(i + 5000, v, 1) for i, v, _ in cap_groups([300, 300, 300], 0.985, 0.05)]
    got = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    want = brute_links(rows)
    assert len({c for _, _, c in want}) == 2
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(want)


def test_near_vectors_below_recall_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "audit", lambda *_: 0.0)
    monkeypatch.setattr(near_vectors, "MOST_ROUNDS", 1)
    rows = cap_groups([300, 40, 5], 0.98, 0.06) + [(9000 + k, [float(k == i) for i in range(32)], 0) for k in range(9)]
    got = near_vectors.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), neighbours=2, rounds=1).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(brute_links(rows))


def test_audit_lets_no_surplus_hide_a_loss(spark):
    rows = cap_groups([30, 20], 0.5, 0.02)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    _, classes = near_vectors._classes(frame)
    true = near_vectors._exact(classes, classes.select("node", F.lit(0).alias("n_links"), F.col("node").alias("component")), 0.98)
    assert sorted(r["n_links"] for r in true.collect()) == [19] * 20 + [29] * 30
    assert near_vectors.audit(classes, true) == 1.0
    moved = true.withColumn("n_links", F.when(F.col("n_links") == 29, 31).otherwise(18))
    assert near_vectors.audit(classes, moved) == (29 * 30 + 18 * 20) / (29 * 30 + 19 * 20)


def test_near_vectors_of_an_empty_table(spark):
    assert near_vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)] + [(200, k) for k in range(201, 260)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 260)}}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_query_with_sql(spark, con, name):
    assert oracle.difference(spark, con, SF, entry.LLM_QUERIES[name], entry.LLM_ORACLES[name]) is None


def test_all_queries_are_registered():
    assert len(entry.LLM_QUERIES) == 14 and {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in entry.LLM_QUERIES}


def test_pipeline_matches_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    texts = {r["doc_id"]: r for r in docs.collect()}
    told = {r["doc_id"] for r in lang_pieces.identify(docs).where("lang_pred <> 'und' AND score >= 0.3").collect()}
    short = [(i, texts[i]["text"]) for i in sorted(told)]
    groups = {r["doc_id"]: r["component_id"] for r in order_minhash.near_duplicates(docs.where(F.col("doc_id").isin(list(told)))).collect()}
    sample = [x for x in short if len(x[1]) < 500]
    want = brute_groups(sample)
    inside = {i for i, _ in sample}
    assert all((groups[i] == groups[j]) >= (want[i] == want[j]) for i in inside for j in inside if want[j] == j)
    items = [r["text"] for r in common.table(spark, SF, "benchmark").collect()]
    one = [i for i, g in groups.items() if i == g]
    clean = {i for i in one if not any(brute_overlap(texts[i]["text"], t) for t in items if len(texts[i]["text"]) < 1000)}
    left = docs.where(F.col("doc_id").isin(one))
    exact = {r["doc_id"] for r in spaced_seeds.clean(left, common.table(spark, SF, "benchmark")).collect()}
    assert exact <= clean and all(len(texts[i]["text"]) >= 1000 for i in clean - exact)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == exact and len(out) == len(exact)  # the mix and the shards drop nothing
    assert {r["shard"] for r in out} <= set(range(16))
