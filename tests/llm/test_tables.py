"""Mixing, neighbour search, components and the pipeline."""

import math
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from commentscope.llm import mixing, neighbours
from commentscope.llm.components import components


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def levels(size, weights=(1, 2, 3), cap=3):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    full = {}
    while True:
        rest = sum(size.values()) - sum(full.values())
        open_ = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * size[s]]
        if not over:
            return full | share
        full |= {s: cap * size[s] for s in over}


def test_mix_reaches_targets(spark, docs, rows, empty):
    got = mixing.mix(docs).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += words(r[1])
    want, taken = levels(size), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda x: Counter((r["doc_id"], r["size"], r["taken"]) for r in x)
    assert key(got) == key(again)
    assert mixing.mix(empty).count() == 0


def test_mix_is_near_its_targets_on_many_documents(spark):
    draw = np.random.default_rng(3)
    rows = [(i, "w " * int(draw.integers(1, 200)), f"s{i % 5}" if i % 3 else "s0") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.005 * t for s, t in target.items())


def test_mending_moves_one_of_equal_rows(spark):
    rows = [(7, "w " * 5, "a")] * 1000 + [(8, "w " * 17, "a")] + [(100 + i, "w " * 5, "b") for i in range(1000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("source = 'a'").collect()
    assert len(got) == 1001
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 2.5


def test_newton_solves_the_dual_with_base_rates(spark):
    draw = np.random.default_rng(4)
    rows = [(i, "w " * int(draw.integers(1, 60)), f"s{i % 3}", float(draw.choice([0.2, 1.0, 2.5]))) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, q double"), base_col="q").collect()
    sums, target, tilt = Counter(), {}, {}
    base = {i: q for i, _, _, q in rows}
    for r in got:
        sums[r["source"]] += r["size"] * r["rate"]
        target[r["source"]] = r["target"]
        if r["rate"] < 3:
            tilt.setdefault(r["source"], set()).add(round(math.log(r["rate"] / base[r["doc_id"]]), 6))
    assert all(sums[s] == pytest.approx(t, rel=1e-9) for s, t in target.items())
    assert all(len(t) == 1 for t in tilt.values())


def _brute(rows, every, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    length = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = sorted(x for x in good if len(x[1]) == length)
    x = np.array([v for _, v in good], np.float32).astype(float)
    out = {}
    for i, v in good:
        if i % every == 0:
            d = np.sqrt(((x - np.array(v, np.float32).astype(float)) ** 2).sum(1))
            out.setdefault(i, sorted((s, j) for s, (j, _) in zip(d.tolist(), good) if j != i)[:k])
    return out


def test_neighbours_on_odd_vectors(spark):
    draw = np.random.default_rng(6)
    same = draw.standard_normal(8).tolist()
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(400)] + [(1000 + i, same) for i in range(60)]
    rows += [(500, None), (None, same), (600, [0.0] * 8), (700, [float("nan")] * 8), (801, [1.0] * 7), (900, [None] * 8), (901, [float("inf")] + [1.0] * 7), rows[20], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r[0], r[1]) for r in df.collect()]
    got = {}
    for r in neighbours.nearest(df, every=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = _brute(rows, 20, 10)
    assert sorted(got) == sorted(want)
    found = 0
    for q, near in want.items():
        assert [r for r, _, _ in sorted(got[q])] == list(range(1, 11))
        exact = dict((j, s) for s, j in _brute(rows, 20, 10**6)[q]) if q in (0, 1000) else None
        if exact:
            assert all(s == pytest.approx(exact[j], abs=1e-12) for _, s, j in got[q])
        found += len({j for _, _, j in got[q]} & {j for _, j in near})
    assert found / (10 * len(want)) >= 0.9
    assert neighbours.nearest(df.limit(0)).count() == 0
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [9.0, 9.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1), (0, 2, 2)]


def test_a_hot_cell_is_split_and_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 40)
    draw = np.random.default_rng(7)
    rows = [(i, (1 + 1e-4 * draw.standard_normal(6)).tolist()) for i in range(300)]
    rows = [(r[0], r[1]) for r in spark.createDataFrame(rows, "vec_id long, embedding array<float>").collect()]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want, hits = _brute(rows, 100, 10), 0
    for r in got:
        hits += r["vec_id"] in {j for _, j in want[r["query_id"]]}
    assert hits >= 0.9 * 10 * len(want)


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (-5, -9), (-9, -5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, -5: -9, -9: -9}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stages_keep_columns_and_take_effect(spark, docs, empty, tmp_path):
    spark.createDataFrame([(i, i % 2, 0) for i in range(0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{name}")
        if k < 4:
            assert now.columns == docs.columns and now.count() > 0
        if name == "quality":
            assert now.where("text is null or size(split(trim(text), '\\\\s+')) < 10").count() == 0
        if name == "near_copies":
            assert now.groupBy("text").count().where("count > 1").count() == 0
        if name == "personal_data":
            assert now.where("text like '%a.b+c@ex-ample%'").count() == 0 and now.count() == before.count()
    nothing = empty
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, str(tmp_path))
    assert nothing.count() == 0
