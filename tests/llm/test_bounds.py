"""Bounds and exact searches of the training-data operators."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from commentscope.llm import packing, quality


def plain_balance(lengths, capacity):
    count = -(-sum(lengths) // capacity)
    cost, room, out = [0.0] * count, [capacity] * count, []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, n = 0, lengths[i]
        while n:
            fits = [(cost[s], s) for s in range(count) if room[s] >= n] or [(cost[s], s) for s in range(count) if room[s]]
            s = min(fits)[1]
            own = min(n, room[s])
            out.append((i, start, own, s, capacity - room[s]))
            room[s] -= own
            cost[s] += own + own * own / capacity
            start, n = start + own, n - own
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 50), st.data())
def test_balance_is_the_exact_search(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=60))
    assert packing.balance(lengths, capacity) == plain_balance(lengths, capacity)


def test_many_rests_are_cut_no_more_than_by_the_exact_search():
    draw = np.random.default_rng(1)
    lengths = np.clip(draw.lognormal(5, 1, 1500).astype(int), 1, 1023).tolist()
    assert len(packing.balance(lengths, 1024)) == len(plain_balance(lengths, 1024))


def test_one_row_per_labelled_id_reaches_the_driver(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_trees", lambda x, y, signs: seen.append(len(x)) or quality.Trees.__new__(quality.Trees))
    docs = spark.createDataFrame([(i % 7, f"words of text {i} " * 20, 0.5) for i in range(400)] + [(None, "x", 1.0)], "doc_id long, text string, good double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)] + [(3, 0)], "doc_id long, quality int")
    quality.train(docs, labels)
    quality.train(docs, labels, rows=4)
    assert seen == [7, 4]
