"""The network on the driver's documents: what it finds in texts that it was not trained on."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from commentscope.llm import pii

SF = "/root/testdata/sf0.01/documents.parquet"
FORMS = ["mail jane.doe @ corp.example.com now", "pay 4539.1488.0343.6467 now", "call (020) 7946 0958 today", "host 10:0:0:12 is up", "host 12-84-156-107 is up"]


def rewritten(text, draw):
    """The text with its spans in forms that the patterns miss, and their places."""
    parts, gold, at, n = [], [], 0, 0
    for a, b, k in sorted((a, b, k) for k, found in pii.base_spans(text).items() for a, b in found):
        if a >= at:
            body = pii._rewritten(k, text[a:b], draw)
            parts += [text[at:a], body]
            gold.append((n + a - at, n + a - at + len(body), k))
            n, at = n + a - at + len(body), b
    return "".join([*parts, text[at:]]), gold


@pytest.fixture(scope="module")
def halves():
    texts = [t or "" for t in pq.read_table(SF).column("text").to_pylist()]
    spanned = [t for t in dict.fromkeys(texts) if any(pii.base_spans(t).values())]
    plain = [t for t in dict.fromkeys(texts) if not any(pii.base_spans(t).values())]
    return spanned[::2] + plain[::2], spanned[1::2], plain[1::2]


@pytest.fixture(scope="module")
def model(spark, halves):
    return pii.train(spark.createDataFrame([(t,) for t in halves[0]], "text string"))


def test_held_out_base_spans(model, halves):
    found = pii.tagged_spans(model, halves[1])
    gold = [{(a, b, k) for k, spans in pii.base_spans(t).items() for a, b in spans} for t in halves[1]]
    hits = sum(len(g & {(a, b, pii.KINDS[k]) for k, a, b in f}) for g, f in zip(gold, found))
    assert hits >= 0.9 * sum(map(len, gold)) and sum(map(len, gold)) > 30


def test_held_out_rewritten_spans_and_precision(model, halves):
    draw, right, added_all, wanted = np.random.default_rng(3), 0, 0, 0
    made = [rewritten(t, draw) for t in halves[1]]
    for (text, gold), (base, added) in zip(made, pii.all_spans(model, [t for t, _ in made])):
        taken = [s for spans in base.values() for s in spans]
        gold = {g for g in gold if not any(g[0] < b and a < g[1] for a, b in taken)}
        wanted, right, added_all = wanted + len(gold), right + len(gold & set(added)), added_all + len(added)
    assert wanted > 25 and right >= 0.9 * wanted and right >= 0.9 * added_all
    # documents without personal data: next to nothing is added
    assert sum(len(added) for _, added in pii.all_spans(model, halves[2])) <= 0.002 * len(halves[2])


def test_hand_written_forms(model):
    got = [added for _, added in pii.all_spans(model, FORMS)]
    assert sum(len(a) == 1 for a in got) >= 4


def test_added_spans_reach_the_result_and_the_mask(spark, model):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(FORMS)], "doc_id long, text string")
    got = pii.find_pii(docs, model, ["doc_id"]).where(F.col("spans") != "").orderBy("doc_id").collect()
    assert len(got) >= 4 and all("<" in r["masked"] and r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == 0 for r in got)
