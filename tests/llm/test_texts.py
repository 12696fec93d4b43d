"""Operators over texts against plain versions of their contracts, on a fixture of odd cases."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from commentscope.llm import packing, parse_dedup, pii, quality, secrets, simhash, substring_trees, token_files
from commentscope.llm.tokens import encode_all

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ordered(rows):
    """Distinct (id, text), null ids last."""
    return sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def multiset(rows):
    return Counter(map(tuple, rows))


def spans_by(patterns, text):
    found = sorted((m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(patterns.items()) for m in re.finditer(p, text) if ok(m))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found), Counter(x[3] for x in found)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
}
SECRETS = {
    "assign": (r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def test_pii_base_spans_and_masked_text(docs, rows, empty):
    model = pii.train(docs)
    got = pii.find_pii(docs, model, docs.columns, prefix="p_").collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        want, counts = spans_by(PII, text)
        assert r["p_base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), text[:80]
        assert [r["p_n_" + k] for k in PII] == [counts[k] for k in PII]
        assert set(filter(None, want.split(","))) <= set(r["p_spans"].split(","))
        assert r["kept"] in ("no", None)
    assert any("<email>" in r["p_masked"] and "<card>" in r["p_masked"] for r in got)
    assert pii.train(empty) is None and pii.find_pii(empty, None, empty.columns, prefix="p_").count() == 0


def test_tagger_learns_held_out_spans():
    import random
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeiou") for _ in range(draw.randint(2, 8)))
    make = {"email": lambda: f"{word()}.{word()}@{word()}.com", "ip": lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)),
            "phone": lambda: f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"}
    texts = [" ".join(word() for _ in range(15)) + " " + draw.choice(list(make.values()))() + " " + " ".join(word() for _ in range(12)) for _ in range(300)]
    codes, tags = pii.examples(texts[:220])
    model = pii.fit(codes, tags)
    codes, tags = pii.examples(texts[220:], seed=8)
    got = pii.viterbi(model.emissions(codes), model.moves)
    assert (got == tags)[tags > 0].mean() > 0.9
    assert (got == tags)[tags == 0].mean() > 0.98


def test_training_finds_rare_and_late_spans(spark):
    dates = "on 3 May 1999 " * 40
    late = [dates * 3 + f"write to a{i}.b@host{i}.example.org now" for i in range(6)]
    df = spark.createDataFrame([(dates + str(i),) for i in range(300)] + [(t,) for t in late] + [(late[0],)] * 30, "text string")
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "fit", lambda codes, tags: seen.append((codes, tags)) or pii.Tagger.new())
        assert pii.train(df, rows=20) is not None
    codes, tags = seen[0]
    assert ((tags == 1) & (codes == ord("a"))).any(axis=1).sum() >= len(late)
    assert len(codes) <= ((1 + pii.MOST_VARIANTS) * len(late) + 20 // pii.PLAIN_SHARE) * (pii.SPANNED + pii.FREE)


def test_tagger_gradients_match_differences():
    model, draw = pii.Tagger.new(), np.random.default_rng(0)
    for name in ("embed", "wx", "wh", "b", "wo", "bo", "moves"):
        setattr(model, name, getattr(model, name).astype(float))
    codes, tags = draw.integers(0, 20, (3, 9)), draw.integers(0, pii.TAGS, (3, 9))
    _, grads = model.loss(codes, tags)
    for w, g in zip(model.weights(), grads):
        at = tuple(np.unravel_index(np.abs(g).argmax(), g.shape))
        keep, sides = w[at], []
        for d in (1e-4, -1e-4):
            w[at] = keep + d
            sides.append(model.loss(codes, tags)[0])
        w[at] = keep
        assert float(g[at]) == pytest.approx((sides[0] - sides[1]) / 2e-4, rel=1e-2)


def test_overlapping_windows_agree_with_one_long_window():
    model = pii.Tagger.new()
    text = "call 12 " * 40
    spans = pii.tagged_spans(model, [text, "", "no anchor here", text])
    assert spans[1] == spans[2] == [] and spans[0] == spans[3]


def test_secrets_base_and_linked_parts(docs, rows, empty):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for i, text in ordered(rows):
        want, _ = spans_by(SECRETS, text)
        mine = [",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((s[0], n, s[1], k) for n, k in enumerate(SECRETS) for s in r[k])) for r in by_id[i]]
        assert want in mine, (text[:60], mine)
    text = next(r[1] for r in rows if r[1] and "client_id" in r[1])
    weak = {(w["kind"], text[w["start"]:w["end"]]) for r in got if r["doc_id"] == next(x[0] for x in rows if x[1] == text) for w in r["weak"]}
    assert weak == {("weak_id", "client_id=web-7731"), ("weak_secret", "Zx8Qw2Er5Ty7Ui9Op1As"), ("weak_endpoint", "https://api.example.org")}
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_after_long_parts_and_of_any_length(spark):
    key, low = "Ab3" + "x/Yz-9_Q" * 40, "abcdefgh" * 10 + "Z9"
    texts = ["secret=" + "Ab1" * 100 + "\nhttps://host.example", f"{key}\nhttps://far.example", f"https://near.example {low}",
             "https://gone.example" + " y" * 100 + " " + key, "https://edge.example" + " " * 160 + key, "https://edge.example" + " " * 161 + key,
             "https://slow.example " + "a/" * 100_000, "https://host.example\n\n" + key]
    got = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r["doc_id"]: [texts[r["doc_id"]][w["start"]:w["end"]] for w in r["weak"]] for r in got}
    assert found == {0: ["https://host.example"], 1: ["https://far.example", key], 2: ["https://near.example", low],
                     3: [], 4: ["https://edge.example", key], 5: [], 6: [], 7: []}


def test_suffix_trees_remove_repeated_windows(docs, rows, empty):
    seen, want = set(), {}
    for i, text in ordered(rows):
        w, gone = words(text), set()
        for j in range(len(w) - 19):
            key = tuple(w[j:j + 20])
            if key in seen:
                gone |= set(range(j, j + 20))
            seen.add(key)
        want[i, len(w), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()] = len(gone)
    for group in (substring_trees.GROUP, 50):
        got = substring_trees.remove_repeats(docs, group=group).collect()
        assert len(got) == len(rows)
        assert {(r["doc_id"], r["n_words"], r["kept_sha256"]): r["n_removed"] for r in got} == want
    assert substring_trees.remove_repeats(empty).count() == 0


def test_prefix_free_parsing_removes_repeated_bytes(docs, rows, empty, monkeypatch):
    seen, want = set(), set()
    for i, text in ordered(rows):
        b = text.encode()
        gone = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - 99):
            if b[j:j + 100] in seen:
                gone[j:j + 100] = True
            seen.add(b[j:j + 100])
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.add((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    for group in (parse_dedup.GROUP, 200):
        got = parse_dedup.remove_repeats(docs, group=group).collect()
        assert len(got) == len(rows)
        assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert parse_dedup.remove_repeats(empty).count() == 0


def test_ids_of_chunks_equal_ids_of_whole_texts(rows):
    import random
    draw = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "\x1c", "\x85", "7", ".", "'s", "<|endoftext|>", "漢", "😀", "\r", " "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(5000)] + [r[1] or "" for r in rows]
    whole = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in encode_all(texts, VOCABULARY)] == [x.ids for x in whole]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(docs, rows, empty, spark):
    model, want, at = Tokenizer.from_file(VOCABULARY), [], 0
    got = token_files.token_files(docs, VOCABULARY, end_id=2).collect()
    ids = {t: model.encode(t, add_special_tokens=False).ids + [2] for t in {r[1] or "" for r in rows}}
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([r[0] for r in rows], key=lambda i: (i is None, i or 0))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        want.append((r["doc_id"], r["n_tokens"], r["ids_crc32"]))
    assert multiset(want) == multiset((r[0], len(ids[r[1] or ""]), _crc(ids[r[1] or ""])) for r in rows)
    assert token_files.token_files(empty, VOCABULARY, end_id=2).count() == 0


def test_packing_places_every_id_once(docs, rows, empty):
    model = Tokenizer.from_file(VOCABULARY)
    pieces = packing.pack(docs.dropDuplicates(["doc_id"]), VOCABULARY).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.dropDuplicates(["doc_id"]).collect()}
    for i, text in texts.items():
        ids, at = model.encode(text, add_special_tokens=False).ids + [0], 0
        for p in sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), _crc(ids[at:at + p["length"]]))
            at += p["length"]
        assert at == len(ids)
    rooms = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == rooms.get(p["sequence_id"], 0) and p["length"] > 0
        rooms[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(rooms.values()) <= 1024 and sorted(rooms) == list(range(len(rooms)))
    assert packing.pack(empty, VOCABULARY).count() == 0


def test_balance_keeps_costs_even_and_padding_small():
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 1024, 3000).tolist()
    placed = packing.balance(lengths, 1024)
    used, cost = Counter(), Counter()
    for _, _, n, s, _ in placed:
        used[s] += n
        cost[s] += n + n * n / 1024
    assert sum(used.values()) == sum(lengths) and max(used.values()) <= 1024
    assert len(used) == -(-sum(lengths) // 1024)
    whole = sum(n == lengths[i] for i, _, n, _, _ in placed)
    assert whole > 0.5 * len(lengths)


def _fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(w[j:j + 4]) for j in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def test_simhash_fingerprints_and_components(docs, rows, empty):
    names = ordered(rows)
    prints = {n: _fingerprint(n[1]) for n in names}
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for n, v in prints.items():
        if n[0] is not None:
            least[find(v)] = min(n[0], least.get(find(v), n[0]))
    got = simhash.near_duplicates(docs)
    assert multiset((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()) == multiset(
        (r[0], f"{prints[r[0], r[1] or '']:016x}", least.get(find(prints[r[0], r[1] or ""]))) for r in rows)
    assert simhash.representatives(got).count() == len({find(v) for v in values})
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_dense_cells_match_all_pairs():
    import pyarrow as pa
    draw = np.random.default_rng(4)
    centre = draw.integers(0, 1 << 63, 1, np.uint64)
    near = np.array([centre[0] ^ np.bitwise_or.reduce(np.uint64(1) << draw.choice(64, 3, False).astype(np.uint64)) for _ in range(300)], np.uint64)
    fp = np.unique(np.concatenate([near, draw.integers(0, 1 << 63, 500, np.uint64)]))
    cells = simhash.plan_cells(len(fp), 4)
    groups = 4 + len(cells[0])
    table = pa.Table.from_batches(simhash._cells(iter([pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64))], ["fp"])]), cells, groups)).sort_by("key")
    links = list(simhash._links(iter(table.to_batches(max_chunksize=700)), cells, groups, 4))
    edges = [(a, b) for x in links for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]

    def classes(pairs):
        root = {}
        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for a, b in pairs:
            root[find(a)] = find(b)
        out = {}
        for x in list(root):
            out.setdefault(find(x), set()).add(x)
        return {frozenset(v) for v in out.values()}

    signed = fp.view(np.int64).tolist()
    every = [(signed[i], signed[j]) for i in range(len(fp)) for j in range(i) if (int(fp[i]) ^ int(fp[j])).bit_count() <= 4]
    assert classes(edges) == classes(every) and all((a & (2**64 - 1) ^ b & (2**64 - 1)).bit_count() <= 4 for a, b in edges)


def test_quality_statistics(docs, rows, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.train(docs, labels)
    got = quality.judge(docs, trees, docs.columns, prefix="q_").collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        w, lines = words(text), [x for x in text.split("\n") if words(x)]
        runs, cover = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4)), set()
        for j in range(len(w) - 4):
            if runs[tuple(w[j:j + 5])] > 1:
                cover |= set(range(j, j + 5))
        assert [r["q_" + s] for s in quality.STATS] == [
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)]
        assert r["q_base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and not (r["q_base_failed"] and r["q_kept"])
    none = quality.train(docs, labels.limit(0))
    assert {r["kept"] for r in quality.judge(docs, none, ["doc_id"]).where("not base_failed").collect()} == {True}
    assert quality.judge(empty, none, empty.columns, prefix="q_").count() == 0


def test_trees_learn_and_keep_their_signs():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (draw.random(3000) < 0.05)).astype(float)
    trees = quality.fit_trees(x[:2000], y[:2000], np.array([-1, 0, 1]))
    assert ((trees.score(x[2000:]) > 0.5) == (x[2000:, 0] < 0.5)).mean() > 0.95
    grid = np.tile(draw.random((50, 3)), (40, 1))
    for j, sign in ((0, -1), (2, 1)):
        line = grid.copy()
        line[:, j] = np.repeat(np.linspace(0, 1, 40), 50)
        scores = trees.score(line).reshape(40, 50)
        assert (sign * np.diff(scores, axis=0) >= -1e-12).all()


def test_texts_of_one_id_with_one_32_bit_hash_are_two_documents(spark):
    from commentscope.llm.common import one_per_name
    half = " ".join(f"left{i}" for i in range(25))
    texts = [f"{half} {half} 13736", " ".join(f"right{i}" for i in range(60)) + " 172207"]
    df = spark.createDataFrame([(None, t) for t in [*texts, texts[1]]] + [(1, "a text of its own")], "doc_id long, text string")
    assert df.where("doc_id is null").selectExpr("hash(text)").distinct().count() == 1
    for found, size in ((substring_trees.remove_repeats(df), "n_words"), (parse_dedup.remove_repeats(df), "n_bytes")):
        got = sorted((r[size], r["n_removed"] > 0) for r in found.where("doc_id is null").collect())
        want = [(len(words(t)) if size == "n_words" else len(t), t is texts[0]) for t in [*texts, texts[1]]]
        assert got == sorted(want)
    names = simhash.representatives(simhash.near_duplicates(df))
    kept = one_per_name(df, names, "doc_id", "text").select("text").collect()
    assert sorted(r["text"] for r in kept) == sorted([*texts, "a text of its own"])
