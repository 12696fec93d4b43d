"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The network is trained in numpy from labelled spans: what the patterns find in a bounded sample of the
documents that hold such a span, and versions of these texts with the spans redrawn, set before other words and
rewritten into forms that the patterns miss. A text is covered by overlapping
windows. Windows without a digit or ``@`` are passed over: a span needs one of these characters, so
they cannot hold one. Emissions of overlapping windows are averaged by how central a character is in
each, then every stretch of touching windows is decoded once, by Viterbi over the whole stretch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from commentscope.llm.common import bounded_sample, quoted, slices, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")

# ---- base patterns (fixed) --------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits that is followed by no dot fails from each of its digits: only its first is tried.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile("[0-9@]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Found from each ``@``: leftwards the whole run of local characters, rightwards the domain."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        # a failed run is never tried again from its middle: it ends in the same "@"
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches per kind; failing matches are dropped, not tried again."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if _ANCHOR.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and _luhn(d):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# ---- the network --------------------------------------------------------------------------------

WINDOW, STRIDE = 64, 32
HIDDEN, EMBEDDED = 24, 16
TAGS = 1 + 2 * len(KINDS)  # outside, and first and further characters of each kind
_ALPHABET = 129


def _codes(text: str) -> np.ndarray:
    """ASCII as it is, everything else one class."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Weights: characters, two LSTM directions (stacked on the first axis), output, transitions."""

    embed: np.ndarray
    wx: np.ndarray
    wh: np.ndarray
    b: np.ndarray
    wo: np.ndarray
    bo: np.ndarray
    moves: np.ndarray

    @staticmethod
    def new(seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        b = np.zeros((2, 1, 4 * HIDDEN), np.float32)
        b[:, :, HIDDEN:2 * HIDDEN] = 1
        return Tagger(f(_ALPHABET, EMBEDDED) * 4, f(2, EMBEDDED, 4 * HIDDEN), f(2, HIDDEN, 4 * HIDDEN), b, f(2 * HIDDEN, TAGS),
                      np.zeros(TAGS, np.float32), np.zeros((TAGS, TAGS), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.wx, self.wh, self.b, self.wo, self.bo, self.moves]

    def states(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (batch, time, 2 * HIDDEN) of code rows (batch, time)."""
        both = np.stack([codes, codes[:, ::-1]])
        table = self.embed @ self.wx + self.b  # input and bias of every character
        n, steps = codes.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.empty((2, n, steps, HIDDEN), np.float32)
        for t in range(steps):
            z = h @ self.wh
            z[0] += table[0][both[0, :, t]]
            z[1] += table[1][both[1, :, t]]
            gates = _sigmoid(z[..., :3 * HIDDEN])
            i, f, o = gates[..., :HIDDEN], gates[..., HIDDEN:2 * HIDDEN], gates[..., 2 * HIDDEN:]
            g = np.tanh(z[..., 3 * HIDDEN:])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((i, f, o, g, before, squashed, h))
            h = o * squashed
            out[:, :, t] = h
        return np.concatenate([out[0], out[1][:, ::-1]], axis=2)

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        return self.states(codes) @ self.wo + self.bo

    def loss(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tag rows, and its gradients."""
        n, steps = codes.shape
        kept: list = []
        hidden = self.states(codes, kept)
        e = (hidden @ self.wo + self.bo).astype(np.float64)
        moves = self.moves.astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        top = lambda x, axis: x.max(axis=axis, keepdims=True)

        def logsum(x: np.ndarray, axis: int) -> np.ndarray:
            m = top(x, axis)
            return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        for t in range(1, steps):
            alpha[:, t] = logsum(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = logsum(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = logsum(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(steps), tags].sum(1) + moves[tags[:, :-1], tags[:, 1:]].sum(1)
        d_e = np.exp(alpha + beta - z[:, None, None])
        d_e[rows, np.arange(steps), tags] -= 1
        pair = np.exp(alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - z[:, None, None, None])
        d_moves = pair.sum((0, 1))
        np.add.at(d_moves, (tags[:, :-1], tags[:, 1:]), -1)
        d_e = (d_e / n).astype(np.float32)
        d_wo = np.einsum("nth,ntk->hk", hidden, d_e)
        d_hidden = d_e @ self.wo.T
        d_out = np.stack([d_hidden[..., :HIDDEN], d_hidden[:, ::-1, HIDDEN:]])
        both = np.stack([codes, codes[:, ::-1]])
        d_wh, d_in = np.zeros_like(self.wh), np.empty((2, n, steps, 4 * HIDDEN), self.wh.dtype)
        d_h, d_c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, squashed, h = kept[t]
            d_h = d_h + d_out[:, :, t]
            d_c = d_c + d_h * o * (1 - squashed**2)
            d_z = np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g**2)], axis=2)
            d_c = d_c * f
            d_h = d_z @ self.wh.transpose(0, 2, 1)
            d_wh += h.transpose(0, 2, 1) @ d_z
            d_in[:, :, t] = d_z
        one_hot = (both.reshape(2, -1, 1) == np.arange(_ALPHABET)).astype(self.wh.dtype)
        d_table = one_hot.transpose(0, 2, 1) @ d_in.reshape(2, n * steps, -1)
        d_wx = self.embed.T @ d_table
        d_embed = (d_table @ self.wx.transpose(0, 2, 1)).sum(0)
        grads = [d_embed, d_wx, d_wh, d_table.sum(1, keepdims=True), d_wo, d_e.sum((0, 1)), (d_moves / n).astype(np.float32)]
        return float((z - gold).mean()), grads


def fit(codes: np.ndarray, tags: np.ndarray, steps: int = 700, batch: int = 64, rate: float = 0.015, seed: int = 7) -> Tagger:
    """Adam over shuffled batches, for the same number of steps whatever the number of windows; the order comes
    from the seed, so reruns agree."""
    model, draw = Tagger.new(seed), np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    step = 0
    while step < steps:
        order = draw.permutation(len(codes))
        for k in range(0, len(codes), batch)[:steps - step]:
            part, step = order[k:k + batch], step + 1
            _, grads = model.loss(codes[part], tags[part])
            pace = rate * (1 - 0.9 * step / steps)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
            for w, g, a, b in zip(model.weights(), grads, first, second):
                g = g * min(1.0, 5 / (norm + 1e-9))
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


# ---- windows and decoding -------------------------------------------------------------------------

def window_starts(text: str) -> np.ndarray:
    """Starts of the windows that hold a digit or ``@``; starts are multiples of the stride."""
    at = np.fromiter((m.start() for m in _ANCHOR.finditer(text)), np.int64)
    if not len(at):
        return at
    last = at // STRIDE
    return np.unique(np.concatenate([last, np.maximum(last - 1, 0)])) * STRIDE


def _rows(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int64)])
    return padded[starts[:, None] + np.arange(WINDOW)]


_CENTRAL = (np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW)) + 1).astype(np.float32)


def viterbi(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of rows (batch, time, TAGS)."""
    n, steps, _ = e.shape
    score, back = e[:, 0], np.empty((n, steps, TAGS), np.int8)
    for t in range(1, steps):
        all_moves = score[:, :, None] + moves
        back[:, t] = all_moves.argmax(1)
        score = all_moves.max(1) + e[:, t]
    out = np.empty((n, steps), np.int64)
    out[:, -1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


def _runs(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the spans in a tag row: a first tag, or a further tag after another kind."""
    kind = (tags - 1) // 2
    inside, first = tags > 0, (tags > 0) & (tags % 2 == 1)
    start = inside & (first | ~np.roll(inside, 1) | (np.roll(kind, 1) != kind))
    if len(tags) and inside[0]:
        start[0] = True
    for a in np.flatnonzero(start).tolist():
        b = a + 1
        while b < len(tags) and inside[b] and not start[b]:
            b += 1
        yield int(kind[a]), a, b


def tagged_spans(model: Tagger, texts: list[str], windows: int = 512) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the network finds in each whole text."""
    pieces = []  # (text, first window, windows) of stretches whose windows touch
    owners, starts, codes = [], [], {}
    for i, text in enumerate(texts):
        at = window_starts(text)
        if len(at):
            codes[i] = _codes(text)
            owners += [i] * len(at)
            starts += at.tolist()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    k = 0
    while k < len(owners):
        j = k + 1
        while j < len(owners) and owners[j] == owners[k] and starts[j] - starts[j - 1] <= STRIDE:
            j += 1
        pieces.append((owners[k], k, j - k))
        k = j
    pieces.sort(key=lambda p: p[2])
    k = 0
    while k < len(pieces):
        j, held = k, 0
        while j < len(pieces) and (held == 0 or pieces[j][2] == pieces[k][2] and held + pieces[j][2] <= windows):
            held += pieces[j][2]
            j += 1
        group, count = pieces[k:j], pieces[k][2]
        rows = np.concatenate([_rows(codes[i], np.array(starts[a:a + n])) for i, a, n in group])
        e = np.concatenate([model.emissions(rows[r:r + windows]) for r in range(0, len(rows), windows)])
        e = e.reshape(len(group), count, WINDOW, TAGS)
        length = (count - 1) * STRIDE + WINDOW
        total, weight = np.zeros((len(group), length, TAGS), np.float32), np.zeros((length, 1), np.float32)
        for w in range(count):
            total[:, w * STRIDE:w * STRIDE + WINDOW] += e[:, w] * _CENTRAL[:, None]
            weight[w * STRIDE:w * STRIDE + WINDOW] += _CENTRAL[:, None]
        for (i, a, _), tags in zip(group, viterbi(total / weight, model.moves)):
            out[i] += [(kind, starts[a] + s, min(starts[a] + t, len(texts[i]))) for kind, s, t in _runs(tags) if starts[a] + s < len(texts[i])]
        k = j
    return out


#: Digits a span of each kind needs, at least, to be taken from the network.
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 9}
MOST_DIGITS = {"email": 99, "ip": 12, "card": 19, "phone": 15}


def _plausible(kind: str, text: str) -> bool:
    if text != text.strip() or "\n" in text:
        return False
    digits = len(_digits(text))
    if not LEAST_DIGITS[kind] <= digits <= MOST_DIGITS[kind]:
        return False
    if kind == "email":
        return "@" in text and "." in text.split("@")[-1] and all(text.split("@"))
    if kind == "card":
        return _luhn(_digits(text)) and all(c in "0123456789 -./" for c in text)
    if kind == "ip":
        return all(c in "0123456789 .:-" for c in text) and all(int(p) <= 255 for p in re.findall("[0-9]{1,9}", text)) and len(re.findall("[0-9]+", text)) == 4
    return all(c in "0123456789 +().-/" for c in text) and len(re.findall("[0-9]+", text)) > 1


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[dict, list[tuple[int, int, str]]]]:
    """Per text its base spans, and the spans (start, end, kind) that the network adds clear of them."""
    found = tagged_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for text, tagged in zip(texts, found):
        base = base_spans(text)
        taken = [s for spans in base.values() for s in spans]
        added: list[tuple[int, int, str]] = []
        for kind, a, b in sorted(tagged, key=lambda x: x[1]):
            while a < b and text[a].isspace():
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
                b -= 1
            name = KINDS[kind]
            if _plausible(name, text[a:b]) and not any(a < y and x < b for x, y in taken):
                added.append((a, b, name))
                taken.append((a, b))
        out.append((base, added))
    return out


# ---- training examples ------------------------------------------------------------------------------

#: Documents that hold a base span, used for training, at most; the sample is ordered by a hash.
TRAIN_DOCS = 400
#: For each document of those, a quarter of one that has a digit or ``@`` but no span.
PLAIN_SHARE = 4
#: Windows of a text, drawn from the whole of it, at most: with a part of a span, and without.
SPANNED, FREE = 8, 4
#: Further versions of a text with a span, with spans redrawn, rewritten and set elsewhere: so many that there are
#: about ``VERSIONS`` of all texts, within these limits.
VARIANTS, MOST_VARIANTS, VERSIONS = 3, 16, 700


def _redrawn(kind: str, s: str, draw: np.random.Generator) -> str:
    """A span of the same shape with other digits and letters; a card keeps a true check digit."""
    if kind == "ip":
        return re.sub("[0-9]+", lambda m: str(draw.integers(0, 256)), s)
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = [str(draw.integers(0, 10)) if "0" <= c <= "9" else letters[draw.integers(0, 26)] if c in letters and kind == "email" else c for c in s]
    if kind == "card":
        last = max(i for i, c in enumerate(out) if c.isdigit())
        out[last] = next(d for d in "0123456789" if _luhn(_digits("".join(out[:last])) + d))
    return "".join(out)


def _rewritten(kind: str, s: str, draw: np.random.Generator) -> str:
    """A form of a labelled span that the patterns miss."""
    if kind == "email":
        return s.replace("@", str(draw.choice([" @ ", "@ ", " @"])), 1)
    if kind == "phone":
        return str(draw.choice([s.lstrip("+"), re.sub(r"^\+[0-9]+[ -]?", "", s), s.replace(" ", "/")]))
    if kind == "card":
        return re.sub(r"([0-9]{4})[ -]?(?=[0-9])", lambda m: m[1] + sep, s) if (sep := str(draw.choice([".", "/", "  "]))) else s
    return s.replace(".", str(draw.choice([":", "-", " . "])))


def examples(texts: list[str], seed: int = 7, variants: int = VARIANTS) -> tuple[np.ndarray, np.ndarray]:
    """Code and tag rows of windows from texts: as they are, then with their spans redrawn, half of them in a form
    that the patterns miss, and spans of the text set before some of its other words."""
    draw, codes, tags = np.random.default_rng(seed), [], []
    for text in texts:
        spans, free = [], 0
        for a, b, kind in sorted((a, b, k) for k, found in base_spans(text).items() for a, b in found):
            if a >= free:
                spans.append((a, b, kind))
                free = b
        blanks = [m.end() for m in re.finditer(r"(?<=[^\s0-9])[ \n](?=\w)", text)]
        for variant in range(1 + variants if spans else 1):
            placed = [(a, b, kind, text[a:b]) for a, b, kind in spans]
            if variant:
                extra = [(int(at), int(at), *spans[draw.integers(0, len(spans))]) for at in draw.choice(blanks, min(len(blanks), len(spans)), replace=False)] if blanks else []
                placed += [(at, at, kind, text[a:b] + " ") for at, _, a, b, kind in extra if not any(x <= at <= y for x, y, _ in spans)]
            parts, labels, at = [], [], 0
            for a, b, kind, body in sorted(placed):
                tail = " " if a == b else ""
                body = body.removesuffix(tail) if tail else body
                if variant:
                    body = _redrawn(kind, body, draw)
                    body = (_rewritten(kind, body, draw) if draw.random() < 0.6 else body).strip() or body
                first = 1 + 2 * KINDS.index(kind)
                parts += [text[at:a], body, tail]
                labels += [0] * (a - at) + [first] + [first + 1] * (len(body) - 1) + [0] * len(tail)
                at = b
            parts.append(text[at:])
            labels += [0] * (len(text) - at)
            new = "".join(parts)
            starts = window_starts(new)
            if len(starts):
                starts = np.minimum(starts + draw.integers(0, STRIDE, len(starts)), len(new))
                padded = np.concatenate([np.array(labels, np.int64), np.zeros(WINDOW, np.int64)])
                upto = np.concatenate([[0], np.cumsum(padded > 0)])
                spanned = upto[starts + WINDOW] > upto[starts]
                starts = np.sort(np.concatenate([draw.permutation(starts[spanned])[:SPANNED], draw.permutation(starts[~spanned])[:FREE]]))
                codes.append(_rows(_codes(new), starts))
                tags.append(padded[starts[:, None] + np.arange(WINDOW)])
    if not codes:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(codes), np.concatenate(tags)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, spanned): whether the patterns find a span in the text."""
    for part in (s for batch in batches for s in slices(batch, 1)):
        spanned = [any(base_spans(text).values()) for text in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spanned, pa.bool_())], ["key", "spanned"])


def _examples(batches: Iterator[pa.RecordBatch], variants: int) -> Iterator[pa.RecordBatch]:
    """(key, codes, tags): the windows of each text."""
    for part in (s for batch in batches for s in slices(batch, 1)):
        found = [examples([text], key % 2**32, variants) for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
        blobs = [pa.array([x[i].astype(np.uint8).tobytes() for x in found], pa.binary()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([part.column(0), *blobs], ["key", "codes", "tags"])


def train(docs: DataFrame, rows: int = TRAIN_DOCS, text_col: str = "text") -> Tagger | None:
    """The network from at most ``rows`` distinct texts with a base span, and a ``PLAIN_SHARE`` of that many with
    a digit or ``@`` but no span: those with the smallest hashes. None where no text has a span. Windows are
    cut on the executors; only theirs, a bounded number per text, reach the driver."""
    text = F.col(quoted(text_col)).cast("string")
    texts = docs.select(text.alias("text")).where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("key"), "text")
    known = written(texts.mapInArrow(_labelled, "key long, spanned boolean").distinct(), "labelled-texts")
    # the samples' bounds are parameters: a broadcast of that many keys
    spanned = bounded_sample(known.where("spanned"), rows, F.col("key")).select(F.col("key").alias("c_key"))
    variants = min(MOST_VARIANTS, max(VARIANTS, VERSIONS // max(1, spanned.count())))
    chosen = spanned.unionByName(
        bounded_sample(known.where("NOT spanned"), rows // PLAIN_SHARE, F.col("key")).select(F.col("key").alias("c_key")))
    once = texts.join(F.broadcast(chosen), F.col("key") == F.col("c_key"), "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    got = sorted(once.mapInArrow(partial(_examples, variants=variants), "key long, codes binary, tags binary").collect(), key=lambda r: r["key"])
    codes, tags = (np.frombuffer(b"".join(r[c] for r in got), np.uint8).reshape(-1, WINDOW).astype(np.int64) for c in ("codes", "tags"))
    return fit(codes, tags) if (tags > 0).any() else None


# ---- Spark -------------------------------------------------------------------------------------------

def span_text(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((a, KINDS.index(k), b, k) for a, b, k in spans))


def _found(batches: Iterator[pa.RecordBatch], model: Tagger | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, batch.num_columns - 1)):
        texts = part.column(part.num_columns - 1).to_pylist()
        counts, digests, spans, masked = [], [], [], []
        for text, (base, added) in zip(texts, all_spans(model, texts)):
            own = [(a, b, k) for k, found in base.items() for a, b in found]
            counts.append([len(base[k]) for k in KINDS])
            digests.append(hashlib.sha256(span_text(own).encode()).hexdigest())
            spans.append(span_text(own + added))
            masked.append(mask(text, own + added))
        table = np.array(counts, np.int64).reshape(len(texts), len(KINDS))
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:-1], *(pa.array(table[:, i]) for i in range(len(KINDS))), pa.array(digests, pa.string()), pa.array(spans, pa.string()),
             pa.array(masked, pa.string())], names)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not spans:
        return text
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, model: Tagger | None, carry: list[str], text_col: str = "text", prefix: str = "") -> DataFrame:
    """The carried columns of every row, counts of base spans, their digest, all spans, and the masked text.

    A null text is empty: it has no spans and its masked text is empty. Equal rows get equal results.
    Names of the added columns start with ``prefix``. Without a model only base spans are found.
    """
    rows = docs.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)], text_or_empty(text_col).alias("searched_text"))
    added = {**{f"n_{k}": LongType() for k in KINDS}, "base_sha256": StringType(), "spans": StringType(), "masked": StringType()}
    schema = StructType([*rows.schema.fields[:-1], *[StructField("a_" + n, t) for n, t in added.items()]])
    return rows.mapInArrow(partial(_found, model=model, names=schema.names), schema).toDF(*carry, *[prefix + n for n in added])
