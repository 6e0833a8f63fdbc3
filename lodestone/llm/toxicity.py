"""Toxicity: a linear-chain CRF over words, its marginals summed up to document scores and spans.

Only documents are labelled, so words are labelled first: a word of a toxic training document is toxic where the word, or a
leading part of it, is found in toxic documents nearly alone. The CRF (two tags, weights of hashed word and prefix features,
transitions) is fitted to these tags by the gradient that forward-backward gives. A document's score is a logistic
function of its marginals, fitted on training documents that the CRF has not seen. Fitting uses at most `train_docs`
labelled rows of each kind, of at most `train_chars` characters each; scoring reads every text whole, map side, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, powers, prefix_hash, prepare, spans, tidied, tidy, utf8

TRAIN_DOCS = 1200
TRAIN_CHARS = 10_000
THRESHOLD = 0.7
BITS = 18
PREFIXES = (4, 5, 6)
LONGEST = 128
CHUNK = 1 << 20

#: Bytes that words hold (letters, and all of UTF-8's longer characters), and those that end a sentence.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
STOP = np.zeros(256, bool)
STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Words:
    """Words of texts that lie one after another: places, text of each, chain of each, and hashed features (-1: none)."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    chain: np.ndarray
    at: np.ndarray
    features: np.ndarray


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    if not _tables or len(_tables[0][0]) <= len(data):
        _tables[:] = [powers(max(len(data) + 1, CHUNK + 1))]
    power, inverse = _tables[0]
    low = LOWER[data]
    letter = np.zeros(len(low) + 2, bool)
    letter[1:-1] = LETTER[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(letter[1:-1] & (~letter[:-2] | edge[:-1]))
    end = np.flatnonzero(letter[1:-1] & (~letter[2:] | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    h = prefix_hash(low, power)
    feats = np.full((1 + len(PREFIXES), len(start)), -1, np.int32)
    cut = np.uint64(64 - BITS)
    feats[0] = (mix((h[end] - h[start]) * inverse[start]) >> cut).astype(np.int32)
    for k, n in enumerate(PREFIXES, 1):
        ok = np.flatnonzero(end - start >= n)
        s = start[ok]
        feats[k, ok] = (mix((h[s + n] - h[s]) * inverse[s] + np.uint64(k)) >> cut).astype(np.int32)
    stops = np.concatenate(([0], np.cumsum(STOP[low])))
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (stops[start[1:]] != stops[start[:-1]])
    first = np.flatnonzero(new)
    at = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
    new |= at % LONGEST == 0
    at %= LONGEST
    return Words(start, end, doc, np.cumsum(new) - 1, at, feats)


@dataclass
class Crf:
    weights: np.ndarray  # of the toxic tag against the clean one, by feature; the last is read for missing features
    bias: float
    trans: np.ndarray  # log, from tag to tag
    first: np.ndarray  # log, of the first tag

    def emission(self, w: Words) -> np.ndarray:
        return self.weights[w.features].sum(0, dtype=np.float64) + self.bias


def forward_backward(score: np.ndarray, w: Words, crf: Crf, count: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of the toxic tag by word and, with `count`, the expected number of each transition in all."""
    out = np.zeros(len(score))
    pairs = np.zeros((2, 2)) if count else None
    if not len(score):
        return out, pairs
    heads = np.flatnonzero(w.at == 0)
    lengths = np.diff(np.append(heads, len(score)))
    odds = np.exp(np.clip(score, -30, 30))
    t = np.exp(crf.trans)
    f = np.exp(crf.first)
    for low, high in ((1, 4), (5, 8), (9, 16), (17, 32), (33, 64), (65, LONGEST)):
        pick = np.flatnonzero((lengths >= low) & (lengths <= high))
        if not len(pick):
            continue
        for part in np.split(pick[np.argsort(-lengths[pick], kind="stable")], range(4096, len(pick), 4096)):
            _chains(part, lengths, heads, odds, t, f, out, pairs)
    return out, pairs


def _chains(pick, lengths, heads, odds, t, f, out, pairs) -> None:
    """Some chains, from long to short, side by side; adds to out and pairs."""
    if len(pick):
        n, head = lengths[pick], heads[pick]
        steps = int(n[0])
        live = [int(np.searchsorted(-n, -i, "left")) for i in range(steps + 1)]  # chains longer than i
        a0, a1, e = (np.ones((steps, len(pick))) for _ in range(3))
        for i in range(steps):
            m = live[i]
            e[i, :m] = odds[head[:m] + i]
            if i:
                x0 = a0[i - 1, :m] * t[0, 0] + a1[i - 1, :m] * t[1, 0]
                x1 = (a0[i - 1, :m] * t[0, 1] + a1[i - 1, :m] * t[1, 1]) * e[i, :m]
            else:
                x0, x1 = np.full(m, f[0]), f[1] * e[0, :m]
            z = x0 + x1
            a0[i, :m], a1[i, :m] = x0 / z, x1 / z
        b0 = b1 = np.ones(len(pick))
        for i in range(steps - 1, -1, -1):
            m = live[i]
            p1 = a1[i, :m] * b1[:m]
            p1 = p1 / (a0[i, :m] * b0[:m] + p1)
            out[head[:m] + i] = p1
            if i:
                x0, x1 = b0[:m], e[i, :m] * b1[:m]
                if pairs is None:
                    y0, y1 = t[0, 0] * x0 + t[0, 1] * x1, t[1, 0] * x0 + t[1, 1] * x1
                    z = y0 + y1
                    b0, b1 = b0.copy(), b1.copy()
                    b0[:m], b1[:m] = y0 / z, y1 / z
                    continue
                j = [[a0[i - 1, :m] * t[0, 0] * x0, a0[i - 1, :m] * t[0, 1] * x1], [a1[i - 1, :m] * t[1, 0] * x0, a1[i - 1, :m] * t[1, 1] * x1]]
                z = j[0][0] + j[0][1] + j[1][0] + j[1][1]
                pairs += [[(j[r][c] / z).sum() for c in (0, 1)] for r in (0, 1)]
                y0 = t[0, 0] * x0 + t[0, 1] * x1
                y1 = t[1, 0] * x0 + t[1, 1] * x1
                z = y0 + y1
                b0, b1 = b0.copy(), b1.copy()
                b0[:m], b1[:m] = y0 / z, y1 / z


def summaries(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """By document: log of one plus the sum of marginals over one half, and the largest marginal."""
    total = np.bincount(doc, np.where(p > 0.5, p, 0), n)
    most = np.zeros(n)
    np.maximum.at(most, doc[p > 0.01], p[p > 0.01])
    return np.stack([np.log1p(total), most], 1)


def _all_words(texts: list[str]) -> Words:
    data, offsets = utf8(pa.array(texts, pa.string()))
    parts, chains = [], 0
    for i, j in spans(offsets, CHUNK):
        w = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        parts.append((w.start, w.end, w.doc + i, w.chain + chains, w.at, w.features))
        chains += int(w.chain[-1]) + 1 if len(w.chain) else 0
    return Words(*(np.concatenate(x, -1) for x in zip(*parts)))


def _distinct(w: Words, n: int) -> np.ndarray:
    """Documents kept for fitting: of near copies, found by the smallest hashes of their word triples, the first."""
    f = w.features[0].astype(np.uint64)
    triple = mix(f[:-2] * np.uint64(31) + f[1:-1] * np.uint64(1009) + f[2:] * np.uint64(65537)) if len(f) > 2 else f[:0]
    doc = w.doc[: len(triple)]
    order = np.lexsort((triple, doc))
    seen: set[int] = set()
    keep = np.ones(n, bool)
    lo = np.searchsorted(doc[order], np.arange(n + 1))
    for i in range(n):
        few = triple[order[lo[i] : lo[i] + 16]].tolist()
        keep[i] = sum(x in seen for x in few) * 2 < max(1, len(few))
        if keep[i]:
            seen.update(few)
    return keep


def fit(texts: list[str], toxic: np.ndarray, prior: float, epochs: int = 30) -> tuple[Crf, np.ndarray]:
    """The CRF and the logistic weights of a document's summaries. prior: share of toxic rows among all training rows."""
    n, size = len(texts), 1 << BITS
    crf = Crf(np.zeros(size + 1, np.float32), -4.0, np.log([[0.95, 0.05], [0.8, 0.2]]), np.log([0.95, 0.05]))
    if not n or toxic.all() or not toxic.any():
        base = np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
        return crf, np.array([base, 0.0, 0.0])
    w = _all_words(texts)
    keep = _distinct(w, n)
    fitted = keep & (np.arange(n) % 3 != 2)
    df = np.zeros((2, size))
    for k in range(len(w.features)):
        use = (w.features[k] >= 0) & fitted[w.doc]
        pair = np.unique(w.doc[use].astype(np.int64) * size + w.features[k][use])
        for y in (0, 1):
            np.add.at(df[y], pair[toxic[pair // size] == y] % size, 1)
    share = (fitted & ~toxic).sum() / max(1, (fitted & toxic).sum())
    # a feature of no meaning is in toxic documents alone with odds of one in exp(11) at most
    least = 11 / np.log(fitted.sum() / max(1, (fitted & toxic).sum()))
    telling = np.append((df[1] >= max(4, least)) & (df[1] * share >= 24 * df[0]), False)
    tag = telling[w.features].any(0) & toxic[w.doc]
    use = fitted[w.doc]  # chains lie within documents
    some = Words(w.start[use], w.end[use], w.doc[use], w.chain[use], w.at[use], w.features[:, use])
    y = tag[use].astype(np.float64)
    after = some.at[1:] > 0
    seen_pairs = np.array([[((y[:-1] == r) & (y[1:] == c) & after).sum() for c in (0, 1)] for r in (0, 1)], float)
    heads = some.at == 0
    grad2 = np.full(size + 1, 1e-6)
    bias2, trans2, first2 = 1e-6, np.full((2, 2), 1e-6), np.full(2, 1e-6)
    for _ in range(epochs):
        p, pairs = forward_backward(crf.emission(some), some, crf, True)
        miss = y - p
        g = np.zeros(size + 1)
        for k in range(len(some.features)):
            g += np.bincount(np.where(some.features[k] < 0, size, some.features[k]), miss, size + 1)
        g -= 0.5 * crf.weights
        g[size] = 0
        grad2 += g * g
        crf.weights = (crf.weights + 0.5 * g / np.sqrt(grad2)).astype(np.float32)
        b = miss.sum()
        bias2 += b * b
        crf.bias += 0.3 * b / np.sqrt(bias2)
        d = seen_pairs - pairs
        trans2 += d * d
        crf.trans = crf.trans + 0.2 * d / np.sqrt(trans2)
        d = np.array([-(y[heads] - p[heads]).sum(), (y[heads] - p[heads]).sum()])
        first2 += d * d
        crf.first = crf.first + 0.2 * d / np.sqrt(first2)
    p, _ = forward_backward(crf.emission(w), w, crf)
    x = np.column_stack([np.ones(n), summaries(p, w.doc, n)])
    held = keep & ~fitted if (keep & ~fitted & toxic).any() and (keep & ~fitted & ~toxic).any() else keep
    x, z = x[held], toxic[held].astype(float)
    weigh = np.where(z == 1, prior / max(z.mean(), 1e-6), (1 - prior) / max(1 - z.mean(), 1e-6))
    beta = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weigh * (z - q)) - 0.05 * beta
        h = (x * (weigh * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3)
        beta = beta + np.linalg.solve(h, g)
    return crf, beta


def _score(crf: Crf, beta: np.ndarray, threshold: float, with_spans: bool, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            scores, counts = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
            found: list = [[] for _ in range(len(scores))] if with_spans else []
            for i, j in spans(offsets, CHUNK):
                off = offsets[i : j + 1] - offsets[i]
                w = words(data[offsets[i] : offsets[j]], off)
                p, _ = forward_backward(crf.emission(w), w, crf)
                x = np.column_stack([np.ones(j - i), summaries(p, w.doc, j - i)])
                scores[i:j] = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                hit = np.flatnonzero(p >= 0.5)
                counts[i:j] = np.bincount(w.doc[hit], minlength=j - i)
                if with_spans:
                    for k in hit.tolist():
                        d = w.doc[k]
                        found[i + d].append({"start": int(w.start[k] - off[d]), "end": int(w.end[k] - off[d]), "p": float(p[k])})
            cols = {c: batch.column(c) for c in extra} | {"score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32)), "toxic_words": pa.array(counts)}
            if with_spans:
                cols["spans"] = pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> tuple[Crf, np.ndarray]:
    """Fit on labels (doc_id, toxic) of rows whose crc32(doc_id as text) mod 3 is not 1: up to `train_docs` of each kind, picked by a hash of doc_id, of up to `train_chars` characters. Null labels take no part."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for kind in (0, 1):
        part = known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        picked = part if picked is None else picked.unionByName(part)
    # the pick is bounded by train_docs, so broadcasting it is safe
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull() & (F.length("text") <= train_chars))
    rows = texts.join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * train_docs).collect()
    toxic = np.array([r["toxic"] == 1 for r in rows], bool)
    model = fit([r["text"] for r in rows], toxic, totals.get(1, 0) / max(1, sum(totals.values())))
    del rows
    tidy()
    return model


def score(docs: DataFrame, model: tuple[Crf, np.ndarray], threshold: float = THRESHOLD, with_spans: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """score (0 to 1), predicted (1 from `threshold` on) and toxic_words of every text, beside the columns in `keep`; with_spans adds the words with a marginal of one half or more, by byte offsets.

    Null, empty and wordless texts get the score of a text none of whose words is toxic;
    texts of any length are read whole; repeated rows are scored each; an empty table gives no rows; columns not in
    `keep` play no part, so clashing names do not matter.
    """
    spark = prepare(docs.sparkSession)
    crf, beta = model
    kinds = [f"`{c}` {t}" for c, t in docs.dtypes if c in keep] + ["score double", "predicted int", "toxic_words long"] + ["spans array<struct<start:int,end:int,p:double>>"] * with_spans
    names = [c for c in docs.columns if c in keep]
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(tidied(_score(crf, beta, threshold, with_spans, names)), ", ".join(kinds))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score", "predicted", "toxic_words")
