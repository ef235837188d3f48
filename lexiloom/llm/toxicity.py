"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled, so token labels come first: features of words (the word, lower-case and without
outer punctuation, and its prefixes of 3 to 7 letters) are ranked by boosting on a bounded
sample of labelled documents, and tokens of toxic documents that bear a chosen feature are
labelled toxic, all others not.  A chain with two states (clean, toxic) then learns a weight per
feature, a bias and transitions from these tokens.  Forward-backward marginals give spans; their
sum, maximum and density give a document's score by a logistic function fitted on the same sample.

Tokens without a chosen feature all have the same potentials, so a run of n of them is the n-th power of one
2 * 2 matrix: marginals are exact for whole texts of any length, at a cost in
proportion to the tokens that bear features.

Bounds, all of them on training and parameters of ``train``: ``sample`` labelled documents of either class (those of the
least hash of the id), of which ``candidates`` features are looked at, ``chosen`` are boosted into the
chain, and ``windows`` sequences (those of the least hash of document and place) train it.  What reaches the driver is
bounded by them: which candidates each sampled document has, and the windows.  Scoring has no bounds.

Cases: a null or empty text scores as a text without features; very long texts score whole; repeated
rows score each; of rows that repeat a labelled id the least text trains; rows with a null id score but never train; contradicting labels of an
id count once each; without both kinds of labels every score is 0; an empty table gives no rows; ``toxicity`` and ``score`` read
no other columns, ``not_toxic`` keeps them under any names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .textscan import TextSlice, mixed, releasing, span_hashes, text_slices, words
from .tokenizing import id_type

SAMPLE = 3000
CANDIDATES = 4000
CHOSEN = 300
PREFIXES = (3, 4, 5, 6, 7)
SLICE = 500_000  # code points that are looked at together, or one text if it has more
CONTEXT = 2  # tokens beside one with a feature whose marginals count too
WINDOW = 32  # tokens of a training sequence
WINDOWS = 12_000  # training sequences at most

_LOWER = np.array([ord(c) if len(c := chr(p).lower()) == 1 else p for p in range(0x3000)], np.uint32)
_INNER = np.ones(0x80, bool)
_INNER[[p for p in range(0x80) if not chr(p).isalnum()]] = False


def held_out(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def token_features(piece: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts, ends and documents of the words, and for each kind of feature a hash per word (0: none)."""
    starts, ends, docs = words(piece)
    points = piece.points.copy()
    small = points < 0x3000
    points[small] = _LOWER[points[small]]
    inner = np.flatnonzero((points >= 0x80) | _INNER[np.minimum(points, 0x7F)])
    if not len(inner) or not len(starts):
        return starts, ends, docs, [np.zeros(len(starts), np.uint64)] * (1 + len(PREFIXES))
    a, b = np.searchsorted(inner, starts), np.searchsorted(inner, ends)
    some = b > a
    first, last = inner[np.minimum(a, len(inner) - 1)], inner[np.maximum(b, 1) - 1] + 1
    whole = np.zeros(len(starts), np.uint64)
    whole[some] = span_hashes(points, first[some], last[some])
    found = [whole]
    padded = np.append(points, np.zeros(PREFIXES[-1], np.uint32))
    length = np.where(some, last - first, 0)
    value = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(PREFIXES[-1]):
            value = value * np.uint64(0x100000001B3) + padded[first + j] + np.uint64(1)
            if j + 1 in PREFIXES:
                found.append(np.where(length > j, mixed(value + np.uint64(j + 1)), np.uint64(0)))
    return starts, ends, docs, found


@dataclass
class Tagger:
    """A trained chain; everything in it is bounded by CHOSEN."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # ascending
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log potential of state i, then j
    document: np.ndarray = field(default_factory=lambda: np.array([-1e3, 0, 0, 0]))  # bias; sum, maximum and density
    known: bool = False

    def __post_init__(self):
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def matches(self, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(token, feature) pairs of the chosen features, by token."""
        tokens, found = [], []
        for h in kinds:
            at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.hashes, h[at]), max(len(self.hashes) - 1, 0))
            own = self.hashes[k] == h[at] if len(self.hashes) else np.zeros(len(at), bool)
            tokens.append(at[own]), found.append(k[own])
        tokens, found = np.concatenate(tokens), np.concatenate(found)
        order = np.argsort(tokens, kind="stable")
        return tokens[order], found[order]

    def marginals(self, piece: TextSlice) -> tuple[np.ndarray, ...]:
        """Tokens near features (start, end, document, probability of toxic), and words of each document."""
        starts, ends, docs, kinds = token_features(piece)
        first = np.searchsorted(docs, np.arange(len(piece) + 1))
        tokens, found = self.matches(kinds)
        near = np.unique(np.clip((tokens[:, None] + np.arange(-CONTEXT, CONTEXT + 1)).ravel(), 0, max(len(docs) - 1, 0)))
        score = np.full(len(near), self.bias)
        np.add.at(score, np.searchsorted(near, tokens), self.weights[found])
        own = docs[near]
        # Each document's chain: near tokens, with the number of other tokens before each.
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        before = np.append(-1, near[:-1])
        before[begins] = first[own[begins]] - 1
        gaps = near - before - 1
        closing = first[own[np.append(begins[1:], len(own)) - 1] + 1] - near[np.append(begins[1:], len(own)) - 1] - 1 if len(own) else gaps
        return starts[near], ends[near], own, self._smooth(score, begins, gaps, closing, first[own] == near), np.diff(first)

    def _power(self, n: np.ndarray) -> np.ndarray:
        """n-th powers of the step to a token without features, scaled so that their sum is 1."""
        step = np.exp(self.moves + np.array([0.0, self.bias]))
        step = step / step.sum()
        out, base, n = np.broadcast_to(np.eye(2), (len(n), 2, 2)).copy(), step, n.copy()
        while n.any():
            odd = (n & 1) == 1
            out[odd] = out[odd] @ base
            out /= out.sum(axis=(1, 2), keepdims=True)
            base = base @ base
            base = base / base.sum()
            n >>= 1
        return out

    def _smooth(self, score: np.ndarray, begins: np.ndarray, gaps: np.ndarray, closing: np.ndarray, opens: np.ndarray) -> np.ndarray:
        if not len(score):
            return score
        n = np.diff(np.append(begins, len(score)))
        emit = np.stack([np.ones(len(score)), np.exp(np.clip(score, -50, 50))], axis=1)
        step, spans = np.exp(self.moves), self._power(np.maximum(gaps, 0))
        # The first token of a text has no step into it: its gap holds one token less.
        start = np.array([1.0, np.exp(self.bias)])
        forward, backward = np.zeros((len(score), 2)), np.ones((len(score), 2))
        entering = self._power(np.maximum(gaps - 1, 0))
        at = begins
        into = np.where(gaps[at, None] > 0, np.einsum("i,kij->kj", start, entering[at]) @ step, 1.0)
        forward[at] = into * emit[at]
        forward[at] /= forward[at].sum(axis=1, keepdims=True)
        for k in range(1, int(n.max())):
            at = begins[n > k] + k
            f = np.einsum("ki,kij->kj", forward[at - 1], spans[at]) @ step * emit[at]
            forward[at] = f / f.sum(axis=1, keepdims=True)
        at = begins + n - 1
        b = self._power(closing).sum(axis=2)
        backward[at] = b / b.sum(axis=1, keepdims=True)
        for k in range(2, int(n.max()) + 1):
            at = (begins + n - k)[n >= k]
            b = np.einsum("kij,kj->ki", spans[at + 1], (emit[at + 1] * backward[at + 1]) @ step.T)
            backward[at] = b / b.sum(axis=1, keepdims=True)
        both = forward * backward
        return both[:, 1] / both.sum(axis=1)

    def summary(self, own: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per document: log(1 + sum of -log(1 - p)), maximum and density of the marginals."""
        out = np.zeros((len(counts), 3))
        heat = -np.log1p(-np.minimum(p, 1 - 1e-9))
        total = np.bincount(own, heat, len(counts))
        out[:, 0] = np.log1p(total)
        np.maximum.at(out[:, 1], own, p)
        out[:, 2] = np.minimum(total / np.maximum(counts, 1), 1) * 10
        return out

    def scores(self, summary: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(summary))
        return 1 / (1 + np.exp(-np.clip(self.document[0] + summary @ self.document[1:], -500, 500)))


def _boosted(present: list[np.ndarray], toxic: np.ndarray, n: int, most: int) -> list[int]:
    """Features that tell toxic documents best, each chosen by the documents that earlier ones leave unexplained."""
    rows = np.repeat(np.arange(len(present)), [len(p) for p in present])
    columns = np.concatenate(present) if present else np.zeros(0, np.int64)
    weight, chosen = np.ones(len(present)), []
    wrong = np.bincount(columns, ~toxic[rows], n)
    least = max(2.0, 0.002 * toxic.sum())
    by = [np.zeros(0, np.int64)] * n
    order = np.argsort(columns, kind="stable")
    ends = np.searchsorted(columns[order], np.arange(n + 1))
    for f in range(n):
        by[f] = rows[order[ends[f] : ends[f + 1]]]
    hits = np.bincount(columns, weight[rows] * toxic[rows], n)
    usual = (~toxic).sum() / max(toxic.sum(), 1)
    for _ in range(most):
        gain = hits - 4 * wrong / max(usual, 1e-9) - 0.5 * wrong
        f = int(np.argmax(gain))
        if gain[f] < least:
            break
        chosen.append(f)
        hits[f] = -1e9
        for d in by[f][toxic[by[f]]].tolist():
            lost = weight[d] / 2
            weight[d] -= lost
            hits[present[d]] -= lost
    return chosen


def _fit_chain(features: list[np.ndarray], labels: np.ndarray, n: int, rounds: int = 120, penalty: float = 0.02) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions by gradient ascent; features: token indexes of each; labels: sequences * WINDOW."""
    weights, bias, moves = np.zeros(n), -2.0, np.zeros((2, 2))
    squares = [np.full(n, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    count, length = labels.shape
    tokens = np.concatenate(features) if features else np.zeros(0, np.int64)
    which = np.repeat(np.arange(n), [len(f) for f in features])
    flat = labels.reshape(-1).astype(float)
    seen = np.bincount(which, flat[tokens], n)
    pairs = np.array([[((labels[:, :-1] == i) & (labels[:, 1:] == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    for _ in range(rounds):
        score = np.full(count * length, bias)
        np.add.at(score, tokens, weights[which])
        emit = np.stack([np.zeros_like(score), np.clip(score, -40, 40)], 1).reshape(count, length, 2)
        emit, step = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(moves)
        forward, backward = np.zeros_like(emit), np.ones_like(emit)
        forward[:, 0] = emit[:, 0]
        forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, length):
            f = forward[:, t - 1] @ step * emit[:, t]
            forward[:, t] = f / f.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(length - 2, -1, -1):
            b = emit[:, t + 1] * backward[:, t + 1]
            joint = forward[:, t, :, None] * step * b[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = b @ step.T
            backward[:, t] = b / b.sum(axis=1, keepdims=True)
        p = (forward * backward)[..., 1] / (forward * backward).sum(axis=2)
        p = p.reshape(-1)
        grads = [seen - np.bincount(which, p[tokens], n) - penalty * weights, flat.sum() - p.sum() - penalty * bias, pairs - expected - penalty * moves]
        for k, g in enumerate(grads):
            squares[k] = 0.9 * squares[k] + 0.1 * np.square(g)
        weights = weights + 0.1 * grads[0] / np.sqrt(squares[0])
        bias = bias + 0.1 * grads[1] / np.sqrt(squares[1])
        moves = moves + 0.1 * grads[2] / np.sqrt(squares[2])
    return weights, float(bias), moves


def _fit_documents(x: np.ndarray, toxic: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """A logistic function by Newton's method, with a small penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (importance * (toxic - p)) - 0.1 * beta
        beta = beta + np.linalg.solve((x * (importance * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta)), grad)
    return beta


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: bool = True, sample: int = SAMPLE, candidates: int = CANDIDATES, chosen: int = CHOSEN, windows: int = WINDOWS) -> Tagger:
    """Learns from the labelled documents (with folds: those not held out), at most ``sample`` of each class."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)").distinct()
    if folds:
        marks = marks.filter(~held_out("id"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    there = marks.join(source.select("id").distinct(), "id", "left_semi")
    shares = {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    if not (shares.get(0) and shares.get(1)):
        return Tagger()
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    drawn = there.filter("toxic = 1").orderBy(*order).limit(sample).union(there.filter("toxic = 0").orderBy(*order).limit(sample))
    rows = source.join(F.broadcast(drawn), "id")  # 2 * sample ids
    texts = written(rows.groupBy("id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).select("text", "toxic", F.xxhash64(F.col("id").cast("string")).alias("key")), "labelled")

    def features(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for piece in text_slices(batch.column(0), SLICE):
                _, _, docs_, kinds = token_features(piece)
                keys, yes, no = [], [], []
                at = np.searchsorted(docs_, np.arange(len(piece) + 1))
                for i in range(len(piece)):
                    own = np.unique(np.concatenate([k[at[i] : at[i + 1]] for k in kinds]))
                    keys.append(own[own > 0])
                    (yes if toxic[piece.first + i] else no).append(keys[-1])
                every, which = np.unique(np.concatenate(keys), return_inverse=True)
                mark = np.repeat(toxic[piece.first : piece.first + len(piece)], [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(np.bincount(which, mark, len(every)).astype(np.int64)), pa.array(np.bincount(which, 1 - mark, len(every)).astype(np.int64))], ["feature", "yes", "no"])

    counts = texts.mapInArrow(releasing(features), "feature long, yes long, no long").groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    n_yes, n_no = min(shares[1], sample), min(shares[0], sample)
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    best = counts.filter((F.col("yes") >= 2) & (odds > 1.5)).orderBy(F.desc(odds * F.sqrt("yes")), "feature").limit(candidates).select("feature").toPandas()
    hashes = np.sort(best["feature"].to_numpy(np.int64).view(np.uint64))
    probe = Tagger(hashes, np.zeros(len(hashes)))

    def present(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for piece in text_slices(batch.column(0), SLICE):
                _, _, docs_, kinds = token_features(piece)
                tokens, found = probe.matches(kinds)
                at = np.searchsorted(docs_[tokens], np.arange(len(piece) + 1))
                rows = [np.unique(found[a:b]).tolist() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[piece.first : piece.first + len(piece)].astype(np.int64)), pa.array(rows, pa.list_(pa.int64()))], ["toxic", "found"])

    seen = texts.mapInArrow(releasing(present), "toxic long, found array<long>").collect()  # 2 * sample rows of candidates each at most
    toxic = np.array([r["toxic"] == 1 for r in seen])
    picked = np.array(sorted(_boosted([np.array(r["found"], np.int64) for r in seen], toxic, len(hashes), chosen)), np.int64)
    if not len(picked):
        return Tagger(document=_fit_documents(np.zeros((len(seen), 3)), toxic, _importance(toxic, shares)), known=True)
    tagger = Tagger(hashes[picked], np.zeros(len(picked)))

    def sequences(batches):
        """Windows of tokens around the features, and as many elsewhere, drawn by hash."""
        for batch in batches:
            toxic, keys = batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            for piece in text_slices(batch.column(0), SLICE):
                _, _, docs_, kinds = token_features(piece)
                tokens, found = tagger.matches(kinds)
                first = np.searchsorted(docs_, np.arange(len(piece) + 1))
                at = np.searchsorted(docs_[tokens], np.arange(len(piece) + 1))
                draws, marks, places, features = [], [], [], []
                for i in range(len(piece)):
                    own, f = tokens[at[i] : at[i + 1]] - first[i], found[at[i] : at[i + 1]]
                    blocks = np.arange(-(-int(first[i + 1] - first[i]) // WINDOW))
                    with np.errstate(over="ignore"):
                        draw = mixed(keys[piece.first + i] + blocks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    used = np.isin(blocks, own // WINDOW)
                    spare = np.flatnonzero(~used)[np.argsort(draw[~used], kind="stable")][: max(1, int(used.sum()))]
                    for b in [*np.flatnonzero(used).tolist(), *spare.tolist()]:
                        inside = own // WINDOW == b
                        draws.append(int(draw[b].view(np.int64))), marks.append(int(toxic[piece.first + i]))
                        places.append((own[inside] % WINDOW).tolist()), features.append(f[inside].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(draws, pa.int64()), pa.array(marks, pa.int64()), pa.array(places, pa.list_(pa.int64())), pa.array(features, pa.list_(pa.int64()))], ["draw", "toxic", "places", "features"])

    trained = texts.mapInArrow(releasing(sequences), "draw long, toxic long, places array<long>, features array<long>")
    trained = trained.orderBy("draw", "toxic", "places", "features").limit(windows).collect()  # windows of WINDOW tokens
    tokens_of, marks_of = [[] for _ in picked], np.zeros((len(trained), WINDOW), int)
    for row, r in enumerate(trained):
        if r["toxic"]:
            marks_of[row, r["places"]] = 1
        for t, f in zip(r["places"], r["features"]):
            tokens_of[f].append(row * WINDOW + t)
    weights, bias, moves = _fit_chain([np.array(t, np.int64) for t in tokens_of], marks_of, len(picked))
    tagger = Tagger(hashes[picked], weights, bias, moves)

    def summed(batches):
        for batch in batches:
            mark = batch.column(1).to_numpy()
            for piece in text_slices(batch.column(0), SLICE):
                _, _, own, p, n = tagger.marginals(piece)
                x = tagger.summary(own, p, n)
                yield pa.RecordBatch.from_arrays([pa.array(mark[piece.first : piece.first + len(piece)].astype(np.int64)), *(pa.array(x[:, k]) for k in range(3))], ["toxic", "x0", "x1", "x2"])

    rows = texts.mapInArrow(releasing(summed), "toxic long, x0 double, x1 double, x2 double").toPandas()  # 2 * sample rows
    mark = rows["toxic"].to_numpy() == 1
    tagger.document = _fit_documents(rows[["x0", "x1", "x2"]].to_numpy(), mark, _importance(mark, shares))
    tagger.known = True
    return tagger


def _importance(toxic: np.ndarray, shares: dict[int, int]) -> np.ndarray:
    """What each sampled document stands for, where one class was sampled more thinly; means 1."""
    weight = np.where(toxic, shares[1] / max(toxic.sum(), 1), shares[0] / max((~toxic).sum(), 1))
    return weight / weight.mean()


def score(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """doc_id, score, predicted and, if asked for, spans: start, end (code points) and probability of each toxic token."""

    def rows(batches):
        for batch in batches:
            for piece in text_slices(batch.column(1), SLICE):
                starts, ends, own, p, n = tagger.marginals(piece)
                value = tagger.scores(tagger.summary(own, p, n))
                columns = [batch.column(0).slice(piece.first, len(piece)), pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
                if spans:
                    bad = p >= 0.5
                    o = own[bad]
                    base = piece.bounds[o]
                    cut = np.searchsorted(o, np.arange(len(piece) + 1))
                    parts = pa.StructArray.from_arrays([pa.array(starts[bad] - base), pa.array(ends[bad] - base), pa.array(p[bad])], ["start", "end", "probability"])
                    columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), parts))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"][: len(columns)])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", spans array<struct<start:long,end:long,probability:double>>" * spans
    return source.mapInArrow(releasing(rows), f"doc_id {id_type(docs, id_col)}, score double, predicted int{more}")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_spans for every document, learning from those not held out."""
    scored = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


def not_toxic(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of documents that score under 0.5."""

    def rows(batches):
        for batch in batches:
            for piece in text_slices(batch.column(at), SLICE):
                keep = tagger.scores(tagger.summary(*tagger.marginals(piece)[2:])) < 0.5
                yield batch.slice(piece.first, len(piece)).filter(pa.array(keep)).select(own)

    names = docs.columns
    hidden = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    own, at = hidden.columns, names.index(text_col)
    if docs.schema[text_col].dataType.simpleString() != "string":  # texts go to Python once if they can
        hidden, at = hidden.withColumn("_text", F.col(own[at]).cast("string")), len(names)
    return hidden.mapInArrow(releasing(rows), hidden.select(*own).schema).toDF(*names)
