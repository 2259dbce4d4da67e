"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Labels are of whole documents; tokens are labelled from them first.

1. Evidence. A token (``[^\\W_]+``) has as features itself and its beginnings and ends, in
   lower case. Of at most ``LABELLED`` training documents of either label, by hash of the
   id, it is counted how many toxic and how many clean ones hold a feature. Features that few toxic documents hold are left out (a
   share, so the number of features is bounded by the mean length of a toxic
   document over that share). A feature far more frequent among toxic documents is evidence.
2. Labelled tokens. In a toxic document a token with evidence is toxic; every other
   token, and all of clean documents, is clean.
3. The field. A chain is a sentence, at most ``CHAIN`` tokens of it at a time. Weights of the
   features, the bias, the start and the three transitions are fitted to the labelled
   chains by gradients from forward-backward expectations. The chains are a bounded
   sample: ``CHAINS`` that hold a toxic token and as many that hold none, by hash.
4. Scores. Forward-backward marginals of a document's tokens give the odds that any of them
   is toxic; two numbers, fitted to at most ``JUDGED`` labelled documents of either label,
   scale these odds to a score. Tokens above one half are its offending spans.

A model is some numbers per feature and goes to the tasks with the code. The sampled labels
are broadcast, so no text is shuffled; the sample's texts are written once. Scoring covers
every text whole, in one pass.

Defined results: a null, empty or blank text has no tokens and gets the score of no
evidence; repeated rows get equal results; a document with several labels is toxic if any says so;
null labels and ids do not train; a null id is not held out; without toxic or without clean
training documents every score is the share of toxic ones (0 without any); an empty
table gives no row.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.llm.common import batch_of, map_slices, mixed, slices, texts
from zoneferry.session import stage

#: Lengths of the beginnings and ends of a token that are features.
BEGINNINGS, ENDS = range(3, 8), range(4, 7)
#: A feature is held by this share of the toxic training documents, and by as many of them.
SHARE, LEAST = 0.01, 3
#: Evidence is this many times as frequent among toxic documents as among clean ones.
TIMES = 20.0
CHAIN = 128
#: Tokens a task remembers the weights of.
REMEMBERED = 300_000
#: Bounds of the samples a model is fitted to: labelled documents of either label, chains
#: with and without a toxic token, and documents of either label that scale the scores.
LABELLED, CHAINS, JUDGED = 8_000, 4_000, 2_000
STEPS, RATE, PENALTY = 80, 0.2, 1e-4
#: Log-odds beyond which one token or document is as good as certain.
CERTAIN = 20.0

_TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def features(token: str) -> list[str]:
    token = token.lower()
    size = len(token)
    found = ["=" + token]
    found += ["<" + token[:k] for k in BEGINNINGS if k < size]
    found += [">" + token[-k:] for k in ENDS if k < size]
    return found


class Memo(dict):
    """What a function of a token gives, worked out once for tokens that recur."""

    def __init__(self, of: Callable[[str], Any]):
        super().__init__()
        self.of = of

    def __missing__(self, token: str) -> Any:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[token] = self.of(token)
        return found


class Chains:
    """The tokens of some texts, in chains.

    ``codes`` number the different tokens (``names``) in order of occurrence over all texts;
    ``doc`` and ``chain`` say where a token belongs.
    """

    def __init__(self, texts_: list[str]):
        found = [_TOKEN.findall(t) for t in texts_]
        flat = np.empty(sum(map(len, found)), object)
        flat[:] = [t for f in found for t in f]
        codes, names = pd.factorize(flat)
        doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
        stop = np.array([n in _ENDS for n in names], bool)[codes] if len(codes) else np.zeros(0, bool)
        before = np.cumsum(stop)[~stop]  # sentence ends seen so far
        self.codes, self.names, self.doc = codes[~stop], names, doc[~stop]
        sentence = np.ones(len(before), bool)
        sentence[1:] = (np.diff(before) > 0) | (np.diff(self.doc) > 0)
        starts = np.flatnonzero(sentence)
        within = np.arange(len(before)) - np.repeat(starts, np.diff([*starts, len(before)]))
        self.at = within % CHAIN
        self.chain = np.cumsum(self.at == 0) - 1


def _steps(at: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token its row in an array ordered by place, longest chains first, and the
    number of chains that reach each place."""
    lengths = np.bincount(chain)
    rank = np.empty(len(lengths), np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    reach = np.bincount(at)
    return (np.cumsum(reach) - reach)[at] + rank[chain], reach


def expectations(
    odds: np.ndarray, at: np.ndarray, chain: np.ndarray, moves: np.ndarray, start: float
) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Forward-backward over all chains at once.

    ``odds`` are log-odds of a token to be toxic, ``moves[i, j]`` weights of going from
    label ``i`` to ``j``. Returns each token's marginal, the expected moves, the sum of the
    chains' log partition functions and the marginal at each place 0.
    """
    if not len(odds):
        return np.zeros(0), np.zeros((2, 2)), 0.0, np.zeros(0)
    row, reach = _steps(at, chain)
    ends = np.cumsum(reach)
    toxic = np.empty(len(odds))
    toxic[row] = np.exp(np.clip(odds, -CERTAIN, CERTAIN))
    move = np.exp(moves)
    clean_at, toxic_at = np.empty(len(odds)), np.empty(len(odds))
    total = 0.0
    for k, end in enumerate(ends):
        here = slice(end - reach[k], end)
        if k == 0:
            c, t = np.ones(reach[0]), np.full(reach[0], np.exp(start))
        else:
            old = slice(ends[k - 1] - reach[k - 1], ends[k - 1] - reach[k - 1] + reach[k])
            c = clean_at[old] * move[0, 0] + toxic_at[old] * move[1, 0]
            t = clean_at[old] * move[0, 1] + toxic_at[old] * move[1, 1]
        t = t * toxic[here]
        size = c + t
        total += np.log(size).sum()
        clean_at[here], toxic_at[here] = c / size, t / size
    marginal = np.empty(len(odds))
    expected = np.zeros((2, 2))
    for k in range(len(ends) - 1, -1, -1):
        here = slice(ends[k] - reach[k], ends[k])
        c, t = np.ones(reach[k]), np.ones(reach[k])
        more = reach[k + 1] if k + 1 < len(ends) else 0
        if more:
            # what follows, for the chains that go on
            to_c, to_t = after_c, after_t * toxic[ends[k] : ends[k] + more]
            c[:more] = move[0, 0] * to_c + move[0, 1] * to_t
            t[:more] = move[1, 0] * to_c + move[1, 1] * to_t
            a, b = clean_at[here][:more], toxic_at[here][:more]
            joint = np.array([[a * move[0, 0] * to_c, a * move[0, 1] * to_t], [b * move[1, 0] * to_c, b * move[1, 1] * to_t]])
            expected += (joint / joint.sum((0, 1))).sum(2)
        size = c + t
        after_c, after_t = c / size, t / size
        a, b = clean_at[here] * after_c, toxic_at[here] * after_t
        marginal[here] = b / (a + b)
    first = marginal[: reach[0]]
    return marginal[row], expected, total, first


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    moves: np.ndarray
    start: float
    slope: float
    shift: float

    odds: Memo = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "odds", Memo(self._own))

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.moves, self.start, self.slope, self.shift)

    def _own(self, token: str) -> float:
        get, token = self.weights.get, token.lower()
        size = len(token)
        odds = get("=" + token, 0.0)
        for k in BEGINNINGS:
            if k >= size:
                break
            odds += get("<" + token[:k], 0.0)
        for k in ENDS:
            if k >= size:
                break
            odds += get(">" + token[-k:], 0.0)
        return odds

    def marginals(self, chains: Chains) -> np.ndarray:
        own = np.array([self.odds[n] for n in chains.names])
        odds = own[chains.codes] + self.bias if len(chains.codes) else np.zeros(0)
        return expectations(odds, chains.at, chains.chain, self.moves, self.start)[0]

    def evidence(self, chains: Chains, marginals: np.ndarray, n: int) -> np.ndarray:
        """Log-odds that a text, of ``n``, has a toxic token, by its tokens' marginals."""
        none = np.bincount(chains.doc, np.log1p(-np.minimum(marginals, 1 - 1e-12)), n)
        return np.clip(np.log(np.maximum(-np.expm1(none), 1e-300)) - none, -CERTAIN, CERTAIN)

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * evidence + self.shift)))


def spans(text: str, toxic: np.ndarray, chain: np.ndarray) -> list[tuple[int, int]]:
    """Start and end, in code points, of the stretches of toxic tokens of a text.

    ``toxic`` numbers the toxic tokens; neighbours of one chain (``chain``, by token) join.
    """
    found: list[tuple[int, int]] = []
    wanted = iter(toxic.tolist())
    next_, last = next(wanted, None), -2
    tokens = (m for m in _TOKEN.finditer(text) if m[0] not in _ENDS)
    for i, m in enumerate(tokens):
        if next_ is None:
            break
        if i == next_:
            if last == i - 1 and chain[i] == chain[last]:
                found[-1] = (found[-1][0], m.end())
            else:
                found.append(m.span())
            next_, last = next(wanted, None), i
    return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """(doc_id, text, toxic) of the sample that trains, staged; toxic and clean labels in all."""
    known = labels.where("toxic is not null and doc_id is not null")
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int") != 0).alias("toxic"))
    known = stage(known.where(~held_out(F.col("doc_id"))), "toxic-labels")
    n_toxic, n_clean = (known.where(F.col("toxic") == is_toxic).count() for is_toxic in (True, False))
    parts = [known.where(F.col("toxic") == is_toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED) for is_toxic in (True, False)]
    sample = stage(parts[0].unionByName(parts[1]), "toxic-sample")
    own = docs.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # twice LABELLED rows of an id and a flag at most
    return stage(own.join(F.broadcast(sample), "doc_id"), "toxic-training"), n_toxic, n_clean


def _counted(docs: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """(feature, n): how many documents hold each feature, of those asked for."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(lambda t: [f for f in features(t) if among is None or f in among])
        for batch in slices(batches):
            held: Counter[str] = Counter()
            for text in texts(batch, "text"):
                held.update({f for t in set(_TOKEN.findall(text)) - _ENDS for f in known[t]})
            yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["feature", "n"])

    return docs.select("text").mapInArrow(count, "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


_CHAIN = pa.schema([("hash", pa.int64()), ("tokens", pa.list_(pa.string()))])


def _sampled(docs: DataFrame, evidence: frozenset[str], toxic: bool, bound: int) -> list[list[str]]:
    """The ``bound`` chains of least hash of those with a token of evidence, or without one.

    Tasks keep as many each, whatever their share of the rows.
    """

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = Memo(lambda t: any(f in evidence for f in features(t)))
        kept: list[tuple[int, list[str]]] = []
        for batch in slices(batches):
            held = texts(batch, "text")
            chains = Chains(held)
            if not len(chains.codes):
                continue
            starts = np.flatnonzero(chains.at == 0)
            ends = np.append(starts[1:], len(chains.codes))
            has = np.logical_or.reduceat(np.array([marked[n] for n in chains.names], bool)[chains.codes], starts)
            doc = chains.doc[starts]
            named = np.array([xxhash.xxh3_64_intdigest(t.encode()) for t in held], np.uint64)[doc]
            hashes = mixed(named + np.arange(len(starts), dtype=np.uint64) - np.searchsorted(doc, doc).astype(np.uint64)) >> np.uint64(1)
            wanted = np.flatnonzero(has == toxic)
            if len(kept) == bound:
                wanted = wanted[hashes[wanted] <= kept[-1][0]]
            new = [(int(hashes[k]), chains.names[chains.codes[starts[k] : ends[k]]].tolist()) for k in wanted]
            kept = heapq.nsmallest(bound, kept + new)
        yield batch_of(_CHAIN, [[h for h, _ in kept], [t for _, t in kept]])

    found = docs.select("text").mapInArrow(least, "hash bigint, tokens array<string>")
    return [r["tokens"] for r in found.orderBy("hash", F.concat_ws(" ", "tokens")).limit(bound).collect()]


def _fitted(chains: list[list[str]], labels: list[np.ndarray], names: list[str]) -> tuple[dict[str, float], float, np.ndarray, float]:
    """Weights of the features, bias, moves and start, by Adam on the mean log-likelihood."""
    number = {f: i for i, f in enumerate(names)}
    flat = np.empty(sum(map(len, chains)), object)
    flat[:] = [t for c in chains for t in c]
    codes, tokens = pd.factorize(flat)
    held = [[number[f] for f in features(t) if f in number] for t in tokens]
    columns = np.array([f for h in held for f in h], np.int64)
    rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
    at = np.concatenate([np.arange(len(c)) for c in chains])
    chain = np.repeat(np.arange(len(chains)), [len(c) for c in chains])
    y = np.concatenate(labels).astype(float)
    follows = np.flatnonzero(at > 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[follows - 1].astype(int), y[follows].astype(int)), 1)
    y_first = y[at == 0].sum()
    f = len(names)
    theta = np.zeros(f + 5)
    theta[f] = -2.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        own = np.bincount(rows, theta[columns], len(held))
        moves = np.array([[0.0, theta[f + 2]], [theta[f + 3], theta[f + 4]]])
        p, moved, _, first = expectations(own[codes] + theta[f], at, chain, moves, theta[f + 1])
        slack = np.bincount(codes, y - p, len(held))
        gradient = np.concatenate(
            [
                np.bincount(columns, slack[rows], f),
                [slack.sum(), y_first - first.sum(), *(seen - moved).ravel()[1:]],
            ]
        ) / len(chains) - PENALTY * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    moves = np.array([[0.0, theta[f + 2]], [theta[f + 3], theta[f + 4]]])
    weights = {n: float(w) for n, w in zip(names, theta[:f]) if w}
    return weights, float(theta[f]), moves, float(theta[f + 1])


def _scaled(evidence: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through labels, by Newton's steps with a small penalty."""
    x = np.stack([evidence, np.ones_like(evidence)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -CERTAIN, CERTAIN)))
        gradient = x.T @ (y - p) - 0.1 * (theta - [1.0, 0.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return max(float(theta[0]), 1e-3), float(theta[1])


def _constant(share: float) -> Model:
    return Model({}, -CERTAIN, np.zeros((2, 2)), 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The field learnt from the labelled documents that are not held out."""
    rows, all_toxic, all_clean = _training(docs.select(F.col("doc_id").cast("bigint"), "text"), labels)
    share = all_toxic / max(all_toxic + all_clean, 1)
    toxic, clean = rows.where("toxic"), rows.where("not toxic")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return _constant(share)
    enough = max(LEAST, int(np.ceil(SHARE * n_toxic)))
    common = {r["feature"]: r["n"] for r in _counted(toxic, None).where(F.col("n") >= enough).collect()}
    others = {r["feature"]: r["n"] for r in _counted(clean, frozenset(common)).collect()}

    def times(feature: str) -> float:
        return ((common[feature] + 0.5) / (n_toxic + 1)) / ((others.get(feature, 0) + 0.5) / (n_clean + 1))

    evidence = frozenset(f for f in common if times(f) >= TIMES)
    if not evidence:
        return _constant(share)
    parts = [(toxic, True), (toxic, False), (clean, False)]
    bounds = [CHAINS, CHAINS // 2, CHAINS // 2]
    chains, marks = [], []
    for (part, marked), bound in zip(parts, bounds):
        for tokens in _sampled(part, evidence, marked, bound):
            chains.append(tokens)
            marks.append(np.array([marked and any(f in evidence for f in features(t)) for t in tokens]))
    learnt = Model(*_fitted(chains, marks, sorted(common)), 1.0, 0.0)
    judged = [_evidence(part.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(JUDGED), learnt) for part in (toxic, clean)]
    found = [np.array([r["evidence"] for r in j.collect()]) for j in judged]
    # Odds as among all training labels, whatever their share in the sample.
    y = np.concatenate([np.ones(len(found[0])), np.zeros(len(found[1]))])
    slope, shift = _scaled(np.concatenate(found), y)
    shift += float(np.log(all_toxic / all_clean) - np.log(len(found[0]) / len(found[1])))
    return Model(learnt.weights, learnt.bias, learnt.moves, learnt.start, slope, shift)


def _evidence(docs: DataFrame, model: Model) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        chains = Chains(texts(batch, "text"))
        found = model.evidence(chains, model.marginals(chains), batch.num_rows)
        return pa.record_batch([pa.array(found, pa.float64())], names=["evidence"])

    return map_slices(docs.select("text"), rows, "evidence double")


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score, spans (start and end in code points)."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = texts(batch, "text")
        chains = Chains(held)
        marginals = model.marginals(chains)
        evidence = model.evidence(chains, marginals, len(held))
        found: list[list[dict[str, int]]] = [[] for _ in held]
        toxic = np.flatnonzero(marginals > 0.5)
        for k in np.unique(chains.doc[toxic]).tolist():
            a, b = np.searchsorted(chains.doc, [k, k + 1])
            inside = toxic[np.searchsorted(toxic, a) : np.searchsorted(toxic, b)] - a
            found[k] = [{"start": x, "end": y} for x, y in spans(held[k], inside, chains.chain[a:b])]
        return batch_of(_SCORED, [batch.column("doc_id"), model.scores(evidence), found])

    schema = "doc_id bigint, score double, spans array<struct<start: int, end: int>>"
    return map_slices(docs.select(F.col("doc_id").cast("bigint"), "text"), rows, schema)
