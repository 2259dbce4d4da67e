"""Merkle manifest, periodic runs and toxicity, each against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneferry.llm import merkle, periodic, queries, toxicity
from zoneferry.llm.common import table

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, i long, digest string, runs string, score double"


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing names."""
    clash = ("x", 7, "y", "z", 0.5)
    rows = [(i, t, "en", s, 3, *clash) for i, (t, s) in enumerate([(None, "a"), ("", "a"), (" \n", None), ("One", ""), ("é ß", "b"), ("Ab " * 5000, "a")])]
    rows += [rows[3], (3, "other", "en", "", 3, *clash), (None, "No id", None, None, None, *clash), (None, None, None, None, None, *clash)]
    rows += [(100 + i, f"Text {i}", "de", "a", i, *clash) for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(digests):
    """(root, for every leaf the list of (place in run, run))."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[k : k + 16] for k in range(0, len(digests), 16)]
        for path, i in zip(paths, range(len(at))):
            path.append((at[i] % 16, runs[at[i] // 16]))
            at[i] //= 16
        digests = [sha(*run) for run in runs]
    return digests[0] if digests else None, paths


def plain_manifest(rows, lowered):
    trees = {}
    for row in rows:
        trees.setdefault("" if row.source is None else "=" + row.source, []).append((row, plain_leaf(row, row.text)))
    out, roots, held = [], [], []
    for name in sorted(trees, key=str.encode):
        leaves = sorted(trees[name], key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        root, paths = climb([d for _, d in leaves])
        roots.append(root)
        held.append((leaves, root, paths))
    top, tops = climb(roots)
    for (leaves, root, paths), above in zip(held, tops):
        for (row, leaf), path in zip(leaves, paths):
            now = leaf
            if lowered and row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0:
                text = row.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text)
                now = plain_leaf(row, text)
            proof = "".join("".join(run[:k] + run[k + 1 :]) for k, run in path + above)
            for k, run in path + above:
                now = sha(*run[:k], now, *run[k + 1 :])
            out.append((row.doc_id, leaf, root, top, sha(proof), now, now == top))
    return out


def lowered():
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(marked, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("which", ["given", "odd", "empty", "one"])
def test_manifest(spark, which):
    docs = table(spark, SMALL, "documents") if which == "given" else odd_documents(spark)
    docs = {"empty": docs.limit(0), "one": docs.where("doc_id = 4")}.get(which, docs)
    got = merkle.proofs(merkle.build(docs, lowered())).collect()
    assert ordered(got) == ordered(plain_manifest(docs.collect(), True))


def test_manifest_over_several_segments(spark):
    """One source of more than one block, ragged at every level, beside small ones."""
    sizes = {"big": merkle.BLOCK * 2 + 17, "full": merkle.BLOCK, "small": 16, "lone": 1}
    docs = spark.range(sum(sizes.values())).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"))
    source, at = F.lit("lone"), 0
    for name, n in sizes.items():
        source = F.when((F.col("doc_id") >= at) & (F.col("doc_id") < at + n), name).otherwise(source)
        at += n
    docs = docs.withColumns({"source": source, "lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    manifest = merkle.build(docs, lowered())
    assert len(manifest.tiers) == 2
    assert ordered(merkle.proofs(manifest).collect()) == ordered(plain_manifest(docs.collect(), True))
    full = merkle.proofs(manifest, full=True).where("doc_id = 5").first()
    assert hashlib.sha256(full.proof.encode()).hexdigest() == merkle.proofs(manifest).where("doc_id = 5").first().proof


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096])
def test_positions_address_the_log(leaves):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(leaves)]
    levels = 0
    while 16**levels < leaves:
        levels += 1
    log = merkle.segment(digests, levels)
    level, nodes = 0, digests
    while True:
        for j, digest in enumerate(nodes):
            at = merkle.position(min((j + 1) * 16**level, leaves) - 1, level) * merkle.DIGEST
            assert log[at : at + merkle.DIGEST] == digest
        if level == levels:
            break
        nodes = [merkle.node(b"".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
        level += 1
    assert len(log) == merkle.DIGEST * (merkle.position(leaves - 1, levels) + 1)


def plain_runs(words):
    """Every period tried at every place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        k = 0
        while k < len(words) - q:
            end = k
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            if end - k + q >= max(24, 3 * q):
                found.setdefault((k, end - k + q), q)
            k = end + 1 if end == k else end
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_made_words():
    chance = random.Random(4)
    total = 0
    for _ in range(800):
        n, letters = chance.choice([10, 24, 48, 90, 200]), chance.choice([1, 2, 3, 40])
        words = [chance.randrange(letters) for _ in range(n)]
        for _ in range(chance.randint(0, 4)):
            start = chance.randrange(n)
            period, end = chance.randint(1, max(1, (n - start) // 3)), chance.randint(start, n)
            for i in range(start, end):
                words[i] = words[start + (i - start) % period]
        expected = plain_runs(words)
        total += len(expected)
        assert periodic.runs(np.array(words) + 1) == expected
    assert total > 200


def test_runs_of_very_long_texts():
    assert periodic.runs(np.ones(300_000, np.int64)) == [(0, 300_000, 1)]
    words = np.arange(100_000) % 33_000
    assert periodic.runs(words + 1) == [(0, 100_000, 33_000)]
    line = np.tile(np.arange(30), 5_000)
    line[::31] = np.arange(len(line[::31])) + 100  # a passage that recurs after ever new words
    assert periodic.runs(line + 1) == plain_runs_short(line)


def plain_runs_short(words):
    """For words whose runs have short periods only."""
    assert not plain_runs(words[:600].tolist())
    return []


@pytest.mark.parametrize("which", ["given", "odd", "empty"])
def test_periodic_query(spark, which, monkeypatch):
    docs = table(spark, SMALL, "documents") if which == "given" else odd_documents(spark)
    docs = docs.limit(0) if which == "empty" else docs
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.op12_periodic_runs(spark, SMALL)
    expected = []
    for row in docs.collect():
        words = (row.text or "").encode().split()
        h = zlib.crc32(str(row.doc_id).encode())
        if row.doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if len(words) < 3000 or len(set(words)) < 3 else None
        if runs is None:
            continue
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        milli = best and 1000 * best[1] // best[2]
        expected.append((row.doc_id, len(runs), *(best or (None,) * 3), milli, sha(listed), hashlib.sha256(kept).hexdigest()))
    rows = ordered(got.collect())
    assert len(rows) == docs.count()
    assert set(map(repr, ordered(expected))) <= set(map(repr, rows))
    assert which == "empty" or len(expected) > 0.9 * len(rows)


def plain_marginals(odds, moves, start):
    """All labellings of one chain, summed."""
    n = len(odds)
    weight = np.zeros(n)
    total, expected = 0.0, np.zeros((2, 2))
    for labels in np.ndindex(*[2] * n):
        value = start * labels[0] + sum(o * y for o, y in zip(odds, labels))
        value = np.exp(value + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += value
        weight += value * np.array(labels)
        for pair in zip(labels, labels[1:]):
            expected[pair] += value
    return weight / total, expected / total, np.log(total)


def test_forward_backward_equals_the_sum_over_labellings():
    chance = np.random.default_rng(2)
    sizes = [1, 5, 2, 7, 1, 4]
    odds = chance.normal(size=sum(sizes))
    at = np.concatenate([np.arange(n) for n in sizes])
    chain = np.repeat(np.arange(len(sizes)), sizes)
    moves = np.array([[0.0, -1.0], [0.5, 1.5]])
    marginal, expected, log_sum, first = toxicity.expectations(odds, at, chain, moves, 0.3)
    plain = [plain_marginals(odds[chain == k], moves, 0.3) for k in range(len(sizes))]
    assert np.allclose(marginal, np.concatenate([p[0] for p in plain]))
    assert np.allclose(expected, sum(p[1] for p in plain))
    assert np.isclose(log_sum, sum(p[2] for p in plain))
    assert np.isclose(first.sum(), sum(p[0][0] for p in plain))


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op13_toxicity(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    toxic = counts.get((1, 1), 0) + counts.get((1, 0), 0)
    assert counts.get((1, 1), 0) >= 0.85 * toxic
    assert counts.get((0, 1), 0) <= 0.01 * sum(n for (y, _), n in counts.items() if y == 0)


def test_toxicity_learns_from_training_labels_only(spark):
    """A word marks toxic documents; held-out labels are the other way round."""
    chance = random.Random(1)
    docs, labels = [], []
    for i in range(300):
        words = [chance.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words[5] = words[20] = "Vilewort"
        docs.append((i, " ".join(words) + ".", "vilewort", 0.5))
        labels.append((i, int(toxic) if zlib.crc32(str(i).encode()) % 3 != 1 else int(not toxic)))
    docs += [(None, "a vilewort here", "", 0.5), (None, None, "", 0.5), (900, "", "", 0.5), (901, None, None, None), docs[0]]
    docs.append((902, "clean " * 50_000 + "vilewort", "", 0.5))
    labels += [(None, 1), (7, None), (1, 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 306
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            has = "vilewort" in (texts[r.doc_id] or "").lower()
            assert (r.score >= 0.7) == has, r.doc_id
            assert all(texts[r.doc_id][s.start : s.end].lower() == "vilewort" for s in r.spans) and bool(r.spans) == has
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score < 0.01 for r in toxicity.score(docs, none).collect()} == {True}
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == 306
