"""Near-duplicate documents by SetSketch registers.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set holds
its distinct runs of five words (all words as one run if there are fewer). Two
documents are linked when their sets have a Jaccard similarity of 0.75 or more,
and the smallest document id that links lead to names the component.

1. Documents with equal sets are one class, whatever their number.
2. A class has 160 registers: truncated minima of exponential variables on an
   exponential scale of base 1.001 (SetSketch). Forty bands of four registers
   make its buckets; a pair at 0.75 shares none with probability 3e-7.
3. A bucket's leader is the class that meets most others over all its buckets, as the
   text that others are copied from does. First every class is held against the best
   leader of its buckets alone, so that a large group becomes one component at a pair a
   class. Then in every bucket that still holds several components, classes are held
   against its leader (a star, not all pairs), and against the next one, up to
   ``LEADERS`` times. Register comparisons and set sizes give the maximum-likelihood similarity;
   pairs far below the threshold go. The rest are verified on full sets, and verified
   links join classes to components.
4. Classes of buckets that are open after that are searched exactly across components
   by their rarest shingles, so that a link between two classes neither of which is linked
   with a leader is found as well. Two documents already in one component need no
   further look. Only here may pairs outgrow the number of classes: among many texts
   that share their rare shingles but are linked with no leader.

Copies and tight groups cost a row per document and bucket. Nothing but counts
reaches the driver. Component labels are written to the shared folder at each step.

Defined results: a null, empty or blank text has no set, is its own component and
is kept; repeated rows of a document get equal results; a null id takes part, but
never names a component (a component of null ids only has a null id and is kept);
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.llm.common import batch_of, map_slices, mixed, odd_words, rolling, texts
from zoneferry.session import stage

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
BANDS, ROWS = 40, 4
#: Leaders a bucket has, one after the other, before the exact search.
LEADERS = 3
REGISTERS = BANDS * ROWS
#: Stands for a null id where the smallest id is looked for.
LAST = (1 << 63) - 1
BASE, RATE, LIMIT = 1.001, 20.0, 65535
#: Pairs whose likelihood puts them this far below the threshold are not verified
#: (about six standard errors of 160 registers).
MARGIN = 0.21

_MULTIPLIERS = odd_words(REGISTERS, 7)


def shingles(text: str) -> np.ndarray:
    """Sorted fingerprints of a text's set."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(SHINGLE, len(words))
    return np.unique(rolling(hashes, k, k))


def registers(shingled: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingled), 2048):
        np.minimum(least, (shingled[i : i + 2048, None] * _MULTIPLIERS).min(axis=0), out=least)
    exponential = -np.log1p(-((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
    return np.clip(np.floor(1 - np.log(exponential / RATE) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in regs.reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(65537) + column.astype(np.uint64))
    return keys.view(np.int64)


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of register rows with known set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = REGISTERS - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def value(j):
        pa_, pb = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return more * np.log(pa_ + tiny) + less * np.log(pb + tiny) + same * np.log(np.maximum(1 - pa_ - pb, tiny))

    low, high = np.zeros(len(u)), most  # the logarithm is concave in the similarity
    for _ in range(30):
        one, two = low + (high - low) * 0.382, low + (high - low) * 0.618
        up = value(one) < value(two)
        low, high = np.where(up, one, low), np.where(up, high, two)
    return (low + high) / 2


_SKETCH = pa.schema([("doc_id", pa.int64()), ("th", pa.binary()), ("n", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64())), ("regs", pa.binary())])


def _node(shingled: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingled.tobytes()) - (1 << 63)


def _sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(t or "") for t in batch.column("text").to_pylist()]
    regs = [registers(s) if len(s) else None for s in sets]
    return batch_of(
        _SKETCH,
        [
            batch.column("doc_id"),
            batch.column("th"),
            [len(s) for s in sets],
            [_node(s) if len(s) else None for s in sets],
            [band_keys(r).tolist() if r is not None else None for r in regs],
            [r.tobytes() if r is not None else None for r in regs],
        ],
    )


_NODED = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("text", pa.string())])


def _noded(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(t) for t in texts(batch, "text")]
    return batch_of(_NODED, [batch.column("key"), [_node(s) if len(s) else None for s in sets], batch.column("text")])


_SET = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _set_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(t) for t in texts(batch, "text")]
    values = pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return batch_of(_SET, [batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), values)])


def _verified(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Those of the pairs whose full sets are as similar as the threshold asks."""
    sets: dict[int, np.ndarray] = {}

    def of(node: int, text: str) -> np.ndarray:
        if node not in sets:
            sets[node] = shingles(text)
        return sets[node]

    near = []
    for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
        x, y = of(a, text_a), of(b, text_b)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        near.append(shared * DENOMINATOR >= (len(x) + len(y) - shared) * NUMERATOR)
    return batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _likely(batch: pa.RecordBatch) -> pa.RecordBatch:
    def matrix(name):
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(-1, REGISTERS)

    n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
    near = likeliest(matrix("regs_a"), matrix("regs_b"), n_a, n_b) >= NUMERATOR / DENOMINATOR - MARGIN
    return batch.select(["a", "b"]).filter(pa.array(near))


def _similar_size(n_a: str, n_b: str):
    return F.least(n_a, n_b) * DENOMINATOR >= F.greatest(n_a, n_b) * NUMERATOR


def _likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) whose registers allow the threshold, staged."""
    sketch = classes.select("node", "n", "regs")
    ends = pairs.join(sketch.toDF("a", "n_a", "regs_a"), "a").join(sketch.toDF("b", "n_b", "regs_b"), "b")
    ends = ends.where(_similar_size("n_a", "n_b")).select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    return stage(map_slices(ends, _likely, "a bigint, b bigint", 4096), "near-likely")


def _texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of some classes, the text of one document each, staged.

    Texts travel instead of sets: they compress, fingerprints do not.
    """
    wanted = stage(nodes.join(classes.select("node", _key("rep")), "node"), "near-wanted")
    own = docs.select(_key("doc_id"), "text").join(wanted.select("key").distinct(), "key", "left_semi")
    noded = map_slices(own, _noded, "key bigint, node bigint, text string")
    noded = noded.join(wanted, ["key", "node"], "left_semi")
    return stage(noded.dropDuplicates(["node"]).select("node", "text"), "near-texts")


def _key(which: str) -> Column:
    """A document id to join on, with one value for null."""
    return F.coalesce(which, F.lit(-(1 << 63))).alias("key")


def _linked(likely: DataFrame, held: DataFrame) -> DataFrame:
    """Those of the pairs that are linked on their full sets, staged."""
    both = likely.join(held.toDF("a", "text_a"), "a").join(held.toDF("b", "text_b"), "b")
    return stage(map_slices(both, _verified, "a bigint, b bigint"), "near-links")


def _across(rest: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs of classes (node, label, n) of two components that may be linked; exact.

    A set of n shingles that is linked with another shares one of its
    ``n - ceil(0.75 n) + 1`` rarest shingles with the rarest of the other. Rarity
    is counted among these classes; shingles of one class only come first and pair
    nothing. At the rarest common shingle, what is left of either set must
    still hold the whole overlap the threshold asks for.
    """
    sets = map_slices(held, _set_rows, "node bigint, shingles array<bigint>")
    shingled = sets.select("node", F.explode("shingles").alias("shingle"))
    common = shingled.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = shingled.join(common, "shingle").groupBy("node")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"))
    prefix = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1
    lone = F.col("n") - F.size("ranked")
    first = F.slice("ranked", F.lit(1), F.greatest(prefix - lone, F.lit(0)).cast("int"))
    index = ranked.join(rest, "node").select("node", "label", "n", lone.alias("lone"), F.posexplode(first.getField("shingle")).alias("at", "shingle"))
    index = index.select("node", "label", "n", (F.col("n") - F.col("lone") - F.col("at")).alias("left"), "shingle")
    index = stage(index, "near-prefixes")
    other = index.toDF("node_2", "label_2", "n_2", "left_2", "shingle")
    enough = F.least("left", "left_2") * (NUMERATOR + DENOMINATOR) >= (F.col("n") + F.col("n_2")) * NUMERATOR
    pairs = index.join(other, "shingle").where((F.col("label") < F.col("label_2")) & _similar_size("n", "n_2") & enough)
    return pairs.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for every node of a link.

    Each step takes the least label among neighbours, then the label's own label,
    which halves paths. Steps are written tables.
    """
    both = stage(links.union(links.select("b", "a")).distinct(), "near-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "near-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("far"))
        step = least.join(jump, "least").select("node", F.least("least", "far").alias("label"), F.col("label").alias("old"))
        done = stage(step, "near-labels")
        labels = done.select("node", "label")
        if done.where("label != old").isEmpty():
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links; only the components that these join are walked again, each as one node."""
    a = _labelled(links.select(F.col("a").alias("node"), "b"), labels).select(F.col("b").alias("node"), F.col("label").alias("a"))
    met = components(_labelled(a, labels).select("a", F.col("label").alias("b")).distinct()).toDF("label", "least")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    return stage(known.join(met, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "near-labels")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    out = rows.join(labels, "node", "left")
    return out.withColumn("label", F.coalesce("label", "node"))


def _led(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Component labels found by holding buckets' members against their leaders.

    At first there is a pair a class at most, then in a round at most as many as there are
    members. A member leads its bucket once; pairs held against each other before are not
    again. A round without a link is the last: what it leaves open is searched exactly.
    """
    spark = members.sparkSession
    tested = spark.createDataFrame([], "a bigint, b bigint")
    labels = spark.createDataFrame([], "node bigint, label bigint")
    ends = F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")
    best = members.groupBy("slot").agg(F.max(F.struct("degree", "node")).alias("lead"))
    best = members.join(best, "slot").where("node != lead.node").groupBy("node").agg(F.max("lead").alias("lead"))
    best = best.select("node", F.col("lead.node").alias("leader")).select(*ends).distinct()
    waiting = members
    for turn in range(LEADERS + 1):
        if turn:
            rows = _labelled(waiting, labels)
            lead = rows.groupBy("slot").agg(
                F.max(F.struct("degree", "node", "label")).alias("lead"), F.min("label").alias("x"), F.max("label").alias("y")
            )
            lead = lead.where("x < y").select("slot", F.col("lead.node").alias("leader"), F.col("lead.label").alias("led"))
            waiting = stage(waiting.join(lead, "slot").where("node != leader").select("slot", "node", "degree", "leader", "led"), "near-waiting")
            pairs = _labelled(waiting, labels).where("label != led").select(*ends).distinct()
            waiting = waiting.select("slot", "node", "degree")
        pairs = stage(pairs.join(tested, ["a", "b"], "left_anti") if turn else best, "near-pairs")
        if pairs.isEmpty():
            break
        tested = tested.union(pairs)
        likely = _likely_pairs(pairs, classes)
        nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        found = _linked(likely, _texts_of(nodes, classes, docs))
        if not found.isEmpty():
            labels = _merged(labels, found)
        elif turn:
            break
    return labels


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, node, bands, regs) of documents (doc_id, th, text), staged."""
    schema = "doc_id bigint, th binary, n bigint, node bigint, bands array<bigint>, regs binary"
    return stage(map_slices(docs, _sketched, schema), "near-sketches")


def _with_components(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, label, component_id) per document (doc_id, th, text); no label without a set."""
    sketches = _sketches(docs)
    grouped = sketches.where("node is not null").groupBy("node")
    classes = stage(
        grouped.agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("regs").alias("regs")),
        "near-classes",
    )
    slots = classes.select(F.explode("bands").alias("slot"), "node")
    shared = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stage(slots.join(shared, "slot"), "near-met")
    degrees = met.groupBy("node").agg(F.sum(F.col("size") - 1).alias("degree"))
    members = stage(met.select("slot", "node").join(degrees, "node"), "near-members")
    labels = _led(members, classes, docs)

    left = _labelled(members.select("slot", "node"), labels)
    open_ = left.groupBy("slot").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("slot")
    rest = left.join(open_, "slot", "left_semi").select("node", "label").distinct()
    rest = stage(rest.join(classes.select("node", "n"), "node"), "near-rest")
    held = _texts_of(rest.select("node"), classes, docs)
    more = _linked(_likely_pairs(_across(rest, held), classes), held)
    if not more.isEmpty():
        labels = _merged(labels, more)

    named = _labelled(classes.select("node", "rep"), labels)
    names = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(names, "label").select("node", "label", "component_id")
    out = sketches.select("doc_id", "th", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", "n", "label", component.alias("component_id"))


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.lit(None).cast("binary").alias("th"))
    found = _with_components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of every component, with all its columns, whatever their names.

    The one of the smallest id stays, null ids last; of rows with one id, that of the
    smallest digest of its text; of rows equal in both, any one. Texts without words are
    components of their own, so all of them stay.
    """
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("id"),
        _digest("text").alias("th"),
        "text",
    )
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = _with_components(own.where(worded).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "text", "th"))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "th")).alias("first")
    kept = stage(found.groupBy("label").agg(first).select("first.id", "first.th"), "near-kept")
    rows = own.where(worded).join(kept, ["id", "th"], "left_semi").dropDuplicates(["id", "th"])
    return rows.select("row").unionByName(own.where(~worded).select("row")).select("row.*")
