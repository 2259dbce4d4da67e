"""Quality rules: hard limits, then divergence from the language's own profile.

A document passes the base rules when it has 50 words or more and at most half
of them lie in three-word windows that occur twice or more in it. Then its
histograms of character classes and of common words are compared with those of
its language by the Jensen-Shannon distance (base 2, 0 to 1). The references are
summed over all documents that pass the base rules, language by language.

Guards: the character test needs ``min_chars`` characters, the word test
``min_words`` words, and a reference counts only with ``min_reference`` words.
Below a guard the test passes, for a short text is far from any profile by chance.

Defined results: a null or empty text has no words and fails the base rules; a
null or rare language is held against the profile of all languages together;
repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zoneferry.llm.common import batch_of, map_slices, without_columns

# Very common words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at this from are".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par sur pas au avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})
#: A common word counts as written in small letters, with a capital or in capitals (ASCII).
_FORMS = [
    (i, form)
    for i, w in enumerate(WORDS)
    for form in dict.fromkeys((w.encode(), w[:1].encode().upper() + w[1:].encode(), w.encode().upper()))
]

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "white", "stop", "symbol", "other", "wide")


def _class_table() -> np.ndarray:
    kinds = np.full(256, CLASSES.index("other"), np.int64)
    for byte in range(256):
        c = chr(byte)
        if 0x80 <= byte < 0xC0:
            kinds[byte] = len(CLASSES)  # the rest of a wide character, not counted
        elif byte >= 0xC0:
            kinds[byte] = CLASSES.index("wide")
        elif c in WHITE:
            kinds[byte] = CLASSES.index("white")
        elif c.isdigit():
            kinds[byte] = CLASSES.index("digit")
        elif c.isalpha():
            kinds[byte] = CLASSES.index("lower" if c.islower() else "upper")
        elif c in SYMBOLS:
            kinds[byte] = CLASSES.index("symbol")
        elif c in ".,;:!?'\"()-":
            kinds[byte] = CLASSES.index("stop")
    return kinds


_CLASS_OF = _class_table()


@dataclass(frozen=True)
class Limits:
    """The parameters of the rules."""

    min_words_base: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.31
    max_word_distance: float = 0.335
    min_chars: int = 400
    min_words: int = 200
    min_reference: int = 1000
    #: Languages with a profile of their own, by their number of words; the rest share one.
    languages: int = 1000


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8."""
    return text.encode().split()


def measures(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Base measures, characters by class, common words (others last)."""
    words = words_of(text)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    repeated = 0
    if len(ids) >= 3:
        two = ids[:-2] * len(seen) + ids[1:-1]
        if len(seen) >= 1 << 21:  # three numbers of words no longer fit 64 bits
            two = np.unique(two, return_inverse=True)[1]
        key = two * len(seen) + ids[2:]
        ordered = np.sort(key)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):
            twice = np.isin(key, again)
            covered = np.zeros(len(ids), bool)
            for i in range(3):
                covered[i : i + len(twice)] |= twice
            repeated = int(covered.sum())
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup += line in lines
            lines.add(line)
    chars = np.bincount(_CLASS_OF[np.frombuffer(text.encode(), np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]
    common = np.zeros(len(WORDS) + 1, np.int64)
    if len(ids):
        times = np.bincount(ids)
        for i, form in _FORMS:
            at = seen.get(form)
            if at is not None:
                common[i] += times[at]
        common[-1] = len(ids) - common.sum()
    base = [
        len(words),
        len(text) - sum(text.count(c) for c in WHITE),
        sum(text.count(c) for c in SYMBOLS),
        dup,
        repeated,
    ]
    return base, chars, common


def base_fails(n_words: int, n_repeat_words: int, limits: Limits) -> bool:
    return n_words < limits.min_words_base or 100 * n_repeat_words > limits.max_repeat_percent * n_words


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms with a positive sum."""
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


_SUMS = pa.schema([("lang", pa.string()), ("sums", pa.list_(pa.int64()))])


def references(docs: DataFrame, limits: Limits = Limits()) -> dict[str | None, np.ndarray]:
    """Profiles by language over all documents; None holds that of all together.

    Tasks send one row per language and slice; the driver gets at most
    ``limits.languages`` rows of some ninety numbers.
    """

    def partial(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: dict = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            base, chars, common = measures(text or "")
            if not base_fails(base[0], base[4], limits):
                total[lang] = total.get(lang, 0) + np.concatenate([chars, common])
        return batch_of(_SUMS, [list(total), [x.tolist() for x in total.values()]])

    parts = map_slices(without_columns(docs, "text", "lang"), partial, "lang string, sums array<bigint>")
    width = len(CLASSES) + len(WORDS) + 1
    summed = parts.groupBy("lang").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    words = sum((F.col(f"s{i}") for i in range(len(CLASSES), width)), F.lit(0))
    own = F.row_number().over(_by_size(words)) <= limits.languages
    kept = summed.withColumn("own", own & F.col("lang").isNotNull())
    kept = kept.withColumn("lang", F.when(F.col("own"), F.col("lang")))
    kept = kept.groupBy("lang").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    found = {r[0]: np.array(r[1:], np.int64) for r in kept.collect()}
    everything = sum(found.values(), np.zeros(width, np.int64))
    return {k: v for k, v in found.items() if k is not None} | {None: everything}


def _by_size(words):
    from pyspark.sql import Window

    return Window.orderBy(words.desc(), F.col("lang"))


def judge(text: str, lang: str | None, profiles: dict, limits: Limits) -> tuple[list[int], bool, float | None, float | None, bool]:
    base, chars, common = measures(text)
    failed = base_fails(base[0], base[4], limits)
    profile = profiles.get(lang)
    if profile is None or profile[len(CLASSES) :].sum() < limits.min_reference:
        profile = profiles[None]
    far_chars = far_words = None
    if profile[len(CLASSES) :].sum() >= limits.min_reference:
        if chars.sum() >= limits.min_chars:
            far_chars = distance(chars, profile[: len(CLASSES)])
        if base[0] >= limits.min_words:
            far_words = distance(common, profile[len(CLASSES) :])
    kept = (
        not failed
        and (far_chars is None or far_chars <= limits.max_class_distance)
        and (far_words is None or far_words <= limits.max_word_distance)
    )
    return base, failed, far_chars, far_words, kept


_JUDGED = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("class_distance", pa.float64()), ("word_distance", pa.float64())]
)


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row of measures and verdict per document."""
    profiles = references(docs, limits)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [
            judge(text or "", lang, profiles, limits)
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist())
        ]
        return batch_of(
            _JUDGED,
            [batch.column("doc_id"), *[[x[0][i] for x in out] for i in range(5)], [x[1] for x in out], [x[4] for x in out], [x[2] for x in out], [x[3] for x in out]],
        )

    read = docs.select(F.col("doc_id").cast("bigint"), "text", "lang")
    return map_slices(
        read,
        rows,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
        " n_repeat_words bigint, base_failed boolean, kept boolean, class_distance double, word_distance double",
    )


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents the rules keep, with all their columns."""
    profiles = references(docs, limits)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdicts = [
            judge(text or "", lang, profiles, limits)[4]
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist())
        ]
        return batch.filter(pa.array(verdicts, pa.bool_()))

    return map_slices(docs, rows, docs.schema)
