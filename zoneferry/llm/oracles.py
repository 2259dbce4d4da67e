"""DuckDB SQL for the queries SQL can express."""

from __future__ import annotations

#: One step per bit of the reflected CRC-32 polynomial; DuckDB has no such function.
CRC32 = """xor(list_reduce(
    flatten(list_transform(string_split({text}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN (CASE WHEN x >= 0 THEN xor(c, x) ELSE c END) % 2 = 1
        THEN xor((CASE WHEN x >= 0 THEN xor(c, x) ELSE c END) >> 1, 3988292384)
        ELSE (CASE WHEN x >= 0 THEN xor(c, x) ELSE c END) >> 1 END,
    4294967295), 4294967295)"""


def crc32(text: str) -> str:
    return CRC32.format(text=text)


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _raised(below: str, level: int) -> list[str]:
    """Nodes (tree, i, d, n) of the next level; a tree's only node stays as it is."""
    return [
        f"""runs{level} AS (SELECT tree, i // 16 AS run, string_agg(d, '' ORDER BY i) AS run_text, any_value(n) AS n
            FROM {below} GROUP BY ALL)""",
        f"""nodes{level} AS (SELECT tree, run AS i, CASE WHEN n > 1 THEN sha256(run_text) ELSE run_text END AS d,
            count(*) OVER (PARTITION BY tree) AS n FROM runs{level})""",
    ]


def _climbed(paths: str, level: int) -> str:
    """Paths (row, tree, i, now, proof) after the runs of a level."""
    before = "substr(run_text, 1, 64 * (i % 16))"
    after = "substr(run_text, 64 * (i % 16) + 65)"
    return f"""path{level} AS (SELECT p.* REPLACE (i // 16 AS i,
            CASE WHEN n > 1 THEN sha256({before} || now || {after}) ELSE now END AS now,
            CASE WHEN n > 1 THEN proof || {before} || {after} ELSE proof END AS proof)
        FROM {paths} p JOIN runs{level} r ON r.tree = p.tree AND r.run = p.i // 16)"""


#: Levels of one source's tree and of the tree over sources: 16 ** 5 leaves each.
DEPTH = 5


def _merkle() -> str:
    changed = f"{crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS d,
            CASE WHEN {changed} THEN {_leaf(lower)} ELSE {_leaf('text')} END AS now FROM documents)""",
        """nodes0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i,
            count(*) OVER (PARTITION BY tree) AS n FROM leaves)""",
        "path0 AS (SELECT doc_id, d AS leaf, tree, i, now, '' AS proof FROM nodes0)",
    ]
    for level in range(1, DEPTH + 1):
        steps += [*_raised(f"nodes{level - 1}", level), _climbed(f"path{level - 1}", level)]
    top = DEPTH + 1
    steps += [
        f"subroots AS (SELECT tree, d AS subroot FROM nodes{DEPTH})",
        """trees AS (SELECT '' AS tree, tree AS source, subroot AS d, row_number() OVER (ORDER BY tree) - 1 AS i,
            count(*) OVER () AS n FROM subroots)""",
        f"""up AS (SELECT doc_id, leaf, d AS subroot, t.tree, t.i, now, proof
            FROM path{DEPTH} p JOIN trees t ON t.source = p.tree)""",
    ]
    below, paths = "trees", "up"
    for level in range(top, top + DEPTH):
        steps += [*_raised(below, level), _climbed(paths, level)]
        below, paths = f"nodes{level}", f"path{level}"
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = d AS verified
        FROM {paths} p JOIN {below} n ON n.tree = p.tree"""


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, table: str = "documents", key: str = "doc_id", word: str = r"[^\x20\x09-\x0D]+") -> str:
    """One row per word, numbered from 1, with the number of words; texts without any have none."""
    return f"""lists AS (SELECT {key}, regexp_extract_all(coalesce({text}, ''), '{word}') AS words FROM {table}),
        words AS (SELECT {key}, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM lists)"""


def _window(size: int) -> str:
    return (
        "array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY i "
        f"ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING), ' ')"
    )


NEAR_DUPLICATES = f"""
    WITH RECURSIVE {_words(LOWER.format("text"))},
    shingles AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, i, n, {_window(5)} AS shingle FROM words)
        WHERE i <= greatest(n - 4, 1)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingles x JOIN shingles y USING (shingle)
        WHERE x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
    reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
    least AS (SELECT a AS doc_id, min(b) AS other FROM reached GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
           doc_id <= coalesce(other, doc_id) AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

WARC = """
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    firsts AS (SELECT *, strlen(body) AS size, min(page_id) OVER (PARTITION BY body) AS first_id FROM bodies)
    SELECT page_id, size AS payload_bytes, sha256(body) AS payload_digest,
           CASE WHEN size >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN size >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM firsts"""

REPEATS = f"""
    WITH {_words("text")},
    windows AS (SELECT doc_id, i, n, word, CASE WHEN i <= n - 19 THEN {_window(20)} END AS win FROM words),
    starts AS (SELECT *, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again FROM windows),
    covered AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
        FROM starts),
    kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text_kept FROM covered GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(text_kept, '')) AS kept_sha256
    FROM documents LEFT JOIN kept USING (doc_id)"""

BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _contaminated() -> str:
    """Windows of ten words; items of fewer words are one window of their own length."""
    sizes = range(1, 11)
    doc_windows = " UNION ALL ".join(
        f"SELECT doc_id, i, {k} AS size, {_window(k)} AS win FROM words WHERE {k} IN (SELECT size FROM item_windows) "
        f"QUALIFY i <= n - {k - 1}"
        for k in sizes
    )
    return f"""
    WITH {_words(LOWER.format("text"), word=BENCH_WORD)},
    items AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{BENCH_WORD}') AS own FROM benchmark),
    item_windows AS (SELECT DISTINCT item_id, least(len(own), 10) AS size,
            array_to_string(list_slice(own, k, k + 9), ' ') AS win
        FROM (SELECT item_id, own, unnest(range(1, greatest(len(own) - 8, 2))) AS k FROM items WHERE len(own) > 0)),
    doc_windows AS ({doc_windows}),
    met AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
    hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM met) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
    SELECT doc_id, len(lists.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM lists LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)"""


ORACLES: dict[str, str] = {
    "op1_minhash_neardup": NEAR_DUPLICATES,
    "op4_decontamination": _contaminated(),
    "op5_warc": WARC,
    "op8_substring_dedup": REPEATS,
    "op11_merkle_manifest": _merkle(),
}
