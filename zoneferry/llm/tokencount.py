"""Token counts of flat token files by a scan for separators.

A token file is nothing but 16-bit little-endian ids, every document closed by
the end-of-document id; there is no index. Files are scanned in blocks. Each block
finds its separators with one vectorised comparison; a prefix scan over the block
summaries (number of separators, place of the last) gives every block the number
of its first document and where that document began, and a second look at the
block emits its documents.

Defined results: an empty document counts one token, its separator; tokens after
the last separator are an unfinished document (``closed`` false); a null text is
empty; repeated rows are documents of their own; a null doc_id stays null; an empty
table writes no file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from zoneferry.llm.common import batch_of, slices, spread
from zoneferry.session import fresh_dir, stage

# Fixed value: the end-of-document id of the 50k byte-level vocabulary.
END_ID = 50256
BLOCK_TOKENS = 4_000_000

_FILE = pa.schema([("path", pa.string()), ("tokens", pa.int64()), ("doc_no", pa.int64()), ("doc_id", pa.int64())])
_BLOCK = pa.schema([("path", pa.string()), ("block", pa.int64()), ("tokens", pa.int64()), ("separators", pa.int64()), ("last", pa.int64())])
_DOC = pa.schema([("path", pa.string()), ("doc_no", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("closed", pa.bool_())])


def _token_writer(folder: str, tokenizer: str, pattern: str):
    def run(batches):
        import base64

        import tiktoken
        from pyarrow import fs
        from pyspark import TaskContext

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"{root}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.tokens"
        tokens, written, out = 0, 0, None
        try:
            for batch in slices(batches):
                for text in batch.column("text").to_pylist():
                    if out is None:
                        out = system.open_output_stream(name)
                    ids = np.array([*encode(text or ""), END_ID], "<u2")
                    out.write(ids.tobytes())
                    tokens += len(ids)
                n = batch.num_rows
                yield batch_of(_FILE, [[name] * n, [None] * n, np.arange(written, written + n), batch.column("doc_id")])
                written += n
        finally:
            if out is not None:
                out.close()
        if tokens:
            yield batch_of(_FILE, [[name], [tokens], [None], [None]])

    return run


def _block(system, path: str, block: int, size: int) -> np.ndarray:
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read_at(2 * size, 2 * block * BLOCK_TOKENS), "<u2")


def _summaries(folder: str, end_id: int):
    def run(batches):
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows: list[list] = [[] for _ in _BLOCK]
            for path, block, size in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "tokens"))):
                at = np.flatnonzero(_block(system, path, block, size) == end_id)
                last = block * BLOCK_TOKENS + int(at[-1]) if len(at) else None
                for column, value in zip(rows, (path, block, size, len(at), last)):
                    column.append(value)
            yield batch_of(_BLOCK, rows)

    return run


def _documents(folder: str, end_id: int):
    def run(batches):
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            fields = ("path", "block", "tokens", "before", "open_from", "is_last")
            for path, block, size, before, open_from, is_last in zip(*(batch.column(c).to_pylist() for c in fields)):
                first = block * BLOCK_TOKENS
                at = np.flatnonzero(_block(system, path, block, size) == end_id) + first
                starts = np.concatenate([[open_from], at + 1])
                ends, closed = at + 1, np.ones(len(at), bool)
                if is_last and starts[-1] < first + size:
                    ends, closed = np.append(ends, first + size), np.append(closed, False)
                n = len(ends)
                yield batch_of(_DOC, [[path] * n, np.arange(before, before + n), starts[:n], ends - starts[:n], closed])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, pattern: str) -> DataFrame:
    """One flat file per task that has documents.

    Returns a row (path, tokens, null, null) per file and, since the files hold ids
    and nothing else, a row (path, null, doc_no, doc_id) per document.
    """
    given = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    written = given.mapInArrow(_token_writer(folder, tokenizer, pattern), "path string, tokens bigint, doc_no bigint, doc_id bigint")
    return stage(written, "token-files")


def count_tokens(files: DataFrame, folder: str, end_id: int = END_ID) -> DataFrame:
    """Per document of flat files (path, tokens): path, doc_no, start, n_tokens, closed."""
    number = F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / BLOCK_TOKENS)))
    blocks = files.where("tokens > 0").select("path", number.alias("block"), F.col("tokens").alias("all"))
    blocks = blocks.select("path", F.col("block").cast("bigint"), F.least(F.lit(BLOCK_TOKENS), F.col("all") - F.col("block") * BLOCK_TOKENS).cast("bigint").alias("tokens"))
    found = stage(spread(blocks).mapInArrow(_summaries(folder, end_id), "path string, block bigint, tokens bigint, separators bigint, last bigint"), "token-blocks")
    order = Window.partitionBy("path").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    stitched = stage(found.select(
        "path",
        "block",
        "tokens",
        F.coalesce(F.sum("separators").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier) + 1, F.lit(0)).alias("open_from"),
        F.lead("block").over(order).isNull().alias("is_last"),
    ), "token-stitched")
    return spread(stitched).mapInArrow(_documents(folder, end_id), "path string, doc_no bigint, start bigint, n_tokens bigint, closed boolean")


def token_counts(docs: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """Tokenise all documents to flat files and count the tokens of each document in them.

    Returns doc_id, path, doc_no (its number in the file), start, n_tokens, closed.
    """
    folder = fresh_dir(docs.sparkSession, "tokens")
    written = write_tokens(docs, folder, tokenizer, pattern)
    counted = count_tokens(written.where("tokens is not null").select("path", "tokens"), folder)
    owners = written.where("tokens is null").select("path", "doc_no", "doc_id")
    # Spark takes the counts for as small as the block rows they come from and would broadcast them.
    return owners.join(counted.hint("merge"), ["path", "doc_no"]).select("doc_id", *counted.columns)
