"""Byte-level BPE encoding and decoding with the tiktoken library.

Each Spark task reads the rank file once and encodes its rows.  A long text is
cut before encoding at places where no match of the splitting pattern can
cross: between a character that is not white space and one that is.  The only
alternatives of the pattern that take white space take it at their start, and
no alternative looks behind, so the parts encode exactly as the whole does,
in bounded memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

PART_CHARS = 1 << 18
_ENCODERS: dict = {}


def default_rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoder(rank_file: str, pattern: str):
    """The encoder of a local rank file, built once per Python worker."""
    key = (rank_file, pattern)
    if key not in _ENCODERS:
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}
        _ENCODERS[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


# ASCII blanks on the right: white space to every regex engine.
_EDGE = re.compile(r"(?<=\S)(?=[ \t\n\v\f\r])")


def safe_parts(text: str, part_chars: int = PART_CHARS) -> Iterator[str]:
    """Parts of at least ``part_chars`` characters, cut only at safe places."""
    start = 0
    while len(text) - start > part_chars:
        edge = _EDGE.search(text, start + part_chars)
        if edge is None or edge.start() >= len(text):
            break
        yield text[start : edge.start()]
        start = edge.start()
    yield text[start:] if start else text


def encode_text(enc, text: str, part_chars: int = PART_CHARS) -> list[int]:
    if len(text) <= part_chars:
        return enc.encode_ordinary(text)
    return [i for part in safe_parts(text, part_chars) for i in enc.encode_ordinary(part)]


def encode_documents(
    docs: DataFrame,
    rank_file: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = True,
    digests: bool = True,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, token_ids (with ``ids``), and
    with ``digests`` ids_sha256 and decoded_sha256, where the latter is over
    the bytes decoded again from the ids.

    A null or empty text has no token.  Repeated rows are encoded each.  Other
    columns of ``docs`` are ignored.  The rank file must be readable at the same
    path on every executor (``--files`` or the Python environment).
    """
    rank_file = rank_file or default_rank_file()
    pattern = pattern or default_pattern()
    src = text_of(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType.simpleString()
    fields = [f"doc_id {id_type}", "n_tokens bigint"]
    fields += ["token_ids array<int>"] * ids + ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        names = [b"%d" % i for i in range(enc.n_vocab)]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # small results: bounded memory per step
                part = batch.slice(at, 256)
                tokens = [encode_text(enc, t, part_chars) for t in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array([len(t) for t in tokens], pa.int64())]
                if ids:
                    cols.append(pa.array(tokens, pa.list_(pa.int32())))
                if digests:
                    cols.append(pa.array([hashlib.sha256(b" ".join([names[i] for i in t])).hexdigest() for t in tokens]))
                    cols.append(pa.array([hashlib.sha256(enc.decode_bytes(t)).hexdigest() for t in tokens]))
                yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in fields])

    return src.mapInArrow(run, ", ".join(fields))


def decode_ids(enc, ids: list[int]) -> bytes:
    return enc.decode_bytes(ids)


def decode_documents(encoded: DataFrame, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, token_ids) back to (doc_id, decoded binary); null ids give null."""
    rank_file = rank_file or default_rank_file()
    pattern = pattern or default_pattern()
    src = encoded.select("doc_id", F.col("token_ids").cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in batches:
            out = [None if t is None else decode_ids(enc, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, decoded binary")
