"""Byte-level BPE: encode texts to token ids with offsets, decode ids to bytes and text.

Encoding runs over Arrow batches: the `tiktoken` library over the ranks, or `tokenizers` over another
vocabulary. A vocabulary writes every byte as one printable character; `byte_of_char` rebuilds that table,
so a token's true bytes, and with them the offset of every token in bytes and characters, follow from the
ids alone.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Characters handed to the library at once, and so in a batch that leaves the worker.
CHUNK_CHARS = 500_000
#: Ids decoded at once, and ids in a batch of decoding, unless one row has more.
CHUNK_IDS, BATCH_IDS = 1 << 18, 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Ranked:
    """An encoder over a file of ranks: the same ids as the vocabulary's, without offsets."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = public_tokenizers.PATTERN
        self.encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_ordinary(self, text: str) -> list[int]:
        try:
            return self.encoding.encode_ordinary(text)
        except BaseException as e:
            if type(e).__name__ != "PanicException":
                raise
        # the library's own matching gives up on about a million white spaces in a row; its merging doesn't
        import regex

        return [i for found in regex.finditer(self.pattern, text) for i in self.encoding._encode_single_piece(found[0])]


@functools.cache
def ranked(path: str) -> Ranked:
    return Ranked(path)


def byte_of_char() -> dict[str, int]:
    """Printable bytes stand for themselves; the others take the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A worker's tokenizer and the bytes of each of its tokens."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        back = byte_of_char()
        with open(path, encoding="utf-8") as f:
            words = json.load(f)["model"]["vocab"]
        self.bytes_of: list[bytes] = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            # a special token has characters outside the table and stands for its own text
            self.bytes_of[i] = bytes(back[c] for c in word) if all(c in back for c in word) else word.encode()
        self.size_of = np.array([len(b) for b in self.bytes_of], dtype=np.int32)
        self.start_of = (np.cumsum(self.size_of) - self.size_of).astype(np.int32)
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [got.ids for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode_lists(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes behind lists of ids that end at `ends`; ids outside the vocabulary stand for nothing.

        All of them together are below 2 GB, which Arrow's binary columns hold; `_by_ids` cuts batches so.
        """
        parts, sizes = [], []
        for some in (ids[at : at + CHUNK_IDS] for at in range(0, len(ids), CHUNK_IDS)):
            known = (some >= 0) & (some < len(self.size_of))
            some = np.where(known, some, 0)
            size = np.where(known, self.size_of[some], np.int32(0))
            upto = np.cumsum(size, dtype=np.int32)  # CHUNK_IDS tokens: far below 2 GB
            at = np.repeat(self.start_of[some] - (upto - size), size)
            at += np.arange(len(at), dtype=np.int32)
            parts.append(self.all_bytes[at])
            sizes.append(size)
        upto = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]), dtype=np.int64)
        bounds = upto[np.concatenate([[0], ends])]
        if bounds[-1] >= 1 << 31:
            raise ValueError("more than 2 GB of bytes in one batch")
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])

    def decode_bytes(self, ids) -> bytes:
        return self.decode_lists(np.array([i for i in ids if i is not None], dtype=np.int64), np.array([sum(i is not None for i in ids)]))[0].as_py()

    def offsets(self, text: str, ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token the byte where it starts and its range of characters.

        A token that holds part of a character counts that whole character as its own, so
        neighbours that share a split character overlap by one.
        """
        ends = np.cumsum(self.size_of[np.asarray(ids, dtype=np.int64)]) if len(ids) else np.zeros(0, np.int64)
        starts = ends - (self.size_of[np.asarray(ids, dtype=np.int64)] if len(ids) else 0)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char_at = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character each byte belongs to
        if not len(raw):
            return starts, starts, ends
        return starts, char_at[starts], char_at[ends - 1] + 1


def split_stream(pieces: Iterator[bytes]) -> Iterator[str]:
    """Text of a stream of token bytes; a character split between tokens waits for its last byte.

    Bytes that can never become a character turn into U+FFFD.
    """
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        yield decoder.decode(piece)
    yield decoder.decode(b"", final=True)


def _list_array(lists: list) -> pa.ListArray:
    """Lists of small numbers as an Arrow array, by way of flat ones."""
    flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, dtype=np.int32) for x in lists)])
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32), flat)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about CHUNK_CHARS; a longer text is a slice by itself."""
    at, held = 0, 0
    for row, n in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
        if held and held + n > CHUNK_CHARS:
            yield batch.slice(at, row - at)
            at, held = row, 0
        held += n
    if batch.num_rows > at:
        yield batch.slice(at)


def encode(docs: DataFrame, vocabulary: str | None = None, offsets: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids), and with `offsets` also byte_start, char_start and char_end of each token.

    A null text counts as empty and has no ids. Rows stay one to one, also repeated ones and those
    without an id; other columns, whatever their names, are left behind. Texts are never cut.
    """
    path, ranks = vocabulary or default_vocabulary(), default_ranks()
    more = ", byte_start array<int>, char_start array<int>, char_end array<int>" if offsets else ""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.load(path)
        for batch in (part for whole in batches for part in _chunks(whole)):
            texts = batch.column(1).to_pylist()
            ids = words.encode(texts) if vocabulary else [*map(ranked(ranks).encode_ordinary, texts)]
            columns = [batch.column(0), _list_array(ids)]
            names = ["doc_id", "ids"]
            if offsets:
                found = [words.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                columns += [_list_array([f[k] for f in found]) for k in range(3)]
                names += ["byte_start", "char_start", "char_end"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>{more}")


def _by_ids(batches: Iterator[pa.RecordBatch], column: str = "ids") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of BATCH_IDS ids at most, or of one row, with their ids (null: -1) and where each row's end."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        counts = np.nan_to_num(pc.list_value_length(batch.column(place)).to_numpy(zero_copy_only=False)).astype(np.int64)
        ends, at = np.cumsum(counts), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + BATCH_IDS, side="right")))
            part = batch.slice(at, upto - at)
            yield part, pc.fill_null(part.column(place).flatten(), -1).to_numpy(zero_copy_only=False), ends[at:upto] - before
            at = upto


def decode(encoded: DataFrame, vocabulary: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """`encoded` (an `ids` column) with `raw` (binary) and, for reading, `decoded` left to the caller.

    `raw` holds the exact bytes, also where a token ends inside a character; `keep` names the other
    columns that stay (default: all). Null ids give empty bytes. An empty table gives no rows.
    """
    path = vocabulary or default_vocabulary()
    kept = [c for c in (keep if keep is not None else encoded.columns) if c != "raw"]
    schema = ", ".join(f"`{c}` {t}" for c, t in encoded.select(*kept).dtypes) + ", raw binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.load(path)
        for batch, ids, ends in _by_ids(batches):
            raw = words.decode_lists(ids, ends)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept] + [raw], names=[*kept, "raw"])

    needed = [*kept, *([] if "ids" in kept else ["ids"])]
    return encoded.select(*needed).mapInArrow(run, schema)


def digests(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, offsets_sha256) of encoded rows; ids are decoded here.

    The last one hashes byte_start, char_start and char_end, one after the other, as 32-bit little-endian
    numbers; it is null where `encoded` has no offsets. Rows stay one to one; null ids count as none.
    """
    path = vocabulary or default_vocabulary()
    spans = [c for c in ("byte_start", "char_start", "char_end") if c in encoded.columns]
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.load(path)
        for batch, ids, ends in _by_ids(batches):
            raw = words.decode_lists(ids, ends)
            bounds = np.concatenate([[0], ends])
            written = [hashlib.sha256(" ".join(map(str, ids[a:b].tolist())).encode()).hexdigest() for a, b in zip(bounds, ends)]
            decoded = [hashlib.sha256(memoryview(x.as_buffer())).hexdigest() for x in raw]
            places = [None] * batch.num_rows
            if len(spans) == 3:
                flat = [batch.column(batch.schema.get_field_index(c)).flatten().to_numpy().astype("<i4") for c in spans]
                places = [hashlib.sha256(b"".join(f[a:b].tobytes() for f in flat)).hexdigest() for a, b in zip(bounds, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(np.diff(bounds)), pa.array(written), pa.array(decoded), pa.array(places, type=pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256"],
            )

    return encoded.select("doc_id", "ids", *spans).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string")
