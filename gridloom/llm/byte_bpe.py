"""Byte-level BPE by a global shuffle of distinct words.

1. Each task cuts its documents into pre-tokens and numbers the distinct ones of a
   block of documents by falling frequency. The explosion into (word, position) is
   kept packed: one row per block with every document's word numbers in order, and
   one row per block and bucket with the words of that bucket. A very common word so
   makes one entry a block, however often it occurs.
   One shuffle takes each row where it is needed, a block's documents by block and its words
   by bucket, so no word is shuffled twice; that shuffle is read twice.
2. In its first read all blocks' copies of a word meet in one task, which encodes it once and
   answers each block's row with the numbers and ids of its words.
3. The answers meet the documents in the second read by block, and each document is put back
   together by position: its ids, and its bytes from the joined token-byte table.

A block is bounded by ``BLOCK`` characters (a longer text is a block of its own). There is a
bucket for each ``BUCKET`` bytes of text, and at least one for each shuffle partition, so a
bucket's words don't grow with the input; should they exceed ``REMEMBERED``, its task forgets
them and goes on, and a word may be encoded again. The token tables are bounded by the
vocabulary. Nothing is collected or broadcast.

Pre-tokens are the library's for every character: the classes of the pattern are read from the
library's own regex engine, once a worker, as engines follow different versions of Unicode.

Defined results: null counts as empty (no ids, no bytes); repeated rows each give a
row; other columns are ignored whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import pieces, release

#: Characters of a block, bytes of text for which there is a bucket, words that a bucket's task remembers at a time.
BLOCK, BUCKET, REMEMBERED = 4_000_000, 1 << 24, 200_000
#: Characters of a longer text that are cut into words at a time.
STRETCH = 1 << 20
#: The compression of what is shuffled, and that which tells the shorter of two layouts.
LEVEL, QUICK = 5, 1
#: The bucket of the row that holds a block's documents.
DOCS = -1


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def word_encoder(path: str, pattern: str):
    """From a pre-token's bytes to its ids as little-endian unsigned 32-bit integers."""
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})
    return lambda word: np.array(encoding._encode_single_piece(word), "<u4").tobytes()


@cache
def token_bytes(path: str) -> tuple[list[bytes], np.ndarray]:
    """By id: a token's bytes and their number."""
    ranks = ranks_of(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table, np.array([len(t) for t in table], np.int64)


#: Every character but surrogates, which no text holds.
CODE_POINTS = (range(0xD800), range(0xE000, 0x110000))


def every_character() -> str:
    return np.concatenate([np.arange(c.start, c.stop, dtype="<u4") for c in CODE_POINTS]).tobytes().decode("utf-32-le")


#: A class of characters, a bracket, any other escape, any other character of a pattern.
PART = re.compile(r"(?P<kind>\\[pP]\{\w+\}|\\[sS])|\\.|.", re.S)


@cache
def members(kind: str) -> str:
    """The characters of a class as the library knows them; its regex engine has its own version of Unicode."""
    import tiktoken

    # Whatever a pattern doesn't match is left out of the encoding.
    probe = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return bytes(probe.encode_ordinary(every_character())).decode()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def ranges(chars: str) -> str:
    """Sorted characters as the ranges of a regex class."""
    codes = code_points(chars).astype(np.int64)
    breaks = np.flatnonzero(np.diff(codes) != 1)
    firsts, lasts = codes[np.r_[0, breaks + 1]], codes[np.r_[breaks, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts.tolist(), lasts.tolist()))


def spelled_out(pattern: str, kinds: dict[str, str]) -> str:
    """The pattern with the ranges of its classes in their place."""
    out, inside = [], False
    for m in PART.finditer(pattern):
        if m["kind"]:
            out.append(kinds[m["kind"]] if inside else f"[{kinds[m['kind']]}]")
        else:
            inside = m[0] == "[" or inside and m[0] != "]"
            out.append(m[0])
    return "".join(out)


@cache
def splitters(pattern: str) -> tuple[Callable[[str], list[str]], Callable[[str], list[str]], np.ndarray]:
    """A fast way to find pre-tokens, one that agrees with the library on every character, and by
    code point, whether the fast one's classes don't."""
    import regex

    kinds = {m["kind"] for m in PART.finditer(pattern) if m["kind"]}
    differ = np.zeros(CODE_POINTS[-1].stop, bool)
    for kind in kinds:
        differ[np.setxor1d(code_points(members(kind)), code_points("".join(regex.findall(f"{kind}+", every_character()))))] = True
    exact = re.compile(spelled_out(pattern, {kind: ranges(members(kind)) for kind in kinds}))
    return regex.compile(pattern).findall, exact.findall, differ


class Numbers(dict):
    """From a word to its number in the order of first occurrence."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


class PreTokens:
    """The word numbers of a block's texts."""

    #: One space between two characters that are no white space: a match always ends before it.
    safe = re.compile(r"(?<=\S) (?=\S)").search

    def __init__(self, pattern: str) -> None:
        self.fast, self.exact, self.differ = splitters(pattern)
        self.numbers = Numbers()

    def of(self, text: str) -> np.ndarray:
        out, start = [np.zeros(0, "<u4")], 0
        while start < len(text):
            cut = self.safe(text, start + STRETCH)
            stretch = text[start : cut.start() if cut else len(text)]
            start += len(stretch)
            find = self.exact if self.differ[code_points(stretch)].any() else self.fast
            out.append(np.array(list(map(self.numbers.__getitem__, find(stretch))), "<u4"))
        return np.concatenate(out)


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as narrow as their values allow, behind each other, compressed: number by number, or all first bytes before
    all second ones, whichever is shorter by a quick compression."""
    narrow = [a if isinstance(a, bytes) else a.astype("<u1" if not len(a) or a.max() < 1 << 8 else "<u2" if a.max() < 1 << 16 else "<u4") for a in arrays]
    made = []
    for planes in (False, True) if any(not isinstance(a, bytes) and a.itemsize > 1 for a in narrow) else (False,):
        parts = []
        for a in narrow:
            width = 0 if isinstance(a, bytes) else a.itemsize
            raw = a if isinstance(a, bytes) else a.view("u1").reshape(-1, width).T.tobytes() if planes else a.tobytes()
            parts += [bytes([width]), len(raw).to_bytes(8, "little"), raw]
        made.append((planes, b"".join(parts)))
    planes, raw = made[0] if len(made) == 1 else min(made, key=lambda x: len(pa.Codec("zstd", QUICK).compress(x[1], asbytes=True)))
    return bytes([planes]) + len(raw).to_bytes(8, "little") + pa.Codec("zstd", LEVEL).compress(raw, asbytes=True)


def unpack(blob: bytes) -> list:
    raw, at, out = pa.decompress(memoryview(blob)[9:], int.from_bytes(blob[1:9], "little"), "zstd", asbytes=True), 0, []
    while at < len(raw):
        width, n = raw[at], int.from_bytes(raw[at + 1 : at + 9], "little")
        part = raw[at + 9 : at + 9 + n]
        if blob[0] and width:
            part = np.ascontiguousarray(np.frombuffer(part, "u1").reshape(width, -1).T).tobytes()
        out.append(np.frombuffer(part, f"<u{width}") if width else part)
        at += 9 + n
    return out


def split_at(data: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def block_rows(texts: list[str], pattern: str, buckets: int) -> Iterator[tuple[int, bytes]]:
    """The packed explosion of a block: (DOCS, word numbers by document), then (bucket, its words)."""
    words = PreTokens(pattern)
    docs = [words.of(t) if t else np.zeros(0, "<u4") for t in texts]
    flat = np.concatenate(docs) if docs else np.zeros(0, "<u4")
    lengths = np.array([len(d) for d in docs], "<u4")
    del docs
    order = np.argsort(-np.bincount(flat, minlength=len(words.numbers)), kind="stable")
    rank = np.empty(len(order), "<u4")
    rank[order] = np.arange(len(order))
    yield DOCS, pack(lengths, rank[flat] if len(flat) else flat)
    spelled = [w.encode() for w in words.numbers]
    by_bucket: dict[int, list[int]] = {}
    for k, number in enumerate(order.tolist()):
        by_bucket.setdefault(zlib.crc32(spelled[number]) % buckets, []).append(k)
    for bucket, ks in by_bucket.items():
        mine = [spelled[order[k]] for k in ks]
        yield bucket, pack(np.diff(np.array(ks), prepend=0), np.array([len(w) for w in mine]), b"".join(mine))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``ids`` (binary, little-endian unsigned 32-bit integers) and ``decoded`` (binary).

    ``ranks_path`` must be readable where Python workers run.
    """
    slim = docs.select(F.col(id_col), F.col(text_col))
    id_type = slim.schema[0].dataType
    size = slim.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    #: The key of a row of documents is its block's number, that of a row of words the bucket's, counted down from -1.
    packed = T.StructType().add("key", T.LongType())
    exploded_type = T.StructType([*packed.fields]).add("block", T.LongType()).add("doc_ids", T.ArrayType(id_type)).add("blob", T.BinaryType())
    answer_type = T.StructType([*packed.fields]).add("blob", T.BinaryType())

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        texts: list[str] = []
        size = 0

        def block_of() -> pa.RecordBatch:
            rows = list(block_rows(texts, pattern, buckets))
            held = pa.ListArray.from_arrays(pa.array([0] + [len(texts)] * len(rows), pa.int32()), pa.concat_arrays(ids))
            keys = pa.array([block if k == DOCS else -1 - k for k, _ in rows], pa.int64())
            return pa.RecordBatch.from_arrays([keys, pa.array([block] * len(rows), pa.int64()), held, pa.array([b for _, b in rows], pa.binary())], exploded_type.names)

        for batch in batches:
            for start, end in pieces(batch.column(1)):
                piece = batch.column(1).slice(start, end - start).to_pylist()
                more = sum(len(t or "") for t in piece)
                if texts and size + more > BLOCK:
                    yield block_of()
                    block, size, ids, texts = block + 1, 0, [], []
                ids.append(batch.column(0).slice(start, end - start))
                texts += piece
                size += more
        if texts:
            yield block_of()
        release()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bucket, known = word_encoder(ranks_path, pattern), None, {}
        for batch in batches:
            batch = batch.filter(pc.less(batch.column("key"), 0))
            out = []
            for k, blob in zip(batch.column("key").to_pylist(), batch.column("blob")):
                if k != bucket:
                    bucket, known = k, {}
                ids = []
                numbers, lengths, words = unpack(blob.as_py())
                for word in split_at(words, lengths):
                    found = known.get(word)
                    if found is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        found = known[word] = encoder(word)
                    ids.append(found)
                out.append(pack(numbers, np.array([len(x) // 4 for x in ids]), np.frombuffer(b"".join(ids), "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], answer_type.names)
        release()

    def reassemble(rows: pa.Table, answers: pa.Table) -> pa.Table:
        docs_of_block = rows.filter(pc.greater_equal(rows.column("key"), 0))  # one row, or none for a bucket's words
        coded, decoded, start = [], [], 0
        table, sizes = token_bytes(ranks_path)
        for blob in docs_of_block.column("blob"):
            counts, flat = unpack(blob.as_py())
            words = int(flat.max()) + 1 if len(flat) else 0
            spelled, said = [b""] * words, [b""] * words  # by word number
            for answer in answers.column("blob"):
                numbers, lengths, ids = unpack(answer.as_py())
                ends = np.r_[0, np.cumsum(sizes[ids])][np.cumsum(lengths, dtype=np.int64)]  # of each word's bytes
                parts = split_at(ids.astype("<u4").tobytes(), lengths.astype(np.int64) * 4)
                heard = split_at(b"".join(map(table.__getitem__, ids.tolist())), np.diff(ends, prepend=0))
                for number, part, bytes_ in zip(np.cumsum(numbers, dtype=np.int64).tolist(), parts, heard):
                    spelled[number], said[number] = part, bytes_
            for end in np.cumsum(counts, dtype=np.int64).tolist():
                run = flat[start:end].tolist()
                coded.append(b"".join(map(spelled.__getitem__, run)))
                decoded.append(b"".join(map(said.__getitem__, run)))
                start = end
            del spelled, said, flat
            release()
        return pa.table(
            {
                id_col: docs_of_block.column("doc_ids").combine_chunks().flatten(),
                "ids": pa.array(coded, pa.binary()),
                "decoded": pa.array(decoded, pa.binary()),
            }
        )

    blocks = slim.mapInArrow(explode, exploded_type).repartition("key")
    answers = blocks.sortWithinPartitions("key").mapInArrow(encode, answer_type)
    result = T.StructType().add(id_col, id_type).add("ids", T.BinaryType()).add("decoded", T.BinaryType())
    return blocks.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(reassemble, result)


def encoding_digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_col,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
