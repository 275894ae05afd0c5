"""Byte-level BPE over a whole corpus: distinct pre-tokens are encoded once.

* Documents are cut into blocks of bounded size where they are read. A block splits its texts into pre-tokens and
  keeps, for each document, the positions' numbers in the block's list of distinct words. So a word leaves a
  task once for each block, not once for each occurrence.
* All blocks' words are shuffled by word: to one of ``shards`` owners, by a hash. A row packs the words of one
  block for one owner. Owners encode every distinct word once and hand its ids to all blocks that hold it; a
  word as common as may be comes once from each block.
* Ids return to their block, where each document is put together by position.
* Decoding looks ids up in the table of token bytes, which is as large as the vocabulary and no larger.

A block's name is a digest of its content. Were a lost task rerun in another order, words and positions would
not meet and the job would stop instead of mixing them up.

Defined results: null counts as empty; an empty text has no ids and decodes to no bytes. Special tokens have no
meaning here. Rows repeat as they came; an empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import small_batches

#: Characters of a block; one longer text is a block of its own.
BLOCK_CHARS = 16_000_000
#: Words an owner remembers at once (about 250 bytes each), and the most owners (their number fits two bytes).
MEMORY_WORDS, MAX_SHARDS = 300_000, 65_535
#: Ids of a batch that leaves the assembly; one longer document is a batch of its own.
BATCH_IDS = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _press(*parts: np.ndarray | bytes) -> bytes:
    """Byte strings one after the other, with their lengths before them, compressed."""
    raw = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    return zstandard.ZstdCompressor(level=6).compress(b"".join([np.array([len(r) for r in raw], np.int64).tobytes(), *raw]))


def _unpress(pressed: bytes, n: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(pressed)
    ends = 8 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int64, n))])
    return [raw[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _press_words(words: list[bytes]) -> bytes:
    return _press(np.array([len(w) for w in words], np.uint32), b"".join(words))


def _unpress_words(pressed: bytes) -> list[bytes]:
    lengths, flat = _unpress(pressed, 2)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.uint32), dtype=np.int64)]).tolist()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _ids_to_bytes(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", ids.type)])) as out:
        out.write_batch(pa.record_batch([ids], names=["doc_id"]))
    return sink.getvalue().to_pybytes()


def _ids_from_bytes(raw: bytes) -> pa.ChunkedArray:
    with pa.ipc.open_stream(pa.py_buffer(raw)) as reader:
        return reader.read_all()["doc_id"]


class _Block:
    """Documents as numbers of their words; texts are not kept."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.doc_ids: list[int | None] = []
        self.codes: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str, split) -> None:
        words, numbers = split(text), self.numbers
        self.codes.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint32, len(words)))
        self.doc_ids.append(doc_id)
        self.chars += len(text)

    def packed(self, shards: int, id_type: pa.DataType) -> pa.RecordBatch:
        distinct = [w.encode("utf-8", "surrogatepass") for w in self.numbers]
        owner = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in distinct), np.uint16, len(distinct))
        words = _press(owner, _press_words(distinct))
        # Equal bytes of the numbers lie side by side: the upper ones are nearly constant.
        planes = np.concatenate(self.codes).view(np.uint8).reshape(-1, 4).T
        docs = _press(_ids_to_bytes(pa.array(self.doc_ids, id_type)), np.array([len(c) for c in self.codes], np.uint32), planes, owner)
        block = hashlib.blake2b(words + docs, digest_size=12).digest()
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (block, words, docs)], ["block", "words", "docs"])


def _blocks(pattern: str, block_chars: int, shards: int):
    """Arrow batches to blocks: a row with its distinct words and with its documents' word numbers.

    A block runs over as many batches as it takes, so its size does not depend on theirs.
    """
    split = regex.compile(pattern).findall

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, id_type = _Block(), pa.int64()
        for batch in batches:
            id_type = batch["doc_id"].type
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if block.codes and block.chars + len(text or "") > block_chars:
                    yield block.packed(shards, id_type)
                    block = _Block()
                block.add(doc_id, text or "", split)
        if block.codes:
            yield block.packed(shards, id_type)

    return cut


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's words as one packed row for each owner, in the order of their numbers."""
    for batch in batches:
        for block, pressed in zip(batch["block"].to_pylist(), batch["words"].to_pylist()):
            owner, words = _unpress(pressed, 2)
            owner, words = np.frombuffer(owner, np.uint16), _unpress_words(words)
            order = np.argsort(owner, kind="stable")
            shards, first = np.unique(owner[order], return_index=True)
            parts = [_press_words([words[i] for i in part]) for part in np.split(order, first[1:])] if len(shards) else []
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([block] * len(shards), pa.binary()), pa.array(parts, pa.binary())],
                                             ["shard", "block", "words"])


class _Encoded(dict):
    """Word to its ids, encoded when it first comes; emptied should an owner ever hold too many words."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        # The pattern takes a word whole: it has been split before.
        self.encode = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        ids = self[word] = self.encode(word.decode())
        return ids


def _encode_words(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _Encoded(shared.value)
        for batch in batches:
            out = []
            for pressed in batch["words"].to_pylist():
                ids = [encoded[w] for w in _unpress_words(pressed)]
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                out.append(_press(np.fromiter(map(len, ids), np.uint32, len(ids)), flat.view(np.uint8).reshape(-1, 4).T))
            yield pa.RecordBatch.from_arrays([batch["block"], batch["shard"], pa.array(out, pa.binary())], ["block", "shard", "ids"])

    return encode


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view(kind).ravel()


def _assemble(key: tuple, docs: pa.Table, words: pa.Table) -> pa.Table:
    """Ids of the block's documents, by position."""
    if not docs.num_rows:
        raise RuntimeError("words came back for a block that is gone")
    back = dict(zip(words["shard"].to_pylist(), words["ids"].to_pylist()))  # equal blocks send each part again
    out_ids, out_lists = [], []
    for pressed in docs["docs"].to_pylist():
        doc_ids, counts, planes, owner = _unpress(pressed, 4)
        owner, flats, at = np.frombuffer(owner, np.uint16), [np.empty(0, np.int32)], 0
        sizes, starts = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        for shard in np.unique(owner).tolist():
            if shard not in back:
                raise RuntimeError("a block's words are incomplete")
            n, flat = _unpress(back[shard], 2)
            n, mine = np.frombuffer(n, np.uint32).astype(np.int64), np.flatnonzero(owner == shard)
            sizes[mine], starts[mine] = n, at + np.cumsum(n) - n
            flats.append(_from_planes(flat, np.int32))
            at += len(flats[-1])
        flat, codes = np.concatenate(flats), _from_planes(planes, np.uint32)
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.uint32), dtype=np.int64)])
        out_ids += _ids_from_bytes(doc_ids).cast(pa.int64()).chunks
        lists, held = [], 0
        for i, j in zip(ends[:-1], ends[1:]):
            lists.append(_take(flat, starts, sizes, codes[i:j]))
            held += len(lists[-1])
            if held >= BATCH_IDS:
                out_lists.append(pa.array(lists, pa.list_(pa.int32())))
                lists, held = [], 0
        out_lists.append(pa.array(lists, pa.list_(pa.int32())))
    return pa.table([pa.chunked_array(out_ids, pa.int64()), pa.chunked_array(out_lists)], names=["doc_id", "ids"])


def _take(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenate the slices flat[starts[c]:starts[c] + sizes[c]] for the codes."""
    size = sizes[codes]
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return np.empty(0, np.int32)
    shift = np.repeat(starts[codes] - (ends - size), size)
    return flat[shift + np.arange(ends[-1])]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and ids of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)  # the vocabulary file
    shards = min(MAX_SHARDS, max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # The exchange by block is planned once and feeds both the words and the assembly.
    blocks = docs.select("doc_id", "text").mapInArrow(_blocks(pattern, block_chars, shards), "block binary, words binary, docs binary") \
        .repartition("block")
    words = blocks.mapInArrow(_spread, "shard int, block binary, words binary")
    ids = words.repartition("shard").mapInArrow(_encode_words(shared), "block binary, shard int, ids binary")
    return blocks.groupBy("block").cogroup(ids.groupBy("block")) \
        .applyInArrow(_assemble, "doc_id long, ids array<int>")


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes by id; ids without a token decode to nothing."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids and the bytes they stand for.

    Tokens are looked up in Spark, in an array as large as the vocabulary: a Python worker here would stand beside
    the assembly's in each task, and both stay for as long as the session uses Python.
    """
    tokens = F.split(F.lit(",".join(t.hex() for t in token_bytes(ranks))), ",")  # folded to a constant
    spelled = F.array_join(F.transform("ids", lambda i: F.get(tokens, i)), "")
    return encoded.select("doc_id", "ids", F.unhex(F.coalesce(spelled, F.lit(""))).alias("bytes"))


def with_digests(decoded: DataFrame) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and decoded bytes."""
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))
