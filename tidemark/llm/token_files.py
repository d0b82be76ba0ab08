"""Token ids in binary blocks whose document boundaries are Elias-Fano encoded.

A file holds blocks of whole documents: one array of ids (16 bits each when the vocabulary allows,
else 32), the ends of the documents in that array, and the ids of the documents. Both lists
ascend, so both are Elias-Fano sequences: the low bits of every value packed side by side, the
high bits as gaps in a unary bit string, and the place of every ``SAMPLE``-th one bit as 32-bit
numbers, from which ``select`` finds any value. There is no table of 64-bit offsets.

Blocks are rows of a Parquet file, written and committed by Spark on any file system; a lost
executor costs the blocks of its running tasks. A block ends at ``BLOCK_TOKENS``; only a longer
document makes a larger one, alone.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import threading
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import arrow_batches_of, give_back, partitions_for, text_rows

BLOCK_TOKENS = 1 << 19
SAMPLE = 256
# Input bytes for each range of document ids, one task each.
RANGE_BYTES = 32 << 20
# Bytes that one of the two generations of remembered pieces may take in a worker, about what an entry
# takes besides its text, and the characters beyond which a piece is not remembered.
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 180
LONG_PIECE = 256
# How a byte-level vocabulary writes a space, and how many new pieces are encoded as one text.
SPACE = "\u0120"
TOGETHER = 64
# Seconds after a task until an idle worker forgets its encoder: other stages have use for the memory.
IDLE_SECONDS = 5
# Rows that a worker is handed at a time, and bytes of text encoded at once.
ROWS_IN = 512
GROUP_BYTES = 4 << 20

_HEAD = "<QQBQQ"

BLOCK_SCHEMA = (
    "part int, seq int, n_docs long, null_docs long, n_tokens long, id_bits int, "
    "ids binary, ends binary, first_doc long, docs binary"
)


class EliasFano:
    """An ascending sequence of unsigned 64-bit values in about 2 + log2(u / n) bits each."""

    def __init__(self, data: bytes):
        self.n, self.most, self.low_bits, low, high = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        self._low = np.frombuffer(data, np.uint8, low, at)
        self._high = np.frombuffer(data, np.uint8, high, at + low)
        self._samples = np.frombuffer(data, "<u4", offset=at + low + high)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        bits = max(0, (most // n).bit_length() - 1) if n else 0
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(
            ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"
        )
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little")
        head = struct.pack(_HEAD, n, most, bits, len(low), len(high))
        samples = ones[::SAMPLE].astype("<u4")
        return head + low.tobytes() + high.tobytes() + samples.tobytes()

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        start, stop = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self._low[start // 8 : -(-stop // 8)], bitorder="little")
        bits = bits[start % 8 : start % 8 + count * self.low_bits].reshape(count, -1)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The ``i``-th value, from the sample before it and the bits up to the next one."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        k = i // SAMPLE
        start = int(self._samples[k])
        stop = int(self._samples[k + 1]) if k + 1 < len(self._samples) else len(self._high) * 8
        bits = np.unpackbits(self._high[start // 8 : -(-stop // 8)], bitorder="little")
        one = np.flatnonzero(bits[start % 8 :])[i % SAMPLE] + start
        return (int(one) - i) << self.low_bits | int(self._lows(i, 1)[0])

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._lows(0, self.n)


class Encoder:
    """Ids of whole texts, with a memory for the pieces between single spaces.

    A byte-level pre-tokenizer starts a new token at a space between two other characters, and
    looks at nothing before it; so a text may be cut there without changing its ids. A piece that
    touches further white space is not cut off.

    The memory has two generations of ``cache_bytes`` each: a full one becomes the old one, from
    which pieces that are met again come back. Pieces of more than ``LONG_PIECE`` characters, such as
    whole texts of a script without spaces, are encoded anew each time.
    """

    _CUT = re.compile(r"(?<=\S) (?=\S)")
    _SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]

    def __init__(self, definition: str, dtype: str, cache_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._dtype, self._width = dtype, np.dtype(dtype).itemsize
        self._code = next(code for code in "HIL" if array(code).itemsize == self._width)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held, self._most = 0, CACHE_BYTES if cache_bytes is None else cache_bytes

    def _wide(self, text: str) -> bool:
        """Whether a space is at an end of the text or touches further white space."""
        if text[0] == " " or text[-1] == " ":
            return True
        # searches for single characters are much faster than an expression for all of them
        found = [c for c in self._SPACES if c in text]
        return any(" " + c in text or c + " " in text for c in found)

    def _pieces(self, text: str) -> tuple[str, str | list[str] | None]:
        """The first piece, marked by a space it has not, and the others without the space before them.

        These are still one string where every space in it is a cut.
        """
        if self._wide(text):
            first, *rest = self._CUT.split(text)
        else:
            first, _, rest = text.partition(" ")
        return " " + first, rest or None

    def _alone(self, pieces: list[str]) -> list[bytes]:
        texts = [p[1:] if p[0] == " " else " " + p for p in pieces]
        # the fast form leaves out the places of the tokens in the text, which nobody asks for
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self._packed(e.ids) for e in found]

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _encode(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of each piece; pieces without a space are encoded ``TOGETHER``, for the calls' sake.

        The only tokens that begin with a space are then the first ones of each piece. Where they are
        not as many as the pieces, these are encoded one by one.
        """
        apart, plain = [], []
        for p in pieces:
            (apart if " " in p else plain).append(p)
        out = dict(zip(apart, self._alone(apart)))
        groups = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        texts = [" " + " ".join(group) for group in groups]
        for group, found in zip(groups, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            packed = self._packed(found.ids)
            firsts = np.flatnonzero(self._spaced[np.frombuffer(packed, self._dtype)])
            if len(firsts) == len(group):
                ends = [*(firsts * self._width).tolist(), len(packed)]
                out.update((p, packed[i:j]) for p, i, j in zip(group, ends, ends[1:]))
            else:
                out.update(zip(group, self._alone(group)))
        return out

    def _learn(self, pieces: set[str]) -> None:
        unknown = pieces.difference(self._old)
        self._young.update((p, self._old[p]) for p in pieces - unknown)
        self._young.update(self._encode(unknown))
        # some four bytes for a character, as text and as ids
        self._held += ENTRY_BYTES * len(pieces) + 4 * sum(map(len, pieces))

    def _found(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces, from the memory where they are in it."""
        found = list(map(self._young.get, pieces))
        missing = [p for p, ids in zip(pieces, found) if ids is None and len(p) <= LONG_PIECE]
        if missing and self._held > self._most:
            # the full generation is put away, and then all pieces are asked of it
            self._old, self._young, self._held = self._young, {}, 0
            missing = [p for p in pieces if len(p) <= LONG_PIECE]
        if missing:
            self._learn(set(missing))
            found = list(map(self._young.get, pieces))
        long = [p for p, ids in zip(pieces, found) if ids is None]
        if long:
            alone = self._encode(long)
            found = [alone[p] if ids is None else ids for p, ids in zip(pieces, found)]
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Arrow splits them, finds their different pieces and lays out the ids."""
        split = [self._pieces(t) if t else None for t in texts]
        firsts = [s[0] if s else None for s in split]
        plain = [s[1] if s and isinstance(s[1], str) else None for s in split]
        wide = [s[1] if s and isinstance(s[1], list) else None for s in split]
        text = pa.large_string()
        columns = [
            pa.array([[f] if f else None for f in firsts], pa.list_(text)),
            pc.split_pattern(pa.array(plain, text), " "),
            pa.array(wide, pa.list_(text)),
        ]
        pieces = pa.concat_arrays([c.flatten() for c in columns]).dictionary_encode()
        known = self._found(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(pieces.indices)
        data, places = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int64)
        parts, before = [], 0
        for column in columns:
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0))]) + before
            bounds, before = places[ends].tolist(), int(ends[-1])
            parts.append([data[i:j] for i, j in zip(bounds, bounds[1:])])
        return [b"".join(p) for p in zip(*parts)]


def _block(part: int, seq: int, docs: list, ids: list[bytes], dtype: str) -> dict:
    width = np.dtype(dtype).itemsize
    known = np.array([d for d in docs if d is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // width for x in ids])
    return {
        "part": part,
        "seq": seq,
        "n_docs": len(docs),
        "null_docs": len(docs) - len(known),
        "n_tokens": int(ends[-1]),
        "id_bits": 8 * width,
        "ids": b"".join(ids),
        "ends": EliasFano.encode(ends),
        "first_doc": first,
        "docs": EliasFano.encode(known.view(np.uint64) - np.int64(first).astype(np.uint64)),
    }


def _encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(document, ids) of all rows; up to ``GROUP_BYTES`` of text are encoded at once."""
    docs, texts, held = [], [], 0
    for batch in batches:
        for doc, text in text_rows(batch, "doc", "text"):
            docs.append(doc)
            texts.append(text.decode())
            held += len(text)
            if held > GROUP_BYTES:
                yield from zip(docs, encoder.ids(texts))
                docs, texts, held = [], [], 0
    yield from zip(docs, encoder.ids(texts))


def _writer(definition, dtype: str, end_id: int, arrow: pa.Schema, cache_bytes: int | None = None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one encoder for all tasks that a worker runs without a longer pause
        encoders = sys.__dict__.setdefault("_tidemark_encoders", {})
        if waiting := encoders.pop("waiting", None):
            waiting.cancel()
        key = (zlib.crc32(definition.value.encode()), dtype, cache_bytes)
        encoder, part, seq = encoders.get(key), TaskContext.get().partitionId(), 0
        if encoder is None:
            encoders.clear()
            give_back()
            encoder = encoders[key] = Encoder(definition.value, dtype, cache_bytes)
        end = np.array([end_id], dtype).tobytes()
        docs, ids, held, most = [], [], 0, BLOCK_TOKENS * len(end)

        def flush():
            return pa.RecordBatch.from_pylist([_block(part, seq, docs, ids, dtype)], arrow)

        for doc, encoded in _encoded(encoder, batches):
            encoded += end
            if docs and held + len(encoded) > most:
                yield flush()
                docs, ids, held, seq = [], [], 0, seq + 1
            docs.append(doc)
            ids.append(encoded)
            held += len(encoded)
        if docs:
            yield flush()

        def forget():
            encoders.clear()
            give_back()

        encoders["waiting"] = waiting = threading.Timer(IDLE_SECONDS, forget)
        waiting.daemon = True
        waiting.start()

    return write


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in BLOCK_SCHEMA.split(", "))])


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_bytes: int | None = None,
) -> None:
    """Encode every whole text and write the blocks in ascending order of the document ids.

    A larger memory of pieces (``cache_bytes`` for each of two generations in a worker) saves time only.

    Null texts are empty documents: only ``end_id``. Null ids come first; rows with equal ids are
    ordered by their texts. Extra columns are ignored; an empty table makes a file without blocks.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    vocabulary = Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)
    dtype = "<u2" if max(vocabulary - 1, end_id) < 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    memory = {} if cache_bytes is None else {"cache_bytes": cache_bytes}
    blocks = (
        rows.repartitionByRange(partitions_for(docs, RANGE_BYTES), "doc")
        .sortWithinPartitions("doc", "text")
        .mapInArrow(_writer(shared, dtype, end_id, _arrow_schema(), **memory), BLOCK_SCHEMA)
    )
    # a batch is held by Spark and by the worker, beside the worker's memory of pieces
    with arrow_batches_of(spark, ROWS_IN):
        blocks.write.option("parquet.block.size", 16 << 20).parquet(path)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, block_start): tokens of all blocks before each, from the counts alone.

    Parts are added up first, so that only one row for each of them is ordered in one task.
    """
    heads = spark.read.schema(BLOCK_SCHEMA).parquet(path).select("part", "seq", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        heads.groupBy("part")
        .agg(F.sum("n_tokens").alias("t"))
        .select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("part_start"))
    )
    local = F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))
    return (
        heads.withColumn("local", local)
        .join(parts, "part")
        .select("part", "seq", (F.col("part_start") + F.col("local")).alias("block_start"))
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = np.frombuffer(row["ids"], f"<u{row['id_bits'] // 8}").astype("<u4")
            ends = EliasFano(row["ends"]).values().astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            docs = EliasFano(row["docs"]).values() + np.int64(row["first_doc"]).astype(np.uint64)
            known = docs.view(np.int64).tolist()
            n, data = row["n_docs"], memoryview(ids).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array([row["seq"]] * n, pa.int32()),
                    pa.array([None] * row["null_docs"] + known, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
            )


def read_token_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    found = blocks.select(
        "part", "seq", "n_docs", "null_docs", "id_bits", "ids", "ends", "first_doc", "docs"
    ).mapInArrow(
        _documents,
        "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long",
    )
    return found.join(block_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("block_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_token_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of each document, its boundaries found by ``select``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], f"<u{row['id_bits'] // 8}")
                ends, docs = EliasFano(row["ends"]), EliasFano(row["docs"])
                for d in range(row["n_docs"]):
                    k = d - row["null_docs"]
                    doc = None if k < 0 else docs.select(k) + row["first_doc"]
                    start = ends.select(d - 1) if d else 0
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc], pa.int64()),
                            pa.array([ids[start : ends.select(d)].tolist()], pa.list_(pa.int64())),
                        ],
                        names=[id_col, "ids"],
                    )

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    return blocks.mapInArrow(unpack, f"{id_col} long, ids array<long>")
