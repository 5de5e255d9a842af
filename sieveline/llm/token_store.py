"""Token ids in a chunked binary store of compressed bit planes.

Documents are put in order of their ids over range partitions, the shards.  Each
shard's ids run on from document to document, cut into chunks of a fixed number of
ids.  A chunk is turned into planes: plane ``b`` holds bit (or byte) ``b`` of all
its ids in turn, and each plane is compressed with zstandard.  The chunk index says
for every chunk where its ids start, how many there are, how long each plane is,
which documents end in it, and how much of the first of them lies in chunks before.

Reading back takes every chunk where it is stored.  What is moved are the checksums of
the documents' parts, which are then joined by arithmetic; planes and ids stay.

Defined results.  A null or empty text has the end id alone.  Rows come in order of
``doc_id`` (null first), text and repetition; rows with the same id are written one
by one.  Other columns are ignored and may have any name.  An empty table gives a
store without chunks.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import work_dir
from .words import raw_texts, release

#: Contract: the id that ends a document.
END_ID = 2
#: Ids of a chunk, and zstandard's level.
CHUNK_IDS, LEVEL = 1 << 17, 3
#: Encoded words a worker remembers, and bytes of text it looks up together.
MEMORY, GROUP = 600_000, 1 << 19

CHUNKS = (
    "shard int, chunk long, first long, n_ids long, plane_bits int, plane_bytes array<int>, planes binary, "
    "open_ids long, doc_ids array<bigint>, doc_tokens array<bigint>"
)
_CHUNKS = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("plane_bits", pa.int32()), ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.binary()),
    ("open_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
])
#: A row for every chunk: the documents that end in it, where the first of them starts, and the
#: checksums of their parts in the chunk, of which the first has ``n_first`` ids; the last is of the open end.
PARTS = "shard int, chunk long, at long, n_first long, doc_ids array<bigint>, doc_tokens array<bigint>, crcs array<bigint>"
_PARTS = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int64()), ("at", pa.int64()), ("n_first", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("crcs", pa.list_(pa.int64())),
])


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, highest bit the constant term."""
    product = 0
    while a:
        if a & 1 << 31:
            product ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product


#: x to the power of 8, 16, 32, ..: what one, two, four, .. further bytes multiply a checksum by.
_FURTHER = [1 << 23]
while len(_FURTHER) < 48:
    _FURTHER.append(_times(_FURTHER[-1], _FURTHER[-1]))


def joined_crc32(first: int, second: int, n_bytes: int) -> int:
    """The CRC-32 of two byte strings in turn from those of each; the second has ``n_bytes``."""
    for bit, power in enumerate(_FURTHER[:n_bytes.bit_length()] if first else ()):
        if n_bytes >> bit & 1:
            first = _times(power, first)
    return first ^ second


def _turned(column: np.ndarray) -> np.ndarray:
    """Bytes in groups of eight, each a square of bits, with rows and columns exchanged."""
    x = column.view("<u8")
    for by, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        t = (x ^ (x >> np.uint64(by))) & np.uint64(mask)
        x = x ^ t ^ (t << np.uint64(by))
    return x.view(np.uint8).reshape(-1, 8)


def pack(ids: np.ndarray, plane_bits: int = 1) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids, lowest first; planes above the
    largest id are left out."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    planes = []
    for byte in range(-(-top // 8)):
        column = np.ascontiguousarray(raw[:, byte])
        if plane_bits == 8:
            planes.append(compress(column.tobytes()))
            continue
        for bit in range(min(8, top - 8 * byte)):
            planes.append(compress(np.packbits(column >> bit & 1, bitorder="little").tobytes()))
    return planes


def unpack(planes: list[bytes], n_ids: int, plane_bits: int = 1) -> np.ndarray:
    decompress = zstandard.ZstdDecompressor().decompress
    read = [np.frombuffer(decompress(plane), dtype=np.uint8) for plane in planes]
    raw = np.zeros((n_ids, 4), dtype=np.uint8)
    if plane_bits == 8:
        for byte, data in enumerate(read):
            raw[:, byte] = data
    else:
        for byte in range(-(-len(read) // 8)):
            turned = np.zeros((-(-n_ids // 8), 8), dtype=np.uint8)
            for bit, data in enumerate(read[8 * byte:8 * byte + 8]):
                turned[:, bit] = data
            raw[:, byte] = _turned(turned.reshape(-1)).reshape(-1)[:n_ids]
    return raw.reshape(-1).view("<u4")


class WordEncoder:
    """Ids of whole texts from a tokenizer that treats blank-separated words apart.

    The vocabulary's own splitting never joins characters across ASCII blanks and
    drops the blanks, so a text's ids are its words' ids in turn.  New words are
    encoded together, as one text, and remembered; the offsets of its tokens tell
    which word they are of.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Words of Latin letters alone go straight to the vocabulary's merges, for
        which nothing is left to be split or normalised; all others through the whole
        tokenizer."""
        others, merge, known = [], self.tokenizer.model.tokenize, self.known
        for word in words:
            text = word.decode()
            if _LETTERS.fullmatch(text):
                text = text.lower()
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
                ids = [token.id for token in merge(text)]
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(word)
        if others:
            self._learn_together(others)

    def _learn_together(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        first = np.fromiter((a for a, _ in encoding.offsets), dtype=np.int64, count=len(encoding.ids))
        cuts = np.searchsorted(first, ends).tolist()
        ids = np.array(encoding.ids, dtype="<u4").tobytes()
        at = 0
        for word, cut in zip(words, cuts):
            self.known[word] = ids[4 * at:4 * cut]
            at = cut

    def encode(self, raws: list[bytes]) -> Iterator[np.ndarray]:
        known = self.known
        for group in _groups(raws):
            if len(known) > MEMORY:
                known.clear()
            texts = [plain_words(raw) for raw in group]
            words = list(chain.from_iterable(texts))
            found = list(map(known.get, words))
            if None in found:
                missing = [i for i, ids in enumerate(found) if ids is None]
                self._learn(list(dict.fromkeys(words[i] for i in missing)))
                for i in missing:
                    found[i] = known[words[i]]
            at = 0
            for own in texts:
                yield np.frombuffer(b"".join(found[at:at + len(own)]), dtype="<u4")
                at += len(own)


#: Letters that are one code point each and of which the lower case is another such.
_LETTERS = re.compile("[a-z]+|[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: How byte-level vocabularies write bytes that are no printable Latin-1 characters:
#: by the characters from U+0100 on, in order.
_BYTE_CHARACTERS = {b: 0x100 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_STOP = re.compile(rb"[.,](?<=[A-Za-z][.,])(?=[\x20\x09-\x0D]|\Z)")  # the stop comes first, as few characters are one


def plain_words(raw: bytes) -> list[bytes]:
    """Words that give the same ids, but fewer different ones: case does not matter
    to the vocabulary in ASCII words, save in its special tokens, and a full stop or
    comma between an ASCII letter and a blank is a token of its own.

    The vocabulary composes letters with their marks before it lowers them, and some
    letters compose in lower case alone, so words with other characters stay as they
    are."""
    words = _STOP.sub(rb" \g<0>", raw)
    if b"<|" in raw:
        return words.split()
    if raw.isascii():
        return words.lower().split()
    return [word.lower() if word.isascii() else word for word in words.split()]


def _groups(raws: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of about GROUP bytes."""
    group, size = [], 0
    for raw in raws:
        group.append(raw)
        size += len(raw)
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per worker process: what it remembers serves all its tasks."""
    return WordEncoder(path)


def write_store(
    docs: DataFrame, path: str, tokenizer: str, chunk_ids: int = CHUNK_IDS, plane_bits: int = 1, end_id: int = END_ID
) -> None:
    """Write the store: rows of chunks, a file or more per shard."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def chunks(batches):
        encoder = _encoder(tokenizer)
        shard = _partition()
        held, n_held, ended, chunk, first = [], 0, [], 0, 0
        behind = 0  # ids of the documents that ended in earlier chunks

        def flush(ids):
            planes = pack(ids, plane_bits)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "chunk": chunk, "first": first, "n_ids": len(ids), "plane_bits": plane_bits,
                "plane_bytes": [len(p) for p in planes], "planes": b"".join(planes),
                "open_ids": first - behind, "doc_ids": [d for d, _ in ended], "doc_tokens": [n for _, n in ended],
            }], schema=_CHUNKS)

        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(raw_texts(batch.column(1)))):
                n_tokens = len(ids) + 1
                held += [ids, end]
                n_held += n_tokens
                while n_held >= chunk_ids:
                    run = np.concatenate(held)
                    done = n_held == chunk_ids  # the document ends with this very chunk
                    if done:
                        ended.append((doc_id, n_tokens))
                    yield flush(run[:chunk_ids])
                    held, n_held = [run[chunk_ids:]], n_held - chunk_ids
                    behind += sum(n for _, n in ended)
                    ended, chunk, first = [], chunk + 1, first + chunk_ids
                    if done:
                        break
                else:
                    ended.append((doc_id, n_tokens))
        if n_held:
            yield flush(np.concatenate(held))
        release()

    ordered.mapInArrow(chunks, CHUNKS).write.parquet(path)


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in a store.

    Every chunk is unpacked alone and gives the checksums of the parts of documents in
    it; these come together by shard, in order, and only the checksum of a document's
    open end is carried from one chunk to the next.
    """
    stored = spark.read.schema(CHUNKS).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per shard
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def parts(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                cuts = np.cumsum([0, *row["plane_bytes"]])
                planes = [row["planes"][a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                ids = unpack(planes, row["n_ids"], row["plane_bits"])
                ends = np.cumsum(row["doc_tokens"], dtype=np.int64) - row["open_ids"]
                crcs = [zlib.crc32(part.tobytes()) for part in np.split(ids, ends)]
                yield pa.RecordBatch.from_pylist([{
                    "shard": row["shard"], "chunk": row["chunk"], "at": row["first"] - row["open_ids"],
                    "doc_ids": row["doc_ids"], "doc_tokens": row["doc_tokens"], "crcs": crcs,
                    "n_first": int(ends[0]) if len(ends) else row["n_ids"],
                }], schema=_PARTS)
        release()

    def documents(batches):
        shard, crc = None, 0
        for batch in batches:
            out = {"shard": [], "doc_id": [], "at": [], "n_tokens": [], "ids_crc32": []}
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, crc = row["shard"], 0
                crcs, at = row["crcs"], row["at"]
                crcs[0] = joined_crc32(crc, crcs[0], 4 * row["n_first"])
                for doc_id, n_tokens, own in zip(row["doc_ids"], row["doc_tokens"], crcs):
                    out["shard"].append(shard)
                    out["doc_id"].append(doc_id)
                    out["at"].append(at)
                    out["n_tokens"].append(n_tokens)
                    out["ids_crc32"].append(own)
                    at += n_tokens
                crc = crcs[-1]
            yield pa.RecordBatch.from_pydict(out, schema=layout)

    layout = pa.schema([(n, pa.int32() if n == "shard" else pa.int64()) for n in (
        "shard", "doc_id", "at", "n_tokens", "ids_crc32")])
    rows = stored.mapInArrow(parts, PARTS).repartition("shard").sortWithinPartitions("shard", "chunk")
    read = rows.mapInArrow(documents, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def store_and_read(docs: DataFrame, tokenizer: str, chunk_ids: int = CHUNK_IDS, plane_bits: int = 1) -> DataFrame:
    """Write ``docs`` to a new store in the shared folder and read it back."""
    path = work_dir(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer, chunk_ids, plane_bits)
    return read_store(docs.sparkSession, path)
