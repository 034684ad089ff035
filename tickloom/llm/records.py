"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard is a run of records without a header. A record is

    length   8 bytes  little-endian unsigned: bytes of the payload
    check    4 bytes  masked CRC-32 of the 8 length bytes
    payload           the ids as little-endian unsigned integers, 2 bytes each if the vocabulary allows it, else 4
    check    4 bytes  masked CRC-32 of the payload

``masked`` is ((crc rotated right by 15 bits) + 0xA282EAD8) mod 2**32, so that a record which itself holds records keeps distinct
checksums. The index is a Parquet table beside the shards: one row for each record with its shard, offset, size and place.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, durable, scratch_path, shared_store, store

#: Appended to each document.
END_ID = 1
#: Distinct white-space-delimited pieces whose ids a worker remembers.
CACHED = 200_000
_SIGNS = ".,;:!?*#$%&|"
INDEX = "shard int, place long, doc_id long, offset long, bytes long, n_tokens long, width int"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked_crc(head)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the record at ``at``, and where the next one begins. ValueError if a checksum is wrong or bytes are missing."""
    head = data[at : at + 8]
    if len(head) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked_crc(head):
        raise ValueError(f"broken length at byte {at}")
    n = struct.unpack("<Q", head)[0]
    payload = data[at + 12 : at + 12 + n]
    if len(payload) < n or struct.unpack_from("<I", data, at + 12 + n)[0] != masked_crc(payload):
        raise ValueError(f"broken payload at byte {at}")
    return payload, at + 16 + n


class _Pieces(dict[str, bytes]):
    """Remembered pieces: one that is missing is encoded as it is looked up, so that a text with new pieces takes one pass too."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = self.encode(piece)
        return found


class PieceEncoder:
    """Encodes a text with a ``tokenizers`` file to the bytes of its ids.

    Where the tokenizer drops white space and never joins across it, each piece between white space is encoded once and remembered. Of
    most pieces the letters are one token of the pre-tokenizer, which the file's model encodes alone, and the signs after them another;
    other pieces, and texts for other tokenizers, are encoded whole.
    """

    def __init__(self, path: str, by_piece: bool, kind: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer, self.by_piece, self.kind = Tokenizer.from_file(path), by_piece, kind
        self.model, self.letters = self.tokenizer.model, byte_letters()
        ids = np.arange(max(self.tokenizer.get_vocab().values()) + 1).astype(kind)
        self.id_bytes = [i.tobytes() for i in ids]
        self.pieces = _Pieces(self.piece)
        self.words: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        return b"".join([self.id_bytes[i] for i in ids])

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        word = piece.rstrip(_SIGNS)
        if not (word.isalpha() and (word.isascii() or (max(word) < "\u0180" and "\u0130" not in word))):
            return self.whole(piece)
        low = word.lower()
        if (ids := self.words.get(low)) is None:
            mapped = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
            ids = self.words[low] = b"".join([self.id_bytes[t.id] for t in self.model.tokenize(mapped)])
        return ids + self.known(piece[len(word) :]) if len(word) < len(piece) else ids

    def known(self, signs: str) -> bytes:
        if (ids := self.pieces.get(signs)) is None:
            ids = self.pieces[signs] = self.whole(signs)
        return ids

    def __call__(self, text: str) -> bytes:
        if not self.by_piece:
            return self.whole(text)
        if "\n" in text or "\t" in text:
            text = text.replace("\n", " ").replace("\t", " ")
        if len(self.pieces) > CACHED:
            self.pieces.clear()
        if len(self.words) > CACHED:
            self.words.clear()
        return b"".join(map(self.pieces.__getitem__, text.split(" ")))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable in Latin-1, else from U+0100 on in order."""
    out, more = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out


#: Encoders of this worker process, so that the next task finds what the last one has remembered.
_ENCODERS: dict[tuple[str, bool, str], PieceEncoder] = {}


def encoder(path: str, by_piece: bool, kind: str) -> PieceEncoder:
    key = (path, by_piece, kind)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(*key)
    return _ENCODERS[key]


def splits_at_spaces(path: str) -> bool:
    """Whether pieces between spaces, tabs and newlines can be encoded on their own: the tokenizer turns white space into single spaces,
    matches no white space as part of a token, lower-cases, takes letters in a row as one token, and has no added token that holds or strips any."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = all(not (t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\n")) for t in spec.get("added_tokens", []))
    norm, pre = json.dumps(spec.get("normalizer")), json.dumps(spec.get("pre_tokenizer"))
    lowers = '"Lowercase"' in norm and '"NFC"' in norm  # pieces are lower-cased here, and Latin letters are taken to be composed
    removed = '"Removed"' in pre and '"ByteLevel"' in pre and '"add_prefix_space": false' in pre
    return bool(added and lowers and removed and "[\\\\p{L}]+" in pre and spec["model"].get("end_of_word_suffix") and "\\\\s+" in norm)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) and writes them to ``folder`` in ascending doc_id order (null first, then text); returns the index.

    Shards follow the order too: all ids of a shard are at most those of the next. Null and empty texts have the end id alone; repeated
    rows are all written. An empty table gives an empty index. A shard is written under a name of its own and moved into place, so tasks
    that are tried again or run twice leave one whole file.
    """
    by_piece = splits_at_spaces(tokenizer)
    rows = docs.select(col(docs, "doc_id", "long").alias("doc_id"), F.coalesce(col(docs, "text", "string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").withColumn("shard", F.spark_partition_id())

    vocabulary = max(vocabulary_size(tokenizer), end_id + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    kind = f"<u{width}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, by_piece, kind)
        end = np.array([end_id], kind).tobytes()
        out = target = None
        at = place = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files, base = shared_store(folder)
                files.create_dir(base, recursive=True)
                shard = batch.column("shard")[0].as_py()
                target = shard_file(base, shard)
                temp = f"{target}.{uuid.uuid4().hex}"
                out = files.open_output_stream(temp)
            index = []
            for text in batch.column("text").to_pylist():
                payload = encode(text) + end
                record = frame(payload)
                out.write(record)
                index.append((shard, place, at, len(record), len(payload) // width, width))
                at += len(record)
                place += 1
            cols = dict(zip(("shard", "place", "offset", "bytes", "n_tokens", "width"), zip(*index, strict=True), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["shard"], pa.int32()), pa.array(cols["place"], pa.int64()), batch.column("doc_id"), *(pa.array(cols[c], pa.int64()) for c in ("offset", "bytes", "n_tokens")), pa.array(cols["width"], pa.int32())],
                ["shard", "place", "doc_id", "offset", "bytes", "n_tokens", "width"],
            )
        if out is not None:
            out.close()
            files.move(temp, target)

    index = ordered.select("shard", "doc_id", "text").mapInArrow(write, INDEX)
    return store(index, f"{folder}/index")


def shard_file(base: str, shard: int) -> str:
    return f"{base}/shard-{shard:06d}.rec"


def payloads(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The ids of each row of an index, read at its offset and checked."""
    files, base = shared_store(folder)
    name = f = None
    try:
        for batch in batches:
            ids = []
            for shard, offset, size, width in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "bytes", "width")), strict=True):
                if shard != name:
                    if f is not None:
                        f.close()
                    name, f = shard, files.open_input_file(shard_file(base, shard))
                f.seek(offset)
                ids.append(np.frombuffer(unframe(f.read(size))[0], "<u2" if width == 2 else "<u4"))
            yield batch, ids
    finally:
        if f is not None:
            f.close()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, ids)`` for the rows of ``index``, in any order and from any subset, as a shuffled read wants it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in payloads(batches, folder):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return index.mapInArrow(read, "doc_id long, ids array<int>")


def record_digests(index: DataFrame, folder: str) -> DataFrame:
    """``(shard, place, doc_id, offset, n_tokens, ids_crc32)`` from the files: the CRC-32 of each document's ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in payloads(batches, folder):
            kept = ["shard", "place", "doc_id", "offset"]
            found = [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], [*kept, "n_tokens", "ids_crc32"])

    return index.mapInArrow(digest, "shard int, place long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before. Within a shard by a window over its rows, across shards by one over their totals."""
    base = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_sum"))
    base = base.select(F.col("shard").alias("_shard"), (F.sum("_sum").over(W.orderBy("shard")) - F.col("_sum")).alias("_base"))
    within = F.sum("n_tokens").over(W.partitionBy("shard").orderBy("place")) - F.col("n_tokens")
    return rows.withColumn("_within", within).join(base, F.col("shard") == F.col("_shard")).withColumn("start", F.col("_base") + F.col("_within")).drop("_shard", "_base", "_within")


def encode_table(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as records below ``folder`` (default: a new one in the shared scratch folder) and returns what is read back from
    them: ``doc_id, start, n_tokens, ids_crc32, shard, offset``."""
    folder = folder or scratch_path(docs.sparkSession, "records")
    index = write_records(docs, folder, tokenizer)
    back = durable(record_digests(index, folder), "digests")
    return with_starts(back).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")
