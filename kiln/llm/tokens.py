"""Token ids in seekable zstandard files.

A shard is a run of documents in ascending ``doc_id`` order. Each document is
a zstandard frame of its own (one of more than ``FRAME_IDS`` ids: several),
holding its ids as little-endian unsigned 32-bit integers and zstandard's own
content checksum. After the frames come two skippable frames: the document
index, and at the very end the seek table of the public zstandard seekable
format, with each frame's compressed and decompressed size and a checksum (low
32 bits of XXH64) of what it holds. So any zstandard tool can decompress a
shard, and a reader that wants some documents reads the tail of the file and
then those frames only.

``write_shards``: documents are range-partitioned by id and sorted; each task
encodes and writes its shards under names made from its partition, moved into
place when whole, so a task that runs again replaces its own files. The
manifest has a row for each shard; the shards' first positions are running
sums of it (rows: files, not documents). ``read_shards`` reads them back, a
task for each shard.

Order: null ids come first; rows of one id are ordered by a hash of the text,
rows alike in both by their place in the input, so that a row repeated any
number of times spreads over tasks. Null and empty texts hold the end id
alone; very long ones are encoded in slices cut at spaces. An empty table
gives no shards and no rows. Repeated rows are encoded each. Only ``doc_id``
and ``text`` are read; columns of other names do not matter.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import saved
from kiln.llm.files import open_file, write_whole
from kiln.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
LEVEL = 1
FRAME_IDS = 1 << 20
SHARD_IDS = 1 << 26
CACHE_TOKENS = 250_000
_SLICE_CHARS = 2_000_000

_BYTE_LEVEL = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
# What the pre-tokenizer's rules tell apart.
_LETTER, _NUMBER, _OTHER, _SPACE, _BLANK, _EDGE, _UNKNOWN = range(7)
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the byte-level pre-tokenizer's public pattern

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A5D
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_DOC = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("first", "<u4"), ("frames", "<u4"), ("n", "<u8")])
_SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])


# ---------------------------------------------------------------- encoding
class Encoder:
    """Ids of whole texts, by the tokenizers library.

    The places where the library's byte-level pre-tokenizer cuts are found for a
    slice of texts at once, from the kind of each character (letter, number,
    other, space, other blank), which the library is asked for when a character is first met.
    Each distinct pre-token's ids come from the library's model and are kept.

    The library finds added tokens (``<|endoftext|>``) before it pre-tokenizes,
    so a text that holds one goes to it whole; a very long one is split around
    them first, or goes whole too if a token's own rules look at its neighbours.
    Any other kind of tokenizer gets whole texts.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        added = self.whole.get_added_tokens_decoder().values()
        self._added = sorted((t.content for t in added), key=len, reverse=True)  # the library takes the longest
        self._between = None
        if not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            self._between = re.compile("(" + "|".join(map(re.escape, self._added)) + ")") if self._added else None
        self._cut = self.whole.pre_tokenizer.pre_tokenize_str
        self._merge = self.whole.model.tokenize
        self._plain = self.whole.normalizer is None and repr(self.whole.pre_tokenizer) == _BYTE_LEVEL
        self._kind = np.full(0x110000, _UNKNOWN, np.uint8)
        self._written: dict[int, str] = {}  # how the library writes each character
        self._kept: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _meet(self, code: int) -> None:
        """Learn a character's kind: it joins an ``a``, a ``1`` or a ``!`` before it, or none of them if it is blank."""
        char = chr(code)
        joins = (k for k, c in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")) if len(self._cut(c + char)) == 1)
        self._kind[code] = _SPACE if char == " " else next(joins, _BLANK)
        self._written[code] = self._cut(char)[0][0]

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        kinds = self._kind[codes]
        if (new := kinds == _UNKNOWN).any():
            for code in np.unique(codes[new]).tolist():
                self._meet(code)
            kinds = self._kind[codes]
        return kinds

    def _known(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens. Two generations of ``CACHE_TOKENS`` are kept: what isn't met during a whole generation is forgotten."""
        out = list(map(self._kept.get, tokens))
        before, merge, written = self._before, self._merge, self._written
        new = {}
        for k, ids in enumerate(out):
            if ids is None:
                token = tokens[k]
                ids = before.get(token)
                if ids is None:
                    got = [t.id for t in merge(token.translate(written))]
                    ids = struct.pack(f"<{len(got)}I", *got)
                out[k] = ids
                if len(token) < 64:
                    new[token] = ids
        if len(self._kept) + len(new) > CACHE_TOKENS:
            self._before, self._kept = self._kept, {}
        self._kept |= new
        return out

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        group, chars = [], 0
        for t in texts:
            t = t or ""
            if len(t) > _SLICE_CHARS:
                yield from self._slice(group)
                group, chars = [], 0
                yield self._long(t)
                continue
            group.append(t)
            chars += len(t)
            if chars > _SLICE_CHARS:
                yield from self._slice(group)
                group, chars = [], 0
        yield from self._slice(group)

    def _holds_added(self, text: str) -> bool:
        return any(a in text for a in self._added)

    def _all(self, text: str) -> np.ndarray:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4")

    def _long(self, text: str) -> np.ndarray:
        """Ids of a very long text, by parts."""
        if not self._holds_added(text):
            runs = [text]
        elif self._between is None:
            return self._all(text)
        else:
            runs = [r for r in self._between.split(text) if r]
        return np.concatenate([ids for r in runs for part in ([r] if r in self._added else _long_parts(r))
                               for ids in self._slice([part])])

    def _slice(self, texts: list[str]) -> Iterator[np.ndarray]:
        odd = [not self._plain or self._holds_added(t) for t in texts]
        joined = "\0" + "\0".join("" if o else t for t, o in zip(texts, odd)) + "\0"
        data = joined.encode()
        ascii_only = len(data) == len(joined)
        codes = np.frombuffer(data, np.uint8) if ascii_only else np.frombuffer(joined.encode("utf-32-le"), "<u4")
        lengths = np.fromiter((0 if o else len(t) for t, o in zip(texts, odd)), np.int64, len(texts))
        edges = np.r_[0, np.cumsum(lengths + 1)]
        kinds = self._kinds(codes)
        kinds[edges] = _EDGE
        starts = np.flatnonzero(_token_starts(codes, kinds))
        at = np.searchsorted(starts, edges)  # every edge is a pre-token of its own
        places = starts
        if not ascii_only:
            width = 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)
            places = (np.cumsum(width, dtype=np.int64) - width)[starts]
        offsets = np.r_[places, len(data)].astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        tokens = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        own = self._known(tokens)
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        ids, first = np.frombuffer(b"".join(own), "<u4"), np.cumsum(sizes) - sizes
        codes = np.asarray(coded.indices)
        n = sizes[codes]
        n[at] = 0
        upto = np.r_[0, np.cumsum(n)]
        all_ids = ids[np.repeat(first[codes] - upto[:-1], n) + np.arange(upto[-1])]
        for k, text in enumerate(texts):
            yield self._all(text) if odd[k] else all_ids[upto[at[k]]:upto[at[k + 1]]]


def _token_starts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer's pre-tokens begin: runs of one kind, with one space before them; of several
    blanks the last stands apart, unless the text ends there; contractions stand alone after a letter, number, blank or edge."""
    before = np.r_[np.uint8(_EDGE), kinds[:-1]]
    after = np.r_[kinds[1:], np.uint8(_EDGE)]
    blank = (kinds == _SPACE) | (kinds == _BLANK)
    after_blank = (before == _SPACE) | (before == _BLANK)
    starts = np.where(blank, ~after_blank | (after <= _OTHER), (kinds != before) & (before != _SPACE)) | (kinds == _EDGE)
    marks = np.flatnonzero((codes == ord("'")) & (before != _OTHER) & (before != _SPACE))
    for c in _CONTRACTIONS:
        at = marks[marks + len(c) < len(codes)]
        for k, char in enumerate(c):
            at = at[codes[at + k] == ord(char)]
        starts[at + 1] = False
        starts[at + len(c)] = True
    return starts


def _long_parts(text: str) -> Iterator[str]:
    """A very long text in pieces cut before spaces that have no white space beside them."""
    at = 0
    while len(text) - at > _SLICE_CHARS:
        cut = text.find(" ", at + _SLICE_CHARS)
        while cut > 0 and (cut + 1 >= len(text) or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """This worker's encoder, kept between tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


# ---------------------------------------------------------------- file format
class ShardWriter:
    """Frames as they come; index and seek table at the end."""

    def __init__(self, out, level: int = LEVEL):
        self.out, self.docs, self.seek, self.n_ids = out, [], [], 0
        self._zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = len(self.seek)
        for at in range(0, max(1, len(ids)), FRAME_IDS):
            plain = ids[at:at + FRAME_IDS].astype("<u4", copy=False).tobytes()
            packed = self._zstd.compress(plain)
            self.out.write(packed)
            self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.docs.append((doc_id or 0, doc_id is None, first, len(self.seek) - first, len(ids)))
        self.n_ids += len(ids)

    def close(self) -> None:
        index = np.array(self.docs, _DOC).tobytes() + struct.pack("<I", len(self.docs))
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = np.array(self.seek, _SEEK).tobytes() + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class ShardReader:
    """Documents of a shard, by place; reads the tail and the frames asked for, and checks their checksums."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - 9 - n * _SEEK.itemsize
        self.seek = np.frombuffer(self._read(table, n * _SEEK.itemsize), _SEEK)
        head, length = struct.unpack("<II", self._read(table - 8, 8))
        if head != SKIPPABLE_SEEK_TABLE or length != size - table:
            raise ValueError("damaged seek table")
        (count,) = struct.unpack("<I", self._read(table - 12, 4))
        self.docs = np.frombuffer(self._read(table - 12 - count * _DOC.itemsize, count * _DOC.itemsize), _DOC)
        self.place = np.r_[0, np.cumsum(self.seek["packed"].astype(np.int64))]
        self._zstd = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, doc: int) -> bytes:
        """The ids of the document at place ``doc``, as written."""
        first, last = int(self.docs[doc]["first"]), int(self.docs[doc]["first"] + self.docs[doc]["frames"])
        raw = self._read(int(self.place[first]), int(self.place[last] - self.place[first]))
        out = []
        for f in range(first, last):
            at = int(self.place[f] - self.place[first])
            plain = self._zstd.decompress(raw[at:at + int(self.seek[f]["packed"])])
            if len(plain) != self.seek[f]["plain"] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.seek[f]["checksum"]:
                raise ValueError(f"frame {f} doesn't match its checksum")
            out.append(plain)
        return b"".join(out)


# ---------------------------------------------------------------- Spark jobs
_MANIFEST = "shard string, partition int, seq int, n_docs long, n_ids long, bytes long"


def write_shards(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``doc_id, text`` into shards under ``folder``; returns the manifest with each shard's first position, ``start``."""
    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy"))
    dealt = dealt.repartitionByRange("doc_id", "tie", "copy")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), f"{task.taskAttemptId()}"
        rows = _encoded(batches, encoder(vocabulary), end_id)
        row, seq = next(rows, None), 0
        while row is not None:
            name, stats = f"part-{part:06d}-{seq:04d}.zst", []

            def fill(out):
                nonlocal row
                shard = ShardWriter(out)
                while row is not None and (not shard.docs or shard.n_ids < shard_ids):
                    shard.add(*row)
                    row = next(rows, None)
                shard.close()
                stats.extend((len(shard.docs), shard.n_ids))

            size = write_whole(folder, name, attempt, fill)
            yield pa.RecordBatch.from_pylist([{"shard": name, "partition": part, "seq": seq, "n_docs": stats[0],
                                               "n_ids": stats[1], "bytes": size}], schema=_manifest_schema())
            seq += 1

    manifest = saved(dealt.sortWithinPartitions("doc_id", "tie").mapInArrow(write, _MANIFEST), "token-manifest")
    run = Window.orderBy("partition", "seq")  # one row for each file
    return manifest.withColumn("start", F.sum("n_ids").over(run) - F.col("n_ids"))


def _manifest_schema() -> pa.Schema:
    return pa.schema([("shard", pa.string()), ("partition", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                      ("n_ids", pa.int64()), ("bytes", pa.int64())])


def _encoded(batches: Iterator[pa.RecordBatch], enc: Encoder, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    end = np.array([end_id], "<u4")
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                yield doc_id, np.concatenate([ids, end])


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shards of the manifest."""
    files = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist()):
                with open_file(folder, name) as file:
                    shard = ShardReader(file)
                    n = shard.docs["n"].astype(np.int64)
                    starts = start + np.cumsum(n) - n
                    crc = np.fromiter((zlib.crc32(shard.ids(k)) for k in range(len(n))), np.int64, len(n))
                    null = shard.docs["is_null"].astype(bool)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.docs["doc_id"].astype(np.int64), mask=null), pa.array(starts), pa.array(n), pa.array(crc)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("shard", "start").repartition(max(1, files)).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(spark: SparkSession, docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as shards into a new folder under the shared one and read them back."""
    folder = scratch_dir(spark, "tokens")
    return read_shards(saved(write_shards(docs, folder, vocabulary, end_id), "token-starts"), folder)
