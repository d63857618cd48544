"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import scratch_dir

#: Bytes of a text that a Python worker turns into words at a time.
CHUNK_BYTES = 1 << 20

_BLANKS = b" \t\n\x0b\x0c\r"
#: A-Z to a-z; every byte outside 0-9, a-z and 0x80-0xFF to a space.
LOWER_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def byte_chunks(data: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut only before white space, so that no word is split."""
    n, start = len(data), 0
    while start < n:
        stop = start + size
        if stop < n:
            stop = min((p for p in (data.find(b, stop) for b in (b" ", b"\n")) if p >= 0), default=n)
        else:
            stop = n
        yield data[start:stop]
        start = stop


def blank_words(text: str | None) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8, a list for each chunk (null: none)."""
    for part in byte_chunks(encoded(text)):
        yield part.split()


def alnum_words(text: str | None) -> Iterator[list[bytes]]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased, a list for each chunk."""
    for part in byte_chunks(encoded(text)):
        yield part.translate(LOWER_ALNUM).split()


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def held_out(doc_id: str | Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id is not held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_share(col: Column, seed: int) -> Column:
    """A repeatable draw in [0, 1) for each value of ``col``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), col), 11) / F.lit(float(1 << 53))
