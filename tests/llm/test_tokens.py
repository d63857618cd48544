import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from kiln.llm import tokens
from kiln.llm.registered import QUERIES
from tests.llm.conftest import SF, bag


@pytest.fixture(scope="module")
def whole():
    return tokens.encoder().whole


def brute(rows, whole):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        raw = np.array(ids, "<u4").tobytes()
        out.append((doc, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def test_encoder_equals_whole_texts(whole, monkeypatch):
    rng = random.Random(2)
    bits = ["a", "Word", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "'s", "'", "123", "été", "\U0001f600", "<|endoftext|>", ".", ",\n", "́", "\r\n",
            "'ll", "'re", "'ve", "\0", "½", "²", "日本", "Ǆ", "​", "5"]
    texts = [None, "", " ", "  a", " a b ", "a"] + ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(4000)]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [list(x) for x in tokens.Encoder().encode(texts)] == want
    monkeypatch.setattr(tokens, "_SLICE_CHARS", 7)
    monkeypatch.setattr(tokens, "CACHE_TOKENS", 3)
    assert [list(x) for x in tokens.Encoder().encode(texts)] == want


def test_added_tokens_as_the_library_alone(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))  # nothing set on it
    assert fresh.encode("doc <|endoftext|> next", add_special_tokens=False).ids == [15390, 220, 50256, 1306]
    rng = random.Random(5)
    bits = ["<|endoftext|>", " <|endoftext|>", "<|endoftext|> ", "<|endof", "text|>", "a", "Word", " ", "  ", "\n", "'s", "été", " next words"]
    texts = ["doc <|endoftext|> next", "<|endoftext|>", " <|endoftext|> <|endoftext|><|endoftext|> "]
    texts += ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(1000)]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(x) for x in tokens.Encoder().encode(texts)] == want
    rows = [(k, t) for k, t in enumerate(texts[:100])]
    got = tokens.tokenize(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(map(tuple, got)) == bag(brute(rows, fresh))
    monkeypatch.setattr(tokens, "_SLICE_CHARS", 7)  # very long texts
    assert [list(x) for x in tokens.Encoder().encode(texts)] == want


def test_query_equals_brute_force(spark, whole):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert bag(map(tuple, QUERIES["op5_tokens"](spark, SF).collect())) == bag(brute(docs, whole))


def test_odd_rows(spark, odd, none, whole):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = tokens.tokenize(spark, odd).collect()
    want = brute(rows, whole)
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == bag((d, n, c) for d, _, n, c in want)
    place = 0
    for r in sorted(got, key=lambda r: r.start):  # no gap, no overlap, ids ascending
        assert r.start == place
        place += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert tokens.tokenize(spark, none).collect() == []


def _shard(docs):
    out = io.BytesIO()
    w = tokens.ShardWriter(out)
    for d, ids in docs:
        w.add(d, np.array(ids, "<u4"))
    w.close()
    return out.getvalue()


def test_reader_takes_only_the_frames_asked_for(monkeypatch):
    monkeypatch.setattr(tokens, "FRAME_IDS", 4)
    docs = [(5, [1, 2, 3]), (None, list(range(11))), (9, [7])]
    raw = _shard(docs)
    plain = b"".join(np.array(i, "<u4").tobytes() for _, i in docs)
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == plain  # any zstandard tool
    reader = tokens.ShardReader(pa.BufferReader(raw))
    assert [np.frombuffer(reader.ids(k), "<u4").tolist() for k in (2, 0, 1)] == [[7], [1, 2, 3], list(range(11))]
    damaged = bytearray(raw)
    damaged[int(reader.place[1]) + 8] ^= 1  # in the second document
    reader = tokens.ShardReader(pa.BufferReader(bytes(damaged)))
    assert np.frombuffer(reader.ids(2), "<u4").tolist() == [7]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.ids(1)


def test_many_shards(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS doc_id", "concat('text number ', id) AS text").repartition(5)
    folder = f"file://{tmp_path}"
    manifest = tokens.write_shards(df, folder, shard_ids=100)
    assert manifest.count() > 8
    got = sorted(map(tuple, tokens.read_shards(manifest, folder).collect()))
    assert got == brute([(i, f"text number {i}") for i in range(500)], tokens.encoder().whole)
