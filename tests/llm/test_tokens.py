"""Token ids, packing and token files: exact round trips and invariants."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from tripstats.llm import packing, range_coder, token_files
from tripstats.llm.queries import QUERIES
from tripstats.llm.tokens import Cut, TextEncoder

FOLDER = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
FILES = [(BYTES, Cut.SPACE_LEADS), (WORDS, Cut.SPACE_DROPPED)]
ODD = [
    None, "", " ", "  a", "a  b", "a \n b", "it's. don't, we'll", "<|endoftext|> x <|startoftext|>",
    "Ünï çödé, ẞ ﬁ Σίσυφος é .́", "x y   z\x1c w", "a\x00b", "tab\tb \t c", "!!x ##y%%", "日本 語。",
    "a," * 50, "\n\n", "end ", "1,234.5", "A.B,c!d", "’s ʼn",
]


def plain(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path, cut", FILES)
def test_ids_of_odd_texts(path, cut):
    ids, starts = TextEncoder(path, cut).encode(pa.array(ODD))
    for text, a, b in zip(ODD, starts, starts[1:]):
        assert ids[a:b].tolist() == plain(path).encode(text or "", add_special_tokens=False).ids, text


ENCODERS = [(plain(path), TextEncoder(path, cut)) for path, cut in FILES]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z.,'!#é\n\t  ́<|1$"), max_size=30), max_size=6))
def test_ids_of_any_text(texts):
    for tokenizer, encoder in ENCODERS:
        ids, starts = encoder.encode(pa.array(texts, pa.string()))
        for text, a, b in zip(texts, starts, starts[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# --- packing ---------------------------------------------------------------------------


def documents(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.selectExpr("*", "1 AS length", "2 AS part", "'x' AS offset")


def expected(texts, path, end_id):
    return [plain(path).encode(t or "", add_special_tokens=False).ids + [end_id] for t in texts]


def test_packed_sequences_hold_every_document_once(spark):
    texts = [None, "", "a", "b c", "word " * 120, "x " * 700, "y " * 49, "b c"] + ["tie tie"] * 40
    packed = packing.pack(documents(spark, texts).repartition(3), WORDS, capacity=64, keep_ids=True)
    rows = packed.collect()
    whole = expected(texts, WORDS, 1)
    for doc_id, ids in enumerate(whole):
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 64)))
        assert sum((r.ids for r in own), []) == ids
        assert [r.start for r in own] == list(range(0, len(ids), 64))
        assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in own)
    for row in packing.sequences(packed).collect():
        inside = sorted((r for r in rows if r.sequence_id == row.sequence_id), key=lambda r: r.offset)
        assert row.ids == sum((r.ids for r in inside), []) and len(row.ids) <= 64
        assert [r.offset for r in inside] == [sum(x.length for x in inside[:i]) for i in range(len(inside))]
    assert len({r.sequence_id for r in rows}) == -(-sum(map(len, whole)) // 64)


def test_no_documents_to_pack(spark):
    assert packing.pack(documents(spark, ["a"]).where("false"), WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=12))
def test_plan_uses_all_pieces(counts):
    fills = packing.plan(counts, 60)
    used = {}
    for fill, times in fills:
        assert sum(length * n for length, n in fill.items()) <= 60 and times > 0
        for length, n in fill.items():
            used[length] = used.get(length, 0) + n * times
    assert used == counts
    slots = packing.Slots(fills, 60)
    places = set()
    for length, n in counts.items():
        sequence, offset = slots.of(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = {(s, o + i) for i in range(length)}
            assert not cells & places and o + length <= 60
            places |= cells


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=6))
def test_a_fill_leaves_least_slack(left):
    order = sorted(left, reverse=True)
    fill = packing.best_fill(left, order, 50)
    sums = {order[0]}
    for length, n in left.items():
        n -= length == order[0]
        sums |= {s + length * k for s in sums for k in range(n + 1)}
    assert sum(length * n for length, n in fill.items()) == max(s for s in sums if s <= 50)
    assert all(n <= left[length] for length, n in fill.items())


# --- range coder and files ---------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_blocks_round_trip(data):
    top = data.draw(st.sampled_from([2, 40, 65536]))
    lengths = sorted(data.draw(st.lists(st.integers(0, 90), min_size=1, max_size=5)), reverse=True)
    rng = np.random.default_rng(data.draw(st.integers(0, 1000)))
    blocks = np.zeros((len(lengths), max(lengths)), dtype=np.uint32)
    for row, n in zip(blocks, lengths):
        row[:n] = rng.integers(0, top, n)
    lengths = np.array(lengths)
    assert (range_coder.decode(range_coder.encode(blocks, lengths), lengths) == blocks).all()


def test_repeats_cost_little():
    ids = np.tile(np.random.default_rng(0).integers(0, 50_000, 50), 80)[None, :]
    (words,) = range_coder.encode(ids, np.array([4000]))
    assert 2 * len(words) < 4000 / 4


def test_files_round_trip(spark, tmp_path):
    texts = ODD + ["long text " * 20_000, "a", "a"]
    df = documents(spark, texts).selectExpr("IF(doc_id = 21, 22, doc_id) AS doc_id", "text", "1 AS start")
    df = df.union(df.selectExpr("CAST(NULL AS long)", "'no id'", "1"))
    path = str(tmp_path / "ids")
    token_files.write_files(df, path, BYTES, files=3)
    rows = token_files.read_files(spark, path, with_ids=True).orderBy("start").collect()
    whole = expected(texts, BYTES, 0)
    assert [r.ids for r in rows] == whole
    assert [r.doc_id for r in rows] == [22 if i == 21 else i for i in range(len(texts))]
    assert [r.start for r in rows] == [sum(map(len, whole[:i])) for i in range(len(whole))]
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in rows)


def test_damaged_and_empty_files(spark, tmp_path):
    path = tmp_path / "ids"
    token_files.write_files(documents(spark, ["some words to code"]), str(path), BYTES, files=1)
    (file,) = [p for p in path.glob("part-*") if p.stat().st_size]
    content = bytearray(file.read_bytes())
    content[-4] ^= 1
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0").write_bytes(content)
    with pytest.raises(PySparkException, match="damaged"):
        token_files.read_files(spark, str(tmp_path / "bad")).collect()
    empty = str(tmp_path / "empty")
    token_files.write_files(documents(spark, ["a"]).where("false"), empty, BYTES)
    assert token_files.read_files(spark, empty).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_queries_equal_plain_tokenizing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    start, files = 0, []
    for doc, ids in zip(docs, expected([d.text for d in docs], BYTES, 0)):
        files.append((doc.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    got = QUERIES["op5_token_files"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == files
    pieces = []
    for doc, ids in zip(docs, expected([d.text for d in docs], WORDS, 1)):
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            pieces.append((doc.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4"))))
    packed = QUERIES["op6_packing"](spark, FOLDER)
    got = packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == pieces
    tokens = sum(p[3] for p in pieces)
    assert packed.select("sequence_id").distinct().count() <= -(-tokens // 4096) + 1


@pytest.mark.parametrize("most_ids, top", [(1 << 16, 65_535), (70_001, 70_000), (1 << 24, 200_000), (1 << 24, (1 << 24) - 1)])
def test_large_ids_come_back(most_ids, top):
    rng = np.random.default_rng(1)
    lengths = np.array([700, 700, 33, 1])
    blocks = rng.integers(0, top + 1, (4, 700), dtype=np.int64).astype(np.uint32)
    blocks[:, ::3] = rng.integers(0, 5, (4, 234))
    blocks[:, 5] = blocks[3, 0] = top
    words = range_coder.encode(blocks, lengths, most_ids)
    back = range_coder.decode(words, lengths, most_ids)
    for block, n, own in zip(back, lengths, blocks):
        assert block[:n].tolist() == own[:n].tolist()


def test_ids_beyond_the_vocabulary_are_refused():
    for ids in ([70_000, 5], [65_536]):
        with pytest.raises(ValueError, match="do not fit"):
            range_coder.encode(np.array([ids], dtype=np.uint32), np.array([len(ids)]))
    with pytest.raises(ValueError, match="vocabulary"):
        range_coder.encode(np.zeros((1, 1), dtype=np.uint32), np.array([1]), (1 << 24) + 1)


def test_frames_keep_large_ids():
    ids = np.array([70_000, 5, 199_999, 0] * 3000, dtype=np.uint32)
    frame = token_files.frame_bytes(np.array([3, 4]), np.array([11_000, 1000]), ids, 200_000)
    (found,) = token_files.read_frames(frame + b"\n")
    assert found[0].tolist() == [3, 4] and found[1].tolist() == [11_000, 1000] and (found[2] == ids).all()


def test_a_very_long_text_and_the_number_of_files(spark, tmp_path, monkeypatch):
    long = " ".join(f"w{i % 977}" for i in range(300_000))
    texts = [long, None, "short", long[:1000]] + ["x y z"] * 20
    monkeypatch.setattr(token_files, "FILE_TEXT_BYTES", len(long) // 8)
    path = str(tmp_path / "files")
    token_files.write_files(documents(spark, texts), path, BYTES)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert 1 < len(parts) <= 9
    rows = token_files.read_files(spark, path).orderBy("doc_id").collect()
    start = 0
    for row, ids in zip(rows, expected(texts, BYTES, 0)):
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    assert len(rows) == len(texts)
