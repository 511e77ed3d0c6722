"""The blocks of token files are coded by the range coder and its model."""

import zlib

import numpy as np
import pytest

from tripstats.llm import range_coder, token_files


def frame_codes(frame):
    """The code bytes of each block of a frame."""
    _, _, length, n_docs, _, n_blocks, _ = token_files.HEAD.unpack_from(frame)
    body = frame[token_files.HEAD.size :]
    assert len(body) == length
    at = 12 * n_docs
    n_words = np.frombuffer(body, "<u4", n_blocks, at)
    at += 8 * n_blocks
    ends = at + 2 * np.cumsum(n_words, dtype=np.int64)
    return [body[end - 2 * n : end] for end, n in zip(ends.tolist(), n_words.tolist())]


def test_blocks_of_a_frame_are_range_coded_and_read_alone():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 10_000) % 50_000).astype(np.uint32)
    frame = token_files.frame_bytes(np.array([1, 2]), np.array([4000, 6000]), ids)
    codes = frame_codes(frame)
    size = range_coder.BLOCK_IDS
    blocks = [ids[at : at + size] for at in range(0, len(ids), size)]
    assert len(codes) == len(blocks) == 3
    for code, block in zip(codes, blocks):
        lengths = np.array([len(block)])
        assert (range_coder.decode([np.frombuffer(code, "<u2")], lengths)[0] == block).all()
        (words,) = range_coder.encode(block[None, :], lengths)
        assert words.astype("<u2").tobytes() == code
    # Deflated byte planes took more.
    planes = [block.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes() for block in blocks]
    assert sum(map(len, codes)) < sum(len(zlib.compress(plane, 6)) for plane in planes)


def test_ids_of_all_kinds_come_back_in_any_company():
    rng = np.random.default_rng(7)
    kinds = [
        np.zeros(4096),
        np.arange(4096),
        np.full(4095, 65_535),
        rng.integers(0, 65_536, 4000),
        np.repeat(rng.integers(0, 65_536, 63), 63),
        np.tile(rng.integers(0, 300, 700), 5),
        rng.geometric(0.02, 3000),
        [0, 65_535, 0],
        [7],
        [],
    ] + [rng.zipf(1.2, n) % 65_536 for n in (0, 0, 0)]
    lengths = np.array([len(kind) for kind in kinds])
    blocks = np.zeros((len(kinds), 4096), dtype=np.uint32)
    for block, kind in zip(blocks, kinds):
        block[: len(kind)] = kind
    words = range_coder.encode(blocks, lengths)
    assert (range_coder.decode(words, lengths) == blocks).all()
    for block, n, code in zip(blocks, lengths, words):
        (alone,) = range_coder.encode(block[None, :n], np.array([n]))
        assert alone.tolist() == code.tolist()
        assert (range_coder.decode([code], np.array([n]))[0] == block[:n]).all()
    # Ids of one kind or in a round take next to nothing.
    assert 2 * len(words[0]) < 200 and 2 * len(words[5]) < 3500


def test_carries_reach_numbers_already_written():
    rng = np.random.default_rng(11)
    blocks = np.minimum(rng.geometric(0.4, (400, 600)) - 1, 3).astype(np.uint32)
    lengths = np.full(400, 600)
    for most_ids in (4, 1 << 24):
        words = range_coder.encode(blocks, lengths, most_ids)
        assert (range_coder.decode(words, lengths, most_ids) == blocks).all()


def test_blocks_of_other_lengths():
    rng = np.random.default_rng(5)
    most = (1 << 16) - 1
    for most_ids in (1 << 16, 1 << 24):
        block = (rng.zipf(1.3, (1, most)) % most_ids).astype(np.uint32)
        words = range_coder.encode(block, np.array([most]), most_ids)
        assert (range_coder.decode(words, np.array([most]), most_ids) == block).all()
    with pytest.raises(ValueError, match="at most"):
        range_coder.encode(np.zeros((1, most + 1), dtype=np.uint32), np.array([most + 1]))
