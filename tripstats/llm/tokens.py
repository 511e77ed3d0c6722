"""Token ids of whole texts.

A tokenizer works on pre-tokens, which never reach across certain places of a text.  Texts are cut
at such places, each distinct cut is encoded once by the tokenizers library, and the ids
are put together again: the same ids as of the whole text, for a fraction of the work.
"""

import functools
import os
from array import array
from enum import Enum

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer

from tripstats.llm.common import ragged

# Distinct words that a task remembers; beyond, it starts anew.
MOST_WORDS = 2_000_000
# Text cut at a time: the more, the fewer words are met again.
TEXT_BYTES = 2 << 20
# Words given to the tokenizer at a time; its answers are far larger than the ids.
ENCODE_WORDS = 2_000

_CUT = "\x00"
_SPACES = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}"
# Texts in which a cut could fall into a pre-token: white space before a space, the cut mark
# itself, and what may be a special token.
_WHOLE = rf"[{_SPACES}] |\x{{0}}|<\|"
_BEFORE_MARKS = r"(\p{L})([.,!#*%&$|])"


class Cut(Enum):
    """Where a tokenizer's pre-tokens end."""

    SPACE_LEADS = "a space belongs to the word behind it"
    SPACE_DROPPED = "white space only separates words"


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str, cut: Cut) -> "TextEncoder":
    """The encoder of this process: a Python worker keeps the words it knows from task to
    task."""
    return TextEncoder(path, cut)


class TextEncoder:
    """Ids by the tokenizer file at ``path``, as ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, cut: Cut):
        # A task has one core; threads of its own would only get in the way of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        self._forget()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (one more
        entry than texts).  Null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, _WHOLE)
        marked = pc.replace_substring_regex(texts, _BEFORE_MARKS, rf"\1{_CUT}\2")
        behind = _CUT + " " if self.cut is Cut.SPACE_LEADS else _CUT
        marked = pc.replace_substring(marked, " ", behind)
        parts = pc.split_pattern(marked, _CUT)
        if pc.any(whole).as_py():
            # Such a text is one part.
            single = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), texts)
            parts = pc.if_else(whole, single, parts)
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(parts).dictionary_encode()
        places = self._places(coded.dictionary.cast(pa.large_binary()).to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[places]
        ids = self.ids[ragged(self.starts[places], sizes)]
        of_parts = np.concatenate([[0], np.cumsum(sizes)])
        return ids, of_parts[np.concatenate([[0], np.cumsum(lengths)])]

    def _forget(self) -> None:
        # Known words by their digests, which take a tenth of the room of the words; in order of the first half.
        self.keys = self.checks = np.zeros(0, dtype=np.uint64)
        self.slots = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def _places(self, words: list[bytes]) -> np.ndarray:
        """For each of the distinct words its place among the known ones."""
        if len(self.keys) + len(words) > MOST_WORDS:
            self._forget()
        digests = b"".join([xxhash.xxh3_128_digest(word) for word in words])
        key, check = np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2).T
        places = np.full(len(words), -1, dtype=np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (self.checks[at] == check)
            places[known] = self.slots[at[known]]
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            first = len(self.sizes)
            places[unknown] = np.arange(first, first + len(unknown))
            sizes, flat = [], array("I")
            for at in range(0, len(unknown), ENCODE_WORDS):
                part = [words[i].decode() for i in unknown[at : at + ENCODE_WORDS]]
                for encoding in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                    ids = encoding.ids
                    sizes.append(len(ids))
                    flat.extend(ids)
            sizes = np.array(sizes, dtype=np.int32)
            flat = np.frombuffer(flat, dtype=np.uint32)
            starts = len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, starts])
            self.sizes = np.concatenate([self.sizes, sizes])
            # The known keys stay in order; only the new ones are sorted.
            new = unknown[np.argsort(key[unknown], kind="stable")]
            at = np.searchsorted(self.keys, key[new])
            self.keys = np.insert(self.keys, at, key[new])
            self.checks = np.insert(self.checks, at, check[new])
            self.slots = np.insert(self.slots, at, places[new])
        return places
