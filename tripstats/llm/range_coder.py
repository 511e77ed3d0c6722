"""Adaptive context-mixing range coder for blocks of token ids.

Each block starts from an empty model.  Three predictions are mixed for an id: what followed the
last two ids the last time (order 2), what followed the last id (order 1), and the counts of the
block so far (order 0, every id possible).  The weights of the first two are learned in the
block, apart for each recent record of hits and for agreement of the two.  The mixed range
drives a range coder with 63-bit state, 32-bit steps of output and carries.

Blocks are independent, so many are coded at once, one array lane each.  What the model says of an
id rests on earlier ids alone, so the encoder has it for all ids at once; id after id go only
the range itself, and the decoder.
"""

from collections.abc import Iterator

import numpy as np

BLOCK_IDS = 4096
# Ids are below ``most_ids``, by default this; a larger vocabulary is named by the caller.
MOST_IDS = 1 << 16
# A table entry has so many bits for an id.
_ID_BITS = 24
_ID_MASK = np.uint32((1 << _ID_BITS) - 1)

# The range has 63 bits; one below _BOTTOM is widened by a step of output.
_STEP = 32
_BOTTOM = 1 << 31
_WHOLE = (1 << 63) - 1
# Weights of the predictions are parts of 2 ** 12; order 0 keeps at least _LEAST.
_PARTS = 12
_LEAST = 64
_MIXED = (1 << _PARTS) - _LEAST
_WEIGHT_BITS = 16
_WEIGHT_MASK = (1 << _WEIGHT_BITS) - 1
# Tables of order 1 and 2: slots, and multipliers of the last id and of the one before.
_SLOTS = np.array([[1 << 12], [1 << 13]])
_HASHES = np.array([[0x9E3779B1], [0x85EBCA6B]])
_HASH_BEFORE = 0xC2B2AE35
_HASH_SHIFT = 20
# Above the id, an entry of order 1 has three bits, and one of order 2 three more: whether it is used, and
# whether its last two predictions were right.
_RECORDS = 8
_RIGHT = np.array([[1], [_RECORDS]], dtype=np.uint32) << np.uint32(_ID_BITS)
_BEFORE = _RIGHT << np.uint32(1)
_USED = _RIGHT << np.uint32(2)
_USED_RIGHT = _USED | _RIGHT
# States: both records, and whether both orders say the same.
_AGREE = _RECORDS * _RECORDS
_STATES = 2 * _AGREE
# What is taken for the chance of a hit before any is seen, by the record, and how many trials it is worth.
_FIRST_CHANCES = np.array([2, 2, 2, 2, 32, 160, 120, 230]) / 256
_FIRST_TRIALS = 4
# Counts of order 0 against the one part that every id has: 2 ** 8 for each time the block held it.
_GAIN_BITS = 8
# An entry of the counts has 16 bits for a place, and the range has room for so many parts.
_MOST_LENGTH = (1 << 16) - 1
_FIRST_COUNTS = 32
# What is done for all ids of some lanes, or some steps of all lanes, is done for so many at a time.
_LANES, _ROWS = 16, 64


def encode(blocks: np.ndarray, lengths: np.ndarray, most_ids: int = MOST_IDS) -> list[np.ndarray]:
    """The code words (uint16) of each block.  ``blocks`` has a row a block, ``lengths`` its ids;
    lengths do not rise, so that the blocks still at work come first.  An id of ``most_ids``
    or more is refused, and so are more than 2 ** 24 ids and blocks of 2 ** 16 ids or more."""
    _check(most_ids)
    if len(lengths) and int(lengths[0]) > _MOST_LENGTH:
        raise ValueError(f"a block has at most {_MOST_LENGTH} ids, not {lengths[0]}")
    if blocks.size and (int(blocks.max()) >= most_ids or int(blocks.min()) < 0):
        raise ValueError(f"ids from {blocks.min()} to {blocks.max()} do not fit into {most_ids}")
    lanes, longest = len(lengths), int(lengths[0]) if len(lengths) else 0
    weight, start, freq = (np.empty((longest, lanes), dtype=np.int32) for _ in range(3))
    for at in range(0, lanes, _LANES):
        part = slice(at, at + _LANES)
        told = _ranges(blocks[part, :longest].astype(np.uint32), lengths[part], most_ids)
        for whole, of_part in zip((weight, start, freq), told):
            whole[:, part] = of_part.T
    low = np.zeros(lanes, dtype=np.int64)
    span = np.full(lanes, _WHOLE)
    # The rarest id takes 30 bits.  The first number of a lane stays 0.
    room = longest + 4
    out = np.zeros(lanes * room, dtype=np.int64)
    filled = np.arange(lanes) * room + 1
    for at, stop in _segments(longest):
        total = np.uint64((at << _GAIN_BITS) + most_ids)
        for first in range(at, stop, _ROWS):
            rows = slice(first, min(first + _ROWS, stop))
            weights, starts, freqs = (a[rows].astype(np.int64) for a in (weight, start, freq))
            for below, own, start_0, freq_0 in zip(weights & _WEIGHT_MASK, weights >> _WEIGHT_BITS, starts, freqs):
                part = span >> _PARTS
                low += part * below
                span = part * own
                unit = (span.view(np.uint64) // total).view(np.int64)
                low += unit * start_0
                span = np.where(freq_0 > 0, unit * freq_0, span)
                small = (span < _BOTTOM).nonzero()[0]
                settled, places = low.take(small), filled.take(small)
                out[places] = _number(settled)
                filled[small] = places + 1
                low[small] = settled << _STEP & _WHOLE
                span[small] = span.take(small) << _STEP
    # Whatever follows this number lies in the range that is left.
    out[filled] = _number(low + (_BOTTOM - 1))
    out = out.reshape(lanes, room)
    while (over := out >> _STEP).any():
        out &= (1 << _STEP) - 1
        out[:, :-1] += over[:, 1:]
    ends = filled - np.arange(lanes) * room + 1
    return [_words(numbers[1:end]) for numbers, end in zip(out, ends.tolist())]


def decode(words: list[np.ndarray], lengths: np.ndarray, most_ids: int = MOST_IDS) -> np.ndarray:
    """The blocks that ``encode`` was given, zero beyond their lengths."""
    _check(most_ids)
    lanes, longest = len(lengths), int(lengths[0]) if len(lengths) else 0
    room = max((len(w) for w in words), default=0) // 2 + 4
    source = np.zeros((lanes, room), dtype=np.int64)
    for numbers, content in zip(source, words):
        numbers[: len(content) // 2] = _numbers(content)
    # The range has one bit less than two numbers, so what comes next begins with the last bit of one.
    code = (source[:, 0] << (_STEP - 1)) | (source[:, 1] >> 1)
    source[:, :-1] = ((source[:, :-1] & 1) << (_STEP - 1)) | (source[:, 1:] >> 1)
    source = source.reshape(-1)
    taken = np.arange(lanes) * room + 1
    span = np.full(lanes, _WHOLE)
    ids = np.zeros((lanes, longest), dtype=np.uint32)
    table = np.zeros(lanes * int(_SLOTS.sum()), dtype=np.uint32)
    base = np.arange(lanes) * _SLOTS + np.array([[0], [lanes * _SLOTS[0, 0]]])
    slots = _SLOTS - 1
    of_state = np.arange(lanes) * _STATES
    of_agree = of_state + _AGREE
    used, used_right = np.repeat(_USED, lanes, axis=1), np.repeat(_USED_RIGHT, lanes, axis=1)
    told = np.zeros((3, lanes * _STATES), dtype=np.int64)
    last = before = np.zeros(lanes, dtype=np.int64)
    counts = _Counts(lanes, longest, most_ids)
    for at, stop in _segments(longest):
        n = np.count_nonzero(lengths > at)
        counts.update(ids[:n, :at])
        weight_2, weight_1 = _weights(told)
        weights = (weight_2 | (weight_2 + weight_1) << _WEIGHT_BITS).astype(np.int32)
        found = np.zeros((stop - at, n), dtype=np.uint32)
        outcomes = []
        for row in found:
            if lengths[n - 1] <= at:
                n = np.count_nonzero(lengths > at)
            if n < len(last):
                last, before, code, span, taken, base, of_state, of_agree, used, used_right = (
                    a[..., :n].copy()
                    for a in (last, before, code, span, taken, base, of_state, of_agree, used, used_right)
                )
            place = last * _HASHES
            place[1] += before
            before = last * _HASH_BEFORE
            place >>= _HASH_SHIFT
            place &= slots
            place += base
            entry = table.take(place)
            guess = entry & _ID_MASK
            guess_1, guess_2 = guess
            state = np.where(guess_1 == guess_2, of_agree, of_state)
            state += (entry[0] | entry[1]) >> np.uint32(_ID_BITS)
            weight = weights.take(state)
            part = span >> _PARTS
            bound = part * (weight >> _WEIGHT_BITS)
            ahead = code - bound
            part <<= _PARTS
            part -= bound
            unit = (part.view(np.uint64) // counts.total).view(np.int64)
            now, start, freq = counts.at((ahead.view(np.uint64) // unit.view(np.uint64)).view(np.int64))
            width = unit * freq
            unit *= start
            # So far all ids were taken for ones of order 0.
            hit = (ahead < 0).nonzero()[0]
            ahead -= unit
            bound, left = bound.take(hit), code.take(hit)
            bound_2 = (span.take(hit) >> _PARTS) * (weight.take(hit) & _WEIGHT_MASK)
            past = left >= bound_2
            now[hit] = np.where(past, guess_1.take(hit), guess_2.take(hit))
            begin = np.where(past, bound_2, 0)
            width[hit] = np.where(past, bound, bound_2) - begin
            ahead[hit] = left - begin
            outcome = np.full(n, 2, dtype=np.int8)
            outcome[hit] = past
            code = ahead
            small = (width < _BOTTOM).nonzero()[0]
            places = taken.take(small)
            code[small] = code.take(small) << _STEP | source.take(places, mode="clip")
            taken[small] = places + 1
            width[small] = width.take(small) << _STEP
            span = width
            entry <<= np.uint32(1)
            entry &= _BEFORE
            entry |= np.where(guess == now, used_right, used)
            entry |= now
            table[place] = entry
            outcomes.append((state, outcome))
            row[:n] = now
            last = now.astype(np.int64)
            at += 1
        ids[: found.shape[1], stop - len(found) : stop] = found.T
        state, outcome = (np.concatenate(of) for of in zip(*outcomes))
        told += np.bincount(state + outcome * np.int64(told.shape[1]), minlength=told.size).reshape(3, -1)
    return ids.view(np.int32)


def _check(most_ids: int) -> None:
    if not 1 <= most_ids <= 1 << _ID_BITS:
        raise ValueError(f"a vocabulary has 1 to {1 << _ID_BITS} ids, not {most_ids}")


def _segments(longest: int) -> Iterator[tuple[int, int]]:
    """Where the counts are brought up to date, ever more rarely, and where they are next."""
    at = 0
    while at < longest:
        stop = at + max(_FIRST_COUNTS, min(at // 2, 512))
        yield at, min(stop, longest)
        at = stop


def _number(low: np.ndarray) -> np.ndarray:
    """The upper bits, and above them the carry to the number before."""
    return (low.view(np.uint64) >> np.uint64(_STEP - 1)).view(np.int64)


def _words(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(">u4").view(">u2").astype(np.uint16)


def _numbers(words: np.ndarray) -> np.ndarray:
    return words.astype(">u2").view(">u4")


def _weights(told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights of order 2 and order 1 in each state, from the outcomes it had: right by order 2,
    else right by order 1, neither."""
    right_2, right_1, neither = told.reshape(3, -1, 2, _RECORDS, _RECORDS)
    left = right_1 + neither + _FIRST_TRIALS
    weight_2 = (right_2 + _FIRST_TRIALS * _FIRST_CHANCES[:, None]) * float(_MIXED - 2) / (right_2 + left)
    weight_2 = 1 + weight_2.astype(np.int64)
    weight_1 = (right_1 + _FIRST_TRIALS * _FIRST_CHANCES) * (_MIXED - 1.0 - weight_2) / left
    weight_1 = 1 + weight_1.astype(np.int64)
    # What order 2 has said already is not said again.
    weight_1[:, 1] = 0
    return weight_2.reshape(-1), weight_1.reshape(-1)


def _ranges(ids: np.ndarray, lengths: np.ndarray, most_ids: int) -> tuple[np.ndarray, ...]:
    """For each id the weights below its prediction's and, above those, its prediction's own, and where
    order 0 codes it, the start and width of its range there (else 0)."""
    lanes, longest = ids.shape
    lane = np.arange(lanes)[:, None]
    last, before = (np.zeros(ids.shape, dtype=np.int64) for _ in range(2))
    last[:, 1:], before[:, 2:] = ids[:, :-1], ids[:, :-2]
    (guess_1, record_1), (guess_2, record_2) = (
        _entries(ids, (hashed >> _HASH_SHIFT & slots - 1).astype(np.uint16))
        for hashed, slots in zip(
            (last * _HASHES[0], last * _HASHES[1] + before * _HASH_BEFORE), _SLOTS[:, 0]
        )
    )
    outcome = np.where(guess_2 == ids, 0, np.where(guess_1 == ids, 1, 2))
    state = lane * _STATES + np.where(guess_1 == guess_2, _AGREE, 0) + record_2 * _RECORDS + record_1
    key = lanes * _STATES * outcome + state
    told = np.zeros((3, lanes * _STATES), dtype=np.int64)
    # The distinct ids of each lane, in order.
    order = _order(ids.astype(_narrow(most_ids)))
    fresh = _fresh(ids.take(order))
    group = np.empty(ids.shape, dtype=np.int64)
    group.reshape(-1)[order] = (np.cumsum(fresh) - 1).reshape(ids.shape)
    groups = np.count_nonzero(fresh)
    held = ahead = np.zeros(groups, dtype=np.int64)
    weight, start, freq = (np.empty(ids.shape, dtype=np.int32) for _ in range(3))
    for at, stop in _segments(longest):
        now = slice(at, stop)
        weight_2, weight_1 = _weights(told)
        mixed = weight_2 + weight_1
        below = np.stack([np.zeros_like(mixed), weight_2, mixed])
        own = np.stack([weight_2, weight_1, (1 << _PARTS) - mixed])
        weight[:, now] = (below | own << _WEIGHT_BITS).take(key[:, now])
        own = held.take(group[:, now])
        known = own > 0
        first = ahead.take(group[:, now]) - lane * at
        rest = outcome[:, now] == 2
        start[:, now] = np.where(known, first << _GAIN_BITS, ids[:, now] + (at << _GAIN_BITS)) * rest
        freq[:, now] = np.where(known, own << _GAIN_BITS, 1) * rest
        held = held + np.bincount(group[:, now].reshape(-1), minlength=groups)
        ahead = np.cumsum(held) - held
        told += np.bincount(key[:, now].reshape(-1), minlength=told.size).reshape(3, -1)
    ended = np.arange(longest) >= lengths[:, None]
    # Lanes that have ended leave their range alone.
    weight[ended], start[ended], freq[ended] = 1 << _PARTS + _WEIGHT_BITS, 0, 0
    return weight, start, freq


def _entries(ids: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the slot of each id held when it came: the id before it in the slot, and the record."""
    order = _order(slots)
    empty, came = _fresh(slots.take(order)), ids.take(order)
    guess = np.zeros_like(ids)
    guess[:, 1:] = came[:, :-1]
    guess[empty] = 0
    right = (guess == came).astype(np.uint32)
    record = np.full_like(ids, 4)
    record[:, 1:] |= right[:, :-1]
    record[:, 2:] |= right[:, :-2] << np.uint32(1)
    # One that is met again for the first time has been tried once.
    record[:, 1:][empty[:, :-1]] &= np.uint32(5)
    record[empty] = 0
    entry = np.empty_like(ids)
    entry.reshape(-1)[order] = guess | record << np.uint32(_ID_BITS)
    return entry & _ID_MASK, entry >> np.uint32(_ID_BITS)


def _order(values: np.ndarray) -> np.ndarray:
    """The places of all values, in the order of the values of each row, equal ones as they come."""
    order = np.argsort(values, axis=1, kind="stable")
    order += np.arange(len(values))[:, None] * values.shape[1]
    return order


def _fresh(ordered: np.ndarray) -> np.ndarray:
    """Whether a value is not that before it in its row."""
    fresh = np.ones(ordered.shape, dtype=bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=fresh[:, 1:])
    return fresh


def _narrow(most_ids: int) -> type:
    """Two bytes are sorted by their digits."""
    return np.uint16 if most_ids <= 1 << 16 else np.uint32


class _Counts:
    """Order 0 of the decoder: parts for each time the block held an id, in their order; then
    every id has one."""

    def __init__(self, lanes: int, longest: int, most_ids: int):
        self.most_ids = most_ids
        self.stride = longest + 1
        # Id, first place in its lane, and number of places, for each place; one more place
        # a lane stands for the ids that it has not held.
        self.entries = np.zeros(lanes * self.stride, dtype=np.int64)
        self.lanes = np.arange(lanes) * self.stride

    def update(self, held: np.ndarray) -> None:
        """The ids of all lanes so far."""
        lanes, self.n = held.shape
        self.total = np.uint64((self.n << _GAIN_BITS) + self.most_ids)
        entries = self.entries.reshape(-1, self.stride)
        for at in range(0, lanes if self.n else 0, _LANES):
            ordered = np.sort(held[at : at + _LANES].astype(_narrow(self.most_ids)), axis=1)
            firsts = _fresh(ordered).reshape(-1).nonzero()[0]
            # Firsts of a lane lie side by side, so the next first ends a run.
            runs = np.diff(firsts, append=ordered.size)
            runs |= firsts % self.n << 16 | ordered.reshape(-1)[firsts].astype(np.int64) << 32
            entries[at : at + len(ordered), : self.n] = np.repeat(runs, runs & 0xFFFF).reshape(-1, self.n)

    def at(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose ranges hold these values, one a lane, where they begin, and their widths."""
        place = values >> _GAIN_BITS
        new = (place.view(np.uint64) >= np.uint64(self.n)).nonzero()[0]
        place[new] = self.n
        place += self.lanes[: len(place)]
        entry = self.entries.take(place)
        ids = (entry >> 32).astype(np.uint32)
        freq = (entry & 0xFFFF) << _GAIN_BITS
        entry >>= 16 - _GAIN_BITS
        entry &= 0xFFFF << _GAIN_BITS
        value = values.take(new)
        entry[new], freq[new] = value, 1
        ids[new] = value - (self.n << _GAIN_BITS)
        return ids, entry, freq
