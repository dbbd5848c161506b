"""Canonical length-limited Huffman codes over ids, in blocks that decode by themselves."""

from __future__ import annotations

import numpy as np

#: ids between two checkpoints
LANE = 128
_STEP_LANES = 8_192


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Bits for each id: the shortest total with no code above ``longest`` (package merge).

    Ids that don't occur have 0 bits; a single id has 1.
    """
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if 1 << longest < len(used):
        raise ValueError(f"{len(used)} ids need codes of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    weights, packages = leaves, np.zeros(len(leaves), dtype=bool)
    levels = [packages]
    for _ in range(longest - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        weights, packages = both[place], place >= len(leaves)
        levels.append(packages)
    take = 2 * len(leaves) - 2
    bits = np.zeros(len(leaves), dtype=np.uint8)
    for packages in reversed(levels):
        packed = int(packages[:take].sum())
        bits[: take - packed] += 1
        take = 2 * packed
    lengths[order] = bits
    return lengths


class Code:
    """The canonical code of given lengths: ascending by length, then by id."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.longest = int(lengths.max()) if len(lengths) else 0
        self.order = np.lexsort((np.arange(len(lengths)), self.lengths))
        self.order = self.order[self.lengths[self.order] > 0]
        bits = self.lengths[self.order]
        # each code stands for a share of the table of the longest codes
        shares = np.int64(1) << (self.longest - bits)
        starts = np.cumsum(shares) - shares
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[self.order] = (starts >> (self.longest - bits)).astype(np.uint64)
        self._shares = shares
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and bits for each value of the next ``longest`` bits."""
        if self._table is None:
            size = 1 << self.longest
            ids, bits = np.zeros(size, dtype=np.uint32), np.ones(size, dtype=np.uint8)
            filled = int(self._shares.sum())
            ids[:filled] = np.repeat(self.order, self._shares)
            bits[:filled] = np.repeat(self.lengths[self.order], self._shares)
            self._table = ids, bits
        return self._table

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Payload, and the bits of each lane of ``LANE`` ids as unsigned 16-bit numbers."""
        if not len(ids):
            return b"", b""
        bits = self.lengths[ids]
        begin = np.cumsum(bits) - bits
        total = int(begin[-1] + bits[-1])
        # a code of at most 32 bits touches two words of 32 bits
        shift = (64 - (begin & 31) - bits).astype(np.uint64)
        wide = self.codes[ids] << shift
        word = begin >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words = np.zeros(int(word[-1]) + 2, dtype=np.uint64)
        words[word[first]] |= np.bitwise_or.reduceat(wide >> np.uint64(32), first)
        words[word[first] + 1] |= np.bitwise_or.reduceat(wide & np.uint64(0xFFFFFFFF), first)
        payload = words.astype(">u4").tobytes()[: -(-total // 8)]
        lanes = np.add.reduceat(bits, np.arange(0, len(ids), LANE))
        return payload, lanes.astype("<u2").tobytes()

    def decode(self, payload: bytes, lanes: bytes, size: int) -> np.ndarray:
        """The ids of a block; all lanes are read side by side, one id each a step."""
        if not size:
            return np.zeros(0, dtype=np.uint32)
        ids, bits = self.table()
        words = np.frombuffer(payload + bytes(12 - len(payload) % 4), dtype=">u4").astype(np.uint64)
        lane_bits = np.frombuffer(lanes, dtype="<u2").astype(np.int64)
        begin = np.cumsum(lane_bits) - lane_bits
        out = np.zeros((len(lane_bits), LANE), dtype=np.uint32)
        last = len(words) - 2
        take = np.uint64(64 - self.longest)
        for low in range(0, len(begin), _STEP_LANES):
            at = begin[low : low + _STEP_LANES].copy()
            for step in range(LANE):
                word = np.minimum(at >> 5, last)
                window = (words[word] << np.uint64(32) | words[word + 1]) << (at & 31).astype(np.uint64) >> take
                out[low : low + len(at), step] = ids[window]
                at += bits[window]
        return out.ravel()[:size]
