"""Token ids of text columns: each distinct word is given to the tokenizer once."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from outagelens.llm import text_arrays

# fixed values: the splitting rule of the word tokenizer that the array code can follow
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"

_GROUP_BYTES = 1 << 19
_WHITE, _LETTER, _DIGIT, _OTHER, _HARD = range(5)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _HARD, dtype=np.uint8)
    kinds[33:127] = _OTHER
    kinds[48:58] = _DIGIT
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[ord("'")] = _HARD  # begins the endings that the splitting rule names
    kinds[text_arrays.WHITE] = _WHITE
    return kinds


_KINDS = _byte_kinds()
#: bytes as the characters that byte-level vocabularies write them with
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in set(_PLAIN)]
_AS_CHAR = {b: 256 + i for i, b in enumerate(_REST) if b != 32}


class Encoder:
    """Ids of whole texts by one tokenizer file; ``most_words`` distinct words are kept.

    Where the file follows the rule in ``SPLIT``, texts are cut into its words as arrays, and
    only words that were not met before go to the library, in one call. White space always
    separates words, so a text's ids are those of its words in order. Words with letters
    beyond Latin-1, apostrophes or control characters go to the library as they are. Texts
    that hold added tokens of the file, such as its end of text, are cut at them first, as
    the library does. Other files take the plain way, text by text.
    """

    def __init__(self, path: str, most_words: int = 1 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.most_words = most_words
        with open(path) as file:
            told = json.load(file)
        steps = (told.get("normalizer") or {}).get("normalizers", [])
        cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = (
            [s["type"] for s in steps] == NORMALIZERS
            and cuts[0].get("pattern", {}).get("Regex") == SPLIT
            and told["model"].get("end_of_word_suffix") == WORD_END
            and not any(t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        # of tokens that begin at one place the library takes the longest
        self.cuts = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends_word = np.zeros(self.size, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _plain_ids(self, plain: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of the splitting rule, end to end, and how many each word has."""
        text = b" ".join(plain).decode("latin-1").translate(_AS_CHAR)
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(plain):
            return ids, np.diff(ends, prepend=0)
        texts = [w.decode("latin-1").translate(_AS_CHAR) for w in plain]
        return self._joined(self.words.encode_batch_fast(texts, add_special_tokens=False))

    @staticmethod
    def _joined(encodings: list) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in encodings]
        flat = np.fromiter((i for ids in lists for i in ids), dtype=np.uint32)
        return flat, np.array([len(ids) for ids in lists], dtype=np.int64)

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.first = np.insert(self.first, at, len(self.flat) + np.cumsum(counts) - counts)
        self.count = np.insert(self.count, at, counts)
        self.flat = np.concatenate([self.flat, ids])

    def _units(self, data: np.ndarray, offsets: np.ndarray):
        """Lower-cased bytes; start, end, row of each word of the splitting rule; hard ones
        are whole runs between white space."""
        kinds = _KINDS[data]
        lead = np.flatnonzero(data == 0xC3)
        after = lead + 1  # UTF-8: a byte always follows
        latin = (data[after] != 0x97) & (data[after] != 0xB7)
        kinds[lead[latin]] = kinds[after[latin]] = _LETTER
        hard = np.flatnonzero(kinds == _HARD)
        lowered = text_arrays.LOWER[data]
        upper = after[latin & (data[after] < 0x9F)]
        lowered[upper] += 0x20
        if len(hard):
            starts, ends = text_arrays.runs(kinds != _WHITE, offsets)
            which = np.unique(np.searchsorted(starts, hard, side="right") - 1)
            cover = np.zeros(len(data) + 1, dtype=np.int8)
            cover[starts[which]] += 1
            cover[ends[which]] -= 1
            inside = np.cumsum(cover[:-1], dtype=np.int8).astype(bool)
            kinds[inside] = _HARD
            lowered[inside] = data[inside]
        breaks = np.zeros(len(data) + 1, dtype=bool)
        breaks[offsets] = True
        change = np.ones(len(data) + 1, dtype=bool)
        change[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT) | breaks[1:-1]
        some = kinds != _WHITE
        starts = np.flatnonzero(change[:-1] & some)
        ends = np.flatnonzero(change[1:] & some) + 1
        return lowered, starts, ends, np.searchsorted(offsets, starts, side="right") - 1, kinds[starts] == _HARD

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids (uint32) of each row of a text column; a null row has none."""
        if not self.by_word:
            for text in column.to_pylist():
                yield np.array(self.whole.encode(text or "", add_special_tokens=False).ids, dtype=np.uint32)
            return
        cut = np.zeros(len(column), dtype=bool)
        for token in self.added:
            cut |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        if not cut.any():
            yield from self._uncut_rows(column)
            return
        for low, high in text_arrays.groups(text_arrays.utf8(column)[1], _GROUP_BYTES):
            parts, between = [], []
            for text, some in zip(column.slice(low, high - low).to_pylist(), cut[low:high], strict=True):
                parts += self.cuts.split(text) if some else [text]
                between.append([self.added[t] for t in self.cuts.findall(text)] if some else [])
            own = self._uncut_rows(pa.array(parts, pa.large_string()))
            for tokens in between:
                ids = [next(own)]
                for token in tokens:
                    ids += [np.array([token], dtype=np.uint32), next(own)]
                yield np.concatenate(ids)

    def _uncut_rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        for low, high, data, offsets in text_arrays.row_groups(column, _GROUP_BYTES):
            if not len(data):
                yield from (np.zeros(0, dtype=np.uint32) for _ in range(low, high))
                continue
            lowered, starts, ends, rows, hard = self._units(data, offsets)
            hashes = text_arrays.hash_spans(lowered, starts, ends)
            distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) > self.most_words:
                self._forget()
            at = np.searchsorted(self.known, distinct).clip(max=max(len(self.known) - 1, 0))
            new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
            if len(new):
                blob = lowered.tobytes()
                is_hard = hard[example[new]]
                plain = new[~is_hard]
                if len(plain):
                    self._learn(distinct[plain], *self._plain_ids([blob[starts[e] : ends[e]] for e in example[plain]]))
                special = new[is_hard]
                if len(special):
                    texts = [blob[starts[e] : ends[e]].decode() for e in example[special]]
                    self._learn(distinct[special], *self._joined(self.whole.encode_batch_fast(texts, add_special_tokens=False)))
                at = np.searchsorted(self.known, distinct)
            first, count = self.first[at][which], self.count[at][which]
            before = np.cumsum(count) - count
            ids = self.flat[np.repeat(first - before, count) + np.arange(int(count.sum()))]
            # ids of a row end where those of its last word do
            cut = np.append(before, len(ids))[np.searchsorted(rows, np.arange(1, high - low))]
            yield from np.split(ids, cut)


def packed(ids: np.ndarray) -> bytes:
    """Ids as compressed bytes; two bytes an id where that is enough."""
    kind = np.uint16 if not len(ids) or int(ids.max()) < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(ids.astype(kind).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    kind = np.uint16 if data[0] == 2 else np.uint32
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=kind).astype(np.uint32)


def crc_bytes(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file in a worker process; its words are kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_ids(rows: DataFrame, path: str, end_id: int) -> DataFrame:
    """(id, order, n, ids) of rows (id, order, body): packed ids with ``end_id`` at the end."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in text_arrays.slices(batches):
            sizes, data = [], []
            for ids in own.rows(batch.column("body")):
                sizes.append(len(ids) + 1)
                data.append(packed(np.append(ids, np.uint32(end_id))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("order"), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                names=["id", "order", "n", "ids"])

    return rows.select("id", "order", "body").mapInArrow(work, "id long, order long, n long, ids binary")
