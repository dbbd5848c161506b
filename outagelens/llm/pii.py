"""Personal data in texts: four patterns, and a linear-chain CRF over word shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagelens.llm import text_arrays

Span = tuple[int, int]

# fixed values: kinds in their order, and the patterns of the contract
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: tags: outside, then begin and inside of each kind
TAGS = 1 + 2 * len(KINDS)
SHAPES = 1 << 12
#: digits and other characters of a word, and whether it is spelled as an at or a dot
_SIZES = 3 * 64
# fixed values: how people write at and dot so that programs overlook an address
AT_MARKS, DOT_MARKS = ["(at)", "[at]"], ["(dot)", "[dot]"]


def emails(text: str) -> list[Span]:
    """Leftmost matches. A match begins with the run of name characters before its ``@``."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        else:
            done = at + 1  # a run of name characters never crosses an @
        at = text.find("@", max(done, at + 1))
    return found


def ips(text: str) -> list[Span]:
    """Four numbers of at most 255 each; a run of digits that begins no match is passed whole."""
    return [m.span() for m in _IP.finditer(text) if all(len(p := n.lstrip("0")) <= 3 and int(p or 0) <= 255 for n in m.groups())]


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


_FINDERS = [emails, ips, cards, phones]


def base_spans(text: str) -> list[list[Span]]:
    """Spans of each kind, in the order of ``KINDS``, by code points with the end left out."""
    return [finder(text) for finder in _FINDERS]


def told(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in sorted(own))


# ---- word shapes ------------------------------------------------------------------------

def _classes() -> np.ndarray:
    kinds = np.full(256, 9, dtype=np.uint8)
    kinds[97:123] = kinds[128:] = 1
    kinds[65:91] = 2
    kinds[48:58] = 3
    for k, marks in enumerate([b"@", b".", b"+", b"-_", b"()"]):
        kinds[list(marks)] = 4 + k
    return kinds


_CLASS = _classes()


@dataclass
class Words:
    """Words of some rows: bytes' start and end, row, shape, size class, may it be tagged."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    shape: np.ndarray
    size: np.ndarray
    open: np.ndarray


def _words_with(data: np.ndarray, start: np.ndarray, marks: list[str]) -> np.ndarray:
    """Which words hold one of the marks, whatever its case."""
    low, found = text_arrays.LOWER[data], np.zeros(len(start), dtype=bool)
    for mark in marks:
        raw = mark.encode()
        places = np.flatnonzero(low[: max(len(low) - len(raw) + 1, 0)] == raw[0])
        for k in range(1, len(raw)):
            places = places[low[places + k] == raw[k]]
        found[np.searchsorted(start, places, side="right") - 1] = True
    return found


def _beside(chosen: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The chosen words and their neighbours in the same row."""
    out = chosen.copy()
    same = row[1:] == row[:-1]
    out[1:] |= chosen[:-1] & same
    out[:-1] |= chosen[1:] & same
    return out


def shaped(data: np.ndarray, offsets: np.ndarray) -> Words:
    """A shape is a word's run-length free sequence of character classes, hashed. A word may be
    tagged if it holds a digit or ``@``, or stands beside an ``@`` or a spelled-out mark that
    ends or begins a word; no other word is part of any kind."""
    start, end, row = text_arrays.words(data, offsets)
    kinds = _CLASS[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[start] = True
    place = np.append(0, np.cumsum(keep))
    shape = text_arrays.hash_spans(kinds[keep], place[start], place[end - 1] + keep[end - 1])
    digit = np.append(0, np.cumsum(kinds == 3))
    mail = np.append(0, np.cumsum(kinds == 4))
    digits = digit[end] - digit[start]
    size = np.minimum(digits, 15) * 4 + np.minimum((end - start - digits + 2) // 3, 3)
    has_mail = mail[end] > mail[start]
    at, dot = _words_with(data, start, AT_MARKS), _words_with(data, start, DOT_MARKS)
    cut = has_mail & ((data[start] == ord("@")) | (data[end - 1] == ord("@")))
    size = size + 64 * np.where(at, 1, np.where(dot, 2, 0))
    return Words(start, end, row, (shape % np.uint64(SHAPES)).astype(np.int64), size,
                 (digits > 0) | has_mail | _beside(at | dot | cut, row))


def features(words: Words) -> np.ndarray:
    """Rows of four indices: the word's shape, size, and its neighbours' shapes."""
    before, after = np.roll(words.shape, 1), np.roll(words.shape, -1)
    if len(words.row):
        before[np.diff(words.row, prepend=-1) != 0] = 0
        after[np.diff(words.row, append=-1) != 0] = 0
    return np.column_stack([words.shape, SHAPES + words.size, SHAPES + _SIZES + before, 2 * SHAPES + _SIZES + after])


N_FEATURES = 3 * SHAPES + _SIZES


# ---- linear-chain CRF -------------------------------------------------------------------

@dataclass
class Crf:
    """Weights of features by tag, of one tag after another, and of tags at the start."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Inside a kind only after its begin or inside: 0 where allowed, else a large negative."""
    move, first = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        move[:, inside] = -1e4
        move[[inside - 1, inside], inside] = 0
        first[inside] = -1e4
    return move, first


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]], steps: int = 90, rate: float = 0.3, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by forward-backward over all rows at once, with Adam steps.

    A row is (features of each word, tags, which words may be tagged, how often it counts).
    """
    move_ok, first_ok = _allowed()
    crf = Crf(np.zeros((N_FEATURES, TAGS)), np.zeros((TAGS, TAGS)), np.zeros(TAGS))
    if not rows:
        return crf
    rows = sorted(rows, key=lambda r: -len(r[1]))
    lengths = np.array([len(tags) for _, tags, _, _ in rows])
    longest, size = int(lengths[0]), len(rows)
    alive = [int((lengths > t).sum()) for t in range(longest)]  # rows that reach a place come first
    weight = np.array([w for _, _, _, w in rows])
    index = np.zeros((size, longest, 4), dtype=np.int64)
    gold = np.zeros((size, longest), dtype=np.int64)
    mask = np.zeros((size, longest), dtype=bool)
    closed = np.zeros((size, longest), dtype=bool)
    for k, (own, tags, able, _) in enumerate(rows):
        n = len(tags)
        index[k, :n], gold[k, :n], mask[k, :n], closed[k, :n] = own, tags, True, ~able
    only_outside = np.where(np.arange(TAGS) > 0, -1e4, 0.0)
    # the words of each feature, found once, so that a step adds them up in one pass
    held = index[mask].T.ravel()
    by_feature = np.argsort(held, kind="stable")
    present, starts = np.unique(held[by_feature], return_index=True)
    word_of = by_feature % mask.sum()
    params = [crf.emit, crf.move, crf.first]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    every = np.arange(size)
    for step in range(1, steps + 1):
        scores = crf.emit[index].sum(axis=2) + closed[..., None] * only_outside
        move, first = crf.move + move_ok, crf.first + first_ok
        forward = np.zeros((size, longest, TAGS))
        forward[:, 0] = scores[:, 0] + first
        for t in range(1, longest):
            n = alive[t]
            forward[:n, t] = _log_sum(forward[:n, t - 1, :, None] + move, 1) + scores[:n, t]
        total = _log_sum(forward[every, lengths - 1], 1)
        backward = np.zeros((size, longest, TAGS))
        pair = np.zeros((TAGS, TAGS))
        for t in range(longest - 2, -1, -1):
            n = alive[t + 1]
            onward = move + (scores[:n, t + 1] + backward[:n, t + 1])[:, None, :]
            backward[:n, t] = _log_sum(onward, 2)
            pair += np.tensordot(weight[:n], np.exp(forward[:n, t, :, None] + onward - total[:n, None, None]), axes=1)
        chance = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        slope = [np.zeros_like(p) for p in params]
        wrong = chance.copy()
        wrong[every[:, None], np.arange(longest), gold] -= mask
        wrong *= weight[:, None, None]
        slope[0][present] = np.add.reduceat(wrong[mask][word_of], starts, axis=0)
        slope[1] += pair
        np.add.at(slope[1], (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), -np.repeat(weight, mask[:, 1:].sum(axis=1)))
        slope[2] += wrong[:, 0].sum(axis=0)
        for p, g, m, v in zip(params, slope, means, squares, strict=True):
            g = g / weight.sum() + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    crf.move += move_ok
    crf.first += first_ok
    return crf


@dataclass
class Runs:
    """Open words that stand together, longest runs first: first word, length, whether they
    open and close their row, and the scores of their words' tags."""

    begin: np.ndarray
    length: np.ndarray
    opens: np.ndarray
    closes: np.ndarray

    def alive(self, step: int) -> int:
        """How many runs have more than ``step`` words."""
        return int(np.searchsorted(-self.length, -step - 1, side="right"))


def _runs(words: Words, chosen: np.ndarray) -> Runs:
    """The runs of open words that hold a chosen one."""
    which = np.flatnonzero(words.open)
    cut = np.flatnonzero((np.diff(which, prepend=-2) != 1) | (np.diff(words.row[which], prepend=-1) != 0))
    begin, length = which[cut], np.diff(np.append(cut, len(which)))
    held = np.append(0, np.cumsum(chosen))
    keep = held[begin + length] > held[begin]
    begin, length = begin[keep], length[keep]
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    last = begin + length - 1
    opens = (begin == 0) | (words.row[begin - 1] != words.row[begin])
    closes = (last == len(words.row) - 1) | (words.row[np.minimum(last + 1, len(words.row) - 1)] != words.row[last])
    return Runs(begin, length, opens, closes)


def decode(crf: Crf, words: Words) -> np.ndarray:
    """The likeliest tags of all rows' words: Viterbi over batches of runs.

    Words that may not be tagged are outside, so a chain falls into runs of open words that
    begin and end beside an outside word; runs are decoded side by side, longest first.
    """
    tags = np.zeros(len(words.row), dtype=np.int64)
    if not words.open.any():
        return tags
    runs, index = _runs(words, words.open), features(words)
    score = crf.emit[index[runs.begin]].sum(axis=1) + np.where(runs.opens[:, None], crf.first, crf.move[0])
    back = []
    finals = np.zeros(len(runs.begin), dtype=np.int64)
    end_score = np.where(runs.closes[:, None], 0.0, crf.move[:, 0])
    for step in range(1, int(runs.length[0]) + 1):
        live, over = runs.alive(step - 1), runs.alive(step)
        finals[over:live] = (score[over:live] + end_score[over:live]).argmax(axis=1)
        if not over:
            break
        paths = score[:over, :, None] + crf.move
        best = paths.argmax(axis=1)
        back.append(best.astype(np.int8))
        score = np.take_along_axis(paths, best[:, None, :], axis=1)[:, 0] + crf.emit[index[runs.begin[:over] + step]].sum(axis=1)
    now = finals.copy()
    for step in range(int(runs.length[0]) - 1, -1, -1):
        live = runs.alive(step)
        tags[runs.begin[:live] + step] = now[:live]
        if step:
            now[:live] = back[step - 1][np.arange(live), now[:live]]
    return tags


def marginals(crf: Crf, words: Words, tags: np.ndarray) -> np.ndarray:
    """The probability of each word's tag, by forward-backward over the runs that hold a span;
    1 for all other words."""
    out = np.ones(len(words.row))
    if not tags.any():
        return out
    runs, index = _runs(words, tags > 0), features(words)
    end_score = np.where(runs.closes[:, None], 0.0, crf.move[:, 0])
    ahead = [crf.emit[index[runs.begin]].sum(axis=1) + np.where(runs.opens[:, None], crf.first, crf.move[0])]
    emits = [ahead[0]]
    for step in range(1, int(runs.length[0])):
        live = runs.alive(step)
        emits.append(crf.emit[index[runs.begin[:live] + step]].sum(axis=1))
        ahead.append(_log_sum(ahead[-1][:live, :, None] + crf.move, 1) + emits[-1])
    total = np.zeros(len(runs.begin))
    back = end_score.copy()
    for step in range(int(runs.length[0]) - 1, -1, -1):
        live, over = runs.alive(step), runs.alive(step + 1)
        total[over:live] = _log_sum(ahead[step][over:live] + end_score[over:live], 1)
        if over:
            back[:over] = _log_sum(crf.move + (emits[step + 1][:over] + back[:over])[:, None, :], 2)
        place = runs.begin[:live] + step
        own = np.arange(live), tags[place]
        out[place] = np.exp(ahead[step][own] + back[own] - total[:live])
    return out


# ---- the labelled table's own rows ------------------------------------------------------

# fixed values: spellings that the patterns don't have, and what only looks like them
_PEOPLE = ["ana.lima", "j_rowe", "k-42", "mail", "Otto.Maier", "x9"]
_HOSTS = [("example", "org"), ("post-haus", "de"), ("mx.uni", "pt"), ("a1b2", "net")]
_ADDRESSES = ["{p} @ {h}.{t}", "{p}@ {h}.{t}", "{p} @{h}.{t}", "{p} (at) {h}.{t}", "{p}(at){h}.{t}", "{p} [at] {h}.{t}",
              "{p}[at]{h}[dot]{t}", "{p} (at) {h} (dot) {t}", "{p} [at] {h} [dot] {t}"]
_CARDS = ["4111{s}1111{s}1111{s}1111", "5500{s}0000{s}0000{s}0004", "3400{s}000000{s}00009", "6011{s}0009{s}9013{s}9424",
          "4000{s}1234{s}5678{s}9017", "5105{s}9876{s}1234{s}0003"]
_NUMBERS = ["({a}) {b}-{c}", "0049 {a} {b}{c}", "0{a} {b}-{c}", "0{a}/{b}-{c}", "({a}) {b}{c}", "(0{a}) {b} {c}", "00351.{a}.{b}.{c}"]
_PARTS = [("30", "555", "0134"), ("555", "010", "9999"), ("351", "5550", "0178"), ("11", "5550", "0123"), ("21", "555", "0190")]
_AROUND = [("", ""), ("write to ", " today"), ("reach us: ", ", thanks"), ("my number is ", "."), ("(see ", ")"), ("call ", " or come by"),
           ("he left ", " and went on"), ("contact ", "\nbest regards")]
_LOOKALIKES = [
    "on 2024-01-31 at 10:45:00", "version 10.2.33.4567 of it", "order 2024-12-3447-14563-15950955", "costs 1.299,00 or 1,299.00",
    "pages 120-135, 2nd ed.", "see [3] and (4) there", "ratio 3/4 by 7/8", "ISBN 978-3-16-148410-0",
    "the meeting (at noon) was short", "a note [sic] here", "she said (quietly) no", "rooms 101 102 103", "at 5 pm, dot by dot",
    "tweet @ once", "price @ 5 each", "10.000.000 people", "1990 1991 1992 1993", "(555) only", "0.5 0.25 0.125", "item #12 (of 30)",
    "temperature -12.5 C", "section 4.2.1.3", "call 112 now", "from 09.05.2021 to 10.06.2022", "12 34 56 78", "RFC 2822 and ISO 8601-1",
]


#: how often each written-out example counts
_WEIGHT = 3.0


def template_rows() -> list[tuple[str, str]]:
    """(body, spans) of written-out examples, each spelling in some surroundings."""
    values = [(0, form.format(p=p, h=h, t=t)) for form in _ADDRESSES for p, (h, t) in zip(_PEOPLE, _HOSTS + _HOSTS, strict=False)]
    values += [(2, form.format(s=s)) for form in _CARDS for s in "./_"]
    values += [(3, form.format(a=a, b=b, c=c)) for form in _NUMBERS for a, b, c in _PARTS]
    rows = []
    for k, (kind, value) in enumerate(values):
        for turn in range(2):
            before, after = _AROUND[(3 * k + 5 * turn) % len(_AROUND)]
            rows.append((f"{before}{value}{after}", f"{KINDS[kind]}:{len(before)}:{len(before) + len(value)}"))
    return rows + [(f"{a}{text}{b}", "") for text in _LOOKALIKES for a, b in _AROUND[:3]]


# ---- the operator -----------------------------------------------------------------------

@dataclass(frozen=True)
class Settings:
    """``sample``: windows of ``reach`` words to each side, from texts with digits or ``@``,
    that make up the labelled table beside the examples written out here. ``sure``: how
    probable every word of a span has to be that the CRF adds."""

    sample: int = 1_200
    reach: int = 8
    sure: float = 0.5


_ADDRESS = re.compile(r"(?i)[^\s@]+\s?(?:@|\(at\)|\[at\])\s?[a-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\])\s?[a-z0-9-]+)+")


def _extra(kind: int, text: str, start: int, end: int) -> Span | None:
    """The tagged words without marks around them, if counts and check digits allow the tag."""
    piece = text[start:end].rstrip()
    lead = re.match(r"[^0-9A-Za-z+(]*", piece).end()
    own = piece[lead:]
    if kind == 0 or own[:1] != "(" or ")" not in own:
        own = own.lstrip("(")
    lead = len(piece) - len(own)
    own = re.sub(r"[^0-9A-Za-z]+$", "", own)
    digits = _digits(own)
    letters = re.search(r"[A-Za-z]", own)
    sure = {
        0: bool(_ADDRESS.fullmatch(own)),
        1: False,  # four numbers above 255 are no address: the pattern has them all
        2: not letters and 13 <= len(digits) <= 19 and _luhn(digits),
        3: not letters and 9 <= len(digits) <= 15 and len(digits) < len(own),
    }[kind]
    return (start + lead, start + lead + len(own)) if own and sure else None


def _tag_spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, first word, last word) of each tagged run."""
    found = []
    for k in np.flatnonzero(tags % 2 == 1):
        last = int(k)
        while last + 1 < len(tags) and tags[last + 1] == tags[k] + 1:
            last += 1
        found.append((int(tags[k]) // 2, int(k), last))
    return found


def all_spans(column: pa.Array, crf: Crf, sure: float = Settings.sure) -> Iterator[tuple[list[list[Span]], list[list[Span]]]]:
    """Spans of the patterns and all spans of each row; null rows are empty.

    Spans that the CRF adds are probable in every word, pass the check of their kind and lie
    clear of the patterns' spans and of each other.
    """
    for low, high, data, offsets in text_arrays.row_groups(column):
        words = shaped(data, offsets)
        busy = np.bincount(words.row[words.open], minlength=high - low) > 0
        tags = decode(crf, words)
        chance = marginals(crf, words, tags)
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        added: dict[int, list[tuple[int, int, int]]] = {}
        for kind, first, last in _tag_spans(tags):
            if chance[first : last + 1].min() >= sure:
                row = int(words.row[first])
                zero = points[offsets[row]]
                added.setdefault(row, []).append((kind, int(points[words.start[first]] - zero), int(points[words.end[last]] - zero)))
        for row in range(high - low):
            if not busy[row]:
                yield [[] for _ in KINDS], [[] for _ in KINDS]
                continue
            text = data[offsets[row] : offsets[row + 1]].tobytes().decode()
            base = base_spans(text)
            spans = [list(own) for own in base]
            if row in added:
                taken = np.zeros(len(text), dtype=bool)
                for x, y in (s for own in base for s in own):
                    taken[x:y] = True
                for kind, start, end in added[row]:
                    span = _extra(kind, text, start, end)
                    if span and not taken[span[0] : span[1]].any():
                        spans[kind].append(span)
                        taken[span[0] : span[1]] = True
            yield base, spans


def _windows(settings: Settings):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for low, high, data, offsets in text_arrays.row_groups(batch.column("body")):
                words = shaped(data, offsets)
                row_ends = np.searchsorted(words.row, np.arange(high - low), side="right")
                row_starts = np.searchsorted(words.row, np.arange(high - low), side="left")
                done = -1
                for k in np.flatnonzero(words.open):
                    if k <= done:
                        continue
                    row = words.row[k]
                    first, last = max(k - settings.reach, row_starts[row]), min(k + settings.reach, row_ends[row] - 1)
                    text = data[words.start[first] : words.end[last]].tobytes().decode()
                    texts.append(text)
                    spans.append(told(base_spans(text)))
                    done = last
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.string())], names=["body", "spans"])
    return work


def labelled_table(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """(body, spans): at most ``sample`` short windows around digits and ``@``, labelled by
    the patterns. Windows are taken in order of their hash, each text once."""
    rows = docs.select(F.col(text_col).alias("body")).filter(F.col("body").rlike("[0-9@]"))
    size = rows.count()
    # a few texts give enough windows: those whose hash is low, four times as many as needed
    share = F.pmod(F.xxhash64("body"), F.lit(1 << 20)) < max(1, min(1 << 20, 4 * settings.sample * (1 << 20) // max(size, 1)))
    windows = rows.filter(share).mapInArrow(_windows(settings), "body string, spans string").distinct()
    return windows.orderBy(F.xxhash64("body"), "body").limit(settings.sample)


def train(table: DataFrame) -> Crf:
    """A CRF from a small labelled table (body, spans), which is read on the driver, and the
    examples written out here."""
    return train_rows([(r["body"], r["spans"]) for r in table.collect()])


def train_rows(table: list[tuple[str, str]]) -> Crf:
    rows = []
    for body, spans, weight in [*((b, s, 1.0) for b, s in table), *((b, s, _WEIGHT) for b, s in template_rows())]:
        raw = body.encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        words = shaped(data, np.array([0, len(data)]))
        if not len(words.row):
            continue
        place = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        tags = np.zeros(len(words.row), dtype=np.int64)
        for item in filter(None, spans.split(",")):
            kind, a, b = item.split(":")
            inside = np.flatnonzero((place[words.start] < int(b)) & (place[words.end] > int(a)) & words.open)
            if len(inside) and not tags[inside].any():
                inside = inside[0] + np.arange(len(inside))[np.diff(inside, prepend=inside[0] - 1) == 1]
                tags[inside] = 2 + 2 * KINDS.index(kind)
                tags[inside[0]] -= 1
        # all other words are outside whatever the weights, so runs of open words, with one
        # word on either side, have the same likelihood as the row
        index, last = features(words), len(tags) - 1
        runs = np.flatnonzero(np.diff(np.append(0, np.append(words.open, 0).astype(np.int8))))
        for low, high in zip(runs[::2], runs[1::2], strict=True):
            part = slice(max(low - 1, 0), min(high, last) + 1)
            rows.append((index[part], tags[part], words.open[part], weight))
    return fit(rows)


def find(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", sure: float = Settings.sure) -> DataFrame:
    """The id, spans of each kind the patterns find, their digest, and all spans.

    Defined results: a null text is empty and has no span; every row gives one row. Places
    count code points, the end left out. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for base, every in all_spans(batch.column("body"), shared.value, sure):
                counts.append([len(own) for own in base])
                digests.append(hashlib.sha256(told(base).encode()).hexdigest())
                spans.append(told(every))
            by_kind = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(by_kind[:, k]) for k in range(len(KINDS))], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = rows.mapInArrow(work, f"id long, {counts}, base_sha256 string, spans string")
    return found.select(F.col("id").alias(id_col), *found.columns[1:])


def personal_data(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``find`` with a CRF trained on windows of these documents."""
    return find(docs, train(labelled_table(docs, settings)), sure=settings.sure)
