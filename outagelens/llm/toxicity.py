"""Abusive texts: misspelled lexicon terms and the context they stand in."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagelens.llm import text_arrays
from outagelens.llm.language_id import remainder
from outagelens.llm.ngram_join import Shingling, shingle_sets
from outagelens.llm.shared import stored

# fixed values: marks that open and close a quotation, and words that report what others say
PAIRS = [("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’")]
REPORTS = ["said", "says", "quote", "quoted", "called", "word", "term", "wrote"]
_REPORTS = frozenset(REPORTS)


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows that are learned from, about, chosen by hash. A term stands
    in ``least_docs`` toxic texts of the sample and ``least_part`` of them at least, and
    ``least_share`` of the texts that hold it are toxic; ``most_terms`` is the size of the
    lexicon. Words of 128 bytes and more are compared with terms as they are, not for an edit."""

    sample: int = 20_000
    least_docs: int = 4
    least_part: float = 0.01
    least_share: float = 0.9
    most_terms: int = 2_000
    least_letters: int = 3
    fuzzy_letters: int = 5
    window: int = 60


@dataclass
class Model:
    """Terms, clean words that only look like one, and weights: bias, then a hit that is
    exact, misspelled, quoted, reported. The last two follow from the others if not given."""

    terms: list[str] = field(default_factory=list)
    clean: set[str] = field(default_factory=set)
    weights: np.ndarray = field(default_factory=lambda: np.array([-3.0, 4.0, 2.0]))

    def __post_init__(self) -> None:
        if len(self.weights) == 3:
            self.weights = np.append(self.weights, [0.2 * self.weights[1], 0.5 * self.weights[1]])


class Trie:
    """A lexicon by letters; words within one edit are found by walking both at once."""

    def __init__(self, terms: Iterable[str], fuzzy_letters: int) -> None:
        self.root: dict = {}
        self.fuzzy_letters = fuzzy_letters
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term

    def near(self, word: str) -> str | None:
        """A term of enough letters at one edit from ``word``, the smallest of several.

        The word's Levenshtein automaton runs along the trie: its states are how many of the
        word's letters are read, with or without the edit. A branch ends with its last state.
        """
        size, found = len(word), []
        walk = [(self.root, {(0, 0), (1, 1)})]
        while walk:
            node, states = walk.pop()
            term = node.get("")
            if term is not None and (size, 1) in states and len(term) >= self.fuzzy_letters:
                found.append(term)
            for letter, child in node.items():
                if not letter:
                    continue
                after = set()
                for read, edits in states:
                    if read < size and word[read] == letter:
                        after.add((read + 1, edits))
                        if not edits:
                            after.add((read + 2, 1))  # the word's next letter is too much
                    if not edits:
                        after |= {(read, 1), (read + 1, 1)}  # a letter is missing, or another
                if after:
                    walk.append((child, after))
        return min(found, default=None)


_WORD_BYTES = np.zeros(256, dtype=bool)
_WORD_BYTES[48:58] = _WORD_BYTES[65:91] = _WORD_BYTES[97:123] = _WORD_BYTES[128:] = True
_WORD_BYTES[[ord("@"), ord("$")]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = text_arrays.LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] < 0x9F) & (data[after] != 0x97)]
    out[after] += 0x20
    return out


def _places(data: np.ndarray, mark: str) -> np.ndarray:
    """Where the bytes of a mark begin."""
    raw = mark.encode()
    found = np.flatnonzero(data[: len(data) - len(raw) + 1] == raw[0])
    for k in range(1, len(raw)):
        found = found[data[found + k] == raw[k]]
    return found


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of runs of letters, digits, ``@`` and ``$``; quotation marks of any
    kind end a word."""
    inside = _WORD_BYTES[data]
    for mark in {m for pair in PAIRS for m in pair}:
        places = _places(data, mark)
        for k in range(len(mark.encode())):
            inside[places + k] = False
    starts, ends = text_arrays.runs(inside, offsets)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def quoted(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each span stands between paired quotation marks of its own line.

    A straight mark opens if an even number of them stands before it on the line. Of two
    different marks the opening one must be the last of both before the span. Either way a
    closing one has to follow on the line.
    """
    breaks = np.union1d(np.flatnonzero(data == 10), offsets)
    line = np.searchsorted(breaks, starts, side="right")
    low = np.maximum(breaks[line - 1], offsets[rows])
    high = np.append(breaks, len(data))[line]

    def between(places: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.searchsorted(places, right) - np.searchsorted(places, left)

    straight = np.flatnonzero(data == 34)
    found = (between(straight, low, starts) % 2 == 1) & (between(straight, ends, high) > 0)
    for opening, closing in PAIRS:
        opens, closes = _places(data, opening), _places(data, closing)
        if not len(opens) or not len(closes):
            continue
        k = np.searchsorted(opens, starts)
        last = np.where(k > 0, opens[np.maximum(k - 1, 0)], -1)
        found |= (last >= low) & (between(closes, last + 1, starts) == 0) & (between(closes, ends, high) > 0)
    return found


class Finder:
    """Terms in texts, spelled right or with one edit; results for words are kept."""

    most_words = 1 << 18

    def __init__(self, model: Model, settings: Settings) -> None:
        self.model, self.settings = model, settings
        self.trie = Trie(model.terms, settings.fuzzy_letters)
        self.exact = self._hashes(model.terms)
        # one edit leaves the first or the last two bytes of a term of four as they are
        self.heads, self.tails = np.zeros(1 << 23, dtype=bool), np.zeros(1 << 23, dtype=bool)
        for term in model.terms:
            raw = term.encode()
            if len(term) >= settings.fuzzy_letters:
                # an edit may add or remove a character of up to four bytes
                sizes = np.arange(max(len(raw) - 4, 2), min(len(raw) + 5, 128))
                self.heads[(raw[0] << 8 | raw[1]) << 7 | sizes] = True
                self.tails[(raw[-2] << 8 | raw[-1]) << 7 | sizes] = True
        self.halves: set[tuple[int, str, str]] = set()
        for term in model.terms:
            if len(term) >= settings.fuzzy_letters:
                half = len(term) // 2
                for size in (len(term) - 1, len(term), len(term) + 1):
                    self.halves |= {(size, "head", term[:half]), (size, "tail", term[half:])}
        self.reach = sorted({len(half) for _, _, half in self.halves})
        self.known: dict[str, bool] = {}

    def _near(self, word: str) -> bool:
        """One edit leaves a term's first or second half whole; the automaton decides."""
        size = len(word)
        if not any((size, "head", word[:k]) in self.halves or (size, "tail", word[-k:]) in self.halves for k in self.reach):
            return False
        if word not in self.known:
            if len(self.known) > self.most_words:
                self.known.clear()
            self.known[word] = word not in self.model.clean and self.trie.near(word) is not None
        return self.known[word]

    @staticmethod
    def _hashes(terms: list[str]) -> np.ndarray:
        raw = [t.encode() for t in terms]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        starts = ends - np.array([len(r) for r in raw], dtype=np.int64)
        return np.sort(text_arrays.hash_spans(np.frombuffer(b"".join(raw), dtype=np.uint8), starts, ends))

    def _reported(self, data: np.ndarray, start: int, end: int, low: int, high: int) -> bool:
        """Whether a reporting word stands in the window around a hit."""
        reach = self.settings.window
        around = data[max(low, start - reach) : start].tobytes() + b" " + data[end : min(high, end + reach)].tobytes()
        return not _REPORTS.isdisjoint(around.decode("utf-8", "ignore").split())

    def features(self, column: pa.Array) -> np.ndarray:
        """(rows, 4): hits that are exact, misspelled, quoted, reported, as log(1 + x).

        A hit counts once: quoted if it stands in a quotation, else reported if a reporting
        word is near, else by its spelling.
        """
        out = np.zeros((len(column), 4))
        if not len(self.exact):
            return out
        for low, high, data, offsets in text_arrays.row_groups(column):
            if not len(data):
                continue
            data = lowered(data)
            starts, ends, rows = words(data, offsets)
            hashes = text_arrays.hash_spans(data, starts, ends)
            at = np.searchsorted(self.exact, hashes).clip(max=len(self.exact) - 1)
            exact = self.exact[at] == hashes
            hits = np.concatenate([np.flatnonzero(exact), self._misspelled(data, starts, ends, hashes, exact)]).astype(np.int64)
            kinds = np.where(exact[hits], 0, 1)
            kinds[quoted(data, offsets, starts[hits], ends[hits], rows[hits])] = 2
            for n in np.flatnonzero(kinds < 2):
                k, row = hits[n], rows[hits[n]]
                if self._reported(data, int(starts[k]), int(ends[k]), int(offsets[row]), int(offsets[row + 1])):
                    kinds[n] = 3
            np.add.at(out, (low + rows[hits], kinds), 1)
        return np.log1p(out)

    def _misspelled(self, data, starts, ends, hashes, exact) -> np.ndarray:
        size = ends - starts
        able = np.flatnonzero((size >= 2) & (size < 128) & ~exact)
        first, last = starts[able], ends[able]
        head = (data[first].astype(np.int64) << 8 | data[first + 1]) << 7 | size[able]
        tail = (data[last - 2].astype(np.int64) << 8 | data[last - 1]) << 7 | size[able]
        able = able[self.heads[head] | self.tails[tail]]
        distinct, example, which = np.unique(hashes[able], return_index=True, return_inverse=True)
        near = np.zeros(len(distinct), dtype=bool)
        for k, at in enumerate(able[example]):
            near[k] = self._near(data[starts[at] : ends[at]].tobytes().decode("utf-8", "ignore"))
        return able[near[which]]


def _unlike(rows: DataFrame) -> DataFrame:
    """One row (toxic, body) of those that share their smallest shingle, as near copies do:
    a word of one much copied text is no term."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(s[:1].view(np.int64).sum()) for s in shingle_sets(batch.column("body"), Shingling(words=5))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["toxic", "body", "least"])

    marked = rows.mapInArrow(work, "toxic int, body string, least long")
    return marked.groupBy("least").agg(F.min_by(F.struct("toxic", "body"), F.xxhash64("body")).alias("row")).select("row.*")


def _word_table(sample: DataFrame) -> DataFrame:
    """(word, toxic, docs, first_half): in how many texts of the sample a word stands, and
    whether in a clean one of its first half."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, halves = batch.column("toxic").to_pylist(), batch.column("half").to_pylist()
            for low, high, data, offsets in text_arrays.row_groups(batch.column("body")):
                data = lowered(data) if len(data) else data
                starts, ends, rows = words(data, offsets)
                blob, cuts = data.tobytes(), np.searchsorted(rows, np.arange(high - low + 1))
                found: dict[bytes, list[int]] = {}
                for row in range(high - low):
                    own = {blob[starts[k] : ends[k]] for k in range(cuts[row], cuts[row + 1])}
                    for word in own:
                        seen = found.setdefault(word, [0, 0, False])
                        seen[0] += labels[low + row]
                        seen[1] += 1
                        seen[2] |= not labels[low + row] and not halves[low + row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("utf-8", "ignore") for w in found], pa.string()),
                     pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64()),
                     pa.array([v[2] for v in found.values()], pa.bool_())],
                    names=["word", "toxic", "docs", "first_half"])

    rows = sample.mapInArrow(work, "word string, toxic long, docs long, first_half boolean")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"), F.max("first_half").alias("first_half"))


def _fitted(features: np.ndarray, labels: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn a little towards ``start``; a hit never
    lowers a score."""
    rows = np.column_stack([np.ones(len(features)), features])
    weights = start.copy()
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - chance) - 0.5 * (weights - start)
        curve = (rows * (chance * (1 - chance))[:, None]).T @ rows + 0.5 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        weights[1:] = np.maximum(weights[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    """A lexicon and weights from labelled rows; of repeated labels the highest counts.

    About ``sample`` labelled rows are taken by a hash of their id. Words of toxic texts that
    clean ones hardly hold become terms. The weights are fitted on the features of the same
    rows, four numbers each.
    """
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    size = known.count()
    if not size:
        return Model()
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(max(1, min(1 << 20, settings.sample * (1 << 20) // size)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    half = F.pmod(F.xxhash64("body", F.lit(1)), F.lit(2))
    labelled = rows.join(known.filter(share), "id").filter("body is not null").select("toxic", "body")
    sample = stored(_unlike(labelled).select("toxic", "body", half.alias("half")))
    table = stored(_word_table(sample))
    toxic_texts = sample.agg(F.sum("toxic")).first()[0] or 0
    least = max(settings.least_docs, settings.least_part * toxic_texts)
    chosen = (
        table.filter((F.col("toxic") >= least) & (F.col("toxic") >= settings.least_share * F.col("docs"))
                     & (F.char_length("word") >= settings.least_letters) & F.col("word").rlike("^[^0-9]+$"))
        .orderBy(F.desc("toxic"), "word").limit(settings.most_terms).select("word")
    )
    terms = sorted(r["word"] for r in chosen.collect())
    if not terms:
        return Model()
    trie = Trie(terms, settings.fuzzy_letters)
    reach = F.lit(max(len(t) for t in terms) + 1)
    heads = sorted({t[:2] for t in terms}), sorted({t[-2:] for t in terms})
    alike = F.substring("word", 1, 2).isin(heads[0]) | F.expr("right(word, 2)").isin(heads[1])

    def looks_like(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = set(terms)
        for batch in batches:
            near = [w not in own and trie.near(w) is not None for w in batch.column("word").to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    # clean words a letter from a term: as many as the lexicon has neighbours in use
    seen = table.filter((F.col("docs") > F.col("toxic")) & alike & (F.char_length("word") <= reach))
    near = seen.select("word", "first_half").mapInArrow(looks_like, "word string, first_half boolean").collect()
    model = Model(terms, {r["word"] for r in near})
    # weights are fitted on texts that did not tell which words are clean
    part = Model(terms, {r["word"] for r in near if r["first_half"]})

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(part, settings)
        for batch in batches:
            found = finder.features(batch.column("body"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(found[:, k]) for k in range(4)]], names=["toxic", *kinds])

    kinds = ["exact", "near", "quoted", "reported"]
    measures = sample.filter("half = 1").select("toxic", "body").mapInArrow(
        measured, "toxic int, exact double, near double, quoted double, reported double").toArrow()
    features = np.column_stack([measures.column(k).to_numpy() for k in kinds])
    model.weights = _fitted(features, measures.column("toxic").to_numpy().astype(float), model.weights)
    return model


def predict(docs: DataFrame, model: Model, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxic_score``, between 0 and 1; it replaces a column of that name.

    Defined results: a null or empty text has no hit and the score of such texts. All other
    columns and all rows stay. Without any labels no term is known and all scores are low.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != "toxic_score"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, settings)
        for batch in batches:
            value = np.clip(finder.features(batch.column(text_col)) @ shared.value.weights[1:] + shared.value.weights[0], -30, 30)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(1 / (1 + np.exp(-value)))], names=[*others, "toxic_score"])

    kept = docs.select(*[F.col(f"`{c}`") for c in others])
    return kept.mapInArrow(work, kept.withColumn("toxic_score", F.lit(0.0)).schema)


def scored_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from labels that are not held out."""
    fold = remainder(F.col("doc_id"), 3)
    model = train(docs, labels.filter(fold != 1), settings)
    rows = docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model, settings).select(
        "doc_id", "held_out", F.col("toxic_score").alias("score"), (F.col("toxic_score") >= cut).cast("int").alias("predicted"))
