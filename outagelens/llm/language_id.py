"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens.llm import text_arrays

UNKNOWN = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass(frozen=True)
class Settings:
    """``sample``: texts of each language the model learns from, about, chosen by hash;
    ``bits``: of an n-gram's bucket; ``most_order``: characters of an n-gram at most."""

    sample: int = 4_000
    bits: int = 16
    most_order: int = 3
    smoothing: float = 0.5


@dataclass
class Model:
    """Languages, log probabilities (bucket, language) with a zero row 0, and log priors."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    priors: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _letters() -> np.ndarray:
    """Each character of the basic plane in lower case; 0 for what is no letter."""
    table = np.zeros(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        if (char := chr(code)).isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    return table


_table: list[np.ndarray] = []


def buckets(column: pa.Array, settings: Settings) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bucket of each n-gram, its row, rows with a letter) by groups.

    Characters other than letters count as one separator. N-grams without a letter, and
    those that would leave their row, are not there. Buckets count from 1.
    """
    if not _table:
        _table.append(_letters())
    for low, high, data, offsets in text_arrays.row_groups(column):
        codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        begins = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
        wide = codes >= 1 << 16
        letters = _table[0][np.where(wide, 0, codes)]
        if wide.any():
            few, which = np.unique(codes[wide], return_inverse=True)
            letters[wide] = np.array([code if chr(code).isalpha() else 0 for code in few.tolist()], dtype=np.uint32)[which]
        rows = np.repeat(np.arange(high - low), np.diff(begins))
        is_letter = letters > 0
        found, of = [], []
        for order in range(1, settings.most_order + 1):
            size = len(letters) - order + 1
            if size <= 0:
                break
            mixed = np.full(size, order, dtype=np.uint32)
            some = np.zeros(size, dtype=bool)
            for k in range(order):
                mixed = (mixed ^ letters[k : k + size]) * _MIX[k % len(_MIX)]
                mixed ^= mixed >> np.uint32(15)
                some |= is_letter[k : k + size]
            some &= rows[:size] == rows[order - 1 :]
            at = np.flatnonzero(some)
            found.append((mixed[at] >> np.uint32(32 - settings.bits)).astype(np.int64) + 1)
            of.append(rows[at])
        has_letter = np.zeros(high - low, dtype=bool)
        has_letter[rows[is_letter]] = True
        empty = np.zeros(0, dtype=np.int64)
        yield low, high, np.concatenate([*found, empty]), np.concatenate([*of, empty]), has_letter


def _counting(settings: Settings):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in text_arrays.slices(batches):
            languages = batch.column("language").to_pylist()
            for low, high, found, of, _ in buckets(batch.column("body"), settings):
                names, index = np.unique(np.array(languages[low:high], dtype=object).astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    own = counts.setdefault(str(name), np.zeros((1 << settings.bits) + 1, dtype=np.int64))
                    own += np.bincount(found[index[of] == k], minlength=len(own))
        for name, own in counts.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(own[used])],
                names=["language", "bucket", "n"])
    return work


def train(labelled: DataFrame, settings: Settings = Settings(), text_col: str = "text", label_col: str = "lang") -> Model:
    """A model from rows with a text and a language; rows without either teach nothing.

    About ``sample`` distinct texts of each language are taken, by hash, and count once each;
    priors count all rows. N-grams are
    counted in the tasks and summed by language and bucket: that table, bounded by languages
    and buckets, is the model.
    """
    rows = labelled.select(F.col(label_col).alias("language"), F.col(text_col).alias("body")).filter(
        "language is not null and body is not null")
    sizes = (
        rows.groupBy("language", F.xxhash64("body").alias("code")).agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("language").agg(F.sum("copies").alias("size"), F.count(F.lit(1)).alias("texts")).toArrow()
    )
    known = dict(zip(sizes.column("language").to_pylist(), sizes.column("size").to_pylist(), strict=True))
    texts = labelled.sparkSession.createDataFrame(sizes).select("language", "texts")
    share = F.pmod(F.xxhash64("body"), F.lit(1 << 20)) * F.col("texts") < F.lit(settings.sample << 20)
    sample = rows.join(F.broadcast(texts), "language").filter(share).select("language", "body").distinct()
    counts = (
        sample.mapInArrow(_counting(settings), "language string, bucket long, n long")
        .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    languages = sorted(set(counts.column("language").to_pylist()))
    index = {name: k for k, name in enumerate(languages)}
    table = np.zeros(((1 << settings.bits) + 1, len(languages)))
    which = np.array([index[x] for x in counts.column("language").to_pylist()], dtype=np.int64)
    table[counts.column("bucket").to_numpy(), which] = counts.column("n").to_numpy()
    table += settings.smoothing
    weights = np.log(table) - np.log(table[1:].sum(axis=0, keepdims=True)) if languages else table
    weights[0] = 0
    priors = np.log(np.array([known[x] for x in languages], dtype=np.float64)) if languages else np.zeros(0)
    return Model(languages, weights, priors)


def score_rows(column: pa.Array, model: Model, settings: Settings) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each row and its posterior probability."""
    best, scores = [], np.zeros(len(column))
    for low, high, found, of, has_letter in buckets(column, settings):
        if not model.languages:
            best += [UNKNOWN] * (high - low)
            continue
        # rows by buckets is a sparse matrix of counts; its product with the weights
        total = np.stack([np.bincount(of, weights=model.weights[found, k], minlength=high - low)
                          for k in range(len(model.languages))], axis=1) + model.priors
        top = total.argmax(axis=1)
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        scores[low:high] = np.where(has_letter, posterior, 0.0)
        best += [model.languages[k] if some else UNKNOWN for k, some in zip(top, has_letter, strict=True)]
    return best, scores


def predict(docs: DataFrame, model: Model, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, which replace columns of that name.

    Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
    any text if nothing was learned. The score is the posterior probability of the language
    given. All other columns and all rows stay.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_arrays.slices(batches):
            best, scores = score_rows(batch.column(text_col), shared.value, settings)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(best, pa.string()), pa.array(scores)],
                names=[*others, "lang_pred", "lang_score"])

    kept = docs.select(*[F.col(f"`{c}`") for c in others])
    schema = kept.withColumn("lang_pred", F.lit("")).withColumn("lang_score", F.lit(0.0)).schema
    return kept.mapInArrow(work, schema)


def remainder(id_col: Column, of: int) -> Column:
    """crc32 of an id as text, modulo; null for a null id."""
    return F.crc32(id_col.cast("string")) % of


def predicted_languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from documents that are not held out."""
    fold = remainder(F.col("doc_id"), 4)
    model = train(docs.filter(fold != 2), settings)
    rows = docs.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model, settings).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
