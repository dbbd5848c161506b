"""Scores of the toxicity operator against plain Python: edit distance, paired marks, weights."""

import math
import random
import re

import numpy as np
import pytest

from outagelens.llm import toxicity

TERMS = ["scumbag", "moronic", "dreckig", "vermin", "rat"]
MODEL = toxicity.Model(TERMS, {"moronie"}, np.array([-3.0, 8.0, 6.0, 1.0, 4.0]))
PAIRS = {"“": "”", "„": "“", "«": "»", "‘": "’"}
MARKS = "“”„«»‘’"


def one_edit(a, b):
    """Levenshtein distance 1, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1] == 1


def in_quotation(line, start, end):
    before, after = line[:start], line[end:]
    if before.count('"') % 2 and '"' in after:
        return True
    for opening, closing in PAIRS.items():
        at = before.rfind(opening)
        if at >= 0 and closing not in before[at + 1 :] and closing in after:
            return True
    return False


def plain_score(text):
    counts = [0, 0, 0, 0]
    low = (text or "").lower()
    raw, offset = low.encode(), 0
    for line in low.split("\n"):
        for hit in re.finditer(r"[a-z0-9@$À-퟿]+", re.sub(f"[{MARKS}]", " ", line)):
            word = hit.group()
            exact = word in TERMS
            if not exact and (word in MODEL.clean or not any(len(t) >= 5 and one_edit(word, t) for t in TERMS)):
                continue
            start, end = (len(low[: offset + at].encode()) for at in hit.span())
            around = (raw[max(0, start - 60) : start] + b" " + raw[end : end + 60]).decode(errors="ignore")
            if in_quotation(line, hit.start(), hit.end()):
                counts[2] += 1
            elif set(around.split()) & set(toxicity.REPORTS):
                counts[3] += 1
            else:
                counts[0 if exact else 1] += 1
        offset += len(line) + 1
    value = MODEL.weights[0] + sum(w * math.log1p(n) for w, n in zip(MODEL.weights[1:], counts, strict=True))
    return 1 / (1 + math.exp(-value))


def scores(spark, texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string").repartition(3)
    return {r.doc_id: r.toxic_score for r in toxicity.predict(docs, MODEL).collect()}


def test_scores_are_those_of_plain_python(spark):
    draw = random.Random(9)
    words = ["you", "the", "people", "moronic", "moroniic", "moronie", "moronix", "scumbg", "scumbag", "Vermin", "DRECKIG", "rat", "rats",
             "said", "quoted", "wrote", "far", "away", "walk", "scumbags", "vermn", "vermiin", "mor0nic"]
    texts = [None, "", "\n", '"', "rat"]
    for _ in range(400):
        parts = []
        for _ in range(draw.randint(1, 40)):
            parts.append(draw.choice(words))
            if draw.random() < 0.25:
                parts.append(draw.choice(['"', '"', "“", "”", "„", "«", "»", "‘", "’", "\n", ".", ","]))
        texts.append(draw.choice([" ", " ", ""]).join(f"{p} " if p.isalpha() else p for p in parts))
    found = scores(spark, texts)
    for k, text in enumerate(texts):
        assert found[k] == pytest.approx(plain_score(text), abs=1e-9), text


def test_quotations_score_below_abuse_between_them(spark):
    texts = [
        'she spoke "hello" you scumbag and "bye" to all', '"you scumbag" he shouted', "you scumbag", "„du dreckig“ rief er",
        "“you scumbag” he shouted", 'a stray " mark\nyou scumbag and another " mark', "’tis a scumbag’s way", "he wrote that a scumbag ran",
    ]
    found = scores(spark, texts)
    assert found[0] == found[2] == found[5] == found[6] > 0.9
    assert found[1] == found[3] == found[4] < 0.1
    assert found[1] < found[7] < found[2]


def test_long_texts_and_many_hits(spark):
    text = ("you scumbag and " * 3000 + '"quoted scumbag" ') * 3
    assert scores(spark, [text])[0] == pytest.approx(plain_score(text), abs=1e-9)


def test_marks_that_split_words():
    data = np.frombuffer("„rat“ «rat» rat’s é”rat".encode(), dtype=np.uint8)
    starts, ends, _ = toxicity.words(data, np.array([0, len(data)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["rat", "rat", "rat", "s", "é", "rat"]
