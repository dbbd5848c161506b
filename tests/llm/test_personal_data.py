"""Personal data: base spans against plain regular expressions, and what the CRF adds."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from outagelens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()}


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, own in spans.items() for a, b in own)


FILLER = "the of and walk tree river Ünder 日本 house blue (green) [sic] 12 1999 3.5 said, to. go; in".split()
BASE = ["ana.lima@example.org", "x+y%z@a-b.c1.d", "10.0.0.1", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999",
        "+49 30 555-0123", "+12", "a@b", "@x.y", "5500000000000004", "2024-12-3447-14563", "+1.2.3", "q@r.s@t.u", "00000000000000"]
HIDDEN = {
    "email": ["otto.maier @ post-haus.de", "k-42 (at) mx.uni.pt", "j_rowe[at]example[dot]org", "Nina [at] somewhere (dot) net", "info@ example.com", "info @example.com"],
    "card": ["4012.8888.8888.1881", "5105/1051/0510/5100"], "phone": ["(555) 010-4477", "0049 30 5550199", "(021) 5550-7788"],
}


def documents():
    draw = random.Random(31)
    rows = []
    for k in range(500):
        parts = draw.choices(FILLER, k=draw.randint(0, 60))
        for _ in range(draw.choice([0, 0, 1, 3])):
            parts.insert(draw.randint(0, len(parts)), draw.choice(BASE))
        rows.append((k, draw.choice([" ", " ", "\n", "  "]).join(parts)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "@"), (904, "1" * 400), (905, "9 " * 3000), (906, "a@" * 500 + "b.c")]


ROWS = documents()


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    return {r.doc_id: r for r in pii.personal_data(docs).collect()}


def test_base_spans_are_those_of_the_patterns(found):
    assert len(found) == len(ROWS)
    for doc_id, text in ROWS:
        row, want = found[doc_id], plain(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(want[k]) for k in PATTERNS]
        assert row.base_sha256 == hashlib.sha256(told(want).encode()).hexdigest()
        spans = set(filter(None, row.spans.split(",")))
        assert spans >= set(filter(None, told(want).split(",")))


def test_filler_has_no_added_spans(found):
    added = [s for doc_id, text in ROWS for s in set(found[doc_id].spans.split(",")) - set(told(plain(text)).split(","))]
    assert len(added) <= 5, added  # runs of digits that the patterns pass over, within longer ones


def test_spellings_that_the_patterns_miss(spark):
    """Of 220 hidden items at least nine in ten are found, whole and of their kind."""
    draw = random.Random(5)
    rows, want = [], {}
    for k in range(220):
        kind = draw.choice(list(HIDDEN))
        item = draw.choice(HIDDEN[kind])
        before, after = (draw.choices([w for w in FILLER if w.isalpha()], k=draw.randint(1, 12)) for _ in range(2))
        text = " ".join([*before, item, *after])
        start = len(" ".join(before)) + 1
        rows.append((k, text))
        want[k] = f"{kind}:{start}:{start + len(item)}"
        assert not any(plain(text)[kind])
    docs = spark.createDataFrame([*ROWS, *((1000 + k, t) for k, t in rows)], "doc_id long, text string")
    crf = pii.train(pii.labelled_table(spark.createDataFrame(ROWS, "doc_id long, text string")))
    got = {r.doc_id: r.spans.split(",") for r in pii.find(docs, crf).collect()}
    hits = sum(want[k] in got[1000 + k] for k in want)
    assert hits >= 0.9 * len(want), (hits, [(rows[k][1], want[k], got[1000 + k]) for k in want if want[k] not in got[1000 + k]][:5])


def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(4)
    raw = "x 12 a@b 3 y 4 (at) 55 z\n7".encode()
    words = pii.shaped(np.frombuffer(raw, dtype=np.uint8), np.array([0, 12, len(raw)]))
    move, first = pii._allowed()
    crf = pii.Crf(draw.normal(size=(pii.N_FEATURES, pii.TAGS)), draw.normal(size=move.shape) + move, draw.normal(size=first.shape) + first)
    index = pii.features(words)
    for row in (0, 1):
        own = np.flatnonzero(words.row == row)
        score = crf.emit[index[own]].sum(axis=1) + np.where(words.open[own], 0.0, -1e9)[:, None] * (np.arange(pii.TAGS) > 0)
        ahead, back = [score[0] + crf.first], [np.zeros(pii.TAGS)]
        for t in range(1, len(own)):
            ahead.append(np.logaddexp.reduce(ahead[-1][:, None] + crf.move, axis=0) + score[t])
        for t in range(len(own) - 1, 0, -1):
            back.append(np.logaddexp.reduce(crf.move + score[t] + back[-1], axis=1))
        total = np.logaddexp.reduce(ahead[-1])
        chance = np.exp(np.array(ahead) + np.array(back[::-1]) - total)
        tags = np.zeros(len(words.row), dtype=np.int64)
        tags[own] = np.where(words.open[own], 1, 0)
        found = pii.marginals(crf, words, tags)
        open_words = own[words.open[own]]
        assert found[open_words] == pytest.approx(chance[words.open[own], 1], abs=1e-9)


def test_long_text_with_many_tagged_words():
    crf = pii.train_rows([])
    text = "write to otto.maier (at) example.org or 4012.8888.8888.1881 and so on. é" * 2_000
    base, spans = next(pii.all_spans(pa.array([text]), crf))
    assert base == [[], [], [], []] and len(spans[0]) >= 1_990 and len(spans[2]) >= 1_990
    assert text[spans[0][-1][0] : spans[0][-1][1]] == "otto.maier (at) example.org"
