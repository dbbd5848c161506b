"""Periodic runs, chat formatting and conversation repair against plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from outagelens.llm import chat_format, conversation_repair, periodic_runs, queries, text_arrays

SPACE = "[\\x20\\x09-\\x0D]+"
CONTROL = f"{chat_format.END}{chat_format.START}assistant ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32(text.encode())


# ---- periodic runs ------------------------------------------------------------------------


def plain_runs(words, least=6, times=4):
    """(start, length, period) by trying every period at every place."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i : i + length]
            if j > i and length >= max(least, times * q) and not any(
                    stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def with_tail(doc_id, words):
    h = crc(str(doc_id)) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def plain_row(words):
    runs = plain_runs(words)
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in dropped)))


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (4, 3), (1, 2), (9, 2)])
def test_runs_of_random_rows(least, times):
    draw = random.Random(least * 10 + times)
    for _ in range(300):
        rows = []
        for _ in range(draw.randint(1, 5)):
            row = draw.choices(range(draw.randint(1, 3)), k=draw.randint(0, 40))
            rows.append(row + row[-draw.randint(1, 5) :] * draw.randint(0, 6))
        codes = text_arrays.mix(np.array([w for row in rows for w in row], dtype=np.uint64) + np.uint64(3))
        offsets = np.append(0, np.cumsum([len(row) for row in rows]))
        found = periodic_runs.find_runs(codes, offsets, periodic_runs.Repeats(least, times)).tolist()
        assert found == [[k, *run] for k, row in enumerate(rows) for run in plain_runs(row, least, times)]


def test_large_classes_are_merged_whole():
    """Two long stretches of one word: classes of many places meet."""
    words = ["a"] * 120 + ["b"] + ["a"] * 100 + ["c"] + ["a", "b"] * 90 + ["d"] + ["a", "b"] * 70
    codes = text_arrays.mix(np.array([ord(w) for w in words], dtype=np.uint64))
    found = periodic_runs.find_runs(codes, np.array([0, len(words)]))
    assert [tuple(r[1:]) for r in found.tolist()] == plain_runs(words)


def check_runs_query(spark, rows, folder):
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", queries.F.lit(1)).withColumn(
        "runs", queries.F.lit("x")).repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, str(folder)).collect()), key=str)
    assert got == sorted(((i, *plain_row(with_tail(i, plain_words(t)))) for i, t in rows), key=str)
    return got


def test_runs_query_on_planted_rows(spark, tmp_path):
    draw = random.Random(11)
    rows = [(k, " ".join(draw.choices("abcde", k=draw.randint(0, 90)))) for k in range(150)]
    rows += [(200 + k, " \t".join([f"w{j}" for j in range(k)] * draw.randint(1, 9)) + "\n") for k in range(30)]
    rows += [(300, None), (301, ""), (302, " \n\x0b\x0c\r "), (303, "ha " * 1500), (304, "one two " * 800), (None, "x " * 9),
             (None, None), (305, "é " * 8 + "   "), (7, "same row " * 4), (7, "same row " * 4)]
    rows += [(400 + k, " ".join(f"v{j}" for j in range(k))) for k in range(40)]
    got = check_runs_query(spark, rows, tmp_path)
    assert sum(r[1] > 0 for r in got) > 30


def test_runs_query_on_whole_tables(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = check_runs_query(spark, rows, tmp_path)
    assert len(got) == 200 and sum(r[1] > 0 for r in got) > 5


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([("x", "so  so so so so so it goes"), ("y", None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in rows["x"].runs] == [(0, 6, 1)] and rows["x"].collapsed == "so it goes"
    assert (rows["y"].n_words, rows["y"].runs, rows["y"].collapsed) == (0, [], "")
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# ---- chat formatting ----------------------------------------------------------------------


def in_order(rows):
    """Rows of each conversation by turn, nulls first, then role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    return {c: [(t if has else None, r, x) for has, t, r, x in sorted(own)] for c, own in convs.items()}


def odd_rows():
    draw = random.Random(3)
    texts = ["", "plain.", "  ", "<|im_end|>", "<\\|im_sep|> <", "|im_start|>x", "<|", "<\\\\|\\|", "line\nline\n", "\\", "日本 ü \U0001f600?",
             "end", "Yes!", "Yes! \n", "the same text.", " "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "us\ner", "a|b\\n", "<|im_start|>"]
    rows = []
    for conv in range(120):
        for turn in range(draw.randint(1, 14)):
            number = draw.choice([turn, turn, turn, turn * 3, 2, -4, None])
            rows.append((conv, number, draw.choice(roles), draw.choice(texts)))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    rows += [(500, k, "assistant" if k % 3 else "user", f"turn {k}." if k % 5 else "turn") for k in range(700)]
    rows += [(None, 1, "user", "no conversation"), (501, None, None, None), (502, 3, "assistant", None), (503, 2**62, "user", "far."),
             (503, -(2**62), "assistant", "apart"), (504, 1, "user", "x" * 300_000 + ".")]
    return rows


ROWS = odd_rows()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("odd")
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("at", queries.F.lit(0)).withColumn("part", queries.F.lit("y")).withColumn("word", queries.F.lit(None))
    frame.withColumn("word", queries.F.lit("w")).repartition(4).write.parquet(f"{out}/conversations.parquet")
    return str(out)


def plain_chats(rows):
    want = {}
    for conv, own in in_order([(c, t, r or "", x or "") for c, t, r, x in rows]).items():
        loss = "".join(x for _, r, x in own if r == "assistant")
        want[conv] = (len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss))
    return want


@pytest.mark.parametrize("where", ["odd", "/root/testdata/sf0.01"])
def test_chat_query(spark, folder, where):
    sf_dir = folder if where == "odd" else where
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    got = queries.op12_chat_format(spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == plain_chats(rows)
    assert len(got) == len(plain_chats(rows))


def test_template(spark):
    rows = [(1, 1, "system", "Be <|im_end|> brief"), (1, 2, "user", "a"), (1, 3, "user", "b"), (1, 4, "assistant", "c <|"), (1, 5, "assistant", "")]
    convs = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    row = chat_format.read_back(chat_format.formatted(convs)).first()
    assert row.formatted == ("<|im_start|>system\nBe <\\|im_end|> brief<|im_end|>\n<|im_start|>user\na<|im_sep|>b<|im_end|>\n"
                             "<|im_start|>assistant\nc <\\|<|im_sep|><|im_end|>\n")
    assert [row.formatted[s.start : s.end] for s in row.loss_spans] == ["c <\\|", ""]
    assert [tuple(t) for t in row.turns] == [r[2:] for r in rows] and row.loss == ["c <|", ""]
    parts = chat_format.read_back(chat_format.formatted(convs, part_turns=2)).orderBy("part").collect()
    assert [tuple(t) for p in parts for t in p.turns] == [r[2:] for r in rows] and [p.part for p in parts] == [0, 1, 2]
    assert chat_format.formatted(convs.limit(0)).count() == 0


# ---- conversation repair ------------------------------------------------------------------


def cheapest(word):
    """(cost, audit) by a search over places and states in order of cost, then text."""
    after = {"": "u", "s": "u", "a": "u", "u": "a"}
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, at, last = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(word) and last in ("", "a"):
            return cost, audit
        need = after[last]
        steps = [(3, "I", at, need)]
        if at < len(word):
            role, late = word[at].lower(), 3 if word[at].isupper() else 0
            steps.append((4, "D", at + 1, last))
            if role != "d":
                steps.append((3 + late, "R", at + 1, need))
                if role == need or (role == "s" and last == ""):
                    steps.append((late, "K", at + 1, role))
        for more, edit, place, role in steps:
            heapq.heappush(heap, (cost + more, audit + edit, place, role))


def plain_repair(rows):
    """Damage and repair of ``rows``, by conversation."""
    left = []
    for conv, turn, role, text in rows:
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        left += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    want = {conv: (0, 0, 0, 0, 0, 0, "", sha("")) for conv, *_ in rows}
    for conv, own in in_order(left).items():
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, counts, word, initials = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, "", []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            initials.append(role[:1] or "?")
            symbol = initials[-1] if initials[-1] in "uas" else "x"
            if fault:
                counts[fault] += 1
                symbol = symbol.upper() if fault == "truncated" else "d"
            word += symbol
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = cheapest(word)
        out, place = [], 0
        for edit in audit:
            need = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if edit == "K":
                out.append(own[place][1:])
            elif edit != "D":
                out.append((need, "" if edit == "I" else own[place][2]))
            place += edit != "I"
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
        want[conv] = (gaps, *counts.values(), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))
    return want


@pytest.mark.parametrize("where", ["odd", "/root/testdata/sf0.01"])
def test_repair_query(spark, folder, where):
    sf_dir = folder if where == "odd" else where
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, sf_dir).collect()
    want = plain_repair(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    assert {letter for w in want.values() for letter in w[6]} == set("DIKR")


def test_words_meet_a_search(spark):
    draw = random.Random(5)
    words = {"".join(draw.choices("uasxdUASX", k=draw.randint(0, 9))) for _ in range(2_000)} | {"uUaAsSd" * 9}
    frame = spark.createDataFrame([(w,) for w in [*words, *words]], "word string")
    got = conversation_repair.cheapest_edits(frame).collect()
    assert {r.word: (r.cost, r.audit) for r in got} == {w: cheapest(w) for w in words} and len(got) == len(words)


def test_repair_of_few_rows(spark):
    rows = [(1, 1, "system", "Be brief."), (1, 2, "user", "Hi!"), (1, 2, "user", "Hi!"), (1, 4, "user", "cut of"), (2, None, "assistant", None)]
    convs = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: r for r in conversation_repair.repaired(convs).collect()}
    one = got[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal) == (1, 0, 1, 1, 2)
    assert (one.cost, one.audit) == (10, "KKDR")
    assert [tuple(m) for m in one.messages] == [("system", "Be brief."), ("user", "Hi!"), ("assistant", "cut of")]
    assert (got[2].gaps, got[2].blank, got[2].cost, got[2].audit, got[2].messages) == (0, 1, 4, "D", [])
    assert conversation_repair.repaired(convs.limit(0)).count() == 0
    assert conversation_repair.damaged(convs.limit(0)).count() == 0
