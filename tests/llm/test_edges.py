"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from outagelens import session
from outagelens.llm import (
    embedding_dedup,
    exact_dedup,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    token_store,
    tokens,
    toxicity,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain_ids(odd):
    encode = Tokenizer.from_file(PATH).encode
    return [(r.doc_id, encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_exact_dedup(odd, none):
    rows = exact_dedup.content_classes(odd, keep="max").collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].keep_id, by_id[1].group_size, by_id[1].kept) == (2, 2, False)
    assert (by_id[3].keep_id, by_id[4].kept, by_id[3].text_sha256) == (4, True, hashlib.sha256(b"").hexdigest())
    assert by_id[7].group_size == 2 and by_id[7].kept
    assert by_id[None].keep_id is None and by_id[None].kept
    assert exact_dedup.content_classes(odd).filter("doc_id = 2").first().keep_id == 1
    assert exact_dedup.content_classes(none).count() == 0


def test_line_dedup(odd, none):
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(odd).collect()}
    assert (rows[1].n_lines, rows[1].n_removed) == (4, 0)
    assert (rows[2].text, rows[2].n_removed) == ("", 4)
    assert rows[3].text is None and rows[3].n_lines == 0
    assert rows[4].text == "" and rows[5].n_removed == 0
    assert rows[1].hash == "x" and rows[1].row == 0
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_mixing(odd, none):
    rows = mixing.mix_sizes(odd).collect()
    assert len(rows) == 10
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
    assert sorted(tuple(r) for r in mixing.mix_sizes(odd.repartition(7)).collect() if r[0]) == sorted(tuple(r) for r in rows if r[0])
    mixed = mixing.mixed_documents(odd)
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert words == sum(r.taken for r in rows)
    assert mixed.columns == odd.columns
    assert mixing.mix_sizes(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_targets_stop_at_three_times_the_source(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 500), ("c", 500), (None, 90)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    # weights 5, 2, 1, 5 of 1100; a stops at 30, the null source at 270; 800 are left for 2 and 1
    assert got["a"] == 30 and got[None] == 270
    assert got["b"] == pytest.approx(800 * 2 / 3) and got["c"] == pytest.approx(800 / 3)


def test_packing(odd, none, plain_ids):
    windows = packing.Windows(size=16)
    rows = packing.pack(odd, PATH, windows=windows).collect()
    left = [(i, [*ids, 1]) for i, ids in plain_ids]
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in left)
    for r in rows:
        assert any(r.doc_id == i and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for i, ids in left)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 16 and (at == 16 or at & (at - 1) == 0)
    assert packing.pack(none, PATH).count() == 0


def test_token_store(spark, odd, none, plain_ids):
    path = session.table_path(spark, "store")
    token_store.write(odd, path, PATH, form=token_store.Format(block_ids=40, file_ids=5_000))
    rows = token_store.read(spark, path).orderBy("start").collect()
    want = sorted([(i if i is not None else -1, len(ids) + 1, crc([*ids, 2])) for i, ids in plain_ids])
    assert [(-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows] == want
    assert [r.start for r in rows] == [sum(w[1] for w in want[:k]) for k in range(len(want))]
    ids = {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}
    assert ids[8] == [*dict(plain_ids)[8], 2]
    empty = session.table_path(spark, "store")
    token_store.write(none, empty, PATH)
    assert token_store.read(spark, empty).count() == 0


def test_ngram_join(odd, none):
    rows = ngram_join.linked_documents(odd).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 10
    assert by_id[2].component_id == 1 and by_id[7].component_id == 7
    assert (by_id[3].n_shingles, by_id[3].component_id, by_id[5].n_shingles) == (0, 3, 0)
    assert by_id[8].n_shingles == 1 and by_id[6].n_shingles == 3
    assert by_id[None].component_id is None
    assert ngram_join.linked_documents(none).count() == 0


def test_language(odd, none):
    rows = {r.doc_id: r for r in language_id.predicted_languages(odd).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == "und"
    assert rows[3].score == 0 and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[1].held_out == (zlib.crc32(b"1") % 4 == 2) and rows[None].held_out is False
    assert language_id.predicted_languages(none).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    rows = toxicity.scored_documents(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored_documents(none, labels.limit(0)).count() == 0


def test_toxicity_spelling_and_context(spark):
    model = toxicity.Model(["moronic"], {"moronix"}, np.array([-3.0, 8.0, 6.0]))
    texts = ["you moronic fool", "you moroniic fool", "you moronix fool", 'he wrote "moronic" here', "nothing", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    score = {r.doc_id: r.toxic_score for r in toxicity.predict(docs, model).collect()}
    assert score[0] > 0.7 and score[1] > 0.7
    assert score[2] == score[4] == score[5] < 0.1
    assert score[3] < 0.5


def test_personal_data(odd, none):
    rows = {r.doc_id: r for r in pii.personal_data(odd).collect()}
    assert (rows[7].n_email, rows[7].n_phone, rows[7].n_ip, rows[7].n_card) == (1, 1, 0, 0)
    assert rows[7].spans == "email:5:18,phone:23:40"
    assert rows[3].spans == "" and rows[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(none).count() == 0


def test_embeddings(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [float("nan"), 1.0], 1), (9, [1.0, 0.0, 0.0], 1),
        (10, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (11, [], 1), (12, [1e200, 1e190], 1), (13, [0.0, 1.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert {i: got[i].n_links for i in (1, 2, 3, 12)} == {1: 3, 2: 3, 3: 3, 12: 3}
    assert {got[i].component_id for i in (1, 2, 3, 12)} == {1}
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 13):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None and not got[None].kept
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [7, 1_024])
def test_vectors_in_several_blocks_and_cells(spark, block):
    draw = np.random.default_rng(8)
    rows, key = [], 0
    for label, dim, clusters in ((1, 16, 6), (2, 16, 40), (3, 2, 5), (4, 1, 2), (1, 5, 4)):
        for centre in draw.normal(size=(clusters, dim)):
            for _ in range(int(draw.integers(1, 14))):
                rows.append((key, (centre + draw.normal(size=dim) * draw.choice([0.0, 0.1, 0.25])).tolist(), label))
                key += 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    parent, links = list(range(key)), [0] * key

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a, x in rows:
        for j, b, y in rows[:i]:
            if x == y and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                links[i] += 1
                links[j] += 1
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    got = embedding_dedup.near_vectors(frame, near=embedding_dedup.Near(block=block)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (links[i], root(i)) for i in range(key)}


def test_null_id_row_before_equal_texts(spark):
    text = "one two three four five six seven eight nine ten"
    near = "zero " + text
    rows = spark.createDataFrame([(None, text), (5, text), (9, text), (4, near), (7, "another text that is alone")],
                                 "doc_id long, text string").coalesce(1)
    got = [(r.doc_id, r.component_id) for r in ngram_join.linked_documents(
        rows, shingling=ngram_join.Shingling(words=4, percent=85)).collect()]
    assert sorted(got, key=str) == [(4, 4), (5, 4), (7, 7), (9, 4), (None, None)]


SPECIAL = [
    "hello <|endoftext|> world", "wo<|endoftext|>rd", "<|startoftext|><|endoftext|>", "it's <|startoftext|>'s caf\u00e9",
    "<|ENDOFTEXT|> <|endoftext", "e<|endoftext|>\u0301 x", "<|<|endoftext|>|>", "plain", "", None,
]


def test_added_tokens_of_the_file_are_kept(spark):
    encode = Tokenizer.from_file(PATH).encode
    want = [encode(t or "", add_special_tokens=False).ids for t in SPECIAL]
    assert want[0] == [3306, 49407, 1002]
    got = tokens.Encoder(PATH).rows(pa.array(SPECIAL * 300))
    assert [ids.tolist() for ids in got] == want * 300
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    for r in packing.pack(docs, PATH).collect():
        own = [*want[r.doc_id], 1]
        assert r.doc_tokens == len(own) and r.ids_crc32 == crc(own[r.start : r.start + r.length])
    path = session.table_path(spark, "store")
    token_store.write(docs, path, PATH)
    assert {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()} == {k: [*ids, 2] for k, ids in enumerate(want)}


def test_symbols_beyond_the_basic_plane_are_no_letters(spark):
    texts = ["the cat sat on the mat", "der hund lag auf dem bett", "\U0001f600\U0001f680 \U0001d7d8", "\U00020000\U00020001",
             "the\U0001f600cat", "the cat"]
    docs = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(zip(texts, ["en", "de"] + [None] * 4, strict=True))],
                                 "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert (rows[2].lang_pred, rows[2].lang_score) == ("und", 0)
    assert rows[3].lang_pred != "und" and rows[3].lang_score > 0
    assert (rows[4].lang_pred, rows[4].lang_score) == (rows[5].lang_pred, rows[5].lang_score)


def test_shards_of_the_mix(spark):
    mix = mixing.Mix(block_words=4, shard_slots=8)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(8)), "abc"[k % 3]) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = {(r.shard, r.source): r.slots for r in mixing.shard_counts(docs, mix).collect()}
    assert len({shard for shard, _ in counts}) > 5
    words, by_doc = {}, {}
    for r in mixing.mixed_documents(docs, mix, shard_col="part").collect():
        n = len(r.text.split())
        words[r.part, r.source] = words.get((r.part, r.source), 0) + n
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + n
    assert words == {key: n * 4 for key, n in counts.items()}
    assert by_doc == {r.doc_id: r.taken for r in mixing.mix_sizes(docs, mix).collect() if r.taken}


def test_copies_of_a_text_teach_the_language_once(spark):
    rows = [(f"some english words {k} {chr(97 + k % 26) * 3}", "en") for k in range(300)]
    rows += [(f"ein paar deutsche w\u00f6rter {chr(97 + k % 26) * 4}", "de") for k in range(300)]
    distinct = spark.createDataFrame(sorted(set(rows)), "text string, lang string")
    settings = language_id.Settings(sample=20)
    want = language_id.train(distinct, settings)
    for copied in ("some english words 1 bbb", rows[7][0]):
        docs = distinct.union(spark.createDataFrame([(copied, "en")] * 400, "text string, lang string"))
        got = language_id.train(docs, settings)
        assert np.array_equal(got.weights, want.weights)
        assert got.priors[got.languages.index("en")] == np.log(700)
