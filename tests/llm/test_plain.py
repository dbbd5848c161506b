"""Some hundred planted rows, held against plain Python versions of the operators."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from outagelens import session
from outagelens.llm import language_id, mixing, ngram_join, packing, pii, signature_tree, token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
SPACE = "[\\x20\\x09-\\x0D]+"


def planted():
    """(doc_id, text, lang, source): two languages, exact and near copies, personal data,
    added tokens, symbols, short and empty texts, null ids."""
    draw = random.Random(7)
    vocabulary = {"en": [f"{a}ing{b}" for a in "wrstl" for b in "abcdefgh"], "de": [f"{a}schä{b}" for a in "kmnpz" for b in "uvwxyzio"]}
    rows = []
    for k in range(300):
        lang = draw.choice(["en", "de"])
        words = draw.choices(vocabulary[lang], k=draw.randint(1, 120))
        rows.append([k, " ".join(words), lang, draw.choice(["a", "b", "c", None])])
    for k in range(300, 400):
        like = draw.choice(rows[:300])
        words = like[1].split()
        for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):
            words.insert(draw.randint(0, len(words)), "extra")
        rows.append([draw.choice([k, k, k, None]), " ".join(words), like[2], like[3]])
    odd = ["\U0001f600\U0001f680", "12 34 !", "", None, "<|endoftext|>", "half<|startoftext|>way <|endoftext|> on",
           "write to a.b@c.example or 10.0.0.1 and +1 555 010 9999", "card 4111 1111 1111 1111 and 300.1.1.1"]
    rows += [[400 + k, text, None, "b"] for k, text in enumerate(odd)]
    return [(*row, len(row[1] or "")) for row in rows]


ROWS = planted()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


ENCODE = Tokenizer.from_file(PATH).encode


def plain_ids(text):
    return ENCODE(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def shingles(text, n):
    words = [w for w in re.split(SPACE, (text or "").lower()) if w]
    return {tuple(words[k : k + n]) for k in range(max(len(words) - n, 0) + 1)} if words else set()


@pytest.mark.parametrize(("words", "percent", "chunk"), [(4, 85, 1_000_000), (5, 80, 1_000_000), (5, 80, 300), (4, 85, 40)])
def test_ngram_join(docs, words, percent, chunk):
    sets = {r[0]: shingles(r[1], words) for r in ROWS if r[0] is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    got = ngram_join.linked_documents(
        docs, shingling=ngram_join.Shingling(words=words, percent=percent, chunk_tokens=chunk)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(sets[i]), root(i)) for i in ids}
    assert len({root(i) for i in ids}) < len(ids) - 20


def test_a_large_group_without_a_main_component(spark):
    """Documents that share rare words in pairs, so that one group holds many small components."""
    draw = random.Random(23)
    passage = [f"rare{k}" for k in range(40)]
    rows = []
    for k in range(60):
        words = passage[: 20 + k % 20] + [f"own{k}x{j}" for j in range(60)]
        for copy in range(3):
            rows.append((3 * k + copy, " ".join([*words, *draw.choices("ab", k=copy)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk, extra in ((200, 0), (200, 6)):
        got = ngram_join.linked_documents(docs, shingling=ngram_join.Shingling(extra_percent=extra, chunk_tokens=chunk)).collect()
        assert {r.doc_id: r.component_id for r in got} == {i: i - i % 3 for i, _ in rows}


def test_trees_find_what_all_pairs_have():
    draw = np.random.default_rng(3)
    sets, base = [], [np.unique(draw.integers(0, 2**63, 80, dtype=np.uint64)) for _ in range(12)]
    for k in range(400):
        own = base[k % 12]
        sets.append(np.unique(np.concatenate([draw.choice(own, len(own) - k % 15, replace=False), draw.integers(0, 2**63, k % 7, dtype=np.uint64)])))
    which = np.arange(len(sets))
    tree = signature_tree.Tree(sets, which)
    assert len(tree.levels) == 4
    pairs = {(i, j) for i in which for j in which[:i]
             if (n := len(np.intersect1d(sets[i], sets[j]))) * 100 >= 80 * (len(sets[i]) + len(sets[j]) - n)}
    found = signature_tree.join(tree, tree, sets, which, 80)
    assert {(max(p), min(p)) for p in found} <= pairs

    def parts(links):
        labels = signature_tree.Labels(which)
        for i, j in links:
            if labels.of[i] != labels.of[j]:
                labels.unite(i, j)
        return sorted(sorted(m) for m in labels.members.values())

    assert parts(found) == parts(pairs) and len(parts(pairs)) < 60


def buckets(text):
    """Hashed n-grams of one to three characters, at least one of them a letter."""
    codes = [(ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in text]
    for order in (1, 2, 3):
        for k in range(len(codes) - order + 1):
            own, mixed = codes[k : k + order], order
            for code, by in zip(own, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
                mixed = (mixed ^ code) * by & 0xFFFFFFFF
                mixed ^= mixed >> 15
            if any(own):
                yield mixed >> 16


def test_language(docs):
    learned = [r for r in ROWS if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] is not None and r[2]]
    counts, totals, priors = {}, {}, {}
    for lang in ("de", "en"):
        own = counts[lang] = {}
        for text in {r[1] for r in learned if r[2] == lang}:
            for bucket in buckets(text):
                own[bucket] = own.get(bucket, 0) + 1
        totals[lang] = sum(own.values()) + 0.5 * 65_536
        priors[lang] = math.log(sum(r[2] == lang for r in learned))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predicted_languages(docs).collect()}
    for doc_id, text, *_ in ROWS:
        if doc_id is None:
            continue
        found = list(buckets(text or ""))
        if not found:
            assert got[doc_id] == ("und", 0)
            continue
        points = {x: priors[x] + sum(math.log((counts[x].get(b, 0) + 0.5) / totals[x]) for b in found) for x in counts}
        best = max(sorted(points), key=points.get)
        score = 1 / sum(math.exp(p - points[best]) for p in points.values())
        assert got[doc_id] == (best, pytest.approx(score, rel=1e-6))


def covers(pieces, want, size):
    """Every id of every text stands in one piece, and pieces fill sequences without gaps."""
    left, places = {}, {}
    for r in pieces:
        left.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    assert sum(r.length for r in pieces) == sum(len(ids) for _, ids in want)
    for i, ids in want:
        if i is None:
            continue
        at = 0
        for r in sorted(left[i, len(ids)], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)


def test_packing(docs):
    want = [(r[0], [*plain_ids(r[1]), 1]) for r in ROWS]
    covers(packing.pack(docs, PATH, windows=packing.Windows(size=64)).collect(), want, 64)


def test_token_store(spark, docs):
    path = session.table_path(spark, "store")
    token_store.write(docs, path, PATH)
    want = {r[0]: [*plain_ids(r[1]), 2] for r in ROWS if r[0] is not None}
    got = {r.doc_id: r for r in token_store.read(spark, path).collect() if r.doc_id is not None}
    assert {i: (r.n_tokens, r.ids_crc32) for i, r in got.items()} == {i: (len(ids), crc(ids)) for i, ids in want.items()}


def test_mixing(docs):
    words = [len([w for w in re.split(SPACE, r[1] or "") if w]) for r in ROWS]
    sizes = {s: sum(n for n, r in zip(words, ROWS, strict=True) if r[3] == s) for s in ("a", "b", "c", None)}
    weights = dict(zip(sizes, (5, 2, 1, 5), strict=True))
    full, targets = set(), {}
    while not targets or any(targets[s] > 3 * sizes[s] + 1e-6 for s in sizes if s not in full):
        full |= {s for s in targets if targets[s] > 3 * sizes[s]}
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        targets = {s: 3 * sizes[s] if s in full else rest * weights[s] / sum(w for t, w in weights.items() if t not in full) for s in sizes}
    taken = dict.fromkeys(sizes, 0)
    by_id = {r[0]: r for r in ROWS}
    for r in mixing.mix_sizes(docs).collect():
        assert 0 <= r.taken <= 3 * r.size
        source = next(s for s in sizes if sizes[s] == r.source_size)
        assert r.target == pytest.approx(targets[source])
        taken[source] += r.taken
        if r.doc_id is not None:
            assert by_id[r.doc_id][3] == source
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 2 * 64


def test_patterns(docs):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for doc_id, text, *_ in ROWS:
        if doc_id is not None:
            assert got[doc_id].n_email == len(email.findall(text or ""))
    assert (got[406].n_email, got[406].n_ip, got[406].n_phone) == (1, 1, 1)
    assert (got[407].n_card, got[407].n_ip) == (1, 0)


def test_pipeline(spark, docs, tmp_path):
    """run() on the planted rows: what is packed are the ids of the words that the mix takes."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    mixed = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = session.table_path(spark, "planted")
        stage(spark, mixed, "").write.parquet(path)
        mixed = spark.read.parquet(path)
    left = mixed.collect()
    assert not {400, 401, 402, 403} & {r.doc_id for r in left}
    covers(corpus_pipeline.run(spark, str(tmp_path)).collect(), [(r.doc_id, [*plain_ids(r.text), 1]) for r in left], 2048)
