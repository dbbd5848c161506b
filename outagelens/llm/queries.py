"""One query for each operator, over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens import session
from outagelens.llm import (
    chat_format,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    token_store,
    toxicity,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.content_classes(_table(spark, sf_dir, "documents"), keep="max")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted_languages(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.table_path(spark, "token-store")
    token_store.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_store.read(spark, path)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(_table(spark, sf_dir, "documents"), shingling=ngram_join.Shingling(words=4, percent=85))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_table(spark, sf_dir, "documents"), mixing.Mix(weights=(5, 2, 1)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), near=embedding_dedup.Near(cosine=0.93))


def _lines(rows: Column, line: Callable[[Column], Column]) -> Column:
    """One line per element of an array, each ended by a line feed."""
    return F.array_join(F.transform(rows, lambda r: F.concat(line(r), F.lit("\n"))), "")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_periodic_tail(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs)
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer"))))
    return found.withColumn("run", greatest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("run.before")).alias("start"),
        F.col("run.length").alias("length"),
        (-F.col("run.finer")).alias("period"),
        F.floor(F.lit(-1000) * F.col("run.length") / F.col("run.finer")).alias("exponent_milli"),
        F.sha2(_lines(F.col("runs"), lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = F.lit(f"{chat_format.END}{chat_format.START}assistant ok")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"))
    convs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    pieces = chat_format.read_back(chat_format.formatted(convs)).select(
        "conv_id", "part",
        F.size("turns").cast("long").alias("n_turns"),
        _lines(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"])).alias("turns"),
        F.array_join("loss", "").alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    whole = pieces.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("part", "turns", "loss"))).alias("parts"),
        F.sum("formatted_chars").alias("formatted_chars"),
    )
    loss = F.array_join("parts.loss", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations")
    found = conversation_repair.repaired(conversation_repair.damaged(convs)).withColumnRenamed("conv_id", "_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    return (
        convs.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
        .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.sha2(F.coalesce(text, F.lit("")), 256).alias("repaired_sha256"))
    )


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_exact_dedup, op3_language_id, op4_packing, op5_token_store, op6_ngram_join,
              op7_toxicity, op8_line_dedup, op9_mixing, op10_embedding_dedup, op11_periodic_runs,
              op12_chat_format, op13_conversation_repair)
}


def _crc(text: str) -> str:
    """CRC-32 of an ASCII text: a step of eight shifts per character."""
    shift = "lambda v, i: xor(v >> 1, 3988292384 * (v & 1))"
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], {shift})))"""


_SEPARATORS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op11_periodic_runs": rf"""
        WITH worded AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {_crc('CAST(doc_id AS VARCHAR)')} AS h
            FROM documents
        ), told AS (
            SELECT *, len(w) AS n, h // 10 AS g FROM worded
        ), cut AS (
            SELECT *, h % 10 = 0 AND n > 0 AS tailed, g % greatest(n, 1) AS a FROM told
        ), parted AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
        words AS (
            SELECT doc_id, n, i, w[CASE WHEN tailed AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
            FROM (SELECT *, unnest(range(n)) AS i FROM parted)
        ), same AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
            ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ), islands AS (
            SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
                SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (
            SELECT doc_id, start, length, q AS period FROM islands r WHERE NOT EXISTS (
                SELECT 1 FROM islands o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.start <= r.start
                AND o.start + o.length >= r.start + r.length)
        ), listed AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
                   arg_min({{'start': start, 'length': length, 'period': period}},
                           {{'l': -length, 's': start, 'p': period}}) AS best
            FROM runs GROUP BY doc_id
        ), dropped AS (
            SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
               1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(k.text, '')) AS collapsed_sha256
        FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept k USING (doc_id)
    """,
    "op12_chat_format": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                             (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        ), placed AS (
            SELECT *, row_number() OVER conv - 1 AS pos, lag(role) OVER conv AS before
            FROM said WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), sized AS (
            SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS body,
                   length(replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '|', '\|')) AS head,
                   pos % 256 = 0 OR before <> role AS opens
            FROM placed
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(body + CASE WHEN opens THEN length('<|im_start|>') + head + 1 + length('<|im_end|>') + 1
                                    ELSE length('<|im_sep|>') END) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op13_conversation_repair": rf"""
        WITH RECURSIVE hit AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) FROM hit WHERE kind <> 0)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                   CASE WHEN role = '' THEN '?' ELSE role[1] END AS initial, rtrim(text, {_SEPARATORS}) AS bare
            FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN bare = '' THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                       WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
            FROM placed
        ), counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), moves(state, wanted, name, after) AS (VALUES ('', 'u', 'user', 'u'), ('s', 'u', 'user', 'u'), ('a', 'u', 'user', 'u'),
                                                      ('u', 'a', 'assistant', 'a')),
        inserted(state, after, cost, audit, said) AS (  -- up to three inserts before a row, or at the end
            SELECT state, state, 0, '', CAST([] AS VARCHAR[]) FROM moves
            UNION ALL SELECT i.state, m.after, i.cost + 3, i.audit || 'I', list_append(i.said, m.name || ':')
            FROM inserted i JOIN moves m ON m.state = i.after WHERE i.cost < 9
        ), best(conv_id, pos, state, way) AS (
            SELECT conv_id, CAST(0 AS BIGINT), '', {{'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])}} FROM counted
            UNION ALL
            SELECT conv_id, pos, state, min(way) FROM (
                SELECT b.conv_id, j.pos, CASE e.edit WHEN 'D' THEN i.after WHEN 'K' THEN j.initial ELSE m.after END AS state,
                       {{'cost': b.way.cost + i.cost + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                                + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 3 ELSE 0 END,
                         'audit': b.way.audit || i.audit || e.edit,
                         'said': list_concat(list_concat(b.way.said, i.said), CASE e.edit WHEN 'D' THEN CAST([] AS VARCHAR[])
                                 WHEN 'K' THEN [j.role || ':' || j.text] ELSE [m.name || ':' || j.text] END)}} AS way
                FROM best b JOIN inserted i ON i.state = b.state JOIN moves m ON m.state = i.after
                JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.pos = b.pos + 1
                JOIN (VALUES ('D'), ('K'), ('R')) e(edit)
                  ON e.edit = 'D' OR (coalesce(j.fault, '') NOT IN ('blank', 'duplicate')
                     AND (e.edit = 'R' OR j.initial = m.wanted OR (j.initial = 's' AND i.after = '')))
            ) GROUP BY conv_id, pos, state
        ), ended AS (
            SELECT c.conv_id, min({{'cost': b.way.cost + i.cost, 'audit': b.way.audit || i.audit,
                                   'said': list_concat(b.way.said, i.said)}}) AS way
            FROM counted c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.pos = c.n
            JOIN inserted i ON i.state = b.state AND i.after IN ('', 'a') GROUP BY c.conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(way.cost, 0) AS BIGINT) AS cost, coalesce(way.audit, '') AS audit,
               sha256(coalesce(array_to_string(way.said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_ngram_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(list_transform(
                range(1, greatest(len(w) - 3, 1) + 1), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' '))) AS s
            FROM worded WHERE len(w) > 0
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * c >= 85 * (p.n + q.n - c)
        ), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (
            SELECT a, b FROM both_ways
            UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
        ), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
    """,
    "op8_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents
        ), windows AS (
            SELECT doc_id, pos, concat_ws(chr(10), line, lead(line) OVER own, lead(line, 2) OVER own) AS body,
                   lead(line, 2) OVER own IS NOT NULL AS whole
            FROM lines WINDOW own AS (PARTITION BY doc_id ORDER BY pos)
        ), ordered AS (
            SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS k
            FROM windows WHERE whole AND trim(body, ' ' || chr(9) || chr(13) || chr(10)) <> ''
        ), covered AS (
            SELECT DISTINCT doc_id, pos + step AS pos FROM ordered, (VALUES (0), (1), (2)) t(step) WHERE k > 1
        ), kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines
            ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
               coalesce(n.n, 0) AS n_lines, coalesce(c.n, 0) AS n_removed
        FROM documents d LEFT JOIN kept k USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) n USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id) c USING (doc_id)
    """,
    "op10_embedding_dedup": """
        WITH RECURSIVE links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y
            ON x.label = y.label AND x.vec_id <> y.vec_id
            AND list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) >= 0.93
        ), reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
        FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
    """,
}
