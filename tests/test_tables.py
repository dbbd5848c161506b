"""Tables, ledger, layer runs and stream ingest on temporary folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from outagelens import session
from outagelens import vocabulary as v
from outagelens.plans import medallion, merging
from outagelens.plans.queries import EVENT_COLUMNS, REGISTRY
from outagelens.sources import landed, ledger, metrics, readers, standins, tables
from outagelens.streaming import landing

SF_DIR = "/root/testdata/sf0.001"
RUN = dt.datetime(2024, 1, 2, 6, tzinfo=dt.timezone.utc)
LATER = RUN + dt.timedelta(days=1)


def by_year(spark, path, column="y"):
    return {r[0]: r[1] for r in spark.read.parquet(path).groupBy(column).count().collect()}


def test_replace_years_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.range(30).select("id", F.when(F.col("id") < 10, 2024).otherwise(2025).alias("y"))
    assert tables.replace_all(both, path, "y") == 30
    fewer = both.filter("id < 15")
    for _ in range(2):
        assert tables.replace_years(fewer, path, "y", [2025]) == {2025: 5}
        assert by_year(spark, path) == {2024: 10, 2025: 5}
    assert tables.replace_years(both.filter("y = 2024"), path, "y", [2024, 2025]) == {2024: 10, 2025: 0}
    assert by_year(spark, path) == {2024: 10}


def test_append_and_full_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).select("id", F.lit(2024).alias("y"))
    tables.append(df, path, "y")
    tables.append(df, path, "y")
    assert by_year(spark, path) == {2024: 10}
    tables.replace_all(df.withColumn("more", F.lit("x")), path, "y")
    assert set(spark.read.parquet(path).columns) == {"id", "more", "y"}


def test_published_table_is_read_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(30).select("id", (F.col("id") % 2 + 2024).cast("int").alias("y"))
    tables.replace_years(df, path, "y", [2024, 2025], sort=["id"])
    try:
        assert tables.publish(spark, path, "outages_by_name", df.schema).count() == 30
        tables.replace_years(df.filter("id < 10"), path, "y", [2024])
        tables.publish(spark, path, "outages_by_name", df.schema)
        found, status = readers.table_or_skip(spark, "outages_by_name")
        assert status == "OK" and found.filter("y = 2024").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS outages_by_name")


def test_write_checked(spark, tmp_path):
    row = tables.write_checked(spark.range(7).withColumn("y", F.lit(1)), str(tmp_path / "t"), "y").first()
    assert tuple(row) == (7, 7, True)


def test_evolving_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    old, new = spark.range(2).toDF("id"), spark.range(3).withColumn("extra", F.lit("x"))
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    stored = readers.read_evolving(spark, path)
    assert stored.count() == 5 and stored.filter("extra IS NULL").count() == 2
    assert readers.union_evolving(old, new).filter("extra IS NULL").count() == 2


def test_csv_keeps_blanks_and_nulls(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n;s;t\n1;  x ;2024-01-01T10:00:00\n2;;\n", encoding="latin-1")
    rows = readers.read_csv_landing(
        spark, str(tmp_path), "n INT, s STRING, t TIMESTAMP_NTZ", sep=";", encoding="ISO-8859-1"
    ).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(1, "  x ", dt.datetime(2024, 1, 1, 10)), (2, None, None)]


def test_missing_table_is_skipped(spark):
    assert readers.table_or_skip(spark, "no_such_table") == (None, "SKIPPED - no_such_table not found")
    spark.range(3).createOrReplaceTempView("some_view")
    assert readers.table_or_skip(spark, "some_view")[0].count() == 3


def test_stamp_styles(spark):
    df = spark.range(1)
    a = readers.stamp(df, "source", "u", RUN, "v1", 2024).first()
    assert (a["_source_url"], a["_source_last_modified"], a["_ano_fonte"]) == ("u", "v1", 2024)
    b = readers.stamp(df, "run", "u", RUN).first()
    assert (b["_run_id"], b["_ingest_date"]) == ("20240102060000", dt.date(2024, 1, 2))
    c = readers.stamp(df, "file", "u", RUN, year=2024).first()
    assert (c["_arquivo_fonte"], c["_ano_referencia"]) == ("u", 2024)


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark).startswith(configured.rstrip("/") if configured else "/tmp/run-")
    assert session.table_path(spark, "x") != session.table_path(spark, "x")


MANIFEST = "fonte STRING, ano INT, url STRING, last_modified STRING"


def test_ledger_life(spark, tmp_path):
    path = str(tmp_path / "ledger")
    manifest = spark.createDataFrame([("interrupcoes", 2024, "a", "v1"), ("interrupcoes", 2025, "b", "v1")], MANIFEST)
    outcome = "fonte STRING, ano INT, num_registros BIGINT, erro STRING"
    first = spark.createDataFrame([("interrupcoes", 2024, 10, None), ("interrupcoes", 2025, 0, "quebrado")], outcome)
    entries = ledger.ledger_entries(manifest, first, RUN)
    ledger.append_entries(entries, path)
    ledger.append_entries(entries, path)
    stored = ledger.read_ledger(spark, path)
    assert stored.filter("status = 'SUCCESS'").count() == 1
    failed = stored.filter("status = 'ERROR'").first()
    assert (failed["num_registros"], failed["last_modified"], failed["mensagem"]) == (0, "", "quebrado")
    assert [r["ano"] for r in ledger.pending(manifest, stored).collect()] == [2025]
    newer = spark.createDataFrame([("interrupcoes", 2024, "a", "v2")], MANIFEST)
    assert ledger.pending(newer, stored).count() == 1
    assert ledger.pending(newer, stored, by_version=False).count() == 0
    summary = ledger.ledger_summary(stored).first()
    assert (summary["sucessos"], summary["total_registros"]) == (1, 10)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Two landed years and one that is missing, taken through all layers."""
    root = str(tmp_path_factory.mktemp("layers"))
    events = standins.events(spark, SF_DIR, *EVENT_COLUMNS, "_ano_fonte")
    for year in (1997, 1998):
        events.filter(F.col("_ano_fonte") == year).drop("_ano_fonte").write.parquet(f"{root}/landing/{year}")
    return root


def _manifest(spark, root, version="v1"):
    return spark.createDataFrame(
        [("interrupcoes", y, f"{root}/landing/{y}", version) for y in (1997, 1998, 1999)], MANIFEST
    )


def test_layers(spark, base):
    bronze, silver, gold, book = (f"{base}/{n}" for n in ("bronze", "silver", "gold", "ledger"))
    entries = medallion.ingest_events(spark, _manifest(spark, base), bronze, book, RUN)
    assert {r["ano"]: r["status"] for r in entries.collect()} == {1997: "SUCCESS", 1998: "SUCCESS", 1999: "ERROR"}
    landed = by_year(spark, bronze, "_ano_fonte")
    assert landed == {r["ano"]: r["num_registros"] for r in ledger.read_ledger(spark, book).filter("status = 'SUCCESS'").collect()}

    # again: only the failed year is tried, nothing doubles
    again = medallion.ingest_events(spark, _manifest(spark, base), bronze, book, LATER)
    assert [r["ano"] for r in again.collect()] == [1999]
    assert by_year(spark, bronze, "_ano_fonte") == landed

    counts = medallion.silver_events(spark, bronze, silver, [1997, 1998], RUN)
    assert counts["bronze"] == sum(landed.values()) == counts["silver"] + counts["duplicatas_removidas"] + counts["excluidos_data_nula"]
    first = by_year(spark, silver, "_ano_fonte")
    medallion.silver_events(spark, bronze, silver, [1998], LATER)
    assert by_year(spark, silver, "_ano_fonte") == first

    result = medallion.gold_outages(spark, silver, gold, [1997, 1998], RUN)
    assert result["segundos_silver"] == result["segundos_gold"]
    stored = spark.read.parquet(gold)
    assert stored.count() == result["linhas"]
    assert {r[0] for r in stored.select("ano_referencia").distinct().collect()} <= {1997, 1998}
    medallion.gold_outages(spark, silver, gold, [1998], LATER)
    assert spark.read.parquet(gold).count() == result["linhas"]

    # a republished file is a new version: kept beside the old in bronze, latest wins in silver
    medallion.ingest_events(spark, _manifest(spark, base, "v2"), bronze, book, LATER)
    assert by_year(spark, bronze, "_ano_fonte") == {y: 2 * n for y, n in landed.items()}
    medallion.silver_events(spark, bronze, silver, [1997, 1998], LATER)
    assert by_year(spark, silver, "_ano_fonte") == first
    assert {r[0] for r in spark.read.parquet(silver).select("_source_last_modified").distinct().collect()} == {"v2"}


def test_unreadable_columns_become_an_error(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/landing")
    manifest = spark.createDataFrame([("interrupcoes", 2024, f"{tmp_path}/landing", "v1")], MANIFEST)
    row = medallion.ingest_events(spark, manifest, f"{tmp_path}/b", f"{tmp_path}/l", RUN).first()
    assert row["status"] == "ERROR" and "linha_vazia" in row["mensagem"]


def test_indicator_tables(spark, tmp_path):
    bronze = standins.indicators(spark, SF_DIR).drop("_tie")
    report = medallion.indicator_tables(spark, bronze, f"{tmp_path}/s", f"{tmp_path}/g", RUN)
    assert {r["status"] for r in report.collect()} == {"PASS"}
    gold = spark.read.parquet(f"{tmp_path}/g")
    assert gold.count() == gold.select("distribuidora", "ano", "mes").distinct().count() > 800
    assert len(gold.columns) == 23


def test_landed_indicators_to_gold(spark, tmp_path):
    landed = standins.indicators(spark, SF_DIR).select(
        F.col("datgeracaoconjuntodados").alias("DatGeracaoConjuntoDados"),
        F.col("ideconjundconsumidoras").alias("IdeConjUndConsumidoras"),
        F.col("dscconjundconsumidoras").alias("DscConjUndConsumidoras"),
        F.col("sigagente").alias("SigAgente"), F.col("numcnpj").alias("NumCNPJ"),
        F.col("sigindicador").alias("SigIndicador"), F.col("anoindice").alias("AnoÍndice"),
        F.col("numperiodoindice").alias("NumPeriodoIndice"),
        F.col("vlrindiceenviado").alias("VlrIndiceEnviado"),
    )
    landed.write.parquet(f"{tmp_path}/landing")
    bronze = f"{tmp_path}/bronze"
    for _ in range(2):
        written = medallion.ingest_indicators(spark, f"{tmp_path}/landing", bronze, [1997, 1998], RUN)
    want = {r[0]: r[1] for r in landed.groupBy("AnoÍndice").count().collect()}
    assert written == {y: want[y] for y in (1997, 1998)} == by_year(spark, bronze, "anoindice")
    extra = ", _fonte_url STRING, _ingest_ts TIMESTAMP, _ingest_date DATE, _run_id STRING"
    stored = readers.read_indicators(spark, bronze, [1998], extra)
    medallion.indicator_tables(spark, stored, f"{tmp_path}/s", f"{tmp_path}/g", RUN)
    gold = spark.read.parquet(f"{tmp_path}/g")
    assert {r[0] for r in gold.select("ano").distinct().collect()} == {1998}
    landed.drop("SigIndicador").write.parquet(f"{tmp_path}/broken")
    with pytest.raises(ValueError, match="sigindicador"):
        medallion.ingest_indicators(spark, f"{tmp_path}/broken", bronze, [1998], RUN)


def test_processed_events(spark):
    bronze = standins.events(spark, SF_DIR, *EVENT_COLUMNS)
    done = medallion.processed_events(bronze, standins.agent_regions(spark, SF_DIR), RUN, "bronze")
    assert len(done.columns) == 36
    assert done.filter("duracao_segundos <= 0 OR num_unidade_consumidora <= 0 OR regiao IS NULL").count() == 0
    assert done.count() == done.select("num_ordem_interrupcao", "num_unidade_consumidora").distinct().count()


def test_stream_reads_each_file_once(spark, base, tmp_path):
    args = (spark, f"{base}/landing/*", v.EVENT_SCHEMA, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", RUN, "NumAno")
    landing.ingest_new_files(*args)
    count = spark.read.parquet(f"{tmp_path}/bronze").count()
    assert count == spark.read.parquet(f"{base}/landing/*").count()
    landing.ingest_new_files(*args)
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == count


def test_dec_analysis(spark, tmp_path):
    from outagelens.operators import compare, conform, indicators

    months = indicators.conjunto_month(
        conform.conform_indicators_long(standins.indicators(spark, SF_DIR)),
        ["ingest_ts_bronze", "_tie"], compare.INDEX_CODES,
    )
    rows = medallion.dec_analysis(standins.events(spark, SF_DIR, *EVENT_COLUMNS), months, f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a")
    assert stored.count() == rows > 0
    assert {r[0] for r in stored.select("alerta").distinct().collect()} <= {
        "OK", "WARNING", "CRITICAL", "NO_REFERENCE", "NO_OBSERVATION"}


def test_queries_leave_the_session_as_it_is(spark):
    now = spark.conf.get("spark.sql.shuffle.partitions")
    REGISTRY["gold_outage_month"](spark, SF_DIR)
    assert spark.conf.get("spark.sql.shuffle.partitions") == now


def test_shared_folder_is_the_warehouse_if_none_is_named(spark):
    folder = session.shared_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert folder.startswith((named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/"))


def test_reused_is_released(spark):
    with session.reused(spark.range(5)) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached


def test_only_the_newest_version_of_a_file_counts(spark):
    rows = [
        (2024, "v1", "a", "old type"), (2024, "v1", "b", "withdrawn"), (2024, "v2", "a", "new type"),
        (2023, None, "c", "no version"), (None, "v1", "d", "no year"),
    ]
    bronze = spark.createDataFrame(rows, "_ano_fonte int, _source_last_modified string, event string, type string")
    kept = {r.event: r.type for r in medallion.newest_version(bronze).collect()}
    assert kept == {"a": "new type", "c": "no version", "d": "no year"}


def test_versions_are_found_without_dealing_rows_by_file(spark, capsys):
    """Rows stay where they are scanned: a table has few files, and their rows would meet in few tasks."""
    rows = [(2024, "v1", "a"), (2023, "v2", "b")]
    schema = "_ano_fonte int, _source_last_modified string, event string"
    medallion.newest_version(spark.createDataFrame(rows, schema)).explain()
    single = capsys.readouterr().out
    assert "Exchange" not in single and "Join" not in single and "Aggregate" not in single
    medallion.newest_version(spark.createDataFrame([*rows, (2024, "v0", "c")], schema)).explain()
    replaced = capsys.readouterr().out
    assert "BroadcastHashJoin" in replaced and "hashpartitioning" not in replaced and "Aggregate" not in replaced


def test_placed_rows_are_not_dealt_again(spark, tmp_path):
    path = tmp_path / "placed"
    rows = spark.range(30).select("id", F.lit(2024).alias("y")).repartition(3)
    written = tables.replace_years_measured(rows, str(path), "y", [2024], placed=True)
    assert written == {2024: {"linhas": 30}} and len(list(path.glob("y=2024/*.parquet"))) == 3


def test_ingested_rows_are_not_dealt_again(spark, base, tmp_path):
    rows, bronze, book = f"{tmp_path}/rows", f"{tmp_path}/bronze", f"{tmp_path}/ledger"
    standins.events(spark, SF_DIR, *EVENT_COLUMNS).repartition(3).write.parquet(rows)
    manifest = spark.createDataFrame([("interrupcoes", 2024, rows, "v1")], MANIFEST)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        medallion.ingest_events(spark, manifest, bronze, book, RUN)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len(list((tmp_path / "bronze").rglob("*.parquet"))) == 3
    assert spark.read.parquet(bronze).count() == spark.read.parquet(rows).count()


def test_quarantine_reads_its_lines_once(spark):
    plan = REGISTRY["csv_quarantine"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_text_is_landed_compressed_in_bounded_files(spark):
    for name in ("scan_csv_landing", "csv_quarantine"):
        files = REGISTRY[name](spark, SF_DIR).inputFiles()
        assert files and all(f.endswith(".lz4") for f in files)
    assert readers.TEXT_FILES["maxRecordsPerFile"] == 250_000


def test_gold_holds_the_events_that_the_steps_leave(spark):
    gold = REGISTRY["gold_outage_month"](spark, SF_DIR).agg(F.sum("total_eventos")).first()[0]
    steps = [r.asDict() for r in REGISTRY["reconcile_steps"](spark, SF_DIR).collect()]
    assert gold in {value for row in steps for value in row.values()}


def test_versions_with_http_dates_are_compared_as_instants(spark):
    old, new = "Wed, 01 Oct 2025 12:00:00 GMT", "Tue, 02 Dec 2025 08:00:00 GMT"
    rows = [
        (2025, "u", old, RUN, "a", "old type"), (2025, "u", old, RUN, "b", "withdrawn"), (2025, "u", new, LATER, "a", "new type"),
        # loaded late, but published earlier
        (2024, "u", new, RUN, "c", "new type"), (2024, "u", old, LATER, "c", "old type"),
        # stamps without an instant: the later load counts
        (2023, "u", "v9", RUN, "d", "old type"), (2023, "u", "v10", LATER, "d", "new type"),
        (2022, "u", None, LATER, "e", "no version"), (2022, "u", old, RUN, "e", "new type"),
        (2021, "u", "2025-10-01 12:00:00.5", RUN, "f", "old type"), (2021, "u", "2025-10-01 12:00:01", RUN, "f", "new type"),
    ]
    bronze = spark.createDataFrame(rows, "_ano_fonte int, _source_url string, _source_last_modified string,"
                                         " _ingest_timestamp timestamp, event string, type string")
    kept = sorted((r.event, r.type) for r in medallion.newest_version(bronze).collect())
    assert kept == [(e, "new type") for e in "acdef"]


def test_republished_http_date_reaches_silver(spark, base, tmp_path):
    bronze, silver, book = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "ledger"))
    for stamp, run in (("Wed, 01 Oct 2025 12:00:00 GMT", RUN), ("Tue, 02 Dec 2025 08:00:00 GMT", LATER)):
        medallion.ingest_events(spark, _manifest(spark, base, stamp), bronze, book, run)
    medallion.silver_events(spark, bronze, silver, [1997, 1998], LATER)
    stamps = {r[0] for r in spark.read.parquet(silver).select("_source_last_modified").distinct().collect()}
    assert stamps == {"Tue, 02 Dec 2025 08:00:00 GMT"}


def test_year_streamed_as_two_files_stays_whole(spark, base, tmp_path):
    events = spark.read.parquet(f"{base}/landing/1997")
    half = F.pmod(F.xxhash64("NumOrdemInterrupcao"), F.lit(2))
    for k in (0, 1):
        part = f"{tmp_path}/landing/{k}"
        events.filter(half == k).coalesce(1).write.parquet(part)
        (file,) = [f"{part}/{n}" for n in os.listdir(part) if n.endswith(".parquet")]
        os.utime(file, (1_700_000_000 + k * 86_400,) * 2)
    landing.ingest_new_files(spark, f"{tmp_path}/landing/*", v.EVENT_SCHEMA, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", RUN, "1997")
    counts = medallion.silver_events(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", [1997], RUN)
    assert counts["bronze"] == events.count() > events.filter(half == 1).count() > 0


def test_failures_are_kept_whole_in_the_ledger(spark, tmp_path, monkeypatch):
    told = {"a": "first line\n" + "x" * 1_000, "b": ""}

    def fail(spark, path):
        raise ValueError(told[path])

    monkeypatch.setattr(medallion.readers, "read_events", fail)
    manifest = spark.createDataFrame([("interrupcoes", 2024, "a", "v1"), ("interrupcoes", 2025, "b", "v1")], MANIFEST)
    medallion.ingest_events(spark, manifest, f"{tmp_path}/b", f"{tmp_path}/l", RUN)
    stored = ledger.read_ledger(spark, f"{tmp_path}/l").collect()
    assert {r["url"]: (r["status"], r["mensagem"]) for r in stored} == {u: ("ERROR", t) for u, t in told.items()}


def _landed(spark, root, sizes):
    """One Parquet file per name, with so many events each."""
    events = standins.events(spark, SF_DIR, *EVENT_COLUMNS)
    for name, n in sizes.items():
        events.limit(n).coalesce(1).write.parquet(f"{root}/{name}")


def test_files_of_one_year_are_loaded_each_for_itself(spark, tmp_path):
    _landed(spark, tmp_path, {"a": 100, "b": 60, "c d%41": 30, "e": 20})
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    (file,) = [f"{tmp_path}/b/{n}" for n in os.listdir(tmp_path / "b") if n.endswith(".parquet")]
    urls = {2024: [f"{tmp_path}/a", file, f"file:{tmp_path}/broken"], 2025: [f"file://{tmp_path}/c d%41/", f"{tmp_path}/missing", f"{tmp_path}/e"]}
    rows = [("interrupcoes", y, u, "v1") for y, own in urls.items() for u in own]
    manifest = spark.createDataFrame([*rows, rows[0]], MANIFEST)
    bronze, book = f"{tmp_path}/bronze", f"{tmp_path}/ledger"
    entries = {r["url"]: r for r in medallion.ingest_events(spark, manifest, bronze, book, RUN).collect()}
    want = {rows[0][2]: 100, rows[1][2]: 60, rows[3][2]: 30, rows[5][2]: 20, rows[2][2]: 0, rows[4][2]: 0}
    assert {u: r["num_registros"] for u, r in entries.items()} == want
    assert "PATH_NOT_FOUND" in entries[rows[4][2]]["mensagem"]
    assert by_year(spark, bronze, "_source_url") == {u: n for u, n in want.items() if n}
    assert by_year(spark, bronze, "_ano_fonte") == {2024: 160, 2025: 50}
    stored = ledger.read_ledger(spark, book)
    assert stored.count() == 6
    assert {r["url"] for r in ledger.pending(manifest, stored).collect()} == {rows[2][2], rows[4][2]}

    # the missing file arrives; only it and the broken one are tried, the others stay as they are
    _landed(spark, tmp_path, {"missing": 7})
    again = medallion.ingest_events(spark, manifest, bronze, book, LATER)
    assert {r["url"]: r["status"] for r in again.collect()} == {rows[2][2]: "ERROR", rows[4][2]: "SUCCESS"}
    assert by_year(spark, bronze, "_ano_fonte") == {2024: 160, 2025: 57}
    counts = medallion.silver_events(spark, bronze, f"{tmp_path}/silver", [2024, 2025], LATER)
    assert counts["bronze"] == 217
    assert "_source_file" not in spark.read.parquet(f"{tmp_path}/silver").columns


def test_an_empty_manifest_loads_nothing(spark, tmp_path):
    none = spark.createDataFrame([], MANIFEST)
    assert medallion.ingest_events(spark, none, f"{tmp_path}/b", f"{tmp_path}/l", RUN).count() == 0


def test_failures_are_found_by_halves():
    tried = []

    def attempt(items):
        tried.append(len(items))
        if bad := [place for place, item in items if item == "bad"]:
            raise ValueError(f"place {bad[0]}")
        return {place: item for place, item in items}

    items = list(enumerate(["ok"] * 64))
    assert landed.by_halves(items, attempt) == (dict(items), {}) and tried == [64]
    tried.clear()
    items[40] = (40, "bad")
    done, failed = landed.by_halves(items, attempt)
    assert failed == {40: "place 40"} and len(done) == 63 and len(tried) == 13


def test_missing_stamps_are_one_version(spark):
    manifest = spark.createDataFrame([("s", 2024, "a", None), ("s", None, "b", "v1"), ("s", 2024, "c", None)], MANIFEST)
    book = spark.createDataFrame([("s", 2024, "a", None, "SUCCESS"), ("s", None, "b", "v1", "SUCCESS")], MANIFEST + ", status STRING")
    assert [r["url"] for r in ledger.pending(manifest, book).collect()] == ["c"]


def test_stored_gold_of_indicators_equals_the_query(spark, tmp_path):
    bronze = standins.indicators(spark, "/root/testdata/sf0.01").withColumn("numcnpj", F.col("_tie").cast("bigint")).drop("_tie")
    medallion.indicator_tables(spark, bronze, f"{tmp_path}/s", f"{tmp_path}/g", RUN)
    stored = {(r["distribuidora"], r["ano"], r["mes"]): r["qtd_conjuntos"] for r in spark.read.parquet(f"{tmp_path}/g").collect()}
    query = REGISTRY["gold_indicator_month"](spark, "/root/testdata/sf0.01").collect()
    assert stored == {(r["distribuidora"], r["ano"], r["mes"]): r["qtd_conjuntos"] for r in query}


BRONZE = "DatInicioInterrupcao timestamp_ntz, SigAgente string, DatFimInterrupcao timestamp_ntz, _ano_fonte int, _source_last_modified string, _ingest_timestamp timestamp"


def _bronze(spark, path, rows):
    """(agent, day, ends after so many hours, year, stamp, days after RUN) to bronze, of one type and conjunto."""
    day = dt.datetime(2024, 12, 31)
    frame = spark.createDataFrame(
        [(day + dt.timedelta(d), a, day + dt.timedelta(d, hours=h), y, s, RUN + dt.timedelta(k)) for a, d, h, y, s, k in rows], BRONZE)
    whole = readers.stamp(spark.createDataFrame([], v.EVENT_SCHEMA), "source", "u", RUN, "", 0)
    tables.replace_partitions(whole.unionByName(frame, allowMissingColumns=True), path, ["_ano_fonte", "_source_last_modified"])


def _events(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("cod_distribuidora", "data_inicio", "data_fim", "_ano_fonte").collect())


def _files(path, year):
    return sorted(n for n in os.listdir(f"{path}/_ano_fonte={year}") if n.endswith(".parquet"))


ROWS = [
    ("a", 0, 1, 2024, "v1", 0), ("b", 0, 1, 2024, "v1", 0), ("c", 0, 1, 2024, "v1", 0), ("c", 0, 5, 2024, "v1", 0),
    ("a", 0, 2, 2025, "v1", 1), ("b", 0, 3, 2025, "v1", -1), ("d", 1, 1, 2025, "v1", 1),
    ("d", 1, 4, 2026, "v1", 2), ("e", 2, 1, 2026, "v1", 2), ("f", 9, 1, 2023, "v1", 0),
]


@pytest.mark.parametrize("calls", [[[2026], [2025, 2024], [2023]], [[2024, 2026], [2023, 2025], [2024]]])
def test_separate_loads_equal_one_load(spark, tmp_path, calls):
    bronze = f"{tmp_path}/bronze"
    _bronze(spark, bronze, ROWS)
    for n, years in enumerate(calls):
        medallion.silver_events(spark, bronze, f"{tmp_path}/apart", years, RUN + dt.timedelta(n))
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2023, 2024, 2025, 2026], RUN)
    found = _events(spark, f"{tmp_path}/apart")
    assert found == _events(spark, f"{tmp_path}/whole")
    assert {(r[0], r[3]) for r in found} == {("a", 2025), ("b", 2024), ("c", 2024), ("d", 2026), ("e", 2026), ("f", 2023)}


def test_only_years_that_share_events_are_rewritten(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    medallion.silver_events(spark, bronze, silver, [2023, 2024], RUN)
    before = {y: _files(silver, y) for y in (2023, 2024)}
    counts = medallion.silver_events(spark, bronze, silver, [2025], LATER)
    assert _files(silver, 2023) == before[2023] and _files(silver, 2024) != before[2024]
    assert (counts["silver"], counts["linhas_reescritas"], counts["duplicatas_removidas"]) == (2, 2, 1)


def test_withdrawn_events_give_way_to_those_they_displaced(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    for years in ([2024], [2025], [2026]):
        medallion.silver_events(spark, bronze, silver, years, RUN)
    _bronze(spark, bronze, [("d", 1, 1, 2025, "v2", 3)])  # a is withdrawn, d published anew
    medallion.silver_events(spark, bronze, silver, [2025], LATER)
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2024, 2025, 2026], LATER)
    found = _events(spark, silver)
    assert found == _events(spark, f"{tmp_path}/whole")
    assert {(r[0], r[3]) for r in found} == {("a", 2024), ("b", 2024), ("c", 2024), ("d", 2025), ("e", 2026)}


def test_a_replacement_cut_short_is_completed(spark, tmp_path, monkeypatch):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    medallion.silver_events(spark, bronze, silver, [2024], RUN)
    replace = tables.replace_years_measured

    def die(df, path, *rest):
        if path == silver:
            raise RuntimeError("lost")
        return replace(df, path, *rest)

    monkeypatch.setattr(tables, "replace_years_measured", die)
    with pytest.raises(RuntimeError, match="lost"):
        medallion.silver_events(spark, bronze, silver, [2025], LATER)
    assert {r[3] for r in _events(spark, silver)} == {2024}
    monkeypatch.setattr(tables, "replace_years_measured", replace)
    medallion.silver_events(spark, bronze, silver, [2026], LATER)
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2024, 2025, 2026], LATER)
    assert _events(spark, silver) == _events(spark, f"{tmp_path}/whole")


def test_staged_years_are_moved_and_go_on_where_a_move_ended(spark, tmp_path, monkeypatch):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    medallion.silver_events(spark, bronze, silver, [2023, 2024], RUN)
    assert not [n for n in os.listdir(f"{silver}_nova") + os.listdir(f"{silver}_chaves_nova") if "=" in n]
    move = tables._move_years

    def part(spark, staged, path, year_col, years):
        move(spark, staged, path, year_col, years[:1])
        # a store that copies and then removes: this year is whole in the table, its rest is still staged
        move(spark, staged, path, year_col, years[1:2])
        os.makedirs(f"{staged}/{year_col}={years[1]}")
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_move_years", part)
    with pytest.raises(RuntimeError, match="lost"):
        medallion.silver_events(spark, bronze, silver, [2025, 2026], LATER)
    assert len(_events(spark, silver)) != 6
    monkeypatch.setattr(tables, "_move_years", move)
    assert sorted(merging.finish(spark, silver, "_ano_fonte")) == [2024, 2025, 2026]
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2023, 2024, 2025, 2026], LATER)
    assert _events(spark, silver) == _events(spark, f"{tmp_path}/whole")
    assert merging.finish(spark, silver, "_ano_fonte") == []


def test_a_replacement_left_open_without_row_counts_is_completed(spark, tmp_path, monkeypatch):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    medallion.silver_events(spark, bronze, silver, [2024], RUN)
    with monkeypatch.context() as cut:
        cut.setattr(merging, "_replace", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.silver_events(spark, bronze, silver, [2025], LATER)
    older = spark.createDataFrame([r[:4] for r in spark.read.schema(merging._STATE).parquet(f"{silver}_troca").collect()],
                                  "estado STRING, carregados ARRAY<INT>, reescritos ARRAY<INT>, esquema STRING")
    older.coalesce(1).write.mode("overwrite").parquet(f"{silver}_troca")
    assert sorted(merging.finish(spark, silver, "_ano_fonte")) == [2024, 2025]
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2024, 2025], LATER)
    assert _events(spark, silver) == _events(spark, f"{tmp_path}/whole")


def test_few_disputed_keys_leave_other_rows_in_place(spark, tmp_path, monkeypatch):
    bronze = f"{tmp_path}/bronze"
    _bronze(spark, bronze, ROWS + [(f"x{n}", n, 1, y, "v1", 0) for y in (2024, 2025, 2026) for n in range(y % 10 * 10, y % 10 * 10 + 9)])
    found, dealt, latest = {}, [], merging.latest_per_key
    monkeypatch.setattr(merging, "latest_per_key", lambda rows, *how: dealt.append(rows.count()) or latest(rows, *how))
    for listed in (merging.LISTED_KEYS, 0):
        monkeypatch.setattr(merging, "LISTED_KEYS", listed)
        for n, years in enumerate(([2026], [2025, 2024], [2023], [2024])):
            counts = medallion.silver_events(spark, bronze, f"{tmp_path}/{listed}", years, RUN + dt.timedelta(n))
        found[listed] = _events(spark, f"{tmp_path}/{listed}")
        assert counts["silver"] + counts["duplicatas_removidas"] == counts["conformado"] == 13
    assert found[0] == found[1_000_000] and len(found[0]) == 6 + 27
    few, all_rows = dealt[:4], dealt[4:]
    assert few == [0, 8, 0, 6] and all_rows == [0, 26, 0, 15]  # without disputes nothing is dealt


@pytest.mark.parametrize("bits", [256, 32])  # sparse, and so dense that rows of other keys are dealt too
def test_keys_too_many_to_list_leave_other_rows_in_place(spark, tmp_path, monkeypatch, bits):
    bronze = f"{tmp_path}/bronze"
    _bronze(spark, bronze, ROWS + [("b", 0, 9, 2025, "v1", -1), ("d", 1, 4, 2026, "v1", 2)] + [
        (f"x{n}", n, 1, y, "v1", 0) for y in (2024, 2025, 2026) for n in range(y % 10 * 40, y % 10 * 40 + 30)])
    dealt, latest = [], merging.latest_per_key
    monkeypatch.setattr(merging, "latest_per_key", lambda rows, *how: dealt.append(rows.count()) or latest(rows, *how))
    monkeypatch.setattr(merging, "BITS", bits)
    calls, found = ([2026], [2025, 2024], [2023], [2024]), {}
    for listed in (1_000_000, 1, 0):
        monkeypatch.setattr(merging, "LISTED_KEYS", listed)
        for n, years in enumerate(calls):
            counts = medallion.silver_events(spark, bronze, f"{tmp_path}/{listed}", years, RUN + dt.timedelta(n))
        found[listed] = _events(spark, f"{tmp_path}/{listed}")
        assert counts["silver"] + counts["duplicatas_removidas"] == counts["conformado"] == 34
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2023, 2024, 2025, 2026], RUN)
    assert found[0] == found[1] == found[1_000_000] == _events(spark, f"{tmp_path}/whole") and len(found[0]) == 6 + 90
    few, marked, all_rows = (sum(dealt[n:n + 4]) for n in (0, 4, 8))
    assert few <= marked < all_rows and (bits == 32 or marked < all_rows / 2)


def test_a_write_takes_its_shuffles_with_it(spark, tmp_path):
    def blocks():
        stored = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for n in range(stored.size()) if (b := stored.apply(n).name()).startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(1000).select((F.col("id") % 7).cast("int").alias("y"), "id").distinct()
    before, was = blocks(), spark.conf.get(name, None)
    assert tables.replace_all(rows, f"{tmp_path}/t", "y") == 1000
    assert not blocks() - before and spark.conf.get(name, None) == was
    with pytest.raises(ZeroDivisionError), session.shuffles_dropped(spark):
        raise ZeroDivisionError
    assert spark.conf.get(name, None) == was and spark.read.parquet(f"{tmp_path}/t").count() == 1000


def test_a_table_without_an_index_gets_one(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    _bronze(spark, bronze, ROWS)
    older = medallion.silver_events(spark, bronze, f"{tmp_path}/other", [2024], RUN)
    assert older["silver"] == 3
    stored = spark.read.schema(medallion.SILVER_EVENTS).parquet(f"{tmp_path}/other")
    tables.replace_all(stored, silver, "_ano_fonte")
    medallion.silver_events(spark, bronze, silver, [2025], LATER)
    medallion.silver_events(spark, bronze, f"{tmp_path}/whole", [2024, 2025], LATER)
    assert _events(spark, silver) == _events(spark, f"{tmp_path}/whole")


def _csv(path, lines, header=True):
    path.mkdir(parents=True, exist_ok=True)
    names = [",".join(EVENT_COLUMNS)] if header else []
    (path / "part.csv").write_text("\n".join([*names, *lines]) + "\n")


def _line(order, **changed):
    values = {"NumOrdemInterrupcao": order, "SigAgente": "a", "DatInicioInterrupcao": "2024-05-01T10:00:00", "NumNivelTensao": "13800", **changed}
    return ",".join(values.get(c, "") for c in EVENT_COLUMNS)


def test_lines_that_do_not_fit_are_kept_aside(spark, tmp_path):
    _csv(tmp_path / "2024a", [
        _line("1-1"), _line("1-2", NumNivelTensao="alta"), _line("1-3", DatInicioInterrupcao="ontem", NumCPFCNPJ="x9"),
        _line("1-4") + ",extra", "1-5,too few", _line('"1,6"', DscFatoGeradorInterrupcao='"a;""b"",c"'), _line("1-7", NumNivelTensao="")])
    _csv(tmp_path / "2024b", [_line("2-1"), _line("2-2")])
    _csv(tmp_path / "2025", [_line("3-1", NumAno="dois mil")])
    (tmp_path / "swapped").mkdir()
    (tmp_path / "swapped" / "part.csv").write_text(",".join(EVENT_COLUMNS[::-1]) + "\n" + _line("4-1") + "\n")
    years = {"2024a": 2024, "2024b": 2024, "2025": 2025, "swapped": 2026}
    manifest = spark.createDataFrame([("interrupcoes", y, f"{tmp_path}/{n}", "v1") for n, y in years.items()], MANIFEST)
    bronze, book, aside, measured = (f"{tmp_path}/{n}" for n in ("bronze", "ledger", "aside", "metrics"))
    for _ in range(2):
        entries = medallion.ingest_events(spark, manifest, bronze, book, RUN, measured, rejected_path=aside)
    stored = ledger.read_ledger(spark, book).filter("status = 'SUCCESS'").collect()
    assert {(os.path.basename(r["url"]), r["num_registros"], r["mensagem"]) for r in stored} == {
        ("2024a", 3, "carga concluida, 4 linhas rejeitadas"), ("2024b", 2, "carga concluida")}
    failed = {os.path.basename(r["url"]): r["mensagem"] for r in entries.collect()}
    assert failed["2025"] == "sem registros" and "header" in failed["swapped"].lower()
    kept = spark.read.parquet(bronze)
    assert {r[0] for r in kept.select("NumOrdemInterrupcao").collect()} == {"1-1", "1,6", "1-7", "2-1", "2-2"}
    assert kept.filter("NumOrdemInterrupcao = '1,6'").first()["DscFatoGeradorInterrupcao"] == 'a;"b",c'
    put = {(os.path.basename(r["_source_url"]), r["motivo"], r["linha"][:3]) for r in spark.read.parquet(aside).collect()}
    assert put == {
        ("2024a", "tipo: NumNivelTensao", ",,,"), ("2024a", "tipo: DatInicioInterrupcao, NumCPFCNPJ", ",,,"),
        ("2024a", "campos", ",,,"), ("2024a", "campos", "1-5"), ("2025", "tipo: NumAno", ",,,")}
    assert spark.read.parquet(aside).count() == 5
    assert by_year(spark, bronze, "_ano_fonte") == {2024: 5}


def test_deliveries_with_changed_types(spark, tmp_path):
    a = spark.createDataFrame([(1, DAY, "7", 1.5, "x")], "k int, d date, n string, f float, only_a string")
    b = spark.createDataFrame([(2**40, dt.datetime(2024, 5, 6, 7), "many", 2, "y")], "k long, d timestamp_ntz, n string, f int, only_b string")
    c = spark.createDataFrame([(3, DAY, " 8 ", None, "z"), (None, None, None, None, None)], "k int, d date, n string, f float, only_a string")
    for name, frame in (("a", a), ("b", b), ("c", c)):
        frame.write.parquet(f"{tmp_path}/{name}")
    rows = readers.read_reconciled(spark, [f"{tmp_path}/{n}" for n in "abc"], {"n": "bigint"})
    assert dict(rows.dtypes) == {"k": "bigint", "d": "timestamp_ntz", "n": "bigint", "f": "double", "only_a": "string",
                                 "only_b": "string", "_falhas_conversao": "int"}
    found = {r["k"]: tuple(r)[1:] for r in rows.collect()}
    noon = dt.datetime(2024, 5, 6)
    assert found == {1: (noon, 7, 1.5, "x", None, 0), 2**40: (dt.datetime(2024, 5, 6, 7), None, 2.0, None, "y", 1),
                     3: (noon, 8, None, "z", None, 0), None: (None, None, None, None, None, 0)}
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    kept = readers.read_reconciled(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert dict(kept.dtypes)["n"] == "string" and kept.agg(F.sum("_falhas_conversao")).first()[0] == 0


DAY = dt.date(2024, 5, 6)


def test_measures_of_a_year_count_with_their_newest_run(spark, tmp_path):
    bronze, silver, gold, measured = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold", "metrics"))
    _bronze(spark, bronze, ROWS)
    metrics.record(spark, measured, RUN, "interrupcoes", "bronze", {(2024, "a"): {"linhas": 3}, (2024, "b"): {"linhas": 1}})
    metrics.record(spark, measured, LATER, "interrupcoes", "bronze", {(2024, "a"): {"linhas": 4}, (2025, "c"): {"linhas": 3}})
    for n, years in enumerate(([2024], [2025])):
        medallion.silver_events(spark, bronze, silver, years, RUN + dt.timedelta(n), measured)
    medallion.gold_outages(spark, silver, gold, [2024, 2025], LATER, metrics_path=measured)
    found = {r["etapa"]: r for r in metrics.run_summary(metrics.read_metrics(spark, measured)).collect()}
    stored = spark.read.parquet(silver)
    assert (found["bronze"]["linhas"], found["bronze"]["anos"]) == (8, 2)
    assert found["silver"]["linhas"] == stored.count() == 4 and found["silver"]["removidos"] == 4
    assert found["silver"]["segundos"] == stored.agg(F.sum("tempo_interrupcao_minutos") * 60).first()[0]
    assert (found["gold"]["eventos"], found["gold"]["removidos"], found["gold"]["diferenca_segundos"]) == (4, 0, 0)
    metrics.record(spark, None, RUN, "interrupcoes", "bronze", {(1, None): {"linhas": 1}})


def test_wide_indicators_are_summed_up(spark, tmp_path):
    bronze = standins.indicators(spark, SF_DIR).withColumn("_ingest_ts", F.col("_ingest_ts").cast("timestamp"))
    odd = bronze.limit(3).withColumn("numperiodoindice", F.lit(13).cast("bigint")).withColumn("ideconjundconsumidoras", F.lit(99).cast("bigint"))
    found = medallion.wide_indicators(spark, bronze.unionByName(odd).drop("_tie"), f"{tmp_path}/w", [1997, 1998], RUN)
    keys = set(v.INDICATOR_KEY)
    given = bronze.filter("anoindice in (1997, 1998)")
    assert found["duplicatas_removidas"] >= given.count() - given.select(*keys, "sigindicador").distinct().count()
    assert found["silver"] == spark.read.parquet(f"{tmp_path}/w").count() == given.select(*keys).distinct().count()
    assert found["linhas_largas"] - found["invalidas_removidas"] == found["silver"]
