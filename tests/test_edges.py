"""Edges of single operators on small literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import calendar, durations, text
from outagelens.operators import (
    compare, conform, dedupe, filters, indicators, names, outages, profiling, quality, ranking,
)

T0 = dt.datetime(2024, 1, 31, 22, 0)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture(scope="module")
def spans(spark):
    rows = [
        ("open", T0, None), ("no_start", None, T0), ("zero", T0, T0), ("reversed", T0, minutes(-5)),
        ("m60", T0, minutes(60)), ("m61", T0, minutes(61)), ("m1439", T0, minutes(1439)),
        ("m1440", T0, minutes(1440)), ("m1441", T0, minutes(1441)),
        ("split", T0 + dt.timedelta(microseconds=900000), minutes(1) + dt.timedelta(microseconds=100000)),
    ]
    return spark.createDataFrame(rows, "id STRING, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")


def as_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_duration_null_or_zero(spans):
    kept = as_map(conform.with_duration(spans, "s", "e"), "id", "duracao_minutos")
    assert kept["open"] is None and kept["no_start"] is None
    assert kept["zero"] == 0.0 and kept["reversed"] == -5.0 and kept["split"] == 1.0
    zeroed = as_map(conform.with_duration(spans, "s", "e", null_as_zero=True), "id", "duracao_minutos")
    assert zeroed["open"] == 0.0 and zeroed["m61"] == 61.0


def test_whole_units_count_complete_minutes(spans):
    whole = as_map(conform.with_duration(spans, "s", "e", whole_units=True), "id", "duracao_minutos")
    assert whole["split"] == 0 and whole["m60"] == 60 and whole["reversed"] == -5


def test_duration_units(spans):
    row = {r["id"]: r for r in conform.with_duration_triplet(spans, "s", "e").collect()}["m61"]
    assert (row["duracao_segundos"], row["duracao_minutos"], row["duracao_horas"]) == (3660, 61.0, 1.0167)


def test_duration_classes(spans):
    classed = conform.with_duration_class(conform.with_duration(spans, "s", "e"))
    got = as_map(classed, "id", "classe_duracao")
    assert got["open"] == "NAO_CALCULADA"
    assert got["zero"] == got["reversed"] == got["m60"] == "CURTA"
    assert got["m61"] == got["m1439"] == "MEDIA"
    assert got["m1440"] == got["m1441"] == "LONGA"


def test_flag_and_band(spark):
    hours = {"6d23": 167, "7d": 168, "30d": 720, "30d23": 743, "31d": 744, "24h": 24, "25h": 25}
    rows = [(k, T0, T0 + dt.timedelta(hours=h)) for k, h in hours.items()] + [("open", T0, None)]
    df = spark.createDataFrame(rows, "id STRING, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    flag = as_map(conform.with_duration_flag(df, "s", "e"), "id", "flag_duracao")
    assert flag["6d23"] == flag["open"] == "Normal"
    assert flag["7d"] == flag["30d"] == flag["30d23"] == "Duração longa"
    assert flag["31d"] == "Duração extrema"
    band = as_map(conform.with_duration_band(df, "s", "e"), "id", "faixa_duracao")
    assert band["24h"] == v.BAND_DAY and band["25h"] == band["6d23"] == v.BAND_WEEK
    assert band["30d23"] == v.BAND_MONTH and band["31d"] == v.BAND_OVER and band["open"] is None


def test_temporal_filters_partition_the_rows(spans):
    good = {r["id"] for r in filters.temporal_valid(spans, "s", "e").collect()}
    bad = {r["id"] for r in filters.temporal_invalid(spans, "s", "e").collect()}
    assert bad == {"zero", "reversed"} and good | bad == {r["id"] for r in spans.collect()}
    assert not good & bad


def test_text_stamps_are_parsed_and_bad_ones_dropped(spark):
    df = spark.createDataFrame(
        [("2024-05-01 10:00:00", "2024-05-01 11:30:00"), ("no date", "2024-05-01 11:30:00"), ("2024-05-01 10:00:00", "x")],
        "DatInicioInterrupcao STRING, DatFimInterrupcao STRING",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in (
            "SigAgente", "DscConjuntoUnidadeConsumidora", "DscTipoInterrupcao",
            "DscFatoGeradorInterrupcao", "_source_url", "_source_last_modified")}
    )
    rows = conform.conform_events(df).collect()
    assert sorted(r["tempo_interrupcao_minutos"] for r in rows) == [0.0, 90.0]
    assert {r["cod_distribuidora"] for r in rows} == {"DESCONHECIDO"}
    assert {r["tipo_interrupcao"] for r in rows} == {"NAO_CLASSIFICADO"}
    assert {r["_source_url"] for r in rows} == {""}


def test_names():
    assert names.fold_name("DatGeracaoConjuntoDados") == "datgeracaoconjuntodados"
    assert names.fold_name("Ação/Índice (%)") == "acao_indice"
    assert names.fold_name("__x__") == "x"
    assert names.fold_name("Nº Güell ñ") == "n_guell_n"
    assert names.snake_name("DatGeracaoConjuntoDados") == "dat_geracao_conjunto_dados"
    assert names.snake_name("NumCPFCNPJ") == "num_cpfcnpj"
    assert names.snake_name("IDEConjunto2Uc") == "ide_conjunto2_uc"


def test_name_collisions_are_refused(spark):
    df = spark.range(1).select(F.lit(1).alias("Ação"), F.lit(2).alias("acao"))
    with pytest.raises(ValueError, match="acao"):
        names.normalize_names(df)
    kept = names.normalize_names(spark.range(1).select(F.lit(1).alias("_ingest_ts"), F.lit(1).alias("Ano Índice")))
    assert kept.columns == ["_ingest_ts", "ano_indice"]


def test_cause_levels(spark):
    causes = ["A;B;C;D", "A-B-C-D", "A; B -C", "A;B", "A;B;C;D;E", "", None, "A;;C"]
    df = conform.with_cause_levels(spark.createDataFrame([(c,) for c in causes], "c STRING"), "c")
    got = {r["c"]: tuple(r[n] for n in v.CAUSE_LEVELS) for r in df.collect()}
    assert got["A;B;C;D"] == got["A-B-C-D"] == got["A;B;C;D;E"] == ("A", "B", "C", "D")
    assert got["A; B -C"] == ("A", "B", "C", None) and got["A;B"] == ("A", "B", None, None)
    assert got[""] == got[None] == (None,) * 4 and got["A;;C"] == ("A", None, "C", None)


def test_period_is_guarded(spark):
    df = spark.createDataFrame([(2024, m) for m in (0, 1, 12, 13, None)] + [(None, 5)], "y BIGINT, m BIGINT")
    got = [r[0] for r in df.select(calendar.month_start(F.col("y"), F.col("m"))).collect()]
    assert got == [None, dt.date(2024, 1, 1), dt.date(2024, 12, 1), None, None, None]


def test_formats(spark):
    row = spark.createDataFrame([(5965546000109, 13800, None)], "n BIGINT, kv BIGINT, x STRING").select(
        text.cnpj_text(F.col("n")), text.kilovolts(F.col("kv")),
        text.composite_key(F.col("n"), F.col("x"), F.col("kv")),
    ).first()
    assert tuple(row) == ("05965546000109", 13.8, "5965546000109##13800")


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (0, 0), (7, 7)], "p BIGINT, t BIGINT")
    assert [r[0] for r in df.select(text.share(F.col("p"), F.col("t"))).collect()] == [0.13, 33.33, None, 100.0]


def test_calendar_weekday_starts_on_sunday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 8, 23, 43),)], "s TIMESTAMP_NTZ")  # a Sunday
    row = conform.with_calendar(df, "s").first()
    assert (row["dia_semana_interrupcao"], row["mes_interrupcao"], row["hora_inicio_interrupcao"]) == (1, 12, 23)


def test_years():
    assert filters.parse_years("2023, 2024") == [2023, 2024]
    assert filters.parse_years(None) == [2025]
    with pytest.raises(ValueError):
        filters.parse_years(" , ")


def test_event_filter_folds_labels(spark):
    rows = [("Não Programada", 5), (" nao programada ", 5), ("PROGRAMADA", 5), (None, 5), ("Emergencial", 0)]
    df = spark.createDataFrame(rows, "DscTipoInterrupcao STRING, NumUnidadeConsumidora BIGINT").withColumns(
        {filters.START: F.lit(T0).cast("timestamp_ntz"), filters.END: F.lit(minutes(1)).cast("timestamp_ntz")}
    )
    only = filters.dec_event_filter(df, v.TYPES_INCLUDED, v.TYPES_EXCLUDED)
    assert sorted(r[0] for r in only.collect()) == [" nao programada ", "Não Programada"]
    loose = filters.dec_event_filter(df, exclude=v.TYPES_EXCLUDED)
    assert loose.count() == 3
    assert filters.dec_event_filter(df, min_minutes=2).count() == 0


def test_dedupe_ties_are_broken_by_value(spark):
    day = dt.date(2024, 1, 1)
    rows = [("k", day, minutes(5), "x"), ("k", day, minutes(9), "a"), ("k", day, None, "z"), ("j", None, None, "q")]
    schema = "k STRING, g DATE, e TIMESTAMP_NTZ, t STRING"
    want = {("k", "a"), ("j", "q")}
    for order in (rows, rows[::-1]):
        for parts in (1, 4):
            df = spark.createDataFrame(order, schema).repartition(parts)
            kept = dedupe.latest_per_key(df, ["k"], ["g"])
            assert {(r["k"], r["t"]) for r in kept.collect()} == want
            assert dedupe.latest_per_key(kept, ["k"], ["g"]).count() == 2


def test_audit_equals_the_dedupe(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("k"),
        (F.col("id") * 7919 % 1000).alias("o"), (F.col("id") % 13 - 3).alias("m"),
    )
    kept = dedupe.latest_per_key(df, ["k"], ["o"], ties=["m"])
    row = dedupe.dedupe_audit(df, ["k"], ["o"], "m").first()
    assert row["rows_before"] == 5000 and row["rows_after"] == kept.count()
    assert row["sum_before"] == df.agg(F.sum("m")).first()[0]
    assert row["sum_after"] == kept.agg(F.sum("m")).first()[0]


def _long(spark, rows):
    return spark.createDataFrame(
        rows, "distribuidora STRING, id_conjunto_uc BIGINT, ano BIGINT, mes BIGINT, indicador STRING, "
        "valor DOUBLE, ts TIMESTAMP_NTZ"
    )


def test_pivot_takes_the_newest_value(spark):
    silver = _long(spark, [
        ("A", 1, 2024, 1, "DEC", 9.0, T0), ("A", 1, 2024, 1, "DEC", 2.0, minutes(1)),
        ("A", 1, 2024, 1, "FEC", 5.0, T0), ("A", 1, 2024, 1, "FEC", None, minutes(1)),
        ("A", 1, 2024, 1, "OUTRO", 5.0, T0),
    ])
    row = indicators.conjunto_month(silver, ["ts"], ["DEC", "FEC", "NumCon"]).collect()
    assert len(row) == 1 and (row[0]["dec"], row[0]["fec"], row[0]["numcon"]) == (2.0, None, None)


def _gold(spark, values, **options):
    rows = [(a, 1, y, m, "DEC", d, T0) for a, y, m, d in values]
    months = indicators.conjunto_month(_long(spark, rows), ["ts"], indicators.GOLD_CODES)
    return {(r["distribuidora"], r["ano"], r["mes"]): r
            for r in indicators.gold_indicator_month(months, **options).collect()}


def test_lag_gap_zero_and_null(spark):
    values = [("A", 2023, 12, 2.0), ("A", 2024, 1, 3.0), ("A", 2024, 3, 0.0), ("A", 2024, 4, 1.0),
              ("A", 2024, 5, None), ("A", 2024, 6, 4.0)]
    loose, strict = _gold(spark, values), _gold(spark, values, strict_month=True)
    assert loose["A", 2023, 12]["dec_medio_mes_anterior"] is None
    assert loose["A", 2024, 1]["variacao_perc_mes_anterior"] == 50.0
    assert loose["A", 2024, 3]["dec_medio_mes_anterior"] == 3.0
    assert strict["A", 2024, 1]["dec_medio_mes_anterior"] == 2.0
    assert strict["A", 2024, 3]["dec_medio_mes_anterior"] is None
    assert loose["A", 2024, 4]["dec_medio_mes_anterior"] == 0.0
    assert loose["A", 2024, 4]["variacao_perc_mes_anterior"] is None
    assert loose["A", 2024, 6]["variacao_perc_mes_anterior"] is None


def test_rank_ties_and_nulls(spark):
    got = _gold(spark, [("A", 2024, 1, 5.0), ("B", 2024, 1, 5.0), ("C", 2024, 1, 1.0), ("D", 2024, 1, None)])
    ranks = {k[0]: r["ranking_dec_mes"] for k, r in got.items()}
    assert ranks == {"A": 1, "B": 1, "C": 3, "D": 4}


def test_alert_levels(spark):
    observed = spark.createDataFrame(
        [(n, 2024, 1, int(s * 3600), 1, 1) for n, s in
         [("ten", 110), ("above", 110.1), ("twenty", 120), ("crit", 121), ("low", 79), ("zero", 5), ("alone", 5)]],
        "distribuidora STRING, ano BIGINT, mes BIGINT, consumidor_segundos BIGINT, consumidores_afetados BIGINT, consumidores_eventos BIGINT",
    )
    official = spark.createDataFrame(
        [(n, 2024, 1, 1.0, 0.0 if n == "zero" else 100.0, 1.0) for n in
         ["ten", "above", "twenty", "crit", "low", "zero", "unseen"]],
        "distribuidora STRING, ano BIGINT, mes BIGINT, consumidores DOUBLE, dec_oficial DOUBLE, dec_medio DOUBLE",
    )
    got = as_map(compare.dec_comparison(observed, official), "distribuidora", "alerta")
    assert got == {"ten": "OK", "above": "WARNING", "twenty": "WARNING", "crit": "CRITICAL",
                   "low": "CRITICAL", "zero": "NO_REFERENCE", "alone": "NO_REFERENCE",
                   "unseen": "NO_OBSERVATION"}


def test_weighted_index(spark):
    months = spark.createDataFrame(
        [("A", 1, 2024, 1, 2.0, 1.0, 300.0), ("A", 2, 2024, 1, 6.0, None, 100.0), ("A", 3, 2024, 1, None, 4.0, 50.0)],
        "distribuidora STRING, id_conjunto_uc BIGINT, ano BIGINT, mes BIGINT, dec DOUBLE, fec DOUBLE, numcon DOUBLE",
    )
    row = compare.official_month(months).first()
    assert (row["consumidores"], row["dec_oficial"], row["dec_medio"]) == (450.0, 3.0, 4.0)
    assert row["fec_oficial"] == (300.0 + 200.0) / 350.0


def test_negative_durations_as_told(spark):
    df = spark.createDataFrame([("A", T0, -30.0), ("A", T0, 90.0), ("A", T0, None)],
                               "cod_distribuidora STRING, data_inicio TIMESTAMP_NTZ, tempo_interrupcao_minutos DOUBLE")
    assert outages.gold_outage_month(df).first()["tempo_total_minutos"] == 60.0
    assert outages.gold_outage_month(df, clip_negative=True).first()["tempo_total_horas"] == 1.5


def test_missing_months(spark):
    df = spark.createDataFrame([("A", 2023, 11), ("A", 2024, 2), ("B", 2024, 1), ("B", 2024, 13)], "k STRING, y INT, m INT")
    got = sorted((r[0], r[1]) for r in outages.missing_months(df, ["k"], "y", "m").collect())
    d = dt.date
    assert got == [("A", d(2023, 12, 1)), ("A", d(2024, 1, 1)), ("B", d(2023, 11, 1)),
                   ("B", d(2023, 12, 1)), ("B", d(2024, 2, 1))]
    fixed = outages.missing_months(df, ["k"], "y", "m", d(2024, 1, 1), d(2024, 2, 1))
    assert sorted((r[0], r[1].month) for r in fixed.collect()) == [("A", 1), ("B", 2)]


def test_limits_for_all_years_or_by_year(spark):
    yearly = spark.createDataFrame([("A", 1990, 7.0), ("A", 2030, 9.0), ("B", 2030, 9.0)],
                                   "distribuidora STRING, ano BIGINT, dec_medio DOUBLE")
    always = spark.createDataFrame([("A", 6.0)], "distribuidora STRING, limite_dec DOUBLE")
    got = compare.above_limit(yearly, always).select("distribuidora", "ano", "excesso").collect()
    assert sorted(map(tuple, got)) == [("A", 1990, 1.0), ("A", 2030, 3.0)]
    by_year = always.withColumn("ano", F.lit(2030).cast("bigint"))
    assert [r["ano"] for r in compare.above_limit(yearly, by_year).collect()] == [2030]


def test_report_and_require(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, 2.0)], "k STRING, x DOUBLE")
    report = quality.check_report(df, columns=["k", "gone"], key=["k"], not_null=["k", "gone"],
                                  ranges={"x": (0, 1)}, domains={"k": ["b"]}, soft=("faixa:x",))
    got = {r["verificacao"]: (r["status"], r["metrica"]) for r in report.collect()}
    assert got == {"coluna_ausente:gone": ("FAIL", 1.0), "sem_linhas": ("PASS", 0.0),
                   "chaves_repetidas": ("FAIL", 1.0), "nulos:k": ("FAIL", 1.0),
                   "faixa:x": ("WARN", 2.0), "dominio:k": ("FAIL", 2.0)}
    with pytest.raises(ValueError, match="gone"):
        quality.require(report)
    quality.require(quality.check_report(df, ranges={"x": (0, 1)}, soft=("faixa:x",)))
    empty = quality.check_report(df.limit(0), key=["k"], not_null=["k"])
    assert {r["verificacao"]: r["status"] for r in empty.collect()} == {
        "sem_linhas": "FAIL", "chaves_repetidas": "PASS", "nulos:k": "PASS"}


def test_reconcile_flags_a_gap(spark):
    left = spark.createDataFrame([(100.0,), (None,)], "m DOUBLE")
    near = spark.createDataFrame([(99.995,)], "m DOUBLE")
    far = spark.createDataFrame([(99.0,)], "m DOUBLE")
    assert quality.reconcile_sum(left, near, "m", "m", 0.01).first()["status"] == "PASS"
    row = quality.reconcile_sum(left, far, "m", "m", 0.01).first()
    assert row["status"] == "FAIL" and row["diferenca_perc"] == 1.0
    assert quality.reconcile_sum(left.limit(0), near.limit(0), "m", "m", 0.01).first()["status"] == "PASS"


def test_steps_on_empty_input(spark):
    df = spark.createDataFrame([], "k STRING, g DATE, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    rows = quality.reconcile_steps(df, ["k"], ["g"], "s", "e").collect()
    assert [r["qtd_registros"] for r in rows] == [0] * 5 and {r["pct_retencao"] for r in rows} == {None}


def test_class_shares_cover_the_table(spans):
    classed = conform.with_duration_class(conform.with_duration(spans, "s", "e"))
    rows = quality.class_distribution(classed, "classe_duracao").collect()
    assert sum(r["qtd_registros"] for r in rows) == spans.count()
    assert abs(sum(r["pct"] for r in rows) - 100) < 0.05


def test_exact_percentiles_against_sorting(spark):
    values = [(i * i * 37) % 200000 - 500 for i in range(999)] + [7] * 600
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x BIGINT").repartition(5)
    points = {"p0": 0, "p50": 50, "p95": 95, "p99": 99, "p100": 100}
    row = profiling.exact_percentiles(df, "x", points, width=1000).first()
    ordered, n = sorted(values), len(values)
    for name, p in points.items():
        assert row[name] == ordered[max(-(-n * p // 100), 1) - 1]
    assert (row["linhas"], row["soma"]) == (n, sum(values))


def test_top_k_is_repeatable(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None)], "n STRING, x INT")
    for parts in (1, 3):
        got = [r["n"] for r in ranking.top_k(df.repartition(parts), "x", 2, ["n"]).collect()]
        assert got == ["c", "a"]


def test_sums_do_not_depend_on_row_order(spark):
    rows = [("A", T0, i * 0.1 + 1 / 3) for i in range(2000)]
    schema = "cod_distribuidora STRING, data_inicio TIMESTAMP_NTZ, tempo_interrupcao_minutos DOUBLE"
    totals = {
        outages.gold_outage_month(spark.createDataFrame(r, schema).repartition(p)).first()["tempo_total_minutos"]
        for r, p in ((rows, 1), (rows[::-1], 7), (rows, 3))
    }
    assert len(totals) == 1


def test_seconds_survive_the_double(spark):
    df = spark.range(100000).select((F.col("id") / F.lit(60.0)).alias("m"), "id")
    assert df.filter(durations.exact_seconds(F.col("m")) != F.col("id")).count() == 0
