"""The same results in plain SQL, written independently of the Spark code."""

from __future__ import annotations

_EV = """
ev AS (
  SELECT
    concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS NumOrdemInterrupcao,
    CAST(o_orderdate AS DATE) AS DatGeracaoConjuntoDados,
    l_partkey % 50 AS IdeConjuntoUnidadeConsumidora,
    CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '  '
         ELSE concat('CJ ', CAST(l_partkey % 50 AS VARCHAR), ' ') END AS DscConjuntoUnidadeConsumidora,
    concat('AL', CAST(l_partkey % 7 AS VARCHAR), ' ') AS DscAlimentadorSubestacao,
    concat(' SE', CAST(l_suppkey % 10 AS VARCHAR)) AS DscSubestacaoDistribuicao,
    CASE WHEN l_tax = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'Programada'
         ELSE 'Não Programada' END AS DscTipoInterrupcao,
    CAST(l_linenumber AS BIGINT) AS IdeMotivoInterrupcao,
    l_shipdate AS DatInicioInterrupcao,
    CASE WHEN l_discount = 0.1 THEN NULL ELSE l_shipdate + INTERVAL '1' MINUTE
         * CAST((l_quantity * 60 - 600) * CASE WHEN l_linenumber = 7 THEN 24 ELSE 1 END AS INT)
    END AS DatFimInterrupcao,
    CASE l_partkey % 4 WHEN 0 THEN 'INTERNA;' || p_type || ';' || p_brand || ';' || p_name
         WHEN 1 THEN 'EXTERNA-' || p_type || '-' || p_brand || '-' || p_name
         WHEN 2 THEN 'INTERNA;' || p_type END AS DscFatoGeradorInterrupcao,
    CAST(CASE WHEN l_suppkey % 25 = 0 THEN 0 ELSE 13800 END AS BIGINT) AS NumNivelTensao,
    (l_orderkey + l_partkey) % 200 AS NumUnidadeConsumidora,
    1000 + (l_partkey % 50) * 10 AS NumConsumidorConjunto,
    CAST(year(l_shipdate) AS BIGINT) AS NumAno,
    s_name AS NomAgenteRegulado,
    concat(' ', s_name) AS SigAgente,
    5965546000109 + l_suppkey AS NumCPFCNPJ,
    o_orderdate AS _ingest_timestamp,
    concat('landing/events_', CAST(year(o_orderdate) AS VARCHAR), '.parquet') AS _source_url,
    CAST(NULL AS VARCHAR) AS _source_last_modified,
    CAST(year(o_orderdate) AS INT) AS _ano_fonte,
    l_extendedprice AS _tie
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
)"""

_IND = """
ind AS (
  SELECT
    CAST(o_orderdate AS DATE) AS datgeracaoconjuntodados,
    l_partkey % 10 AS ideconjundconsumidoras,
    concat(' CJ ', CAST(l_partkey % 10 AS VARCHAR)) AS dscconjundconsumidoras,
    concat('Supplier#00000000', CAST(l_suppkey % 10 AS VARCHAR), ' ') AS sigagente,
    5965546000109 + l_suppkey % 10 AS numcnpj,
    CASE l_linenumber WHEN 1 THEN 'DEC' WHEN 2 THEN 'FEC' WHEN 3 THEN 'NumCon' WHEN 4 THEN 'DECIND'
         WHEN 5 THEN 'DECINC' WHEN 6 THEN 'FECIND' WHEN 7 THEN 'DECXP' END AS sigindicador,
    CAST(year(l_shipdate) AS BIGINT) AS anoindice,
    CAST(month(l_shipdate) AS BIGINT) AS numperiodoindice,
    CASE WHEN l_linenumber = 3 THEN l_quantity * 100 ELSE l_quantity / 4 END AS vlrindiceenviado,
    'landing/indicators.parquet' AS _fonte_url,
    o_orderdate AS _ingest_ts,
    l_extendedprice AS _tie
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_LONG = _IND + """,
lng AS (
  SELECT ideconjundconsumidoras AS id_conjunto_uc, trim(dscconjundconsumidoras) AS conjunto_uc,
    trim(sigagente) AS distribuidora, numcnpj AS cnpj, trim(sigindicador) AS indicador,
    vlrindiceenviado AS valor,
    make_date(anoindice, numperiodoindice, 1) AS data_apuracao,
    anoindice AS ano, numperiodoindice AS mes, datgeracaoconjuntodados AS data_geracao_fonte,
    _fonte_url AS fonte_url, _ingest_ts AS ingest_ts_bronze,
    CAST(_ingest_ts AS DATE) AS ingest_date_bronze,
    strftime(_ingest_ts, '%Y%m%d%H%M%S') AS run_id_bronze, _tie
  FROM ind
)"""

_CELLS = _LONG + """,
cells AS (
  SELECT * FROM lng QUALIFY row_number() OVER (
    PARTITION BY distribuidora, id_conjunto_uc, ano, mes, indicador
    ORDER BY ingest_ts_bronze DESC, _tie DESC) = 1
)"""

_GOLD_IND = _CELLS + """,
monthly AS (
  SELECT distribuidora, ano, mes,
    avg(valor) FILTER (WHERE indicador = 'DEC') AS dec_medio,
    min(valor) FILTER (WHERE indicador = 'DEC') AS dec_minimo,
    max(valor) FILTER (WHERE indicador = 'DEC') AS dec_maximo,
    sum(valor) FILTER (WHERE indicador = 'DEC') AS dec_total,
    avg(valor) FILTER (WHERE indicador = 'DECIND') AS decind_medio,
    sum(valor) FILTER (WHERE indicador = 'DECIND') AS decind_total,
    avg(valor) FILTER (WHERE indicador = 'DECINC') AS decinc_medio,
    sum(valor) FILTER (WHERE indicador = 'DECINC') AS decinc_total,
    avg(valor) FILTER (WHERE indicador = 'FEC') AS fec_medio,
    sum(valor) FILTER (WHERE indicador = 'FEC') AS fec_total,
    avg(valor) FILTER (WHERE indicador = 'NumCon') AS numcon_medio,
    sum(valor) FILTER (WHERE indicador = 'NumCon') AS numcon_total,
    count(DISTINCT id_conjunto_uc) AS qtd_conjuntos
  FROM cells GROUP BY ALL
),
gi AS (
  SELECT *, distribuidora AS sigagente, distribuidora AS codigo_distribuidora,
    make_date(ano, mes, 1) AS ano_mes, prev AS dec_medio_mes_anterior,
    CASE WHEN prev <> 0 THEN (dec_medio - prev) / prev * 100.0 END AS variacao_perc_mes_anterior,
    CAST(rank() OVER (PARTITION BY ano, mes ORDER BY dec_medio DESC NULLS LAST) AS INT) AS ranking_dec_mes
  FROM (SELECT *, lag(dec_medio) OVER (PARTITION BY distribuidora ORDER BY ano, mes) AS prev FROM monthly)
)"""

_WIDE_VALUES = [
    "DEC", "DECINC", "DECIND", "DECINE", "DECINO", "DECIP", "DECIPC", "DECXN", "DECXNC", "DECXP",
    "DECXPC", "FEC", "FECINC", "FECIND", "FECINE", "FECINO", "FECIP", "FECIPC", "FECXN", "FECXNC",
    "FECXP", "FECXPC", "NumCon",
]
_WIDE = _IND + """,
wide AS (
  SELECT sigagente, ideconjundconsumidoras, anoindice, numperiodoindice,
    max_by(dscconjundconsumidoras, (_ingest_ts, _tie)) AS dscconjundconsumidoras,
    max_by(numcnpj, (_ingest_ts, _tie)) AS numcnpj,
    max_by(_fonte_url, (_ingest_ts, _tie)) AS _fonte_url,
    max(_ingest_ts) AS _ingest_ts,
""" + ",\n".join(
    f"    max_by(vlrindiceenviado, (_ingest_ts, _tie)) FILTER (WHERE sigindicador = '{c}') AS {c.lower()}"
    for c in _WIDE_VALUES
) + """
  FROM ind GROUP BY sigagente, ideconjundconsumidoras, anoindice, numperiodoindice
),
w AS (
  SELECT *, upper(trim(sigagente)) AS codigo_distribuidora,
    trim(dscconjundconsumidoras) AS distribuidora, anoindice AS ano_referencia,
    make_date(anoindice, numperiodoindice, 1) AS periodo_apuracao, sigagente AS chave_uc
  FROM wide
)"""

_SECONDS = (
    "(CAST(floor(epoch(DatFimInterrupcao)) AS BIGINT)"
    " - CAST(floor(epoch(DatInicioInterrupcao)) AS BIGINT))"
)

_SILVER = _EV + f""",
sv AS (
  SELECT coalesce(SigAgente, 'DESCONHECIDO') AS cod_distribuidora,
    DatInicioInterrupcao AS data_inicio,
    coalesce(DscConjuntoUnidadeConsumidora, 'NAO_INFORMADO') AS conjunto,
    coalesce(DscTipoInterrupcao, 'NAO_CLASSIFICADO') AS tipo_interrupcao,
    DatFimInterrupcao AS data_fim,
    coalesce(DscFatoGeradorInterrupcao, 'NAO_INFORMADO') AS origem_interrupcao,
    coalesce({_SECONDS} / CAST(60 AS DOUBLE), 0.0) AS tempo_interrupcao_minutos,
    _ingest_timestamp, coalesce(_source_url, '') AS _source_url,
    coalesce(_source_last_modified, '') AS _source_last_modified, _ano_fonte, _tie,
    DatGeracaoConjuntoDados
  FROM ev WHERE DatInicioInterrupcao IS NOT NULL
),
natural_key AS (
  SELECT * FROM sv QUALIFY row_number() OVER (
    PARTITION BY cod_distribuidora, data_inicio, conjunto, tipo_interrupcao
    ORDER BY _ingest_timestamp DESC, DatGeracaoConjuntoDados DESC, data_fim DESC NULLS LAST, _tie DESC) = 1
)"""

_VALID = """(DatFimInterrupcao IS NULL OR DatInicioInterrupcao IS NULL
    OR DatFimInterrupcao > DatInicioInterrupcao)"""

_LATEST = _EV + f""",
newest AS (
  SELECT * FROM ev QUALIFY row_number() OVER (
    PARTITION BY NumOrdemInterrupcao
    ORDER BY DatGeracaoConjuntoDados DESC, DatFimInterrupcao DESC NULLS LAST, _tie DESC) = 1
),
latest AS (SELECT *, {_SECONDS} AS secs FROM newest WHERE {_VALID})"""

_GOLD_OUT = _LATEST + """,
go AS (
  SELECT SigAgente AS cod_distribuidora,
    CAST(year(DatInicioInterrupcao) AS INT) AS ano_referencia,
    CAST(month(DatInicioInterrupcao) AS INT) AS mes_referencia,
    CAST(sum(coalesce(secs, 0)) AS BIGINT) AS s,
    count(*) AS total_eventos, min(DatInicioInterrupcao) AS data_primeiro_evento,
    max(DatInicioInterrupcao) AS data_ultimo_evento
  FROM latest GROUP BY 1, 2, 3
)"""


def _pct(part: str, total: str) -> str:
    """Two decimals, half up, in integers."""
    return f"CAST((({part}) * 20000 + ({total})) // (2 * ({total})) AS DOUBLE) / 100.0"


def _hours(seconds: str) -> str:
    return f"round({seconds} / CAST(3600 AS DOUBLE), 2)"


_MIN = f"{_SECONDS} / CAST(60 AS DOUBLE)"
_ROW = "NumOrdemInterrupcao, _tie"
_STAMPS = "NumOrdemInterrupcao, _tie, DatInicioInterrupcao, DatFimInterrupcao"
_EVENT_COLUMNS = [
    "DatGeracaoConjuntoDados", "IdeConjuntoUnidadeConsumidora", "DscConjuntoUnidadeConsumidora",
    "DscAlimentadorSubestacao", "DscSubestacaoDistribuicao", "NumOrdemInterrupcao",
    "DscTipoInterrupcao", "IdeMotivoInterrupcao", "DatInicioInterrupcao", "DatFimInterrupcao",
    "DscFatoGeradorInterrupcao", "NumNivelTensao", "NumUnidadeConsumidora",
    "NumConsumidorConjunto", "NumAno", "NomAgenteRegulado", "SigAgente", "NumCPFCNPJ",
]
_ALL = ", ".join(_EVENT_COLUMNS)
_SNAKE = [
    "dat_geracao_conjunto_dados", "ide_conjunto_unidade_consumidora",
    "dsc_conjunto_unidade_consumidora", "dsc_alimentador_subestacao",
    "dsc_subestacao_distribuicao", "num_ordem_interrupcao", "dsc_tipo_interrupcao",
    "ide_motivo_interrupcao", "dat_inicio_interrupcao", "dat_fim_interrupcao",
    "dsc_fato_gerador_interrupcao", "num_nivel_tensao", "num_unidade_consumidora",
    "num_consumidor_conjunto", "num_ano", "nom_agente_regulado", "sig_agente", "num_cpfcnpj",
]
_TEXTS = {
    "DscConjuntoUnidadeConsumidora", "DscAlimentadorSubestacao", "DscSubestacaoDistribuicao",
    "NumOrdemInterrupcao", "DscTipoInterrupcao", "DscFatoGeradorInterrupcao",
    "NomAgenteRegulado", "SigAgente",
}
_CLASS = f"""CASE WHEN {_MIN} IS NULL THEN 'NAO_CALCULADA' WHEN {_MIN} <= 60 THEN 'CURTA'
    WHEN {_MIN} >= 1440 THEN 'LONGA' ELSE 'MEDIA' END"""
_DAYS = "datesub('day', DatInicioInterrupcao, DatFimInterrupcao)"
_FLAG = f"""CASE WHEN {_DAYS} > 30 THEN 'Duração extrema'
    WHEN {_DAYS} BETWEEN 7 AND 30 THEN 'Duração longa' ELSE 'Normal' END"""
_BAND = f"""CASE WHEN {_SECONDS} <= 86400 THEN 'ate 24 h' WHEN {_DAYS} < 7 THEN '1 a 6 dias'
    WHEN {_DAYS} <= 30 THEN '7 a 30 dias' WHEN {_DAYS} > 30 THEN 'mais de 30 dias' END"""
_GOOD = "NumUnidadeConsumidora > 0 AND DatFimInterrupcao > DatInicioInterrupcao AND NumNivelTensao <> 0"
_CALENDAR = """CAST({0} AS DATE) AS data_interrupcao, CAST(month({0}) AS INT) AS mes_interrupcao,
    CAST(dayofweek({0}) + 1 AS INT) AS dia_semana_interrupcao, CAST(hour({0}) AS INT) AS hora_inicio_interrupcao"""
_CAUSE_NAMES = [
    "fato_gerador_origem", "fato_gerador_natureza", "fato_gerador_categoria", "fato_gerador_detalhe",
]


def _causes(cause: str) -> str:
    parts = f"string_split(replace({cause}, '-', ';'), ';')"
    return ", ".join(
        f"nullif(trim({parts}[{i + 1}]), '') AS {n}" for i, n in enumerate(_CAUSE_NAMES)
    )


_TRIPLET = f"""{_SECONDS} AS duracao_segundos, round({_MIN}, 2) AS duracao_minutos,
    round({_SECONDS} / CAST(3600 AS DOUBLE), 4) AS duracao_horas"""

_HALVES = """
halves AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS ano, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS metade,
    strftime(max(o_orderdate) OVER (PARTITION BY year(o_orderdate)), '%Y-%m-%d') AS last_modified
  FROM orders
)"""

_MANIFEST = """
man AS (
  SELECT 'interrupcoes' AS fonte, CAST(year(o_orderdate) AS INT) AS ano,
    concat('landing/events_', CAST(year(o_orderdate) AS VARCHAR), '.parquet') AS url,
    strftime(max(o_orderdate), '%Y-%m-%d') AS last_modified, count(*) AS num_registros
  FROM orders GROUP BY ALL
),
led AS (
  SELECT fonte, ano, url,
    CASE WHEN ano <= 1996 THEN last_modified WHEN ano <= 1998 THEN '1990-01-01' ELSE '' END AS last_modified,
    CASE WHEN ano <= 1998 THEN 'SUCCESS' ELSE 'ERROR' END AS status,
    CAST(concat(CAST(ano + 1 AS VARCHAR), '-01-15 06:00:00') AS TIMESTAMP) AS timestamp_ingestao,
    CASE WHEN ano <= 1998 THEN num_registros ELSE 0 END AS num_registros
  FROM man WHERE ano <= 1999
)"""

_REGIONS = """
regions AS (
  SELECT s_name AS agente, n_name AS uf, r_name AS regiao FROM supplier
  LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_OBSERVED = _EV + f""",
conj AS (
  SELECT trim(SigAgente) AS distribuidora, CAST(year(DatInicioInterrupcao) AS BIGINT) AS ano,
    CAST(month(DatInicioInterrupcao) AS BIGINT) AS mes, IdeConjuntoUnidadeConsumidora AS c,
    CAST(sum(NumUnidadeConsumidora * {_SECONDS}) AS BIGINT) AS cs,
    CAST(sum(NumUnidadeConsumidora) AS BIGINT) AS ca, max(NumConsumidorConjunto) AS served
  FROM ev
  WHERE {_GOOD} AND {_SECONDS} >= 60 AND NumUnidadeConsumidora >= 1
    AND coalesce(lower(strip_accents(trim(DscTipoInterrupcao))), '') <> 'programada'
  GROUP BY ALL
),
obs AS (
  SELECT distribuidora, ano, mes, CAST(sum(cs) AS BIGINT) AS cs, CAST(sum(ca) AS BIGINT) AS ca,
    CAST(sum(served) AS DOUBLE) AS served
  FROM conj GROUP BY ALL
)"""

_OFFICIAL = _CELLS + """,
per_conj AS (
  SELECT distribuidora, ano, mes, id_conjunto_uc,
    max(valor) FILTER (WHERE indicador = 'DEC') AS d, max(valor) FILTER (WHERE indicador = 'FEC') AS f,
    max(valor) FILTER (WHERE indicador = 'NumCon') AS n
  FROM cells WHERE indicador IN ('DEC', 'FEC', 'NumCon') GROUP BY ALL
),
off AS (
  SELECT distribuidora, ano, mes, sum(n) AS consumidores,
    sum(d * n) / nullif(sum(n) FILTER (WHERE d IS NOT NULL), 0) AS dec_oficial,
    avg(d) AS dec_medio
  FROM per_conj GROUP BY ALL
)"""

_SEEN = """,
seen AS (
  SELECT distribuidora, ano, mes, coalesce(consumidores, served) AS consumidores,
    cs / CAST(3600 AS DOUBLE) / nullif(coalesce(consumidores, served), 0) AS dec_observado
  FROM obs LEFT JOIN off USING (distribuidora, ano, mes)
)"""


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {r}" for r in rows)


def _finding(name: str, metric: str, soft: bool = False) -> str:
    bad = "WARN" if soft else "FAIL"
    return (
        f"SELECT '{name}' AS verificacao, CASE WHEN ({metric}) <= 0 THEN 'PASS' ELSE '{bad}' END"
        f" AS status, CAST(({metric}) AS DOUBLE) AS metrica, CAST(0 AS DOUBLE) AS limite"
    )


_CRITICAL = ["NumOrdemInterrupcao", "NumAno", "SigAgente", "DscTipoInterrupcao"]
_MEANS = """,
means AS (
  SELECT distribuidora, ano, avg(valor) FILTER (WHERE indicador = 'DEC') AS dec_medio,
    avg(valor) FILTER (WHERE indicador = 'FEC') AS fec_medio
  FROM cells WHERE indicador IN ('DEC', 'FEC') GROUP BY ALL
)"""

_STEPS = _EV + f""",
d AS (
  SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY NumOrdemInterrupcao
    ORDER BY DatGeracaoConjuntoDados DESC, DatFimInterrupcao DESC NULLS LAST, _tie DESC) = 1
),
n AS (
  SELECT (SELECT count(*) FROM ev) AS n1, (SELECT count(*) FROM d) AS n2,
    (SELECT count(*) FROM d WHERE {_VALID}) AS n3,
    (SELECT count(*) FROM d WHERE {_VALID} AND DatFimInterrupcao IS NOT NULL
       AND DatInicioInterrupcao IS NOT NULL) AS n4
),
steps AS (
  SELECT 1 AS passo, 'bronze' AS etapa, n1 AS q, n1 FROM n
  UNION ALL SELECT 2, 'deduplicado', n2, n1 FROM n
  UNION ALL SELECT 3, 'temporal_valido', n3, n1 FROM n
  UNION ALL SELECT 4, 'com_duracao', n4, n1 FROM n
  UNION ALL SELECT 5, 'final', n3, n1 FROM n
)"""

def _gap(tolerance: float) -> str:
    """Sums ``l`` and ``r`` are in seconds, the result in minutes."""
    pct = "CASE WHEN l > 0 THEN CAST(abs(l - r) AS DOUBLE) / l * 100.0 ELSE 0.0 END"
    minute = "CAST(60 AS DOUBLE)"
    return (
        f"l / {minute} AS soma_origem, r / {minute} AS soma_destino,"
        f" abs(l - r) / {minute} AS diferenca, {pct} AS diferenca_perc,"
        f" CASE WHEN {pct} > {tolerance} THEN 'FAIL' ELSE 'PASS' END AS status"
    )


def _column_profile(rule: str, columns, count: str, pct: str) -> str:
    return _union(
        [
            f"'{c}' AS coluna, count(*) FILTER (WHERE {rule.format(c)}) AS {count},"
            f" {_pct(f'count(*) FILTER (WHERE {rule.format(c)})', 'count(*)')} AS {pct} FROM ev"
            for c in columns
        ]
    )


_PROBLEM_NULL = " OR ".join(
    f"{c} IS NULL"
    for c in [
        "NumOrdemInterrupcao", "DatInicioInterrupcao", "DatFimInterrupcao", "DscTipoInterrupcao",
        "NumUnidadeConsumidora", "NumConsumidorConjunto",
    ]
)
_PROBLEMS = {
    "campos_nulos_criticos": _PROBLEM_NULL,
    "duracao_zero": f"{_SECONDS} = 0",
    "duracao_7_a_30_dias": f"{_DAYS} BETWEEN 7 AND 30",
    "duracao_mais_30_dias": f"{_DAYS} > 30",
    "uc_zero": "NumUnidadeConsumidora = 0",
}


def _ev(select: str) -> str:
    return f"WITH {_EV} SELECT {select}"


def _dedupe(keys: str, columns: str) -> str:
    return _ev(
        f"""{columns} FROM ev QUALIFY row_number() OVER (PARTITION BY {keys}
        ORDER BY DatGeracaoConjuntoDados DESC, DatFimInterrupcao DESC NULLS LAST, _tie DESC) = 1"""
    )


ORACLES: dict[str, str] = {
    # scans
    "scan_events": _ev(f"{_ALL} FROM ev"),
    "scan_csv_landing": _ev(f"{_ALL} FROM ev"),
    "scan_year_in": f"""WITH {_IND} SELECT sigagente, ideconjundconsumidoras, anoindice,
        numperiodoindice, sigindicador, vlrindiceenviado FROM ind WHERE anoindice IN (1997, 1998)""",
    "scan_indicators_stored": f"""WITH {_IND} SELECT * EXCLUDE (_fonte_url, _ingest_ts, _tie)
        FROM ind WHERE anoindice IN (1997, 1998)""",
    "scan_by_name": _ev(f"{_ROW}, NumUnidadeConsumidora, _ano_fonte, 'OK' AS situacao, TRUE AS ausente FROM ev"),
    "scan_year_partition": _ev(
        f"""{_ROW}, DatInicioInterrupcao, NumUnidadeConsumidora, _ano_fonte FROM ev
        WHERE _ano_fonte IN (1997, 1998)"""
    ),
    "csv_quarantine": f"""WITH {_EV}, keyed AS (
          SELECT *, CAST(split_part(NumOrdemInterrupcao, '-', 1) AS BIGINT) AS k FROM ev
        ), told AS (SELECT *, CASE WHEN k % 61 = 0 OR k % 67 = 0 THEN 'campos'
            WHEN k % 53 = 0 AND k % 59 = 0 THEN 'tipo: DatInicioInterrupcao, NumNivelTensao' WHEN k % 53 = 0 THEN 'tipo: NumNivelTensao'
            WHEN k % 59 = 0 THEN 'tipo: DatInicioInterrupcao, NumNivelTensao' ELSE 'aceita' END AS motivo FROM keyed)
        SELECT motivo, NumOrdemInterrupcao, CASE WHEN motivo = 'aceita' THEN NumUnidadeConsumidora END AS NumUnidadeConsumidora FROM told""",
    "merge_schema_widened": _ev(
        """NumOrdemInterrupcao, _tie, NumAno,
        CASE WHEN NumAno < 1997 THEN date_trunc('day', DatInicioInterrupcao) ELSE DatInicioInterrupcao END AS DatInicioInterrupcao,
        NumUnidadeConsumidora,
        CASE WHEN NumAno >= 2000 OR (NumAno < 1997 AND NumNivelTensao = 0) THEN NULL ELSE NumNivelTensao END AS NumNivelTensao,
        CASE WHEN NumAno < 1997 AND NumNivelTensao = 0 THEN 1 ELSE 0 END AS _falhas_conversao FROM ev"""
    ),
    # sinks
    "replace_year_idempotent": _ev(
        """_ano_fonte, count(*) AS linhas, count(DISTINCT NumOrdemInterrupcao) AS ordens,
        CAST(sum(NumUnidadeConsumidora) AS BIGINT) AS unidades FROM ev GROUP BY _ano_fonte"""
    ),
    "write_match_check": "SELECT count(*) AS rows_written, count(*) AS rows_in_table, true AS matches FROM lineitem",
    **{
        name: _ev(
            f"""{_ROW}, NumAno, CASE WHEN NumAno >= 1998 THEN NumNivelTensao END AS NumNivelTensao,
            CASE WHEN NumAno < 1998 THEN DscTipoInterrupcao END AS DscTipoInterrupcao FROM ev"""
        )
        for name in ("merge_schema_union", "merge_schema_read")
    },
    "bronze_provenance": _ev(
        f"""{_ROW}, DatInicioInterrupcao, 'landing/events.parquet' AS _source_url,
        '2024-01-01' AS _source_last_modified, CAST(2024 AS INT) AS _ano_fonte,
        DATE '2024-01-02' AS _ingest_date FROM ev"""
    ),
    "bronze_provenance_run": f"""WITH {_IND} SELECT sigagente, sigindicador, vlrindiceenviado, _tie,
        'landing/indicators.parquet' AS _fonte_url, DATE '2024-01-02' AS _ingest_date,
        '20240102060000' AS _run_id FROM ind""",
    "bronze_provenance_file": _ev(
        f"{_ROW}, 'landing/events.parquet' AS _arquivo_fonte, CAST(2024 AS INT) AS _ano_referencia FROM ev"
    ),
    "ledger_entries": f"""WITH {_EV}, {_MANIFEST},
        loaded AS (SELECT _ano_fonte AS ano, count(*) AS n FROM ev GROUP BY ALL)
        SELECT fonte, ano, url, CASE WHEN ok THEN last_modified ELSE '' END AS last_modified,
          CASE WHEN ok THEN 'SUCCESS' ELSE 'ERROR' END AS status,
          CASE WHEN ok THEN n ELSE 0 END AS num_registros,
          CASE WHEN ok THEN 'carga concluida' WHEN ano = 1998 THEN 'arquivo ilegivel'
               ELSE 'sem registros' END AS mensagem
        FROM (SELECT fonte, ano, url, last_modified, n, coalesce(n, 0) > 0 AND ano <> 1998 AS ok
              FROM man LEFT JOIN loaded USING (ano))""",
    "ledger_pending": f"""WITH {_MANIFEST} SELECT * FROM man WHERE ano NOT IN
        (SELECT ano FROM led WHERE status = 'SUCCESS')""",
    "ledger_pending_version": f"""WITH {_MANIFEST} SELECT * FROM man WHERE (ano, last_modified) NOT IN
        (SELECT (ano, last_modified) FROM led WHERE status = 'SUCCESS')""",
    "ledger_pending_files": f"""WITH {_HALVES} SELECT 'interrupcoes' AS fonte, ano,
        'landing/events_' || ano || '_' || metade || '.parquet' AS url, last_modified
        FROM halves WHERE ano > 1996 OR (ano = 1995 AND metade = 2)""",
    "ingest_files": f"""WITH {_EV}, found AS (
          SELECT _ano_fonte AS ano, CASE WHEN month(DatGeracaoConjuntoDados) <= 6 THEN 1 ELSE 2 END AS metade,
            count(*) AS n, _ano_fonte = 1998 AND month(any_value(DatGeracaoConjuntoDados)) > 6 AS missing
          FROM ev GROUP BY 1, 2)
        SELECT 'interrupcoes' AS fonte, ano, metade, CASE WHEN missing THEN 'ERROR' ELSE 'SUCCESS' END AS status,
          CAST(CASE WHEN missing THEN 2 ELSE 1 END AS BIGINT) AS tentativas,
          CASE WHEN missing THEN 0 ELSE n END AS num_registros, CASE WHEN missing THEN 0 ELSE n END AS linhas_bronze,
          missing AS pendente FROM found""",
    "ledger_summary": f"""WITH {_MANIFEST} SELECT fonte, count(*) AS total_ingestoes,
        count(*) FILTER (WHERE status = 'SUCCESS') AS sucessos,
        count(*) FILTER (WHERE status = 'ERROR') AS erros,
        CAST(sum(num_registros) AS BIGINT) AS total_registros,
        max(timestamp_ingestao) AS ultima_ingestao FROM led GROUP BY fonte""",
    "sample_n": _ev(
        f"""{_ROW}, SigAgente, DatInicioInterrupcao, DatFimInterrupcao, DscTipoInterrupcao
        FROM ev ORDER BY NumOrdemInterrupcao, _tie LIMIT 10"""
    ),
    "run_summary": f"""WITH {_EV}, {_IND.strip()}, kept AS (
          SELECT *, CASE WHEN DatFimInterrupcao IS NULL THEN 0 ELSE {_SECONDS} END AS s FROM ev
          WHERE DatInicioInterrupcao IS NOT NULL QUALIFY row_number() OVER (
            PARTITION BY SigAgente, DatInicioInterrupcao, coalesce(DscConjuntoUnidadeConsumidora, 'NAO_INFORMADO'),
              coalesce(DscTipoInterrupcao, 'NAO_CLASSIFICADO')
            ORDER BY DatFimInterrupcao DESC NULLS LAST) = 1
        ), span AS (SELECT max(year(o_orderdate)) - min(year(o_orderdate)) + 2 AS y FROM orders
        ), stages(fluxo, ordem, etapa, anos, linhas, eventos, segundos) AS (
          SELECT 'interrupcoes', 0, 'bronze', count(DISTINCT _ano_fonte), count(*), count(*), NULL FROM ev
          UNION ALL SELECT 'interrupcoes', 1, 'silver', any_value(y), count(*), count(*), sum(s) FROM kept, span
          UNION ALL SELECT 'interrupcoes', 2, 'gold', any_value(y),
            count(DISTINCT (SigAgente, year(DatInicioInterrupcao), month(DatInicioInterrupcao))), count(*), sum(s) FROM kept, span
          UNION ALL SELECT 'indicadores', 0, 'bronze', any_value(y), count(*), count(*), NULL FROM ind, span
          UNION ALL SELECT 'indicadores', 1, 'silver', 0, count(*), count(*), NULL FROM ind
          UNION ALL SELECT 'indicadores', 2, 'largo', y, n, n, NULL FROM span, (SELECT count(DISTINCT (
            sigagente, ideconjundconsumidoras, anoindice, numperiodoindice)) AS n FROM ind)
          UNION ALL SELECT 'indicadores', 3, 'gold', 0, n, n, NULL FROM (
            SELECT count(DISTINCT (sigagente, anoindice, numperiodoindice)) AS n FROM ind))
        SELECT fluxo, etapa, anos, linhas, eventos, lag(eventos) OVER step - eventos AS removidos,
          CAST(segundos AS BIGINT) AS segundos, CAST(segundos - lag(segundos) OVER step AS BIGINT) AS diferenca_segundos
        FROM stages WINDOW step AS (PARTITION BY fluxo ORDER BY ordem)""",
    # derivations
    "conform_events": f"WITH {_SILVER} SELECT * EXCLUDE (DatGeracaoConjuntoDados) FROM sv",
    "conform_events_detailed": _ev(
        ", ".join(
            f"trim({c}) AS {s}" if c in _TEXTS else f"{c} AS {s}"
            for c, s in zip(_EVENT_COLUMNS, [*_SNAKE[:-1], "num_cnpj"])
        )
        + f", {_causes('trim(DscFatoGeradorInterrupcao)')}, {_TRIPLET},"
        + _CALENDAR.format("DatInicioInterrupcao")
        + f""", lpad(CAST(NumCPFCNPJ AS VARCHAR), 14, '0') AS cnpj_formatado,
        round(NumNivelTensao / 1000.0, 3) AS nivel_tensao_kv FROM ev WHERE {_GOOD}"""
    ),
    "conform_indicators_stamped": f"""WITH {_IND} SELECT trim(sigagente) AS distribuidora, trim(sigindicador) AS indicador,
        vlrindiceenviado AS valor, _tie, TIMESTAMP '2024-01-02 06:00:00' AS _processado_em, DATE '2024-01-02' AS _data_processamento,
        'v1.0.0' AS _versao_silver, '20240102060000' AS _run_id_silver FROM ind""",
    "conform_indicators_long": f"WITH {_LONG} SELECT * FROM lng",
    "duration_minutes_zero": _ev(f"{_STAMPS}, coalesce({_MIN}, 0.0) AS duracao_minutos FROM ev"),
    "duration_minutes_null": _ev(f"{_STAMPS}, {_MIN} AS duracao_minutos FROM ev"),
    "duration_hours": _ev(f"{_STAMPS}, {_SECONDS} / CAST(3600 AS DOUBLE) AS duracao_horas FROM ev"),
    "duration_triplet": _ev(f"{_STAMPS}, {_TRIPLET} FROM ev"),
    "duration_minutes_trunc": _ev(
        f"""{_STAMPS}, datesub('minute', DatInicioInterrupcao, DatFimInterrupcao) AS duracao_minutos,
        datesub('minute', DatInicioInterrupcao, DatFimInterrupcao) / CAST(60 AS DOUBLE) AS duracao_horas FROM ev"""
    ),
    "duration_class": _ev(f"{_STAMPS}, {_MIN} AS duracao_minutos, {_CLASS} AS classe_duracao FROM ev"),
    "duration_flag": _ev(f"{_STAMPS}, {_FLAG} AS flag_duracao FROM ev"),
    "duration_bands": _ev(
        f"""faixa_duracao, count(*) AS qtd_registros,
        {_pct('count(*)', '(SELECT count(*) FROM ev)')} AS pct
        FROM (SELECT {_BAND} AS faixa_duracao FROM ev) GROUP BY faixa_duracao"""
    ),
    "scheduled_flag": _ev(
        f"{_ROW}, DscTipoInterrupcao, coalesce(DscTipoInterrupcao = 'Programada', false) AS programada FROM ev"
    ),
    "normalize_names": _ev(
        """NumOrdemInterrupcao AS numordeminterrupcao, _tie, DatInicioInterrupcao AS data_de_inicio,
        NumNivelTensao AS tensao_v, NumUnidadeConsumidora AS ucs_atingidas_regiao FROM ev"""
    ),
    "normalize_names_snake": _ev(
        ", ".join(f"{c} AS {s}" for c, s in zip(_EVENT_COLUMNS, _SNAKE)) + " FROM ev"
    ),
    "trim_text": f"""WITH {_IND} SELECT upper(trim(sigagente)) AS sigagente,
        trim(dscconjundconsumidoras) AS dscconjundconsumidoras, sigindicador, _tie FROM ind""",
    "period_month": f"WITH {_LONG} SELECT distribuidora, ano, mes, data_apuracao, _tie FROM lng",
    "composite_key": f"""WITH {_WIDE} SELECT sigagente, ideconjundconsumidoras, anoindice,
        numperiodoindice, concat(trim(sigagente), '#', distribuidora, '#', CAST(anoindice AS VARCHAR))
        AS chave_composta, chave_uc FROM w""",
    "cause_levels": _ev(
        f"{_ROW}, DscFatoGeradorInterrupcao, {_causes('DscFatoGeradorInterrupcao')} FROM ev"
    ),
    "cnpj_format": _ev(
        f"{_ROW}, NumCPFCNPJ, lpad(CAST(NumCPFCNPJ AS VARCHAR), 14, '0') AS cnpj_formatado FROM ev"
    ),
    "voltage_kv": _ev(
        f"{_ROW}, NumNivelTensao, round(NumNivelTensao / 1000.0, 3) AS nivel_tensao_kv FROM ev"
    ),
    "calendar_fields": _ev(
        f"{_ROW}, DatInicioInterrupcao, {_CALENDAR.format('DatInicioInterrupcao')} FROM ev"
    ),
    "enrich_region": f"""WITH {_EV}, {_REGIONS} SELECT {_ROW}, trim(SigAgente) AS SigAgente, uf, regiao
        FROM ev LEFT JOIN regions ON trim(SigAgente) = agente""",
    # filters
    "null_drops": _ev(
        """unnest([
          {'coluna': 'DscTipoInterrupcao', 'removidas': count(*) FILTER (WHERE DscTipoInterrupcao IS NULL),
           'restantes': count(DscTipoInterrupcao)},
          {'coluna': 'SigAgente', 'removidas': CAST(0 AS BIGINT), 'restantes': count(DscTipoInterrupcao)},
          {'coluna': 'NumAno', 'removidas': CAST(0 AS BIGINT), 'restantes': count(DscTipoInterrupcao)},
          {'coluna': 'NumOrdemInterrupcao', 'removidas': CAST(0 AS BIGINT), 'restantes': count(DscTipoInterrupcao)}],
          recursive := true) FROM ev"""
    ),
    "drop_critical_nulls": _ev(
        f"""{', '.join(_CRITICAL)}, _tie FROM ev WHERE
        {' AND '.join(f'{c} IS NOT NULL' for c in _CRITICAL)}"""
    ),
    "temporal_invalid": _ev(
        f"{_STAMPS}, DscTipoInterrupcao FROM ev WHERE DatFimInterrupcao <= DatInicioInterrupcao"
    ),
    "temporal_valid": _ev(f"{_STAMPS} FROM ev WHERE {_VALID}"),
    "long_outages": _ev(f"{_STAMPS} FROM ev WHERE {_MIN} > 1440"),
    "quality_filter": _ev(f"{_STAMPS}, NumUnidadeConsumidora, NumNivelTensao FROM ev WHERE {_GOOD}"),
    "dec_event_filter": _ev(
        f"""{_STAMPS}, DscTipoInterrupcao, NumUnidadeConsumidora FROM ev WHERE {_MIN} >= 1
        AND NumUnidadeConsumidora >= 1
        AND lower(strip_accents(trim(DscTipoInterrupcao))) IN ('emergencial', 'nao programada')"""
    ),
    "cause_containing": _ev(
        f"{_ROW}, DscFatoGeradorInterrupcao FROM ev WHERE DscFatoGeradorInterrupcao LIKE '%ECONOMY%'"
    ),
    "invalid_class": _ev(
        f"""* FROM (SELECT {_STAMPS}, {_MIN} AS duracao_minutos, {_CLASS} AS classe_duracao FROM ev)
        WHERE classe_duracao NOT IN ('CURTA', 'MEDIA', 'LONGA')"""
    ),
    "indicators_slice": f"""WITH {_LONG} SELECT id_conjunto_uc, conjunto_uc, distribuidora, indicador,
        valor, data_apuracao, ano, mes FROM lng WHERE indicador IN ('DEC', 'FEC')
        AND data_apuracao >= DATE '1998-01-01' AND mes = 8""",
    # deduplication
    "dedupe_natural_key": f"WITH {_SILVER} SELECT * FROM natural_key",
    "dedupe_order_number": _dedupe(
        "NumOrdemInterrupcao",
        "NumOrdemInterrupcao, DatGeracaoConjuntoDados, DatInicioInterrupcao, DatFimInterrupcao, SigAgente, _tie",
    ),
    "dedupe_order_uc": _dedupe(
        "NumOrdemInterrupcao, NumUnidadeConsumidora",
        "NumOrdemInterrupcao, NumUnidadeConsumidora, DatGeracaoConjuntoDados, DatInicioInterrupcao, DatFimInterrupcao, _tie",
    ),
    "dedupe_conjunto_start": _dedupe(
        "IdeConjuntoUnidadeConsumidora, DatInicioInterrupcao",
        "IdeConjuntoUnidadeConsumidora, DatInicioInterrupcao, DatGeracaoConjuntoDados, DatFimInterrupcao, _tie",
    ),
    "dedupe_indicators": f"""WITH {_CELLS} SELECT distribuidora, id_conjunto_uc, ano, mes, indicador,
        valor, ingest_ts_bronze FROM cells""",
    "dedupe_across_loads": f"""WITH {_EV}, found AS (
          SELECT coalesce(SigAgente, 'DESCONHECIDO') AS cod_distribuidora, date_trunc('month', DatInicioInterrupcao) AS data_inicio,
            coalesce(DscConjuntoUnidadeConsumidora, 'NAO_INFORMADO') AS conjunto,
            coalesce(DscTipoInterrupcao, 'NAO_CLASSIFICADO') AS tipo_interrupcao, DatFimInterrupcao AS data_fim,
            coalesce(DscFatoGeradorInterrupcao, 'NAO_INFORMADO') AS origem_interrupcao,
            coalesce((CAST(floor(epoch(DatFimInterrupcao)) AS BIGINT)
              - CAST(floor(epoch(date_trunc('month', DatInicioInterrupcao))) AS BIGINT)) / CAST(60 AS DOUBLE), 0.0)
              AS tempo_interrupcao_minutos,
            _ingest_timestamp, _source_url, coalesce(_source_last_modified, '') AS _source_last_modified, _ano_fonte
          FROM ev)
        SELECT * FROM found QUALIFY row_number() OVER (
          PARTITION BY cod_distribuidora, data_inicio, conjunto, tipo_interrupcao
          ORDER BY _ingest_timestamp DESC, data_fim DESC NULLS LAST, origem_interrupcao DESC) = 1""",
    # gold and reports
    "gold_outage_month": f"""WITH {_GOLD_OUT} SELECT cod_distribuidora, ano_referencia, mes_referencia,
        s / CAST(60 AS DOUBLE) AS tempo_total_minutos, {_hours('s')} AS tempo_total_horas,
        total_eventos, data_primeiro_evento, data_ultimo_evento FROM go""",
    "gold_outage_stamped": f"""WITH {_GOLD_OUT} SELECT cod_distribuidora, ano_referencia, mes_referencia,
        s / CAST(60 AS DOUBLE) AS tempo_total_minutos, {_hours('s')} AS tempo_total_horas,
        total_eventos, data_primeiro_evento, data_ultimo_evento, TIMESTAMP '2024-01-02 06:00:00' AS _gold_timestamp FROM go""",
    "gold_outage_month_clipped": f"""WITH {_EV}, g AS (
        SELECT SigAgente AS cod_distribuidora, CAST(year(DatInicioInterrupcao) AS INT) AS ano_referencia,
          CAST(month(DatInicioInterrupcao) AS INT) AS mes_referencia,
          CAST(sum(greatest(coalesce({_SECONDS}, 0), 0)) AS BIGINT) AS s, count(*) AS total_eventos,
          min(DatInicioInterrupcao) AS data_primeiro_evento, max(DatInicioInterrupcao) AS data_ultimo_evento
        FROM ev GROUP BY 1, 2, 3)
        SELECT cod_distribuidora, ano_referencia, mes_referencia, s / CAST(60 AS DOUBLE) AS tempo_total_minutos,
        {_hours('s')} AS tempo_total_horas, total_eventos, data_primeiro_evento, data_ultimo_evento FROM g""",
    "indicators_wide": f"WITH {_WIDE} SELECT * FROM w",
    "indicators_wide_legacy": f"""WITH {_WIDE} SELECT * EXCLUDE (ideconjundconsumidoras, numcnpj,
        numperiodoindice) REPLACE (make_date(anoindice, 1, 1) AS periodo_apuracao) FROM w""",
    "conflicting_cells": f"""WITH {_IND}, c AS (SELECT sigagente, ideconjundconsumidoras, anoindice,
        numperiodoindice, numcnpj + CAST(floor(_tie) AS BIGINT) % 2 AS k FROM ind)
        SELECT sigagente, ideconjundconsumidoras, anoindice, numperiodoindice, min(k) AS menor_cnpj,
        max(k) AS maior_cnpj FROM c GROUP BY 1, 2, 3, 4 HAVING min(k) <> max(k)""",
    "dec_fec_evolution": f"""WITH {_LONG}, m AS (
        SELECT distribuidora, data_apuracao, max(valor) FILTER (WHERE indicador = 'DEC') AS dec_horas,
          max(valor) FILTER (WHERE indicador = 'FEC') AS fec_qtd,
          max(valor) FILTER (WHERE indicador = 'NumCon') AS num_consumidores
        FROM lng WHERE indicador IN ('DEC', 'FEC', 'NumCon') AND ano = 1998 GROUP BY 1, 2)
        SELECT *, round(dec_horas * num_consumidores, 2) AS dec_total_horas FROM m
        WHERE num_consumidores > 4000 ORDER BY distribuidora, data_apuracao LIMIT 50""",
    "gold_indicator_month": f"WITH {_GOLD_IND} SELECT * EXCLUDE (prev) FROM gi",
    "gold_indicator_month_strict": f"""WITH {_GOLD_IND} SELECT distribuidora, ano, mes, dec_medio,
        CASE WHEN ano * 12 + mes - lag(ano * 12 + mes) OVER (PARTITION BY distribuidora ORDER BY ano, mes) = 1
        THEN prev END AS dec_medio_mes_anterior FROM gi""",
    "count_by_agent": _ev(
        "SigAgente, count(*) AS qtd_registros FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "count_by_type": _ev("DscTipoInterrupcao, count(*) AS qtd_registros FROM ev GROUP BY 1"),
    "count_by_indicator": f"WITH {_IND} SELECT sigindicador, count(*) AS qtd_registros FROM ind GROUP BY 1",
    "count_by_year": f"WITH {_IND} SELECT anoindice, count(*) AS qtd_registros FROM ind GROUP BY 1 ORDER BY 1",
    "count_by_cause": _ev(
        f"""fato_gerador_origem, count(*) AS qtd_registros FROM
        (SELECT {_causes('DscFatoGeradorInterrupcao')} FROM ev) GROUP BY 1
        ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10"""
    ),
    "dist_by_type": _ev(
        """DscTipoInterrupcao, count(*) AS qtd_registros,
        count(DISTINCT NumOrdemInterrupcao) AS qtd_ordens_unicas FROM ev GROUP BY 1"""
    ),
    "dist_by_distributor": _ev("SigAgente, NomAgenteRegulado, count(*) AS qtd_registros FROM ev GROUP BY 1, 2"),
    "dist_by_voltage": _ev("NumNivelTensao, count(*) AS qtd_registros FROM ev GROUP BY 1"),
    "duration_stats": _ev(
        f"""min({_MIN}) AS min_minutos, max({_MIN}) AS max_minutos,
        CAST(sum({_SECONDS}) AS BIGINT) / CAST(count({_SECONDS}) AS DOUBLE) / 60.0 AS media_minutos,
        quantile_disc({_MIN}, 0.50) AS mediana_minutos, quantile_disc({_MIN}, 0.95) AS p95_minutos,
        quantile_disc({_MIN}, 0.99) AS p99_minutos FROM ev"""
    ),
    "duration_stats_hours": _ev(
        f"""CAST(sum({_SECONDS}) AS BIGINT) / CAST(count({_SECONDS}) AS DOUBLE) / 3600.0 AS media_horas,
        min({_SECONDS}) / 3600.0 AS min_horas, max({_SECONDS}) / 3600.0 AS max_horas,
        round(stddev({_SECONDS} / 3600.0), 6) AS desvio_padrao FROM ev"""
    ),
    "longest_events": f"""WITH {_LATEST} SELECT NumOrdemInterrupcao, DatFimInterrupcao, _tie,
        DatInicioInterrupcao, SigAgente, DscTipoInterrupcao, {_MIN} AS duracao_minutos,
        {_CLASS} AS classe_duracao FROM latest
        ORDER BY duracao_minutos DESC NULLS LAST, NumOrdemInterrupcao LIMIT 10""",
    "long_outage_share": _ev(
        f"""count({_SECONDS}) AS com_duracao, count(*) FILTER (WHERE {_SECONDS} > 86400) AS qtd_longas,
        {_pct(f'count(*) FILTER (WHERE {_SECONDS} > 86400)', f'count({_SECONDS})')} AS pct_longas FROM ev"""
    ),
    "period_covered": "SELECT min(l_shipdate) AS inicio, max(l_shipdate) AS fim FROM lineitem",
    "period_covered_gold": f"WITH {_GOLD_IND} SELECT min(ano_mes) AS inicio, max(ano_mes) AS fim FROM gi",
    "distinct_agents": f"WITH {_IND} SELECT count(DISTINCT trim(sigagente)) AS total FROM ind",
    "indicator_stats": f"""WITH {_IND} SELECT sigindicador, avg(vlrindiceenviado) AS media,
        min(vlrindiceenviado) AS minimo, max(vlrindiceenviado) AS maximo, count(*) AS quantidade
        FROM ind GROUP BY 1 ORDER BY quantidade DESC, 1 LIMIT 10""",
    "indicator_spread": f"""WITH {_LONG} SELECT indicador, avg(valor) AS media,
        round(stddev(valor), 6) AS desvio_padrao, count(*) AS quantidade
        FROM lng GROUP BY 1 ORDER BY quantidade DESC, 1 LIMIT 10""",
    "top_outage_time": _ev(
        f"""trim(SigAgente) AS sig_agente, CAST(sum({_SECONDS}) AS BIGINT) / CAST(3600 AS DOUBLE) AS total_horas,
        count(*) AS qtd_interrupcoes FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
    ),
    "top_mean_dec": f"""WITH {_LONG} SELECT distribuidora, avg(valor) AS dec_medio, count(*) AS qtd_medicoes
        FROM lng WHERE indicador = 'DEC' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "top_dec_year": f"""WITH {_GOLD_IND} SELECT distribuidora, round(avg(dec_medio), 6) AS dec_medio_anual,
        sum(numcon_total) AS total_consumidores, count(*) AS meses_registrados
        FROM gi WHERE ano = 1998 GROUP BY 1 ORDER BY avg(dec_medio) DESC, 1 LIMIT 5""",
    "gold_overall": f"""WITH {_GOLD_IND} SELECT round(avg(dec_medio), 6) AS media_dec_medio,
        round(avg(fec_medio), 6) AS media_fec_medio, round(avg(numcon_total), 6) AS media_consumidores FROM gi""",
    "variation_stats": f"""WITH {_GOLD_IND} SELECT round(avg(variacao_perc_mes_anterior), 6) AS variacao_media,
        round(stddev(variacao_perc_mes_anterior), 6) AS desvio_padrao,
        round(min(variacao_perc_mes_anterior), 6) AS min_variacao,
        round(max(variacao_perc_mes_anterior), 6) AS max_variacao
        FROM gi WHERE variacao_perc_mes_anterior IS NOT NULL""",
    "coverage": f"""WITH {_LONG} SELECT min(data_apuracao) AS data_inicio, max(data_apuracao) AS data_fim,
        count(DISTINCT data_apuracao) AS total_periodos, count(DISTINCT ano) AS total_anos,
        count(DISTINCT mes) AS total_meses FROM lng""",
    "indicator_distribution": f"""WITH {_LONG} SELECT indicador, count(*) AS total_registros,
        count(DISTINCT distribuidora) AS total_distribuidoras,
        {_pct('count(*)', '(SELECT count(*) FROM lng)')} AS percentual FROM lng GROUP BY 1""",
    "top_volume": f"""WITH {_LONG} SELECT distribuidora, count(*) AS total_registros,
        count(DISTINCT indicador) AS indicadores_reportados, min(data_apuracao) AS primeira_data,
        max(data_apuracao) AS ultima_data FROM lng GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "class_distribution": _ev(
        f"""classe_duracao, count(*) AS qtd_registros,
        {_pct('count(*)', '(SELECT count(*) FROM ev)')} AS pct
        FROM (SELECT {_CLASS} AS classe_duracao FROM ev) GROUP BY 1"""
    ),
    "cause_analysis": _ev(
        f"""{', '.join(_CAUSE_NAMES)}, count(*) AS qtd_eventos,
        CAST(coalesce(sum(secs), 0) AS BIGINT) / CAST(3600 AS DOUBLE) AS total_horas,
        CAST(sum(NumUnidadeConsumidora) AS BIGINT) AS consumidores_afetados
        FROM (SELECT {_causes('trim(DscFatoGeradorInterrupcao)')}, {_SECONDS} AS secs, NumUnidadeConsumidora FROM ev)
        GROUP BY 1, 2, 3, 4"""
    ),
    "cause_rollup": _ev(
        f"""CAST(4 - bit_count(GROUPING({', '.join(_CAUSE_NAMES)})) AS INT) AS nivel, {', '.join(_CAUSE_NAMES)},
        count(*) AS qtd_eventos, CAST(sum(secs) AS BIGINT) AS total_segundos,
        CAST(sum(NumUnidadeConsumidora) AS BIGINT) AS consumidores_afetados
        FROM (SELECT {_causes('trim(DscFatoGeradorInterrupcao)')}, coalesce({_SECONDS}, 0) AS secs, NumUnidadeConsumidora FROM ev)
        GROUP BY ROLLUP ({', '.join(_CAUSE_NAMES)})"""
    ),
    "conjunto_ranking": _ev(
        f"""SigAgente, IdeConjuntoUnidadeConsumidora, s / CAST(3600 AS DOUBLE) AS total_horas, qtd_eventos,
        CAST(rank() OVER (PARTITION BY SigAgente ORDER BY s DESC) AS INT) AS posicao FROM (
          SELECT SigAgente, IdeConjuntoUnidadeConsumidora, CAST(sum({_SECONDS}) AS BIGINT) AS s,
            count(*) AS qtd_eventos FROM ev WHERE {_GOOD} GROUP BY 1, 2)"""
    ),
    "consumers_stats": _ev("avg(NumUnidadeConsumidora) AS media, max(NumUnidadeConsumidora) AS maximo FROM ev"),
    "distinct_agents_stored_sketch": _ev(
        """count(DISTINCT (SigAgente, IdeConjuntoUnidadeConsumidora, CAST(DatInicioInterrupcao AS DATE))) AS exato,
        TRUE AS within_bound FROM ev"""
    ),
    "duration_quantiles_stored_sketch": _ev(
        """unnest(['mediana', 'p95', 'p99']) AS quantil, count(DatFimInterrupcao) AS valores, TRUE AS within_bound FROM ev"""
    ),
    # checks
    "check_columns": f"WITH {_EV} "
    + _union(
        [
            f"'{c}' AS coluna, true AS presente, count({c}) AS preenchidos, count(*) AS linhas FROM ev"
            for c in [*_CRITICAL, "DatInicioInterrupcao", "DatFimInterrupcao"]
        ]
        + ["'DscMotivo', false, 0, count(*) FROM ev"]
    ),
    "check_report": f"""WITH {_EV},
        keys AS (SELECT NumOrdemInterrupcao, count(*) AS n FROM ev GROUP BY 1) """
    + " UNION ALL ".join(
        [
            _finding("coluna_ausente:DscMotivo", "1"),
            _finding("sem_linhas", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ev"),
            _finding("chaves_repetidas", "SELECT count(*) FROM keys WHERE n > 1"),
            *[_finding(f"nulos:{c}", f"SELECT count(*) FROM ev WHERE {c} IS NULL") for c in _CRITICAL],
            _finding("faixa:duracao_minutos", f"SELECT count(*) FROM ev WHERE {_SECONDS} < 0", soft=True),
            _finding("faixa:NumUnidadeConsumidora", "SELECT count(*) FROM ev WHERE NumUnidadeConsumidora < 1"),
            _finding("dominio:classe_duracao", "SELECT 0"),
            _finding("temporal", "SELECT count(*) FROM ev WHERE DatFimInterrupcao <= DatInicioInterrupcao"),
        ]
    ),
    "dup_keys": _ev("NumOrdemInterrupcao, count(*) AS qtd FROM ev GROUP BY 1 HAVING count(*) > 1"),
    "check_unique": f"""WITH {_SILVER}, k AS (SELECT count(*) AS n FROM natural_key
        GROUP BY cod_distribuidora, data_inicio, conjunto, tipo_interrupcao)
        SELECT count(*) AS chaves, count(*) FILTER (WHERE n > 1) AS chaves_repetidas,
        CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS linhas_envolvidas FROM k""",
    "check_nulls": f"WITH {_EV} "
    + _union([f"'{c}' AS coluna, count(*) FILTER (WHERE {c} IS NULL) AS qtd_nulos FROM ev" for c in _CRITICAL]),
    "check_range": _ev(
        f"""count(*) AS linhas, count(*) FILTER (WHERE {_SECONDS} IS NULL) AS nulos,
        count(*) FILTER (WHERE {_SECONDS} < 0) AS negativos FROM ev"""
    ),
    "check_duration": f"""WITH {_LATEST} SELECT count(*) FILTER (WHERE secs < 0) AS negativas,
        count(*) FILTER (WHERE DatFimInterrupcao IS NOT NULL AND DatInicioInterrupcao IS NOT NULL
          AND secs IS NULL) AS nulas_invalidas FROM latest""",
    "check_classes": f"""WITH {_LATEST} SELECT count(*) AS linhas, count({_CLASS}) AS classificadas,
        count(*) FILTER (WHERE {_CLASS} NOT IN ('NAO_CALCULADA', 'CURTA', 'MEDIA', 'LONGA')) AS invalidas
        FROM latest""",
    "reconcile_counts": f"""WITH {_SILVER} SELECT (SELECT count(*) FROM ev) AS bronze,
        (SELECT count(*) FROM sv) AS conformado, (SELECT count(*) FROM natural_key) AS silver,
        (SELECT count(*) FROM ev) - (SELECT count(*) FROM sv) AS excluidos_data_nula,
        (SELECT count(*) FROM sv) - (SELECT count(*) FROM natural_key) AS duplicatas_removidas""",
    "reconcile_sum_silver": f"""WITH {_SILVER}, p AS (SELECT
        (SELECT CAST(sum(tempo_interrupcao_minutos * 60) AS BIGINT) FROM sv) AS l,
        (SELECT CAST(sum(tempo_interrupcao_minutos * 60) AS BIGINT) FROM natural_key) AS r)
        SELECT {_gap(1.0)} FROM p""",
    "reconcile_sum_gold": f"""WITH {_GOLD_OUT}, p AS (SELECT
        (SELECT CAST(sum(coalesce(secs, 0)) AS BIGINT) FROM latest) AS l,
        (SELECT CAST(sum(s) AS BIGINT) FROM go) AS r) SELECT {_gap(0.01)} FROM p""",
    "reconcile_steps": f"""WITH {_STEPS} SELECT CAST(passo AS INT) AS passo, etapa, q AS qtd_registros,
        greatest(n1 - q, 0) AS reducao, {_pct('q', 'n1')} AS pct_retencao,
        {_pct('q', 'n1')} >= 95.0 AS aceitavel FROM steps""",
    "filtered_share": _ev(
        f"""count(*) AS bronze, count(*) FILTER (WHERE {_GOOD}) AS silver,
        count(*) - count(*) FILTER (WHERE {_GOOD}) AS filtrados,
        {_pct(f'count(*) - count(*) FILTER (WHERE {_GOOD})', 'count(*)')} AS perc_filtrado FROM ev"""
    ),
    "null_keys": f"WITH {_LONG} SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulos_{c}"
        for c in ["id_conjunto_uc", "conjunto_uc", "distribuidora", "indicador", "valor", "data_apuracao"]
    )
    + " FROM lng",
    # profiles
    "profile_nulls": f"WITH {_EV} "
    + _column_profile("{0} IS NULL", _EVENT_COLUMNS, "qtd_nulos", "pct_nulos"),
    "profile_blanks": f"WITH {_EV} SELECT * FROM ("
    + _column_profile(
        "{0} IS NOT NULL AND trim({0}) = ''", [c for c in _EVENT_COLUMNS if c in _TEXTS],
        "qtd_vazias", "pct_vazias",
    )
    + ") WHERE qtd_vazias > 0",
    "profile_temporal": _ev(
        f"""count(*) AS linhas,
        count(*) FILTER (WHERE DatFimInterrupcao <= DatInicioInterrupcao) AS qtd_inconsistentes,
        {_pct('count(*) FILTER (WHERE DatFimInterrupcao <= DatInicioInterrupcao)', 'count(*)')} AS pct FROM ev"""
    ),
    "profile_duplicates": _ev(
        """count(*) AS chaves_repetidas, CAST(coalesce(sum(n), 0) AS BIGINT) AS linhas_envolvidas,
        max(n) AS maior_repeticao, max_by(NumOrdemInterrupcao, (n, NumOrdemInterrupcao)) AS pior_chave
        FROM (SELECT NumOrdemInterrupcao, count(*) AS n FROM ev GROUP BY 1) WHERE n > 1"""
    ),
    "duplicate_examples": _ev(
        f"""{_ROW}, DatGeracaoConjuntoDados, DatInicioInterrupcao, DatFimInterrupcao, SigAgente FROM ev
        WHERE NumOrdemInterrupcao = (SELECT NumOrdemInterrupcao FROM ev GROUP BY 1 HAVING count(*) > 1
          ORDER BY count(*) DESC, 1 LIMIT 1)"""
    ),
    "quality_summary": f"""WITH {_EV} """
    + _union(
        [
            f"'{n}' AS problema, count(*) FILTER (WHERE {r}) AS quantidade,"
            f" {_pct(f'count(*) FILTER (WHERE {r})', 'count(*)')} AS pct FROM ev"
            for n, r in _PROBLEMS.items()
        ]
        + [
            f"""'duplicatas' AS problema, n - k AS quantidade, {_pct('n - k', 'n')} AS pct
            FROM (SELECT count(*) AS n, count(DISTINCT (NumOrdemInterrupcao, NumUnidadeConsumidora)) AS k FROM ev)"""
        ]
    ),
    # observed against published
    "dec_observed": f"""WITH {_OBSERVED}, {_OFFICIAL} {_SEEN} SELECT * FROM seen""",
    "fec_observed": f"""WITH {_OBSERVED} SELECT distribuidora, ano, mes, served AS consumidores,
        CAST(ca AS DOUBLE) / nullif(served, 0) AS fec_observado FROM obs""",
    "dec_comparison": f"""WITH {_OBSERVED}, {_OFFICIAL} {_SEEN},
        j AS (SELECT distribuidora, ano, mes, dec_observado, dec_oficial, dec_medio,
          dec_observado - dec_oficial AS diferenca,
          (dec_observado - dec_oficial) / nullif(dec_oficial, 0) * 100.0 AS diferenca_perc
          FROM (SELECT distribuidora, ano, mes, dec_observado FROM seen)
          FULL JOIN (SELECT distribuidora, ano, mes, dec_oficial, dec_medio FROM off) USING (distribuidora, ano, mes))
        SELECT *, CASE WHEN dec_oficial IS NULL OR dec_oficial = 0 THEN 'NO_REFERENCE'
          WHEN dec_observado IS NULL THEN 'NO_OBSERVATION' WHEN abs(diferenca_perc) > 20 THEN 'CRITICAL'
          WHEN abs(diferenca_perc) > 10 THEN 'WARNING' ELSE 'OK' END AS alerta FROM j""",
    "limit_as_of": f"""WITH {_GOLD_IND}, starts AS (
          SELECT s_name AS distribuidora, DATE '1995-06-10' AS valido_desde, 5.5 + s_suppkey % 3 * 0.25 AS limite_dec
            FROM supplier WHERE s_suppkey % 4 <> 3
          UNION ALL SELECT s_name, DATE '1997-07-01', 6.0 + s_suppkey % 5 * 0.25 FROM supplier WHERE s_suppkey % 4 <> 3
          UNION ALL SELECT s_name, DATE '1999-04-15', 6.5 FROM supplier WHERE s_suppkey % 2 = 0
        ), matched AS (
          SELECT g.distribuidora, g.ano, g.mes, g.ano_mes, g.dec_medio, l.valido_desde, l.limite_dec
          FROM gi g LEFT JOIN starts l ON l.distribuidora = g.distribuidora AND l.valido_desde <= g.ano_mes
          QUALIFY row_number() OVER (PARTITION BY g.distribuidora, g.ano_mes ORDER BY l.valido_desde DESC NULLS LAST) = 1)
        SELECT distribuidora, ano, mes, dec_medio, valido_desde, CAST(limite_dec AS DOUBLE) AS limite_dec,
          CASE WHEN dec_medio > limite_dec THEN dec_medio - limite_dec END AS excesso,
          CASE WHEN limite_dec IS NULL THEN 'SEM_LIMITE' WHEN dec_medio IS NULL THEN 'SEM_MEDICAO'
               WHEN dec_medio > limite_dec THEN 'ACIMA' ELSE 'DENTRO' END AS situacao FROM matched""",
    "bq_robust_jumps": f"""WITH {_GOLD_IND}, seen AS (
          SELECT distribuidora, ano, mes, dec_medio, list_sort(list_filter(
            list(dec_medio) OVER (PARTITION BY distribuidora ORDER BY ano * 12 + mes RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING),
            lambda x: x IS NOT NULL)) AS past FROM gi
        ), based AS (
          SELECT *, len(past) AS n, (past[CAST(ceil(len(past) / 2) AS INT)] + past[CAST(floor(len(past) / 2) AS INT) + 1]) / 2 AS mediana
          FROM seen
        ), away AS (SELECT *, list_sort(list_transform(past, lambda x: abs(x - mediana))) AS off FROM based),
        spread AS (SELECT *, (off[CAST(ceil(n / 2) AS INT)] + off[CAST(floor(n / 2) AS INT) + 1]) / 2 AS mad FROM away)
        SELECT distribuidora, ano, mes, dec_medio, n AS historico, mediana, mad,
          CASE WHEN mad > 0 THEN (dec_medio - mediana) / (mad * CAST(1.4826 AS DOUBLE)) END AS desvios
        FROM spread WHERE n >= 6 AND CASE WHEN mad > 0 THEN (dec_medio - mediana) / (mad * CAST(1.4826 AS DOUBLE)) > 2
          ELSE dec_medio > mediana END""",
    "above_limit": f"""WITH {_CELLS} {_MEANS},
        lim AS (SELECT s_name AS distribuidora, 6.0 + (s_suppkey % 3) * 0.25 AS limite FROM supplier)
        SELECT distribuidora, ano, dec_medio, CAST(limite AS DOUBLE) AS limite_dec,
        dec_medio - CAST(limite AS DOUBLE) AS excesso
        FROM means JOIN lim USING (distribuidora) WHERE dec_medio > limite""",
    "fec_by_region": f"""WITH {_CELLS}, {_REGIONS}, m AS (
        SELECT distribuidora, avg(valor) AS fec_medio, count(valor) AS medicoes FROM cells
        WHERE indicador = 'FEC' GROUP BY 1)
        SELECT regiao, distribuidora, fec_medio, medicoes FROM m LEFT JOIN regions ON distribuidora = agente""",
    # business questions
    "bq_worst_distributor_year": f"""WITH {_GOLD_OUT} SELECT cod_distribuidora,
        {_hours('CAST(sum(s) AS BIGINT)')} AS horas, CAST(sum(total_eventos) AS BIGINT) AS eventos
        FROM go WHERE ano_referencia = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "bq_monthly_trend": f"""WITH {_GOLD_OUT}, h AS (SELECT *, {_hours('s')} AS tempo_total_horas FROM go)
        SELECT cod_distribuidora, ano_referencia, mes_referencia, tempo_total_horas, total_eventos,
        lag(tempo_total_horas) OVER (PARTITION BY cod_distribuidora ORDER BY ano_referencia, mes_referencia)
        AS horas_mes_anterior FROM h""",
    "bq_events_month": f"""WITH {_GOLD_OUT} SELECT ano_referencia, mes_referencia,
        CAST(sum(total_eventos) AS BIGINT) AS eventos FROM go GROUP BY 1, 2""",
    "bq_mean_dec_year": f"""WITH {_WIDE} SELECT codigo_distribuidora, ano_referencia, avg("dec") AS dec_medio,
        count("dec") AS medicoes FROM w GROUP BY 1, 2""",
    "bq_top_cause": _ev(
        """SigAgente, DscFatoGeradorInterrupcao, n AS qtd_eventos FROM (
          SELECT SigAgente, DscFatoGeradorInterrupcao, count(*) AS n FROM ev
          WHERE DscFatoGeradorInterrupcao IS NOT NULL GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY SigAgente ORDER BY n DESC, DscFatoGeradorInterrupcao) = 1"""
    ),
    "bq_month_jumps": f"""WITH {_GOLD_IND} SELECT distribuidora, ano, mes, dec_medio, dec_medio_mes_anterior,
        variacao_perc_mes_anterior FROM gi WHERE variacao_perc_mes_anterior > 50""",
    "bq_month_rank": f"""WITH {_GOLD_IND} SELECT ano, mes, ranking_dec_mes, distribuidora, dec_medio
        FROM gi WHERE ranking_dec_mes <= 3""",
    "bq_annual_means": f"WITH {_CELLS} {_MEANS} SELECT * FROM means",
    "bq_missing_ranges": f"""WITH {_EV}, have AS (
          SELECT DISTINCT SigAgente, IdeConjuntoUnidadeConsumidora, date_trunc('month', DatInicioInterrupcao)::DATE AS m FROM ev
        ), span AS (SELECT min(m) AS lo, max(m) AS hi FROM have), wanted AS (
          SELECT SigAgente, IdeConjuntoUnidadeConsumidora, unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS m
          FROM (SELECT DISTINCT SigAgente, IdeConjuntoUnidadeConsumidora FROM have), span
        ), absent AS (SELECT * FROM wanted EXCEPT SELECT * FROM have), placed AS (
          SELECT *, year(m) * 12 + month(m) - row_number() OVER (
            PARTITION BY SigAgente, IdeConjuntoUnidadeConsumidora ORDER BY m) AS island FROM absent)
        SELECT SigAgente, IdeConjuntoUnidadeConsumidora, min(m) AS primeiro_mes, max(m) AS ultimo_mes, count(*) AS meses
        FROM placed GROUP BY SigAgente, IdeConjuntoUnidadeConsumidora, island""",
    "bq_missing_months": _ev(
        """a AS "SigAgente", c AS "IdeConjuntoUnidadeConsumidora", CAST(m AS DATE) AS mes_ausente FROM (
          SELECT k.a, k.c, unnest(generate_series(
            (SELECT date_trunc('month', min(DatInicioInterrupcao)) FROM ev),
            (SELECT date_trunc('month', max(DatInicioInterrupcao)) FROM ev), INTERVAL 1 MONTH)) AS m
          FROM (SELECT DISTINCT SigAgente AS a, IdeConjuntoUnidadeConsumidora AS c FROM ev) k)
        WHERE (a, c, m) NOT IN (SELECT (SigAgente, IdeConjuntoUnidadeConsumidora,
          date_trunc('month', DatInicioInterrupcao)) FROM ev)"""
    ),
}

ORACLES["dec_analysis_stored"] = ORACLES["dec_comparison"]  # the layer run stores what the query compares
