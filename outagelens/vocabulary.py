"""Labels, codes, column names and thresholds results must carry."""

# --- fixed values: indicator codes, in publication order -------------------
INDICATOR_CODES = [
    "DEC", "DECINC", "DECIND", "DECINE", "DECINO", "DECIP", "DECIPC",
    "DECXN", "DECXNC", "DECXP", "DECXPC",
    "FEC", "FECINC", "FECIND", "FECINE", "FECINO", "FECIP", "FECIPC",
    "FECXN", "FECXNC", "FECXP", "FECXPC",
    "NumCon",
]

# --- fixed values: source columns ------------------------------------------
EVENT_SCHEMA = """
    DatGeracaoConjuntoDados DATE,
    IdeConjuntoUnidadeConsumidora BIGINT,
    DscConjuntoUnidadeConsumidora STRING,
    DscAlimentadorSubestacao STRING,
    DscSubestacaoDistribuicao STRING,
    NumOrdemInterrupcao STRING,
    DscTipoInterrupcao STRING,
    IdeMotivoInterrupcao BIGINT,
    DatInicioInterrupcao TIMESTAMP_NTZ,
    DatFimInterrupcao TIMESTAMP_NTZ,
    DscFatoGeradorInterrupcao STRING,
    NumNivelTensao BIGINT,
    NumUnidadeConsumidora BIGINT,
    NumConsumidorConjunto BIGINT,
    NumAno BIGINT,
    NomAgenteRegulado STRING,
    SigAgente STRING,
    NumCPFCNPJ BIGINT
"""

INDICATOR_SCHEMA = """
    datgeracaoconjuntodados DATE,
    ideconjundconsumidoras BIGINT,
    dscconjundconsumidoras STRING,
    sigagente STRING,
    numcnpj BIGINT,
    sigindicador STRING,
    anoindice BIGINT,
    numperiodoindice BIGINT,
    vlrindiceenviado DOUBLE
"""

LEDGER_SCHEMA = """
    fonte STRING,
    ano INT,
    url STRING,
    last_modified STRING,
    status STRING,
    timestamp_ingestao TIMESTAMP,
    num_registros BIGINT,
    mensagem STRING
"""

# --- fixed values: defaults for missing text -------------------------------
UNKNOWN_AGENT = "DESCONHECIDO"
NOT_INFORMED = "NAO_INFORMADO"
NOT_CLASSIFIED = "NAO_CLASSIFICADO"

# --- fixed values: duration classes, flags, bands --------------------------
CLASS_NONE, CLASS_SHORT, CLASS_MEDIUM, CLASS_LONG = (
    "NAO_CALCULADA", "CURTA", "MEDIA", "LONGA",
)
DURATION_CLASSES = [CLASS_NONE, CLASS_SHORT, CLASS_MEDIUM, CLASS_LONG]
SHORT_MAX_MINUTES = 60
LONG_MIN_MINUTES = 1440

FLAG_EXTREME, FLAG_LONG, FLAG_NORMAL = "Duração extrema", "Duração longa", "Normal"
FLAG_LONG_DAYS, FLAG_EXTREME_DAYS = 7, 30

BAND_DAY, BAND_WEEK, BAND_MONTH, BAND_OVER = (
    "ate 24 h", "1 a 6 dias", "7 a 30 dias", "mais de 30 dias",
)

# --- fixed values: event types and default rule parameters -----------------
SCHEDULED = "Programada"
UNSCHEDULED = "Não Programada"
TYPES_INCLUDED = ["Emergencial", "Não programada"]
TYPES_EXCLUDED = ["Programada"]
MIN_MINUTES = 1
MIN_CONSUMERS = 1
WARN_PERCENT = 10.0
CRITICAL_PERCENT = 20.0

# --- fixed values: ledger states -------------------------------------------
SUCCESS, ERROR = "SUCCESS", "ERROR"

# --- fixed values: columns whose nulls are critical ------------------------
CRITICAL_COLUMNS = ["NumOrdemInterrupcao", "NumAno", "SigAgente", "DscTipoInterrupcao"]
NATURAL_KEY = ["cod_distribuidora", "data_inicio", "conjunto", "tipo_interrupcao"]
OUTAGE_MONTH_KEY = ["cod_distribuidora", "ano_referencia", "mes_referencia"]
INDICATOR_KEY = ["sigagente", "ideconjundconsumidoras", "anoindice", "numperiodoindice"]
CAUSE_LEVELS = [
    "fato_gerador_origem", "fato_gerador_natureza",
    "fato_gerador_categoria", "fato_gerador_detalhe",
]
