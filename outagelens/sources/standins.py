"""Event and indicator tables projected from the star-schema test tables.

Each stand-in column names the lookup table it needs, and only those lookups are joined:
a query that asks nothing of ``orders`` does not shuffle it. Lookups are left joins on
unique keys, so leaving one out never changes the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
        o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}

_LOOKUPS = {
    "orders": "l_orderkey = o_orderkey",
    "supplier": "l_suppkey = s_suppkey",
    "part": "l_partkey = p_partkey",
}

#: suppliers that are matched last and where the rows are, so that no shuffle carries their names
SHORT_LIST = 500_000

# what two columns are needed for, as one of few bytes: lookups shuffle line items
_DERIVED = {
    "minutes": """if(l_discount = 0.1D, null,
        cast((l_quantity * 60 - 600) * if(l_linenumber = 7, 24, 1) as int))""",
    "scheduled": "case when l_tax = 0 then null when l_returnflag = 'R' then true else false end",
}

# column -> (lookup table or none, expression)
_EVENTS = {
    "DatGeracaoConjuntoDados": ("orders", "cast(o_orderdate as date)"),
    "IdeConjuntoUnidadeConsumidora": (None, "l_partkey % 50"),
    "DscConjuntoUnidadeConsumidora": (
        None,
        """case when l_partkey % 97 = 0 then null when l_partkey % 89 = 0 then '  '
           else concat('CJ ', l_partkey % 50, ' ') end""",
    ),
    "DscAlimentadorSubestacao": (None, "concat('AL', l_partkey % 7, ' ')"),
    "DscSubestacaoDistribuicao": (None, "concat(' SE', l_suppkey % 10)"),
    "NumOrdemInterrupcao": (None, "concat(l_orderkey, '-', l_linenumber)"),
    "DscTipoInterrupcao": (
        None,
        "case when scheduled then 'Programada' when not scheduled then 'Não Programada' end",
    ),
    "IdeMotivoInterrupcao": (None, "cast(l_linenumber as bigint)"),
    "DatInicioInterrupcao": (None, "l_shipdate"),
    "DatFimInterrupcao": (None, "l_shipdate + interval '1' minute * minutes"),
    "DscFatoGeradorInterrupcao": (
        "part",
        """case l_partkey % 4 when 0 then concat_ws(';', 'INTERNA', p_type, p_brand, p_name)
           when 1 then concat_ws('-', 'EXTERNA', p_type, p_brand, p_name)
           when 2 then concat_ws(';', 'INTERNA', p_type) end""",
    ),
    "NumNivelTensao": (None, "cast(if(l_suppkey % 25 = 0, 0, 13800) as bigint)"),
    "NumUnidadeConsumidora": (None, "(l_orderkey + l_partkey) % 200"),
    "NumConsumidorConjunto": (None, "1000 + (l_partkey % 50) * 10"),
    "NumAno": (None, "cast(year(l_shipdate) as bigint)"),
    "NomAgenteRegulado": ("supplier", "s_name"),
    "SigAgente": ("supplier", "concat(' ', s_name)"),
    "NumCPFCNPJ": (None, "5965546000109 + l_suppkey"),
    "_ingest_timestamp": ("orders", "o_orderdate"),
    "_source_url": ("orders", "concat('landing/events_', year(o_orderdate), '.parquet')"),
    "_source_last_modified": (None, "cast(null as string)"),
    "_ano_fonte": ("orders", "year(o_orderdate)"),
    "_tie": (None, "l_extendedprice"),
}

_INDICATORS = {
    "datgeracaoconjuntodados": ("orders", "cast(o_orderdate as date)"),
    "ideconjundconsumidoras": (None, "l_partkey % 10"),
    "dscconjundconsumidoras": (None, "concat(' CJ ', l_partkey % 10)"),
    "sigagente": (None, "concat('Supplier#00000000', l_suppkey % 10, ' ')"),
    "numcnpj": (None, "5965546000109 + l_suppkey % 10"),
    "sigindicador": (
        None,
        """element_at(array('DEC', 'FEC', 'NumCon', 'DECIND', 'DECINC', 'FECIND', 'DECXP'),
           l_linenumber)""",
    ),
    "anoindice": (None, "cast(year(l_shipdate) as bigint)"),
    "numperiodoindice": (None, "cast(month(l_shipdate) as bigint)"),
    "vlrindiceenviado": (None, "if(l_linenumber = 3, l_quantity * 100, l_quantity / 4)"),
    "_fonte_url": (None, "'landing/indicators.parquet'"),
    "_ingest_ts": ("orders", "o_orderdate"),
    "_ingest_date": ("orders", "cast(o_orderdate as date)"),
    "_run_id": ("orders", "date_format(o_orderdate, 'yyyyMMddHHmmss')"),
    "_tie": (None, "l_extendedprice"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _project(
    spark: SparkSession, sf_dir: str, columns: dict, wanted: tuple[str, ...]
) -> DataFrame:
    names = list(wanted or columns)
    df = table(spark, sf_dir, "lineitem").withColumns({n: F.expr(e) for n, e in _DERIVED.items()})
    lookups = {lookup: table(spark, sf_dir, lookup) for lookup in _LOOKUPS if any(columns[c][0] == lookup for c in names)}
    if {"supplier", "part"} <= lookups.keys() and lookups["supplier"].count() <= SHORT_LIST:
        lookups["supplier"] = F.broadcast(lookups.pop("supplier"))
    for lookup, rows in lookups.items():
        df = df.join(rows, F.expr(_LOOKUPS[lookup]), "left")
    return df.select(*[F.expr(columns[c][1]).alias(c) for c in names])


def events(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Bronze events; all columns, or the ones asked for."""
    return _project(spark, sf_dir, _EVENTS, wanted)


def indicators(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Bronze indicator series, long."""
    return _project(spark, sf_dir, _INDICATORS, wanted)


def half_of_year(date: str) -> Column:
    return F.when(F.month(date) <= 6, 1).otherwise(2)


def manifest(spark: SparkSession, sf_dir: str, halves: bool = False) -> DataFrame:
    """One landed file per year, its version the newest date in it; or two of one version."""
    by_half = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("ano"), half_of_year("o_orderdate").alias("metade"))
        .agg(F.max("o_orderdate").alias("ultima"), F.count(F.lit(1)).alias("num_registros"))
    )
    stamped = {"last_modified": F.date_format(F.max("ultima"), "yyyy-MM-dd"), "num_registros": F.sum("num_registros")}
    by_year = by_half.groupBy("ano").agg(*[c.alias(n) for n, c in stamped.items()])
    if halves:
        files = by_half.drop("ultima").join(by_year.drop("num_registros"), "ano")
        url = F.format_string("landing/events_%d_%d.parquet", "ano", "metade")
    else:
        files, url = by_year, F.format_string("landing/events_%d.parquet", "ano")
    return files.select(F.lit("interrupcoes").alias("fonte"), "ano", url.alias("url"), "last_modified", "num_registros")


def ledger(spark: SparkSession, sf_dir: str, halves: bool = False) -> DataFrame:
    """A past ledger for the manifest.

    Years up to 1996 were loaded as they are now, 1997 and 1998 in an older version, 1999
    failed, later years were never tried. Of years in halves, the second of 1995 failed.
    """
    year = F.col("ano")
    broken = (year > 1998) | ((year == 1995) & F.col("url").endswith("_2.parquet"))
    current, loaded = ~broken & (year <= 1996), ~broken
    return (
        manifest(spark, sf_dir, halves)
        .filter(year <= 1999)
        .select(
            "fonte",
            "ano",
            "url",
            F.when(current, F.col("last_modified"))
            .when(loaded, "1990-01-01")
            .otherwise("")
            .alias("last_modified"),
            F.when(loaded, "SUCCESS").otherwise("ERROR").alias("status"),
            F.to_timestamp(F.concat(year + 1, F.lit("-01-15 06:00:00")))
            .cast("timestamp")
            .alias("timestamp_ingestao"),
            F.when(loaded, F.col("num_registros")).otherwise(0).alias("num_registros"),
            F.when(loaded, "carga concluida").otherwise("arquivo ilegivel").alias("mensagem"),
        )
    )


def agent_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributor to state and region, from the supplier's nation."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"), "left")
        .select(
            F.col("s_name").alias("agente"),
            F.col("n_name").alias("uf"),
            F.col("r_name").alias("regiao"),
        )
    )


def dec_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A DEC limit per distributor, the same in every year."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("distribuidora"),
        (F.lit(6.0) + F.col("s_suppkey") % 3 * 0.25).alias("limite_dec"),
    )


def dated_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC limits with the day from which they hold; a quarter of the suppliers has none at
    first, half of those none at all, and half of all get a new one amid a month."""
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    first = F.array(F.struct(F.lit("1995-06-10").alias("d"), (5.5 + key % 3 * 0.25).alias("v")),
                    F.struct(F.lit("1997-07-01").alias("d"), (6.0 + key % 5 * 0.25).alias("v")))
    later = F.array(F.struct(F.lit("1999-04-15").alias("d"), F.lit(6.5).alias("v")))
    none = F.filter(first, lambda x: F.lit(False))
    listed = F.concat(F.when(key % 4 != 3, first).otherwise(none), F.when(key % 2 == 0, later).otherwise(none))
    return supplier.select(F.col("s_name").alias("distribuidora"), F.inline(listed)).select(
        "distribuidora", F.col("d").cast("date").alias("valido_desde"), F.col("v").alias("limite_dec"))
