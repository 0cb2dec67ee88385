"""Trade, counterparty and flow tables derived from the star-schema test tables.

Every value follows from the row's keys by remainders, so that another engine
can derive the same tables.  ``k`` is the order key and ``q`` its quotient by
24; the remainder picks the product.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradescribe.sources.schemas import COUNTERPARTIES, FIXFLOWS, TRADES

# Family, group, type, product and UPI path by remainder.
PRODUCTS = """
    CURR FXD  SMP  CURR_FXD_FXD   ForeignExchange:Forward
    CURR FXD  -    CURR_FXD_SWLEG ForeignExchange:NDF
    CURR OPT  SMP  CURR_OPT_SMP   ForeignExchange:VanillaOption
    CURR OPT  BAR  CURR_OPT_BAR   ForeignExchange:ComplexExotic
    CURR OPT  ASN  CURR_OPT_ASN   ForeignExchange:ComplexExotic
    IRD  IRS  SWAP IRD_IRS        InterestRate:IRSwap:OIS
    IRD  IRS  SWAP IRD_IRS        InterestRate:Exotic
    IRD  IRS  -    IRD_IRS        Credit:Exotic
    IRD  CS   -    IRD_CS         Equity:Swap
    IRD  CS   SWAP IRD_CS         InterestRate:CrossCurrency
    IRD  OSWP -    IRD_OSWP       InterestRate:Option:Swaption
    IRD  TRS  -    IRD_TRS        Equity:Swap:Basket
    IRD  RTRN -    IRD_RTRN_BSK   Equity:Swap:Index
    IRD  BOND -    IRD_BOND       InterestRate:Debt
    IRD  CF   -    IRD_CF         -
    EQD  EQS  -    EQD_EQS        Equity:Swap:Index
    EQD  RTRN -    EQD_RTRN       Equity:Swap:Single
    EQD  OPT  -    EQD_OPT        Equity:Option
    CRD  CDS  -    CRD_CDS        Credit:SingleName
    CRD  TRS  -    CRD_TRS        Credit:TotalReturn
    COM  SWAP SWAP COM_SWAP       Commodity:Energy:Oil:Swap
    COM  FWD  -    COM_FWD        Commodity:Agricultural:Softs:Fwd
    -    -    -    -              -
    IRD  IRS  -    IRD_FRA        InterestRate:IRSwap:OIS
"""

# The columns used, with their types: no job has to look them up.
COLUMNS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores: a small file is one split.  Larger ones have enough splits as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


# A customer becomes some 130 versions; those of this many can be sorted in a task's memory.
CUSTOMERS_A_TASK = 10_000


def _spread(df: DataFrame, key: str, most: int = CUSTOMERS_A_TASK) -> DataFrame:
    """Rows that become very many each, in as many tasks as a shuffle has, or more, so that no task outgrows its memory."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(tasks, math.ceil(df.count() / most)), key)


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _cycle(number: str, *values: str | None) -> str:
    """Value listed for the remainder of ``number`` by the list's length."""
    listed = ", ".join(_literal(value) for value in values)
    return f"get(array({listed}), int(pmod({number}, {len(values)})))"


def _at(number: str, modulus: int, values: dict[int, str], otherwise: str = "NULL") -> str:
    """Expression given for some remainders, another for the rest."""
    cases = " ".join(f"WHEN {remainder} THEN {value}" for remainder, value in values.items())
    return f"CASE pmod({number}, {modulus}) {cases} ELSE {otherwise} END"


def _texts(*values: str) -> dict[int, str]:
    return {remainder: _literal(value) for remainder, value in enumerate(values)}


def _money(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(20,2))"


def _select(rows: DataFrame, schema: T.StructType, values: dict[str, str]) -> DataFrame:
    """The schema's columns by expression; those without one are NULL."""
    return rows.selectExpr(
        *[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )


def _products(spark: SparkSession) -> DataFrame:
    """24 rows, whatever the scale."""
    rows = [
        [str(i), *[_literal(None if cell == "-" else cell) for cell in line.split()]]
        for i, line in enumerate(PRODUCTS.strip().splitlines())
    ]
    values = ", ".join(f"({', '.join(row)})" for row in rows)
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS p(product_id, TRN_FMLY, TRN_GRP, TRN_TYPE, H_PRODUCT, HS_UPI)"
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _dealt(_table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "o_orderkey AS k",
        "o_orderkey div 24 AS q",
        "int(pmod(o_orderkey, 24)) AS product_id",
        "o_custkey",
        "o_orderdate",
        "date(o_orderdate) AS day",
        f"{_money('o_totalprice')} AS price",
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = orders.join(F.broadcast(_products(spark)), "product_id").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    last = "add_months(day, int(12 * pmod(q, 20)))"
    package_types = ["Price", "Spread", "IR Rebate Swap", "IR Floored Rate", "FX Dual Ccy Capped", "IR Capped Rate"]
    typologies = ["Contingent leg", "SUST LINK DERIV", "x CANCELLABLE", "Bespoke CDS", "INVSMT ALLOC METHD", "  "]
    notes = [
        "met x",
        "OET",
        "Extendible",
        "OffsetClause",
        "mandatory early termination",
        "optional early termination",
    ]
    values = {
        "NB": "k",
        "THD_VALUE_DATE": "trunc(day, 'month')",
        "HS_CNTRP": _at("k", 7, {0: "NULL", 1: "concat('XX', k)"}, "c_name"),
        "D_CTP_ENT": _at("k", 11, {0: "NULL"}, "c_name"),
        "H_INT": _cycle("k", "Y", "Y", "Y", "N", None),
        "H_BS": _cycle("q", "B", "B", "S", "S", None),
        "H_DVCS": f"rpad({_cycle('q', 'C', 'D', 'Z', None)}, 50, ' ')",
        "H_PUTCALL": _cycle("q", "C", "P", None),
        "H_TP_AE": _cycle("q", "D", "D", "D", "E", "E", "E", None),
        "TP_OBAR1": _cycle("q", "0", "0", "1.5", "1.5", None),
        "TP_IQTY": _at("q", 11, {0: "0.5BD", 1: "-0.25BD"}, "price"),
        "TP_QTYEQ": "price + 1.005BD",
        "TP_FXSTNUM": _at("q", 9, {0: "'CNH'", 1: "'CNH'", 2: "'CNH'"}, "'USD'"),
        "TP_FXSTDEN": _cycle("q", "CAD", "CNH"),
        "M_CFI": _cycle("q", "SRACSC", "SRACSP ", "SRACSE", "   ", "", "SRACSX", None),
        "C_CUR_PL": _cycle("q", "USD", "CAD", None),
        "TP_RTCUR0": _cycle("q", "USD", None),
        "M_TP_MSTRUCT": _at("q", 9, {0: "'XBRSX'"}, "'STD'"),
        "M_TP_CRISDA": _cycle("q", "Cash", "Delivery", "Cash or delivery", "Auction", None),
        "M_BASKET_IND": _cycle("q", "Y", "N", None),
        "M_PKG_TYP_R": _cycle("q", *package_types, "  ", None),
        "M_PKG_CURR_R": "'USD'",
        "M_PKG_VAL_R": "concat(pmod(q, 100), '.25')",
        "M_PKG_NOTA_R": _cycle("q", "Monetory Amount", "Decimal", "Basis points", "Other", None),
        "H_PKG_LOG_ID": _at("q", 7, {0: "concat('PKG', q)", 1: "'  '", 2: "'0'"}),
        "PACKAGE": _at("q", 5, {0: "q + 1", 1: "0"}),
        "CNT_TYPO": _at("q", 11, _texts(*typologies)),
        "PKG_CLASS": _cycle("q", "internal", "single", None),
        "M_BUSINE_EVT": _cycle("q", "Exercise", None),
        "CONTRACT_NUMBER": "k * 10",
        "HS_EXEC_TIME": "o_orderdate",
        "M_COMPRES_ID": "concat('CMP', k)",
        "M_VAL_METHOD": _cycle("q", "MTM", None),
        "M_HS_PCK_DSC": _at("q", 13, _texts(*notes)),
        "U_OPTTYPE": _at("q", 17, {0: "'extendible'"}),
        "M_CCP_NAME": "CASE WHEN pmod(q, 7) >= 4 THEN 'CCP' END",
        "M_AUTO_CLR": _at("q", 5, _texts("true", "N")),
        "M_CLEAR_STS": _cycle("q", "Registered", " ", None),
        "HS_REPROLCSA": _at("q", 5, {4: "NULL"}, "'Y'"),
        "HS_REPROLCFTC": _cycle("q", "Y", "N", None),
        "HS_MUTUALP": _at("q", 19, _texts("Mandatory", " optional ")),
        "TP_CANCBY": _at("q", 23, {0: "'CPTY'"}),
        "M_SCHEDULE": _at("q", 4, {3: "'M'"}, "'C'"),
        "M_MARGIN_IND": _at("q", 8, {0: "'affiliate'"}),
        "HS_MAT_LAB": "concat(pmod(q, 30), 'Y')",
        "H_DTETRN": "day",
        "H_DTELST": last,
        "H_UNADJST0": _at("q", 2, {1: "date_add(day, 2)"}),
        "H_UNADJMAT": _at("q", 3, {0: "NULL"}, f"date_add({last}, 1)"),
        "TP_RTNBLEG": "pmod(q, 2)",
        "DEAL_LEG": "pmod(q, 3)",
        "H_IPAY": _cycle("q", "0", "-1.5", "2.5", None),
        "TP_RTCCP02": _cycle("q", "0", "1", "-1"),
        "TP_LENTDSP": _cycle("q", "LE_NBCGFLTD", "OTHER"),
    }
    from_product = ["TRN_FMLY", "TRN_GRP", "TRN_TYPE", "H_PRODUCT", "HS_UPI"]
    return _select(rows, TRADES, values | dict(zip(from_product, from_product)))


def counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The months of the orders, as one array: there are as many as the calendar has.
    dates = (
        _table(spark, sf_dir, "orders")
        .selectExpr("CAST(trunc(o_orderdate, 'MM') AS DATE) AS vd")
        .where("vd IS NOT NULL")
        .distinct()
        .agg(F.collect_list("vd"))
    )
    # What only the customer decides is worked out once, not for every version.
    own = {
        "MUREX_COUNTERPART": "c_name",
        "NAME": _at("c", 6, {0: "NULL"}, "concat('Name ', c)"),
        "LEI": _at("c", 4, {0: "NULL"}, "concat('LEI', lpad(string(c), 17, '0'))"),
        "CPTY_ID_SOURCE_PRIV_LAW_IDENT": _cycle("c", "Y", "N", None),
        "CPTY_ID_SOURCE_NAT_PERS_IND": _cycle("c", "Y", None),
        "FINANCIAL_ENTITY": _cycle("c", "Y", "N", None),
        "FED_ENTITY_INDICATOR": _at("c", 5, _texts("Y", "N")),
        "CLR_EX_END_USER_EXCEPTION": _at("c", 7, {0: "'Y'"}, "'N'"),
        "CLR_EX_SMALL_BK_EXEMPTION": _at("c", 7, {1: "'Y'"}, "'N'"),
        "CLR_EX_COOP_EXEMPTION": _at("c", 7, {2: "'Y'"}, "'N'"),
        "CLR_EX_NO_ACT_LETTER": _at("c", 7, {3: "'Y'"}, "'N'"),
        "CLR_EX_OTHER_EXCEPTIONS": _at("c", 7, {4: "'Y'"}, "'N'"),
        "CLEARING_THRESHOLD_EXEEDED": _cycle("c", "Y", "N", None),
        "CANADIAN_DERIVATIVE_STATUS": _cycle("c", "Y", "N", None, "Y"),
        "CANADA": _cycle("c", "Y", "N", None, "Y", "N"),
    }
    agent = _at("c", 13, {5: "NULL"}, "concat('AG', c, '-')")
    rows = (
        _spread(_table(spark, sf_dir, "customer"), "c_custkey")
        .selectExpr("c_custkey AS c", "c_name")
        .selectExpr("c", f"{agent} AS agent", *[f"{value} AS {name}" for name, value in own.items()])
        .withColumn("dates", dates.scalar())
        .selectExpr("* EXCEPT (dates)", "explode(dates) AS vd")
        .where("pmod(c + month(vd), 5) <> 0")
        .selectExpr("*", "explode(array(0, 1)) AS v")
    )
    values = {
        "RPY_VALUE_DATE": "vd",
        "AGENT_ID": "concat(agent, v)",
        "SYS_CREAT_DTMS": _at("c", 17, {0: "NULL"}, "CAST(vd AS TIMESTAMP_NTZ) + make_dt_interval(0, v)"),
    }
    return _select(rows, COUNTERPARTIES, values | dict(zip(own, own)))


def fixflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order, numbered, as its flows.

    The numbering shuffles them by trade number, as text, so Spark knows that
    they lie by it.  The last columns of its order break ties, and let every
    reader share one shuffle, whichever columns it reads.
    """
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS number", "trunc(date(o_orderdate), 'month') AS vd"
    )
    lines = (
        _table(spark, sf_dir, "lineitem")
        .selectExpr("* EXCEPT (l_orderkey)", "string(l_orderkey) AS number")
        .where("number IS NOT NULL")
        .selectExpr(
            "*",
            "row_number() OVER (PARTITION BY number ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,"
            " l_extendedprice, l_quantity, l_returnflag, l_linestatus) AS s",
        )
    )
    rows = lines.join(orders, "number").selectExpr("*", "bigint(number) AS k").selectExpr(
        "*", "1 + int((s - 1) div 2) * IF(pmod(k, 9) = 0, 5, 1) AS step", "date(l_shipdate) AS shipped"
    )
    in_months = "add_months(vd, step)"
    starts = {
        0: "date_add(vd, step)",
        1: in_months,
        2: "date_add(vd, 91 * step)",
        3: "shipped",
        4: _at("step", 2, {1: in_months}),
    }
    values = {
        "NB": "number",
        "FFL_VALUE_DATE": _at("s", 10, {0: "date_add(vd, 1)"}, "vd"),
        "LEGSTEP": "step",
        "DT_LEG0": "pmod(s - 1, 2)",
        "DATE2": _at("k", 5, starts),
        "DATE4": "add_months(vd, int(2 * l_quantity))",
        "DT_CAPREM0": _at("s", 6, {0: "NULL"}, _money("l_extendedprice")),
        "FIXVAR": "IF(l_returnflag = 'R', 'F2', 'F1')",
        "FIXVAR1": "IF(l_linestatus = 'O', 'F', 'V')",
        "AMORTFLAG": _at("l_suppkey", 4, {0: "'N'"}, "'Y'"),
        "EQDSIDE": _at("l_suppkey", 10, {0: "'Y'"}, "'N'"),
    }
    return _select(rows, FIXFLOWS, values)
