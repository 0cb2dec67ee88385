"""The three raw tables, derived from the star-schema test tables."""

from __future__ import annotations

# Product table by remainder of the order key.
PRODUCTS = """
(0,'CURR','FXD','SMP','CURR_FXD_FXD','ForeignExchange:Forward'),
(1,'CURR','FXD',NULL,'CURR_FXD_SWLEG','ForeignExchange:NDF'),
(2,'CURR','OPT','SMP','CURR_OPT_SMP','ForeignExchange:VanillaOption'),
(3,'CURR','OPT','BAR','CURR_OPT_BAR','ForeignExchange:ComplexExotic'),
(4,'CURR','OPT','ASN','CURR_OPT_ASN','ForeignExchange:ComplexExotic'),
(5,'IRD','IRS','SWAP','IRD_IRS','InterestRate:IRSwap:OIS'),
(6,'IRD','IRS','SWAP','IRD_IRS','InterestRate:Exotic'),
(7,'IRD','IRS',NULL,'IRD_IRS','Credit:Exotic'),
(8,'IRD','CS',NULL,'IRD_CS','Equity:Swap'),
(9,'IRD','CS','SWAP','IRD_CS','InterestRate:CrossCurrency'),
(10,'IRD','OSWP',NULL,'IRD_OSWP','InterestRate:Option:Swaption'),
(11,'IRD','TRS',NULL,'IRD_TRS','Equity:Swap:Basket'),
(12,'IRD','RTRN',NULL,'IRD_RTRN_BSK','Equity:Swap:Index'),
(13,'IRD','BOND',NULL,'IRD_BOND','InterestRate:Debt'),
(14,'IRD','CF',NULL,'IRD_CF',NULL),
(15,'EQD','EQS',NULL,'EQD_EQS','Equity:Swap:Index'),
(16,'EQD','RTRN',NULL,'EQD_RTRN','Equity:Swap:Single'),
(17,'EQD','OPT',NULL,'EQD_OPT','Equity:Option'),
(18,'CRD','CDS',NULL,'CRD_CDS','Credit:SingleName'),
(19,'CRD','TRS',NULL,'CRD_TRS','Credit:TotalReturn'),
(20,'COM','SWAP','SWAP','COM_SWAP','Commodity:Energy:Oil:Swap'),
(21,'COM','FWD',NULL,'COM_FWD','Commodity:Agricultural:Softs:Fwd'),
(22,NULL,NULL,NULL,NULL,NULL),
(23,'IRD','IRS',NULL,'IRD_FRA','InterestRate:IRSwap:OIS')
"""

TRADES = f"""
products(id, TRN_FMLY, TRN_GRP, TRN_TYPE, H_PRODUCT, HS_UPI) AS (VALUES {PRODUCTS}),
numbered_orders AS (
  SELECT o_orderkey AS k, o_orderkey // 24 AS q, o_orderdate::DATE AS od,
         date_trunc('month', o_orderdate)::DATE AS vd,
         o_totalprice::DECIMAL(20,2)::DECIMAL(38,12) AS price, o_orderdate, c_name
  FROM orders JOIN customer ON o_custkey = c_custkey
),
raw_trades AS (
  SELECT k::VARCHAR AS NB, vd AS THD_VALUE_DATE,
    NULL::VARCHAR AS SYS_PARTITION_ID, NULL::VARCHAR AS TP_STATUS2, NULL::DATE AS M_EVT_DATE,
    NULL::VARCHAR AS H_RTDPP01, NULL::VARCHAR AS H_CNTRPCY, NULL::VARCHAR AS TP_CRDPROT,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN 'XX' || k ELSE c_name END AS HS_CNTRP,
    CASE WHEN k % 11 <> 0 THEN c_name END AS D_CTP_ENT,
    ['Y','Y','Y','N',NULL][k % 5 + 1] AS H_INT,
    TRN_FMLY, TRN_GRP, TRN_TYPE, H_PRODUCT, HS_UPI,
    ['B','B','S','S',NULL][q % 5 + 1] AS H_BS,
    rpad(['C','D','Z',NULL][q % 4 + 1], 50, ' ') AS H_DVCS,
    ['C','P',NULL][q % 3 + 1] AS H_PUTCALL,
    ['D','D','D','E','E','E',NULL][q % 7 + 1] AS H_TP_AE,
    [0,0,1.5,1.5,NULL][q % 5 + 1]::DECIMAL(38,12) AS TP_OBAR1,
    CASE q % 11 WHEN 0 THEN 0.5 WHEN 1 THEN -0.25 ELSE price END::DECIMAL(38,12) AS TP_IQTY,
    (price + 1.005)::DECIMAL(38,12) AS TP_QTYEQ,
    CASE WHEN q % 9 < 3 THEN 'CNH' ELSE 'USD' END AS TP_FXSTNUM,
    ['CAD','CNH'][q % 2 + 1] AS TP_FXSTDEN,
    ['SRACSC','SRACSP ','SRACSE','   ','','SRACSX',NULL][q % 7 + 1] AS M_CFI,
    ['USD','CAD',NULL][q % 3 + 1] AS C_CUR_PL, ['USD',NULL][q % 2 + 1] AS TP_RTCUR0,
    CASE WHEN q % 9 = 0 THEN 'XBRSX' ELSE 'STD' END AS M_TP_MSTRUCT,
    ['Cash','Delivery','Cash or delivery','Auction',NULL][q % 5 + 1] AS M_TP_CRISDA,
    ['Y','N',NULL][q % 3 + 1] AS M_BASKET_IND,
    ['Price','Spread','IR Rebate Swap','IR Floored Rate','FX Dual Ccy Capped','IR Capped Rate','  ',NULL][q % 8 + 1] AS M_PKG_TYP_R,
    'USD' AS M_PKG_CURR_R, (q % 100) || '.25' AS M_PKG_VAL_R,
    ['Monetory Amount','Decimal','Basis points','Other',NULL][q % 5 + 1] AS M_PKG_NOTA_R,
    CASE q % 7 WHEN 0 THEN 'PKG' || q WHEN 1 THEN '  ' WHEN 2 THEN '0' END AS H_PKG_LOG_ID,
    CASE q % 5 WHEN 0 THEN q + 1 WHEN 1 THEN 0 END::DECIMAL(38,0) AS PACKAGE,
    CASE q % 11 WHEN 0 THEN 'Contingent leg' WHEN 1 THEN 'SUST LINK DERIV' WHEN 2 THEN 'x CANCELLABLE'
                WHEN 3 THEN 'Bespoke CDS' WHEN 4 THEN 'INVSMT ALLOC METHD' WHEN 5 THEN '  ' END AS CNT_TYPO,
    ['internal','single',NULL][q % 3 + 1] AS PKG_CLASS, ['Exercise',NULL][q % 2 + 1] AS M_BUSINE_EVT,
    (k * 10)::DECIMAL(38,0) AS CONTRACT_NUMBER, o_orderdate AS HS_EXEC_TIME, 'CMP' || k AS M_COMPRES_ID,
    ['MTM',NULL][q % 2 + 1] AS M_VAL_METHOD,
    CASE q % 13 WHEN 0 THEN 'met x' WHEN 1 THEN 'OET' WHEN 2 THEN 'Extendible' WHEN 3 THEN 'OffsetClause'
                WHEN 4 THEN 'mandatory early termination' WHEN 5 THEN 'optional early termination' END AS M_HS_PCK_DSC,
    CASE WHEN q % 17 = 0 THEN 'extendible' END AS U_OPTTYPE,
    CASE WHEN q % 7 >= 4 THEN 'CCP' END AS M_CCP_NAME, CASE q % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'N' END AS M_AUTO_CLR,
    ['Registered',' ',NULL][q % 3 + 1] AS M_CLEAR_STS,
    CASE WHEN q % 5 < 4 THEN 'Y' END AS HS_REPROLCSA, ['Y','N',NULL][q % 3 + 1] AS HS_REPROLCFTC,
    CASE q % 19 WHEN 0 THEN 'Mandatory' WHEN 1 THEN ' optional ' END AS HS_MUTUALP,
    CASE WHEN q % 23 = 0 THEN 'CPTY' END AS TP_CANCBY, CASE WHEN q % 4 < 3 THEN 'C' ELSE 'M' END AS M_SCHEDULE,
    CASE WHEN q % 8 = 0 THEN 'affiliate' END AS M_MARGIN_IND, (q % 30) || 'Y' AS HS_MAT_LAB,
    od AS H_DTETRN, (od + to_months((12 * (q % 20))::INTEGER))::DATE AS H_DTELST,
    CASE WHEN q % 2 = 1 THEN od + 2 END AS H_UNADJST0,
    CASE WHEN q % 3 > 0 THEN (od + to_months((12 * (q % 20))::INTEGER))::DATE + 1 END AS H_UNADJMAT,
    (q % 2)::INTEGER AS TP_RTNBLEG, (q % 3)::INTEGER AS DEAL_LEG,
    [0,-1.5,2.5,NULL][q % 4 + 1]::DECIMAL(38,12) AS H_IPAY, [0,1,-1][q % 3 + 1]::DECIMAL(38,12) AS TP_RTCCP02,
    ['LE_NBCGFLTD','OTHER'][q % 2 + 1] AS TP_LENTDSP
  FROM numbered_orders JOIN products ON id = k % 24
)
"""

COUNTERPARTIES = """
raw_counterparties AS (
  SELECT c_name AS MUREX_COUNTERPART, vd AS RPY_VALUE_DATE,
    CASE WHEN c % 13 <> 5 THEN 'AG' || c || '-' || v END AS AGENT_ID,
    CASE WHEN c % 6 <> 0 THEN 'Name ' || c END AS NAME,
    CASE WHEN c % 4 <> 0 THEN 'LEI' || lpad(c::VARCHAR, 17, '0') END AS LEI,
    ['Y','N',NULL][c % 3 + 1] AS CPTY_ID_SOURCE_PRIV_LAW_IDENT, ['Y',NULL][c % 2 + 1] AS CPTY_ID_SOURCE_NAT_PERS_IND,
    ['Y','N',NULL][c % 3 + 1] AS FINANCIAL_ENTITY,
    CASE c % 7 WHEN 0 THEN 'Y' ELSE 'N' END AS CLR_EX_END_USER_EXCEPTION,
    CASE c % 7 WHEN 1 THEN 'Y' ELSE 'N' END AS CLR_EX_SMALL_BK_EXEMPTION,
    CASE c % 7 WHEN 4 THEN 'Y' ELSE 'N' END AS CLR_EX_OTHER_EXCEPTIONS,
    CASE c % 7 WHEN 3 THEN 'Y' ELSE 'N' END AS CLR_EX_NO_ACT_LETTER,
    CASE c % 7 WHEN 2 THEN 'Y' ELSE 'N' END AS CLR_EX_COOP_EXEMPTION,
    CASE WHEN c % 17 <> 0 THEN vd + to_hours(v) END AS SYS_CREAT_DTMS,
    CASE c % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS FED_ENTITY_INDICATOR,
    ['Y','N',NULL][c % 3 + 1] AS CLEARING_THRESHOLD_EXEEDED, ['Y','N',NULL,'Y'][c % 4 + 1] AS CANADIAN_DERIVATIVE_STATUS,
    ['Y','N',NULL,'Y','N'][c % 5 + 1] AS CANADA
  FROM (SELECT c_custkey AS c, c_name, unnest([0, 1]) AS v FROM customer),
       (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS vd FROM orders)
  WHERE (c + month(vd)) % 5 <> 0
)
"""

FIXFLOWS = """
numbered_lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS s
  FROM lineitem
),
stepped_lines AS (
  SELECT l.*, l_orderkey AS k, date_trunc('month', o_orderdate)::DATE AS vd,
         (1 + ((s - 1) // 2) * CASE WHEN l_orderkey % 9 = 0 THEN 5 ELSE 1 END)::INTEGER AS step
  FROM numbered_lines l JOIN orders ON o_orderkey = l_orderkey
),
raw_fixflows AS (
  SELECT k::VARCHAR AS NB, CASE WHEN s % 10 = 0 THEN vd + 1 ELSE vd END AS FFL_VALUE_DATE,
    step AS LEGSTEP, ((s - 1) % 2)::INTEGER AS DT_LEG0,
    CASE k % 5 WHEN 0 THEN vd + step WHEN 1 THEN (vd + to_months(step))::DATE WHEN 2 THEN vd + 91 * step
               WHEN 3 THEN l_shipdate::DATE ELSE CASE WHEN step % 2 = 1 THEN (vd + to_months(step))::DATE END END AS DATE2,
    (vd + to_months((2 * l_quantity)::INTEGER))::DATE AS DATE4,
    CASE WHEN s % 6 <> 0 THEN l_extendedprice::DECIMAL(20,2)::DECIMAL(38,12) END AS DT_CAPREM0,
    CASE WHEN l_returnflag = 'R' THEN 'F2' ELSE 'F1' END AS FIXVAR,
    CASE WHEN l_linestatus = 'O' THEN 'F' ELSE 'V' END AS FIXVAR1,
    CASE WHEN l_suppkey % 4 <> 0 THEN 'Y' ELSE 'N' END AS AMORTFLAG,
    CASE WHEN l_suppkey % 10 <> 0 THEN 'N' ELSE 'Y' END AS EQDSIDE
  FROM stepped_lines
)
"""

# Order keys with a returned line: the trade list of the restricted reports.
RETURNED = "returned AS (SELECT DISTINCT l_orderkey::VARCHAR AS NB FROM lineitem WHERE l_returnflag = 'R')"
