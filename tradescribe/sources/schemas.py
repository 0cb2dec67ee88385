"""Column names and types of the three inputs, the extract and the report."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(38, 12)
NUMBER_ID = T.DecimalType(38, 0)
TEXT = T.StringType()
CODE = T.IntegerType()
DAY = T.DateType()
MOMENT = T.TimestampNTZType()

# The trade columns, in their published order.
TRADE_COLUMNS = """
    NB THD_VALUE_DATE SYS_PARTITION_ID HS_CNTRP D_CTP_ENT H_INT TP_STATUS2 H_PRODUCT
    TRN_FMLY TRN_GRP TRN_TYPE M_EVT_DATE M_CFI H_DVCS C_CUR_PL TP_RTCUR0 M_TP_MSTRUCT
    M_TP_CRISDA M_BASKET_IND TP_QTYEQ H_PUTCALL TP_IQTY TP_FXSTNUM TP_FXSTDEN
    M_PKG_CURR_R M_PKG_TYP_R H_PKG_LOG_ID PACKAGE CNT_TYPO PKG_CLASS M_BUSINE_EVT
    M_PKG_VAL_R M_PKG_NOTA_R CONTRACT_NUMBER HS_UPI H_TP_AE TP_OBAR1 HS_EXEC_TIME
    M_COMPRES_ID M_VAL_METHOD H_RTDPP01 TP_RTCCP02 M_HS_PCK_DSC U_OPTTYPE M_CLEAR_STS
    M_AUTO_CLR M_CCP_NAME HS_REPROLCFTC HS_REPROLCSA HS_MUTUALP TP_CANCBY M_SCHEDULE
    H_CNTRPCY M_MARGIN_IND HS_MAT_LAB H_DTETRN H_DTELST H_UNADJMAT H_UNADJST0 H_BS
    TP_RTNBLEG DEAL_LEG H_IPAY TP_LENTDSP TP_CRDPROT
""".split()

_TRADE_TYPES = {
    AMOUNT: "TP_QTYEQ TP_IQTY TP_OBAR1 TP_RTCCP02 H_IPAY",
    NUMBER_ID: "PACKAGE CONTRACT_NUMBER",
    CODE: "TP_RTNBLEG DEAL_LEG",
    DAY: "THD_VALUE_DATE M_EVT_DATE H_DTETRN H_DTELST H_UNADJMAT H_UNADJST0",
    MOMENT: "HS_EXEC_TIME",
}

# Columns a source may deliver blank padded to a fixed width.
PADDED_COLUMNS = ("H_DVCS",)

# The counterparty attributes a trade takes over.
COUNTERPARTY_ATTRIBUTES = """
    AGENT_ID NAME LEI CPTY_ID_SOURCE_PRIV_LAW_IDENT CPTY_ID_SOURCE_NAT_PERS_IND
    FINANCIAL_ENTITY CLR_EX_END_USER_EXCEPTION CLR_EX_SMALL_BK_EXEMPTION
    CLR_EX_OTHER_EXCEPTIONS CLR_EX_NO_ACT_LETTER CLR_EX_COOP_EXEMPTION
    FED_ENTITY_INDICATOR CLEARING_THRESHOLD_EXEEDED CANADIAN_DERIVATIVE_STATUS CANADA
""".split()

# The report columns, in their published order.
REPORT_COLUMNS = """
    NB CLEARED CAN_CLEARABLE HS_MAT_LAB CLEARING_CPTY_2 COUNTERPARTY_1 COUNTERPARTY_2
    PARTY_TYP2 FINANCIAL_ENTITY_1 FINANCIAL_ENTITY_2 BUYER_IDENTIFIER SELLER_IDENTIFIER
    PAYER_IDENTIFIER_LEG_1 PAYER_IDENTIFIER_LEG_2 RECEIVER_IDENTIFIER_LEG_1
    RECEIVER_IDENTIFIER_LEG_2 CPTY_2_FE_INDICATOR BASKET_INDICATOR EVENT_IDENTIFIER
    EVENT_TIMESTAMP NOTI_AMOUNT_IE_ON_ASSOC_EFF_DATE_LEG_1 CALL_AMOUNT_LEG_1
    CALL_AMOUNT_LEG_2 CALL_CURR_LEG_1 CALL_CURR_LEG_2 PUT_AMOUNT_LEG_1 PUT_AMOUNT_LEG_2
    PUT_CURR_LEG_1 PUT_CURR_LEG_2 QTY_FREQUENCY_LEG_1 QTY_FREQUENCY_LEG_2
    QTY_FREQ_MULT_LEG_1 QTY_FREQ_MULT_LEG_2 QUANTITY_UNIT_MEASURE_LEG_1
    QUANTITY_UNIT_MEASURE_LEG_2 PACKAGE_INDICATOR PACKAGE_ID PACKAGE_TRAN_PRICE
    PACKAGE_TRAN_PRICE_CURR PACKAGE_TRAN_PRICE_NOTAT PACKAGE_TRAN_SPREAD
    PACKAGE_TRAN_SPREAD_CURR PACKAGE_TRAN_SPREAD_NOTAT
""".split()

# The columns of the field-investigation extract.
EXTRACT_COLUMNS = """
    NB H_BS H_PRODUCT HS_UPI H_DVCS TP_STATUS2 CANADA CANADIAN_DERIVATIVE_STATUS
    CLEARING_THRESHOLD_EXEEDED
""".split()


def _schema(columns: list[str], types: dict[T.DataType, str]) -> T.StructType:
    by_name = {name: kind for kind, names in types.items() for name in names.split()}
    return T.StructType([T.StructField(name, by_name.get(name, TEXT)) for name in columns])


TRADES = _schema(TRADE_COLUMNS, _TRADE_TYPES)

COUNTERPARTIES = _schema(
    ["MUREX_COUNTERPART", "RPY_VALUE_DATE", *COUNTERPARTY_ATTRIBUTES, "SYS_CREAT_DTMS"],
    {DAY: "RPY_VALUE_DATE", MOMENT: "SYS_CREAT_DTMS"},
)

FIXFLOWS = _schema(
    "NB FFL_VALUE_DATE LEGSTEP DT_LEG0 DATE2 DATE4 DT_CAPREM0 FIXVAR FIXVAR1 AMORTFLAG EQDSIDE".split(),
    {CODE: "LEGSTEP DT_LEG0", DAY: "FFL_VALUE_DATE DATE2 DATE4", AMOUNT: "DT_CAPREM0"},
)

EXTRACT = _schema(EXTRACT_COLUMNS, {})
