"""Small tables that reach every rule: odd values, copies, ties, hot groups."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import product

from pyspark.sql import SparkSession

from tradescribe.sources import schemas as S

DAYS = [date(2026, 1, 31), date(2026, 2, 28), date(2026, 3, 17)]
FAMILIES = ["CURR", "IRD", "EQD", "CRD", "COM", "XXX", None]
GROUPS = "FXD OPT IRS CS OSWP TRS RTRN BOND CF EQS CDS SWAP EQUIT".split() + [None]
PATHS = [
    "InterestRate:IRSwap:OIS",
    "InterestRate:Exotic",
    "InterestRate:Option:Swaption",
    "interestrate:option",
    "ForeignExchange:Forward",
    "Credit:SingleName",
    "credit:lower",
    "X:CREDIT:Y",
    "Equity:Swap:Index",
    "Equity:Swap:Basket",
    "Equity:Option",
    "equity:swap",
    "EQUITY",
    "Commodity:Energy:Oil:Swap",
    "Commodity:Energy:NatGas:Swap",
    "Commodity:Energy:Elec:Fwd",
    "COMMODITY:ENERGY:ELEC:FWD",
    "Commodity:Metals:Precious:Gold",
    "Commodity:Metals:NonPrecious:Tin",
    "Commodity:Agricultural:GrainsOilseeds:Corn",
    "Commodity:Agricultural:Softs:Sugar",
    "Commodity:Other",
    "",
    None,
]

CHOICES = {
    "H_INT": ["Y", "N", None],
    "H_PRODUCT": "CURR_FXD_FXD CURR_FXD_SWLEG IRD_OSWP IRD_FRA IRD_TRS IRD_IRS IRD_RTRN_BSK CRD_CDS".split() + [None],
    "TRN_TYPE": ["SMP", "ASN", "BAR", "BAR2", "SWAP", "OTH", None],
    "M_CFI": ["SRACSC", " SRACSP ", "E", "   ", "", "SRACSX", None],
    "H_DVCS": ["C".ljust(50), "D".ljust(50), "Z".ljust(50), "D", " " * 50, None],
    "C_CUR_PL": ["USD", "CAD", " ", None],
    "TP_RTCUR0": ["USD", "CAD", " ", None],
    "M_TP_MSTRUCT": ["XBRSX", "brs", "STD", None],
    "M_TP_CRISDA": ["Cash", "Delivery", "Cash or delivery", "Auction", "cash", None],
    "M_BASKET_IND": ["Y", "N", None],
    "H_PUTCALL": ["C", "P", "X", None],
    "TP_FXSTNUM": ["CNH", "USD", "", None],
    "TP_FXSTDEN": ["CNH", "CAD", None],
    "M_PKG_CURR_R": ["USD", "CAD", None],
    "M_PKG_TYP_R": ["Price", "Spread", "IR Rebate Swap", "IR Floored Rate", "IR Capped Rate", "FX Dual Ccy Capped", "  ", "", None],
    "H_PKG_LOG_ID": ["PKG1", "  ", "0", "", None],
    "CNT_TYPO": ["Contingent leg", " sust link deriv ", "x Cancellable", "Bespoke CDS", "INVSMT ALLOC METHD", "  ", "", None],
    "PKG_CLASS": ["internal", "single", "other", None],
    "M_BUSINE_EVT": ["Exercise", "New", None],
    "M_PKG_VAL_R": ["1.25", "", None],
    "M_PKG_NOTA_R": ["Monetory Amount", "Decimal", "Basis points", "Other", None],
    "H_TP_AE": ["D", "E", "A", None],
    "M_COMPRES_ID": ["CMP1", None],
    "M_VAL_METHOD": ["MTM", "", None],
    "M_HS_PCK_DSC": "met x|OET|extendible|OffsetClause|a mandatory early termination|optional early termination|none".split("|") + [None, None],
    "U_OPTTYPE": [" extendible ", "other", None],
    "M_CLEAR_STS": ["Registered", " registered ", "No", None],
    "M_AUTO_CLR": ["true", " y ", "N", None],
    "M_CCP_NAME": ["CCP", "", None],
    "HS_REPROLCFTC": ["Y", "N", None],
    "HS_REPROLCSA": ["Y", "Y", "N", None],
    "HS_MUTUALP": ["Mandatory", " optional ", "x", None, None],
    "TP_CANCBY": ["CPTY", "", None, None],
    "M_SCHEDULE": ["C", "C", "M", None],
    "M_MARGIN_IND": [" affiliate ", "x", None],
    "HS_MAT_LAB": ["10Y", "", None],
    "H_BS": ["B", "S", "X", None],
    "TP_LENTDSP": ["LE_NBCGFLTD", "OTHER", None],
    "TP_QTYEQ": [Decimal(x) for x in ("0", "1.005", "-0.004", "-0.25", "12345678901234567890.125")] + [None],
    "TP_IQTY": [Decimal(x) for x in ("0.5", "1.004999", "-1.005", "99.995", "1000000")] + [None],
    "TP_OBAR1": [Decimal(0), Decimal("1.5"), None],
    "TP_RTCCP02": [Decimal(0), Decimal(1), Decimal(-1), None],
    "H_IPAY": [Decimal(0), Decimal("2.5"), Decimal("-1.5"), None],
    "PACKAGE": [Decimal(0), Decimal(77), None],
    "CONTRACT_NUMBER": [Decimal(1000), Decimal(0), None],
    "TP_RTNBLEG": [0, 1, None],
    "DEAL_LEG": [1, 2, None],
    "HS_EXEC_TIME": [datetime(2026, 1, 2, 3, 4, 5), None],
    "H_DTETRN": [date(2020, 1, 31), date(2020, 2, 15), None],
    "H_DTELST": [date(2030, 1, 31), date(2030, 2, 14), date(2030, 2, 16), date(2040, 1, 1), None],
    "H_UNADJST0": [date(2020, 2, 29), None, None],
    "H_UNADJMAT": [date(2030, 2, 28), date(2030, 3, 1), None, None],
    "TP_STATUS2": ["LIVE", None],
}

CODES = [f"C{i}" for i in range(12)] + ["NONE", "", None]


def trade_rows(rng: random.Random) -> list[tuple]:
    deals = list(product(FAMILIES, GROUPS, PATHS))
    # Combinations whose rules need many values at once appear more often.
    deals += [("CURR", "OPT", "ForeignExchange:VanillaOption")] * 500
    deals += [("IRD", "IRS", "InterestRate:IRSwap:OIS")] * 1500
    deals += [("CURR", "FXD", "ForeignExchange:Forward")] * 300
    rows = []
    for number, (family, group, path) in enumerate(deals):
        row = {name: rng.choice(values) for name, values in CHOICES.items()}
        row |= {"TRN_FMLY": family, "TRN_GRP": group, "HS_UPI": path}
        if path == "InterestRate:IRSwap:OIS" and rng.random() < 0.5:
            # Plain swaps, or clearing exceptions would hardly ever occur.
            row |= dict.fromkeys(
                "CNT_TYPO TP_CANCBY M_PKG_TYP_R HS_MUTUALP M_HS_PCK_DSC U_OPTTYPE M_CCP_NAME".split()
            )
            row |= {"HS_REPROLCSA": "Y", "M_SCHEDULE": "C", "M_MARGIN_IND": rng.choice([" Affiliate", None, None])}
            row |= {"H_DTETRN": date(2020, 1, 31), "H_DTELST": date(2030, 1, 31)}
        row["NB"] = str(number // 3) if number % 50 else None
        row["THD_VALUE_DATE"] = rng.choice([*DAYS, DAYS[0]]) if number % 77 else None
        row["HS_CNTRP"], row["D_CTP_ENT"] = rng.choice(CODES), rng.choice(CODES)
        rows.append(tuple(row.get(name) for name in S.TRADE_COLUMNS))
    # A group of copies, and one trade number on all days.
    rows += [rows[100]] * 7
    hot = dict(zip(S.TRADE_COLUMNS, rows[200])) | {"NB": "1", "TRN_GRP": "IRS"}
    rows += [tuple((hot | {"THD_VALUE_DATE": day}).values()) for day in DAYS * 2]
    return rows


def counterparty_rows(rng: random.Random) -> list[tuple]:
    flags = ["Y", "N", "", None]
    rows = []
    for code, day in product([c for c in CODES if c != "NONE"], [*DAYS, None]):
        for version in range(rng.choice([0, 1, 2, 5])):
            row = {name: rng.choice(flags) for name in S.COUNTERPARTY_ATTRIBUTES}
            row["AGENT_ID"] = rng.choice([f"AG{version}", None, None, ""])
            row["NAME"], row["LEI"] = rng.choice(["Name", "", None]), rng.choice([f"LEI{code}", "", None])
            row |= {"MUREX_COUNTERPART": code, "RPY_VALUE_DATE": day}
            row["SYS_CREAT_DTMS"] = rng.choice([datetime(2026, 1, 1), datetime(2026, 1, 2), None])
            rows.append(tuple(row[field.name] for field in S.COUNTERPARTIES))
    return rows


def flow_rows(rng: random.Random) -> list[tuple]:
    rows = []
    for number in range(900):
        for _ in range(rng.choice([0, 1, 4, 12])):
            day = rng.choice([*DAYS, *DAYS, None])
            start = date(2026, 1, 1) + timedelta(days=rng.choice([0, 1, 2, 3, 4, 30, 31, 44, 46, 90]))
            rows.append(
                (
                    str(number),
                    day,
                    rng.choice([0, 1, 1, 1, 2, 3, 17, 18, None]),
                    rng.choice([0, 0, 1, 1, 2, None]),
                    rng.choice([start, start, start, None]),
                    rng.choice([date(2031, 1, 31), date(2031, 2, 28), date(2031, 3, 1), date(2026, 5, 1), None]),
                    rng.choice([Decimal("0.5"), Decimal("-0.25"), Decimal(1000000), Decimal("12.340"), Decimal(0), None]),
                    rng.choice(["F1", "F1", "F1", "F2"]),
                    rng.choice(["F", "F", "F", None]),
                    rng.choice(["Y", "Y", "Y", "N"]),
                    rng.choice(["N", "N", "N", ""]),
                )
            )
    # Twins, and one trade with very many flows.
    rows += rows[:200]
    for i in range(3000):
        start = date(2026, 1, 1) + timedelta(days=i % 40)
        rows.append(
            ("1", DAYS[i % 3], i % 20, i % 2, start, date(2026, 6, 1), Decimal(i) / 4, "F1", "F", "Y", "N")
        )
    return rows


def write(spark: SparkSession, folder: str, seed: int = 7) -> None:
    rng = random.Random(seed)
    for name, rows, schema in (
        ("raw_trades", trade_rows(rng), S.TRADES),
        ("raw_counterparties", counterparty_rows(rng), S.COUNTERPARTIES),
        ("raw_fixflows", flow_rows(rng), S.FIXFLOWS),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
