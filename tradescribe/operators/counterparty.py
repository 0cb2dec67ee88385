"""Counterparty resolution: primary code first, fallback code second.

A third of all trades may share one counterparty, and one counterparty may own
a third of all versions, so nothing here shuffles raw trades or raw versions by
counterparty code:

* versions shrink to the latest one of their (date, code) inside each map task,
  and are restricted to the pairs that trades look up where these meet;
* trades shrink to their distinct (date, primary, fallback) combinations, and
  only those are joined with the counterparties;
* the trades themselves meet the finished matches in one join.  Both of its
  sides come straight from a shuffle and the match side is unique, so adaptive
  execution may split a hot combination or broadcast a small match table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradescribe.functions.text import empty_to_null, first_packs, packed, packs_filled, with_unpacked
from tradescribe.sources.schemas import COUNTERPARTY_ATTRIBUTES
from tradescribe.sources.tables import normal_counterparties

# Names under which a trade carries attributes that would clash or mislead.
CARRIED_AS = {"NAME": "CPTY_NAME", "LEI": "CPTY_LEI"}

CARRIED_ATTRIBUTES = [CARRIED_AS.get(name, name) for name in COUNTERPARTY_ATTRIBUTES]

MATCH_COLUMNS = [*CARRIED_ATTRIBUTES, "MATCH_PRIORITY", "MATCH_SOURCE"]

# The attributes in one text: so they travel from the versions to the trades.
PACK = "ATTRIBUTES_"

# Empty text means "no code": it is NULL in the sources, hence never a code.
NO_CODE = ""


def primary_code() -> Column:
    return F.col("HS_CNTRP")


def fallback_code() -> Column:
    """The second code, which only internal trades may fall back to."""
    return F.when(F.col("H_INT") == "Y", F.col("D_CTP_ENT"))


def relevant_keys(trades: DataFrame) -> DataFrame:
    """Distinct (date, code) pairs under which trades look up a counterparty."""
    return _keys(trades, primary_code(), fallback_code())


def _keys(rows: DataFrame, primary: Column, fallback: Column) -> DataFrame:
    codes = F.explode(F.array_distinct(F.array(primary, fallback)))
    return (
        rows.select(F.col("THD_VALUE_DATE").alias("RPY_VALUE_DATE"), codes.alias("MUREX_COUNTERPART"))
        .where(F.col("MUREX_COUNTERPART").isNotNull())
        .dropDuplicates(["MUREX_COUNTERPART", "RPY_VALUE_DATE"])
    )


def relevant_counterparties(trades: DataFrame, counterparties: DataFrame) -> DataFrame:
    """All versions of the counterparties that some trade refers to."""
    return _versions_of(relevant_keys(trades), counterparties)


def _versions_of(keys: DataFrame, counterparties: DataFrame) -> DataFrame:
    """The versions of the given (date, code) pairs.

    The null-safe comparison of the code changes no result, as a key is never
    NULL.  It gives the keys a shuffle of their own, without which adaptive
    execution could not split a counterparty with very many versions.
    """
    versions = normal_counterparties(counterparties)
    same_key = (F.col("c.RPY_VALUE_DATE") == F.col("k.RPY_VALUE_DATE")) & F.col(
        "c.MUREX_COUNTERPART"
    ).eqNullSafe(F.col("k.MUREX_COUNTERPART"))
    return versions.alias("c").join(keys.alias("k"), same_key, "left_semi")


def latest_versions(counterparties: DataFrame) -> DataFrame:
    """The most recent version per (code, date).

    A version without creation time is the oldest; among equal times the
    greater attributes win, agent first, so the choice never varies.  As an
    aggregate, it is known to be unique: a query that uses no counterparty
    field drops the join altogether.
    """
    return with_unpacked(_latest_packs(counterparties), PACK, COUNTERPARTY_ATTRIBUTES)


def _latest_packs(counterparties: DataFrame) -> DataFrame:
    """The same with the attributes packed."""
    version = F.struct("SYS_CREAT_DTMS", packed(*map(F.col, COUNTERPARTY_ATTRIBUTES)).alias(PACK))
    return (
        normal_counterparties(counterparties)
        .where(F.col("MUREX_COUNTERPART").isNotNull() & F.col("RPY_VALUE_DATE").isNotNull())
        .groupBy("MUREX_COUNTERPART", "RPY_VALUE_DATE")
        .agg(F.max(version).alias("version"))
        .select("MUREX_COUNTERPART", "RPY_VALUE_DATE", f"version.{PACK}")
    )


def with_match_keys(trades: DataFrame) -> DataFrame:
    """Trades plus the two non-NULL codes that decide their match."""
    return trades.withColumns(
        {
            "PRIMARY_CODE": F.coalesce(primary_code(), F.lit(NO_CODE)),
            "FALLBACK_CODE": F.coalesce(fallback_code(), F.lit(NO_CODE)),
        }
    )


def match_table(trades: DataFrame, counterparties: DataFrame) -> DataFrame:
    """One resolved counterparty per distinct (date, primary, fallback), its attributes packed.

    The fallback is asked when the primary gave no agent, and then fills the
    attributes the primary left empty, one by one.

    A combination that lacks the code of a lookup is hashed by its other code,
    so that such combinations spread over all tasks; the extra condition keeps
    them from matching.

    An unknown code is in no reference data, so a code may come with any number
    of others.  The fallback code decides where a combination goes only if the
    primary gave no agent, and the looked-up side comes into each join by a
    shuffle of its own (equal codes are equally long; as one more key, the
    length asks for another shuffle than the aggregate's, and leaves the side
    known to be unique), which lets adaptive execution split a hot code.  That
    side holds one row for each code that the combinations refer to: the trades
    are read once for both.
    """
    combos = (
        with_match_keys(trades)
        .where(F.col("THD_VALUE_DATE").isNotNull())
        .where((F.col("PRIMARY_CODE") != NO_CODE) | (F.col("FALLBACK_CODE") != NO_CODE))
        .select("THD_VALUE_DATE", "PRIMARY_CODE", "FALLBACK_CODE")
        .distinct()
    )
    given = [F.nullif(name, F.lit(NO_CODE)) for name in ("PRIMARY_CODE", "FALLBACK_CODE")]
    # Both sides of the restriction are aggregates on its keys, so it costs the versions no further shuffle.
    keys = _keys(combos, *given)
    latest = _latest_packs(counterparties).join(keys, ["MUREX_COUNTERPART", "RPY_VALUE_DATE"], "left_semi")
    has_primary = F.col("PRIMARY_CODE") != NO_CODE
    has_fallback = F.col("FALLBACK_CODE") != NO_CODE

    def on(side: str, code: Column) -> Column:
        found = F.col(f"{side}.MUREX_COUNTERPART")
        same_length = F.length(found) == F.length(code)
        return (F.col(f"{side}.RPY_VALUE_DATE") == F.col("THD_VALUE_DATE")) & (found == code) & same_length

    pack_1, pack_2 = F.col(f"first.{PACK}"), F.col(f"second.{PACK}")
    # The agent comes first.
    agent_1, agent_2 = [empty_to_null(first_packs(pack, 1)) for pack in (pack_1, pack_2)]
    primary_or_any = F.when(has_primary, F.col("PRIMARY_CODE")).otherwise(F.col("FALLBACK_CODE"))
    asks_fallback = has_fallback & agent_1.isNull()
    fallback_or_any = F.when(asks_fallback, F.col("FALLBACK_CODE")).otherwise(F.col("PRIMARY_CODE"))
    resolved = combos.join(latest.alias("first"), on("first", primary_or_any) & has_primary, "left").join(
        latest.alias("second"), on("second", fallback_or_any) & asks_fallback, "left"
    )
    merged = packs_filled(pack_1, pack_2, len(COUNTERPARTY_ATTRIBUTES)).alias(PACK)
    provenance = [
        F.when(agent_1.isNotNull(), 1).when(agent_2.isNotNull(), 2).alias("MATCH_PRIORITY"),
        F.when(agent_1.isNotNull(), "HS_CNTRP").when(agent_2.isNotNull(), "D_CTP_ENT").alias("MATCH_SOURCE"),
    ]
    return resolved.select("THD_VALUE_DATE", "PRIMARY_CODE", "FALLBACK_CODE", merged, *provenance)


def attach_match(keyed: DataFrame, matches: DataFrame) -> DataFrame:
    """Add the match columns to rows that carry the match keys."""
    joined = keyed.join(matches, ["THD_VALUE_DATE", "PRIMARY_CODE", "FALLBACK_CODE"], "left")
    return with_unpacked(joined, PACK, CARRIED_ATTRIBUTES)


def matched_trades(trades: DataFrame, counterparties: DataFrame) -> DataFrame:
    """Trades with their counterparty's attributes and where the match came from."""
    matched = attach_match(with_match_keys(trades), match_table(trades, counterparties))
    return matched.select(*trades.columns, *MATCH_COLUMNS)
