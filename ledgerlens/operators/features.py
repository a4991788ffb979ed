"""Domain feature expressions: one projection, no shuffle.

Every feature is guarded by "inputs present" exactly like the reference: a
missing input column silently skips the feature. Divisions use the 1e-6 guard
and ``try_divide`` so ANSI mode never raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import stats as S

DAYS_PER_YEAR = 365.25        # fixed value
EMPLOYED_SENTINEL = 365243    # fixed value: "not employed" marker in DAYS_EMPLOYED
EXT_WEIGHTS = {"EXT_SOURCE_1": 0.25, "EXT_SOURCE_2": 0.50, "EXT_SOURCE_3": 0.25}  # fixed values


def affordability(cols: set[str]) -> dict[str, Column]:
    """E1-E6."""
    out = {}
    if {"AMT_ANNUITY", "AMT_INCOME_TOTAL", "AMT_CREDIT"} <= cols:
        out["DEBT_BURDEN_RATIO"] = S.eps_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL")
        out["CREDIT_INCOME_RATIO"] = S.eps_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL")
        out["ANNUITY_CREDIT_RATIO"] = S.eps_ratio("AMT_ANNUITY", "AMT_CREDIT")
        out["PAYMENT_RATE"] = S.eps_ratio("AMT_ANNUITY", "AMT_CREDIT")
    if {"AMT_GOODS_PRICE", "AMT_CREDIT"} <= cols:
        out["GOODS_CREDIT_RATIO"] = S.eps_ratio("AMT_GOODS_PRICE", "AMT_CREDIT")
        out["CREDIT_GOODS_DIFF"] = F.col("AMT_CREDIT") - F.col("AMT_GOODS_PRICE")
    return out


def lifecycle(cols: set[str]) -> dict[str, Column]:
    """Day offsets (negative) to years; sentinel -> null."""
    out = {}
    if "DAYS_BIRTH" in cols:
        out["AGE_YEARS"] = -F.col("DAYS_BIRTH") / DAYS_PER_YEAR
    if "DAYS_EMPLOYED" in cols:
        clean = F.when(F.col("DAYS_EMPLOYED") != EMPLOYED_SENTINEL, F.col("DAYS_EMPLOYED"))
        out["DAYS_EMPLOYED_CLEAN"] = clean.cast("double")
        out["YEARS_EMPLOYED"] = -clean / DAYS_PER_YEAR
        if "DAYS_BIRTH" in cols:
            out["EMPLOYMENT_LIFE_FRACTION"] = F.try_divide(-clean, -F.col("DAYS_BIRTH") + F.lit(S.EPS))
    if "DAYS_REGISTRATION" in cols:
        out["YEARS_SINCE_REGISTRATION"] = -F.col("DAYS_REGISTRATION") / DAYS_PER_YEAR
    if "DAYS_ID_PUBLISH" in cols:
        out["YEARS_SINCE_ID_CHANGE"] = -F.col("DAYS_ID_PUBLISH") / DAYS_PER_YEAR
    return out


def ext_composites(cols: set[str]) -> dict[str, Column]:
    """Null-skipping row statistics of the external scores (>= 2 present
    columns needed); the weighted score propagates nulls like plain arithmetic."""
    ext = [c for c in EXT_WEIGHTS if c in cols]
    if len(ext) < 2:
        return {}
    out = {
        "EXT_SOURCE_MEAN": S.row_mean(ext),
        "EXT_SOURCE_SUM": S.row_sum(ext),
        "EXT_SOURCE_MIN": S.row_min(ext),
        "EXT_SOURCE_MAX": S.row_max(ext),
        "EXT_SOURCE_STD": S.row_std(ext),
    }
    out["EXT_SOURCE_RANGE"] = out["EXT_SOURCE_MAX"] - out["EXT_SOURCE_MIN"]
    w_sum = sum(EXT_WEIGHTS[c] for c in ext)
    weighted = None
    for c in ext:
        term = F.col(c) * EXT_WEIGHTS[c]
        weighted = term if weighted is None else weighted + term
    out["EXT_SOURCE_WEIGHTED"] = weighted / w_sum
    return out


def per_capita(cols: set[str]) -> dict[str, Column]:
    """E20-E21."""
    out = {}
    if "CNT_FAM_MEMBERS" in cols:
        if "AMT_INCOME_TOTAL" in cols:
            out["INCOME_PER_PERSON"] = S.eps_ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS")
        if "AMT_CREDIT" in cols:
            out["CREDIT_PER_PERSON"] = S.eps_ratio("AMT_CREDIT", "CNT_FAM_MEMBERS")
    return out


GROUPS = {"ratios": affordability, "lifecycle": lifecycle,
          "ext_composites": ext_composites, "per_capita": per_capita}


def domain_features(df: DataFrame, groups=tuple(GROUPS)) -> DataFrame:
    """Append every applicable domain feature in one ``withColumns`` projection."""
    cols = set(df.columns)
    new: dict[str, Column] = {}
    for g in groups:
        new.update(GROUPS[g](cols))
    return df.withColumns(new)
