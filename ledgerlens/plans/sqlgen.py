"""Small helpers that write the DuckDB oracle SQL for wide tables."""

from __future__ import annotations

from ledgerlens.functions.stats import sql_round

R = sql_round


def unpivot_lateral(source: str, cols: list[str], ids: list[str] = (), cast: str = "DOUBLE",
                    name_col: str = "column_name", value_col: str = "value") -> str:
    """Unpivot keeping nulls: ``source`` is a table/CTE name."""
    vals = ", ".join(f"('{c}', CAST({c} AS {cast}))" for c in cols)
    idl = "".join(f"{source}.{i}, " for i in ids)
    return (f"SELECT {idl}v.{name_col}, v.{value_col} FROM {source}, "
            f"LATERAL (VALUES {vals}) v({name_col}, {value_col})")


def name_index(cols: list[str], name_col: str = "column_name", idx_col: str = "idx") -> str:
    vals = ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))
    return f"SELECT * FROM (VALUES {vals}) t({name_col}, {idx_col})"


def skew_sql(x: str) -> str:
    return f"(CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 ELSE skewness({x}) END)"


def kurt_sql(x: str) -> str:
    return f"(CASE WHEN count({x}) < 4 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 ELSE kurtosis({x}) END)"
