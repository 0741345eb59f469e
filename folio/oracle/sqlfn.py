"""SQL-text twins of folio.functions.scalar for the DuckDB oracle."""


def name_sql(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f"({p}first_name || ' ' || {p}last_name)"


def rr(num: str, den: str, scale: int, mult: int = 1) -> str:
    """Exact half-up ROUND(num * mult / den, scale) as DOUBLE; NULL if den is 0/NULL."""
    factor = 10 ** scale
    return (f"(CASE WHEN ({den}) <> 0 THEN CAST(((({num}) * {2 * mult * factor} + ({den})) "
            f"// (2 * ({den}))) AS DOUBLE) / CAST({factor} AS DOUBLE) END)")


def days(end: str, start: str) -> str:
    """DATEDIFF(end, start) as BIGINT."""
    return f"CAST(date_diff('day', {start}, {end}) AS BIGINT)"


def fine_days(due: str, ret: str) -> str:
    d = days(ret, due)
    return f"(CASE WHEN {d} < 0 THEN CAST(0 AS BIGINT) ELSE {d} END)"


def fine_for_days(days_sql: str) -> str:
    return f"CAST(({days_sql}) * 0.25 AS DECIMAL(10,2))"


def money_sum(c: str) -> str:
    return f"CAST(SUM({c}) AS DECIMAL(20,2))"


AS_OF = "DATE '2001-06-30'"
AS_OF_EVENTS = "DATE '2024-01-17'"
