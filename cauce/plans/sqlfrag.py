"""Small helpers that write DuckDB oracle SQL fragments consistently."""


def R(expr: str, d: int = 2) -> str:
    """Round like Spark's ``round(double)`` (HALF_UP on the shortest decimal).

    DuckDB's ``round(DOUBLE)`` rounds some ties down (1.005 -> 1.0); going
    through DECIMAL gives Spark's result.
    """
    scale = min(d + 8, 30)   # wide enough that the cast itself never decides the tie
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,{scale})), {d}) AS DOUBLE)"


def MONEY(expr: str) -> str:
    """'$' + two decimals of an already rounded value."""
    return f"'$' || printf('%.2f', {expr})"


def PCT(expr: str) -> str:
    return f"printf('%.2f', {expr}) || '%'"
