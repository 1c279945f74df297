"""SQL text for exact integer rounding."""


def half_up(num: str, den: str) -> str:
    """num/den to the nearest integer, ties away from zero; NULL for a zero denominator."""
    n, d = f"({num})::HUGEINT", f"NULLIF({den}, 0)::HUGEINT"
    return f"(sign({num})::HUGEINT * ((2*abs({n}) + {d}) // (2*{d})))"


def half_even(num: str, den: str) -> str:
    """num/den to the nearest integer for num >= 0, ties to the even neighbour."""
    n, d = f"({num})::HUGEINT", f"NULLIF({den}, 0)::HUGEINT"
    q, r = f"({n} // {d})", f"({n} % {d})"
    return f"({q} + CASE WHEN 2*{r} > {d} OR (2*{r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"


def half_even_signed(num: str, den: str) -> str:
    return f"(sign({num})::HUGEINT * {half_even(f'abs({num})', den)})"


def real(units: str, digits: int) -> str:
    """Scaled integer as a double."""
    return f"(({units})::DOUBLE / 1e{digits})"


def units(x: str, digits: int) -> str:
    """Double that stands for a decimal back to its scaled integer."""
    return f"round(({x}) * 1e{digits})::HUGEINT"


def up(num: str, den: str, digits: int) -> str:
    """num/den rounded half up at ``digits``, as a double."""
    return real(half_up(f"({num})::HUGEINT * {10**digits}", den), digits)


def avg(col: str, scale: int, digits: int) -> str:
    """Mean of a column of scaled integers, rounded half up, as a double."""
    shift = digits - scale
    if shift >= 0:
        return real(half_up(f"sum({col}) * {10**shift}", f"count({col})"), digits)
    return real(half_up(f"sum({col})", f"count({col}) * {10**-shift}"), digits)


def whole(x: str) -> str:
    return f"({x})::BIGINT"


def pick(values: list, number: str) -> str:
    """Value at position number modulo the list length."""
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[(({number}) % {len(values)})::INT + 1]"
