"""SQL of polynomial fits, for checking: by orthogonal polynomials, another way than the moments of the
operators."""

from __future__ import annotations


def fit_sql(name: str, source: str, keys: list[str], x: str, ys: dict[str, str], top: int, degree: str | None = None) -> str:
    """Common table expressions that end in `name`: `source` with, for each (out, y) of `ys`, the least
    squares polynomial of y on x in each group, of degree `top` or of the column `degree` up to it. Each
    polynomial follows from the two before it; those that vanish on the data count for nothing."""
    w = f"OVER (PARTITION BY {', '.join(keys)})"
    norm = lambda k: f"sum({name}_q{k} * {name}_q{k}) {w}"
    steps = [f"{name}_0 AS (SELECT *, ({x} - avg({x}) {w}) / CASE WHEN stddev_pop({x}) {w} > 1e-200 THEN stddev_pop({x}) {w} ELSE 1 END AS {name}_t, 1.0::DOUBLE AS {name}_q0 FROM {source})"]
    steps.append(f"{name}_1 AS (SELECT *, {name}_t - avg({name}_t) {w} AS {name}_q1 FROM {name}_0)")
    for k in range(1, top):
        a = f"coalesce(sum({name}_t * {name}_q{k} * {name}_q{k}) {w} / nullif({norm(k)}, 0), 0)"
        b = f"coalesce({norm(k)} / nullif({norm(k - 1)}, 0), 0)"
        steps.append(f"{name}_{k + 1} AS (SELECT *, ({name}_t - {a}) * {name}_q{k} - {b} * {name}_q{k - 1} AS {name}_q{k + 1} FROM {name}_{k})")

    def value(y: str) -> str:
        parts = [f"avg({y}) {w}"]
        for k in range(1, top + 1):
            asked = f"{norm(k)} > 1e-9 * count(*) {w}" + (f" AND {degree} >= {k}" if degree else "")
            parts.append(f"CASE WHEN {asked} THEN sum({y} * {name}_q{k}) {w} / nullif({norm(k)}, 0) * {name}_q{k} ELSE 0 END")
        return " + ".join(parts)

    steps.append(f"{name} AS (SELECT * EXCLUDE ({name}_t, {', '.join(f'{name}_q{k}' for k in range(top + 1))}), {', '.join(f'{value(y)} AS {out}' for out, y in ys.items())} FROM {name}_{top})")
    return ", ".join(steps)
