"""Query registry and small SQL text helpers for the oracles."""
from __future__ import annotations

import re

from ticketlake.rules import ACCENTS_FROM, ACCENTS_TO
from ticketlake.sources.adapters import BRONZE
from ticketlake.sources.tables import Tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {
    f"bronze_{name}": sql.format(**{n: n for n in needs}) for name, (sql, needs) in BRONZE.items()
}
_NAME = re.compile(r"\b(?:bronze|stg|silver|gold|corpus|idx|tmp)_\w+")


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def oracle(sql: str) -> str:
    """Prefix ``sql`` with the named sub-queries it mentions, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in CTES and name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    once = {n: "MATERIALIZED " if n.startswith(("idx_", "corpus_")) else "" for n in order}
    return "WITH " + ",\n".join(f"{n} AS {once[n]}({CTES[n]})" for n in order) + "\n" + sql


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def deco(fn):
        def run(spark, sf_dir):
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return deco


# ---- oracle text helpers ------------------------------------------------------------------------
def fold(x: str) -> str:
    return f"translate(lower({x}), '{ACCENTS_FROM}', '{ACCENTS_TO}')"


def blank(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def has(x: str) -> str:
    return f"COALESCE(TRIM({x}) <> '', FALSE)"


def one(x: str) -> str:
    return f"COALESCE({x} = 1, FALSE)"


def lit(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def classify(x: str, rules, default) -> str:
    arms = []
    for patterns, label in rules:
        patterns = (patterns,) if isinstance(patterns, str) else patterns
        cond = " OR ".join(f"contains({fold(x)}, '{p}')" for p in patterns)
        arms.append(f"WHEN {cond} THEN {lit(label)}")
    return f"CASE {' '.join(arms)} ELSE {lit(default)} END"


def tier(x: str, cuts, default) -> str:
    arms = " ".join(f"WHEN {x} {op} {cut} THEN {lit(label)}" for op, cut, label in cuts)
    return f"CASE {arms} ELSE {lit(default)} END"


def codes(x: str, mapping, default) -> str:
    arms = []
    for cs, label in mapping:
        cs = cs if isinstance(cs, tuple) else (cs,)
        arms.append(f"WHEN CAST({x} AS VARCHAR) IN ({', '.join(repr(str(c)) for c in cs)}) THEN {lit(label)}")
    return f"CASE {' '.join(arms)} ELSE {lit(default)} END"


def is_in(x: str, values) -> str:
    return f"CAST({x} AS VARCHAR) IN ({', '.join(repr(str(v)) for v in values)})"


def null_in(x: str, values, contains=()) -> str:
    bad = [f"{fold(f'TRIM({x})')} IN ({', '.join(repr(v.lower()) for v in list(values) + [''])})"]
    bad += [f"contains({fold(f'TRIM({x})')}, '{p}')" for p in contains]
    return f"CASE WHEN {' OR '.join(bad)} THEN NULL ELSE TRIM({x}) END"


def leading_int(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE COALESCE(TRY_CAST(regexp_extract({x}, '^\\s*([0-9]+)', 1) AS BIGINT), 0) END"


def rnd(x: str, digits: int) -> str:
    """Half-up rounding on a decimal."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"
