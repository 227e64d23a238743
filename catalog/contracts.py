"""Contracts of all models as queries: every rule with its number of bad rows, and the failing rows with what they break."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from catalog.registry import query
from ticketlake.contracts import Contract, contracts
from ticketlake.operators import contract_checks as K
from ticketlake.plans.warehouse import Warehouse
from ticketlake.session import AS_OF


def _bad(c: Contract) -> list[tuple[str, str, str]]:
    """(column, check, condition of a bad row) in the oracle's SQL."""
    now = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
    out = [(x, "not_null", f"{x} IS NULL") for x in c.required]
    out += [(x, "accepted_values", f"CAST({x} AS VARCHAR) NOT IN ({', '.join(repr(v) for v in values)})") for x, values in c.accepted.items()]
    return out + [(name, "row_rule", sql.replace("{as_of}", now)) for name, sql in c.rows.items()]


def _counts(c: Contract) -> str:
    checks = _bad(c)
    counts = ", ".join(f"COUNT(*) FILTER ({bad}) AS c{k}" for k, (_, _, bad) in enumerate(checks))
    rows = "".join(f", {{'column_name': '{x}', 'check_name': '{kind}', 'bad_rows': c{k}}}" for k, (x, kind, _) in enumerate(checks))
    repeated = f"(SELECT COUNT(*) FROM (SELECT {c.key} FROM {c.model} WHERE {c.key} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1))"
    return f"SELECT '{c.model}' AS model, unnest([{{'column_name': '{c.key}', 'check_name': 'unique', 'bad_rows': {repeated}}}{rows}]) AS r FROM (SELECT {counts} FROM {c.model})"


def _failing(c: Contract) -> str:
    broken = ", ".join(f"CASE WHEN {bad} THEN '{kind}:{x}' END" for x, kind, bad in _bad(c))
    return f"SELECT '{c.model}' AS model, CAST({c.key} AS VARCHAR) AS key, array_to_string(list_sort(list_filter([{broken}], lambda x: x IS NOT NULL)), ' ') AS broken FROM {c.model}"


def _every(layers: tuple[str, ...]) -> list[Contract]:
    return [c for c in contracts() if c.model.startswith(layers)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _checked(t, layers) -> DataFrame:
    w = Warehouse(t)
    return _union([K.check(getattr(w, c.model), c, AS_OF) for c in _every(layers)])


_PASS = "SELECT model, r.column_name AS column_name, r.check_name AS check_name, r.bad_rows AS bad_rows, CASE WHEN r.bad_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({})"
for _name, _layers in (("qa1_qa4_contracts_staging", ("stg_",)), ("qa1_qa4_contracts_silver", ("silver_",)), ("qa1_qa4_contracts_gold", ("gold_",))):
    query(_name, _PASS.format(" UNION ALL ".join(_counts(c) for c in _every(_layers))))(lambda t, layers=_layers: _checked(t, layers))


def _broken(t, layers) -> DataFrame:
    from pyspark.sql import functions as F

    w = Warehouse(t)
    return _union([K.failing(getattr(w, c.model), c, AS_OF) for c in _every(layers)]).withColumn("broken", F.array_join("broken", " "))


#: Years of the given tables lie outside the contract's, so every staging row of desk and inventory fails; the layers above have no such rule.
query("qa4_failing_rows", "SELECT * FROM (" + " UNION ALL ".join(_failing(c) for c in _every(("silver_", "gold_"))) + ") WHERE broken <> ''")(lambda t: _broken(t, ("silver_", "gold_")))
query("qa4_failing_rows_external", "SELECT * FROM (" + " UNION ALL ".join(_failing(c) for c in _every(("stg_external", "stg_cve", "stg_harddrive", "stg_laptops", "stg_eventlog"))) + ") WHERE broken <> ''")(
    lambda t: _broken(t, ("stg_external", "stg_cve", "stg_harddrive", "stg_laptops", "stg_eventlog"))
)
