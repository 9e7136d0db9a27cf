"""ANSI SQL for the named queries, runnable by DuckDB over the same tables.

Written independently of the DataFrame code: common table expressions for the layers, one statement per query.
"""

from __future__ import annotations

import re

from tierline.model import (
    FORECAST_MEASURES,
    FORECAST_TYPES,
    SETTLEMENT_DDL,
    SETTLEMENT_REQUIRED_COLUMNS,
    USAGE_ALIASES,
    USAGE_DAILY_COLUMNS,
    USAGE_DIMENSIONS,
    USAGE_FACT_KEYS,
    USAGE_MEASURES,
    USAGE_MONTHLY_GRAIN,
    USAGE_TYPES,
)


def _half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero; the denominator may be negative, not zero."""
    return (
        f"(sign({numerator})*sign({denominator})*"
        f"((2*abs({numerator}) + abs({denominator})) // (2*abs({denominator}))))"
    )


LINE = """
lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN region r ON cn.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""
_PRICE = "l_extendedprice::decimal(18,2)"
_NET = f"({_PRICE} * (1 - l_discount::decimal(5,2)))"
_GROSS = f"({_NET} * (1 + l_tax::decimal(5,2)))"
_DISC = f"({_PRICE} * l_discount::decimal(5,2))"
_DISC_GROSS = f"({_DISC} * (1 + l_tax::decimal(5,2)))"

# Cleaned column -> value, in landed order.
USAGE = {
    "client_pmn": "CASE WHEN l_linenumber % 2 = 1 THEN ' ' || lower(cn.n_name) ELSE cn.n_name END",
    "partner_pmn": "CASE WHEN s_suppkey % 37 = 1 THEN '' WHEN s_suppkey % 37 <> 0 THEN s_name END",
    "traffic_direction": "l_returnflag",
    "call_date": "CASE WHEN l_partkey % 101 = 0 THEN strftime(l_shipdate, '%d/%m/%Y') "
    "ELSE strftime(l_shipdate, '%Y-%m-%d') END",
    "call_type": "o_orderpriority",
    "imsi": "o_custkey::varchar",
    "apn": "CASE WHEN p_size % 10 <> 0 THEN p_brand END",
    "duration": "CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE l_quantity::decimal(18,2)::varchar END",
    "volume": f"({_PRICE})::varchar",
    "event_count": "l_linenumber::varchar",
    "roamer_indicator": "CASE WHEN l_linenumber = 4 THEN 'VISITOR' ELSE c_mktsegment END",
    "total_charge_sdr_net": f"{_NET}::decimal(18,6)::varchar",
    "total_charge_sdr_gross": f"{_GROSS}::decimal(18,6)::varchar",
    "iot_rti_group_id": "s_nationkey::varchar",
    "service_type_id": "p_type",
    "event_type_id": "o_orderstatus",
    "call_type_level_2": "CASE WHEN l_linestatus <> 'O' THEN l_linestatus END",
    "rat_type": "(p_size % 4)::varchar",
    "tac_number": "(p_partkey % 100)::varchar",
    "roaming_partner_country": "sn.n_name",
    "call_month": "strftime(l_shipdate, '%Y-%m')",
    "destination_category": "r_name",
    "destination": "cn.n_name",
    "is_camel": "CASE WHEN l_tax > 0.04 THEN 'Y' ELSE 'N' END",
    "source_system": "'synthetic'",
    "batch_id": "o_orderstatus",
}

_NUMBER = "'^-?\\d+(\\.\\d+)?$'"
_ISO = "'^\\d{4}-\\d{2}-\\d{2}$'"


def _misfit(c: str, t: str) -> str:
    shape = _ISO if t == "date" else _NUMBER if t.startswith("decimal") else "'^-?\\d+$'"
    return f"coalesce({c} <> '' AND (NOT regexp_matches({c}, {shape}) OR try_cast({c} AS {t}) IS NULL), false)"


_BAD = " OR ".join(_misfit(c, t) for c, t in USAGE_TYPES.items())
_REASON = "concat_ws(',', " + ", ".join(f"CASE WHEN {_misfit(c, t)} THEN '{c}' END" for c, t in USAGE_TYPES.items()) + ")"

_UNKNOWN_KEYS = {k: f"coalesce(lower(trim({c})), 'unknown')" for k, c in USAGE_FACT_KEYS.items()}
_DEC_MEASURES = [m for m in USAGE_MEASURES if m != "event_count"]


def _dimension(name: str, natural: str, key: str, label: str, attribute: str | None, extra: str) -> str:
    """One row per normalised value: smallest spelling, then filled attribute, then smallest attribute."""
    attr = attribute or "NULL::varchar"
    return (
        f"SELECT md5(norm) AS {key}, {label}{extra} FROM (SELECT lower(trim({natural})) AS norm, {natural} AS label, "
        f"{attr} AS attribute, row_number() OVER (PARTITION BY lower(trim({natural})) "
        f"ORDER BY {natural}, ({attr} IS NULL), {attr}) AS rn FROM bronze WHERE {natural} IS NOT NULL) WHERE rn = 1"
    )


def _dimension_sql(table: str) -> str:
    d = USAGE_DIMENSIONS[table]
    attribute = d.attribute[0] if d.attribute else None
    if table == "dim_date":
        day = "try_strptime(label, '%Y-%m-%d')::date"
        return _dimension(
            table, d.natural, d.key, f"{day} AS call_date", attribute,
            f", attribute AS call_month, year({day})::int AS year, month({day})::int AS month, day({day})::int AS day",
        )
    extra = ""
    if d.attribute_key:
        extra += f", md5(lower(trim(attribute))) AS {d.attribute_key}"
    if d.attribute:
        extra += f", attribute AS {d.attribute[1]}"
    return _dimension(table, d.natural, d.key, f"label AS {d.label}", attribute, extra)


def _spelled(columns) -> str:
    """Each value behind its length, NULL as a dash, all in one text."""
    return " || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in columns)


def _int_key(*columns: str) -> str:
    joined = columns[0] if len(columns) == 1 else _spelled(columns)
    filled = " OR ".join(f"{c} IS NOT NULL" for c in columns)
    return f"CASE WHEN {filled} THEN ('0x' || substr(md5({joined}), 1, 15))::bigint END"


def _row_hash(columns) -> str:
    return f"md5({_spelled(columns)})"


FORECAST = {
    "client_name": "CASE WHEN o_custkey % 89 <> 0 THEN cn.n_name END",
    "client_group_name": "CASE WHEN o_custkey % 89 <> 0 THEN r_name END",
    "partner_name": "s_name",
    "partner_group_name": "sn.n_name",
    "service_type": "p_type",
    "event_type": "o_orderstatus",
    "traffic_direction": "CASE WHEN l_returnflag = 'R' THEN 'CR' ELSE 'VR' END",
    "period_start_date": "date_trunc('month', l_shipdate)::timestamp",
    "cr_period_start_date": "date_trunc('month', l_shipdate)::timestamp",
    "destination_type": "c_mktsegment",
    "agreement_reference": "CASE WHEN s_suppkey % 41 <> 0 THEN 'AGR_' || (s_suppkey % 50)::varchar END",
    "rti_group": "p_brand",
    "traffic_volume": "(CASE WHEN c_nationkey = 7 AND l_linestatus = 'F' THEN 0 "
    "WHEN l_partkey % 103 <> 0 THEN l_quantity::decimal(18,2) END)::decimal(20,2)",
    "charged_volume": "(l_quantity::decimal(18,2) * (1 - l_discount::decimal(5,2)))::decimal(20,2)",
    "tap_charge_sdr_net": f"{_NET}::decimal(20,5)",
    "tap_charge_sdr_gross": f"{_GROSS}::decimal(20,5)",
    "disc_charge_sdr_net": f"{_DISC}::decimal(20,5)",
    "disc_charge_sdr_gross": f"{_DISC_GROSS}::decimal(20,5)",
    "no_of_records": "1::int",
    "forecast_or_actual_ind": "CASE WHEN l_orderkey % 83 = 0 THEN 'X' WHEN l_linestatus = 'O' THEN 'F' ELSE 'A' END",
}


def _spelled_date(day: str) -> str:
    formats = ("%Y-%m-%d", "%d-%b-%y", "%d/%m/%Y", "%m/%d/%Y", "%d/%m/%y", "%m/%d/%y", "%Y/%m/%d")
    arms = " ".join(f"WHEN {i} THEN strftime({day}, '{f}')" for i, f in enumerate(formats))
    return f"CASE o_orderkey % 7 {arms} END"


def _spelled_amount(amount: str) -> str:
    cents = f"({amount} * 100)::bigint"
    whole = f"({cents} // 100)"
    grouped = (
        f"({whole} // 1000)::varchar || ',' || lpad(({whole} % 1000)::varchar, 3, '0') || '.' || "
        f"lpad(({cents} % 100)::varchar, 2, '0')"
    )
    return (
        f"CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 3 = 0 THEN ({amount})::varchar "
        f"WHEN o_orderkey % 3 = 1 THEN CASE WHEN {whole} >= 1000 THEN {grouped} ELSE ({amount})::varchar END "
        f"ELSE {cents}::varchar || 'E-2' END"
    )


_TOTAL = "o_totalprice::decimal(18,2)"
SETTLEMENT = {
    "row_id": "lpad(o_orderkey::varchar, 12, '0')",
    "home_pmn": "CASE WHEN o_custkey % 50 = 0 THEN '' WHEN o_custkey % 50 = 1 THEN '  ' "
    "ELSE 'HOME' || (o_custkey % 20)::varchar END",
    "home_operator": "c_mktsegment",
    "traffic_direction": "CASE WHEN o_orderkey % 2 = 0 THEN 'CR' ELSE 'VR' END",
    "service_type": "o_orderpriority",
    "event_type": "o_orderstatus",
    "partner_name": "c_name",
    "partner_pmn": "CASE WHEN o_custkey % 50 <> 2 THEN 'PMN' || c_nationkey::varchar END",
    "country": "n_name",
    "traffic_period": f"CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE {_spelled_date('o_orderdate')} END",
    "agreement_reference": "'AGR_' || (o_custkey % 50)::varchar",
    "agreement_start_date": _spelled_date("(o_orderdate::date - 30)"),
    "agreement_end_date": f"CASE WHEN o_orderkey % 59 = 0 THEN 'open' "
    f"ELSE {_spelled_date('(o_orderdate::date + 335)')} END",
    "currency": "'SDR'",
    "conversion_rate": "CASE WHEN o_orderkey % 5 = 0 THEN '1.02886535219e-7' ELSE '1.25' END",
    "settlement_status": "o_orderstatus",
    "traffic_volume": f"({_TOTAL} * 100)::bigint::varchar || 'E-12'",
    "tap_charges_excl_tax": _spelled_amount(_TOTAL),
    "tap_charges_incl_tax": _spelled_amount(f"({_TOTAL} * 1.19::decimal(3,2))::decimal(18,2)"),
    "settled_amount_excl_tax": f"CASE WHEN o_orderstatus = 'F' THEN ({_TOTAL})::varchar ELSE '' END",
    "traffic_volume_not_rounded": f"({_TOTAL})::varchar",
    "internal_note": "'not loaded'",
}


def _parse_date(c: str) -> str:
    """The seven spellings in order; two-digit years are in this century."""
    t = f"trim({c})"

    def slashed(day: int, month: int, year: str) -> str:
        return f"try_strptime(split_part({t}, '/', {day}) || '/' || split_part({t}, '/', {month}) || '/' || {year}, '%d/%m/%Y')::date"

    two = f"'20' || split_part({t}, '/', 3)"
    four = f"split_part({t}, '/', 3)"
    return (
        f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime({t}, '%Y-%m-%d')::date "
        f"WHEN regexp_matches({t}, '^\\d{{2}}-[A-Za-z]{{3}}-\\d{{2}}$') "
        f"THEN try_strptime(left({t}, 7) || '20' || right({t}, 2), '%d-%b-%Y')::date "
        f"WHEN regexp_matches({t}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN coalesce({slashed(1, 2, four)}, {slashed(2, 1, four)}) "
        f"WHEN regexp_matches({t}, '^\\d{{2}}/\\d{{2}}/\\d{{2}}$') THEN coalesce({slashed(1, 2, two)}, {slashed(2, 1, two)}) "
        f"WHEN regexp_matches({t}, '^\\d{{4}}/\\d{{2}}/\\d{{2}}$') THEN try_strptime({t}, '%Y/%m/%d')::date END"
    )


SETTLEMENT_TYPES = dict(re.findall(r"(\w+) (string|date|decimal\(\d+,\d+\))", SETTLEMENT_DDL))
_DATES = [c for c, t in SETTLEMENT_TYPES.items() if t == "date"]
_DECIMALS = [c for c, t in SETTLEMENT_TYPES.items() if t.startswith("decimal")]
_PRESENT_DATES = [c for c in _DATES if c in SETTLEMENT]
_PRESENT_DECIMALS = [c for c in _DECIMALS if c in SETTLEMENT]


def _settled(c: str, t: str) -> str:
    if c not in SETTLEMENT:
        return f"NULL::{'varchar' if t == 'string' else t} AS {c}"
    if t == "date":
        return f"{_parse_date(c)} AS {c}"
    if t.startswith("decimal"):
        return f"try_cast(nullif(replace(trim({c}), ',', ''), '') AS {t}) AS {c}"
    return c


_BLANK_PMN = "trim(coalesce(home_pmn, '')) = '' OR trim(coalesce(partner_pmn, '')) = ''"
_ANY_DATE = (
    "'^\\d{4}-\\d{2}-\\d{2}$|^\\d{1,2}-[A-Za-z]{3}-\\d{2,4}$|^\\d{1,2}/\\d{1,2}/\\d{2,4}$|^\\d{2,4}/\\d{1,2}/\\d{1,2}$'"
)
_ANY_NUMBER = "'^[+-]?\\d[\\d,]*(\\.\\d+)?([eE][+-]?\\d+)?$'"


def _cells(columns, pattern: str, kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT row_id, '{c}' AS column_name, {c} AS value, '{kind}' AS kind FROM settlement "
        f"WHERE trim(coalesce({c}, '')) <> '' AND NOT regexp_matches(trim({c}), {pattern})"
        for c in columns
    )


_USAGE_SELECT = ", ".join(f"{v} AS {c}" for c, v in USAGE.items())
_FACT_SUMS = ", ".join(
    [f"sum(try_cast({m} AS decimal(18,6)))::decimal(28,6) AS {m}" for m in _DEC_MEASURES]
    + ["sum(try_cast(event_count AS bigint))::bigint AS event_count"]
)

# name -> (statement, common table expressions it reads)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "copies": (
        "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_quantity <= 10", (),
    ),
    "cleaned": (f"SELECT {_USAGE_SELECT} FROM {LINE.replace('lineitem l', 'copies l')}", ("copies",)),
    "bronze": (f"SELECT * FROM cleaned WHERE NOT ({_BAD})", ("cleaned",)),
    "grouped": (
        f"SELECT {', '.join(f'{v} AS {k}' for k, v in _UNKNOWN_KEYS.items())}, {_FACT_SUMS}, "
        f"min(source_system) AS source_system, min(batch_id) AS batch_id FROM bronze "
        f"GROUP BY {', '.join(_UNKNOWN_KEYS.values())}",
        ("bronze",),
    ),
    "fact": (
        f"SELECT md5(concat_ws('|', {', '.join(USAGE_FACT_KEYS)})) AS traffic_fact_id, *, "
        f"{_row_hash([*USAGE_FACT_KEYS, *USAGE_MEASURES])} AS record_hash "
        f"FROM (SELECT {', '.join(f'md5({k}) AS {k}' for k in USAGE_FACT_KEYS)}, "
        f"{', '.join(USAGE_MEASURES)}, source_system, batch_id FROM grouped)",
        ("grouped",),
    ),
    **{t: (_dimension_sql(t), ("bronze",)) for t in USAGE_DIMENSIONS},
    "daily": (
        "SELECT "
        + ", ".join(
            next(f"{d.table}.{src}" for d in USAGE_DIMENSIONS.values() for src, out in d.daily if out == c) + f" AS {c}"
            for c in USAGE_DAILY_COLUMNS
        )
        + ", duration AS total_duration, volume AS total_volume, event_count AS total_event_count, "
        "total_charge_sdr_net, total_charge_sdr_gross FROM fact "
        + " ".join(f"LEFT JOIN {d.table} ON fact.{d.fact_key} = {d.table}.{d.key}" for d in USAGE_DIMENSIONS.values()),
        ("fact", *USAGE_DIMENSIONS),
    ),
    "forecast": (f"SELECT {', '.join(f'{v} AS {c}' for c, v in FORECAST.items())} FROM {LINE}", ()),
    "partners": (
        f"SELECT {_int_key('partner_name', 'partner_group_name')} AS partner_id, "
        "partner_name || '_' || partner_group_name AS partner_key, partner_name, partner_group_name, "
        "'' AS partner_pmn, '' AS partner_country, true AS is_active "
        "FROM (SELECT DISTINCT partner_name, partner_group_name FROM forecast "
        "WHERE partner_name IS NOT NULL AND partner_group_name IS NOT NULL)",
        ("forecast",),
    ),
    "agreements": (
        f"SELECT {_int_key('agreement_reference')} AS agreement_id, agreement_reference AS agreement_key, "
        f"{_int_key('agreement_reference')} AS iot_agreement_id, agreement_reference, 'ACTIVE' AS agreement_status, "
        "DATE '2026-07-01' AS agreement_start_date, NULL::date AS agreement_end_date, 'SDR' AS currency "
        "FROM (SELECT DISTINCT agreement_reference FROM forecast WHERE agreement_reference IS NOT NULL)",
        ("forecast",),
    ),
    "ffact": (
        f"SELECT {_int_key('client_name', 'client_group_name')} AS client_master_entity_id, "
        "NULL::bigint AS client_main_master_entity_id, p.partner_id AS partner_master_entity_id, "
        "NULL::bigint AS partner_main_master_entity_id, "
        f"{_int_key('service_type')} AS iot_service_type_id, {_int_key('event_type')} AS iot_event_type_id, "
        f"{_int_key('destination_type')} AS destination_type_id, a.iot_agreement_id, "
        f"{_int_key('rti_group')} AS iot_rti_group_id, traffic_direction, "
        "period_start_date::date AS period_start_date, cr_period_start_date::date AS cr_period_start_date, "
        "forecast_or_actual_ind, "
        + ", ".join(f"{m}::decimal(20,6) AS {m}" for m in FORECAST_MEASURES)
        + ", no_of_records::bigint AS no_of_records, "
        + _row_hash(
            [
                f"strftime(f.{c}, '%Y-%m-%d %H:%M:%S')" if t == "timestamp" else f"f.{c}"
                for c, t in FORECAST_TYPES.items()
            ]
        )
        + " AS record_hash, 'forecast_001' AS ingestion_id FROM forecast f "
        "LEFT JOIN partners p ON f.partner_name = p.partner_name AND f.partner_group_name = p.partner_group_name "
        "LEFT JOIN agreements a ON f.agreement_reference = a.agreement_reference",
        ("forecast", "partners", "agreements"),
    ),
    "settlement": (
        f"SELECT {', '.join(f'{v} AS {c}' for c, v in SETTLEMENT.items())} FROM orders o "
        "JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey",
        (),
    ),
    "settlement_gold": (
        f"SELECT {', '.join(_settled(c, t) for c, t in SETTLEMENT_TYPES.items())} FROM settlement "
        f"WHERE NOT ({_BLANK_PMN})",
        ("settlement",),
    ),
    "issues": (
        _cells(_PRESENT_DATES, _ANY_DATE, "INVALID_DATE_FORMAT")
        + " UNION ALL "
        + _cells(_PRESENT_DECIMALS, _ANY_NUMBER, "INVALID_VALUE"),
        ("settlement",),
    ),
}

_F_NAMES = (
    "total_traffic_volume", "total_charged_volume", "total_tap_charge_net",
    "total_tap_charge_gross", "total_discount_net", "total_discount_gross",
)
_F_TOTALS = (
    ", ".join(
        f"sum({m})::decimal(30,{2 if m.endswith('volume') else 5}) AS {n}"
        for m, n in zip(FORECAST_MEASURES, _F_NAMES, strict=True)
    )
    + ", sum(no_of_records)::bigint AS record_count"
)
CTES["client_date"] = (
    "SELECT client_master_entity_id::varchar AS client_key, strftime(period_start_date, '%Y-%m-%d') AS date_key, "
    f"forecast_or_actual_ind, forecast_or_actual_ind = 'F' AS is_forecast, {_F_TOTALS} FROM ffact "
    "GROUP BY client_master_entity_id, period_start_date, forecast_or_actual_ind",
    ("ffact",),
)
CTES["service_direction"] = (
    "SELECT iot_service_type_id::varchar AS service_type_key, traffic_direction AS direction_key, "
    "strftime(period_start_date, '%Y-%m-%d') AS date_key, "
    f"forecast_or_actual_ind, forecast_or_actual_ind = 'F' AS is_forecast, {_F_TOTALS} FROM ffact "
    "GROUP BY iot_service_type_id, traffic_direction, period_start_date, forecast_or_actual_ind",
    ("ffact",),
)
CTES["monthly_forecast"] = (
    "SELECT strftime(period_start_date, '%Y-%m') AS year_month, client_master_entity_id::varchar AS client_key, "
    "forecast_or_actual_ind, forecast_or_actual_ind = 'F' AS is_forecast, sum(traffic_volume)::decimal(30,2) AS total_traffic_volume, "
    "sum(charged_volume)::decimal(30,2) AS total_charged_volume, "
    "sum(tap_charge_sdr_net + disc_charge_sdr_net)::decimal(30,5) AS total_charges_net, "
    "sum(no_of_records)::bigint AS record_count FROM ffact "
    "GROUP BY strftime(period_start_date, '%Y-%m'), client_master_entity_id, forecast_or_actual_ind",
    ("ffact",),
)

_F6, _A6 = "(f * 1000000)::hugeint", "(a * 1000000)::hugeint"
_RATIO = _half_up(f"(({_F6} - {_A6}) * 100000000)", _A6)
_PCT = _half_up(_RATIO, "10000::hugeint")
_VARIANCE_OUT = (
    "client_master_entity_id::varchar AS client_key, iot_service_type_id::varchar AS service_type_key, "
    "traffic_direction AS direction_key, strftime(period_start_date, '%Y-%m-%d') AS date_key, "
    "f::decimal(30,2) AS forecast_traffic_volume, fc::decimal(30,5) AS forecast_charge_net, "
    "a::decimal(30,2) AS actual_traffic_volume, ac::decimal(30,5) AS actual_charge_net, "
    "(f - a)::decimal(30,2) AS variance_traffic, "
    f"CASE WHEN a <> 0 THEN ({_PCT} * 0.01::decimal(3,2))::decimal(10,2) END AS variance_pct, "
    "(fc - ac)::decimal(30,5) AS variance_charge"
)


def _one_side(indicator: str, measure: str) -> str:
    picked = f"CASE WHEN forecast_or_actual_ind = '{indicator}' THEN {measure} END"
    return f"coalesce(sum({picked}), 0)::decimal(30,6)"


_GRAIN = "client_master_entity_id, iot_service_type_id, traffic_direction, period_start_date"
CTES["variance"] = (
    f"SELECT {_VARIANCE_OUT} FROM (SELECT {_GRAIN}, {_one_side('F', 'traffic_volume')} AS f, "
    f"{_one_side('F', 'tap_charge_sdr_net')} AS fc, {_one_side('A', 'traffic_volume')} AS a, "
    f"{_one_side('A', 'tap_charge_sdr_net')} AS ac FROM ffact WHERE forecast_or_actual_ind IN ('F', 'A') "
    f"GROUP BY {_GRAIN})",
    ("ffact",),
)


def _joined_side(indicator: str, volume: str, charge: str) -> str:
    return (
        f"(SELECT {_GRAIN}, sum(traffic_volume) AS {volume}, sum(tap_charge_sdr_net) AS {charge} FROM ffact "
        f"WHERE forecast_or_actual_ind = '{indicator}' GROUP BY {_GRAIN})"
    )


CTES["variance_joined"] = (
    f"SELECT {_VARIANCE_OUT} FROM (SELECT {_GRAIN}, "
    + ", ".join(f"coalesce({c}, 0)::decimal(30,6) AS {c}" for c in ("f", "fc", "a", "ac"))
    + f" FROM {_joined_side('F', 'f', 'fc')} FULL OUTER JOIN {_joined_side('A', 'a', 'ac')} "
    f"USING ({_GRAIN}))",
    ("ffact",),
)


def _checks(layer: str, source: str, *checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS check_name, {passed} AS passed, {details} AS details FROM ({source})"
        for name, passed, details in checks
    )


def _exists(layer: str, name: str, source: str, empty: str, suffix: str) -> str:
    return _checks(
        layer, source, (name, "n > 0", f"CASE WHEN n > 0 THEN n::varchar || '{suffix}' ELSE '{empty}' END")
    )


def _none_of(layer: str, name: str, source: str, good: str, suffix: str) -> str:
    return _checks(
        layer, source, (name, "k = 0", f"CASE WHEN k = 0 THEN '{good}' ELSE k::varchar || '{suffix}' END")
    )


def _quality() -> tuple[str, tuple[str, ...]]:
    parts = [
        _exists("bronze", "record_count", "SELECT count(*) AS n FROM forecast", "nothing there", " rows"),
        _none_of(
            "bronze", "null_keys", "SELECT count(*) AS k FROM forecast WHERE client_name IS NULL",
            "every key filled", " keys missing",
        ),
        _checks(
            "bronze",
            "SELECT min(traffic_volume) AS lo, max(traffic_volume) AS hi, min(period_start_date)::date AS first, "
            "max(period_start_date)::date AS last FROM forecast",
            ("volume_ranges", "true", "'lowest ' || lo::varchar || ', highest ' || hi::varchar"),
            ("date_coverage", "true", "'first ' || first::varchar || ', last ' || last::varchar"),
        ),
    ]
    sources = {
        "dim_forecast_actual": "SELECT DISTINCT forecast_or_actual_ind FROM forecast "
        "WHERE forecast_or_actual_ind IS NOT NULL",
        "dim_partner": "SELECT * FROM partners",
        "dim_agreement": "SELECT * FROM agreements",
    }
    for name, source in sources.items():
        parts.append(_exists("silver", f"{name}_exists", f"SELECT count(*) AS n FROM ({source})", "nothing there", " rows"))
        repeated = f"SELECT (SELECT count(*) FROM ({source})) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({source}))) AS k"
        parts.append(_none_of("silver", f"{name}_uniqueness", repeated, "keys differ", " keys repeat"))
    parts.append(_exists("silver", "fact_record_count", "SELECT count(*) AS n FROM ffact", "nothing there", " rows"))
    nulls = "SELECT count(*) AS k FROM ffact WHERE traffic_volume IS NULL OR charged_volume IS NULL"
    parts.append(_none_of("silver", "null_measures", nulls, "every measure filled", " rows lack a measure"))
    missing = (
        "SELECT count(*) AS k FROM ffact f WHERE NOT EXISTS "
        "(SELECT 1 FROM partners p WHERE p.partner_id = f.partner_master_entity_id)"
    )
    parts.append(_none_of("silver", "foreign_keys", missing, "every key known", " rows with an unknown key"))
    gold = {
        "forecast_by_client_date": ("client_date", "client_key, date_key, forecast_or_actual_ind"),
        "forecast_by_service_direction": ("service_direction", "service_type_key, direction_key, date_key, forecast_or_actual_ind"),
        "forecast_vs_actual_comparison": ("variance", "client_key, service_type_key, direction_key, date_key"),
        "forecast_summary_monthly": ("monthly_forecast", "year_month, client_key, forecast_or_actual_ind"),
    }
    for name, (source, grain) in gold.items():
        parts.append(_exists("gold", f"{name}_records", f"SELECT count(*) AS n FROM {source}", "nothing there", " rows"))
        repeated = f"SELECT count(*) AS k FROM (SELECT {grain} FROM {source} GROUP BY {grain} HAVING count(*) > 1)"
        parts.append(_none_of("gold", f"{name}_duplicates", repeated, "grain holds", " keys repeat"))
    for name, in_fact, in_gold, limit in (
        ("volume", "traffic_volume", "total_traffic_volume", "1.0"),
        ("charge", "tap_charge_sdr_net", "total_tap_charge_net", "0.01"),
    ):
        source = (
            f"SELECT abs((SELECT sum({in_fact}) FROM ffact)::decimal(38,6) - "
            f"(SELECT sum({in_gold}) FROM client_date)::decimal(38,6)) AS diff"
        )
        parts.append(
            _checks(
                "gold", source,
                (f"{name}_accuracy", f"diff < {limit}",
                 f"CASE WHEN diff < {limit} THEN 'totals agree' ELSE 'totals differ by ' || diff::varchar END"),
            )
        )
    reads = ("forecast", "partners", "agreements", "ffact", "client_date", "service_direction", "variance", "monthly_forecast")
    return " UNION ALL ".join(parts), reads


CTES["checks"] = _quality()


def _statement(body: str, *reads: str) -> str:
    """The body preceded by every common table expression it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][1]:
            visit(needed)
        ordered.append(name)

    for name in reads:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + "\n" + body


_TENANT = "CASE WHEN batch_id IN ('O', 'P') THEN 'south' ELSE 'north' END"
_MONTHLY = (
    f"SELECT {', '.join(USAGE_MONTHLY_GRAIN)}, "
    + ", ".join(
        f"sum({t})::{'bigint' if t == 'total_event_count' else 'decimal(38,6)'} AS {t}"
        for t in ("total_duration", "total_volume", "total_event_count", "total_charge_sdr_net", "total_charge_sdr_gross")
    )
    + ", count(DISTINCT imsi) AS distinct_imsi_count, count(DISTINCT apn) AS distinct_apn_count "
)
# What stays after the incoming rows were loaded again without the oldest year.
CTES["ffact_kept"] = (
    "SELECT * FROM ffact WHERE NOT (traffic_direction = 'CR' AND year(period_start_date) = "
    "(SELECT min(year(period_start_date)) FROM forecast))",
    ("ffact", "forecast"),
)
# Usage records dated on the first of their month, and what stays of them after the open ones came again without that year.
_OLDEST_OPEN = "o_orderstatus = 'O' AND year(l_shipdate) = (SELECT min(year(l_shipdate)) FROM lineitem)"
CTES["copies_kept"] = ("SELECT * REPLACE (date_trunc('month', l_shipdate)::timestamp AS l_shipdate) FROM copies", ("copies",))
_CLEANED_KEPT = CTES["cleaned"][0].replace("copies l", "copies_kept l")
CTES["cleaned_all"] = (_CLEANED_KEPT, ("copies_kept",))
CTES["cleaned_kept"] = (f"{_CLEANED_KEPT} WHERE NOT ({_OLDEST_OPEN})", ("copies_kept",))
CTES["bronze_kept"] = (CTES["bronze"][0].replace("FROM cleaned", "FROM cleaned_kept"), ("cleaned_kept",))
CTES["grouped_kept"] = (CTES["grouped"][0].replace("FROM bronze", "FROM bronze_kept"), ("bronze_kept",))
CTES["fact_kept"] = (CTES["fact"][0].replace("FROM grouped", "FROM grouped_kept"), ("grouped_kept",))
# Dimensions keep the members of every load.
CTES["bronze_all"] = (CTES["bronze"][0].replace("FROM cleaned", "FROM cleaned_all"), ("cleaned_all",))
for _table in USAGE_DIMENSIONS:
    CTES[f"{_table}_all"] = (CTES[_table][0].replace("FROM bronze", "FROM bronze_all"), ("bronze_all",))
_DAILY_KEPT = CTES["daily"][0].replace("fact.", "fact_kept.").replace("FROM fact ", "FROM fact_kept fact_kept ")
for _table in USAGE_DIMENSIONS:
    _DAILY_KEPT = _DAILY_KEPT.replace(f"LEFT JOIN {_table} ON", f"LEFT JOIN {_table}_all {_table} ON")
CTES["daily_kept"] = (_DAILY_KEPT, ("fact_kept", *[f"{t}_all" for t in USAGE_DIMENSIONS]))
# Files by partner group; values of some partners are spoiled.
CTES["spoiled"] = (
    "SELECT partner_group_name, CASE WHEN odd AND last <> '3' OR NOT odd THEN traffic_volume END AS traffic_volume, "
    "CASE WHEN NOT odd THEN '' WHEN last = '3' THEN 'period_start_date,traffic_volume' WHEN last = '9' THEN 'period_start_date' "
    "WHEN last = '5' THEN 'no_of_records' ELSE '' END AS reason "
    "FROM (SELECT *, forecast_or_actual_ind = 'X' AS odd, right(partner_name, 1) AS last FROM forecast)",
    ("forecast",),
)
CTES["spoiled_files"] = (
    "SELECT *, bool_or(reason <> '') OVER (PARTITION BY partner_group_name) AS held FROM spoiled", ("spoiled",),
)
CTES["client_date_kept"] = (CTES["client_date"][0].replace("FROM ffact ", "FROM ffact_kept "), ("ffact_kept",))


def _counts(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names)


def sql() -> dict[str, str]:
    s = _statement
    blank_rows = "(SELECT count(*) FROM lineitem WHERE l_orderkey % 211 = 0)"
    # A delimited file cannot tell an empty value from a missing one; Parquet can.
    partner = "CASE batch_id WHEN 'P' THEN partner_pmn ELSE nullif(partner_pmn, '') END AS partner_pmn"
    landed_cols = ", ".join(partner if c == "partner_pmn" else c for c in USAGE)
    out = {
        "ingest_clean": s("SELECT * FROM cleaned", "cleaned"),
        "split_valid": s("SELECT * FROM bronze", "bronze"),
        "split_invalid": s(f"SELECT * FROM cleaned WHERE {_BAD}", "cleaned"),
        "split_stats": s(
            "SELECT valid_rows, invalid_rows, "
            + ", ".join(
                f"({_half_up(f'({c}_rows * 1000)::hugeint', '(valid_rows + invalid_rows)::hugeint')} "
                f"* 0.1::decimal(2,1))::decimal(5,1) AS {c}_pct"
                for c in ("valid", "invalid")
            )
            + f" FROM (SELECT count(*) FILTER (WHERE NOT ({_BAD})) AS valid_rows, "
            f"count(*) FILTER (WHERE {_BAD}) AS invalid_rows FROM cleaned)",
            "cleaned",
        ),
        "align_schema": s(
            "SELECT "
            + ", ".join(
                (f"try_cast({c} AS {USAGE_TYPES[c]}) AS {c}" if c in USAGE_TYPES else c)
                if c in USAGE
                else f"NULL::varchar AS {c}"
                for c in USAGE_ALIASES
            )
            + " FROM bronze",
            "bronze",
        ),
        "alias_coalesce": s(
            "SELECT CASE WHEN duration = 'n/a' THEN '0' ELSE duration END AS minutes, count(*) AS row_count "
            "FROM cleaned GROUP BY 1",
            "cleaned",
        ),
        "clean_rows": s(
            "SELECT client_name, CASE WHEN trim(partner_name) <> '' THEN partner_name END AS partner_name, "
            "strftime(period_start_date, '%Y-%m-%d') AS period, traffic_volume, charged_volume, "
            "tap_charge_sdr_gross, disc_charge_sdr_gross, no_of_records, forecast_or_actual_ind, "
            "DATE '2026-07-01' AS _load_date FROM forecast "
            "WHERE client_name IS NOT NULL AND client_group_name IS NOT NULL",
            "forecast",
        ),
        "landing_ingest": s(
            f"SELECT {landed_cols}, {_TENANT} AS _tenant, "
            "'bronze' AS _layer, 'traffic' AS _stage, "
            "CASE batch_id WHEN 'P' THEN 'parquet' ELSE 'csv' END AS _source_format, "
            "DATE '2026-07-01' AS _ingest_date FROM bronze",
            "bronze",
        ),
        "stream_ingest": s(f"SELECT {landed_cols} FROM bronze", "bronze"),
        "stream_two_tenants": s(
            f"SELECT {_TENANT} AS tenant, event_type_id, client_pmn, count(*) AS row_count, "
            "sum(volume::decimal(18,6))::decimal(28,6) AS volume FROM bronze GROUP BY 1, 2, 3",
            "bronze",
        ),
        "mixed_headers": s(
            "SELECT "
            + ", ".join(
                "CASE WHEN batch_id IN ('O', 'P') THEN nullif(partner_pmn, '') END AS partner_pmn"
                if c == "partner_pmn"
                else c
                for c in USAGE
            )
            + " FROM cleaned",
            "cleaned",
        ),
        "split_reasons": s(
            f"SELECT {_REASON} AS reason, count(*) AS row_count FROM cleaned WHERE {_BAD} GROUP BY 1", "cleaned"
        ),
        "samples": s(
            f"SELECT call_date, duration, volume FROM cleaned WHERE {_BAD} "
            "ORDER BY call_date NULLS FIRST, duration NULLS FIRST, volume NULLS FIRST LIMIT 3",
            "cleaned",
        ),
        "forecast_split_reasons": s(
            # A value that cannot be read is NULL; the others of its row and file are there.
            "SELECT partner_group_name, CASE WHEN reason <> '' THEN reason WHEN held THEN 'file' ELSE '' END AS reason, "
            "count(*) AS row_count, sum(traffic_volume) AS volume FROM spoiled_files GROUP BY ALL",
            "spoiled_files",
        ),
        "forecast_reload": s("SELECT * FROM client_date_kept", "client_date_kept"),
        "settlement_reload": s(
            "SELECT * FROM settlement_gold WHERE NOT (event_type = 'O' AND traffic_direction = 'VR')", "settlement_gold"
        ),
        "archived_rows": "SELECT date_trunc('month', o_orderdate)::date AS month, count(*) AS row_count FROM orders "
        "WHERE date_trunc('month', o_orderdate)::date < "
        "((SELECT max(o_orderdate)::date FROM orders) - INTERVAL 24 MONTH)::date GROUP BY 1",
        "delimiter_detect": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {d} AS delimiter, "
            f"(SELECT count(*) FROM (DESCRIBE {t}))::int AS column_count WHERE EXISTS (SELECT 1 FROM {t})"
            for t, d in (("nation", "'~'"), ("supplier", "','"), ("customer", "';'"), ("part", "'|'"), ("orders", "chr(9)"))
        ),
        **{t: s(f"SELECT * FROM {t}", t) for t in USAGE_DIMENSIONS},
        "dimension_members": s(
            " UNION ALL ".join(
                f"SELECT '{d.table}' AS dimension, count(*) AS members, "
                + (f"count({d.attribute[1]})" if d.attribute else "0::bigint")
                + " AS with_attribute, "
                + (f"min({d.label})" if d.table != "dim_date" else "min(strftime(call_date, '%Y-%m-%d'))")
                + f" AS first_label FROM {d.table} HAVING count(*) > 0"
                for d in USAGE_DIMENSIONS.values()
                if not d.unbounded
            ),
            *[d.table for d in USAGE_DIMENSIONS.values() if not d.unbounded],
        ),
        "dim_forecast_actual": s(
            f"SELECT {_int_key('forecast_or_actual_ind')} AS forecast_actual_key, forecast_or_actual_ind, "
            "CASE forecast_or_actual_ind WHEN 'F' THEN 'Forecast' WHEN 'A' THEN 'Actual' ELSE 'Unknown' END "
            "AS forecast_actual_desc FROM (SELECT DISTINCT forecast_or_actual_ind FROM forecast "
            "WHERE forecast_or_actual_ind IS NOT NULL)",
            "forecast",
        ),
        "dim_partner": s("SELECT * FROM partners", "partners"),
        "dim_agreement": s("SELECT * FROM agreements", "agreements"),
        "dim_upsert": s(
            "SELECT * FROM dim_imsi WHERE imsi NOT IN (SELECT imsi FROM bronze WHERE event_type_id = 'F')",
            "dim_imsi",
        ),
        "dim_upsert_stored": s(
            "SELECT d.imsi_key, coalesce(k.label, d.imsi) AS imsi, "
            "md5(lower(trim(coalesce(k.attribute, d.roamer_indicator)))) AS roamer_indicator_key, "
            "coalesce(k.attribute, d.roamer_indicator) AS roamer_indicator, CASE WHEN k.norm IS NULL THEN 'inserted' "
            "WHEN k.attribute IS NULL AND d.roamer_indicator IS NOT NULL THEN 'filled' ELSE 'kept' END AS outcome "
            "FROM dim_imsi d LEFT JOIN (SELECT norm, label, CASE WHEN label NOT LIKE '%7' THEN attribute END AS attribute FROM ("
            "SELECT lower(trim(imsi)) AS norm, imsi AS label, roamer_indicator AS attribute, row_number() OVER ("
            "PARTITION BY lower(trim(imsi)) ORDER BY imsi, (roamer_indicator IS NULL), roamer_indicator) AS rn "
            "FROM bronze WHERE imsi IS NOT NULL AND event_type_id = 'F') WHERE rn = 1) k ON md5(k.norm) = d.imsi_key",
            "dim_imsi",
        ),
        "usage_fact": s("SELECT * FROM fact", "fact"),
        "gold_daily": s("SELECT * FROM daily", "daily"),
        "stored_alerts": _alerts(),
        "catalog_round_trip": (
            "SELECT 'rows' AS kind, o_orderstatus AS name, count(*)::varchar || ' ' || "
            "sum(o_totalprice::decimal(18,2))::varchar || ' 2026-07-01' AS value FROM orders GROUP BY o_orderstatus "
            "UNION ALL VALUES ('exists', 'orders_raw', 'false'), ('exists', 'orders', 'true'), ('table', 'silver.orders', NULL), "
            "('missing', 'o_totalprice', NULL), ('extra', 'settled_on', NULL), ('extra', 'gross', NULL), "
            "('extra', 'created_at', NULL), ('extra', 'updated_at', NULL)"
        ),
        "quarantine_round_trip": s(
            "SELECT 'usage' AS origin, '2026-07-01' AS day, service_type_id AS kind, count(*) AS row_count, "
            f"count(duration) AS filled, max(duration) AS last FROM cleaned WHERE {_BAD} GROUP BY service_type_id "
            "UNION ALL SELECT 'settlement', NULL, event_type, count(*), count(row_id), max(row_id) FROM settlement "
            f"WHERE {_BLANK_PMN} GROUP BY event_type",
            "cleaned", "settlement",
        ),
        "multi_line_rows": (
            "SELECT p_partkey, '\"' || p_brand || '\";' || chr(10) || p_type || chr(10) || chr(10) || p_size::varchar AS note, p_name FROM part"
        ),
        "usage_reload": s(_MONTHLY + "FROM daily_kept GROUP BY " + ", ".join(USAGE_MONTHLY_GRAIN), "daily_kept"),
        "gold_monthly": s(_MONTHLY + "FROM daily GROUP BY " + ", ".join(USAGE_MONTHLY_GRAIN), "daily"),
        "forecast_fact": s("SELECT * FROM ffact", "ffact"),
        "documented_forecast_fact": s(_documented(), "forecast"),
        "by_client_date": s("SELECT * FROM client_date", "client_date"),
        "by_service_direction": s("SELECT * FROM service_direction", "service_direction"),
        "variance": s("SELECT * FROM variance", "variance"),
        "variance_outer_join": s("SELECT * FROM variance_joined", "variance_joined"),
        "forecast_monthly": s("SELECT * FROM monthly_forecast", "monthly_forecast"),
        "settlement_gold": s("SELECT * FROM settlement_gold", "settlement_gold"),
        "settlement_invalid": s(
            f"SELECT row_id, home_pmn, partner_pmn, traffic_period FROM settlement WHERE {_BLANK_PMN}", "settlement"
        ),
        "variance_rollup": s(
            "SELECT date_key, sum(variance_traffic)::decimal(38,2) AS total_variance, "
            f"CASE WHEN count(variance_pct) > 0 THEN ({_half_up('(sum(variance_pct) * 1000000)::hugeint', 'count(variance_pct)::hugeint')} "
            "* 0.000001::decimal(7,6))::decimal(14,6) END AS avg_variance_pct FROM variance GROUP BY date_key",
            "variance",
        ),
        "fa_ratio": s(
            "SELECT count(*) FILTER (WHERE forecast_or_actual_ind = 'F') AS forecast_records, "
            "count(*) FILTER (WHERE forecast_or_actual_ind = 'A') AS actual_records FROM ffact",
            "ffact",
        ),
        "top_clients": s(
            "SELECT c.client_name, sum(g.total_traffic_volume)::decimal(38,2) AS volume FROM client_date g "
            f"JOIN (SELECT DISTINCT client_name, {_int_key('client_name', 'client_group_name')}::varchar AS client_key "
            "FROM forecast WHERE client_name IS NOT NULL AND client_group_name IS NOT NULL) c "
            "ON g.client_key = c.client_key WHERE g.date_key::date BETWEEN (SELECT max(period_start_date)::date - 365 FROM forecast) "
            "AND (SELECT max(period_start_date)::date FROM forecast) "
            "GROUP BY c.client_name ORDER BY volume DESC, c.client_name LIMIT 10",
            "client_date",
        ),
        "pair_activity": s(
            "SELECT client_pmn, partner_pmn, count(*) AS row_count, count(DISTINCT call_date) AS distinct_dates "
            "FROM bronze GROUP BY client_pmn, partner_pmn",
            "bronze",
        ),
        "top_pairs": s(
            "SELECT client_pmn, partner_pmn, count(*) AS row_count, count(DISTINCT call_date) AS distinct_dates "
            "FROM bronze GROUP BY client_pmn, partner_pmn "
            "ORDER BY row_count DESC, client_pmn, partner_pmn NULLS FIRST LIMIT 5",
            "bronze",
        ),
        "union_counts": _counts(("orders", "lineitem", "customer", "supplier", "part", "events")) + " ORDER BY table_name",
        "inventory": " UNION ALL ".join(
            f"SELECT 'star' AS table_schema, '{t}' AS table_name, "
            f"(SELECT count(*) FROM (DESCRIBE {t}))::int AS column_count, (SELECT count(*) FROM {t}) AS row_count"
            for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
        ),
        "ordered_report": s(
            "SELECT traffic_period, country, partner_pmn, service_type, count(*) AS record_count, "
            "sum(tap_charges_excl_tax)::decimal(28,6) AS amount FROM settlement_gold "
            "GROUP BY traffic_period, country, partner_pmn, service_type",
            "settlement_gold",
        ),
        "recent_rows": s(
            "SELECT call_date::date AS day, service_type_id, count(*) AS row_count, "
            "sum(volume::decimal(18,6))::decimal(28,6) AS volume FROM bronze "
            "WHERE call_date::date >= (SELECT max(call_date::date) - 7 FROM bronze) GROUP BY 1, 2",
            "bronze",
        ),
        "indicator_rows": s(
            "SELECT service_type, count(*) AS row_count FROM forecast WHERE forecast_or_actual_ind = 'F' "
            "GROUP BY service_type",
            "forecast",
        ),
        "range_stats": s(
            "SELECT min(traffic_volume) AS min_value, max(traffic_volume) AS max_value, "
            f"({_half_up('(sum(traffic_volume) * 1000000)::hugeint', 'count(traffic_volume)::hugeint')} "
            "* 0.000001::decimal(7,6))::decimal(24,6) AS avg_value, "
            "min(period_start_date)::date AS min_date, max(period_start_date)::date AS max_date FROM forecast",
            "forecast",
        ),
        "null_measures": s(
            "SELECT forecast_or_actual_ind, count(*) AS row_count FROM forecast "
            "WHERE traffic_volume IS NULL OR charged_volume IS NULL GROUP BY forecast_or_actual_ind",
            "forecast",
        ),
        "duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "uniqueness": s("SELECT count(*) AS total, count(DISTINCT client_pmn_key) AS unique_keys FROM fact", "fact"),
        "row_uniqueness": s(
            "SELECT (SELECT count(*) FROM bronze) AS total, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM bronze)) AS unique_rows",
            "bronze",
        ),
        "orphans": s(
            "SELECT iot_agreement_id AS missing_key, count(*) AS fact_rows FROM ffact f WHERE NOT EXISTS "
            f"(SELECT 1 FROM settlement b WHERE {_int_key('b.agreement_reference')} = f.iot_agreement_id) "
            "GROUP BY iot_agreement_id",
            "ffact", "settlement",
        ),
        "orphan_count": s("SELECT count(*) AS orphaned FROM ffact WHERE iot_agreement_id IS NULL", "ffact"),
        "reconcile": s(
            "SELECT *, abs(fact_volume - gold_volume)::decimal(38,6) AS volume_diff, "
            "abs(fact_charge - gold_charge)::decimal(38,6) AS charge_diff, "
            "abs(fact_volume - gold_volume) < 1.0 AS volume_ok, abs(fact_charge - gold_charge) < 0.01 AS charge_ok "
            "FROM (SELECT (SELECT sum(traffic_volume) FROM ffact)::decimal(38,6) AS fact_volume, "
            "(SELECT sum(total_traffic_volume) FROM client_date)::decimal(38,6) AS gold_volume, "
            "(SELECT sum(tap_charge_sdr_net) FROM ffact)::decimal(38,6) AS fact_charge, "
            "(SELECT sum(total_tap_charge_net) FROM client_date)::decimal(38,6) AS gold_charge)",
            "client_date",
        ),
        "scalar_total": s(
            "SELECT sum(total_traffic_volume)::decimal(38,6) AS agg_total_volume, "
            "(SELECT sum(traffic_volume) FROM ffact)::decimal(38,6) AS fact_total_volume FROM client_date",
            "client_date",
        ),
        "quality_report": s("SELECT * FROM checks", "checks"),
        "quality_summary": s(
            "SELECT layer, count(*) FILTER (WHERE passed) AS passed_checks, "
            "count(*) FILTER (WHERE NOT passed) AS failed_checks, count(*) AS total_checks FROM checks GROUP BY layer",
            "checks",
        ),
        "required_columns": s(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, true AS present, "
                f"count(*) FILTER (WHERE trim(coalesce({c}, '')) <> '') AS filled_rows FROM settlement"
                if c in SETTLEMENT
                else f"SELECT '{c}' AS column_name, false AS present, 0::bigint AS filled_rows"
                for c in SETTLEMENT_REQUIRED_COLUMNS
            ),
            "settlement",
        ),
        "csv_issues": s("SELECT * FROM issues", "issues"),
        "first_issues": s(
            "SELECT *, row_number() OVER (PARTITION BY kind ORDER BY row_id, column_name, value)::int AS position "
            "FROM issues QUALIFY position <= 5",
            "issues",
        ),
        "issue_counts": s(
            "SELECT kind, column_name, count(*) AS cells FROM issues GROUP BY kind, column_name", "issues"
        ),
        "strict_date_issues": s(
            "SELECT kind, column_name, count(*) AS cells FROM ("
            + _cells(["agreement_start_date", "agreement_end_date"], _ISO, "INVALID_DATE_FORMAT")
            + ") GROUP BY kind, column_name",
            "settlement",
        ),
        "missing_required": s(
            "SELECT row_id, 'no value for home_pmn' AS reason FROM settlement "
            "WHERE trim(coalesce(home_pmn, '')) = '' ORDER BY row_id LIMIT 10",
            "settlement",
        ),
        "repair_stats": s(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, "
                f"count(*) FILTER (WHERE regexp_matches({c}, '[eE]') AND regexp_matches(trim({c}), {_ANY_NUMBER})) AS exponent_conversions, "
                f"count(*) FILTER (WHERE contains({c}, ',')) AS separator_removals, "
                f"count(*) FILTER (WHERE trim({c}) <> '' AND NOT regexp_matches(trim({c}), {_ANY_NUMBER})) AS unreadable, "
                f"count(*) FILTER (WHERE trim(coalesce({c}, '')) = '') AS blank FROM settlement"
                for c in _PRESENT_DECIMALS
            ),
            "settlement",
        ),
        "empty_rows": s(
            f"SELECT (SELECT count(*) FROM copies) + {blank_rows} AS total_rows, {blank_rows} AS empty_rows", "copies"
        ),
        "daily_counts": "SELECT ts::date AS day, count(*) AS row_count FROM events GROUP BY 1",
        "freshness": "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_load, count(*) AS records, "
        "CASE WHEN max(ts) < max(ts) + INTERVAL 12 HOUR - INTERVAL 1 DAY THEN 'STALE_DATA' ELSE 'OK' END AS status "
        "FROM events",
        "alerts": _alerts(),
        "forecast_alerts": s(
            "SELECT day, 'no_records' AS alert, 'no rows for ' || category AS details FROM "
            "(SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::date AS day FROM "
            "(SELECT min(period_start_date) AS lo, max(period_start_date) AS hi FROM forecast)) d, "
            "(VALUES ('F'), ('A'), ('B'), ('X')) c(category) WHERE NOT EXISTS (SELECT 1 FROM forecast f "
            "WHERE f.period_start_date::date = d.day AND f.forecast_or_actual_ind = c.category)",
            "forecast",
        ),
        "schema_evolution": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS gross_amount, "
        "left(o_orderpriority, 1)::bigint AS o_priority, NULL::date AS settled_on FROM orders",
        "retired_rows": "SELECT year(o_orderdate)::int AS year, count(*) AS row_count FROM orders "
        "WHERE o_orderdate::date < ((SELECT max(o_orderdate)::date FROM orders) - INTERVAL 24 MONTH)::date GROUP BY 1",
        "blank_keys": s(
            "SELECT trim(coalesce(partner_pmn, '')) = '' AS blank_partner, count(*) AS row_count FROM cleaned GROUP BY 1",
            "cleaned",
        ),
    }
    return out


def _documented() -> str:
    texts = {
        "forecast_key": "forecast_or_actual_ind", "client_key": "client_name", "partner_key": "partner_name",
        "service_type_key": "service_type", "event_type_key": "event_type", "direction_key": "traffic_direction",
        "destination_key": "destination_type", "rti_key": "rti_group",
    }
    keys = {k: f"md5(lower(trim(coalesce({c}, ''))))" for k, c in texts.items()}
    keys["date_key"] = "md5(strftime(period_start_date, '%Y-%m-%d'))"
    keys["charge_period_date_key"] = "md5(strftime(cr_period_start_date, '%Y-%m-%d'))"
    keys["agreement_id"] = "agreement_reference"
    sums = ", ".join(
        f"sum({m})::decimal(30,{2 if m.endswith('volume') else 5}) AS {m}" for m in FORECAST_MEASURES
    )
    return (
        f"SELECT {', '.join(f'{v} AS {k}' for k, v in keys.items())}, {sums}, "
        "sum(no_of_records)::bigint AS number_of_records, "
        "max(CASE WHEN forecast_or_actual_ind = 'F' THEN 1 ELSE 0 END)::int AS is_forecast "
        f"FROM forecast GROUP BY {', '.join(keys.values())}"
    )


def _alerts() -> str:
    return (
        "WITH daily AS (SELECT ts::date AS day, count(*) AS n FROM events GROUP BY 1), "
        "calendar AS (SELECT unnest(generate_series(min(day)::timestamp, max(day)::timestamp, INTERVAL 1 DAY))::date "
        "AS day FROM daily), kinds AS (SELECT DISTINCT event_type AS kind FROM events UNION SELECT 'refund') "
        "SELECT (p.day + 7)::date AS day, 'volume_deviation' AS alert, "
        "coalesce(d.n, 0)::varchar || ' rows, ' || p.n::varchar || ' a week earlier' AS details FROM daily p "
        "LEFT JOIN daily d ON d.day = p.day + 7 WHERE p.day + 7 <= (SELECT max(day) FROM daily) "
        "AND abs(coalesce(d.n, 0) - p.n) * 100 > p.n * 20 "
        "UNION ALL SELECT c.day, 'no_records', 'no rows for ' || k.kind FROM calendar c, kinds k "
        "WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.ts::date = c.day AND e.event_type = k.kind)"
    )
