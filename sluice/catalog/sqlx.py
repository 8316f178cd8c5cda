"""DuckDB SQL text for the oracles (independent SQL restatements of each
operator; DuckDB has no initcap and needs the 'g' flag for global
replacement)."""

from __future__ import annotations


def text(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR))"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


def blank_null(x: str) -> str:
    return f"CASE WHEN length(trim({x})) > 0 THEN {x} END"


def normalize_phone(x: str) -> str:
    s = text(x)
    d = f"regexp_replace({s}, '[^0-9]', '', 'g')"
    lead = f"CASE WHEN starts_with({d}, '62') THEN '0' || {d}[3:] WHEN starts_with({d}, '8') THEN '0' || {d} ELSE {d} END"
    junk = (f"{s} IS NULL OR {s} = '' OR {s} = '0' OR regexp_matches({s}, '\\be\\+?\\d+', 'i') "
            f"OR regexp_matches({s}, '\\bn/?a\\b', 'i') OR regexp_matches({s}, '^null$', 'i')")
    return f"(CASE WHEN {junk} THEN NULL WHEN regexp_matches({lead}, '^[0-9]+$') THEN {lead} END)"


def phone_valid(x: str) -> str:
    s = f"regexp_replace({text(x)}, '[\\s().\\-/]', '', 'g')"
    return f"COALESCE(regexp_matches({s}, '^(\\+62|62|0)?(8[1-9][0-9]{{7,10}}|[2-7][0-9]{{7,10}})$'), false)"


def phone_status(v: str, n: str) -> str:
    return f"(CASE WHEN {v} AND {n} THEN 'valid' WHEN NOT {v} AND NOT {n} THEN 'invalid' ELSE 'check' END)"


def address(cols: list[str]) -> list[str]:
    cleaned = [blank_null(initcap(f"trim({c})")) for c in cols]
    out = [cleaned[0]]
    for j in range(1, len(cleaned)):
        dup = " OR ".join(f"({cleaned[j]} = {cleaned[i]})" for i in range(j))
        out.append(f"(CASE WHEN {dup} THEN NULL ELSE {cleaned[j]} END)")
    return out


def clean_name(x: str) -> str:
    s = f"regexp_replace({x}, '[^A-Za-zÀ-ÿ''\\-\\s]', '', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    return blank_null(initcap(s))


def clean_nik(x: str) -> str:
    s = f"regexp_replace(regexp_replace(trim({x}), '\\s+', '', 'g'), '\\D', '', 'g')"
    return f"(CASE WHEN length({s}) = 16 THEN {s} END)"


def clean_postal(x: str) -> str:
    s = f"regexp_replace({text(x)}, '\\s+', '', 'g')"
    return f"(CASE WHEN regexp_matches({s}, '^\\d{{5}}$') THEN {s} END)"


def coords(lat: str, lon: str) -> tuple[str, str]:
    la = f"TRY_CAST({lat} AS FLOAT)"
    lo = f"TRY_CAST({lon} AS FLOAT)"
    la = f"(CASE WHEN {la} BETWEEN -90 AND 90 THEN {la} END)"
    lo = f"(CASE WHEN {lo} BETWEEN -180 AND 180 THEN {lo} END)"
    return (f"(CASE WHEN {lo} = 0.0 THEN NULL ELSE {la} END)", f"(CASE WHEN {lo} = 0.0 THEN NULL ELSE {lo} END)")


def clean_bool(x: str) -> str:
    s = f"lower({text(x)})"
    return f"(CASE WHEN {s} IN ('y','yes','true','1') THEN true WHEN {s} IN ('n','no','false','0') THEN false END)"


def padded(x: str, allowed: list[str]) -> str:
    vals = ", ".join(f"'{a.upper()}'" for a in allowed)
    cond = f"upper({x}) IN ({vals})" if allowed else "false"
    return f"(CASE WHEN NOT ({cond}) THEN NULL ELSE {x} END)"


def location(x: str) -> str:
    return initcap(f"trim(regexp_replace({x}, '[^A-Za-z\\s\\-'']', '', 'g'))")


def yn(x: str) -> str:
    s = f"lower(trim(CAST({x} AS VARCHAR)))"
    return f"(CASE WHEN {s} = 'y' THEN true WHEN {s} = 'n' THEN false END)"


def zero_null_text(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    return f"(CASE WHEN TRY_CAST({s} AS DECIMAL(38,18)) = 0 OR {s} IN ('0', '') THEN NULL ELSE {x} END)"


def round_dec(x: str, s: int) -> str:
    return f"TRY_CAST(round(CAST({x} AS DECIMAL(38,10)), {s}) AS DECIMAL(10,{s}))"
