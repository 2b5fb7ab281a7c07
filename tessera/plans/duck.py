"""The normal forms of names and addresses and the blocking tokens, spelled for the engine that the results are compared with.

Written from the rules, not from the plans: lists and lambdas there, no look-around patterns. Fixed tables come from functions/.
"""
from __future__ import annotations

from ..functions import address, text


def quoted(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def within(w: str, xs) -> str:
    return f"list_contains({quoted(xs)}, {w})"


def lookup(w: str, table: dict[str, str]) -> str:
    return f"{quoted(table.values())}[list_position({quoted(table)}, {w})]"


def words(x: str) -> str:
    return f"list_filter(string_split(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda ww: ww <> '')"


def skeleton(w: str) -> str:
    s = w
    for old, new in text.SKELETON:
        s = f"replace({s}, '{old}', '{new}')"
    kept = f"left({s}, 1) || regexp_replace(substr({s}, 2), '[aeiouyh]', '', 'g')"
    return f"CASE WHEN regexp_matches({w}, '^[0-9]') THEN {w} ELSE list_reduce(string_split({kept}, ''), lambda aa, cc: CASE WHEN right(aa, 1) = cc THEN aa ELSE aa || cc END) END"


def canonical(x: str) -> str:
    undotted = f"list_reduce([{x}] || regexp_extract_all({x}, '\\b(?:[a-z]\\.)(?:[a-z]\\.)+'), lambda xx, mm: replace(xx, mm, replace(mm, '.', '')))"
    plain = f"regexp_replace(regexp_replace({undotted}, '[&+]', ' and ', 'g'), '[''`’]', '', 'g')"
    digit = "CASE WHEN length(w1) >= 4 AND regexp_full_match(w1, '[^0-9]*[0-9][^0-9]*') THEN translate(w1, '013458', 'oleasb') ELSE w1 END"
    lettered = f"list_transform({words(plain)}, lambda w1: {digit})"
    short = f"list_transform({lettered}, lambda w2: coalesce({lookup('w2', text.CANON)}, w2))"
    return f"list_transform({short}, lambda w3: CASE WHEN length(w3) >= 5 AND NOT {within('w3', text.LEGAL)} THEN coalesce({lookup(skeleton('w3'), text.LEGAL_SKELETONS)}, w3) ELSE w3 END)"


def core(tokens: str) -> str:
    no_stop = f"list_filter({tokens}, lambda w4: NOT {within('w4', text.STOP)})"
    bare = f"list_filter({no_stop}, lambda w5: NOT {within('w5', text.LEGAL)})"
    return f"CASE WHEN len({bare}) > 0 THEN {bare} WHEN len({no_stop}) > 0 THEN {no_stop} ELSE {tokens} END"


_key = f"list_filter(core, lambda w6: NOT {within('w6', text.GENERIC)})"
_split = f"'(?s)^(.*?){text.ALIAS}(.*)$'"
NAMES = f"""
    SELECT key, array_to_string(tokens, ' ') AS name_clean, array_to_string(core, ' ') AS name_core, array_to_string(CASE WHEN len({_key}) > 0 THEN {_key} ELSE core END, ' ') AS name_key,
        array_to_string(list_transform(core, lambda w7: {skeleton('w7')}), ' ') AS name_skel, array_to_string(core, '') AS name_nospace, array_to_string(alt, ' ') AS name_alt,
        array_to_string(list_sort(list_distinct(list_filter(tokens, lambda w8: {within('w8', text.LEGAL)}))), ' ') AS name_legal, is_domain, is_nonlatin
    FROM (SELECT *, {core('tokens')} AS core, {core('alt_tokens')} AS alt FROM (SELECT *, {canonical('main')} AS tokens, {canonical('alt_text')} AS alt_tokens
    FROM (SELECT key, is_domain, is_nonlatin, CASE WHEN one = '' THEN two ELSE one END AS main, CASE WHEN one = '' THEN '' ELSE two END AS alt_text
    FROM (SELECT key, is_domain, is_nonlatin, trim(CASE WHEN regexp_matches(t, '{text.ALIAS}') THEN regexp_extract(t, {_split}, 1) ELSE t END) AS one, trim(regexp_extract(t, {_split}, 2)) AS two
    FROM (SELECT key, is_nonlatin, CASE WHEN label <> '' THEN replace(label, '-', ' ') ELSE t END AS t, CASE WHEN label <> '' THEN 1 ELSE 0 END AS is_domain
    FROM (SELECT *, regexp_extract(regexp_replace(t, '\\s+', '', 'g'), '{text.DOMAIN}', 1) AS label
    FROM (SELECT key, regexp_replace(lower(business_name), '{text.MESSRS}', ' ', 'g') AS t, CASE WHEN len(list_filter(string_split(business_name, ''), lambda c1: unicode(c1) > 591 AND regexp_matches(c1, '\\pL'))) > 0 THEN 1 ELSE 0 END AS is_nonlatin
    FROM {{raw}}) z1) z2) z3) z4) z5) z6) z7"""

_plain = "trim(regexp_replace({0}, '[^a-z0-9]+', ' ', 'g'))"
_first = "coalesce(({0})[1], '')"
_pin = "regexp_replace(trim(lower(business_address)), '(^|[^0-9])([0-9][0-9][0-9]) ([0-9][0-9][0-9])($|[^0-9])', '\\1\\2\\3\\4', 'g')"
_joined = "regexp_replace(regexp_replace(body, '([0-9])\\s*[-/]\\s*([a-z0-9])', '\\1\\2', 'g'), '([a-z0-9])\\s*[-/]\\s*([0-9])', '\\1\\2', 'g')"
_short = f"list_transform({words(_joined)}, lambda v1: CASE WHEN regexp_full_match(v1, '[0-9]+') THEN regexp_replace(v1, '^0+([0-9])', '\\1') ELSE coalesce({lookup('v1', address.CANON)}, v1) END)"
_codes = "list_filter(regexp_split_to_array(body, '[^\\w\\-/]+'), lambda v2: regexp_full_match(v2, '[0-9]+') AND length(v2) BETWEEN 5 AND 6 AND left(v2, 2) <> '00')"
_bare = "regexp_replace({0}, '^0+([0-9])', '\\1')"
_distinct = "list_filter({0}, lambda v3, i3: list_position({0}, v3) = i3)"
_runs = f"list_transform(regexp_extract_all(body, '[0-9]+'), lambda v4: {_bare.format('v4')})"
ADDRESSES = f"""
    SELECT key, array_to_string(tokens, ' ') AS addr_clean, {_first.format(f"list_filter(numeric, lambda v5: v5 <> {_bare.format('code')})")} AS house_no, code AS postcode,
        {_first.format("list_filter(list_transform(parts, lambda v6: v6.state), lambda v7: v7 IS NOT NULL)")} AS state, array_to_string({_distinct.format(_runs)}, ' ') AS numbers,
        array_to_string(list_filter(list_transform(rest, lambda v8: regexp_extract(v8.plain, '{address.LANDMARK}', 0)), lambda v9: v9 <> ''), ' ') AS landmark, CASE WHEN t = '' THEN 1 ELSE 0 END AS addr_missing
    FROM (SELECT *, CASE WHEN length(last) = 5 AND numeric[1] = {_bare.format('last')} THEN '' ELSE last END AS code
    FROM (SELECT *, list_filter(tokens, lambda u1: regexp_matches(u1, '[0-9]')) AS numeric, coalesce({_codes}[-1], '') AS last
    FROM (SELECT *, list_filter({_short}, lambda u2: NOT {within('u2', address.STOP)}) AS tokens
    FROM (SELECT *, array_to_string(list_transform(rest, lambda u3: regexp_replace(regexp_replace(u3.raw, '(?s){address.LANDMARK}', ''), '{address.LABEL}', ' ', 'g')), ',') AS body
    FROM (SELECT *, list_filter(parts, lambda u4: u4.state IS NULL) AS rest
    FROM (SELECT key, t, list_filter(list_transform(string_split(t, ','), lambda u5: struct_pack(raw := u5, plain := {_plain.format('u5')}, state := {lookup(_plain.format('u5'), address.state_codes())})),
        lambda u6: u6.plain <> '' AND NOT {within('u6.plain', address.COUNTRIES)}) AS parts
    FROM (SELECT key, regexp_replace({_pin}, '{address.CENSUS_PLACE}', ' ', 'g') AS t FROM {{raw}}) y1) y2) y3) y4) y5) y6) y7"""

_pairs = "flatten(list_transform(list_sort(sk), lambda p1, j1: list_transform(list_sort(sk)[j1 + 1:], lambda p2: 'kk_' || p1 || '_' || p2)))"
_cross = "flatten(list_transform({0}, lambda p3: list_transform({1}, lambda p4: '{2}_' || p3 || '_' || p4)))"
_prefixed = "list_transform({0}, lambda p5: '{1}_' || p5)"
_joined_name = "(CASE WHEN length(name_nospace) >= 4 THEN ['z_' || name_nospace] ELSE CAST([] AS varchar[]) END)"
_some = "(CASE WHEN {0} <> '' THEN ['{1}_' || {0}] ELSE CAST([] AS varchar[]) END)"
_passes = {
    "name": f"{_prefixed.format('ws', 'n')} || {_prefixed.format('sk', 'k')} || {_pairs} || {_joined_name}",
    "addr": f"{_prefixed.format('aw', 'a')} || {_some.format('house_no', 'h')} || {_some.format('postcode', 'p')} || " + _prefixed.format("list_filter(string_split(numbers, ' '), lambda p6: length(p6) >= 2)", "d") + f" || {_cross.format('nums', 'aw[:4]', 'ha')}",
    "combo": f"{_pairs} || {_joined_name} || {_cross.format('nums', 'sk', 'hk')} || (CASE WHEN postcode <> '' THEN {_prefixed.format('sk', 'pk_')} ELSE CAST([] AS varchar[]) END) || {_cross.format('aw[:4]', 'sk[:3]', 'ak')}",
}
_passes["combo"] = _passes["combo"].replace("'pk__' || p5", "'pk_' || postcode || '_' || p5")
_skeletons = f"list_filter(list_transform(list_filter(ws, lambda q1: NOT regexp_full_match(q1, '[0-9]+')), lambda q2: {skeleton('q2')}), lambda q3: true)"
_sets = f"""(SELECT *, (list_filter(list_filter(all_sk, lambda q4, i4: list_position(all_sk, q4) = i4), lambda q5: length(q5) >= 2))[:5] AS sk FROM (SELECT *, {_skeletons} AS all_sk
    FROM (SELECT *, list_filter(string_split(name_core || ' ' || name_alt, ' '), lambda q6: length(q6) >= 2) AS ws, list_filter(string_split(addr_clean, ' '), lambda q7: length(q7) >= 3 AND NOT regexp_matches(q7, '[0-9]')) AS aw,
        (list_filter(string_split(addr_clean, ' '), lambda q8: regexp_matches(q8, '[0-9]')))[:3] AS nums FROM {{clean}}) x1) x2) x3"""
TOKENS = " UNION ALL ".join(f"SELECT country, key, source, '{p}' AS pass, unnest(list_distinct({e})) AS token FROM {_sets}" for p, e in _passes.items())
