"""Record linkage as relational plans.

Each step is a query over the steps it names in braces. In Spark a step runs on DataFrames, so users can put their own in the
place of any step, and Catalyst sees one plan. The same text, with the few words that engines spell differently, is what the
tests run in another engine. Scores are rounded before they are ranked, and every order has a last key, so ties are settled.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Container, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.address import clean_addresses
from ..functions.hashing import MULTIPLIERS, hash01_udf
from ..functions.similarity import score_udf
from ..functions import translit
from ..functions.text import clean_names
from ..operators import blocking, decision, validation
from ..operators.features import stack_features
from ..sources.scratch import written
from . import duck

TOP, PRUNE, MAX_DF, MAX_DF_SHARE, FOLDS, SAMPLE, THRESHOLD, FLOOR = 3, 0.75, 400, 0.003, 5, 0.3, 0.5, 0.1

#: Spellings: Spark, DuckDB.
WORDS = {"UNNEST": ("explode", "unnest"), "SPLIT": ("split", "string_split"), "STRING": ("string", "varchar"), "[ALL]": ("", ", 'g'"), "MEDIAN": ("percentile", "quantile_cont"), "FIRST_OF": ("slice", "list_slice"), "REGEXP": ("regexp_like", "regexp_matches"), "JARO_WINKLER": ("tessera_jaro_winkler", "100 * jaro_winkler_similarity")}


def duck_hash(key: str, salt: int) -> str:
    x = f"CAST({key} + {salt} AS UBIGINT)"
    for m in MULTIPLIERS:
        x = f"CAST((CAST(xor({x}, {x} >> 33) AS UHUGEINT) * CAST('{m}' AS UHUGEINT)) % CAST('18446744073709551616' AS UHUGEINT) AS UBIGINT)"
    return f"(CAST(xor({x}, {x} >> 33) >> 11 AS DOUBLE) / 9007199254740992)"


WORD_LIST = "SPLIT(trim(regexp_replace(lower(text), '[^a-z]+', ' '[ALL])), ' ')"
OF_CUSTOMER = ("c_custkey AS k", "r_name AS country", "100 + (c_custkey * 7) % 900 AS house", "10000 + (c_custkey * 37) % 89999 AS zip", *(f"coalesce(nullif(AT(w, {i}), ''), 'x') AS w{i + 1}" for i in range(4)))
TOKENS_OF = "SPLIT(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' '[ALL])), ' ')"

STEPS: dict[str, str] = {
    # Records of three sources, derived from customers and the words of English documents.
    # Four words of a text go into the order, not the text.
    "english": f"SELECT doc_id, CAST(floor(doc_id / 1024.0) AS bigint) AS part, FIRST_OF({WORD_LIST}, 1, 4) AS w FROM {{documents}} WHERE lang = 'en'",
    "parts": "SELECT part, sum(n) OVER (ORDER BY part) - n AS before FROM (SELECT part, count(*) AS n FROM {english} GROUP BY part) x",
    "words": "SELECT CAST(before AS bigint) + row_number() OVER (PARTITION BY e.part ORDER BY doc_id) - 1 AS i, w FROM {english} e JOIN {parts} p ON e.part = p.part",
    "base": """
        SELECT """
    + ", ".join(OF_CUSTOMER)
    + """ FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        JOIN {words} ON i = c_custkey % (SELECT count(*) FROM {words})""",
    "raw": """
        SELECT concat('S1-', k + 1) AS entity_id, 10000000000 + k + 1 AS key, 1 AS source, concat(w1, ' ', w2, CASE k % 4 WHEN 0 THEN ' Private Limited' WHEN 1 THEN ' Services Inc.' WHEN 2 THEN ' Company' ELSE ' L.L.C.' END) AS business_name,
            concat(house, ' ', w3, ' Street, ', w4, ', ', zip) AS business_address, country FROM {base} WHERE k % 10 <> 9
        UNION ALL SELECT concat('S2-', k + 1), 20000000000 + k + 1, 2, concat(CASE WHEN k % 7 = 0 THEN concat(w2, ' ', w1) ELSE concat(w1, ' & ', w2) END, CASE k % 4 WHEN 0 THEN ' Pvt Ltd' WHEN 1 THEN ' Svcs' ELSE '' END),
            CASE WHEN k % 11 = 0 THEN '' ELSE concat('00', house, ' ', w3, ' St, ', w4) END, country FROM {base} WHERE k % 5 <> 0
        UNION ALL SELECT concat('S3-', k + 1), 30000000000 + k + 1, 3, CASE k % 7 WHEN 1 THEN concat(w1, w2, '.com') WHEN 2 THEN concat(w1, ' dba ', w2) ELSE concat(w1, ' ', w2, ' Group') END,
            concat('Near ', w4, ' ATM, ', w3, ' Road No ', house, ', ', zip), country FROM {base} WHERE k % 3 <> 0""",
    "truth": "SELECT q.key AS cand, s.key AS s1 FROM {raw} q JOIN {raw} s ON q.source > 1 AND s.source = 1 AND q.key % 10000000000 = s.key % 10000000000",
    "s1_info": "SELECT r.key AS s1, r.country, count(t.cand) AS n_true, CAST(floor(HASH(r.key, 7) * 5) AS int) AS fold FROM {raw} r LEFT JOIN {truth} t ON r.key = t.s1 WHERE r.source = 1 GROUP BY r.key, r.country",
    "hash_folds": "SELECT fold, count(*) AS n, sum(n_true) AS n_true, round(avg(n_true), 6) AS mean_true FROM {s1_info} GROUP BY fold",
    # A matched record is sampled with its owner, another one by itself.
    "sample": f"SELECT r.entity_id, r.source FROM {{raw}} r LEFT JOIN {{truth}} t ON r.key = t.cand WHERE HASH(coalesce(t.s1, r.key), 1) < {SAMPLE}",
    # Blocking: token sets, weights, cosine, the best of each pass.
    "name_words": f"SELECT DISTINCT country, key, source, t FROM (SELECT country, key, source, UNNEST({TOKENS_OF.format('business_name')}) AS t FROM {{raw}}) x WHERE length(t) >= 2",
    "addr_words": f"SELECT DISTINCT country, key, source, t FROM (SELECT country, key, source, UNNEST({TOKENS_OF.format('business_address')}) AS t FROM {{raw}}) x WHERE length(t) >= 2",
    "names": duck.NAMES,
    "addresses": duck.ADDRESSES,
    "clean": "SELECT r.entity_id, r.key, r.source, r.country, n.* EXCLUDE (key), a.* EXCLUDE (key) FROM {raw} r JOIN {names} n ON r.key = n.key JOIN {addresses} a ON r.key = a.key",
    "tokens": duck.TOKENS,
    "name_forms": "SELECT entity_id, name_clean, name_core, name_key, name_skel, name_nospace, name_alt, name_legal, is_domain, is_nonlatin FROM {clean}",
    "address_forms": "SELECT entity_id, addr_clean, house_no, postcode, state, numbers, landmark, addr_missing FROM {clean}",
    "token_sets": "SELECT key, pass, token FROM {tokens}",
    "sizes": "SELECT country, count(*) AS n1 FROM {raw} WHERE source = 1 GROUP BY country",
    "df": "SELECT country, pass, token, count(*) AS df FROM {tokens} WHERE source = 1 GROUP BY country, pass, token",
    "idf": f"SELECT d.country, d.pass, d.token, d.df, ln((n1 + 1.0) / df) + 1 AS idf FROM {{df}} d JOIN {{sizes}} s ON d.country = s.country WHERE df <= greatest({MAX_DF}, CAST(floor({MAX_DF_SHARE} * n1) AS int))",
    "idf_report": "SELECT country, pass, token, df, round(idf, 6) AS idf FROM {idf}",
    "weights": """
        SELECT t.country, t.pass, t.key, t.source, t.token, idf / sqrt(sum(idf * idf) OVER (PARTITION BY t.country, t.pass, t.key)) AS w
        FROM {tokens} t JOIN {idf} i ON t.country = i.country AND t.pass = i.pass AND t.token = i.token""",
    "cosine": """
        SELECT q.country, q.pass, q.key AS cand, s.key AS s1, round(CAST(sum(q.w * s.w) AS double), 8) AS score
        FROM {weights} q JOIN {weights} s ON q.country = s.country AND q.pass = s.pass AND q.token = s.token AND q.source > 1 AND s.source = 1 GROUP BY q.country, q.pass, q.key, s.key""",
    "best": f"""
        SELECT country, pass, cand, s1, score, rn - 1 AS rank FROM (SELECT *, max(score) OVER (PARTITION BY country, pass, cand) AS top FROM (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, pass, cand ORDER BY score DESC, s1) AS rn FROM {{cosine}}) x WHERE rn <= {TOP}) y) z WHERE rn = 1 OR score >= {PRUNE} * top""",
    "merged": """
        SELECT country, cand, s1, max(CASE WHEN pass = 'combo' THEN score ELSE 0 END) AS sc_combo, max(CASE WHEN pass = 'name' THEN score ELSE 0 END) AS sc_name,
            max(CASE WHEN pass = 'addr' THEN score ELSE 0 END) AS sc_addr, count(DISTINCT pass) AS n_pass FROM {best} GROUP BY country, cand, s1""",
    "cand": "SELECT m.*, round(sc_combo + sc_name + sc_addr, 8) AS score, row_number() OVER (PARTITION BY country, cand ORDER BY round(sc_combo + sc_name + sc_addr, 8) DESC, s1) - 1 AS rank FROM {merged} m",
    "candidates_name": "SELECT cand, s1, round(score, 6) AS score, rank FROM {best} WHERE pass = 'name'",
    "candidates_union": "SELECT country, cand, s1, round(score, 6) AS score, rank, round(sc_combo, 6) AS sc_combo, round(sc_name, 6) AS sc_name, round(sc_addr, 6) AS sc_addr, n_pass FROM {cand}",
    "labelled": "SELECT c.*, i.fold, CASE WHEN t.s1 = c.s1 THEN 1 ELSE 0 END AS label FROM {cand} c JOIN {s1_info} i ON c.s1 = i.s1 LEFT JOIN {truth} t ON c.cand = t.cand",
    "labels": "SELECT cand, s1, fold, label FROM {labelled}",
    "blocking_recall": """
        SELECT i.country, count(*) AS n_true, sum(CASE WHEN c.cand IS NOT NULL THEN 1 ELSE 0 END) AS found, sum(CASE WHEN c.sc_combo > 0 THEN 1 ELSE 0 END) AS by_combo, sum(CASE WHEN c.sc_name > 0 THEN 1 ELSE 0 END) AS by_name,
            sum(CASE WHEN c.sc_addr > 0 THEN 1 ELSE 0 END) AS by_addr, """
    + ", ".join(f"sum(CASE WHEN c.rank < {k} THEN 1 ELSE 0 END) AS within_{k}" for k in (1, 2, 3, 5))
    + " FROM {truth} t JOIN {s1_info} i ON t.s1 = i.s1 LEFT JOIN {cand} c ON c.cand = t.cand AND c.s1 = t.s1 GROUP BY i.country",
    "candidate_stats": """
        SELECT i.country, count(*) AS n_s1, round(avg(n), 6) AS mean_n, CAST(MEDIAN(n, 0.5) AS double) AS median_n, CAST(MEDIAN(n, 0.95) AS double) AS p95_n, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS without
        FROM (SELECT i.s1, i.country, count(c.cand) AS n FROM {s1_info} i LEFT JOIN {cand} c ON i.s1 = c.s1 GROUP BY i.s1, i.country) i GROUP BY i.country""",
    "reduction_ratio": """
        SELECT s.country, n1, nq, n_pairs, round(1 - n_pairs / (n1 * CAST(nq AS double)), 9) AS reduction FROM {sizes} s JOIN (SELECT country, count(*) AS nq FROM {raw} WHERE source > 1 GROUP BY country) q ON s.country = q.country
        JOIN (SELECT country, count(*) AS n_pairs FROM {cand} GROUP BY country) p ON s.country = p.country""",
    # Features of pairs among their record's and their entity's pairs.
    "group_features": """
        SELECT cand, s1, round(max(score) OVER c, 6) AS q_best, count(*) OVER c AS q_n, round(score - lead(score, 1, 0.0) OVER (PARTITION BY cand ORDER BY rank), 6) AS gap_next, round((max(score) OVER c) - score, 6) AS gap_best,
            round(score / greatest(max(score) OVER c, 0.000001), 6) AS ratio_best, count(*) OVER s AS s1_n, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS s1_rank,
            round(score / greatest(max(score) OVER s, 0.000001), 6) AS s1_ratio, sum(CASE WHEN rank = 0 THEN 1 ELSE 0 END) OVER s AS s1_top1_n, CASE WHEN cand >= 30000000000 THEN 1 ELSE 0 END AS is_s3
        FROM {cand} WINDOW c AS (PARTITION BY cand), s AS (PARTITION BY s1)""",
    "blocking_partner": """
        SELECT cand, s1, CASE WHEN rn = 1 THEN second ELSE first END AS partner, coalesce(CASE WHEN rn = 1 THEN second_score ELSE first_score END, 0) AS partner_score FROM (
            SELECT cand, s1, rn, max(CASE WHEN rn = 1 THEN cand END) OVER s AS first, max(CASE WHEN rn = 2 THEN cand END) OVER s AS second, max(CASE WHEN rn = 1 THEN score END) OVER s AS first_score, max(CASE WHEN rn = 2 THEN score END) OVER s AS second_score
            FROM (SELECT cand, s1, round(score, 6) AS score, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rn FROM {cand}) x WINDOW s AS (PARTITION BY s1)) y""",
    "exact_features": """
        SELECT c.cand, c.s1, length(a.business_name) AS len_a, length(b.business_name) AS len_b, CASE WHEN b.business_address = '' THEN 1 ELSE 0 END AS amiss_b, CASE WHEN w.n IS NULL THEN 0 ELSE w.n END AS common_words,
            round(CASE WHEN w.n IS NULL THEN 0.0 ELSE w.n / CAST(x.n + y.n - w.n AS double) END, 6) AS jaccard, CASE WHEN split_part(lower(a.business_name), ' ', 1) = split_part(lower(b.business_name), ' ', 1) THEN 1 ELSE 0 END AS first_eq
        FROM {cand} c JOIN {raw} a ON c.s1 = a.key JOIN {raw} b ON c.cand = b.key LEFT JOIN (
            SELECT c.cand, c.s1, count(*) AS n FROM {cand} c JOIN {name_words} p ON p.key = c.s1 JOIN {name_words} q ON q.key = c.cand AND p.t = q.t GROUP BY c.cand, c.s1) w ON w.cand = c.cand AND w.s1 = c.s1
        JOIN (SELECT key, count(*) AS n FROM {name_words} GROUP BY key) x ON x.key = c.s1 JOIN (SELECT key, count(*) AS n FROM {name_words} GROUP BY key) y ON y.key = c.cand""",
    "jaro_winkler": """
        SELECT c.cand, c.s1, round(JARO_WINKLER(lower(a.business_name), lower(b.business_name)), 6) AS name_jw FROM {cand} c JOIN {raw} a ON c.s1 = a.key JOIN {raw} b ON c.cand = b.key""",
    "blocking_relative": """
        SELECT cand, s1, comb, round(comb - (max(comb) OVER c), 6) AS comb_rel, round(sc_name - (max(sc_name) OVER c), 6) AS name_rel, round(sc_addr - (max(sc_addr) OVER c), 6) AS addr_rel, rank() OVER (PARTITION BY cand ORDER BY comb DESC) AS comb_rank
        FROM (SELECT cand, s1, sc_name, sc_addr, round(0.6 * sc_name + 0.4 * sc_addr, 10) AS comb FROM {cand}) x WINDOW c AS (PARTITION BY cand)""",
    # A transparent scorer, so that all that follows can be checked without a learnt model.
    "scored": "SELECT cand, s1, country, fold, label, round(1 / (1 + exp(-(6 * (0.4 * sc_combo + 0.35 * sc_name + 0.25 * sc_addr) - 1.5))), 6) AS prob FROM {labelled}",
    "one_owner": "SELECT cand, s1, country, label, prob FROM (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY prob DESC, s1) AS rn FROM {scored}) x WHERE rn = 1",
    "threshold": f"SELECT cand, s1, prob FROM {{one_owner}} WHERE prob >= {THRESHOLD}",
    # Expected F0.5 of keeping an entity's k most likely pairs, against that of keeping none.
    "ranked": """
        SELECT *, 1.25 * cum / (0.25 * total + k) AS ef FROM (SELECT cand, s1, label, prob, param, row_number() OVER w AS k, sum(p) OVER (PARTITION BY param, s1 ORDER BY prob DESC, cand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
            sum(p) OVER (PARTITION BY param, s1) AS total, exp(sum(ln(1 - p)) OVER (PARTITION BY param, s1)) AS none
        FROM (SELECT o.*, f.param, least(greatest(prob, 0.000001), 0.999999) AS p FROM {one_owner} o JOIN {floors} f ON o.prob >= f.param) x WINDOW w AS (PARTITION BY param, s1 ORDER BY prob DESC, cand)) y""",
    "floors": "SELECT round(CAST(i * 0.025 AS double), 3) AS param FROM (SELECT UNNEST(" + "SPLIT('" + ",".join(map(str, range(39))) + "', ',')) AS s) x, LATERAL (SELECT CAST(s AS int) AS i) y",
    "thresholds": "SELECT round(CAST(0.3 + i * 0.01 AS double), 3) AS param FROM (SELECT UNNEST(" + "SPLIT('" + ",".join(map(str, range(66))) + "', ',')) AS s) x, LATERAL (SELECT CAST(s AS int) AS i) y",
    "kept": """
        SELECT cand, s1, label, prob, param FROM (SELECT *, min(CASE WHEN round(ef, 9) = top THEN k END) OVER (PARTITION BY param, s1) AS k_best FROM (SELECT *, max(round(ef, 9)) OVER (PARTITION BY param, s1) AS top FROM {ranked}) x) y WHERE k <= k_best AND top > none""",
    "expected_f": f"SELECT cand, s1, prob FROM {{kept}} WHERE round(param, 3) = {FLOOR}",
    "grid": """
        SELECT method, round(param, 3) AS param, country, sum(tp) AS tp, sum(n_pred) AS n_pred, sum(f) AS f FROM (SELECT g.method, g.param, i.country, coalesce(p.tp, 0) AS tp, coalesce(p.n_pred, 0) AS n_pred,
            CASE WHEN n_true + coalesce(p.n_pred, 0) = 0 THEN 1.0 ELSE 1.25 * coalesce(p.tp, 0) / (0.25 * n_true + coalesce(p.n_pred, 0)) END AS f
        FROM (SELECT 'threshold' AS method, param FROM {thresholds} UNION ALL SELECT 'expected', param FROM {floors}) g JOIN {s1_info} i ON g.param >= 0
        LEFT JOIN (SELECT 'threshold' AS method, t.param, o.s1, sum(label) AS tp, count(*) AS n_pred FROM {one_owner} o JOIN {thresholds} t ON o.prob >= t.param GROUP BY t.param, o.s1
            UNION ALL SELECT 'expected', param, s1, sum(label), count(*) FROM {kept} GROUP BY param, s1) p ON p.method = g.method AND p.param = g.param AND p.s1 = i.s1) x GROUP BY method, round(param, 3), country""",
    "grid_search": "SELECT method, param, CAST(sum(tp) AS bigint) AS tp, CAST(sum(n_pred) AS bigint) AS n_pred, round(sum(f) / (SELECT count(*) FROM {s1_info}), 6) AS f05 FROM {grid} GROUP BY method, param",
    "per_country": "SELECT country, method, param, f FROM (SELECT country, method, param, round(f, 6) AS f, row_number() OVER (PARTITION BY country ORDER BY round(f, 6) DESC, method DESC, param) AS rn FROM {grid}) x WHERE rn = 1",
    "decision": """
        SELECT scope, method, param, f05, CASE WHEN scope = 'all' OR (SELECT sum(f05 * n) FROM {country_best}) > (SELECT max(f05 * n) FROM {all_best}) + 0.000001 THEN 1 ELSE 0 END AS adopted
        FROM (SELECT * FROM {all_best} UNION ALL SELECT * FROM {country_best}) x""",
    "all_best": "SELECT 'all' AS scope, method, param, f05, n FROM (SELECT *, row_number() OVER (ORDER BY round(f05, 9) DESC, method DESC, param) AS rn FROM (SELECT method, param, sum(f) / (SELECT count(*) FROM {s1_info}) AS f05, (SELECT count(*) FROM {s1_info}) AS n FROM {grid} GROUP BY method, param) x) y WHERE rn = 1",
    "country_best": "SELECT country AS scope, method, param, f05, n FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY round(f05, 9) DESC, method DESC, param) AS rn FROM (SELECT g.country, method, param, sum(f) / max(c.n) AS f05, max(c.n) AS n FROM {grid} g JOIN (SELECT country, count(*) AS n FROM {s1_info} GROUP BY country) c ON c.country = g.country GROUP BY g.country, method, param) x) y WHERE rn = 1",
    "decision_report": "SELECT scope, method, param, round(f05, 6) AS f05, adopted FROM {decision}",
    # Each country's rule where it is adopted, else the rule for all.
    "rules": "SELECT c.country, coalesce(d.method, a.method) AS method, coalesce(d.param, a.param) AS param FROM (SELECT DISTINCT country FROM {s1_info}) c JOIN (SELECT * FROM {decision} WHERE scope = 'all') a ON 1 = 1 LEFT JOIN {decision} d ON d.scope = c.country AND d.adopted = 1",
    "applied": """
        SELECT o.cand, o.s1, o.country, o.label, o.prob FROM {one_owner} o JOIN {rules} r ON r.country = o.country AND r.method = 'threshold' AND o.prob >= r.param
        UNION ALL SELECT k.cand, k.s1, i.country, k.label, k.prob FROM {kept} k JOIN {s1_info} i ON i.s1 = k.s1 JOIN {rules} r ON r.country = i.country AND r.method = 'expected' AND round(k.param, 3) = r.param""",
    "applied_pairs": "SELECT cand, s1, prob FROM {applied}",
    "per_s1": "SELECT i.s1, i.country, i.n_true, CAST(coalesce(sum(p.label), 0) AS bigint) AS tp, count(p.cand) AS n_pred FROM {s1_info} i LEFT JOIN {applied} p ON p.s1 = i.s1 GROUP BY i.s1, i.country, i.n_true",
    "pair_rates": "SELECT CAST(sum(tp) AS bigint) AS tp, CAST(sum(n_pred) AS bigint) AS n_pred, round(sum(tp) / greatest(sum(n_pred), 1.0), 6) AS pair_precision, round(sum(tp) / greatest(sum(n_true), 1.0), 6) AS pair_recall, round(avg(CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END END), 6) AS singletons_empty FROM {per_s1}",
    # What a perfect scorer would reach on the candidates.
    "ceiling": """
        SELECT coalesce(country, 'all') AS country, count(*) AS n, round(avg(f), 6) AS f05, round(avg(CASE WHEN n_true = 0 THEN f END), 6) AS f05_single, round(avg(CASE WHEN n_true > 0 THEN f END), 6) AS f05_matched
        FROM (SELECT i.country, n_true, CASE WHEN n_true = 0 THEN 1.0 ELSE 1.25 * coalesce(tp, 0) / (0.25 * n_true + coalesce(tp, 0)) END AS f FROM {s1_info} i LEFT JOIN (SELECT s1, count(*) AS tp FROM {labelled} WHERE label = 1 GROUP BY s1) p ON p.s1 = i.s1) x GROUP BY ROLLUP (country)""",
    "output_counts": "SELECT i.country, count(*) AS n_s1, CAST(sum(CASE WHEN n_pred > 0 THEN 1 ELSE 0 END) AS bigint) AS with_match, CAST(sum(n_pred) AS bigint) AS n_pairs, count(DISTINCT CASE WHEN n_pred > 0 THEN s1 END) AS distinct_s1 FROM {per_s1} i GROUP BY i.country",
    "test_features": "SELECT cand, s1, country, -1 AS label, -1 AS fold FROM {cand}",
    "sampled_truth": f"SELECT t.cand, t.s1 FROM {{truth}} t WHERE t.s1 IN (SELECT key FROM {{raw}} WHERE source = 1 AND HASH(key, 1) < {SAMPLE})",
    "decided": f"SELECT i.s1, i.country, i.n_true, coalesce(sum(p.label), 0) AS tp, count(p.cand) AS n_pred FROM {{s1_info}} i LEFT JOIN (SELECT * FROM {{one_owner}} WHERE prob >= {THRESHOLD}) p ON p.s1 = i.s1 GROUP BY i.s1, i.country, i.n_true",
    "macro_f05": """
        SELECT coalesce(country, 'all') AS country, count(*) AS n, round(avg(f), 6) AS f05, round(avg(CASE WHEN n_true = 0 THEN f END), 6) AS f05_single, round(avg(CASE WHEN n_true > 0 THEN f END), 6) AS f05_matched
        FROM (SELECT country, n_true, CASE WHEN n_true + n_pred = 0 THEN 1.0 ELSE 1.25 * tp / (0.25 * n_true + n_pred) END AS f FROM {decided}) x GROUP BY ROLLUP (country)""",
    "pair_confusion": f"""
        SELECT count(CASE WHEN o.label = 1 AND o.prob >= {THRESHOLD} THEN 1 END) AS tp, count(CASE WHEN c.cand IS NULL THEN 1 END) AS fn_blocking, count(CASE WHEN c.cand IS NOT NULL AND o.cand IS NULL THEN 1 END) AS fn_owner,
            count(CASE WHEN o.prob < {THRESHOLD} THEN 1 END) AS fn_threshold, (SELECT count(*) FROM {{one_owner}} WHERE label = 0 AND prob >= {THRESHOLD}) AS fp
        FROM {{truth}} t LEFT JOIN {{cand}} c ON c.cand = t.cand AND c.s1 = t.s1 LEFT JOIN {{one_owner}} o ON o.cand = t.cand AND o.s1 = t.s1""",
    "entity_outcomes": """
        SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN n_true = 0 AND n_pred = 0 THEN 'empty, right' WHEN n_true = 0 THEN 'empty, wrong' WHEN n_pred = 0 THEN 'missed' WHEN tp = n_true AND tp = n_pred THEN 'exact'
            WHEN tp = 0 THEN 'all wrong' ELSE 'partial' END AS outcome FROM {decided}) x GROUP BY outcome""",
    "found": f"SELECT t.cand, t.s1, CASE WHEN o.prob >= {THRESHOLD} THEN 1 ELSE 0 END AS found, CASE WHEN c.cand IS NOT NULL THEN 1 ELSE 0 END AS in_cand, coalesce(c.sc_name, 0) AS sc_name FROM {{truth}} t LEFT JOIN {{cand}} c ON c.cand = t.cand AND c.s1 = t.s1 LEFT JOIN {{one_owner}} o ON o.cand = t.cand AND o.s1 = t.s1",
    "cause_rows": f"""
        SELECT p.*, b.addr_missing AS c1, b.is_domain AS c2, CASE WHEN a.state <> '' AND b.state <> '' AND a.state <> b.state THEN 1 ELSE 0 END AS c3, CASE WHEN a.house_no <> '' AND b.house_no <> '' AND a.house_no <> b.house_no THEN 1 ELSE 0 END AS c4,
            CASE WHEN a.country = 'ASIA' THEN 1 ELSE 0 END AS c5, CASE WHEN a.country = 'AMERICA' THEN 1 ELSE 0 END AS c6, CASE WHEN b.source = 2 THEN 1 ELSE 0 END AS c7, CASE WHEN b.source = 3 THEN 1 ELSE 0 END AS c8
        FROM (SELECT cand, s1, 'predicted' AS kind, 1 - label AS wrong, 0 AS lost, 0 AS missed FROM {{one_owner}} WHERE prob >= {THRESHOLD} UNION ALL SELECT cand, s1, 'true', 0, 1 - in_cand, 1 - found FROM {{found}}) p JOIN {{clean}} a ON a.key = p.s1 JOIN {{clean}} b ON b.key = p.cand""",
    "error_causes": "SELECT cause, CAST(sum(CASE WHEN kind = 'predicted' THEN 1 ELSE 0 END) AS bigint) AS n_predicted, CAST(sum(wrong) AS bigint) AS n_wrong, CAST(sum(CASE WHEN kind = 'true' THEN 1 ELSE 0 END) AS bigint) AS n_true, CAST(sum(lost) AS bigint) AS n_lost, CAST(sum(missed) AS bigint) AS n_missed FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS cause, kind, wrong, lost, missed FROM {{cause_rows}} WHERE c{i} = 1" for i, n in enumerate(("candidate address missing", "candidate name is a domain", "state conflict", "house number conflict", "country = ASIA", "country = AMERICA", "candidate from S2", "candidate from S3"), 1))
    + ") x GROUP BY cause",
    "recall_bins": "SELECT bin, count(*) AS n, sum(found) AS found FROM (SELECT CASE WHEN sc_name <= 0.4 THEN '0-40' WHEN sc_name <= 0.6 THEN '40-60' WHEN sc_name <= 0.8 THEN '60-80' WHEN sc_name <= 0.9 THEN '80-90' ELSE '90-100' END AS bin, found FROM {found}) x GROUP BY bin",
    # Outputs and their checks.
    "lists": f"SELECT o.s1, LIST(r.entity_id, o.prob DESC, o.cand) AS ids FROM {{one_owner}} o JOIN {{raw}} r ON r.key = o.cand WHERE o.prob >= {THRESHOLD} GROUP BY o.s1",
    "id_lists": "SELECT r.entity_id AS source1_entity_id, coalesce(l.ids, '') AS matched_entity_ids FROM {raw} r LEFT JOIN {lists} l ON r.key = l.s1 WHERE r.source = 1",
    "rows": "SELECT source1_entity_id AS s1, matched_entity_ids AS ids FROM {id_lists} UNION ALL SELECT 'S1-1', 'S2-2,S2-2,S1-9,X-1' UNION ALL SELECT 'S1-0', 'S2-0'",
    "listed": "SELECT s1, id FROM (SELECT s1, UNNEST(SPLIT(ids, ',')) AS id FROM {rows}) x WHERE id <> ''",
    "findings": """
        SELECT 'duplicate row' AS finding, s1 AS example FROM {rows} GROUP BY s1 HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'duplicate id', s1 FROM (SELECT s1, id FROM {listed} GROUP BY s1, id HAVING count(*) > 1) a
        UNION ALL SELECT DISTINCT 'source 1 id', id FROM {listed} WHERE id LIKE 'S1-%' UNION ALL SELECT DISTINCT 'bad prefix', id FROM {listed} WHERE NOT (id LIKE 'S1-%' OR id LIKE 'S2-%' OR id LIKE 'S3-%')
        UNION ALL SELECT 'unknown row', s1 FROM (SELECT DISTINCT s1 FROM {rows}) b WHERE s1 NOT IN (SELECT entity_id FROM {raw} WHERE source = 1) UNION ALL SELECT 'missing row', entity_id FROM {raw} WHERE source = 1 AND entity_id NOT IN (SELECT s1 FROM {rows})
        UNION ALL SELECT DISTINCT 'unknown id', id FROM {listed} WHERE id NOT IN (SELECT entity_id FROM {raw}) UNION ALL SELECT DISTINCT 'not a candidate', concat(l.s1, ' ', l.id) FROM {listed} l LEFT JOIN (
            SELECT a.entity_id AS s1, b.entity_id AS id FROM {cand} c JOIN {raw} a ON a.key = c.s1 JOIN {raw} b ON b.key = c.cand) c ON c.s1 = l.s1 AND c.id = l.id WHERE c.id IS NULL""",
    "validate_findings": "SELECT finding, CAST(max(total) AS bigint) AS n, LIST(example, rn) AS ids FROM {ranked_findings} WHERE rn <= 5 GROUP BY finding",
    "ranked_findings": "SELECT finding, example, row_number() OVER (PARTITION BY finding ORDER BY example) AS rn, count(*) OVER (PARTITION BY finding) AS total FROM {findings}",
    # Second-stage features: a pair's probability among its entity's and its record's.
    "stack_features": "SELECT cand, s1, prob, logit, s_rank, s_n, s_max, s_gap, s_sum, s_n50, c_rank, c_n, c_max, c_gap, c_sum, c_n50, coalesce(max(CASE WHEN c_rank = 2 THEN prob END) OVER (PARTITION BY cand), 0.0) AS c_second, share_s FROM ("
    "SELECT cand, s1, prob, round(ln(least(greatest(prob, 0.000001), 0.999999) / (1 - least(greatest(prob, 0.000001), 0.999999))), 6) AS logit, "
    + ", ".join(f"row_number() OVER (PARTITION BY {k} ORDER BY prob DESC, {o}) AS {p}_rank, count(*) OVER {p} AS {p}_n, max(prob) OVER {p} AS {p}_max, round((max(prob) OVER {p}) - prob, 6) AS {p}_gap, round(sum(prob) OVER {p}, 6) AS {p}_sum, sum(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END) OVER {p} AS {p}_n50" for k, o, p in (("s1", "cand", "s"), ("cand", "s1", "c")))
    + ", round(prob / greatest(sum(prob) OVER s, 0.000001), 6) AS share_s FROM {scored} WINDOW s AS (PARTITION BY s1), c AS (PARTITION BY cand)) x",
    # A dictionary of words that stand for one another in true pairs of a name in another script and one in Latin letters, word by
    # word. The fixture has no such script, so names of source 3 stand for it.
    "scripts": "SELECT key, source, name_core, CASE WHEN source = 3 THEN 1 ELSE 0 END AS native FROM {clean} WHERE name_core <> ''",
    "aligned": """
        SELECT src, dst FROM (SELECT UNNEST(SPLIT(b.name_core, ' ')) AS src, UNNEST(SPLIT(a.name_core, ' ')) AS dst FROM {truth} t JOIN {scripts} b ON b.key = t.cand AND b.native = 1
        JOIN {scripts} a ON a.key = t.s1 AND a.native = 0 WHERE len(SPLIT(a.name_core, ' ')) = len(SPLIT(b.name_core, ' '))) x""",
    "dictionary": """
        SELECT src, dst, n FROM (SELECT src, dst, n, sum(n) OVER (PARTITION BY src) AS total FROM (SELECT src, dst, count(*) AS n FROM {aligned} GROUP BY src, dst) p) q
        WHERE n >= 3 AND n >= 0.5 * total AND src <> dst AND length(src) >= 2 AND NOT REGEXP(src, '^[0-9]+$')""",
}


def base(customer: DataFrame, nation: DataFrame, region: DataFrame, words: DataFrame) -> DataFrame:
    """The step base with the number of words as a column: Spark fails where it shuffles by a key that has a scalar subquery in it.
    Without words there are no rows."""
    numbered = customer.crossJoin(F.broadcast(words.agg(F.count(F.lit(1)).alias("n_words")))).withColumn("i", F.try_mod("c_custkey", "n_words"))
    placed = numbered.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.join(words, "i").selectExpr(*(spelled(c, False) for c in OF_CUSTOMER))


#: Steps that Spark plans from DataFrames, and the steps that they need; their texts above are the definitions, for the other engine.
PLANS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "base": (("customer", "nation", "region", "words"), base),
    "clean": (("raw",), lambda raw: clean_addresses(clean_names(raw)).drop("business_name", "business_address")),
    "tokens": (("clean",), blocking.token_sets),
    "best": (("weights",), lambda weights: blocking.best_pairs(weights, TOP, PRUNE)),
    "stack_features": (("scored",), stack_features),
    "grid": (("one_owner", "s1_info"), decision.grid),
    "findings": (("rows", "raw", "cand"), validation.list_findings),
    "decision": (("grid", "s1_info"), decision.choose),
    "applied": (("one_owner", "decision"), decision.apply),
    "aligned": (("truth", "scripts"), translit.aligned),
}

BASE = ("region", "nation", "customer", "documents")
#: Steps that are queries of their own, as er_<name>.
QUERIES = (
    "raw", "hash_folds", "sample", "sampled_truth", "name_forms", "address_forms", "token_sets", "idf_report", "candidates_name", "candidates_union", "labels", "test_features", "blocking_recall", "candidate_stats", "reduction_ratio", "ceiling", "group_features",
    "exact_features", "jaro_winkler", "blocking_partner", "blocking_relative", "one_owner", "threshold", "expected_f", "grid_search", "per_country", "decision_report", "applied_pairs", "macro_f05", "pair_rates", "output_counts", "pair_confusion", "entity_outcomes",
    "error_causes", "recall_bins", "id_lists", "validate_findings", "stack_features", "dictionary",
)
#: Steps that are read more than once and costly: they are written once into the shared folder when the plan is run.
WRITTEN = ("base", "raw", "clean", "weights", "cand", "one_owner", "grid")


def needs(name: str, other: bool = False) -> list[str]:
    """The steps and tables that a step reads."""
    if name in PLANS and not other:
        return list(PLANS[name][0])
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", STEPS.get(name, ""))))


def ordered(name: str, given: Container[str] = (), other: bool = False) -> list[str]:
    """The steps that name needs, each after those it needs itself; what is given needs none."""
    out: list[str] = []
    for n in needs(name, other):
        if n not in given:
            out += [m for m in ordered(n, given, other) if m not in out]
    return [*out, name] if name in STEPS else out


def rounded(text: str) -> str:
    """text with each round(x, n) of doubles as round(x * 10^n) / 10^n, as the other engine does it: Spark's own rounds the decimal digits,
    so halves like 2.0107085 can differ."""
    out, at = "", 0
    while found := re.compile(r"\bround\(").search(text, at):
        depth, end, comma = 1, found.end(), None
        while depth:
            c = text[end]
            depth += (c == "(") - (c == ")")
            comma = end if c == "," and depth == 1 else comma
            end += 1
        x, n = rounded(text[found.end() : comma]), int(text[comma + 1 : end - 1])
        out += f"{text[at : found.start()]}(round(({x}) * 1e{n}) / 1e{n})"
        at = end
    return out + text[at:]


def spelled(text: str, other: bool) -> str:
    for word, spelling in WORDS.items():
        text = text.replace(word, spelling[other])
    text = re.sub(r"(?<![\w.'])(\d+\.\d+)(?![\w.'])", r"\1e0", text)  # doubles, not decimals
    text = text if other else rounded(text)
    text = re.sub(r"AT\((\w+), (\d+)\)", lambda m: f"{m[1]}[{int(m[2]) + 1}]" if other else f"get({m[1]}, {m[2]})", text)
    text = re.sub(r"LIST\(([\w.]+), (.*?)\) AS ids", r"string_agg(\1, ',' ORDER BY \2) AS ids" if other else r"listagg(\1, ',') WITHIN GROUP (ORDER BY \2) AS ids", text)
    text = re.sub(r"HASH\((.*?), (\d)\)( \* 5\) AS int| <)", lambda m: (duck_hash(m[1], int(m[2])) if other else f"tessera_hash01({m[1]}, {m[2]})") + m[3], text)
    return text


def prepare(spark: SparkSession, names: Iterable[str], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """tables and the costly steps that names need, each written once, so that queries over the result share them."""
    spark.udf.register("tessera_hash01", hash01_udf())
    spark.udf.register("tessera_jaro_winkler", score_udf("jaro_winkler"))
    made = dict(tables)
    for name in names:
        for n in ordered(name, made):
            if n in WRITTEN and n != name:
                made[n] = written(_plan(spark, n, made), n)
    return made


def _plan(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    made = dict(tables)
    for n in ordered(name, tables):
        if n not in made:
            made[n] = PLANS[n][1](*(made[x] for x in PLANS[n][0])) if n in PLANS else spark.sql(spelled(STEPS[n], False), **{x: made[x] for x in needs(n)})
    return made[name]


def run(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The step name over tables, which hold the base tables and any step that stands for a planned one."""
    return _plan(spark, name, prepare(spark, [name], tables))


def oracle(name: str) -> str:
    """The step as one statement for another engine."""
    steps = ordered(name, other=True)
    text = lambda n: reduce(lambda t, x: t.replace(f"{{{x}}}", x if x in BASE else f"er_{x}_"), needs(n, True), spelled(STEPS[n], True))
    return "WITH " + ", ".join(f"er_{n}_ AS MATERIALIZED ({text(n)})" for n in steps) + f" SELECT * FROM er_{name}_"
