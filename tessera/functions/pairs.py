"""Features of a pair of cleaned records; all but the text scorers, which are one function, are native expressions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .address import ADDRESS_COLUMNS
from .similarity import scores
from .text import NAME_COLUMNS

#: Feature, scorer, column of both records.
SCORED = (
    ("n_set", "token_set_ratio", "name_core"), ("n_sort", "token_sort_ratio", "name_core"), ("n_ratio", "ratio", "name_core"), ("n_partial", "partial_ratio", "name_core"), ("n_jw", "jaro_winkler", "name_core"),
    ("n_full_set", "token_set_ratio", "name_clean"), ("key_set", "token_set_ratio", "name_key"), ("key_sort", "token_sort_ratio", "name_key"), ("skel_set", "token_set_ratio", "name_skel"),
    ("skel_ratio", "ratio", "name_skel"), ("nosp_ratio", "ratio", "name_nospace"), ("nosp_partial", "partial_ratio", "name_nospace"), ("a_set", "token_set_ratio", "addr_clean"),
    ("a_sort", "token_sort_ratio", "addr_clean"), ("a_ratio", "ratio", "addr_clean"), ("a_partial", "partial_ratio", "addr_clean"),
)
#: Prefix of the three features, column: equal, different, missing on a side.
COMPARED = (("state", "state"), ("post", "postcode"), ("legal", "name_legal"), ("house", "house_no"))
RECORD_COLUMNS = (*NAME_COLUMNS, *ADDRESS_COLUMNS)


def _flag(c: Column) -> Column:
    return c.cast("int")


def _word_list(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def _number(c: Column) -> Column:
    """The first whole number of up to nine digits in a house number, else -1."""
    digits = F.regexp_extract(c, "([0-9]+)", 1)
    return F.when(F.length(digits).between(1, 9), digits.try_cast("long")).otherwise(-1)


def string_features(pairs: DataFrame) -> DataFrame:
    """pairs with the 48 text features of the records in its columns a_* and b_* (RECORD_COLUMNS each), which go.

    Nulls don't occur in cleaned records; a feature of a null is null or 0. Scores are rounded to six digits.
    """
    alt = {f"{side}_alias": F.when(F.col(f"{side}_name_alt") != "", F.col(f"{side}_name_alt")).otherwise(F.col(f"{side}_name_core")) for side in "ab"}
    crossed = {"a_cross1": alt["a_alias"], "b_cross1": F.col("b_name_core"), "a_cross2": F.col("a_name_core"), "b_cross2": alt["b_alias"]}
    pairs = pairs.withColumns(alt | crossed)
    wanted = [*SCORED, *((f"alt_{c}", "token_set_ratio", c) for c in ("alias", "cross1", "cross2"))]
    text = sorted({f"{side}_{c}" for _, _, c in wanted for side in "ab"})
    pairs = pairs.withColumn("_scores", scores(wanted, text))
    s = F.col("_scores")
    a, b = ({c: F.col(f"{side}_{c}") for c in RECORD_COLUMNS} for side in "ab")
    f = {n: s[n] for n, _, _ in SCORED}
    some_alt = (a["name_alt"] != "") | (b["name_alt"] != "")
    f |= {"alt_best": F.greatest(s["n_set"], s["alt_alias"], s["alt_cross1"], s["alt_cross2"]), "has_alt": _flag(some_alt)}
    for name, c in COMPARED:
        known, same = (a[c] != "") & (b[c] != ""), a[c] == b[c]
        f |= {f"{name}_eq": _flag(known & same), f"{name}_conf": _flag(known & ~same), f"{name}_miss": _flag(~known)}
    x, y = a["house_no"], b["house_no"]
    inside = x.startswith(y) | x.endswith(y) | y.startswith(x) | y.endswith(x)
    m, n = _number(x), _number(y)
    both = (m >= 0) & (n >= 0)
    f |= {
        "house_part": _flag((x != "") & (y != "") & (x != y) & inside),
        "house_numdiff": F.when(both, F.abs(m - n)).otherwise(-1).cast("double"),
        "house_numreldiff": F.round(F.when(both, F.abs(m - n) / F.greatest(m, n, F.lit(1))).otherwise(-1.0), 6),
        "house_numeq": _flag(both & (m == n)),
    }
    p, q = _word_list(a["numbers"]), _word_list(b["numbers"])
    shared, all_ = F.size(F.array_intersect(p, q)), F.size(F.array_union(p, q))
    first_a, first_b = (F.coalesce(F.get(_word_list(r["name_key"]), F.lit(0)), F.lit("")) for r in (a, b))
    f |= {
        "num_jacc": F.round(F.when(all_ > 0, shared / F.greatest(all_, F.lit(1))).otherwise(-1.0), 6),
        "num_common": shared,
        "key_first_eq": _flag((first_a != "") & (first_a == first_b)),
        "lm_any": _flag((a["landmark"] != "") | (b["landmark"] != "")),
    }
    for side, r in (("a", a), ("b", b)):
        f |= {f"nonascii_{side}": r["is_nonlatin"], f"dom_{side}": r["is_domain"], f"amiss_{side}": r["addr_missing"], f"len_{side}": F.length(r["name_core"]), f"ntok_{side}": F.size(_word_list(r["name_core"]))}
    sides = {f"{side}_{c}" for side in "ab" for c in RECORD_COLUMNS} | alt.keys() | crossed.keys() | {"_scores"}
    return pairs.select(*(F.col(f"`{c}`") for c in pairs.columns if c not in sides), *(c.alias(n) for n, c in f.items()))
