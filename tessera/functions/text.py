"""Business names in a normal form: columns in, columns out; only accents go through Python, and only where a text isn't ASCII."""
from __future__ import annotations

import unicodedata
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words and their short forms, legal forms and their skeletons, words that say little, and patterns.
CANON = {
    "limited": "ltd", "private": "pvt", "corporation": "corp", "incorporated": "inc", "company": "co", "compagnie": "co", "cie": "co", "international": "intl", "brothers": "bros",
    "centre": "center", "services": "service", "svcs": "service", "svc": "service", "technologies": "tech", "technology": "tech", "enterprise": "enterprises", "associates": "assoc",
    "associate": "assoc", "manufacturing": "mfg", "management": "mgmt", "grp": "group", "holding": "holdings", "hldgs": "holdings", "societe": "ste", "saint": "st",
    "etablissements": "ets", "establishments": "ets", "solution": "solutions", "consultant": "consultants", "industry": "industries", "venture": "ventures", "partner": "partners",
    "system": "systems", "product": "products",
}
LEGAL = ("ltd", "pvt", "corp", "inc", "co", "llc", "llp", "lp", "plc", "pllc", "pc", "sa", "sas", "sasu", "sarl", "eurl", "sci", "snc", "gmbh", "opc", "pty", "ag", "nv", "bv")
LEGAL_SKELETONS = {"prvt": "pvt", "lmtd": "ltd", "krprtn": "corp", "kmpn": "co", "inkrprtd": "inc", "elp": "llp"}
STOP = ("the", "and", "of", "a")
GENERIC = (
    "service", "group", "partners", "center", "holdings", "solutions", "enterprises", "ventures", "assoc", "intl", "global", "industries", "trading", "consultants", "consulting", "india", "france", "usa",
    "systems", "mgmt", "tech", "products",
)
DIGITS_FOR_LETTERS = ("013458", "oleasb")
ALIAS = r"\b(?:doing business as|trading as|d\s*/\s*b\s*/\s*a|dba|t\s*/\s*a|aka|formerly)\b"
MESSRS = r"\bm\s*/\s*s\b\.?"
DOMAIN = r"^(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:co\.in|com|in|net|org|fr|biz|info|io|co|us)$"
MOJIBAKE = r"[ÂâÃ][\u0080-\u009f]+|[\u0080-\u009f]"
SKELETON = (("ph", "f"), ("ck", "k"), ("q", "k"), ("c", "k"), ("z", "s"), ("w", "v"), ("x", "ks"))

# The first code points of the Indic blocks, and Latin letters by place in such a block.
INDIC_BLOCKS = (0x900, 0x980, 0xA00, 0xA80, 0xB00, 0xB80, 0xC00, 0xC80, 0xD00)
INDIC = {
    0x01: "N", 0x02: "N", 0x03: "H", 0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu", 0x0B: "R", 0x0E: "e", 0x0F: "e", 0x10: "ai", 0x12: "o", 0x13: "o", 0x14: "au",
    0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "ng", 0x1A: "c", 0x1B: "ch", 0x1C: "j", 0x1D: "jh", 0x1E: "ny", 0x1F: "tt", 0x20: "tth", 0x21: "dd", 0x22: "ddh", 0x23: "nn", 0x24: "t", 0x25: "th",
    0x26: "d", 0x27: "dh", 0x28: "n", 0x29: "nnn", 0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "rr", 0x32: "l", 0x33: "l", 0x34: "lll", 0x35: "v", 0x36: "sh", 0x37: "ss",
    0x38: "s", 0x39: "h", 0x3C: "", 0x3E: "aa", 0x3F: "i", 0x40: "ii", 0x41: "u", 0x42: "uu", 0x43: "R", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au", 0x4D: "",
    **{0x66 + d: str(d) for d in range(10)},
}

#: Letters that don't decompose into a letter and an accent.
LETTERS = str.maketrans({"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ı": "i", "þ": "th", "Þ": "Th", "ð": "d"})

#: A dot of a run of single letters with a dot each.
ACRONYM_DOT = r"(?<=\b[a-z]\.[a-z])\.|(?<=\b[a-z])\.(?=[a-z]\.)"

NAME_COLUMNS = ("name_clean", "name_core", "name_key", "name_skel", "name_nospace", "name_alt", "name_legal", "is_domain", "is_nonlatin")


#: Letters of the Indic scripts, whose blocks share one order: a consonant without its own vowel, vowels and their signs, digits.
LETTERS.update({first + place: latin for first in INDIC_BLOCKS for place, latin in INDIC.items()})


def plain(text: str) -> str:
    """ASCII for text: accents go, Indic letters become Latin ones, other signs become blanks."""
    return "".join(c if c < "\x80" else "" if unicodedata.combining(c) else " " for c in unicodedata.normalize("NFKD", text.translate(LETTERS)))


def ascii_lower(c: Column) -> Column:
    """Lower-case ASCII of a text; null is empty."""

    @F.arrow_udf("string")
    def strip(t: pa.Array) -> pa.Array:
        return pa.array([plain(x or "") for x in t.to_pylist()], pa.string())

    text = F.coalesce(c, F.lit(""))
    return F.lower(F.when(text.rlike(r"[^\x00-\x7F]"), strip(F.regexp_replace(text, MOJIBAKE, " "))).otherwise(text))


def words(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(c, "[^a-z0-9]+", " "), " "), lambda w: w != "")


def skeleton(w: Column) -> Column:
    """The sound of a word in consonants; words that begin with a digit stay."""
    s = w
    for old, new in SKELETON:
        s = F.replace(s, F.lit(old), F.lit(new))
    s = F.regexp_replace(F.regexp_replace(s, "(?<!^)[aeiouyh]", ""), r"(.)\1+", "$1")
    return F.when(w.rlike("^[0-9]"), w).otherwise(s)


def letters_for_digits(w: Column) -> Column:
    """A word of four signs or more with a single digit: the letter that the digit stands for."""
    return F.when((F.length(w) >= 4) & w.rlike("^[^0-9]*[0-9][^0-9]*$"), F.translate(w, *DIGITS_FOR_LETTERS)).otherwise(w)


def _mapped(w: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(table.items()))), w), w)


def _canonical(text: Column) -> Column:
    """The words of a name in their short forms; legal forms are also known by their skeletons."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ACRONYM_DOT, ""), "[&+]", " and "), "['`’]", "")
    short = F.transform(words(text), lambda w: _mapped(letters_for_digits(w), CANON))
    skeletons = F.create_map(*map(F.lit, chain.from_iterable(LEGAL_SKELETONS.items())))
    return F.transform(short, lambda w: F.when((F.length(w) >= 5) & ~w.isin(*LEGAL), F.coalesce(F.try_element_at(skeletons, skeleton(w)), w)).otherwise(w))


def _first_filled(*arrays: Column) -> Column:
    return F.coalesce(*(F.when(F.size(a) > 0, a) for a in arrays[:-1]), arrays[-1])


def _core(t: Column) -> Column:
    return _first_filled(F.filter(t, lambda w: ~w.isin(*LEGAL, *STOP)), F.filter(t, lambda w: ~w.isin(*STOP)), t)


def clean_names(df: DataFrame, name: str = "business_name") -> DataFrame:
    """df with NAME_COLUMNS for the column name. Null and empty names give empty texts and 0; other columns stay as they are.

    Raises ValueError if df has one of the new columns already.
    """
    taken = {c.lower() for c in df.columns}
    if taken & set(NAME_COLUMNS):
        raise ValueError(f"there are columns {sorted(taken & set(NAME_COLUMNS))} already")
    c = dict(zip(("text", "label", "main", "alias", "tokens", "core", "alt"), (f"__tessera_name_{i}" for i in range(7)), strict=True))
    text, label, main, alias, tokens, core, alt = (F.col(x) for x in c.values())
    out = df.withColumn(c["text"], F.regexp_replace(ascii_lower(F.col(name)), MESSRS, " "))
    out = out.withColumn(c["label"], F.regexp_extract(F.regexp_replace(text, r"\s+", ""), DOMAIN, 1))
    named = F.when(label != "", F.replace(label, F.lit("-"), F.lit(" "))).otherwise(text)
    out = out.withColumn(c["text"], named).withColumn(c["alias"], F.split(text, ALIAS, 2))
    first, second = F.trim(F.get(alias, F.lit(0))), F.coalesce(F.trim(F.get(alias, F.lit(1))), F.lit(""))
    out = out.withColumn(c["main"], F.when(first == "", second).otherwise(first)).withColumn(c["alt"], _core(_canonical(F.when(first == "", "").otherwise(second))))
    out = out.withColumn(c["tokens"], _canonical(main)).withColumn(c["core"], _core(tokens))
    return out.withColumns(
        {
            "name_clean": F.array_join(tokens, " "),
            "name_core": F.array_join(core, " "),
            "name_key": F.array_join(_first_filled(F.filter(core, lambda w: ~w.isin(*GENERIC)), core), " "),
            "name_skel": F.array_join(F.transform(core, skeleton), " "),
            "name_nospace": F.array_join(core, ""),
            "name_alt": F.array_join(alt, " "),
            "name_legal": F.array_join(F.array_sort(F.array_distinct(F.filter(tokens, lambda w: w.isin(*LEGAL)))), " "),
            "is_domain": (label != "").cast("int"),
            "is_nonlatin": F.coalesce(F.col(name).rlike(r"[\p{L}&&[^\u0000-ɏ]]"), F.lit(False)).cast("int"),
        }
    ).drop(*c.values())
