"""Addresses in a normal form: columns in, columns out, by native expressions but for accents."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _mapped, ascii_lower, words

# States and regions by code (a code that is given twice means the later one), short forms of words, words that say
# little, and patterns.
STATES = {
    # United States; some codes also stand for an Indian state.
    "al": ["alabama"], "ak": ["alaska"], "az": ["arizona"], "ar": ["arkansas"], "ca": ["california"], "co": ["colorado"], "ct": ["connecticut"], "de": ["delaware"],
    "dc": ["district of columbia", "washington dc"], "fl": ["florida"], "ga": ["georgia", "goa"], "hi": ["hawaii"], "id": ["idaho"], "il": ["illinois"], "in": ["indiana"], "ia": ["iowa"],
    "ks": ["kansas"], "ky": ["kentucky"], "la": ["louisiana"], "me": ["maine"], "md": ["maryland"], "ma": ["massachusetts"], "mi": ["michigan"], "mn": ["minnesota", "manipur"],
    "ms": ["mississippi"], "mo": ["missouri"], "mt": ["montana"], "ne": ["nebraska"], "nv": ["nevada"], "nh": ["new hampshire"], "nj": ["new jersey"], "nm": ["new mexico"],
    "ny": ["new york"], "nc": ["north carolina"], "nd": ["north dakota"], "oh": ["ohio"], "ok": ["oklahoma"], "or": ["oregon", "odisha", "orissa", "od"], "pa": ["pennsylvania"],
    "ri": ["rhode island"], "sc": ["south carolina"], "sd": ["south dakota"], "tn": ["tennessee", "tamil nadu"], "tx": ["texas"], "ut": ["utah"], "vt": ["vermont"], "va": ["virginia"],
    "wa": ["washington"], "wv": ["west virginia"], "wi": ["wisconsin"], "wy": ["wyoming"], "pr": ["puerto rico"],
    # India
    "mh": ["maharashtra"], "dl": ["delhi", "nct of delhi"], "up": ["uttar pradesh"], "ka": ["karnataka"], "gj": ["gujarat"], "wb": ["west bengal"], "tg": ["telangana", "ts"], "hr": ["haryana"],
    "rj": ["rajasthan"], "kl": ["kerala"], "br": ["bihar"], "mp": ["madhya pradesh"], "ap": ["andhra pradesh"], "pb": ["punjab"], "jh": ["jharkhand"], "cg": ["chhattisgarh", "chattisgarh", "ct"],
    "uk": ["uttarakhand", "uttaranchal"], "hp": ["himachal pradesh"], "jk": ["jammu and kashmir", "jammu kashmir"], "as": ["assam"], "ch": ["chandigarh"], "py": ["puducherry", "pondicherry"],
    "tr": ["tripura"], "ml": ["meghalaya"], "nl": ["nagaland"], "arp": ["arunachal pradesh"], "mz": ["mizoram"], "sk": ["sikkim"],
    # France: regions, and departments by their region
    "hdf": ["hauts de france", "nord", "pas de calais", "somme", "aisne", "oise"], "naq": ["nouvelle aquitaine", "gironde", "landes", "pyrenees atlantiques", "charente maritime"],
    "pdl": ["pays de la loire", "loire atlantique", "vendee", "maine et loire", "sarthe", "mayenne"], "idf": ["ile de france", "paris"], "ara": ["auvergne rhone alpes"], "occ": ["occitanie"],
    "ges": ["grand est"], "pac": ["provence alpes cote d azur", "paca"], "bre": ["bretagne"], "nor": ["normandie"], "cvl": ["centre val de loire"], "bfc": ["bourgogne franche comte"], "cor": ["corse"],
}
NATIVE_STATES = {
    "ଓଡ଼ିଶା": "odisha", "தமிழ்நாடு": "tamil nadu", "महाराष्ट्र": "maharashtra", "दिल्ली": "delhi", "उत्तर प्रदेश": "uttar pradesh", "ಕರ್ನಾಟಕ": "karnataka", "ગુજરાત": "gujarat", "পশ্চিমবঙ্গ": "west bengal",
    "తెలంగాణ": "telangana", "हरियाणा": "haryana", "राजस्थान": "rajasthan", "കേരളം": "kerala", "बिहार": "bihar", "मध्य प्रदेश": "madhya pradesh", "ఆంధ్రప్రదేశ్": "andhra pradesh", "ਪੰਜਾਬ": "punjab",
}
COUNTRIES = ("india", "usa", "us", "united states", "united states of america", "france")
CANON = {
    "street": "st", "str": "st", "saint": "st", "road": "rd", "avenue": "ave", "av": "ave", "boulevard": "blvd", "bd": "blvd", "bvd": "blvd", "drive": "dr", "lane": "ln", "court": "ct",
    "highway": "hwy", "parkway": "pkwy", "place": "pl", "square": "sq", "circle": "cir", "trail": "trl", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne",
    "northwest": "nw", "southeast": "se", "southwest": "sw", "apartment": "unit", "apt": "unit", "flat": "unit", "suite": "unit", "ste": "unit", "room": "unit", "floor": "fl", "flr": "fl",
    "building": "bldg", "mount": "mt", "fort": "ft", "sector": "sec", "extension": "ext", "extn": "ext", "colony": "col", "ngr": "nagar", "market": "mkt", "route": "rte", "allee": "all",
    "chemin": "chem", "impasse": "imp", "faubourg": "fbg", "fg": "fbg", "r": "rue", "bengaluru": "bangalore", "gurugram": "gurgaon", "bombay": "mumbai", "calcutta": "kolkata", "madras": "chennai",
}
STOP = ("of", "the", "de", "du", "des", "la", "le", "les", "l", "d", "et", "and", "a")
LANDMARK = r"\b(?:near|nr|opp|opposite|behind|beside|next[^a-z0-9]+to|adjacent[^a-z0-9]+to|in[^a-z0-9]+front[^a-z0-9]+of|close[^a-z0-9]+to|landmark|land[^a-z0-9]+mark)\b.*$"
LABEL = r"\b(?:h\s*\.?\s*no|(?:house|door|plot|flat|shop|office|bldg|building|survey|sy|kh|khasra|gali|room|site|ward|property)\s*\.?\s*no|nos|no|num|number)\b\.?"
COMPOUND = r"(?<=\d)\s*[-/]\s*(?=[a-z0-9])|(?<=[a-z0-9])\s*[-/]\s*(?=\d)"
SPLIT_PIN = r"(?<!\d)(\d{3}) (\d{3})(?!\d)"
CENSUS_PLACE = r"\s*cdp\b"
STANDALONE = r"(?<![\w\-/])(\d+)(?![\w\-/])"

ADDRESS_COLUMNS = ("addr_clean", "house_no", "postcode", "state", "numbers", "landmark", "addr_missing")


def state_codes() -> dict[str, str]:
    """The code that each name or code of a state stands for; of codes given twice the later one."""
    return {name: code for code, names in STATES.items() for name in (code, *names)}


_STATE_OF = state_codes()


def _no_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+(?=.)", "")


def _first(a: Column) -> Column:
    return F.coalesce(F.get(a, F.lit(0)), F.lit(""))


def _ascii(c: Column) -> Column:
    """Lower-case ASCII, states in their own scripts by their names in Latin letters."""
    text = F.translate(F.coalesce(c, F.lit("")), "’", "'")
    named = text
    for native, name in NATIVE_STATES.items():
        named = F.replace(named, F.lit(native), F.lit(name))
    return ascii_lower(F.when(text.rlike(r"[^\x00-\x7F]"), named).otherwise(text))


def clean_addresses(df: DataFrame, address: str = "business_address") -> DataFrame:
    """df with ADDRESS_COLUMNS for the column address. Null and blank addresses give empty texts and addr_missing 1; other columns
    stay as they are. A landmark is cut off where its word begins in the component as written.

    Raises ValueError if df has one of the new columns already.
    """
    taken = {c.lower() for c in df.columns}
    if taken & set(ADDRESS_COLUMNS):
        raise ValueError(f"there are columns {sorted(taken & set(ADDRESS_COLUMNS))} already")
    c = dict(zip(("text", "parts", "rest", "body", "tokens", "numeric", "code"), (f"__tessera_addr_{i}" for i in range(7)), strict=True))
    text, parts, rest, body, tokens, numeric, code = (F.col(x) for x in c.values())
    plain = lambda p: F.trim(F.regexp_replace(p, "[^a-z0-9]+", " "))
    state_of = F.create_map(*(F.lit(x) for pair in _STATE_OF.items() for x in pair))
    out = df.withColumn(c["text"], F.regexp_replace(F.regexp_replace(F.trim(_ascii(F.col(address))), SPLIT_PIN, "$1$2"), CENSUS_PLACE, " "))
    named = F.transform(F.split(text, ","), lambda p: F.struct(p.alias("raw"), plain(p).alias("plain"), F.try_element_at(state_of, plain(p)).alias("state")))
    out = out.withColumn(c["parts"], F.filter(named, lambda p: (p["plain"] != "") & ~p["plain"].isin(*COUNTRIES)))
    out = out.withColumn(c["rest"], F.filter(parts, lambda p: p["state"].isNull()))
    out = out.withColumn(c["body"], F.array_join(F.transform(rest, lambda p: F.regexp_replace(F.regexp_replace(p["raw"], "(?s)" + LANDMARK, ""), LABEL, " ")), ","))
    compact = words(F.regexp_replace(F.regexp_replace(body, COMPOUND, ""), "['`]", ""))
    short = F.transform(compact, lambda w: F.when(w.rlike("^[0-9]+$"), _no_zeros(w)).otherwise(_mapped(w, CANON)))
    out = out.withColumn(c["tokens"], F.filter(short, lambda w: ~w.isin(*STOP))).withColumn(c["numeric"], F.filter(tokens, lambda w: w.rlike("[0-9]")))
    codes = F.filter(F.regexp_extract_all(body, F.lit(STANDALONE), F.lit(1)), lambda d: F.length(d).between(5, 6) & ~d.startswith("00"))
    last = F.coalesce(F.try_element_at(codes, F.lit(-1)), F.lit(""))
    # Five digits that come first are a house number.
    out = out.withColumn(c["code"], last).withColumn(c["code"], F.when((F.length(code) == 5) & (_first(numeric) == _no_zeros(code)), "").otherwise(code))
    return out.withColumns(
        {
            "addr_clean": F.array_join(tokens, " "),
            "house_no": _first(F.filter(numeric, lambda w: w != _no_zeros(code))),
            "postcode": code,
            "state": _first(F.filter(F.transform(parts, lambda p: p["state"]), lambda s: s.isNotNull())),
            "numbers": F.array_join(F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(r"(\d+)"), F.lit(1)), _no_zeros)), " "),
            "landmark": F.array_join(F.filter(F.transform(rest, lambda p: F.regexp_extract(p["plain"], LANDMARK, 0)), lambda m: m != ""), " "),
            "addr_missing": (text == "").cast("int"),
        }
    ).drop(*c.values())
