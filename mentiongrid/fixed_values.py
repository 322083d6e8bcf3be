"""Constants that must have exactly these contents for right results."""

# Topic dictionary (label, pattern), ASCII case-insensitive.
TOPIC_TERMS = [
    ("Typhus", r"\b(ty(ph|f)(us|euz\w*)|febris\s?typhoidea|kwaadaardige\s?koorts)\b"),
    ("Dysentery", r"\b(diarrhoea|dysenter\w*|rood\s?loop|buik\s?loop|bloed\s?gang)\b"),
    ("Cholera", r"\b(choler\w*|krim\s?koorts)\b"),
    ("Smallpox", r"\b(pokken|variola)\b"),
    ("ScarletFever", r"\b(rood\s?vonk|scarlatina|scharlaken\s?koorts)\b"),
    ("Measles", r"\b(mazelen|rood\s?ziekte|rubeola|rubella)\b"),
    ("Tuberculosis", r"\b(tering|verteringsziekte)\b"),
    ("Diphteria", r"\b((c|k)roup|angina\s?diphtheri\w*|diphtheri\w*|difteritis)\b"),
    ("Influenza", r"\b(griep|influenza)\b"),
    ("Malaria", r"\b(malaria|moeras\s?koorts|polder\s?koorts)\b"),
]

# Name of a delivered zip file -> period label of its tables.
ZIP_PERIODS = [
    ("kranten_pd_183x.zip", "1830_1839"),
    ("kranten_pd_184x.zip", "1840_1849"),
    ("kranten_pd_1850-4.zip", "1850_1854"),
    ("kranten_pd_1855-9.zip", "1855_1859"),
    ("kranten_pd_1860-4.zip", "1860_1864"),
    ("kranten_pd_1865-9.zip", "1865_1869"),
    ("kranten_pd_1870-4.zip", "1870_1874"),
    ("kranten_pd_1875-6.zip", "1875_1876"),
    ("kranten_pd_1877-9.zip", "1877_1879"),
]

# XML namespaces of issue descriptions.
NAMESPACES = {
    "didl": "urn:mpeg:mpeg21:2002:02-DIDL-NS",
    "dc": "http://purl.org/dc/elements/1.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "ddd": "http://www.kb.nl/namespaces/ddd",
    "xsi": "http://www.w3.org/2001/XMLSchema-instance",
}

# Member suffixes inside a delivered zip file.
ARTICLE_SUFFIX = "articletext.xml"
ISSUE_SUFFIX = "didl.xml"

# Parts stripped from harvested article identifiers.
RESOLVER_PREFIX_PATTERN = r"^http://resolver\.kb\.nl/resolve\?urn="
RESOLVER_SUFFIX_PATTERN = r":ocr$"

# Dated annotations of the mention-rate time line.
KEY_DATES = [
    ("1832-07-01", "1832 cholera epidemic", 0.045),
    ("1849-07-01", "1849 cholera epidemic", 0.045),
    ("1853-10-16", "Crimean war", 0.04),
    ("1866-07-01", "1866 cholera epidemic", 0.045),
]

# Saved pair queries (label, topic pattern, place pattern), Unicode mode.
PAIR_QUERIES = [
    ("typhus amsterdam", r"ty(ph|f)(us|euz.)|febris.?typhoidea|kwaadaardige.*koorts", r"amste[rl]da.*|amst\."),
    ("cholera rotterdam", r"cholera", r"rotter*"),
    ("cholera amsterdam wide", r"cholera", r"amster*"),
    ("cholera utrecht", r"cholera", r"u[i]trec*"),
    ("cholera maastricht wide", r"cholera", r"maastric*"),
    ("cholera den haag", r"choler.*|krim.?koorts", r"graven.?hage|haag.*|s.?hage|grave\."),
    ("cholera amsterdam", r"choler.*|krim.?koorts", r"amste.?dam|amst\.?"),
    ("flu amsterdam", r"griep|influenza", r"amste.?dam|amst\.?"),
    ("smallpox amsterdam", r"pokken|variola", r"amste.?dam|amst\."),
    ("cholera franekeradeel", r"choler.*|krim.?koorts", r"franekeradeel|frjentsjerteradiel"),
    ("smallpox franekeradeel", r"pokken|variola", r"franekeradeel|frjentsjerteradiel"),
    ("cholera leeuwarden", r"choler.*|krim.?koorts", r"l(eeu|iw|ieu)ward(en|\.)|ljouwert"),
    ("smallpox leeuwarden", r"pokken|variola", r"l(eeu|iw|ieu)ward(en|\.)|ljouwert"),
    ("cholera leiden", r"choler.*|krim.?koorts", r"le(i|y)den|leid(s|sch)e"),
    ("smallpox leiden", r"pokken|variola", r"le(i|y)den|leid(s|sch)e"),
    ("cholera maastricht", r"cholera", r"maastr(ich.*|\.)"),
    ("smallpox maastricht", r"pokken|variola", r"maastr(ich.*|\.)"),
    ("cholera leiden short", r"cholera", r"le[iy]den"),
]

# Topic patterns of the saved queries over all places, Unicode mode, 20 or 40 characters.
CHOLERA_EVERYWHERE = r"choler.*|krim.?koorts"
SMALLPOX_EVERYWHERE = r"pokken|variola|pok.?ziekte"

# Place names too ambiguous to map (also ordinary words or surnames).
AMBIGUOUS_PLACES = "Sluis|Broek|Heer|Haren|Vries|Bergen|Waarde"
