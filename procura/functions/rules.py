"""Rule tables as data.

Everything between the FIXED VALUES markers must equal the source system's
values for results to match (order included: rule lists are applied in the
order written).  Regexes are written in the common Python/Java syntax; the
Spark side prefixes them with ``(?U)`` so ``\\s`` and ``\\d`` are Unicode-aware
like Python's ``re``.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source system)
# ---------------------------------------------------------------------------

# Source codes, in the order the batch job processes them.
SOURCES = (
    "fnspza", "fnnitra", "fnsppresov", "fntt", "dfnkosice", "unb", "unlp", "unm",
    "dfnbb", "nou", "nusch", "vou", "nudch", "suscch", "inmm", "nurch",
    "nemocnicapp", "vusch", "fntn", "donsp", "nsptrstena",
)

# Mail sources and the sender-domain suffix their attachments arrive from.
MAIL_DOMAIN = {
    "fnspza": ".sk", "fnnitra": ".sk", "fnsppresov": ".sk", "fntt": ".sk",
    "dfnkosice": ".sk", "unb": ".sk", "unlp": ".sk", "unm": ".sk", "dfnbb": ".sk",
    "nou": "sk.sk", "nusch": ".sk", "vou": ".sk", "nudch": ".eu", "suscch": ".eu",
    "inmm": ".sk", "nurch": ".sk", "nemocnicapp": ".sk", "vusch": ".sk",
}

# Registry key (cleaned full name) of every source.
REGISTRY_KEY = {
    "fnspza": "fakultna nemocnica s poliklinikou zilina",
    "fnnitra": "fakultna nemocnica nitra",
    "fnsppresov": "fakultna nemocnica s poliklinikou j a reimana presov",
    "fntt": "fakultna nemocnica trnava",
    "dfnkosice": "detska fakultna nemocnica kosice",
    "unb": "univerzitna nemocnica bratislava",
    "unlp": "univerzitna nemocnica l pasteura kosice",
    "unm": "univerzitna nemocnica martin",
    "dfnbb": "detska fakultna nemocnica s poliklinikou banska bystrica",
    "nou": "narodny onkologicky ustav",
    "nusch": "narodny ustav srdcovych a cievnych chorob as",
    "vou": "vychodoslovensky onkologicky ustav as",
    "nudch": "narodny ustav detskych chorob",
    "suscch": "stredoslovensky ustav srdcovych a cievnych chorob as",
    "inmm": "institut nuklearnej a molekularnej mediciny kosice",
    "nurch": "narodny ustav reumatickych chorob piestany",
    "nemocnicapp": "nemocnica poprad as",
    "vusch": "vychodoslovensky ustav srdcovych a cievnych chorob as",
    "fntn": "fakultna nemocnica trencin",
    "donsp": "dolnooravska nemocnica s poliklinikou mudr l nadasi jegeho dolny kubin",
    "nsptrstena": "hornooravska nemocnica s poliklinikou trstena",
}

# Entries added to the registry, in order: key, attribute, value, whether the entry is replaced whole.
REGISTRY_OVERRIDES = (
    ("centrum pre liecbu drogovych zavislosti bratislava", "objednavky_faktury_link",
     "https://cpldz.sk/wp-content/uploads/Fakturyaobjednavky_december.xlsx", False),
    ("centrum pre liecbu drogovych zavislosti kosice", "objednavky_faktury_link",
     "https://ba5c113364.clvaw-cdnwnd.com/a410a7ba52b55860f90d7278a3fc9ce5/200000168-2c40a2c40c/Objedn%C3%A1vky%20tovarov%2C%20slu%C5%BEieb"
     "%20a%20pr%C3%A1c%20a%20Fakt%C3%BAry.xlsx?ph=ba5c113364", False),
    ("detska fakultna nemocnica kosice", "objednavky_faktury_link",
     "https://docs.google.com/uc?id=1uNSfzKDWdQfcwNJv5vBNS3yTGkGKlOIsK9FxXpx_edY", False),
    ("detska fakultna nemocnica s poliklinikou banska bystrica", "objednavky_faktury_link",
     "https://www.detskanemocnica.sk/sites/default/files/files/199/objednavky_od_2023.01.01_do_2023.02.17.pdf", False),
    ("detska fakultna nemocnica s poliklinikou banska bystrica", "objednavky_faktury_link2022",
     "https://www.detskanemocnica.sk/sites/default/files/files/199/objednavky_od_2022.01.01_do_2022.12.30.pdf", False),
    ("detska fakultna nemocnica s poliklinikou banska bystrica", "objednavky_faktury_link2021",
     "https://www.detskanemocnica.sk/sites/default/files/files/199/objednavky_od_2022.01.01_do_2022.12.30.pdf", False),
    ("detska fakultna nemocnica s poliklinikou banska bystrica", "objednavky_faktury_file_ext", ".pdf", False),
    ("detska psychiatricka liecebna n o hran", "objednavky_faktury_link",
     "https://zverejnovanie.mzsr.sk/ministerstvo-zdravotnictva-sr/objednavky/?export=csv&art_rok=2023", False),
    ("detska psychiatricka liecebna n o hran", "objednavky_faktury_file_ext", ".csv", False),
    ("fakultna nemocnica nitra", "objednavky_faktury_link", "https://fnnitra.sk/objd/new/", False),
    ("fakultna nemocnica s poliklinikou f d roosevelta banska bystrica", "objednavky_faktury_link",
     "https://www.fnspfdr.sk/objednavky/zverejnenie.php?akcia=vsetkyobjednavky_internet", False),
    ("fakultna nemocnica s poliklinikou zilina", "objednavky_link", "http://www.fnspza.sk/zm2019/objednavky", False),
    ("fakultna nemocnica trencin", "objednavky_link",
     "https://www.fntn.sk/zverejnovanie/objednavky/zobraz/triedenie/order_date/smer/zostupne", False),
    ("dolnooravska nemocnica s poliklinikou mudr l nadasi jegeho dolny kubin_2020", "zverejnovanie_objednavok_faktur_rozne",
     "https://www.donsp.sk/donsp/inzercia/objednavky/objednavky-rok-2020/", True),
    ("dolnooravska nemocnica s poliklinikou mudr l nadasi jegeho dolny kubin_2019", "zverejnovanie_objednavok_faktur_rozne",
     "https://www.donsp.sk/donsp/inzercia/objednavky/objednavky-2019/", True),
    ("dolnooravska nemocnica s poliklinikou mudr l nadasi jegeho dolny kubin_2018", "zverejnovanie_objednavok_faktur_rozne",
     "https://www.donsp.sk/donsp/inzercia/objednavky/objednavky-rok-2018/", True),
    ("dolnooravska nemocnica s poliklinikou mudr l nadasi jegeho dolny kubin_2017", "zverejnovanie_objednavok_faktur_rozne",
     "https://www.donsp.sk/donsp/inzercia/objednavky/objednavky-rok-2017/", True),
    ("hornooravska nemocnica s poliklinikou trstena_2023", "zverejnovanie_objednavok_faktur_rozne",
     "https://www.nsptrstena.sk/uploads/fck/document/Objednavky/ROK%202023/Zoznam%20objednavok%202023(1).pdf", True),
)

# Month prefixes (first three letters of a Slovak month name) -> month number.
MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "maj": 5, "jun": 6, "jul": 7,
          "aug": 8, "sep": 9, "okt": 10, "nov": 11, "dec": 12}

# Canonical column -> raw header aliases (compared after header normalisation).
ALIASES = {
    "objednavatel": ["nazov verejneho obstaravatela"],
    "kategoria": ["kategoria zakazky(tovar/stavebna praca/sluzba)", "kategoria(tovar/stavebna praca/sluzba)",
                  "sluzba", "kategoria (tovary / prace / sluzby)", "kategoria(tovary / prace / sluzby)",
                  "kategoria (tovar/stavebna praca/sluzba)", "kategoria zakazky (tovar/stavebna praca/sluzba)"],
    "objednavka_predmet": ["nazov predmetu objednavky", "predmet objednavky", "nazov predmetu zakazky",
                           "predmet zakazky", "nazou predmetu objednavky"],
    "cena": ["hodnotaobjednavkyv eur bez dph", "s.nc bdph", "hodnotaobjednavkyv eur bez dph",
             "hodnota zakazky      s dph", "hodnota objednavky", "hodnota",
             "predpokladana hodnota v eur bez dph", "hodnota objednavky v eur bez dph", "cena v eur bez dph",
             "hodnota objednavky v eur s dph"],
    "datum": ["datum zadania objednavky", "datum objednavky",
              "cislo oznamenia o vyhlaseni vo/ cislo vestnika/ datum zverejnenia", "datum", "platnost zmluvy"],
    "objednavka_cislo": ["c.obj.", "cislo objednavky"],
    "zdroj_financovania": ["zdroje financovania"],
    "balenie": ["balenie"],
    "sukl_kod": ["sukl_kod"],
    "mnozstvo": ["mnozstvo"],
    "poznamka": ["kratke zdovodnenie", "kratke zdovodnenie2", "kratke zdovodnenie (zostavajuca hodnota)",
                 "kratke zdovodnenie/zostavajuca hodnota"],
    "dodavatel_ico": ["dodavatel - ico"],
    "dodavatel_nazov": ["dodavatel - nazov", "uspesny uchadzac", "obchodne meno a sidlo dodavatela"],
    "odkaz_na_zmluvu": ["odkaz na zverejnenu zmluvu"],
    "pocet_oslovenych": ["pocet oslovenych"],
}

# Headers whose presence marks a sheet's prices as VAT-inclusive.
VAT_HEADERS = ("hodnota objednavky v eur s dph", "hodnota zakazky      s dph")

# Noise rows: a row is dropped when any cell starts with a match.  Branch 16 of
# the original names one person; it is configuration (NOISE_PERSONAL_NAMES).
NOISE_BRANCHES = (
    r"vypracovala*\s*:.*", r"schvalil.*:.*", r".*riaditel$", r".*referent .*", r"vysvetlivky:",
    r"^v stlpci.*uviest.*", r".*@.*\.sk.*", r"^informacia o.*", r"^kontakt:.*", r"dna: \d+.*",
    r"judr.*", r"ing.*", r"mgr.*", r"datum zaciatku platnosti", r"^vyhotovil.*",
    r"^- za lekaren$", r"^- za referat prevadzky a udrzby$",
)
NOISE_PERSONAL_NAMES: tuple[str, ...] = ()

# Noise searched (unanchored) in raw, still accented text of web / PDF tables.
NOISE_DONSP = r"(Strana.*)|(Dodávateľ)"
NOISE_TRSTENA = r"(Str:.*)|(Vystavené objednávky za obdobie:)"

# Price rule sets: ordered (pattern, replacement); "" as pattern means a
# whole empty cell.
_R2 = [(r"[a-z]|'|\s|[\(\)]+", ""), (r",-", ""), (r",$", ""), (r",+", "."), (r"/.*", "")]
_R4 = [(r"[a-z]|'|\s|[\(\)]|\++", ""), (r",-", ""), (r",$", ""), (r",+", "."), (r"/.*", ""),
       (r"\.-", ""), (r"-", ""), ("", "0")]
_R5 = [(r"[a-z]|'|\s|[\(\)]|\+|\*+", "")] + _R4[1:]
PRICE_RULES = {
    "R0": [(r"^mc\s*", ""), (r"[,|\.]-.*", ""), (r"[a-z]+\.[a-z]*\s*", ""), (r"[a-z]|'|\s|-|[\(\)]+", ""),
           (r",,", "."), (r",", "."), (r".*[:].*", "0"), (r"=.*", "")],
    "R1": [(r"[a-z]|'|\s|[\(\)]+", ""), (r"[,|\.]-.*", ""), (r"-,", ""), (r",", "."), (r"\.\.", "."),
           (r"/.*/*", ""), (r"\..\.\+", ""), (r"/\..*", ""), (r".*:", "")],
    "R2": _R2,
    "R3": _R2 + [(r"\.-", ""), (r"_", "0")],
    "R4": _R4,
    "R5": _R5,
    "R6": _R5 + [(r"=.*", ""), (r".+\d{2}:\d{2}:\d{2}$", "0")],
    "R7": _R5 + [(r"\.+", ".")],
}
PRICE_SET_OF_SOURCE = {
    "fnspza": "R0", "fnnitra": "R1", "fnsppresov": "R2", "fntt": "R2", "dfnkosice": "R2", "unb": "R3",
    "unlp": "R4", "unm": "R4", "dfnbb": "R5", "nou": "R5", "vou": "R5", "nudch": "R5", "suscch": "R5",
    "inmm": "R5", "nurch": "R5", "vusch": "R5", "nusch": "R6", "nemocnicapp": "R7", "donsp": "R7",
}
# Sources that apply the thousands-dot rule after their price rules.
THOUSANDS_DOT_SOURCES = tuple(s for s in PRICE_SET_OF_SOURCE if s != "donsp")

# Date text corrections of fnspza: (pattern, replacement, is_regex).  Entries
# with is_regex False replace a whole cell equal to the pattern.
DATE_CORRECTIONS = [
    ("210", "201", True), ("217", "2017", True), ("[a-z]", "", True), (r"\(", "", True), (r"\)", "", True),
    (r"\s+", " ", True), ("..", ".", False), (": ", "", False), (".,", ".", False), ("5019", "2019", True),
    (",", ".", False), ("201/8", "2018", True), (r"20\.17", "2017", True), ("209", "2019", True),
    (r"19.12.202$", "19.12.2022", True), ("2048", "2018", True),
]

# Impossible-day fixes of donsp date text (substring replacements).
DATE_TYPO_FIXES = [(r"29\.2\.", "27.2."), (r"31\.04\.", "30.04."), (r"31\.06\.", "30.06.")]

# Attribute lists packed into the two JSON columns.
POPIS_LIST = ["objednavka_predmet", "kategoria", "objednavka_cislo", "zdroj_financovania", "balenie",
              "sukl_kod", "mnozstvo", "poznamka", "odkaz_na_zmluvu", "pocet_oslovenych", "cena_s_dph"]
DODAVATEL_LIST = ["dodavatel_nazov", "dodavatel_ico"]
POPIS_FNTN = ["objednavka_predmet", "objednavka_cislo", "cislo zmluvy", "schvalil", "cena_s_dph"]
POPIS_DONSP = ["objednavka_predmet", "objednavka_cislo", "cena_s_dph"]
POPIS_TRSTENA = ["objednavka_predmet", "objednavka_cislo", "zmluva", "cena_s_dph"]
DODAVATEL_TRSTENA = ["dodavatel"]

FINAL_COLUMNS = ["objednavatel", "cena", "datum", "dodavatel", "popis", "insert_date", "file", "link"]

# Per-source renames and drops.
RENAME_FNTN = {"cislo objednavky": "objednavka_cislo", "nazov dodavatela": "dodavatel_nazov",
               "popis": "objednavka_predmet"}
RENAME_DONSP = {"Číslo objednávky": "objednavka_cislo", "Dodávateľ": "dodavatel_nazov", "IČO": "dodavatel_ico",
                "Suma": "cena", "Predmet objednávky": "objednavka_predmet", "Dátum zverejnenia": "datum"}
RENAME_TRSTENA = {"predmet objednania": "objednavka_predmet", "objednavka": "objednavka_cislo"}
DROP_FNTN = ["ico dodavatela", "schvalil", "mesto dodavatela", "psc dodavatela", "adresa dodavatela",
             "datum vyhotovenia", "cislo zmluvy", "cena s dph (EUR)"]
DROP_DONSP = ["Meno schvaľujúceho"]
DROP_TRSTENA = ["predbeznacena bez dph", "zmluva", "datumobjednania", "schvalil",
                "predbeznapredmet objednaniacena bez dph", "cena_extr"]

DROP_COLUMNS = {"fntn": DROP_FNTN, "donsp": DROP_DONSP, "nsptrstena": DROP_TRSTENA}

# Source files skipped / handled manually, by last extension.
SKIP_EXTENSIONS = ("png", "jpeg", "pkl", "jpg", "htm")
MANUAL_EXTENSIONS = ("pdf", "docx")
SPREADSHEET_EXTENSIONS = ("ods",)
CONVERT_EXTENSIONS = ("doc",)

# Column names of the web sources' tables.
FNTN_HEADERS = ["Číslo objednávky", "Názov dodávateľa", "Popis", "IČO dodávateľa", "Cena s DPH (€)",
                "Dátum vyhotovenia", "Číslo zmluvy", "Schválil", "Mesto dodávateľa", "PSČ dodávateľa",
                "Adresa dodávateľa"]
DONSP_HEADERS = ["Číslo objednávky", "Dodávateľ", "IČO", "Suma", "Predmet objednávky", "Dátum zverejnenia",
                 "Meno schvaľujúceho"]

# Default number of rows per written chunk.
CHUNK_ROWS = 10000
# Search result bound.
SEARCH_LIMIT = 1000

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------

CANONICAL = list(ALIASES)
# Canonical names that count as an alias hit because they list themselves.
SELF_LISTED = [c for c, al in ALIASES.items() if c in al]

# Letters and signs folded to ASCII: every character of the Latin blocks whose
# decomposition is one ASCII letter and combining marks, then the ones without
# a decomposition.  Foldings to several letters are separate replacements.
_PLAIN = {"–": "-", "—": "-", "‐": "-", "‑": "-", "−": "-", "‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"',
          "„": '"', "«": '"', "»": '"', "\u00a0": " ", "\u202f": " ", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L",
          "ø": "o", "Ø": "O", "ħ": "h", "Ħ": "H", "ı": "i"}


def _fold_table() -> dict[str, str]:
    out = {}
    for ch in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            out[ch] = base
    return out | _PLAIN


FOLD = _fold_table()
ACCENTED, UNACCENTED = "".join(FOLD), "".join(FOLD.values())
MULTI_FOLD = [("ß", "ss"), ("€", "EUR"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("…", "...")]
