"""Parts of a postal address out of its written form."""

from __future__ import annotations

import unicodedata
from typing import NamedTuple

import regex

#: Fixed spellings of countries.
COUNTRIES = {
    "US": "united states|united states of america|usa|us|u s a|america",
    "GB": "united kingdom|great britain|gb|uk|england|scotland|wales|u k",
    "DE": "germany|deutschland|de|ger|deu",
    "FR": "france|fr|fra",
    "ES": "spain|espana|es|esp",
    "IT": "italy|italia|it|ita",
    "NL": "netherlands|the netherlands|nederland|nl|holland",
    "SE": "sweden|sverige|se|swe",
    "CA": "canada|ca|can",
    "AU": "australia|au|aus",
    "JP": "japan|jp|jpn|日本",
    "KR": "south korea|korea|republic of korea|kr|kor|대한민국|한국",
    "PT": "portugal|pt",
    "AT": "austria|osterreich|at|aut",
    "CH": "switzerland|schweiz|suisse|ch|che",
}
_COUNTRY = {w: k for k, v in COUNTRIES.items() for w in v.split("|")}

#: Kinds of street and their spellings; a kind at the front and one at the end of a name are the same.
KINDS = {
    "street": "street st str",
    "strasse": "strasse strabe",
    "road": "road rd",
    "avenue": "avenue ave av avda avd avenida",
    "boulevard": "boulevard blvd boul bd bvd bulevar",
    "lane": "lane ln",
    "drive": "drive dr drv",
    "court": "court ct crt",
    "place": "place pl plaza plza pza platz",
    "square": "square sq",
    "terrace": "terrace ter terr",
    "way": "way wy",
    "rue": "rue r",
    "calle": "calle c cl",
    "paseo": "paseo pso po",
    "allee": "allee all",
    "weg": "weg",
    "gasse": "gasse",
    "quai": "quai",
    "chemin": "chemin ch",
    "impasse": "impasse imp",
    "camino": "camino cno",
    "ronda": "ronda rda",
    "via": "via",
    "ring": "ring",
    "damm": "damm",
}
_KIND = {w: k for k, v in KINDS.items() for w in v.split()}
_JOINED = ("strasse", "allee", "platz", "gasse", "weg", "damm", "ring", "str", "pl")
_DIRECTION = {w: k for k, v in {"n": "n north", "s": "s south", "e": "e east", "w": "w west", "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest"}.items() for w in v.split()}
#: Words written short, and words that tell nothing.
SHORT = {"sta": "santa", "sto": "santo", "mt": "mount", "ft": "fort", "gov": "governor", "gob": "gobernador", "gral": "general", "gen": "general", "pres": "president", "sainte": "saint", "ste": "saint", "hbr": "harbor", "pk": "park", "prof": "profesor", "cap": "capitan"}
SILENT = {"de", "del", "la", "las", "los", "el", "des", "du", "le", "les", "l", "d", "the", "da", "do", "di", "der", "die", "das", "am", "an", "zum", "zur", "no", "nr", "num", "numero"}
_ORDINAL = {w: i for i, w in enumerate("zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split())}
_TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}
_TENTH = {"thirtieth": 30, "fortieth": 40, "fiftieth": 50}

_UNIT = regex.compile(r"(?:\b(?:suite|ste|unit|studio|apt|apartment|office|room|rm|bureau|oficina)\b\.?\s*#?\s*|#\s*)([a-z]?-?\d+[a-z]?|[a-z])\b(?!\.?\s*[a-z]{2,})")
_REMARK = regex.compile(r"\b(?:ground floor|rear entrance|local bajo|front desk|rdc|\d+\.? ?og|\d+(?:st|nd|rd|th) floor|inside [a-z ]*|c/o [a-z ]*|upstairs|basement|rear|planta baja|bajo|eg|erdgeschoss|hinterhof)\b\.?")
_NUMBER = regex.compile(r"(?<![\w.])(?:n[º°o]\.?\s*|nr\.?\s*|#)?(\d+)\s?(?:([a-d])(?![\w./]))?(?!(?:st|nd|rd|th)\b)(?![\w])")


class Address(NamedTuple):
    country: str | None
    city: str  # key, '' if unknown
    city_in_line: str  # key of a town named in the street line, '' if none
    region: str
    postal: str  # key, '' if unknown
    street: str  # key of the name without kind and direction
    kind: str
    direction: str
    number: str
    unit: str


def _drops(w: str) -> set[str]:
    return {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}


_NUMBER_WORDS = [w for w in [*_ORDINAL, *_TENS] if len(w) > 4]
_NUMBER_DROPS: dict[str, set[str]] = {}
for _w in _NUMBER_WORDS:
    for _x in _drops(_w):
        _NUMBER_DROPS.setdefault(_x, set()).add(_w)


def _near_ordinal(w: str) -> str:
    """The one number word that lies a slip away from ``w``, else ``w``."""
    near = {n for x in _drops(w) for n in _NUMBER_DROPS.get(x, ()) if abs(len(n) - len(w)) <= 1 and n[0] == w[0] and n[-1] == w[-1]}
    return near.pop() if len(near) == 1 else w


def fold(text: str | None) -> str:
    """Lower case, without accents, ß as ss, one kind of apostrophe."""
    t = unicodedata.normalize("NFKC", text or "").lower().replace("ß", "ss").replace("’", "'").replace("`", "'")
    return "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)).strip()


def country_code(text: str | None) -> str | None:
    key = regex.sub(r"[^\p{L}]+", " ", fold(text)).strip()
    return _COUNTRY.get(unicodedata.normalize("NFC", key))


def city_key(text: str | None) -> str:
    """Letters of a town's name; ae, oe and ue as a, o and u."""
    key = regex.sub(r"[^\p{L}\p{N}]+", "", regex.sub(r"\bst\b\.?", "saint", fold(text)))
    return regex.sub(r"([aou])e", r"\1", key)


def postal_key(text: str | None, country: str | None) -> str:
    """Letters and digits of a postal code without country prefix and delivery suffix; five digits where a leading zero was lost."""
    t = regex.sub(r"^(?:fr|de|d|f|es|e|us)\s*-\s*", "", fold(text))
    t = regex.sub(r"^(\d{5})-\d{4}$", r"\1", t)
    t = regex.sub(r"[^a-z0-9]", "", t)
    return t.zfill(5) if t.isdigit() and len(t) == 4 and country not in ("AU", "NL", "CH", "AT") else t


def street_parts(text: str, country: str | None) -> tuple[str, str, str]:
    """(name key, kind, direction) of a street line without number and unit."""
    t = regex.sub(r"(\p{L})'s\b", r"\1", text)
    first_short = regex.match(r"\s*(c/|c\.|r\.|p\.)", t)
    t = regex.sub(r"\bl'|\bd'", " ", t)
    t = regex.sub(r"pº|p\.º", "paseo", t)
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", t) if w]
    if first_short and words:
        words[0] = {"c": "calle", "r": "rue", "p": "paseo"}[first_short[1][0]]
    name, kind, direction = [], "", ""
    romance = country in ("FR", "ES", "IT", "PT") or (country is None and len(words) > 1 and words[0] in _KIND and words[0] not in ("st", "dr") and words[-1] not in _KIND and words[-1] not in _DIRECTION)
    german = country in ("DE", "AT", "CH")
    i = 0
    while i < len(words):
        w = words[i]
        last = all(x in _DIRECTION for x in words[i + 1 :])
        ordinal = regex.fullmatch(r"(\d+)(?:st|nd|rd|th)", w)
        if len(w) > 4 and w not in _ORDINAL and w not in _TENS and not romance:
            w = _near_ordinal(w)
        if ordinal:
            name.append(f"{int(ordinal[1])}th")
        elif w in _TENS and i + 1 < len(words) and _near_ordinal(words[i + 1]) in _ORDINAL:
            name.append(f"{_TENS[w] + _ORDINAL[_near_ordinal(words[i + 1])]}th")
            i += 1
        elif w in _ORDINAL and not romance:
            name.append(f"{_ORDINAL[w]}th")
        elif w in _TENTH:
            name.append(f"{_TENTH[w]}th")
        elif w in _DIRECTION and not romance and not german and not direction and (i == 0 or last) and len(words) > 2:
            direction = _DIRECTION[w]
        elif w in ("st", "dr") and not last:
            name.append("doctor" if w == "dr" else "san" if country == "ES" else "saint")
        elif w == "s" and country == "ES" and not last:
            name.append("san")
        elif w in _KIND and not kind and (last if not romance else not name):
            kind = "strasse" if german and w == "str" else _KIND[w]
        elif w == "la" and i and i == len(words) - 1 and not romance and not kind:
            kind = "lane"
        elif w in SILENT and len(words) > 1:
            pass
        else:
            name.append("doctor" if w == "dr" else SHORT.get(w, w))
        i += 1
    key = "".join(name)
    if not kind:
        for end in _JOINED:
            if key.endswith(end) and len(key) > len(end) + 2 and country in (None, "DE", "AT", "CH"):
                key, kind = key[: -len(end)], "strasse" if end == "str" else _KIND[end]
                break
    key = regex.sub(r"([aou])e", r"\1", key) if german or country is None else key
    return key, kind, direction


_STATES = set("al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy".split())
_GB_POSTAL = regex.compile(r"\b([a-z]{1,2}\d[a-z\d]?) ?(\d[a-z]{2})\s*$")
_POSTAL = regex.compile(r"\b(?:fr-|de-|es-)?(\d{5})(?:-\d{4})?\s*$")


def guess_country(line: str, region: str, postal: str) -> str | None:
    """Country of an address that names none, by its postal code's form, its region or its words; None if they tell nothing."""
    if _GB_POSTAL.search(postal) or _GB_POSTAL.search(line):
        return "GB"
    if region in _STATES:
        return "US"
    if regex.search(r"\bcalle\b|\bc/|\bpaseo\b|\bpso\b|\bdel\b|\blos\b|\blas\b|\bavda\b|\bavenida\b|\bsta\b|\bde (?:la|el|los)\b.*\b(?:cion|cia|illa|ana)\b", line):
        return "ES"
    if regex.search(r"\brue\b|\bdes\b|\bdu\b|\bd'|\bl'", line):
        return "FR"
    if regex.search(r"strasse\b|allee\b|[a-z]{3}str\b|[a-z]{3}platz\b|[a-z]{3}weg\b", line):
        return "DE"
    if regex.fullmatch(r"\d{5}(?:-\d{4})?", postal) and regex.search(r"\b(?:street|st|road|rd|ave?|avenue|blvd|boulevard|boul|lane|ln|drive|court|ct)\b\.?(?:\s+(?:n|s|e|w|north|south|east|west)\b\.?)?(?:\s*,|\s+\d|\s*$)", line):
        return "US"
    return None


def parse(address1: str | None, address2: str | None, city: str | None, region: str | None, postal: str | None, country: str | None) -> Address:
    """The parts of an address; an unreadable part is ''. Nothing is guessed from other records."""
    code = country_code(country)
    town = city_key(city)
    line = regex.sub(r"\s+", " ", fold(address1))
    if code is None:
        code = guess_country(line, fold(region), fold(postal))
    unit = ""
    for part in (fold(address2), line):
        m = _UNIT.search(part)
        if m and not unit:
            unit = m[1].replace("-", "").lstrip("0")
    line = _REMARK.sub(" ", _UNIT.sub(" , ", line))
    segments = [x.strip(" .;-") for x in line.split(",")]
    segments = [x for x in segments if x]
    number, letter, rest, in_line = "", "", [], ""
    for s in segments:
        if not number:
            m = _NUMBER.search(s)
            if m:
                number, letter = m[1].lstrip("0"), m[2] or ""
                s = (s[: m.start()] + " " + s[m.end() :]).strip(" .;-")
                if not s:
                    continue
        rest.append(s)
    code_in_line = ""
    if len(rest) > 1:
        m = _GB_POSTAL.search(rest[-1]) or _POSTAL.search(rest[-1])
        if m:
            code_in_line = "".join(m.groups())
            rest[-1] = rest[-1][: m.start()].strip()
        # the town may stand in the line, after the street
        if not any(w in _KIND for w in regex.split(r"[^\p{L}]+", rest[-1])) or city_key(rest[-1]) == town:
            in_line = city_key(rest[-1])
            rest = rest[:-1]
    name, kind, direction = street_parts(" ".join(rest), code)
    return Address(code, town, in_line, fold(region), postal_key(postal, code) or code_in_line, name, kind, direction, number + letter, unit)
